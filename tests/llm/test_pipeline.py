"""The pipeline against its stages in plain Python, and its stages on awkward documents."""

import hashlib

import awkward
import numpy as np
import sentencepiece
from test_quality_pii import pseudonymised
from test_simhash import components

import corpus_pipeline
from tidemark.llm import decontaminate, queries, toxicity
from tidemark.llm.letters import Letters, Lookup

SMALL = "/root/testdata/sf0.001"


def tokens(text):
    found = Letters([text])
    return ["".join(map(chr, found.codes[s:e])) for s, e in zip(found.starts, found.ends)]


def not_toxic(rows, index):
    counts = toxicity.term_counts([t for _, t in rows], Lookup(index.terms), len(index.terms))
    examples = np.concatenate([index.dense(b) for b in range(len(index.blocks))] or [np.zeros((0, len(index.terms)), np.float32)])
    cosines = np.round((index.vectors(counts) @ examples.T).astype(np.float64), 5)
    for row, cosine in zip(rows, cosines):
        near = sorted(range(len(cosine)), key=lambda j: (-cosine[j], j))[: toxicity.NEIGHBOURS]
        weight = cosine[near].sum()
        votes = (cosine[near] * index.labels[near]).sum() / weight if weight > 0 else -1.0
        if index.probability(np.array([votes]))[0] < toxicity.THRESHOLD:
            yield row


def not_leaked(rows, items):
    number: dict = {}
    spelled = [np.array([number.setdefault(w, len(number)) for w in tokens(t)]) for t in items]
    for row in rows:
        doc = np.array([[number.setdefault(w, len(number)) for w in tokens(row[1])]])
        if not any(decontaminate.align(w, doc)[0] >= 2 * len(w) * decontaminate.THRESHOLD for w in spelled):
            yield row


def test_the_whole_pipeline(spark, documents):
    got = {r.doc_id: tuple(r)[1:] for r in corpus_pipeline.run(spark, SMALL).collect()}
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    rows = list(not_toxic(rows, queries.toxicity_index(spark, documents, SMALL)))
    kept = {i for i, _, c in components(rows) if i == c}
    rows = [r for r in rows if r[0] in kept]
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    library = sentencepiece.SentencePieceProcessor(model_file=queries.model_path())
    wanted = {}
    for i, text in not_leaked(rows, items):
        ids = library.encode(pseudonymised(text), add_bos=True, add_eos=True)
        decoded = library.decode(ids).encode()
        raw = np.array(ids, "<u4").tobytes()
        wanted[i] = (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded).hexdigest())
    assert got == wanted and 100 < len(got) < len(documents.collect())


def test_stages_keep_the_columns_and_bear_awkward_documents(spark):
    docs = awkward.documents(spark)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "pii", "sentencepiece"]
    for rows in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, SMALL)
            if name != "sentencepiece":
                assert out.columns == docs.columns and out.dtypes == docs.dtypes
            assert out.count() <= rows.count()
            rows = out if name != "sentencepiece" else rows


def test_every_operator_has_a_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
