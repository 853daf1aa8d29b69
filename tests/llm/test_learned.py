"""Language, toxicity and decontamination: exactness of the search, held-out accuracy, edge cases."""

import random
from collections import Counter

import awkward
import numpy as np
import pytest

from pyspark.sql import functions as F
from tidemark.llm import decontaminate, language, queries, toxicity
from tidemark.llm.letters import Lookup

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


# --- language ----------------------------------------------------------------------------


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang")
    out = queries.op8_language(spark, MEDIUM).join(docs, "doc_id").where("held_out")
    assert out.count() > 100
    assert out.where("lang = lang_pred").count() >= 0.99 * out.count()
    assert out.where("score < 0 OR score > 1").isEmpty()


def test_language_of_awkward_documents(spark):
    train = spark.createDataFrame(
        [(1, "the and of the", "en"), (2, "der und die der", "de"), (3, None, "fr"), (4, "la", None)],
        "doc_id bigint, text string, lang string",
    )
    model = language.train(train)
    assert model.languages == ["de", "en"]
    out = language.predict(awkward.documents(spark), model).collect()
    assert len(out) == len(awkward.ROWS)
    for r, (_, text) in zip(out, awkward.ROWS):
        if not any(c.isalpha() for c in text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    texts = spark.createDataFrame([(1, "the theory"), (2, "unduly derby"), (3, "梦梦"), (4, "THE")], "doc_id bigint, text string")
    got = {r.doc_id: r.lang_pred for r in language.predict(texts, model).collect()}
    assert got[1] == got[4] == "en" and got[2] == "de" and got[3] in ("de", "en")
    empty = language.train(train.where("false"))
    assert {r.lang_pred for r in language.predict(texts, empty).collect()} == {"und"}
    assert language.predict(texts.where("false"), model).isEmpty()


# --- toxicity ----------------------------------------------------------------------------


def random_index(seed, n=300, v=40):
    rng = np.random.default_rng(seed)
    counts = (rng.random((n, v)) < 0.06) * rng.integers(1, 4, (n, v)).astype(np.float32)
    counts[counts.sum(axis=1) == 0, 0] = 1
    counts = counts.astype(np.float32)
    terms = rng.integers(0, 2**63, v).astype(np.uint64)
    held = [(np.flatnonzero(c), c[c > 0]) for c in counts]
    return toxicity.build_index(terms, 0.5 + rng.random(v), np.arange(n).astype(object), rng.integers(0, 2, n), held, 0.1)


@pytest.mark.parametrize("seed", range(4))
def test_neighbours_are_the_exact_ones(seed):
    index = random_index(seed)
    vectors = np.concatenate([index.dense(b) for b in range(len(index.blocks))])
    best, where = index.neighbours(vectors, 7)
    cosines = np.round((vectors @ vectors.T).astype(np.float64), 5)
    for i in range(len(cosines)):
        order = sorted(range(len(cosines)), key=lambda j: (-cosines[i, j], j))[:7]
        kept = [j for j in order if cosines[i, j] > 0]
        assert np.allclose(best[i][: len(kept)], cosines[i, kept], atol=2e-5)
        sure = [k for k, j in enumerate(kept) if cosines[i, j] > cosines[i, kept[-1]] + 1e-4]
        assert Counter(where[i][sure].tolist()) == Counter(kept[k] for k in sure)


def labelled(n, seed):
    rng = random.Random(seed)
    for i in range(n):
        toxic = i % 5 == 0
        words = [f"word{rng.randrange(400)}" for _ in range(60)]
        for _ in range(3 * toxic):
            words.insert(rng.randrange(60), rng.choice(["idiot", "trash", "loser"]) + rng.choice(["", "s"]))
        yield i, " ".join(words), int(toxic)


def test_toxic_documents_are_found(spark):
    rows = list(labelled(600, 1))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows[:400]], "doc_id bigint, toxic int")
    index = toxicity.train(labels, docs)
    out = {r.doc_id: r for r in toxicity.score(docs, index).collect()}
    late = rows[400:]
    assert all((out[i].score >= 0.3) == bool(t) for i, _, t in late)
    assert all(0 <= r.score <= 1 for r in out.values())
    evidence = out[next(i for i, _, t in late if t)].evidence
    assert len(evidence) == 3 and {e.label for e in evidence} == {1}
    kept = {r.doc_id for r in toxicity.drop_toxic(docs, index).collect()}
    assert kept == {i for i, r in out.items() if r.score < 0.3}


def test_every_term_that_tells_the_labels_apart_is_kept(spark):
    """1,500 toxic words with rare and common forms; each is the only one of its document."""
    def word(k):
        return "".join("bcdfghjklm"[int(d)] for d in f"{k:04d}")

    rows = []
    for i in range(400):
        bad = [f"{word(k)}" for k in range(i % 50 * 30, i % 50 * 30 + 30)] if i < 300 else []
        rows.append((i, " ".join([*bad, "nothing", "else", f"n{'aeiou'[i % 5]}"]), int(i < 300)))
    asked = [(1000 + k, f"nothing else {word(k)}") for k in range(1500)]
    docs = spark.createDataFrame([r[:2] for r in rows] + asked, "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] , "doc_id bigint, toxic int")
    monkey_chi = toxicity.MIN_CHI_SQUARE
    toxicity.MIN_CHI_SQUARE = 1.0
    try:
        index = toxicity.train(labels, docs)
    finally:
        toxicity.MIN_CHI_SQUARE = monkey_chi
    assert len(index.terms) >= 1500
    out = toxicity.score(docs.where("doc_id >= 1000"), index)
    assert out.where("score >= 0.3 AND size(evidence) = 3").count() == 1500
    # Document frequencies are those of all documents.
    word_hash = next(iter(toxicity._terms(toxicity.Letters([word(7)]))))[0][0]
    place = int(np.flatnonzero(index.terms == word_hash)[0])
    assert np.isclose(index.idf[place], np.log1p(1900 / 7))


def test_toxicity_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    out = queries.op5_toxicity(spark, MEDIUM).join(labels, "doc_id").where("held_out")
    hits = Counter((r.toxic, r.predicted) for r in out.collect())
    assert hits[0, 1] <= 0.1 * (hits[0, 0] + hits[0, 1]) and hits[1, 1] >= 0.6 * (hits[1, 0] + hits[1, 1])


def test_the_query_against_cosines_with_all_examples(spark):
    """Every document against every example over dense vectors, with the calibration left out and put in."""
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    index = queries.toxicity_index(spark, docs, MEDIUM)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    place = {i: k for k, i in enumerate(index.ids)}

    def dense(texts):
        return index.vectors(toxicity.term_counts(texts, Lookup(index.terms), len(index.terms)))

    text_of = dict(rows)
    examples = dense([text_of[i] for i in index.ids])
    cosines = np.round(dense([t for _, t in rows]) @ examples.T, 5)

    def votes(cosine):
        near = sorted(range(len(cosine)), key=lambda j: (-cosine[j], j))[: toxicity.NEIGHBOURS]
        near = [j for j in near if cosine[j] > 0]
        return np.average(index.labels[near], weights=cosine[near]) if near else -1.0

    without = [np.where(np.arange(len(index.ids)) == place[i], 0, c) for (i, _), c in zip(rows, cosines) if i in place]
    label = [index.labels[place[i]] for i, _ in rows if i in place]
    bins = [(min(int(v * 10), 9), t) for v, t in zip(map(votes, without), label) if v >= 0]
    rate = [(sum(t for b, t in bins if b == k) + (k + 0.5) / 5) / (sum(b == k for b, _ in bins) + 2) for k in range(10)]
    calibration = np.maximum.accumulate(rate)
    assert np.allclose(index.calibration, calibration)
    got = {r.doc_id: r.score for r in queries.op5_toxicity(spark, MEDIUM).collect()}
    for (i, _), cosine in zip(rows, cosines):
        v = votes(cosine)
        wanted = index.prior if v < 0 else np.interp(v, (np.arange(10) + 0.5) / 10, calibration)
        assert abs(got[i] - wanted) < 1e-3


@pytest.mark.parametrize("room", [0, 1 << 30])
def test_neighbours_without_a_matrix_and_with_all_terms_in_it(room, monkeypatch):
    monkeypatch.setattr(toxicity, "_MATRIX_BYTES", room)
    monkeypatch.setattr(toxicity, "_COMMON_SHARE", 10**9)
    index = random_index(11, n=150)
    assert len(index.common) == (len(index.terms) if room else 0)
    vectors = np.concatenate([index.dense(b) for b in index.blocks])
    best, where = index.neighbours(vectors, 9, np.arange(150))
    cosines = np.round(vectors @ vectors.T, 5)
    np.fill_diagonal(cosines, 0)
    for i in range(150):
        order = sorted(range(150), key=lambda j: (-cosines[i, j], j))[:9]
        assert np.allclose(best[i], cosines[i, order], atol=2e-5) and i not in where[i]


def test_toxicity_of_awkward_documents(spark):
    docs = awkward.documents(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (5, 0), (99, 1), (None, 1), (6, None)], "doc_id bigint, toxic int")
    for index in (toxicity.train(labels, docs), toxicity.train(labels.where("false"), docs)):
        out = toxicity.score(docs, index)
        assert out.count() == len(awkward.ROWS) and out.where("score IS NULL").isEmpty()
        kept = toxicity.drop_toxic(docs, index, threshold=2.0)
        assert kept.columns == docs.columns
        assert Counter(map(tuple, kept.collect())) == Counter(map(tuple, docs.collect()))
        assert toxicity.score(docs.where("false"), index).isEmpty()


def test_lookup():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 2**63, 500).astype(np.uint64))
    rng.shuffle(keys)
    asked = np.r_[keys, rng.integers(0, 2**63, 500).astype(np.uint64)]
    places = {int(k): i for i, k in enumerate(keys)}
    assert Lookup(keys)(asked).tolist() == [places.get(int(a), -1) for a in asked]
    assert Lookup(keys[:0])(asked).tolist() == [-1] * len(asked)


# --- decontamination ---------------------------------------------------------------------


def smith_waterman(a, b):
    best, above = 0, [0] * (len(b) + 1)
    for x in a:
        here = [0]
        for j, y in enumerate(b):
            here.append(max(0, above[j] + (2 if x == y else -1), above[j + 1] - 1, here[j] - 1))
        best, above = max(best, *here), here
    return best


def test_alignment_scores():
    rng = random.Random(5)
    for _ in range(60):
        a = [rng.randrange(4) for _ in range(rng.randrange(1, 12))]
        passages = [[rng.randrange(4) for _ in range(15)] for _ in range(3)]
        got = decontaminate.align(np.array(a), np.array(passages))
        assert got.tolist() == [smith_waterman(a, p) for p in passages]


ITEM = "Which of the two rivers that cross the old town carries more water in spring, and why does it flood the lower market so rarely in autumn?"


def edited(rng, n):
    words = ITEM.split()
    for _ in range(n):
        k = rng.randrange(len(words))
        words[k : k + 1] = rng.choice([[], ["another"], [words[k], "inserted"]])
    return " ".join(words)


def test_exact_and_edited_copies_are_found_and_others_are_not(spark):
    rng = random.Random(2)
    clean = [(i, " ".join(rng.choice(ITEM.split() + [f"w{k}" for k in range(60)]) for _ in range(200))) for i in range(100)]
    filler = clean[0][1]
    held = [(1000 + i, f"{filler} {edited(rng, i % 5)} {filler}") for i in range(50)]
    held += [(2000, ITEM.upper()), (2001, "%%% ".join(ITEM.split())), (2002, "tiny item here")]
    docs = spark.createDataFrame(clean + held, "doc_id bigint, text string")
    items = spark.createDataFrame(
        [(1, ITEM), (2, "tiny item here"), (3, None), (4, ""), (5, "..."), (6, ITEM)], "item_id bigint, text string"
    )
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.leaks(docs, items).collect()}
    assert set(got) == {(i, k) for i, _ in held if i != 2002 for k in (1, 6)} | {(2002, 2)}
    assert got[2000, 1] == got[2001, 1] == got[2002, 2] == 1.0
    kept = decontaminate.without_leaks(docs, items)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in clean)


def test_edited_copies_are_found_without_any_exact_copy(spark):
    rng = random.Random(4)
    words = [f"{'abcdefghij'[k // 10]}{'klmnopqrst'[k % 10]}x" for k in range(38)]
    held = []
    for i in range(120):
        if i % 6 < 4:
            lost = set(range(i % 3, 38, 4 + i % 6))
        else:
            lost = set(rng.sample(range(38), 9))
        filler = [f"f{'abcdefgh'[rng.randrange(8)]}{'abcdefgh'[rng.randrange(8)]}" for _ in range(90)]
        held.append((i, " ".join(filler[:45] + ["other" if k in lost else w for k, w in enumerate(words)] + filler[45:])))
    docs = spark.createDataFrame(held, "doc_id bigint, text string")
    items = spark.createDataFrame([(1, " ".join(words))], "item_id bigint, text string")
    wanted = {}
    for i, text in held:
        score = smith_waterman(words, text.split()) / 76
        if score >= 0.5:
            wanted[i] = score
    assert len(wanted) == 120
    for only in (range(120), range(1)):  # with other edited copies, and one alone
        got = {r.doc_id: r.score for r in decontaminate.leaks(docs.where(F.col("doc_id").isin(list(only))), items).collect()}
        assert got == {i: wanted[i] for i in only}
    kept = decontaminate.without_leaks(docs, items)
    assert kept.isEmpty()


def test_blocks_of_items_give_the_same(spark, documents, monkeypatch):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    whole = sorted(map(tuple, decontaminate.leaks(documents, items).collect()))
    assert len(whole) == 3
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 3_000)
    assert sorted(map(tuple, decontaminate.leaks(documents, items).collect())) == whole
    assert decontaminate.without_leaks(documents, items).count() == documents.count() - 3


def test_decontamination_against_alignment_of_everything(spark, documents):
    """Every document against every item, without seeds."""
    from tidemark.llm.letters import Letters

    def tokens(text):
        found = Letters([text])
        return ["".join(map(chr, found.codes[s:e])) for s, e in zip(found.starts, found.ends)]

    items = {r.item_id: tokens(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    number: dict = {}
    wanted = set()
    for r in documents.collect():
        doc = np.array([[number.setdefault(w, len(number)) for w in tokens(r.text)]])
        for item, w in items.items():
            score = decontaminate.align(np.array([number.setdefault(x, len(number)) for x in w]), doc)[0]
            if score >= 0.5 * 2 * len(w):
                wanted.add((r.doc_id, item))
    assert {(r.doc_id, r.item_id) for r in queries.op4_decontamination(spark, SMALL).collect()} == wanted


def test_decontamination_of_awkward_documents(spark):
    docs = awkward.documents(spark)
    items = spark.createDataFrame([(1, awkward.PASSAGE)], "item_id bigint, text string")
    found = Counter(r.doc_id for r in decontaminate.leaks(docs, items).collect())
    assert found == Counter({6: 1, 7: 1, 9: 1, 11: 1, 12: 1, None: 1, 13: 1})
    kept = decontaminate.without_leaks(docs, items)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, t in awkward.ROWS if awkward.PASSAGE not in (t or ""))
    assert decontaminate.leaks(docs.where("false"), items).isEmpty()
    assert decontaminate.leaks(docs, items.where("false")).isEmpty()
    assert decontaminate.without_leaks(docs, items.where("false")).count() == len(awkward.ROWS)


HAN = "\u8fd9\u6761\u6cb3\u5728\u6625\u5929\u4e3a\u4ec0\u4e48\u6bd4\u53e6\u4e00\u6761\u6cb3\u6709\u66f4\u591a\u7684\u6c34\u5462\u5417"


def test_items_of_numbers_symbols_and_scripts_without_spaces(spark):
    items = [(1, "What is 37 * 48?"), (2, "12 + 34 * 5 = 182"), (3, HAN), (4, "..."), (5, "f(x) = x^2"), (6, "7")]
    texts = {
        1: "I asked what is going on here.",
        2: "so 12 + 34 * 5 = 182, they said",
        3: f"\u6211\u4eec\u95ee\u8fc7{HAN}\u6ca1\u6709\u4eba\u77e5\u9053",
        4: "He asked: what is 37 * 48? Nobody knew ...",
        5: "112 + 34 * 5 = 182 and 12 + 34 * 5 = 1827",
        6: "what is 37 + 48",
        7: "take F(X) = X^2 as given; f(x) = x^3 is another",
        8: HAN[:9] + "\u5c71" + HAN[10:],
        9: HAN[:5] + "\u5c71\u5c71\u5c71\u5c71" + HAN[11:14],
        10: "12 + 34 * 5",
        11: "177 or 7",
        12: None,
        13: "",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    rows = spark.createDataFrame(items, "item_id int, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.leaks(docs, rows).collect()}
    assert set(got) == {(2, 2), (3, 3), (4, 1), (7, 5), (8, 3), (11, 6)}
    assert got[3, 3] == got[2, 2] == 1.0 and got[8, 3] == pytest.approx((2 * len(HAN) - 3) / (2 * len(HAN)))
    kept = {r.doc_id for r in decontaminate.without_leaks(docs, rows).collect()}
    assert kept == {1, 5, 6, 9, 10, 12, 13}


def test_short_items_against_search_of_everything(spark, monkeypatch):
    rng = random.Random(11)
    signs = ["a", "b", "1", "22", "+", "-", "=", "(", ")", "\u4e2d"]
    items = {i: [rng.choice(signs) for _ in range(rng.randrange(1, 7))] for i in range(60)}
    docs = {i: [rng.choice(signs) for _ in range(rng.randrange(0, 60))] for i in range(80)}
    wanted = {
        (d, i)
        for i, x in items.items()
        for d, t in docs.items()
        if not set(x) <= set("+-=()") and any(t[k : k + len(x)] == x for k in range(len(t) - len(x) + 1))
    }
    frames = [
        spark.createDataFrame([(k, " ".join(v)) for k, v in rows.items()], f"{name} int, text string")
        for rows, name in ((docs, "doc_id"), (items, "item_id"))
    ]
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(*frames).collect()} == wanted
    short = decontaminate._Items.of(list(items), [" ".join(v) for v in items.values()])
    monkeypatch.setattr(decontaminate, "_BATCH_CELLS", 50)
    found = zip(*(x.tolist() for x in short.exact.held([" ".join(v) for v in docs.values()])))
    assert set(found) == wanted and len(wanted) > 100


def test_item_ids_of_any_type(spark):
    docs = awkward.documents(spark)
    for ids, kind in ((["a/1", None], "string"), ([7, None], "int"), ([1.5, None], "double")):
        items = spark.createDataFrame([(i, awkward.PASSAGE) for i in ids], f"item_id {kind}, text string")
        found = decontaminate.leaks(docs.where("doc_id = 13"), items).collect()
        assert Counter(r.item_id for r in found) == Counter(ids) and {r.score for r in found} == {1.0}
        assert decontaminate.without_leaks(docs.where("doc_id = 13"), items).isEmpty()
