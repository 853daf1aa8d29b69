"""Fingerprints and components, against brute force."""

import re

import awkward
import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import queries, simhash
from tidemark.llm.components import connected_components

SMALL = "/root/testdata/sf0.001"


def fingerprint(text):
    lowered = re.sub(r"[A-Z]", lambda m: m.group().lower(), text or "")
    w = awkward.words(lowered)
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows):
    fps = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    for i, (id_, _) in enumerate(rows):
        held = [r[0] for j, r in enumerate(rows) if find(j) == find(i) and r[0] is not None]
        yield id_, f"{fps[i]:016x}", min(held, default=None)


def test_whole_table(spark, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op9_simhash(spark, SMALL).collect())) == sorted(components(rows))


def test_awkward_documents(spark):
    out = simhash.components(awkward.documents(spark))
    got = [(r.doc_id, f"{r.fp % 2**64:016x}", r.component_id) for r in out.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, components(awkward.ROWS)))
    assert simhash.components(awkward.documents(spark).where("false")).isEmpty()


def test_one_document_of_each_group_stays(spark):
    docs = awkward.documents(spark)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    wanted = {(i, c) for i, _, c in components(awkward.ROWS)}
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    gone = {i for i, c in wanted if i is not None and i != c}
    assert ids == sorted(i for i, _ in awkward.ROWS if i is not None and i not in gone)
    assert simhash.keep_first(docs.where("false")).isEmpty()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 40).map(lambda k: (1 << k) - 1), min_size=1, max_size=60, unique=True), st.integers(0, 60))
def test_tiles_connect_what_is_linked(values, cut):
    fps = np.array(values, np.uint64)
    a, b = fps[:cut], fps[cut:]
    edges = [simhash.tile_links(t, t, True, 3) for t in (a, b) if len(t)]
    if len(a) and len(b):
        edges.append(simhash.tile_links(a, b, False, 3))
    label = {int(v): int(v) for v in fps}

    def find(v):
        while label[v] != v:
            v = label[v]
        return v

    for x, y in edges:
        for v, w in zip(x.tolist(), y.tolist()):
            label[find(v)] = find(w)
    theirs = dict(label)
    label = {int(v): int(v) for v in fps}
    for v in label:
        for w in label:
            if (v ^ w).bit_count() <= 3:
                label[find(v)] = find(w)
    ours, label = dict(label), theirs
    same = {(v, w): find(v) == find(w) for v in theirs for w in theirs}
    label = ours
    assert same == {(v, w): find(v) == find(w) for v in ours for w in ours}


def test_many_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE_ROWS", 8)
    monkeypatch.setattr(simhash, "MAX_TILE_ROWS", 8)
    rows = [(i, f"text number {i} " + " ".join(f"w{j}" for j in range(60) if j != i)) for i in range(60)]
    out = simhash.components(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = [(r.doc_id, f"{r.fp % 2**64:016x}", r.component_id) for r in out.collect()]
    assert sorted(got) == sorted(components(rows))


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(8, 60)] + [(9, 9), (None, 3)]
    edges = spark.createDataFrame(chain + star, "x bigint, y bigint")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in range(7, 60)}}
    assert connected_components(edges.where("false")).isEmpty()
