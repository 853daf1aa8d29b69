"""Repeated passages of words and of bytes, against brute force."""

import hashlib
import re
from collections import Counter

import awkward
import numpy as np
import oracle
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F
from tidemark.llm import phrases, queries, suffixes
from tidemark.llm.windows import anchored_windows, gram_hashes

SMALL = "/root/testdata/sf0.001"


def words_expected(rows):
    units = lambda t: tuple(awkward.words(t))
    for (id_, text), gone in zip(rows, awkward.removed(rows, units, 50)):
        w = units(text)
        yield id_, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)


def bytes_expected(rows):
    units = lambda t: (t or "").encode()
    for (id_, text), gone in zip(rows, awkward.removed(rows, units, 50)):
        raw = units(text)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        yield id_, len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept


@pytest.mark.parametrize("operator, expected", [(phrases, words_expected), (suffixes, bytes_expected)])
def test_awkward_documents(spark, operator, expected):
    out = operator.remove_repeats(awkward.documents(spark))
    got = Counter(tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in out.collect())
    assert got == Counter(expected(awkward.ROWS))


def thue_morse(n, a, b):
    return [b if k.bit_count() % 2 else a for k in range(n)]


def test_words_and_spans_whose_sums_of_powers_agree(spark):
    """Words of 2,048 letters, and spans of 2,048 words, beside their complements."""
    rows = []
    for k in range(4):
        plain = [f"w{k}x{i}" for i in range(80)]
        for twin in range(2):
            letters = "".join(thue_morse(2048, *("ab" if twin else "ba")))
            rows.append((len(rows), " ".join([*plain[:40], letters, *plain[40:]])))
    first = [f"p{i}" for i in range(60)]
    for twin in range(2):
        rows.append((len(rows), " ".join([*first, *thue_morse(2048, *("ab" if twin else "ba")), *first])))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = Counter(map(tuple, phrases.remove_repeats(df).collect()))
    assert got == Counter(words_expected(rows))


@pytest.mark.parametrize("operator", [phrases, suffixes])
def test_nothing_stays_persisted(spark, operator):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    operator.remove_repeats(awkward.documents(spark)).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


@pytest.mark.parametrize("operator", [phrases, suffixes])
def test_no_rows(spark, operator):
    none = awkward.documents(spark).where("false")
    assert operator.remove_repeats(none).isEmpty()


def test_queries_on_the_whole_table(spark, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    by_word = {r[0]: (r[1], r[2], sha(r[3].encode())) for r in words_expected(rows)}
    by_byte = {r[0]: (r[1], r[2], r[3], sha(r[4])) for r in bytes_expected(rows)}
    assert {r[0]: tuple(r)[1:] for r in queries.op6_phrases(spark, SMALL).collect()} == by_word
    assert {r[0]: tuple(r)[1:] for r in queries.op7_suffixes(spark, SMALL).collect()} == by_byte


@pytest.mark.parametrize("name", ["op6_phrases", "op7_suffixes"])
def test_queries_against_sql(spark, name):
    con = oracle.connect(SMALL)
    assert oracle.differences(queries.QUERIES[name](spark, SMALL), con, queries.ORACLE_SQL[name]) == []


def test_one_passage_in_most_documents(spark):
    """A hot passage, with different neighbours each time."""
    rows = [(i, f"{i} x{i} {awkward.PASSAGE} y{i} {i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, phrases.remove_repeats(docs).collect())) == sorted(words_expected(rows))
    got = [(*r[:4], bytes(r.kept)) for r in suffixes.remove_repeats(docs).collect()]
    assert sorted(got) == sorted(bytes_expected(rows))


@settings(max_examples=60, deadline=None)
@given(st.text("ab", max_size=120).map(str.encode), st.integers(3, 9))
def test_every_window_has_one_anchor(raw, size):
    symbols, window = np.frombuffer(raw, np.uint8), 12
    grams = gram_hashes(symbols, size)
    starts, at = anchored_windows(grams, np.array([0, len(symbols)]), window, size)
    assert starts.tolist() == list(range(max(0, len(raw) - window + 1)))
    for s, a in zip(starts, at):
        inside = grams[s : s + window - size + 1]
        assert a == s + int(inside.argmin())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab\0ÿ", min_size=11, max_size=11).map(lambda t: t.encode("latin-1")), min_size=1, max_size=40))
def test_multikey_sort(strings):
    data = np.frombuffer(b"".join(strings), np.uint8)
    order, begins = suffixes.multikey_groups(data, np.arange(len(strings)) * 11, 11)
    in_order = [strings[k] for k in order]
    assert in_order == sorted(strings)
    assert [k for k in range(len(in_order)) if k == 0 or in_order[k] != in_order[k - 1]] == begins.tolist()


def test_borders_of_ranges_are_compared(spark):
    """More ranges than anchors: every anchor stands at a border."""
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        rows = [(i, f"{awkward.PASSAGE[:80]} {i}") for i in range(200)]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        got = [(*r[:4], bytes(r.kept)) for r in suffixes.remove_repeats(docs).collect()]
        assert sorted(got) == sorted(bytes_expected(rows))
        assert suffixes.remove_repeats(docs).agg(F.sum("n_removed")).first()[0] > 199 * 80
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def packed_spans(rows, splitters):
    """The packed spans of all anchors of the rows."""
    from zstandard import ZstdCompressor

    anchors = []
    for _, text in rows:
        grams = gram_hashes(np.frombuffer(text.encode(), np.uint8), suffixes.GRAM)
        anchors.append(suffixes._anchor_hashes(grams).view(np.int64).tolist())
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array([i for i, _ in rows]),
            pa.array([0] * len(rows)),
            pa.array([ZstdCompressor().compress(t.encode()) for _, t in rows]),
            pa.array(anchors, pa.list_(pa.int64())),
        ],
        names=["id", "key", "text", "anchors"],
    )
    return list(suffixes._spans(splitters)([batch]))


def test_equal_spans_are_sorted_once(monkeypatch):
    rows = [(i, f"{awkward.PASSAGE[:120]}{i:04d}{i}") for i in range(100)]
    spans = packed_spans(rows, np.zeros(0, f"S{suffixes._LEAD}"))
    sort, sorted_ = suffixes.multikey_groups, []

    def counted(data, starts, length):
        if length == suffixes.LENGTH:
            sorted_.append(len(starts))
        return sort(data, starts, length)

    monkeypatch.setattr(suffixes, "multikey_groups", counted)
    found = pa.Table.from_batches(list(suffixes._sort_range(spans))).to_pylist()
    closed = [r for r in found if r["anchor"] is None]
    lost = {i: set() for i in range(100)}
    for r in closed:
        lost[r["id"]] |= set(range(r["first"], r["first"] + r["n"]))
    assert all(lost[i] >= set(range(120 - 50 + 1)) for i in range(1, 100)) and not lost[0]
    # 100 texts of more than 70 suffixes each; but for their ends they are one text
    assert sum(sorted_) < 100 * 75 / 2


@pytest.mark.parametrize("hashes", [suffixes.span_hashes, lambda data, a, b: np.zeros(len(a), np.uint64)])
def test_spans_of_a_class_are_equal(monkeypatch, hashes):
    monkeypatch.setattr(suffixes, "span_hashes", hashes)
    words = [b"abc", b"abd", b"abc", b"abcd", b"abc", b"abd"]
    place, size = np.cumsum([0, *map(len, words)])[:-1], np.array([len(w) for w in words])
    data = np.frombuffer(b"".join(words), np.uint8)
    anchor, offset, ids = np.zeros(6, int), np.array([0, 0, 0, 0, 1, 0]), np.array([5, 4, 3, 2, 1, 9])
    kind, example = suffixes._alike(data, place, size, anchor, offset, ids)
    for i in range(6):
        assert (words[i], offset[i]) == (words[example[kind[i]]], offset[example[kind[i]]])
        assert ids[example[kind[i]]] <= ids[i]
    if hashes is not None and hashes(data, place, place + size).any():
        assert kind[0] == kind[2] and kind[1] == kind[5] and len(example) == 4


def test_ranges_hold_about_the_same(spark):
    rng = np.random.default_rng(3)
    rows = [(i, bytes(rng.integers(97, 100, 400, np.uint8)).decode()) for i in range(80)]
    known = spark.createDataFrame(rows, "id bigint, text string").selectExpr("id", "CAST(text AS binary) AS text")
    splitters = suffixes._splitters(known, 80 * 400, 8)
    assert len(splitters) == 7 and (splitters[1:] >= splitters[:-1]).all()
    counts = np.zeros(8, int)
    for batch in packed_spans(rows, splitters):
        for r in batch.to_pylist():
            counts[r["range"]] += len(suffixes.unpacked(pa.array([r["lengths"]]))[0].as_py())
    assert counts.min() > counts.sum() / 16 and counts.max() < counts.sum() / 4
    assert len(suffixes._splitters(known.where("false"), 0, 8)) == 0


@pytest.mark.parametrize("partitions", ["1", "16"])
def test_passages_with_changes(spark, partitions):
    """Many classes of spans for one anchor, ids that repeat, several ranges."""
    rng = np.random.default_rng(7)
    base = awkward.PASSAGE[:260]
    rows = []
    for i in range(150):
        text = list(base)
        for at in rng.integers(0, len(text), rng.integers(0, 3)):
            text[at] = "~^ü"[rng.integers(3)]
        cut = int(rng.integers(0, 120))
        rows.append((int(rng.integers(-40, 80)), "".join(text[cut:]) + " | " + "".join(text[: int(rng.integers(0, 90))])))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        got = [(*r[:4], bytes(r.kept)) for r in suffixes.remove_repeats(docs).collect()]
        assert sorted(got) == sorted(bytes_expected(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
