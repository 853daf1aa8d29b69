"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters, runs of digits and, in scripts without spaces, single characters, all
lower-cased, so punctuation and markup between them do not hide a copy. Every pair of neighbouring
words of a test item is a seed, however common it is. Words that match score ``MATCH``, mismatches
and gaps cost. The score, as a share of the item's score with itself, tells exact and edited copies
from chance.

Seeds lose nothing by replaced or deleted words: a passage with that share of the score has two
neighbouring words intact. (With n words, e of them lost and i inserted, 2 (n - e) - e - i >= n,
and n - e words in at most e + i + 1 runs; only a word inserted in every gap breaks all pairs.)
What surrounds a seed is aligned if the score could reach the threshold: m matching words with p
pairs of neighbours stand in m - p runs with a cost between any two, so the score is at most
m + p + 1. Items' words and seeds found around the place bound m and p.

Items of fewer than ``MIN_ITEM_WORDS`` words (a single character counts as half a word) have too
few words to tell an edited copy from chance. They count only where their whole sequence of words
and symbols stands, less marks at the end of their sentence: the seed is the sequence's beginning.

The items are sent to the tasks in blocks of bounded size; each block is one pass over the
documents. No document is moved.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.arrays import column, mixed, ragged, span_hashes, text_chunks
from tidemark.llm.letters import Lookup, Tokens

GRAM_WORDS = 2
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
MIN_ITEM_WORDS = 8  # shorter items must match whole
EXACT_SEED = 4  # tokens of a shorter item that are looked up
_END_MARKS = " \t\r\n.?!,:;\u2026\u3002\uff1f\uff01"
BLOCK_CHARS = 4 << 20
_BATCH_CELLS = 1 << 21
_BATCH_HITS = 1 << 20


def _words(texts: list[str | None], symbols: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts and the first word of every text, with the end last."""
    found = Tokens(texts, symbols)
    hashes = span_hashes(found.codes, found.starts, found.ends)
    return hashes, np.searchsorted(found.text, np.arange(len(texts) + 1))


def _is_long(texts: list[str]) -> np.ndarray:
    """Whether a text has words enough to be aligned."""
    found = Tokens(texts)
    return np.bincount(found.text, weights=found.weights, minlength=len(texts)) >= MIN_ITEM_WORDS


def _grams(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of all n-grams that lie within one text."""
    lengths = np.maximum(np.diff(bounds) - size + 1, 0)
    places = ragged(bounds[:-1], lengths)
    value = np.full(len(places), np.uint64(size))
    for k in range(size):
        value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + hashes[places + k])
    return value, places


@dataclass
class _Exact:
    """The items of one block that must be held whole, by the hash of their first tokens."""

    item: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray
    grams: dict[int, tuple[np.ndarray, np.ndarray]]  # by size: sorted hashes, places in ``item``

    @classmethod
    def of(cls, texts: list[str], item: np.ndarray) -> _Exact:
        hashes, bounds = _words([texts[i].rstrip(_END_MARKS) for i in item], symbols=True)
        lengths = np.diff(bounds)
        grams = {}
        for size in sorted({min(int(n), EXACT_SEED) for n in lengths if n}):
            value, at = _grams(hashes, bounds, size)
            owner = np.searchsorted(bounds, at, side="right") - 1
            mine = (at == bounds[owner]) & (np.minimum(lengths[owner], EXACT_SEED) == size)
            order = np.argsort(value[mine], kind="stable")
            grams[size] = value[mine][order], owner[mine][order]
        return cls(item, hashes, bounds, grams)

    def held(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Texts and items of all pairs where the text holds the item."""
        pairs = [np.zeros((0, 2), np.int64)]
        if not self.grams:
            return pairs[0][:, 0], pairs[0][:, 1]
        hashes, bounds = _words(texts, symbols=True)
        lengths = np.diff(self.bounds)
        for size, (grams, owner) in self.grams.items():
            value, at = _grams(hashes, bounds, size)
            known, first = np.unique(grams, return_index=True)
            last = np.r_[first[1:], len(grams)]
            gram = Lookup(known)(value)
            gram, at = gram[gram >= 0], at[gram >= 0]
            doc = np.searchsorted(bounds, at, side="right") - 1
            cost = np.cumsum((last - first)[gram] * (int(lengths[owner].max()) + 1))
            k = 0
            while k < len(gram):  # a bounded number of comparisons at a time
                limit = _BATCH_CELLS + (cost[k - 1] if k else 0)
                end = max(k + 1, int(np.searchsorted(cost, limit, side="right")))
                times = (last - first)[gram[k:end]]
                mine = owner[ragged(first[gram[k:end]], times)]
                where, text = np.repeat(at[k:end], times), np.repeat(doc[k:end], times)
                fits = where + lengths[mine] <= bounds[text + 1]
                mine, where, text = mine[fits], where[fits], text[fits]
                if len(mine):
                    same = hashes[ragged(where, lengths[mine])] == self.hashes[ragged(self.bounds[mine], lengths[mine])]
                    whole = np.logical_and.reduceat(same, np.cumsum(lengths[mine]) - lengths[mine])
                    pairs.append(np.unique(np.stack([text[whole], self.item[mine[whole]]], axis=1), axis=0))
                k = end
        found = np.unique(np.concatenate(pairs), axis=0)
        return found[:, 0], found[:, 1]


@dataclass
class _Items:
    """One block of test items."""

    ids: list
    hashes: np.ndarray
    bounds: np.ndarray
    grams: np.ndarray  # of every place in an item that is aligned where one begins
    gram_item: np.ndarray
    gram_place: np.ndarray  # within the item
    exact: _Exact

    @classmethod
    def of(cls, ids: list, texts: list[str]) -> _Items:
        hashes, bounds = _words(texts)
        aligned = _is_long(texts)
        worded = np.diff(bounds) > 0  # symbols alone are no item
        value, at = _grams(hashes, bounds, GRAM_WORDS)
        owner = np.searchsorted(bounds, at, side="right") - 1
        mine = aligned[owner]
        exact = _Exact.of(texts, np.flatnonzero(worded & ~aligned))
        return cls(ids, hashes, bounds, value[mine], owner[mine], (at - bounds[owner])[mine], exact)


def _copies(items: _Items, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk its rows, and texts, items and scores of the pairs that count as copies."""
    order = np.argsort(items.grams, kind="stable")
    grams, item, place = items.grams[order], items.gram_item[order], items.gram_place[order]
    known, first = np.unique(grams, return_index=True)
    last = np.r_[first[1:], len(grams)]
    lookup = Lookup(known)
    vocabulary, own = np.unique(items.hashes, return_inverse=True)
    known_word = Lookup(vocabulary)
    lengths = np.diff(items.bounds)
    for row, end, _, _ in text_chunks(texts):
        chunk = texts.slice(row, end - row).to_pylist()
        text, found = items.exact.held(chunk)
        out = [(text, found, np.ones(len(text)))]
        hashes, bounds = _words(chunk)
        value, at = _grams(hashes, bounds, GRAM_WORDS)
        gram = lookup(value)
        gram, at = gram[gram >= 0], at[gram >= 0]
        words = known_word(hashes)
        # Common seeds of many items are paired with a part of the items at a time.
        parts = int((last[gram] - first[gram]).sum()) // _BATCH_HITS + 1
        for part in range(parts if len(gram) else 0):
            mine = item % parts == part
            before = np.r_[0, np.cumsum(mine)]
            times = before[last[gram]] - before[first[gram]]
            pair = np.flatnonzero(mine)[ragged(before[first[gram]], times)]
            where = np.repeat(at, times)
            near = _promising(items, lengths, own, words, bounds, item[pair], place[pair], where)
            text, found, scores = _best_scores(items, lengths, hashes, bounds, item[pair[near]], place[pair[near]], where[near])
            good = scores >= THRESHOLD
            out.append((text[good], found[good], scores[good]))
        yield row, end, *(np.concatenate(x) for x in zip(*out))


def _promising(items, lengths, own, words, bounds, item, place, where):
    """The hits around which an alignment could reach the threshold."""
    if not len(where):
        return np.zeros(0, np.int64)
    doc = np.searchsorted(bounds, where, side="right") - 1
    order = np.lexsort((where, doc, item))
    item, where, doc, begin = item[order], where[order], doc[order], (where - place)[order]
    n = lengths[item]
    # At most n inserted words keep the score, so a copy lies within n words of its hit's place.
    low, high = np.maximum(begin - n, bounds[doc]), np.minimum(begin + 2 * n, bounds[doc + 1])
    key = item * (len(words) + 1) + where
    pairs = np.searchsorted(key, item * (len(words) + 1) + high) - np.searchsorted(key, item * (len(words) + 1) + low)
    held = np.zeros(len(item), np.int64)
    local = np.full(len(own) + 1, -1)  # places of words in the item at hand, by vocabulary
    firsts = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
    for first, last in zip(firsts, np.r_[firsts[1:], len(item)]):
        i = item[first]
        mine, count = np.unique(own[items.bounds[i] : items.bounds[i + 1]], return_counts=True)
        local[mine] = np.arange(len(mine))
        step = max(1, _BATCH_CELLS // (3 * int(n[first])))
        for k in range(first, last, step):
            rows = slice(k, min(k + step, last))
            places = low[rows][:, None] + np.arange(3 * int(n[first]))
            inside = places < high[rows][:, None]
            word = local[words[np.minimum(places, len(words) - 1)]]  # -1 takes the last, unused place
            seen = np.zeros((len(places), len(mine) + 1), bool)
            np.put_along_axis(seen, np.where(inside, word, -1) % (len(mine) + 1), True, axis=1)
            held[rows] = seen[:, :-1] @ count
        local[mine] = -1
    return order[held + pairs + 1 >= THRESHOLD * MATCH * n]


def _pairs(items: _Items, id_col: str, text_col: str, item_kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, text, found, scores in _copies(items, column(batch, text_col)):
                yield pa.RecordBatch.from_arrays(
                    [
                        column(batch, id_col).take(pa.array(row + text)),
                        pa.array([items.ids[i] for i in found.tolist()], item_kind),
                        pa.array(scores),
                    ],
                    names=[id_col, "item_id", "score"],
                )

    return run


def _clean_rows(items: _Items, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, text, _, _ in _copies(items, column(batch, text_col)):
                clean = np.ones(end - row, bool)
                clean[text] = False
                yield batch.slice(row, end - row).filter(pa.array(clean))

    return run


def _best_scores(items, lengths, hashes, bounds, item, place, where):
    """Document, item and best score of every candidate pair."""
    if not len(where):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    doc = np.searchsorted(bounds, where, side="right") - 1
    begin = where - place  # where the item would begin
    order = np.lexsort((begin, item, doc))
    doc, item, begin = doc[order], item[order], begin[order]
    slack = np.maximum(lengths[item] // 2, 4)
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (begin[1:] - begin[:-1] > slack[1:])
    firsts = np.flatnonzero(new)
    finals = np.r_[firsts[1:], len(doc)] - 1
    doc, item = doc[firsts], item[firsts]
    pad = lengths[item]
    low = np.maximum(begin[firsts] - pad, bounds[doc])
    high = np.minimum(begin[finals] + lengths[item] + pad, bounds[doc + 1])
    scores = np.zeros(len(doc))
    order = np.lexsort((high - low, item))
    k = 0
    while k < len(order):
        i = item[order[k]]
        end = k + 1
        while end < len(order) and item[order[end]] == i and (end - k) * (high[order[end]] - low[order[end]]) < _BATCH_CELLS:
            end += 1
        rows = order[k:end]
        width = int((high[rows] - low[rows]).max())
        places = low[rows][:, None] + np.arange(width)
        inside = places < high[rows][:, None]
        passages = np.where(inside, hashes[np.minimum(places, len(hashes) - 1)], np.uint64(0))
        words = items.hashes[items.bounds[i] : items.bounds[i + 1]]
        scores[rows] = align(words, passages, inside) / (MATCH * len(words))
        k = end
    pair = np.lexsort((-scores, item, doc))
    doc, item, scores = doc[pair], item[pair], scores[pair]
    top = np.ones(len(doc), bool)
    top[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])
    return doc[top], item[top], scores[top]


def align(words: np.ndarray, passages: np.ndarray, inside: np.ndarray | None = None) -> np.ndarray:
    """The best local alignment score of the words with every passage (one per row)."""
    n, width = passages.shape
    if inside is None:
        inside = np.ones(passages.shape, bool)
    above = np.zeros((n, width + 1), np.int64)
    best = np.zeros(n, np.int64)
    ramp = -GAP * np.arange(width + 1)
    for word in words:
        same = (passages == word) & inside
        here = np.zeros_like(above)
        here[:, 1:] = np.maximum(above[:, :-1] + np.where(same, MATCH, MISMATCH), above[:, 1:] + GAP)
        here = np.maximum(here, 0)
        # A gap along the passage: the best value to the left less its distance.
        above = np.maximum.accumulate(here + ramp, axis=1) - ramp
        best = np.maximum(best, above.max(axis=1))
    return best


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``(id, item_id, score)`` of every document and test item it holds a copy of.

    The score is at least ``THRESHOLD``; items of fewer than ``MIN_ITEM_WORDS`` words must be
    held whole, symbols included, and score 1. Texts and items that are null, empty or without
    letters and digits match nothing; items that repeat are found for each id; rows that repeat an id give one row per item with the
    best score; other columns are left out; no documents or no items give no rows. Ids of documents
    and items may be of any type; texts of any length are read whole; equal scores need no order, as
    a pair of ids has one row.
    """
    narrow = docs.select(F.col(id_col), F.col(text_col))
    kind = benchmark.schema[item_col].dataType
    schema = T.StructType([narrow.schema[0], T.StructField("item_id", kind), T.StructField("score", T.DoubleType())])
    found = docs.sparkSession.createDataFrame([], schema)
    for seeds in _blocks(benchmark, item_col, item_text_col):
        found = found.unionByName(narrow.mapInArrow(_pairs(seeds, id_col, text_col, to_arrow_type(kind)), schema))
    return found.groupBy(id_col, "item_id").agg(F.max("score").alias("score"))


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that hold no copy of a test item; columns unchanged.

    Every row is judged by itself, as in ``leaks``; nothing is shuffled.
    """
    clean = docs
    for seeds in _blocks(benchmark, item_col, item_text_col):
        clean = clean.mapInArrow(_clean_rows(seeds, text_col), docs.schema)
    return clean


def _blocks(benchmark: DataFrame, item_col: str, item_text_col: str) -> Iterator[_Items]:
    """The test items with their seeds, in blocks of about ``BLOCK_CHARS`` characters."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("words"))
    items = items.where(F.length("words") > 0)
    chars = items.agg(F.sum(F.length("words"))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS)
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b).orderBy("item", "words").collect()
        yield _Items.of([r["item"] for r in rows], [r["words"] for r in rows])
