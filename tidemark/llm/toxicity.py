"""Toxicity scores by the nearest labelled examples under exact TF-IDF cosine.

Terms are words (runs of letters, lower-cased) and their prefixes, kept if they tell the labels
of the examples apart (chi-square). Each example is a TF-IDF vector of unit length over these
terms. The index is inverted: per term it lists the blocks of neighbouring examples that hold it,
with the largest weight in the block and the postings. For a text, the largest weights bound the
cosine with every example of a block. The blocks with the largest bounds are scored first, and then
all whose bound reaches the k-th best cosine found there. The neighbours are therefore the exact
ones. Texts are scored many at a time, and of the postings only those of open blocks are read;
terms that stand in many examples are kept as columns of a matrix, whose open blocks are
multiplied, since a list of nearly all examples is longer than a column.

The neighbours vote with their cosines, and the share of votes is turned into a probability by
the rates seen when every example is scored by the others (in the executors; ten counts come back).
A text without a known term has no neighbours and gets the rate of the examples without one. The
neighbours are returned as evidence. An example that is scored itself finds itself first.

The examples are a bounded sample: the ``max_examples`` labelled documents with the smallest
hashes of their ids. Every term that passes the test is kept, and the postings are sparse, so the
index has the size of the examples and is sent to every task. Document frequencies are those of
all documents. Every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import SpanHashes, column, mixed, ragged, text_chunks
from tidemark.llm.letters import Letters, Lookup

MAX_EXAMPLES = 20_000
PREFIXES = (4, 5, 6, 7, 8)
MIN_EXAMPLES_OF_TERM = 5
MIN_CHI_SQUARE = 10.83  # the 0.1 % level with one degree of freedom
NEIGHBOURS = 15
BLOCK = 64
EVIDENCE = 3
THRESHOLD = 0.3
_BINS = 10
_TEXTS = 128  # scored at a time: one number per text and example is held
_FIRST_BLOCKS = 3  # scored before the others, to know what these must reach
_COMMON_SHARE = 60  # terms of more than one in so many examples are columns of a matrix,
_MATRIX_BYTES = 60 << 20  # the most common ones as long as it has room
_DECIMALS = 5  # cosines are compared at this precision, so ties do not depend on rounding


def _terms(found: Letters) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the terms of one kind and the texts they stand in."""
    hashes = SpanHashes(found.codes)
    yield mixed(hashes(found.starts, found.ends) + np.uint64(1)), found.text
    starts, text, length = found.starts, found.text, found.ends - found.starts
    for size in sorted(PREFIXES):
        long = length >= size
        starts, text, length = starts[long], text[long], length[long]
        yield hashes(starts, starts + size), text


def held_terms(texts: list[str | None], terms: Lookup, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place and count of every known term in each text, in this order."""
    cells = []
    for hashes, text in _terms(Letters(texts)):
        at = terms(hashes)
        cells.append(text[at >= 0] * n_terms + at[at >= 0])
    cell, n = np.unique(np.concatenate(cells), return_counts=True)
    return cell // max(n_terms, 1), cell % max(n_terms, 1), n.astype(np.float32)


def term_counts(texts: list[str | None], terms: Lookup, n_terms: int) -> np.ndarray:
    """How often each known term stands in each text."""
    counts = np.zeros((len(texts), n_terms), np.float32)
    text, at, n = held_terms(texts, terms, n_terms)
    counts[text, at] = n
    return counts


@dataclass
class Postings:
    """Postings by term, those of a term by block, and where they begin."""

    term_first: np.ndarray  # entry that a term's entries begin at; one more at the end
    block: np.ndarray  # of every entry,
    largest: np.ndarray  # and the largest weight of its postings
    entry_first: np.ndarray  # posting that an entry's postings begin at; one more at the end
    example: np.ndarray
    weight: np.ndarray


@dataclass
class Index:
    terms: np.ndarray
    idf: np.ndarray
    ids: np.ndarray = field(repr=False)
    labels: np.ndarray = field(repr=False)
    rare: Postings = field(repr=False)
    common: np.ndarray = field(repr=False)  # the places of the common terms,
    common_postings: tuple[np.ndarray, np.ndarray, np.ndarray] = field(repr=False)  # example, column, weight
    prior: float = 0.0
    calibration: np.ndarray | None = field(default=None, repr=False)

    @property
    def blocks(self) -> range:
        return range(-(-len(self.ids) // BLOCK))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("matrix", "matrix_largest")}

    @cached_property
    def matrix(self) -> np.ndarray:
        """Weights of the common terms per block, example of the block, and term."""
        example, at, weight = self.common_postings
        out = np.zeros((len(self.blocks), BLOCK, len(self.common)), np.float32)
        out[example // BLOCK, example % BLOCK, at] = weight
        return out

    @cached_property
    def matrix_largest(self) -> np.ndarray:
        return self.matrix.max(axis=1, initial=0.0)

    def dense(self, block: int) -> np.ndarray:
        """The vectors of the examples of one block over all terms."""
        p, first = self.rare, block * BLOCK
        out = np.zeros((BLOCK, len(self.terms)))
        term = np.repeat(np.arange(len(self.terms)), np.diff(p.entry_first[p.term_first]))
        mine = (p.example >= first) & (p.example < first + BLOCK)
        out[p.example[mine] - first, term[mine]] = p.weight[mine]
        out[:, self.common] = self.matrix[block]
        return out[: len(self.ids) - first]

    def weights(self, text: np.ndarray, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The weights of terms in texts, of unit length per text."""
        raw = (1 + np.log(counts)) * self.idf[at]
        lengths = np.sqrt(np.bincount(text, raw * raw))
        return raw / np.maximum(lengths, 1e-12)[text]

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        """Unit vectors over all terms, of how often each stands in each text."""
        text, at = np.nonzero(counts)
        out = np.zeros(counts.shape)
        out[text, at] = self.weights(text, at, counts[text, at].astype(np.float64))
        return out

    def neighbours(
        self, vectors: np.ndarray, k: int, leave_out: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """`nearest` for vectors over all terms."""
        text, at = np.nonzero(vectors)
        return self.nearest(len(vectors), text, at, vectors[text, at], k, leave_out)

    def nearest(
        self,
        n: int,
        text: np.ndarray,
        at: np.ndarray,
        weight: np.ndarray,
        k: int,
        leave_out: np.ndarray | None = None,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Cosines and positions of the ``k`` nearest examples of ``n`` texts; equal cosines go by
        position. Places without an example have cosine 0 and position -1.

        The texts are given by the weights of their terms, in the order of the texts. ``leave_out``
        names one example per text that does not count, or -1."""
        best, where = np.zeros((n, k)), np.full((n, k), -1)
        if not len(self.blocks):
            return best, where
        for first in range(0, n, _TEXTS):
            rows = slice(first, min(first + _TEXTS, n))
            low, high = np.searchsorted(text, [first, first + _TEXTS])
            without = None if leave_out is None else leave_out[rows]
            best[rows], where[rows] = self._nearest(
                rows.stop - first, text[low:high] - first, at[low:high], weight[low:high], k, without
            )
        return best, where

    def _nearest(
        self, n: int, text: np.ndarray, at: np.ndarray, weight: np.ndarray, k: int, leave_out: np.ndarray | None
    ) -> tuple[np.ndarray, np.ndarray]:
        rare, n_blocks = self.rare, len(self.blocks)
        column_of = np.full(len(self.terms), -1)
        column_of[self.common] = np.arange(len(self.common))
        is_common = column_of[at] >= 0
        asked = np.zeros((n, len(self.common)), np.float32)
        asked[text[is_common], column_of[at[is_common]]] = weight[is_common]
        text, at, weight = text[~is_common], at[~is_common], weight[~is_common]

        # One entry per text, rare term and block that holds it.
        n_entries = rare.term_first[at + 1] - rare.term_first[at]
        entry = ragged(rare.term_first[at], n_entries)
        owner, factor = np.repeat(text, n_entries), np.repeat(weight, n_entries)
        pair = owner * n_blocks + rare.block[entry]
        bounds = (asked @ self.matrix_largest.T).astype(np.float64)
        bounds += np.bincount(pair, factor * rare.largest[entry], n * n_blocks).reshape(n, n_blocks)

        def rare_cosines(slot: np.ndarray, width: int) -> np.ndarray:
            """What the rare terms add to the cosines with the examples of blocks that have a slot."""
            at_slot = slot.ravel()[pair]
            mine = at_slot >= 0
            chosen = entry[mine]
            sizes = rare.entry_first[chosen + 1] - rare.entry_first[chosen]
            posting = ragged(rare.entry_first[chosen], sizes)
            cell = np.repeat((owner[mine] * width + at_slot[mine]) * BLOCK, sizes)
            cell += rare.example[posting] % BLOCK
            added = np.repeat(factor[mine], sizes)
            added *= rare.weight[posting]
            total = np.bincount(cell, added, n * width * BLOCK).astype(np.float64, copy=False)
            return total.reshape(n, width, BLOCK)

        # The k-th best cosine in the blocks with the largest bounds.
        few = min(_FIRST_BLOCKS, n_blocks)
        top = np.argpartition(-bounds, few - 1, axis=1)[:, :few]
        slot = np.full((n, n_blocks), -1)
        np.put_along_axis(slot, top, np.arange(few), axis=1)
        first = rare_cosines(slot, few)
        for block in np.unique(top):
            rows = np.flatnonzero(slot[:, block] >= 0)
            first[rows, slot[rows, block]] += asked[rows] @ self.matrix[block].T
        if leave_out is not None:
            rows = np.flatnonzero((leave_out >= 0) & (slot[np.arange(n), leave_out // BLOCK] >= 0))
            first[rows, slot[rows, leave_out[rows] // BLOCK], leave_out[rows] % BLOCK] = 0
        held = min(k, few * BLOCK)
        reached = np.partition(first.reshape(n, -1), few * BLOCK - held, axis=1)[:, few * BLOCK - held]
        reached -= 2 * 10.0**-_DECIMALS

        # All blocks that may reach it. A block that may not is left with less than its bound.
        open_ = (bounds > 0) & (bounds >= reached[:, None])
        cosines = rare_cosines(np.where(open_, np.arange(n_blocks), -1), n_blocks)
        if 2 * open_.sum() > open_.size:
            cosines += (asked @ self.matrix.reshape(n_blocks * BLOCK, len(self.common)).T).reshape(cosines.shape)
        else:
            for block in np.flatnonzero(open_.any(axis=0)):
                rows = np.flatnonzero(open_[:, block])
                cosines[rows, block] += asked[rows] @ self.matrix[block].T
        if leave_out is not None:
            rows = np.flatnonzero(leave_out >= 0)
            cosines[rows, leave_out[rows] // BLOCK, leave_out[rows] % BLOCK] = 0

        # Few examples come near; they are sorted by rounded cosine, then by position.
        near = cosines.reshape(n, -1) >= np.maximum(reached, 10.0**-_DECIMALS / 2)[:, None]
        text, example = np.divmod(np.flatnonzero(near), n_blocks * BLOCK)
        cosine = np.round(cosines.reshape(n, -1)[text, example], _DECIMALS)
        order = np.lexsort((example, -cosine, text))
        text, example, cosine = text[order], example[order], cosine[order]
        rank = np.arange(len(text)) - np.searchsorted(text, text)
        kept = (rank < k) & (cosine > 0)
        best, where = np.zeros((n, k)), np.full((n, k), -1)
        best[text[kept], rank[kept]] = cosine[kept]
        where[text[kept], rank[kept]] = example[kept]
        return best, where

    def votes(self, best: np.ndarray, where: np.ndarray) -> np.ndarray:
        """The cosine-weighted share of toxic neighbours; the prior where there are none."""
        total = best.sum(axis=1)
        toxic = (best * np.where(where >= 0, self.labels[where], 0)).sum(axis=1) if len(self.labels) else 0 * total
        return np.where(total > 0, toxic / np.where(total > 0, total, 1), -1)

    def votes_of(
        self, n: int, held: tuple[np.ndarray, np.ndarray, np.ndarray], leave_out: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Votes, cosines and positions of the neighbours of ``n`` texts; -1 for one without a term."""
        text, at, counts = held
        some, row = np.unique(text, return_inverse=True)
        weight = self.weights(row, at, counts.astype(np.float64))
        without = None if leave_out is None else leave_out[some]
        best, where = np.zeros((n, NEIGHBOURS)), np.full((n, NEIGHBOURS), -1)
        best[some], where[some] = self.nearest(len(some), row, at, weight, NEIGHBOURS, without)
        return self.votes(best, where), best, where

    def probability(self, votes: np.ndarray) -> np.ndarray:
        if self.calibration is None:
            return np.where(votes < 0, self.prior, votes)
        centres = (np.arange(_BINS) + 0.5) / _BINS
        return np.where(votes < 0, self.prior, np.interp(votes, centres, self.calibration))


def train(
    labelled: DataFrame,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_examples: int = MAX_EXAMPLES,
) -> Index:
    """Build the index from ``labelled`` ids (0 or 1 in ``label_col``) and their texts.

    Rows without an id, a label or a text are left out; an id with several labels counts as
    toxic if one of them says so; a document that repeats counts once. Without examples every
    score is 0.
    """
    known = (
        labelled.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max(label_col).cast("int").alias("label"))
    )
    wanted = known.orderBy(F.xxhash64("id"), "id").limit(max_examples)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    sample = texts.join(F.broadcast(wanted), "id").dropDuplicates(["id"]).checkpoint()

    found = (
        sample.mapInArrow(_distinct_terms, "term bigint, label int")
        .groupBy("term")
        .agg(F.count("*").alias("n"), F.sum("label").alias("toxic"))
        .where(F.col("n") >= MIN_EXAMPLES_OF_TERM)
    )
    size, positive = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    a, n = F.col("toxic").cast("double"), F.col("n").cast("double")
    # (a, b) with the term, (c, d) without it: a d - b c, over the four margins
    b, c = n - a, F.lit(float(positive)) - a
    d = F.lit(float(size - positive)) - b
    # A term of all examples tells nothing apart: the quotient is null and the term is left out.
    margins = (a + b) * (c + d) * (a + c) * (b + d)
    chi = F.try_divide(F.lit(float(size)) * F.pow(a * d - b * c, 2), margins)
    kept = found.where(chi >= MIN_CHI_SQUARE).select("term").collect() if 0 < positive < size else []
    terms = np.sort(np.array([r["term"] for r in kept], np.int64).view(np.uint64))
    idf = np.zeros(0)
    if len(terms):
        counted = texts.mapInArrow(_frequencies(terms), "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
        n_docs = np.zeros(len(terms) + 1)
        for row in counted.collect():
            n_docs[row["at"]] = row["n"]
        idf = np.log1p(n_docs[-1] / np.maximum(n_docs[:-1], 1))

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(terms)
        for batch in batches:
            texts = column(batch, "text")
            for row, end, _, _ in text_chunks(texts):
                text, at, n = held_terms(texts.slice(row, end - row).to_pylist(), lookup, len(terms))
                cuts = np.searchsorted(text, np.arange(1, end - row))
                yield pa.RecordBatch.from_arrays(
                    [
                        column(batch, "id").slice(row, end - row),
                        column(batch, "label").slice(row, end - row),
                        pa.array([a.astype(np.int32).tobytes() for a in np.split(at, cuts)], pa.binary()),
                        pa.array([c.tobytes() for c in np.split(n, cuts)], pa.binary()),
                    ],
                    names=["id", "label", "at", "n"],
                )

    schema = T.StructType(
        [sample.schema["id"]]
        + T.StructType.fromDDL("label int, at binary, n binary").fields
    )
    # Only the examples with a term come to the driver; of the others their rate is enough.
    rows = sample.mapInArrow(sparse, schema).where(F.length("at") > 0).collect()
    ids = np.array([r["id"] for r in rows], object)
    labels = np.array([r["label"] for r in rows], np.int64)
    prior = (positive - int(labels.sum()) + positive / max(size, 1)) / (size - len(rows) + 1)
    held = [(np.frombuffer(r["at"], np.int32), np.frombuffer(r["n"], np.float32)) for r in rows]
    del rows
    index = build_index(terms, idf, ids, labels, held, prior)
    del held
    if len(ids) > 1:
        index.calibration = _calibrated(sample, index)
    return index


def _calibrated(sample: DataFrame, index: Index) -> np.ndarray:
    """The rate of toxic examples by share of votes, every example scored by the others."""
    shared = sample.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: Index = shared.value
        terms, places = Lookup(fitted.terms), {x: i for i, x in enumerate(fitted.ids)}
        for batch in batches:
            texts, ids = column(batch, "text"), column(batch, "id").to_pylist()
            labels = column(batch, "label").to_numpy()
            for row, end, _, _ in text_chunks(texts):
                held = held_terms(texts.slice(row, end - row).to_pylist(), terms, len(fitted.terms))
                own = np.array([places.get(x, -1) for x in ids[row:end]])
                votes = fitted.votes_of(end - row, held, own)[0]
                seen = (votes >= 0) & (own >= 0)
                bins = np.minimum((votes[seen] * _BINS).astype(np.int32), _BINS - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bins), pa.array(labels[row:end][seen], pa.int32())], names=["bin", "label"]
                )

    rows = sample.mapInArrow(run, "bin int, label int").groupBy("bin").agg(F.count("*"), F.sum("label")).collect()
    shared.destroy()
    n, toxic = np.zeros(_BINS), np.zeros(_BINS)
    for at, count, positive in rows:
        n[at], toxic[at] = count, positive
    centres = (np.arange(_BINS) + 0.5) / _BINS
    return np.maximum.accumulate((toxic + 2 * centres) / (n + 2))


def _frequencies(terms: np.ndarray):
    """In how many texts each term stands, by its place; all texts are counted behind the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(terms)
        counts = np.zeros(len(terms) + 1, np.int64)
        for batch in batches:
            texts = column(batch, "text")
            counts[-1] += len(texts)
            for row, end, _, _ in text_chunks(texts):
                _, at, _ = held_terms(texts.slice(row, end - row).to_pylist(), lookup, len(terms))
                counts += np.bincount(at, minlength=len(counts))
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(counts[held])], names=["at", "n"])

    return run


def _distinct_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = column(batch, "text")
        labels = column(batch, "label").to_numpy()
        for row, end, _, _ in text_chunks(texts):
            found = Letters(texts.slice(row, end - row).to_pylist())
            for hashes, text in _terms(found):
                order = np.lexsort((hashes, text))
                hashes, text = hashes[order], text[order]
                new = np.ones(len(hashes), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes[new].view(np.int64)),
                        pa.array(labels[row:end][text[new]], pa.int32()),
                    ],
                    names=["term", "label"],
                )


def build_index(
    terms: np.ndarray,
    idf: np.ndarray,
    ids: np.ndarray,
    labels: np.ndarray,
    held: list[tuple[np.ndarray, np.ndarray]],
    prior: float,
) -> Index:
    """The index of examples that have a term each, not calibrated yet.

    ``held`` has the sorted places of each example's terms and how often they stand in it;
    ``prior`` is the rate of toxic ones among examples without a term.
    """
    # The driver holds a few arrays of all postings at a time, of 32 bits each.
    sizes = np.array([len(at) for at, _ in held], np.int64)
    at = np.concatenate([np.zeros(0, np.int32), *(a for a, _ in held)]).astype(np.int32, copy=False)
    owner = np.repeat(np.arange(len(held), dtype=np.int32), sizes)
    weight = np.concatenate([np.zeros(0, np.float32), *(n for _, n in held)]).astype(np.float32)
    weight = (1 + np.log(weight)) * idf.astype(np.float32)[at] if len(at) else weight
    weight /= np.sqrt(np.bincount(owner, weight * weight, len(held))).astype(np.float32)[owner]
    # Examples with the same strongest term share a block, which keeps the bounds low.
    first = np.cumsum(sizes) - sizes
    largest = np.maximum.reduceat(weight, first) if len(held) else weight
    hits = np.flatnonzero(weight == largest[owner]) if len(held) else first
    strongest = at[hits[np.searchsorted(owner[hits], np.arange(len(held)))]]
    order = np.lexsort((ids.astype(str), -largest, strongest)) if len(held) else first
    place = np.empty(len(held), np.int32)
    place[order] = np.arange(len(held))
    example = place[owner]
    del owner

    frequency = np.bincount(at, minlength=len(terms))
    room = _MATRIX_BYTES // (4 * BLOCK * max(1, -(-len(held) // BLOCK)))
    common = np.argsort(-frequency, kind="stable")[:room]
    common = np.sort(common[frequency[common] * _COMMON_SHARE > len(held)])
    column_of = np.full(len(terms), -1, np.int32)
    column_of[common] = np.arange(len(common))
    in_matrix = column_of[at] >= 0
    postings = (example[in_matrix], column_of[at[in_matrix]], weight[in_matrix])
    at, example, weight = (x[~in_matrix] for x in (at, example, weight))
    rare = _postings(at, example, weight, len(terms))
    return Index(terms, idf, ids[order], labels[order], rare, common, postings, prior)


def _postings(at: np.ndarray, example: np.ndarray, weight: np.ndarray, n_terms: int) -> Postings:
    order = np.lexsort((example, at))
    at, example, weight = at[order], example[order], weight[order]
    del order
    block = example // BLOCK
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (block[1:] != block[:-1])
    first = np.flatnonzero(new)
    largest = np.maximum.reduceat(weight, first) if len(first) else weight
    return Postings(
        np.searchsorted(at[first], np.arange(n_terms + 1)), block[first], largest, np.r_[first, len(at)], example, weight
    )


def score(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score, evidence)`` of every row.

    ``score`` is the probability of label 1; ``evidence`` holds the nearest examples (id as
    text, cosine, label). Null and empty texts and texts without a known term get the rate of
    such examples and no evidence. Repeated rows stay; other columns are left out.
    """
    return _scored(docs, index, text_col, [id_col], "score", "evidence")


def drop_toxic(docs: DataFrame, index: Index, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold; columns unchanged.

    Every row is judged by itself, as in ``score``; nothing is shuffled.
    """
    own = {c.lower() for c in docs.columns}
    score_col, evidence_col = (next(n for k in range(len(own) + 1) if (n := f"{name}_{k}") not in own) for name in ("score", "evidence"))
    scored = _scored(docs, index, text_col, docs.columns, score_col, evidence_col)
    return scored.where(F.col(score_col) < threshold).select(docs.columns)


def _scored(
    docs: DataFrame, index: Index, text_col: str, passed: list[str], score_col: str, evidence_col: str
) -> DataFrame:
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(index)
    narrow = docs.select(*dict.fromkeys([*passed, text_col]))
    kind = pa.list_(pa.struct([("example", pa.string()), ("cosine", pa.float64()), ("label", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: Index = shared.value
        terms = Lookup(fitted.terms)
        for batch in batches:
            texts = column(batch, text_col)
            for row, end, _, _ in text_chunks(texts):
                held = held_terms(texts.slice(row, end - row).to_pylist(), terms, len(fitted.terms))
                votes, best, where = fitted.votes_of(end - row, held)
                evidence = [
                    [
                        {"example": str(fitted.ids[x]), "cosine": y, "label": int(fitted.labels[x])}
                        for x, y in zip(w, b)
                        if x >= 0
                    ]
                    for w, b in zip(where[:, :EVIDENCE].tolist(), best[:, :EVIDENCE].tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(column(batch, c).slice(row, end - row) for c in passed),
                        pa.array(fitted.probability(votes)),
                        pa.array(evidence, kind),
                    ],
                    names=[*passed, score_col, evidence_col],
                )

    schema = T.StructType(
        [narrow.schema[c] for c in passed]
        + T.StructType.fromDDL(
            f"`{score_col}` double, `{evidence_col}` array<struct<example: string, cosine: double, label: int>>"
        ).fields
    )
    return narrow.mapInArrow(run, schema)
