"""Removal of repeated passages of words by repeated-phrase automata.

A passage recurs where a window of ``WINDOW`` words also starts in a document with a smaller id.

1. Every window is anchored at one phrase of ``PHRASE_WORDS`` words (see ``windows``). The
   anchors are grouped by their hashes; those of two or more documents are confirmed. (Two phrases
   of one hash would be confirmed without need, which costs work and changes no result.)
2. Documents are dealt to buckets. Each bucket gets the hashes of the confirmed phrases that its
   documents anchor, takes their words from its documents, compiles them into one Aho-Corasick
   automaton, and streams all its documents through it. That locates every occurrence; a document
   is read by one automaton, whose size is bounded by its bucket, so the work grows with the corpus
   and not with its square.
3. The windows anchored at an occurrence form a span. Equal spans are copies of the one with the
   smallest id and all of their windows recur. Only the first of equal spans compares window by
   window, so a passage that stands in a third of the documents costs few rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64

from tidemark.llm.arrays import binary, column, ragged, span_hashes, text_chunks, words
from tidemark.llm.packing import packed, unpacked
from tidemark.llm.windows import anchored_windows, covered, gram_hashes, runs
from tidemark.scratch import ensure_checkpoint_dir

WINDOW = 50
# Long enough that single lines, which recur far more often than passages, are no anchors.
PHRASE_WORDS = 16
BUCKET_BYTES = 8 << 20
# Sums of powers tell words of this many bytes apart; two much longer ones can be made to agree.
_PLAIN_BYTES = 64
_PHRASE, _COPY, _DOCUMENT = 0, 1, 2
_ALL = 1 << 30  # all windows of a text


def text_bytes(docs: DataFrame, text_col: str) -> int:
    return docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


def bucket_count(spark: SparkSession, size: int) -> int:
    """Buckets of about ``BUCKET_BYTES`` of ``size`` bytes of text, several for each shuffle partition."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(4 * partitions, -(-size // BUCKET_BYTES))


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of all words, and the first word of every text."""
    starts, ends, text = words(data, offsets)
    hashes = span_hashes(data, starts, ends)
    for k in np.flatnonzero(ends - starts > _PLAIN_BYTES):
        hashes[k] = xxh64(data[starts[k] : ends[k]].tobytes()).intdigest()
    return starts, ends, hashes, np.searchsorted(text, np.arange(len(offsets)))


def _spelled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All words with one space after each, and where each begins."""
    lengths = ends - starts
    begins = np.cumsum(lengths + 1) - (lengths + 1)
    out = np.full(int((lengths + 1).sum()), 0x20, np.uint8)
    out[ragged(begins, lengths)] = data[ragged(starts, lengths)]
    return out, begins


def _anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of some texts: starts and ends of the words, first words, phrase hashes, and the anchors."""
    starts, ends, hashes, bounds = _word_hashes(data, offsets)
    grams = gram_hashes(hashes, PHRASE_WORDS)
    _, at = anchored_windows(grams, bounds, WINDOW, PHRASE_WORDS)
    return starts, ends, bounds, grams, np.unique(at)


def _anchor_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, buckets, texts = (column(batch, c) for c in ("id", "bucket", "text"))
        for row, end, data, offsets in text_chunks(texts):
            _, _, bounds, grams, at = _anchors(data, offsets)
            owner = pa.array(row + np.searchsorted(bounds, at, side="right") - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams[at].view(np.int64)), ids.take(owner), buckets.take(owner)],
                names=["phrase", "id", "bucket"],
            )


def _phrases(texts: list[bytes], confirmed: np.ndarray) -> set[str]:
    """The words of the confirmed phrases that some documents anchor."""
    found = set()
    for _, _, data, offsets in text_chunks(pa.array(texts, pa.large_binary())):
        starts, ends, _, grams, at = _anchors(data, offsets)
        for k in at[np.isin(grams[at], confirmed)].tolist():
            raw = (data[a:b].tobytes() for a, b in zip(starts[k : k + PHRASE_WORDS], ends[k : k + PHRASE_WORDS]))
            found.add(b" ".join(raw).decode())
    return found


def _located_spans(raw: bytes, ends: list[int]) -> tuple[np.ndarray, ...]:
    """The spans of windows that are anchored where a phrase ends, in the text with single spaces."""
    data = np.frombuffer(raw, np.uint8)
    starts, stops, hashes, bounds = _word_hashes(data, np.array([0, len(data)]))
    letters = (data[ragged(starts, stops - starts)] & 0xC0) != 0x80
    size = np.add.reduceat(letters, np.cumsum(stops - starts) - (stops - starts))
    final = np.searchsorted(np.cumsum(size + 1), np.array(ends))
    grams = gram_hashes(hashes, PHRASE_WORDS)
    located = np.zeros(len(grams), bool)
    located[final - PHRASE_WORDS + 1] = True
    windows, at = anchored_windows(grams, bounds, WINDOW, PHRASE_WORDS)
    chosen = located[at]
    windows, at = windows[chosen], at[chosen]
    first, length = runs(at, windows)
    begin = windows[first]
    # Spans may be long, so their hash is one without structure; windows have fifty words.
    stop = begin + length - 1 + WINDOW
    whole = [xxh64(hashes[a:b].tobytes()).intdigest() for a, b in zip(begin.tolist(), stop.tolist())]
    each = span_hashes(hashes, windows, windows + WINDOW)
    return grams[at[first]], np.array(whole, np.uint64), begin, length, each


def _locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams rows of one bucket after the other: hashes of phrases, then copies, then documents."""
    import ahocorasick
    from zstandard import ZstdDecompressor

    expand = ZstdDecompressor().decompress

    def located(confirmed: list[int], copies: set, docs: list[tuple]) -> Iterator[tuple]:
        docs = [(id_, key, expand(text)) for id_, key, text in docs if (id_, key) not in copies]
        phrases = _phrases([d[2] for d in docs], np.array(confirmed, np.int64).view(np.uint64)) if confirmed else set()
        if not phrases:
            return
        automaton = ahocorasick.Automaton()
        for phrase in phrases:
            automaton.add_word(f" {phrase} ", True)
        automaton.make_automaton()
        for id_, key, raw in docs:
            ends = [e for e, _ in automaton.iter(" " + b" ".join(raw.split()).decode() + " ")]
            if ends:
                spans = _located_spans(raw, ends)
                if len(spans[0]):
                    yield (id_, key, *spans)

    kind = None
    bucket, confirmed, copies, docs = None, [], set(), []
    for batch in batches:
        kind = column(batch, "id").type
        rows = zip(*(column(batch, c).to_pylist() for c in ("bucket", "kind", "text", "id", "key")))
        out: list[tuple] = []
        for b, what, text, id_, key in rows:
            if b != bucket:
                out += located(confirmed, copies, docs)
                bucket, confirmed, copies, docs = b, [], set(), []
            if what == _PHRASE:
                confirmed.append(key)
            elif what == _COPY:
                copies.add((id_, key))
            else:
                docs.append((id_, key, text))
        if out:
            yield _span_rows(out, kind)
    out = list(located(confirmed, copies, docs))
    if out:
        yield _span_rows(out, kind)


def _span_rows(out: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    owner = pa.array(np.repeat(np.arange(len(out)), [len(o[2]) for o in out]))
    lengths = np.concatenate([o[5] for o in out])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([o[0] for o in out], kind).take(owner),
            pa.array([o[1] for o in out], pa.int64()).take(owner),
            *(pa.array(np.concatenate([o[k] for o in out]).view(np.int64)) for k in (2, 3)),
            pa.array(np.concatenate([o[4] for o in out]).astype(np.int32)),
            pa.ListArray.from_arrays(
                pa.array(np.cumsum(np.r_[0, lengths]).astype(np.int32)),
                pa.array(np.concatenate([o[6] for o in out]).view(np.int64)),
            ),
        ],
        names=["id", "key", "anchor", "span", "first", "windows"],
    )


def recurring_windows(located: DataFrame) -> DataFrame:
    """``(id, key, first, n)``: ranges of windows that also start under a smaller id.

    ``located`` has (id, key, anchor, span, first, windows): spans of documents with the hashes
    of anchor, span and every window in it.
    """
    span = ["anchor", "span"]
    least = located.groupBy(*span).agg(F.min("id").alias("first_id"))
    told = located.join(least, span)
    copies = told.where("id > first_id").select("id", "key", "first", F.size("windows").alias("n"))
    each = told.where("id = first_id").select("id", "key", "anchor", "first", F.posexplode("windows").alias("k", "window"))
    earliest = each.groupBy("anchor", "window").agg(F.min("id").alias("first_id"))
    late = each.join(earliest, ["anchor", "window"]).where("id > first_id")
    return copies.unionByName(late.select("id", "key", (F.col("first") + F.col("k")).alias("first"), F.lit(1).alias("n")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, n_removed, kept)`` of every row; kept words are joined by one space.

    Null and empty texts have no words, texts of any length are read whole. Texts under ``WINDOW`` words lose nothing. Rows that
    repeat an id never count as each other's earlier document; rows without an id lose nothing
    and take nothing. Other columns are left out, whatever their names; no rows give no rows.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("key")
    )
    buckets = bucket_count(docs.sparkSession, text_bytes(rows, "text"))
    dealt = rows.where("id IS NOT NULL AND text IS NOT NULL").withColumn(
        "bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")
    )
    kind = rows.schema["id"].dataType
    anchors = dealt.select("id", "bucket", "text").mapInArrow(
        _anchor_hashes,
        T.StructType([T.StructField("phrase", T.LongType()), T.StructField("id", kind), T.StructField("bucket", T.IntegerType())]),
    )
    held = anchors.groupBy("phrase").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("phrase")
    # A phrase may stand in every bucket; its rows are joined, not gathered.
    confirmed = anchors.select("phrase", "bucket").join(held, "phrase").distinct()
    # Texts equal to one with a smaller id go whole; nothing has to be located in them.
    named = dealt.select("bucket", "id", "key", F.md5("text").alias("digest"))
    earliest = named.groupBy("digest").agg(F.min("id").alias("first_id"))
    copies = named.join(earliest, "digest").where("id > first_id").select("bucket", "id", "key").distinct().checkpoint()

    lines = (
        confirmed.select("bucket", F.lit(_PHRASE).alias("kind"), F.lit(None).cast("binary").alias("text"), F.lit(None).cast(kind).alias("id"), F.col("phrase").alias("key"))
        .unionByName(copies.select("bucket", F.lit(_COPY).alias("kind"), F.lit(None).cast("binary").alias("text"), "id", "key"))
        .unionByName(packed(dealt.select("bucket", F.lit(_DOCUMENT).alias("kind"), "text", "id", "key")))
    )
    located = (
        lines.repartition(F.col("bucket"))
        .sortWithinPartitions("bucket", "kind")
        .mapInArrow(
            _locate,
            T.StructType(
                [T.StructField("id", kind)]
                + T.StructType.fromDDL("key bigint, anchor bigint, span bigint, first int, windows array<bigint>").fields
            ),
        )
        .checkpoint()
    )
    whole = copies.select("id", "key", F.lit(0).alias("first"), F.lit(_ALL).alias("n"))
    found = (
        recurring_windows(located)
        .unionByName(whole)
        .groupBy("id", "key")
        .agg(F.collect_list("first").alias("firsts"), F.collect_list("n").alias("lengths"))
    )
    joined = packed(rows).join(found, ["id", "key"], "left").select("id", "text", "firsts", "lengths")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, firsts, lengths = (column(batch, c) for c in ("id", "text", "firsts", "lengths"))
            for row, end, data, offsets in text_chunks(unpacked(texts)):
                starts, ends, text = words(data, offsets)
                bounds = np.searchsorted(text, np.arange(len(offsets)))
                gone = np.zeros(len(starts), bool)
                for i in np.flatnonzero(firsts.slice(row, end - row).is_valid().to_numpy(zero_copy_only=False)):
                    size = int(bounds[i + 1] - bounds[i])
                    if size < WINDOW:
                        continue
                    first = firsts[row + i].values.to_numpy()
                    n_windows = np.minimum(lengths[row + i].values.to_numpy(), size - WINDOW + 1)
                    gone[bounds[i] : bounds[i + 1]] = covered(size, first, n_windows - 1 + WINDOW)
                n = np.diff(bounds)
                removed = np.bincount(text[gone], minlength=len(n))
                left, owner = np.flatnonzero(~gone), text[~gone]
                spelled, begins = _spelled(data, starts[left], ends[left])
                # No space after the last word of a text.
                kept = np.ones(len(spelled), bool)
                last = np.flatnonzero(np.r_[owner[1:] != owner[:-1], True]) if len(owner) else owner
                kept[begins[last] + (ends - starts)[left[last]]] = False
                sizes = np.bincount(owner, weights=(ends - starts)[left] + 1, minlength=len(n)).astype(np.int64)
                sizes -= sizes > 0
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(row, end - row),
                        pa.array(n),
                        pa.array(removed),
                        binary(spelled[kept], np.cumsum(np.r_[0, sizes]), pa.large_string()).cast(pa.string()),
                    ],
                    names=[id_col, "n_words", "n_removed", "kept"],
                )

    schema = T.StructType([T.StructField(id_col, kind)] + T.StructType.fromDDL("n_words bigint, n_removed bigint, kept string").fields)
    return joined.mapInArrow(remove, schema)
