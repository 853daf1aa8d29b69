"""Removal of repeated byte strings by range-partitioned suffix sorting.

A string of ``LENGTH`` bytes recurs where it also starts in a document with a smaller id. Every
such string begins a suffix of its text; suffixes that begin with the same string are neighbours
in sorted order. Three steps keep out of the sort what cannot matter:

1. Every string is anchored at one n-gram of ``GRAM`` bytes (see ``windows``). The hashes of the
   anchors are counted; a suffix can only recur if its anchor is found under two ids.
2. Texts equal to one with a smaller id are whole copies.

The suffixes that share an anchor form a span of text. Splitters over the order of spans (anchor,
id, place) come from a sample of the documents; every task packs its spans by range and the ranges
are dealt out. Of equal spans in a range one stands for all. Each range sorts the suffixes of these by
multikey quicksort on eight bytes at a time and takes the smallest id of every run of equal
beginnings. Many equal anchors fill several ranges, since ids are part of the splitters. What
no smaller id of its own range precedes may have one across the border: for the first and the
last anchor of every range these suffixes are compared over all ranges.

Documents are shuffled compressed, once for their spans and once for the removal at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import binary, column, mixed, ragged, span_hashes, text_chunks
from tidemark.llm.packing import packed, unpacked
from tidemark.llm.phrases import bucket_count, text_bytes
from tidemark.llm.windows import anchored_windows, covered, gram_hashes, runs
from tidemark.scratch import ensure_checkpoint_dir

LENGTH = 50
# Long enough that equal n-grams by chance stay rare in a large corpus.
GRAM = 24
_FLUSH_ANCHORS = 250_000
_HASH_BYTES = 5
_CHUNK_BYTES = 512 << 10  # of text at a time; the arrays take some fifty times as much
_SORTED_SUFFIXES = 250_000  # at a time; anchors are not divided
_FLUSH_SPANS = 250_000
_SAMPLED_LEADS = 200  # a range
_BYTES_A_SPAN = 14  # about; of any text


# --- anchors that stand under two ids ----------------------------------------------------


def _anchor_hashes(grams: np.ndarray) -> np.ndarray:
    """40 bits of the hashes; a wrong hit costs work and no result."""
    return grams >> np.uint64(24)


def _requests(buckets: int):
    """Anchors of a part of the documents, packed by bucket of their hash.

    An anchor that this part already knows under two ids is sent once to its bucket, so that
    others learn of it; its other holders go to buckets of their own, which pass them on.
    """
    from zstandard import ZstdCompressor

    def pack(values: np.ndarray) -> bytes:
        return ZstdCompressor().compress(values.tobytes())

    def flush(hashes: list[np.ndarray], ids: list[np.ndarray]) -> pa.RecordBatch:
        h, i = np.concatenate(hashes), np.concatenate(ids)
        order = np.lexsort((i, h))
        h, i = h[order], i[order]
        new = np.r_[True, (h[1:] != h[:-1]) | (i[1:] != i[:-1])]
        h, i = h[new], i[new]
        first = np.r_[True, h[1:] != h[:-1]]
        confirmed = first & np.r_[h[1:] == h[:-1], False]
        bucket = np.where(first, (h % np.uint64(buckets)).astype(np.int64), -1 - (i % buckets))
        order = np.lexsort((i, bucket))
        h, i, confirmed, bucket = h[order], i[order], confirmed[order], bucket[order]
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        ends = np.r_[cuts[1:], len(h)]
        short = h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_HASH_BYTES]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[cuts].astype(np.int32)),
                pa.array([short[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                pa.array([pack(np.diff(i[a:b], prepend=np.int64(0))) for a, b in zip(cuts, ends)], pa.binary()),
                pa.array([pack(np.packbits(confirmed[a:b])) for a, b in zip(cuts, ends)], pa.binary()),
            ],
            names=["bucket", "hashes", "ids", "confirmed"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = 0
        for batch in batches:
            own = column(batch, "id").to_numpy()
            for row, _, data, offsets in text_chunks(column(batch, "text"), _CHUNK_BYTES):
                grams = gram_hashes(data, GRAM)
                _, at = anchored_windows(grams, offsets, LENGTH, GRAM)
                grams = _anchor_hashes(grams)
                at = at[np.r_[True, at[1:] != at[:-1]]] if len(at) else at
                hashes.append(grams[at])
                ids.append(own[row + np.searchsorted(offsets, at, side="right") - 1])
                held += len(at)
                if held >= _FLUSH_ANCHORS:
                    yield flush(hashes, ids)
                    hashes, ids, held = [], [], 0
        if held:
            yield flush(hashes, ids)

    return run


def _recurring(table: pa.Table) -> pa.Table:
    """``(id, anchor)`` of the anchors of one bucket that stand under two ids."""
    from zstandard import ZstdDecompressor

    def unpack(blob: bytes, kind: type) -> np.ndarray:
        return np.frombuffer(ZstdDecompressor().decompress(blob), kind)

    hashes, ids, confirmed = [], [], []
    for h, i, c in zip(*(table.column(n).to_pylist() for n in ("hashes", "ids", "confirmed"))):
        wide = np.zeros((len(h) // _HASH_BYTES, 8), np.uint8)
        wide[:, :_HASH_BYTES] = np.frombuffer(h, np.uint8).reshape(-1, _HASH_BYTES)
        hashes.append(wide.view("<u8").ravel())
        ids.append(np.cumsum(unpack(i, np.int64)))
        confirmed.append(np.unpackbits(unpack(c, np.uint8))[: len(hashes[-1])].astype(bool))
    h, i, c = np.concatenate(hashes), np.concatenate(ids), np.concatenate(confirmed)
    if table.column("bucket")[0].as_py() >= 0:
        order = np.argsort(h, kind="stable")
        h, i, c = h[order], i[order], c[order]
        begins = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        two = np.minimum.reduceat(i, begins) < np.maximum.reduceat(i, begins)
        two |= np.logical_or.reduceat(c, begins)
        keep = np.repeat(two, np.diff(np.r_[begins, len(h)]))
        h, i = h[keep], i[keep]
    return pa.table({"id": pa.array(i), "anchor": pa.array(h.view(np.int64))})


# --- spans -------------------------------------------------------------------------------

_SPANS = "range int, ids binary, keys binary, firsts binary, lengths binary, offsets binary, content binary"
# Column of a packed row, type of its numbers.
_PACKED = {"ids": "<i8", "keys": "<i8", "firsts": "<i4", "lengths": "u1", "offsets": "u1", "content": "u1"}
_LEAD = GRAM + 12


def _leads(data: np.ndarray, at: np.ndarray, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The order of spans as bytes: the anchor, the id, the place of the span."""
    lead = np.empty((len(at), _LEAD), np.uint8)
    lead[:, :GRAM] = data[at[:, None] + np.arange(GRAM)]
    lead[:, GRAM : GRAM + 8] = (ids.astype(np.int64) ^ np.int64(-(1 << 63))).astype(">i8").view(np.uint8).reshape(-1, 8)
    lead[:, GRAM + 8 :] = first.astype(">u4").view(np.uint8).reshape(-1, 4)
    return lead.view(f"S{_LEAD}").ravel()


def _splitters(known: DataFrame, size: int, ranges: int) -> np.ndarray:
    """Leads that divide the spans of all texts, recurring or not, into ``ranges`` equal parts.

    They come from a sample of the documents, some two hundred leads a range. Of the recurring spans
    a range has therefore no more than its part of all.
    """
    rate = min(1.0, _SAMPLED_LEADS * ranges * _BYTES_A_SPAN / max(size, 1))
    one_in = max(1, int(1 / (8 * rate)))
    share = min(1.0, rate * one_in)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = column(batch, "id").to_numpy()
            for row, _, data, offsets in text_chunks(column(batch, "text"), _CHUNK_BYTES):
                windows, at = anchored_windows(gram_hashes(data, GRAM), offsets, LENGTH, GRAM)
                first, _ = runs(at, windows)
                begin, at = windows[first], at[first]
                text = np.searchsorted(offsets, begin, side="right") - 1
                spread = mixed(own[row + text].astype(np.uint64) * np.uint64(1 << 32) + begin.astype(np.uint64))
                taken = (spread >> np.uint64(11)) < np.uint64(int(share * (1 << 53)))
                begin, at, text = begin[taken], at[taken], text[taken]
                leads = _leads(data, at, own[row + text], begin - offsets[text])
                yield pa.RecordBatch.from_arrays([pa.array([x.ljust(_LEAD, b"\0") for x in leads.tolist()], pa.binary())], names=["lead"])

    sampled = known.where(F.pmod(F.xxhash64("id", F.lit("range")), F.lit(one_in)) == 0)
    rows = sampled.select("id", "text").mapInArrow(run, "lead binary").collect()
    leads = np.sort(np.array([bytes(r["lead"]) for r in rows], f"S{_LEAD}"))
    return leads[np.arange(1, ranges) * len(leads) // ranges] if len(leads) else leads


def _spans(splitters: np.ndarray):
    """The spans around the anchors that each row names, packed by range."""
    from zstandard import ZstdCompressor

    def flush(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        number, ids, keys, firsts, lengths, offsets, sizes, content = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(number, kind="stable")
        number, sizes, starts = number[order], sizes[order], (np.cumsum(sizes) - sizes)[order]
        content = content[ragged(starts, sizes)]
        cuts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
        compress = ZstdCompressor(level=1).compress
        columns = dict(zip(_PACKED, (*(x[order] for x in (ids, keys, firsts, lengths, offsets)), content)))
        ends = np.r_[0, np.cumsum(sizes)]
        arrays = [pa.array(number[cuts].astype(np.int32))]
        for name, kind in _PACKED.items():
            bounds = np.r_[cuts, len(number)]
            bounds = ends[bounds] if name == "content" else bounds
            values = columns[name].astype(kind)
            arrays.append(pa.array([compress(values[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()))
        return pa.RecordBatch.from_arrays(arrays, names=["range", *_PACKED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0
        for batch in batches:
            ids, keys = (column(batch, c).to_numpy() for c in ("id", "key"))
            texts, wanted = column(batch, "text"), column(batch, "anchors")
            for row, end, data, offsets in text_chunks(unpacked(texts), _CHUNK_BYTES):
                grams = gram_hashes(data, GRAM)
                windows, at = anchored_windows(grams, offsets, LENGTH, GRAM)
                first, length = runs(at, windows)
                begin, at = windows[first], at[first]
                text = np.searchsorted(offsets, begin, side="right") - 1
                part = wanted.slice(row, end - row)
                owner = np.repeat(np.arange(end - row), np.diff(part.offsets.to_numpy()))
                asked = part.flatten().to_numpy().view(np.uint64)
                # A pair of text and anchor as one number; a wrong hit costs work, no result.
                sought = mixed(asked ^ mixed(owner.astype(np.uint64)))
                here = np.isin(mixed(_anchor_hashes(grams[at]) ^ mixed(text.astype(np.uint64))), sought)
                begin, at, length, text = begin[here], at[here], length[here], text[here]
                size = length - 1 + LENGTH
                place = begin - offsets[text]
                number = np.searchsorted(splitters, _leads(data, at, ids[row + text], place), side="right")
                held.append((number, ids[row + text], keys[row + text], place, length, at - begin, size, data[ragged(begin, size)]))
                count += len(begin)
                if count >= _FLUSH_SPANS:
                    yield flush(held)
                    held, count = [], 0
        if count:
            yield flush(held)

    return run


# --- sorting one range -------------------------------------------------------------------


def multikey_groups(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of the strings of ``length`` bytes at ``starts``, and where equal ones begin.

    Multikey quicksort with eight bytes as one key: sort by the first key, then the runs of
    equal keys by the next, until a run is one string or the strings end.
    """
    padded = np.r_[data, np.zeros(8, np.uint8)]
    order = np.arange(len(starts))
    group = np.zeros(len(starts), np.int64)  # first place of the run that holds a place
    open_ = np.arange(len(starts))  # places in runs of several strings
    for depth in range(0, length, 8):
        if not len(open_):
            break
        width = min(8, length - depth)
        at = starts[order[open_]] + depth
        keys = np.zeros(len(at), np.uint64)
        for k in range(width):
            keys = (keys << np.uint64(8)) | padded[at + k]
        rank = np.lexsort((keys, group[open_]))
        order[open_] = order[open_][rank]
        keys, own = keys[rank], group[open_]
        new = np.r_[True, (keys[1:] != keys[:-1]) | (own[1:] != own[:-1])]
        group[open_] = np.maximum.accumulate(np.where(new, open_, 0))
        alone = new & np.r_[new[1:], True]
        open_ = open_[~alone]
    return order, np.flatnonzero(group == np.arange(len(group)))


_FOUND = "id bigint, key bigint, first int, n int, anchor bigint, window bigint"


def _alike(data: np.ndarray, place: np.ndarray, size: np.ndarray, anchor: np.ndarray, offset: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of every span, and the row of its smallest id for every class.

    Spans of a class are equal, byte by byte. Equal ones whose hashes happen to lie between those of
    others may be in two classes.
    """
    hashes = span_hashes(data, place, place + size)
    by = np.lexsort((ids, hashes, size, offset, anchor))
    like = np.zeros(len(by), bool)
    like[1:] = True
    for x in (hashes, size, offset, anchor):
        like[1:] &= x[by[1:]] == x[by[:-1]]
    pair = np.flatnonzero(like)
    if len(pair):
        a, b, length = by[pair - 1], by[pair], size[by[pair]]
        differs = data[ragged(place[a], length)] != data[ragged(place[b], length)]
        like[pair] = ~np.logical_or.reduceat(differs, np.cumsum(length) - length)
    number = np.empty(len(by), np.int64)
    number[by] = np.cumsum(~like) - 1
    return number, by[~like]


def _sort_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes of one range that begin as one with a smaller id does, as ranges of places; and
    of the anchors at its borders those that do not, one by one, with hashes to compare them by.

    Equal spans have equal suffixes: one of each class is sorted, and none where an anchor has one class."""
    from zstandard import ZstdDecompressor

    # Column by column, and contents as bytes alone: a range is held once, not three times.
    expand = ZstdDecompressor().decompress
    held: dict[str, list[np.ndarray]] = {c: [] for c in _PACKED}
    for batch in batches:
        for name, parts in held.items():
            parts += [np.frombuffer(expand(x.as_py()), _PACKED[name]) for x in column(batch, name)]
    if not held["ids"]:
        return
    data = np.concatenate(held.pop("content"))
    ids, keys, first, n, offset = (np.concatenate(held.pop(c)).astype(np.int64, copy=False) for c in list(held))
    content = np.cumsum(n - 1 + LENGTH) - (n - 1 + LENGTH)

    # Rows by anchor, in portions of whole anchors.
    order, begins = multikey_groups(data, content + offset, GRAM)
    ends = np.r_[begins[1:], len(order)]
    done = np.cumsum(n[order])[ends - 1]
    portion = (done - 1) // _SORTED_SUFFIXES
    cuts = np.flatnonzero(np.r_[True, portion[1:] != portion[:-1]])
    for k, until in zip(cuts, np.r_[cuts[1:], len(begins)]):
        rows = order[begins[k] : ends[until - 1]]
        anchor = np.repeat(np.arange(until - k), ends[k:until] - begins[k:until])
        size = n[rows] - 1 + LENGTH
        own = data[ragged(content[rows], size)]
        place = np.cumsum(size) - size
        kind, example = _alike(own, place, size, anchor, offset[rows], ids[rows])

        # The first and the last anchor of the range, and those with spans of several classes.
        border = np.zeros(until - k, bool)
        border[[0] if k == 0 else []] = True
        border[[-1] if until == len(begins) else []] = True
        several = np.bincount(anchor[example], minlength=until - k) > 1
        several |= border

        # Of the other anchors a span recurs as a whole or not at all.
        whole = np.flatnonzero(~several[anchor] & (ids[rows] > ids[rows[example[kind]]]))

        sorted_ = example[several[anchor[example]]]
        starts = ragged(place[sorted_], n[rows[sorted_]])
        smallest = np.zeros(len(starts), np.int64)
        if len(starts):
            by_suffix, runs_begin = multikey_groups(own, starts, LENGTH)
            least = np.minimum.reduceat(np.repeat(ids[rows[sorted_]], n[rows[sorted_]])[by_suffix], runs_begin)
            smallest[by_suffix] = np.repeat(least, np.diff(np.r_[runs_begin, len(by_suffix)]))
        begin_of = np.zeros(len(example), np.int64)  # of a class in ``smallest``
        begin_of[kind[sorted_]] = np.cumsum(n[rows[sorted_]]) - n[rows[sorted_]]
        open_ = np.flatnonzero(several[anchor])
        row = np.repeat(open_, n[rows[open_]])
        within = ragged(np.zeros(len(open_), np.int64), n[rows[open_]])
        late = ids[rows[row]] > smallest[begin_of[kind[row]] + within]
        chosen = np.flatnonzero(late)
        start, length = runs(row[chosen], within[chosen])
        start = chosen[start]

        edge = np.flatnonzero(border[anchor[row]] & ~late)
        at = place[row[edge]] + offset[rows[row[edge]]]
        from_ = place[row[edge]] + within[edge]
        closed = np.arange(len(whole) + len(start) + len(edge)) < len(whole) + len(start)
        nothing = np.zeros(len(whole) + len(start), np.int64)
        hashes = [
            np.r_[nothing, span_hashes(own, x, x + width).view(np.int64)]
            for x, width in ((at, GRAM), (from_, LENGTH))
        ]
        found = rows[np.r_[whole, row[start], row[edge]]]
        shift = np.r_[np.zeros(len(whole), np.int64), within[start], within[edge]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids[found]),
                pa.array(keys[found]),
                pa.array((first[found] + shift).astype(np.int32)),
                pa.array(np.r_[n[rows[whole]], length, np.ones(len(edge), np.int64)].astype(np.int32)),
                *(pa.array(h, mask=closed) for h in hashes),
            ],
            names=["id", "key", "first", "n", "anchor", "window"],
        )


# --- the operator ------------------------------------------------------------------------


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept)`` of every row; kept is binary.

    Null and empty texts have no bytes; texts under ``LENGTH`` bytes lose nothing. Rows that
    repeat an id never count as each other's earlier document; rows without an id lose nothing
    and take nothing. Ids are integers. Other columns are left out, whatever their names; no rows
    give no rows. Texts of any length are read whole. The ranges found are checkpointed in the shared
    folder; nothing stays persisted.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.xxhash64(text_col).alias("key"),
        F.col(text_col).cast("binary").alias("text"),
    )
    size = text_bytes(rows, "text")
    buckets = bucket_count(spark, size)
    ranges = max(1, buckets // 2)
    known = rows.where(f"id IS NOT NULL AND octet_length(text) >= {LENGTH}")

    asked = known.select("id", "text").mapInArrow(
        _requests(buckets), "bucket int, hashes binary, ids binary, confirmed binary"
    )
    anchors = asked.groupBy("bucket").applyInArrow(_recurring, "id bigint, anchor bigint")

    # Texts equal to one with a smaller id.
    named = known.select("id", "key", F.md5("text").alias("digest"), F.octet_length("text").alias("size"))
    earliest = named.groupBy("digest").agg(F.min("id").alias("first_id"))
    copies = named.join(earliest, "digest").where("id > first_id").select("id", "key", "size").distinct()
    copies = copies.checkpoint()

    # Rows without an id are dealt by their text.
    kept = packed(rows).withColumn("slot", F.coalesce("id", "key"))
    kept = kept.repartition(buckets, "slot")
    per_id = (
        anchors.select(F.col("id").alias("slot"), "anchor", F.lit(None).cast("bigint").alias("copy"))
        .unionByName(copies.select(F.col("id").alias("slot"), F.lit(None).cast("bigint").alias("anchor"), F.col("key").alias("copy")))
        .groupBy("slot")
        .agg(F.collect_list("anchor").alias("anchors"), F.collect_set("copy").alias("copies"))
        .where(F.size("anchors") > 0)
    )
    wanted = kept.where("id IS NOT NULL").join(per_id, "slot").where("NOT array_contains(copies, key)")
    spans = wanted.select("id", "key", "text", "anchors").mapInArrow(_spans(_splitters(known, size, ranges)), _SPANS)
    found = spans.repartitionById(ranges, "range").mapInArrow(_sort_range, _FOUND).checkpoint()
    edge = found.where("anchor IS NOT NULL")
    least = edge.groupBy("anchor", "window").agg(F.min("id").alias("first_id"))
    across = edge.join(least, ["anchor", "window"]).where("id > first_id")

    whole = copies.select("id", "key", F.lit(0).alias("first"), (F.col("size") - LENGTH + 1).alias("n"))
    gone = (
        found.where("anchor IS NULL")
        .select("id", "key", "first", "n")
        .unionByName(across.select("id", "key", "first", "n"))
        .unionByName(whole)
        .groupBy(F.col("id").alias("slot"))
        .agg(F.collect_list("key").alias("keys"), F.collect_list("first").alias("firsts"), F.collect_list("n").alias("lengths"))
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, own, texts = (column(batch, c) for c in ("id", "key", "text"))
            lists = [column(batch, c) for c in ("keys", "firsts", "lengths")]
            for row, end, data, offsets in text_chunks(unpacked(texts), _CHUNK_BYTES):
                lost = np.zeros(len(data), bool)
                for i in np.flatnonzero(lists[0].slice(row, end - row).is_valid().to_numpy(zero_copy_only=False)):
                    # Rows that repeat an id with another text have ranges of their own.
                    keys, first, n = (x[row + i].values.to_numpy() for x in lists)
                    mine = keys == own[row + i].as_py()
                    size = int(offsets[i + 1] - offsets[i])
                    lost[offsets[i] : offsets[i + 1]] = covered(size, first[mine], n[mine] - 1 + LENGTH)
                begins = lost.copy()
                begins[1:] &= ~lost[:-1]
                inner = offsets[:-1][offsets[:-1] < len(data)]
                begins[inner] = lost[inner]
                before = np.r_[0, np.cumsum(lost)]
                starts = np.r_[0, np.cumsum(begins)]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(row, end - row),
                        pa.array(np.diff(offsets)),
                        pa.array(np.diff(before[offsets])),
                        pa.array(np.diff(starts[offsets])),
                        binary(data[~lost], offsets - before[offsets], pa.binary()),
                    ],
                    names=[id_col, "n_bytes", "n_removed", "n_spans", "kept"],
                )

    joined = kept.join(gone, "slot", "left").select("id", "key", "text", "keys", "firsts", "lengths")
    schema = T.StructType([T.StructField(id_col, T.LongType())] + T.StructType.fromDDL("n_bytes bigint, n_removed bigint, n_spans bigint, kept binary").fields)
    return joined.mapInArrow(remove, schema)
