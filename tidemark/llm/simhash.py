"""Near duplicates by SimHash fingerprints, compared exactly in tiles.

A fingerprint has a bit for every bit position that more than half of the text's shingle
hashes set. Two texts are linked at ``radius`` or fewer differing bits.

Linking is exact. Equal fingerprints are one row from the start, so groups of copies cost one
row. The different fingerprints are cut into tiles of bounded size by their number of set bits,
which can differ by at most ``radius`` between two linked ones: only tile pairs within that
distance are compared, by exclusive-or and bit counts on numpy arrays. Inside a pair the rows
are sorted by the bit counts of their four 16-bit lanes, and blocks whose lane counts lie
further apart than ``radius`` in sum are skipped as well. A pair of tiles returns a spanning
forest of its links, never all of them.

The comparisons grow with the square of the number of different fingerprints. The memory of a
task does not: it holds two tiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import column
from tidemark.llm.components import connected_components
from tidemark.scratch import ensure_checkpoint_dir

BITS = 64
RADIUS = 3
SHINGLE_WORDS = 3
TILE_ROWS = 16_384
MAX_TILE_ROWS = 262_144
_TILES = 48
_BLOCK = 256


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of UTF-8 text; ASCII letters are lower-cased, no words give zero."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    width = min(shingle_words, len(words))
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    hashes = np.array([xxh64_intdigest(joined[s:e], 42) for s, e in spans], ">u8")
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 65_536):
        part = hashes[k : k + 65_536]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp)`` of every row, fp as a signed 64-bit number."""
    narrow = docs.select(F.col(id_col), F.col(text_col).cast("binary").alias(text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column(batch, text_col)
            found = [fingerprint(t.as_py() or b"") for t in texts]
            fps = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([column(batch, id_col), pa.array(fps)], names=[id_col, "fp"])

    return narrow.mapInArrow(run, T.StructType([narrow.schema[0], T.StructField("fp", T.LongType())]))


def components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS
) -> DataFrame:
    """``(id, fp, component_id)`` of every row.

    ``component_id`` is the smallest id reachable over links, null only where no row of the
    component has an id. Null and empty texts and texts without a word have fingerprint zero,
    linked like any other. Repeated rows stay; no rows give no rows; other columns are left out.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    fps = fingerprints(docs, id_col, text_col).checkpoint()
    different = fps.groupBy("fp").agg(F.min(id_col).alias("first")).checkpoint()
    roots = connected_components(links(different.select("fp"), radius))
    rooted = different.join(roots, different["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return fps.join(rooted.join(least, "root").select("fp", "component_id"), "fp").select(
        id_col, "fp", "component_id"
    )


def links(different: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs ``(a, b)`` of different fingerprints that connect all that are linked."""
    spark = different.sparkSession
    ones = F.bit_count("fp")
    counts = {r["ones"]: r["n"] for r in different.groupBy(ones.alias("ones")).agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    rows = min(max(TILE_ROWS, total // _TILES), MAX_TILE_ROWS)

    # At most 65 bit counts: neighbouring small ones share a tile, large ones are divided.
    bounds: list[tuple[int, int]] = []
    ranges: list[tuple[int, int, int, int]] = []  # bit counts, first tile, number of tiles
    ones_list = sorted(counts)
    k = 0
    while k < len(ones_list):
        low, held = ones_list[k], counts[ones_list[k]]
        while k + 1 < len(ones_list) and held + counts[ones_list[k + 1]] <= rows:
            k += 1
            held += counts[ones_list[k]]
        parts = -(-held // rows)
        ranges.append((low, ones_list[k], len(bounds), parts))
        bounds += [(low, ones_list[k])] * parts
        k += 1
    if not bounds:
        return spark.createDataFrame([], "a bigint, b bigint")

    tile = F.lit(None).cast("int")
    for low, high, first, parts in ranges:
        share = F.lit(first) + F.pmod(F.xxhash64("fp"), F.lit(parts)).cast("int")
        tile = F.when(ones.between(low, high), share).otherwise(tile)
    # A tile holds MAX_TILE_ROWS fingerprints, 2 MB, in the mean.
    tiles = different.groupBy(tile.alias("tile")).agg(F.sort_array(F.collect_list("fp")).alias("fps")).checkpoint()
    pairs = [
        (i, j)
        for i in range(len(bounds))
        for j in range(i, len(bounds))
        if bounds[j][0] - bounds[i][1] <= radius and bounds[i][0] - bounds[j][1] <= radius
    ]
    wanted = spark.createDataFrame(pairs, "left int, right int")
    left = tiles.select(F.col("tile").alias("left"), F.col("fps").alias("a"))
    right = tiles.select(F.col("tile").alias("right"), F.col("fps").alias("b"))
    dealt = wanted.join(left, "left").join(right, "right").repartition(len(pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                a, b = (column(batch, c)[k].values.to_numpy(zero_copy_only=False) for c in ("a", "b"))
                same = column(batch, "left")[k].as_py() == column(batch, "right")[k].as_py()
                x, y = tile_links(a.view(np.uint64), b.view(np.uint64), same, radius)
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], names=["a", "b"])

    return dealt.mapInArrow(run, "a bigint, b bigint")


def tile_links(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles, or within one if ``same``."""
    a, a_low, a_high = _blocks(a)
    b, b_low, b_high = (a, a_low, a_high) if same else _blocks(b)
    nodes = a if same else np.r_[a, b]
    base = 0 if same else len(a)
    label = np.arange(len(nodes))
    for k in range(len(a_low)):
        gap = np.maximum(b_low - a_high[k], a_low[k] - b_high).clip(0).sum(axis=1)
        x = a[k * _BLOCK : (k + 1) * _BLOCK, None]
        for m in np.flatnonzero(gap <= radius):
            if same and m < k:
                continue
            near = np.bitwise_count(x ^ b[m * _BLOCK : (m + 1) * _BLOCK]) <= radius
            i, j = np.nonzero(near)
            i, j = i + k * _BLOCK, j + m * _BLOCK + base
            apart = label[i] != label[j]
            if apart.any():
                _unite(label, i[apart], j[apart])
    held = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[held], nodes[label[held]]


def _blocks(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows sorted by the bit counts of their lanes, and the bounds of every block."""
    lanes = np.bitwise_count(np.ascontiguousarray(fps).view(np.uint16).reshape(-1, 4)).astype(np.int16)
    order = np.lexsort(lanes.T[::-1])
    lanes = lanes[order]
    begins = np.arange(0, len(fps), _BLOCK)
    return fps[order], np.minimum.reduceat(lanes, begins), np.maximum.reduceat(lanes, begins)


def _unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the trees of every pair; afterwards each label is its tree's root again."""
    while True:
        x, y = label[i], label[j]
        low, high = np.minimum(x, y), np.maximum(x, y)
        open_ = low != high
        if not open_.any():
            return
        i, j = i[open_], j[open_]
        np.minimum.at(label, high[open_], low[open_])
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component; columns unchanged.

    Rows that repeat an id are one document and stay together, as do rows without an id.
    """
    dropped = components(docs, id_col, text_col).where(F.col(id_col) != F.col("component_id"))
    return docs.join(dropped.select(id_col).distinct(), id_col, "left_anti").select(docs.columns)
