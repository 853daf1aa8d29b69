"""Texts compressed one by one while they are shuffled.

Text takes most of a shuffle that moves documents, and the block compression of shuffle files
does little for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.arrays import column


def packed(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the text (string or binary) as compressed binary; null stays null."""
    names = df.columns
    schema = T.StructType(
        [T.StructField(f.name, T.BinaryType() if f.name == text_col else f.dataType) for f in df.schema]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdCompressor

        compress = ZstdCompressor(level=1).compress
        for batch in batches:
            raw = column(batch, text_col).cast(pa.binary()).to_pylist()
            small = pa.array([None if r is None else compress(r) for r in raw], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [small if n == text_col else column(batch, n) for n in names], names=names
            )

    return df.mapInArrow(run, schema)


def unpacked(texts: pa.Array) -> pa.Array:
    """The bytes of packed texts; null stays null."""
    from zstandard import ZstdDecompressor

    expand = ZstdDecompressor().decompress
    return pa.array([None if t is None else expand(t) for t in texts.to_pylist()], pa.large_binary())
