"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that a Python task holds at once (a single longer text is a batch of its own).
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(column: str = "text") -> list[Column]:
    """128 bits that name a text (null counts as empty): equal texts share them."""
    text = F.coalesce(F.col(column), F.lit(""))
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names in any letter case, so that they can be added."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def extended(schema: T.StructType, **added: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(n, t) for n, t in added.items()]])


def small_batches(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts have about ``limit`` bytes or are one text."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy()
        group = np.cumsum(sizes) // limit
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        for lo, hi in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(lo, hi - lo)


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The column's texts as UTF-8 bytes; null is empty."""
    return batch.column(column).cast(pa.binary()).fill_null(b"").to_pylist()


def with_columns(batch: pa.RecordBatch, **arrays: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*batch.columns, *arrays.values()], names=[*batch.schema.names, *arrays]
    )
