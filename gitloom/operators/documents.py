"""From summaries to collection documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gitloom.functions.text import has_text
from gitloom.operators.inference import BATCH_SIZE
from gitloom.operators.ordering import keep_first

EmbedClient = Callable[[list[str]], list[list[float]]]

STUB_DIMENSIONS = 64


@dataclass(frozen=True)
class Embedder:
    """``vector`` (expression over the text) or ``client`` (factory, called once per task)."""

    name: str
    client: Callable[[], EmbedClient] | None = None
    batch_size: int = BATCH_SIZE
    vector: Callable[[Column], Column] | None = None


@F.arrow_udf(returnType=T.ArrayType(T.FloatType()))
def _word_counts(text: pa.Array) -> pa.Array:
    """Hashed word counts, scaled to unit length; each different word of a batch is hashed once."""
    text = pc.replace_substring(text, "\n", " ")
    while pc.any(pc.match_substring(text, "  ")).as_py():
        text = pc.replace_substring(text, "  ", " ")
    words = pc.split_pattern(text, " ")
    coded = words.flatten().dictionary_encode()
    slot = np.array([md5(w.encode()).digest()[1] % STUB_DIMENSIONS for w in coded.dictionary.to_pylist()], dtype=np.int64)
    row = np.repeat(np.arange(len(words)), pc.fill_null(pc.list_value_length(words), 0).to_numpy())
    place = row * STUB_DIMENSIONS + slot[coded.indices.to_numpy()]
    counts = np.bincount(place, minlength=len(words) * STUB_DIMENSIONS).reshape(-1, STUB_DIMENSIONS)
    lengths = np.sqrt((counts * counts).sum(1, keepdims=True))
    scaled = (counts / np.where(lengths == 0, 1.0, lengths)).astype(np.float32).ravel()
    # A missing text has a vector of missing numbers.
    missing = np.repeat(words.is_null().to_numpy(zero_copy_only=False), STUB_DIMENSIONS)
    ends = np.arange(0, len(scaled) + 1, STUB_DIMENSIONS, dtype=np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(scaled, mask=missing))


def stub_embedder() -> Embedder:
    """Offline stand-in: hashed word counts."""
    return Embedder("stub", vector=_word_counts)


def valid_summaries(df: DataFrame, column: str = "semantic_summary") -> DataFrame:
    return df.where(has_text(F.col(column)))


def prepare_documents(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per commit hash: the first in ``order`` that has a summary."""
    return keep_first(valid_summaries(df), ["commit_hash"], order)


def metadata_map() -> Column:
    """Repo, hash and message always; pull request fields only when present."""
    always = ["repo_id", "commit_hash", "commit_message"]
    entries: list[Column] = []
    for name in always:
        entries += [F.lit(name), F.coalesce(F.col(name).cast("string"), F.lit(""))]
    for name in ("pr_message", "pr_id"):
        entries += [F.lit(name), F.col(name).cast("string")]
    return F.map_filter(F.create_map(*entries), lambda _, value: value.isNotNull())


def metadata_value(key: str, column: str = "metadata") -> Column:
    return F.coalesce(F.try_element_at(F.col(column), F.lit(key)), F.lit(""))


def embed_column(df: DataFrame, text_col: str, embedder: Embedder) -> DataFrame:
    """Add ``embedding``; a client sees slices of ``batch_size`` texts in row order."""
    if embedder.vector is not None:
        return df.withColumn("embedding", embedder.vector(F.col(text_col)))
    schema = T.StructType([*df.schema.fields, T.StructField("embedding", T.ArrayType(T.FloatType()))])
    factory, size = embedder.client, embedder.batch_size

    def embed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = factory()
        for batch in batches:
            for start in range(0, len(batch), size):
                part = batch.iloc[start : start + size].copy()
                vectors = client(part[text_col].tolist())
                if len(vectors) != len(part):
                    raise ValueError(f"{len(vectors)} vectors for {len(part)} texts")
                part["embedding"] = list(vectors)
                yield part

    return df.mapInPandas(embed, schema)


def to_collection(docs: DataFrame, embedder: Embedder) -> DataFrame:
    """``id, document, embedding, metadata`` of prepared summaries."""
    slim = docs.select(
        F.col("commit_hash").alias("id"),
        F.col("semantic_summary").alias("document"),
        metadata_map().alias("metadata"),
    )
    return embed_column(slim, "document", embedder).select("id", "document", "embedding", "metadata")


def unseen(docs: DataFrame, ids: DataFrame, key: str = "commit_hash") -> DataFrame:
    """Documents whose id is not in ``ids``."""
    return docs.join(ids.select(F.col("id").alias(key)), key, "left_anti")


def id_difference(docs: DataFrame, ids: DataFrame, key: str = "commit_hash") -> DataFrame:
    """``id`` of the documents that ``ids`` does not hold, each of a repeated id counted off once."""
    return docs.select(F.col(key).alias("id")).exceptAll(ids.select("id"))


def dimensions(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Number of vectors per dimension; more than one row means a mixed collection."""
    return df.groupBy(F.size(column).alias("dim")).agg(F.count("*").alias("n"))


def require_one_dimension(df: DataFrame, column: str = "embedding") -> int:
    bounds = df.agg(F.min(F.size(column)), F.max(F.size(column))).first()
    if bounds[0] != bounds[1]:
        raise ValueError(f"embeddings have mixed dimensions: {bounds[0]} to {bounds[1]}")
    return bounds[0]
