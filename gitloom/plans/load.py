"""Load summaries into the collection, in full or incrementally."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gitloom.operators.documents import (
    Embedder,
    prepare_documents,
    stub_embedder,
    to_collection,
    unseen,
    valid_summaries,
)
from gitloom.session import cut, scratch_scope
from gitloom.sources import collection as store
from gitloom.sources.tables import read_summaries

OPTIONAL_COLUMNS = {"repo_id": "string", "commit_message": "string", "pr_message": "string", "pr_id": "long"}


def load_frame(
    summaries: DataFrame,
    root: str,
    mode: str = "full",
    embedder: Embedder | None = None,
    order: Sequence[str] | None = None,
) -> int:
    """Returns the number of documents written. With nothing to load, nothing is dropped.

    The first summary of a commit in ``order`` is loaded, by default in the ordinal that
    the summaries were stored with (``ord``). A table without it must not repeat a commit.
    """
    if mode not in ("full", "incremental"):
        raise ValueError(f"unknown mode: {mode}")
    for name, kind in OPTIONAL_COLUMNS.items():
        if name not in summaries.columns:
            summaries = summaries.withColumn(name, F.lit(None).cast(kind))
    spark = summaries.sparkSession
    if order is None and "ord" in summaries.columns:
        order = ["ord"]
    if order is None:
        repeated = valid_summaries(summaries).groupBy("commit_hash").count().where("count > 1")
        if not repeated.isEmpty():
            raise ValueError("commits repeat and no column 'ord' says which row comes first: pass order")
        order = ["commit_hash"]
    docs = prepare_documents(summaries, order)
    if mode == "incremental":
        docs = unseen(docs, store.existing_ids(spark, root))
    with scratch_scope(spark):
        # The embedding calls are made once, here; counting and writing read the stored result.
        ready = cut(to_collection(docs, embedder or stub_embedder()), "documents")
        n = ready.count()
        if n:
            if mode == "full":
                store.replace_all(ready, root, stored=True)
            else:
                store.append_new(ready, root)
    return n


def load_summaries(spark: SparkSession, input_path: str, root: str, mode: str = "full", **options) -> int:
    return load_frame(read_summaries(spark, input_path), root, mode, **options)
