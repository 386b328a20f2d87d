"""Keep a collection current from a folder that summaries are appended to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gitloom.plans.load import load_frame
from gitloom.schemas import SUMMARIES


def stream_summaries(
    spark: SparkSession,
    source_path: str,
    root: str,
    checkpoint: str,
    schema: T.StructType = SUMMARIES,
    files_per_batch: int | None = None,
    reshape=None,
    **options,
):
    """Start a query that loads new files incrementally and stops when it has caught up.

    A batch that is replayed after a failure adds nothing twice: ids already in the
    collection are skipped. ``reshape`` maps the source columns to summary columns.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    summaries = reader.parquet(source_path)
    if reshape:
        summaries = reshape(summaries)

    def load(batch: DataFrame, _: int) -> None:
        load_frame(batch, root, "incremental", **options)

    return (
        summaries.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
