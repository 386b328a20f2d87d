"""Categorise a collection: batches, discovery, merge, assignment, roll-up, sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gitloom.operators import categories as ct
from gitloom.operators.batches import SUMMARIES_PER_BATCH, kmeans_batches
from gitloom.operators.inference import Model
from gitloom.session import cut, scratch_scope
from gitloom.sources.collection import read_collection
from gitloom.sources.paths import path_exists, remove
from gitloom.sources.tables import write_by_category


def stage(
    spark: SparkSession, root: str, name: str, build: Callable[[], DataFrame], overwrite: bool = False
) -> DataFrame:
    """The stored result of a stage, building and storing it when it is not complete.

    A stage counts once its ``_SUCCESS`` marker exists.
    """
    path = f"{root}/stages/{name}"
    if overwrite or not path_exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return spark.read.parquet(path)


def clear_stages(spark: SparkSession, root: str) -> None:
    remove(spark, f"{root}/stages")


def with_batches(collection: DataFrame, batches: DataFrame) -> DataFrame:
    """``batch, ord, text`` of every document; the id gives the order inside a batch."""
    return collection.select("id", "document").join(batches, "id").select(
        "batch", F.col("id").alias("ord"), F.col("document").alias("text")
    )


def categorise(
    spark: SparkSession,
    collection_root: str,
    work_root: str,
    discovery: Model | None = None,
    merge: Model | None = None,
    assignment: Model | None = None,
    batches: DataFrame | None = None,
    per_batch: int = SUMMARIES_PER_BATCH,
    overwrite_stages: bool = False,
    other_off_list: bool = False,
) -> DataFrame:
    """Categorised rows. Finished stages of an interrupted run are reused.

    Only answers are stored: a document whose assignment failed is asked for again, once
    in this run, and if it fails again the job ends with the stages kept. Answers that are
    not on the list stay as given, or become ``Other`` with ``other_off_list``.
    Without models the offline stand-ins run. Assignments are stored by id: when the
    collection grew since, only the new documents are assigned.
    """
    collection = read_collection(spark, collection_root)

    def build_discovered() -> DataFrame:
        grouped = with_batches(
            collection, batches if batches is not None else kmeans_batches(collection, per_batch)
        )
        found = ct.discover(grouped, discovery) if discovery else ct.discover_terms(grouped)
        return ct.in_batch_order(found)

    discovered = stage(spark, work_root, "discovered", build_discovered, overwrite_stages)

    def build_merged() -> DataFrame:
        return ct.merge_with_model(discovered, merge) if merge else ct.merge_spellings(discovered)

    merged = stage(spark, work_root, "merged", build_merged, overwrite_stages)

    def assign(docs: DataFrame) -> DataFrame:
        if assignment:
            answered = cut(ct.assign(docs, merged, assignment), "assigned")
            found = answered.where("status = 'completed'").select("id", "category")
        else:
            found = ct.assign_by_words(docs, merged)
        return ct.flag_off_list(found, merged).select("id", "category", "off_list")

    docs = collection.select("id", "document")
    assigned = stage(spark, work_root, "assigned", lambda: assign(docs), overwrite_stages)
    missing = docs.join(assigned.select("id"), "id", "left_anti")
    if not missing.isEmpty():
        # Later documents join the same stage table, so they too are asked for once.
        cut(assign(missing), "late").write.mode("append").parquet(f"{work_root}/stages/assigned")
        assigned = spark.read.parquet(f"{work_root}/stages/assigned")
        lost = docs.join(assigned.select("id"), "id", "left_anti").count()
        if lost:
            raise ValueError(f"{lost} documents got no category; the stages are kept in {work_root}")
    if other_off_list:
        listed = F.when(F.col("off_list"), F.lit(ct.OTHER)).otherwise(F.col("category"))
        assigned = assigned.withColumn("category", listed)
    counted = collection.select("id").join(assigned.select("id", "category"), "id")
    return ct.categorised(collection, ct.roll_up_rare(assigned, counted=counted))


def run(spark: SparkSession, collection_root: str, out_path: str, **options) -> None:
    work = f"{out_path}_work"
    with scratch_scope(spark):
        write_by_category(categorise(spark, collection_root, work, **options), out_path)
    clear_stages(spark, work)
