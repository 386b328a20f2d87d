"""Resumable commit summaries: file diffs in, one summary per commit out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gitloom.operators.inference import MAX_RETRIES, Model, stub_model
from gitloom.operators.summarise import (
    COMMIT_KEYS,
    MAX_SYNTHESIS_LENGTH,
    NO_CHANGES,
    commit_attributes,
    merge_forks as merge_fork_rows,
    not_done,
    not_summarised,
    summarisable_files,
    summarise_files,
    summary_lines,
    synthesise,
)
from gitloom.operators.ordering import ordered_prefix
from gitloom.schemas import FILE_SUMMARIES, SUMMARIES
from gitloom.session import cut, scratch_scope
from gitloom.sources.paths import path_exists, remove, rename
from gitloom.sources.tables import append_summaries


def summarise_commits(
    file_diffs: DataFrame,
    stored_files: DataFrame,
    file_model: Model,
    commit_model: Model,
    max_retries: int = MAX_RETRIES,
    max_diff: int | None = None,
    limit: int = MAX_SYNTHESIS_LENGTH,
    retry_failed: bool = False,
    save_files=None,
) -> DataFrame:
    """Summaries of the given commits: the ``SUMMARIES`` columns, ``status``, ``error``.

    ``stored_files`` are file summaries of earlier, unfinished runs. ``save_files``
    receives the new ones before the synthesis starts and returns what was stored,
    so a crash after it costs no file call.
    """
    # Read for the scope, every level and the result; it holds no diff text.
    commits = cut(commit_attributes(file_diffs), "commit-attributes")
    files = not_done(summarisable_files(file_diffs, max_diff), stored_files, retry_failed)
    new = summarise_files(files, file_model, max_retries)
    new = save_files(new) if save_files else cut(new, "file-summaries")
    if retry_failed:
        kept = stored_files.where(F.col("status") == "completed")
    else:
        kept = stored_files
    # Stored summaries come first in a commit's list, new ones follow.
    scoped = kept.join(commits.select(*COMMIT_KEYS), COMMIT_KEYS, "left_semi")
    ordered = scoped.withColumn("run", F.lit(0)).unionByName(new.withColumn("run", F.lit(1)))
    lines = summary_lines(ordered.withColumn("file_ord", F.struct("run", "file_ord")))
    made = synthesise(lines, commits, commit_model, limit=limit, max_retries=max_retries)
    return commits.join(made, COMMIT_KEYS, "left").select(
        *COMMIT_KEYS,
        "commit_message",
        "pr_message",
        "pr_id",
        # No row from the synthesis means there was nothing to summarise.
        F.when(F.col("status").isNull(), NO_CHANGES).otherwise(F.col("value")).alias(
            "semantic_summary"
        ),
        F.lit(commit_model.name).alias("model"),
        F.coalesce("status", F.lit("completed")).alias("status"),
        "error",
    )


def run(
    spark: SparkSession,
    file_diffs: DataFrame,
    out_path: str,
    file_model: Model | None = None,
    commit_model: Model | None = None,
    retry_failed: bool = False,
    merge_forks: bool = False,
    **options,
) -> dict[str, int]:
    """Process the commits that ``out_path`` does not hold yet; return the counts.

    ``merge_forks`` takes one hash in several repositories as one commit.
    ``<out_path>/summaries`` takes finished commits, ``<out_path>/file_summaries`` the
    file stage. Failed commits are not written, so the next run tries them again.
    """
    with scratch_scope(spark):
        file_model = file_model or stub_model("file_summary")
        commit_model = commit_model or stub_model("semantic_summary")
        summary_path, stage_path = f"{out_path}/summaries", f"{out_path}/file_summaries"
        if merge_forks:
            file_diffs = merge_fork_rows(file_diffs)
        finish_compaction(spark, stage_path)
        if path_exists(spark, summary_path):
            summaries = spark.read.schema(SUMMARIES).parquet(summary_path)
        else:
            summaries = spark.createDataFrame([], SUMMARIES)
        if path_exists(spark, stage_path):
            stored = spark.read.schema(FILE_SUMMARIES).parquet(stage_path)
        else:
            stored = spark.createDataFrame([], FILE_SUMMARIES)
        todo = not_summarised(file_diffs, summaries)
        total = file_diffs.select(*COMMIT_KEYS).distinct().count()
        # The stage grows while it is read: fix what earlier runs left.
        stored = cut(stored, "stored")

        def save(new: DataFrame) -> DataFrame:
            fixed = cut(new, "new-files")
            fixed.write.mode("append").parquet(stage_path)
            return fixed

        made = cut(
            summarise_commits(
                todo,
                stored,
                file_model,
                commit_model,
                retry_failed=retry_failed,
                save_files=save,
                **options,
            ),
            "commits",
        )
        finished = made.where(F.col("status") == "completed")
        append_summaries(with_ordinal(finished, todo, summaries).select(*SUMMARIES.names), summary_path)
        compact_stage(spark, stage_path, finished)
        counts = {r["status"]: r["count"] for r in made.groupBy("status").count().collect()}
        processed, failed = counts.get("completed", 0), counts.get("failed", 0)
        return {"processed": processed, "skipped": total - processed - failed, "failed": failed}


def with_ordinal(finished: DataFrame, file_diffs: DataFrame, stored: DataFrame) -> DataFrame:
    """Add ``ord``: after all stored summaries, by repo and commit order."""
    last = stored.agg(F.max("ord")).first()[0]
    start = 0 if last is None else last + 1
    if "commit_ord" in file_diffs.columns:
        places = file_diffs.groupBy(*COMMIT_KEYS).agg(F.min("commit_ord").alias("__place"))
        placed = finished.join(places, COMMIT_KEYS, "left")
    else:
        placed = finished.withColumn("__place", F.lit(0))
    order = ["repo_id", "__place", "commit_hash"]
    ranked = ordered_prefix(placed.withColumn("__all", F.lit(0)), ["__all"], order, None, "__rank")
    return ranked.withColumn("ord", F.col("__rank") - 1 + start).drop("__all", "__place", "__rank", "running")


def compact_stage(spark: SparkSession, stage_path: str, finished: DataFrame) -> None:
    """Drop the file summaries of finished commits from the stage.

    What is left is written beside the stage and takes its place when it is complete, so
    a job that dies loses nothing.
    """
    if not path_exists(spark, stage_path):
        return
    stage = spark.read.schema(FILE_SUMMARIES).parquet(stage_path)
    left = stage.join(finished.select(*COMMIT_KEYS), COMMIT_KEYS, "left_anti")
    left.write.mode("overwrite").parquet(f"{stage_path}_next")
    finish_compaction(spark, stage_path)


def finish_compaction(spark: SparkSession, stage_path: str) -> None:
    """Let a complete new stage replace the old one; an incomplete one is left to be rewritten."""
    following = f"{stage_path}_next"
    if not path_exists(spark, f"{following}/_SUCCESS"):
        return
    remove(spark, stage_path)
    if spark.read.schema(FILE_SUMMARIES).parquet(following).isEmpty():
        remove(spark, following)
    else:
        rename(spark, following, stage_path)


def status_counts(made: DataFrame) -> DataFrame:
    return made.groupBy("status").agg(F.count("*").alias("n"))
