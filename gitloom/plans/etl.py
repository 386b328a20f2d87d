"""Commits and pull requests in, one row per changed file out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gitloom.functions.text import sanitize_utf8
from gitloom.operators.file_diffs import explode_files
from gitloom.operators.linking import with_pull_request
from gitloom.session import scratch_scope
from gitloom.sources.dumps import normalise_commits, normalise_prs, read_commit_dump, read_pr_pages
from gitloom.sources.tables import write_by_repo


def build_file_diffs(commits: DataFrame, prs: DataFrame, drop_preamble: bool = False) -> DataFrame:
    """The whole transformation; no Python workers.

    Only hashes and ids take part in the link; the diff texts move once at most, in
    the final left join, and not at all when the stored link table is small enough
    for Spark to broadcast it.
    """
    commits, _ = normalise_commits(commits)
    prs, _ = normalise_prs(prs)
    rows = explode_files(with_pull_request(commits, prs), drop_preamble=drop_preamble)
    return rows.select(
        "repo_id",
        "commit_hash",
        "commit_ord",
        "file_ord",
        sanitize_utf8(F.col("message")).alias("commit_message"),
        sanitize_utf8(F.col("diff")).alias("diff"),
        sanitize_utf8(F.col("pr_message")).alias("pr_message"),
        "pr_id",
    )


def rejected_rows(commits: DataFrame, prs: DataFrame) -> DataFrame:
    """``kind, repo_id, id, missing_fields`` of the rows that the ETL cannot take."""
    _, bad_commits = normalise_commits(commits)
    _, bad_prs = normalise_prs(prs)

    def named(rows: DataFrame, kind: str, key: str) -> DataFrame:
        return rows.select(
            F.lit(kind).alias("kind"), "repo_id", F.col(key).cast("string").alias("id"), "missing_fields"
        )

    return named(bad_commits, "commit", "commit_hash").unionByName(
        named(bad_prs, "pull request", "pr_id")
    )


def run(
    spark: SparkSession, commit_path: str, pr_path: str, out_path: str, commit_format: str = "json"
) -> dict[str, int | bool]:
    """``written`` (were there rows) and ``rejected``, the number of rows in ``<out>_rejects``."""
    commits = read_commit_dump(spark, commit_path, commit_format)
    prs = read_pr_pages(spark, pr_path)
    rejects = f"{out_path}_rejects"
    with scratch_scope(spark):
        rejected_rows(commits, prs).write.mode("overwrite").parquet(rejects)
        written = write_by_repo(build_file_diffs(commits, prs), out_path)
    return {"written": written, "rejected": spark.read.parquet(rejects).count()}
