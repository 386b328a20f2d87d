"""Parquet and CSV tables: checked scans and partitioned sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gitloom.session import observed
from gitloom.sources.paths import path_exists, remove

# Upper bound on the rows of one file, so that a large partition is many files.
ROWS_PER_FILE = 1_000_000


def read_checked(
    spark: SparkSession, path: str, required: Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """Scan a Parquet table after checking that it exists and has ``required`` columns."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Input not found: {path}")
    reader = spark.read.schema(schema) if schema else spark.read
    df = import_view(reader.parquet(path))
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def read_file_diffs(spark: SparkSession, path: str) -> DataFrame:
    return read_checked(spark, path, ["commit_hash", "commit_message", "diff"])


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    return read_checked(spark, path, ["commit_hash", "semantic_summary"])


def _by_folder(df: DataFrame, folder: str) -> DataFrame:
    """Rows of a folder together: Spark splits large folders and joins small ones by bytes
    (``advisoryPartitionSizeInBytes``), so files do not multiply with tasks."""
    return df.hint("rebalance", folder)


def write_by_repo(df: DataFrame, path: str) -> bool:
    """Replace the partitions of the repos in ``df``; write nothing, and say so, without rows.

    Only the repos present are overwritten, so a rerun does not add rows twice. The rows
    are counted while they are written, so ``df`` is evaluated once.
    """
    spark, seen = df.sparkSession, Observation()
    existed = path_exists(spark, path)
    (
        _by_folder(df.observe(seen, F.count(F.lit(1)).alias("n")), "repo_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy("repo_id")
        .parquet(path)
    )
    written = (observed(seen) or {"n": 0})["n"] > 0
    if not written and not existed:
        remove(spark, path)
    return written


def append_summaries(df: DataFrame, path: str, per_commit_folders: bool = False) -> None:
    """Append commit summaries, partitioned by repo.

    One folder per commit is only for readers that insist on it: at scale it means
    as many files as commits.
    """
    folders = ["repo_id", "commit_hash"] if per_commit_folders else ["repo_id"]
    _by_folder(df, folders[-1]).write.mode("append").partitionBy(*folders).parquet(path)


def write_by_category(df: DataFrame, path: str) -> None:
    """Folder per category with ``/`` written as ``_``; rows without category are dropped.

    The category stays a column, so ``A/B`` and ``A_B`` share a folder but not a name.
    """
    kept = df.where(F.col("category").isNotNull())
    folders = kept.withColumn("category_dir", F.replace("category", F.lit("/"), F.lit("_")))
    (
        _by_folder(folders, "category_dir")
        .write.mode("overwrite")
        # A rerun may move commits to other categories: old folders must go.
        .option("partitionOverwriteMode", "static")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy("category_dir")
        .parquet(path)
    )


def read_category(spark: SparkSession, path: str, category: str, schema: T.StructType) -> DataFrame:
    """Rows of one category folder; only that partition is scanned."""
    full = T.StructType([*schema.fields, T.StructField("category_dir", T.StringType())])
    return (
        spark.read.schema(full)
        .parquet(path)
        .where(F.col("category_dir") == category.replace("/", "_"))
        .drop("category_dir")
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV whose fields may hold line ends and doubled quotes (diffs do)."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("quoteAll", True)
        .csv(path)
    )


def write_csv_sample(df: DataFrame, order: Sequence[str], n: int, path: str) -> None:
    """The first ``n`` rows in ``order`` as CSV."""
    write_csv(head(df, order, n), path)


def head(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def read_runs(
    spark: SparkSession, runs: Mapping[str, str], schema: T.StructType | None = None
) -> DataFrame:
    """Summary sets of several runs, each row tagged with the run it came from."""
    frames = []
    for source, path in runs.items():
        reader = spark.read.schema(schema) if schema else spark.read
        frames.append(reader.parquet(path).withColumn("source_file", F.lit(source)))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def append_repos(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all repos in one frame."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


EXPORT_NAMES = {
    "repo_id": "Repo ID",
    "commit_hash": "commit hash",
    "commit_message": "commit message",
    "pr_message": "PR message",
    "pr_id": "PR ID",
}


def import_view(df: DataFrame) -> DataFrame:
    """The columns of :data:`EXPORT_NAMES` under their own names again; others stay."""
    spaced = {v: k for k, v in EXPORT_NAMES.items() if v in df.columns and k not in df.columns}
    return df.withColumnsRenamed(spaced)


def export_view(df: DataFrame) -> DataFrame:
    """Spaced column names for readers of the older table layout."""
    return df.withColumnsRenamed({k: v for k, v in EXPORT_NAMES.items() if k in df.columns})
