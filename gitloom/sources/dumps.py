"""Readers for saved commits and pull requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gitloom.functions.text import repo_id_from_url, strip
from gitloom.schemas import PR_PAGE_ITEM, PRS
from gitloom.sources.paths import path_exists

_COMMIT_LINE = T.StructType(
    [
        T.StructField("commit_hash", T.StringType()),
        T.StructField("commit_ord", T.LongType()),
        T.StructField("message", T.StringType()),
        T.StructField("diff", T.StringType()),
        T.StructField("repo_id", T.StringType()),
    ]
)


def read_commit_dump(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Commits saved as JSON lines or Parquet, one ``repo_id=owner%2Frepo`` folder per repo.

    The schema is given, so Spark does not guess types: a hash such as ``12e4567``
    stays text.
    """
    return (
        spark.read.schema(_COMMIT_LINE)
        .format(fmt)
        .load(path)
        .select("repo_id", "commit_hash", "commit_ord", "message", "diff")
    )


def read_pr_pages(spark: SparkSession, path: str, whole_file: bool = True) -> DataFrame:
    """Pull requests from saved API pages: ``<path>/repo_id=owner%2Frepo/page=<n>/*``.

    A page is a JSON array. Pages that hold something else (an error object) and
    missing folders give no rows. ``pr_ord`` follows page and position.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], PRS)
    pages = (
        spark.read.schema("value string, repo_id string, page long")
        .option("wholetext", whole_file)
        .text(path)
    )
    # from_json would read a lone object as a list of one.
    is_list = F.startswith(strip(F.col("value")), F.lit("["))
    items = F.when(is_list, F.from_json("value", T.ArrayType(PR_PAGE_ITEM)))
    # Page sizes differ, so the position is kept in the low bits of the ordinal.
    return pages.select("repo_id", "page", F.posexplode(items).alias("pos", "pr")).select(
        "repo_id",
        F.col("pr.id").alias("pr_id"),
        (F.col("page") * (1 << 20) + F.col("pos")).alias("pr_ord"),
        F.col("pr.title").alias("title"),
        F.col("pr.body").alias("body"),
        F.col("pr.user.login").alias("user"),
        F.col("pr.created_at").alias("created_at"),
        F.col("pr.merged_at").alias("merged_at"),
    )


def split_rejects(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with every required field, and the rest with the names of what they lack."""
    lacking = F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in required]))
    tagged = df.withColumn("missing_fields", lacking)
    return (
        tagged.where(F.size("missing_fields") == 0).drop("missing_fields"),
        tagged.where(F.size("missing_fields") > 0),
    )


def normalise_commits(commits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fill the default of ``diff``; return (valid, rejected)."""
    valid, rejects = split_rejects(commits, ["repo_id", "commit_hash", "message"])
    return valid.withColumn("diff", F.coalesce("diff", F.lit(""))), rejects


def normalise_prs(prs: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_rejects(prs, ["pr_id", "title", "user", "created_at"])


def with_repo_from_url(df: DataFrame, url_col: str) -> DataFrame:
    return df.withColumn("repo_id", repo_id_from_url(F.col(url_col)))
