"""Link commits to the pull requests that mention them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gitloom.functions.text import commit_hash_tokens, pr_search_text
from gitloom.session import cut

# Every token has at least this many digits, so an equi-join on the prefix loses nothing.
PREFIX = 7


def pr_hash_tokens(prs: DataFrame) -> DataFrame:
    """One row per (repo, token): the first pull request in list order that names it.

    Taking the minimum here, before the join, is exact because a later request can
    never win for the same token, and it folds a token quoted by very many requests.
    """
    tokens = prs.select(
        "repo_id",
        F.explode(commit_hash_tokens(pr_search_text(F.col("title"), F.col("body")))).alias("token"),
        "pr_ord",
        "pr_id",
    )
    return tokens.groupBy("repo_id", "token").agg(
        F.min(F.struct("pr_ord", "pr_id")).alias("first_pr")
    )


def match_commits(commits: DataFrame, prs: DataFrame) -> DataFrame:
    """All (commit, token) matches: ``commit_hash`` starts with the token, same repo."""
    hashes = commits.select("repo_id", "commit_hash").distinct()
    left = hashes.withColumn("prefix", F.left("commit_hash", F.lit(PREFIX)))
    right = pr_hash_tokens(prs).withColumn("prefix", F.left("token", F.lit(PREFIX)))
    return left.join(right, ["repo_id", "prefix"]).where(
        F.startswith("commit_hash", F.col("token"))
    )


def first_pr_per_commit(commits: DataFrame, prs: DataFrame) -> DataFrame:
    """``repo_id, commit_hash, pr_id, pr_ord`` for every linked commit."""
    return (
        match_commits(commits, prs)
        .groupBy("repo_id", "commit_hash")
        .agg(F.min("first_pr").alias("first_pr"))
        .select("repo_id", "commit_hash", "first_pr.pr_id", "first_pr.pr_ord")
    )


def with_pull_request(commits: DataFrame, prs: DataFrame) -> DataFrame:
    """Left-outer enrichment: ``pr_message`` and ``pr_id`` are null when nothing matches.

    The link table is written first, so Spark plans the last join with its true size:
    below the broadcast threshold the diff texts are not shuffled at all.
    """
    bodies = prs.select("repo_id", "pr_ord", "pr_id", F.col("body").alias("pr_message"))
    linked = cut(
        first_pr_per_commit(commits, prs)
        .join(bodies, ["repo_id", "pr_ord", "pr_id"])
        .select("repo_id", "commit_hash", "pr_message", "pr_id"),
        "links",
    )
    return commits.join(linked, ["repo_id", "commit_hash"], "left")
