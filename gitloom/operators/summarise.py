"""File and commit summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gitloom.functions.prompts import file_prompt, synthesis_prompt
from gitloom.functions.text import (
    is_blank_stripped,
    strip,
    stripped_file_path,
    summary_line,
    truncate_diff,
)
from gitloom.operators.inference import MAX_RETRIES, Model, infer
from gitloom.operators.ordering import keep_first, ordered_prefix
from gitloom.operators.packing import pack_lines
from gitloom.session import cut

# --- fixed values ---
MAX_SYNTHESIS_LENGTH = 150_000
FAILED_FILE = "[Failed to summarize]"
NO_CHANGES = "No file changes to summarize."
# --- end of fixed values ---
COMMIT_KEYS = ["repo_id", "commit_hash"]


def commit_attributes(file_diffs: DataFrame) -> DataFrame:
    """One row per commit with the attributes of its first file row."""
    columns = ["repo_id", "commit_hash", "commit_message", "pr_message", "pr_id", "file_ord"]
    return keep_first(file_diffs.select(*columns), COMMIT_KEYS, ["file_ord"]).drop("file_ord")


def merge_forks(file_diffs: DataFrame) -> DataFrame:
    """Rows of one hash in several repositories as one commit of the first repository.

    Its files are numbered on: those of the first repository come first.
    """
    first = file_diffs.groupBy("commit_hash").agg(F.min("repo_id").alias("__repo"))
    ranked = ordered_prefix(file_diffs, ["commit_hash"], ["repo_id", "file_ord"], None, "__rank")
    merged = ranked.drop("running").join(first, "commit_hash").withColumns(
        {"repo_id": F.col("__repo"), "file_ord": (F.col("__rank") - 1).cast("int")}
    )
    return merged.select(*file_diffs.columns)


def distinct_commits(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count_distinct("commit_hash").alias("n_commits"))


def commit_sketches(rows: DataFrame, precision: int = 14) -> DataFrame:
    """``repo_id, sketch``: a small mergeable summary of each repository's commit hashes.

    Sketches of later loads are united with :func:`united`; null hashes do not count.
    """
    return rows.groupBy("repo_id").agg(F.hll_sketch_agg("commit_hash", precision).alias("sketch"))


def united(sketches: DataFrame) -> DataFrame:
    """One sketch of each repository from those of several loads."""
    return sketches.groupBy("repo_id").agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated_commits(sketches: DataFrame) -> DataFrame:
    """``repo_id, n_commits``, about one in a hundred off; exact counts are ``distinct_commits``."""
    return sketches.select("repo_id", F.hll_sketch_estimate("sketch").alias("n_commits"))


def row_totals(rows: DataFrame) -> DataFrame:
    """File rows and the commits that have them."""
    return rows.agg(F.count("*").alias("n_rows"), F.count_distinct("commit_hash").alias("n_commits"))


def commits_per_hash(file_diffs: DataFrame, merge_forks: bool = False) -> DataFrame:
    """File rows per commit; ``merge_forks`` groups by hash alone, as one commit
    that lives in several repositories."""
    keys = ["commit_hash"] if merge_forks else list(COMMIT_KEYS)
    return file_diffs.groupBy(*keys).agg(F.count("*").alias("n_files"))


def not_summarised(file_diffs: DataFrame, summaries: DataFrame) -> DataFrame:
    """File rows of commits that have no stored summary."""
    return file_diffs.join(summaries.select(*COMMIT_KEYS).distinct(), COMMIT_KEYS, "left_anti")


def summarisable_files(
    file_diffs: DataFrame, max_diff: int | None = None, disable_thinking: bool = True
) -> DataFrame:
    """Non-blank file rows with ``file_path``, ``truncated`` and the rendered ``prompt``.

    The whole diff goes into the prompt unless the caller gives ``max_diff``. The diff is
    stripped once, into a column that the rules read.
    """
    diff = F.col("__diff")
    text = diff if max_diff is None else truncate_diff(diff, max_diff)
    cut_short = F.lit(False) if max_diff is None else F.length(diff) > max_diff
    return (
        file_diffs.withColumn("__diff", strip(F.coalesce("diff", F.lit(""))))
        .where(~is_blank_stripped(diff))
        .withColumn("file_path", stripped_file_path(diff, F.col("file_ord")))
        .withColumn("truncated", cut_short)
        .withColumn("prompt", file_prompt(F.col("file_path"), text, disable_thinking))
        .drop("__diff")
    )


def not_done(files: DataFrame, file_summaries: DataFrame, retry_failed: bool = False) -> DataFrame:
    """Files without a stored summary. Two diffs of one path in one run both stay."""
    done = file_summaries.where(F.col("status") == "completed") if retry_failed else file_summaries
    keys = [*COMMIT_KEYS, "file_path"]
    return files.join(done.select(*keys).distinct(), keys, "left_anti")


def summarise_files(files: DataFrame, model: Model, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Summaries of rendered file prompts; a failure is a row, not an exception."""
    slim = files.select(*COMMIT_KEYS, F.col("file_ord").cast("long"), "file_path", "prompt")
    out = infer(slim, "prompt", "file_summary", model, max_retries)
    return out.select(
        *COMMIT_KEYS,
        "file_ord",
        "file_path",
        F.coalesce("value", F.lit(FAILED_FILE)).alias("summary"),
        "status",
        F.col("attempts").cast("int").alias("attempts"),
        "error",
        "model",
    )


def summary_lines(file_summaries: DataFrame) -> DataFrame:
    return file_summaries.select(
        *COMMIT_KEYS, "file_ord", summary_line(F.col("file_path"), F.col("summary")).alias("line")
    )


def synthesise(
    lines: DataFrame,
    messages: DataFrame,
    model: Model,
    keys: Sequence[str] = COMMIT_KEYS,
    ord_col: str = "file_ord",
    line_col: str = "line",
    limit: int = MAX_SYNTHESIS_LENGTH,
    max_retries: int = MAX_RETRIES,
    disable_thinking: bool = True,
) -> DataFrame:
    """Reduce each key's lines to one summary: ``keys, value, status, error, levels``.

    Each level is one job over the keys that are still too long: pack lines into
    chunks, summarise every chunk, and use the chunk summaries as the next lines.
    ``messages`` holds ``commit_message`` per key. A failed chunk fails its key, and so do
    summaries that are together no shorter than what they summarise: a level always makes
    a key smaller, so there is no fixed number of levels.
    """
    keys = list(keys)
    current = lines.select(*keys, F.col(ord_col).alias("ord"), F.col(line_col).alias("line"))
    finished, level = None, 0
    while True:
        level += 1
        chunks = pack_lines(current, keys, "ord", "line", limit).join(
            messages.select(*keys, "commit_message"), keys, "left"
        )
        prompts = chunks.select(
            *keys,
            "chunk_no",
            "fits",
            F.length("text").alias("chunk_chars"),
            synthesis_prompt(
                F.coalesce("commit_message", F.lit("")), F.col("text"), disable_thinking
            ).alias("prompt"),
        )
        answered = cut(
            infer(prompts, "prompt", "semantic_summary", model, max_retries)
            .drop("prompt", "reply")
            .withColumn("levels", F.lit(level)),
            "synthesis",
        )
        broken = (
            answered.where(F.col("status") == "failed")
            .groupBy(*keys)
            .agg(F.min("error").alias("error"))
        )
        final = answered.where((F.col("status") == "completed") & F.col("fits")).select(
            *keys, "value", "status", F.lit(None).cast("string").alias("error"), "levels"
        )
        failed = broken.select(
            *keys,
            F.lit(None).cast("string").alias("value"),
            F.lit("failed").alias("status"),
            "error",
            F.lit(level).alias("levels"),
        )
        left = answered.where(~F.col("fits")).join(broken.select(*keys), keys, "left_anti")
        chars = F.sum(F.length("value"))
        # Chunks cover all lines: their texts' length is that of the level before.
        stuck = left.groupBy(*keys).agg(chars.alias("now"), F.sum("chunk_chars").alias("before"))
        stuck = stuck.where("now >= before").select(*keys)
        endless = stuck.select(
            *keys,
            F.lit(None).cast("string").alias("value"),
            F.lit("failed").alias("status"),
            F.lit("summaries are too long and do not get shorter").alias("error"),
            F.lit(level).alias("levels"),
        )
        level_done = final.unionByName(failed).unionByName(endless)
        finished = level_done if finished is None else finished.unionByName(level_done)
        current = cut(
            left.join(stuck, keys, "left_anti").select(
                *keys, F.col("chunk_no").alias("ord"), F.col("value").alias("line")
            ),
            "level",
        )
        if current.isEmpty():
            return finished
