"""How far several summary runs disagree: pairs, scores, the largest gaps, a histogram."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from gitloom.operators import disagreement as ds
from gitloom.session import cut, scratch_scope
from gitloom.sources.tables import read_runs

PAIR = ["commit_hash", "source_1", "source_2"]


@dataclass(frozen=True)
class Analysis:
    pairs: DataFrame
    top: DataFrame
    statistics: DataFrame
    histogram: DataFrame


def analyse(
    runs: DataFrame, order: Sequence[str], drop: Sequence[str] = (), k: int = ds.TOP_PAIRS
) -> Analysis:
    """The whole chain over ``commit_hash, source_file, semantic_summary``.

    ``order`` says which row of a commit and run comes first; commits in ``drop`` are left
    out of every result. The pairs hold no text and are stored once for all results.
    """
    pairs = cut(ds.drop_commits(ds.run_pairs(runs, order), drop), "run-pairs")
    scored = ds.with_zscore(pairs)
    return Analysis(
        pairs=scored,
        top=ds.with_summaries(ds.top_pairs(scored, PAIR, k=k), runs, order),
        statistics=ds.distance_stats(pairs),
        histogram=ds.histogram(pairs),
    )


def run(
    spark: SparkSession,
    paths: Mapping[str, str],
    out_path: str,
    order: Sequence[str] = ("ord",),
    drop: Sequence[str] = (),
) -> None:
    """Write each result of :func:`analyse` over stored summary sets under ``out_path``."""
    with scratch_scope(spark):
        found = analyse(read_runs(spark, paths), order, drop)
        for name in ("pairs", "top", "statistics", "histogram"):
            getattr(found, name).write.mode("overwrite").parquet(f"{out_path}/{name}")
