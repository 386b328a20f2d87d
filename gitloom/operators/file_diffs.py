"""Explode commits to one row per changed file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gitloom.functions.text import file_pieces


def explode_files(
    commits: DataFrame, diff_col: str = "diff", drop_preamble: bool = False
) -> DataFrame:
    """Replace ``diff`` by one piece per row and add ``file_ord`` (0-based).

    A commit without pieces keeps one row with an empty diff. ``drop_preamble``
    removes pieces that hold no diff lines, such as the header of a root commit.
    """
    pieces = file_pieces(F.col(diff_col))
    if drop_preamble:
        pieces = F.filter(pieces, lambda p: p.rlike(r"(?md)^(?:--- |\+\+\+ |@@)"))
    others = [c for c in commits.columns if c != diff_col]
    return (
        commits.withColumn("__pieces", pieces)
        .select(
            *others,
            F.posexplode(
                F.when(F.size("__pieces") == 0, F.array(F.lit(""))).otherwise(F.col("__pieces"))
            ).alias("file_ord", diff_col),
        )
    )
