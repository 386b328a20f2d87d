"""Pack ordered lines into texts of bounded length, greedily and in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gitloom.operators.ordering import ordered_prefix
from gitloom.session import cut

# Keys above either bound take the distributed path.
HOT_LINES = 20_000
HOT_CHARS = 64_000_000
# Width, in characters, of the buckets that turn "which line holds offset q" into an equi-join.
OFFSET_BUCKET = 512


def pack_lines(
    df: DataFrame,
    keys: Sequence[str],
    ord_col: str,
    line_col: str,
    limit: int,
    hot_lines: int = HOT_LINES,
    hot_chars: int = HOT_CHARS,
) -> DataFrame:
    """``keys, chunk_no, n_lines, text, fits`` with lines joined by newlines.

    When the joined lines fit in ``limit`` there is one chunk (``fits``). Otherwise
    lines fill a chunk until adding ``length + 1`` would pass the limit; a line over
    the limit is a chunk of its own. A null line is an empty one. Lines with the same
    ordinal go by their text. Most keys are folded as one array. Keys too large for one
    task are found by a pre-aggregation and packed by joins, with the same result.
    """
    keys = list(keys)
    lines = df.select(
        *keys,
        F.col(ord_col).alias("__ord"),
        F.coalesce(line_col, F.lit("")).alias("__line"),
        (F.length(F.coalesce(line_col, F.lit(""))) + 1).alias("__len"),
    )
    sizes = lines.groupBy(*keys).agg(
        F.count("*").alias("__n"), F.sum("__len").alias("__chars")
    )
    is_hot = (F.col("__n") > hot_lines) | (F.col("__chars") > hot_chars)
    hot = cut(sizes.where(is_hot), "hot-keys")
    if hot.isEmpty():
        return _pack_arrays(lines, keys, limit)
    cold_lines = lines.join(hot.select(*keys), keys, "left_anti")
    hot_lines_df = lines.join(hot.select(*keys), keys, "left_semi")
    return _pack_arrays(cold_lines, keys, limit).unionByName(
        _pack_distributed(hot_lines_df, hot, keys, limit)
    )


def _pack_arrays(lines: DataFrame, keys: list[str], limit: int) -> DataFrame:
    grouped = lines.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("__ord", "__line", "__len"))).alias("__rows"),
        F.sum("__len").alias("__chars"),
    )
    # The fold carries only start positions; each chunk's text is sliced once.
    empty = F.struct(
        F.array().cast("array<int>").alias("starts"),
        F.lit(0).cast("long").alias("used"),
        F.lit(0).alias("i"),
    )

    def step(state, row):
        opens = (state["i"] == 0) | (state["used"] + row["__len"] > limit)
        return F.struct(
            F.when(opens, F.array_append(state["starts"], state["i"]))
            .otherwise(state["starts"])
            .alias("starts"),
            F.when(opens, row["__len"].cast("long"))
            .otherwise(state["used"] + row["__len"])
            .alias("used"),
            (state["i"] + 1).alias("i"),
        )

    starts = F.when(F.col("__chars") - 1 <= limit, F.array(F.lit(0))).otherwise(
        F.aggregate("__rows", empty, step, lambda s: s["starts"])
    )
    return (
        grouped.withColumn("__starts", starts)
        .select(
            *keys,
            "__rows",
            (F.col("__chars") - 1 <= limit).alias("fits"),
            F.col("__starts"),
            F.posexplode("__starts").alias("chunk_no", "__from"),
        )
        .withColumn(
            "n_lines",
            F.coalesce(
                F.try_element_at("__starts", F.col("chunk_no") + 2), F.size("__rows")
            )
            - F.col("__from"),
        )
        .select(
            *keys,
            F.col("chunk_no").cast("long").alias("chunk_no"),
            F.col("n_lines").cast("long").alias("n_lines"),
            F.array_join(
                F.slice(F.col("__rows.__line"), F.col("__from") + 1, F.col("n_lines")), "\n"
            ).alias("text"),
            "fits",
        )
    )


def _pack_distributed(
    lines: DataFrame, sizes: DataFrame, keys: list[str], limit: int
) -> DataFrame:
    """Packing without any task that sees a whole key.

    Every line gets its character interval ``[start, end)``. A chunk opening at line
    ``i`` is followed by one opening at the line whose interval holds offset
    ``start_i + limit``; those pointers come from one bucketed join. The chunks are
    the lines reachable from the first, found by pointer doubling.
    """
    placed = cut(
        ordered_prefix(lines, keys, ["__ord", "__line"], F.col("__len"), "__rn", "__end").withColumn(
            "__start", F.col("__end") - F.col("__len")
        ),
        "placed",
    )
    # Columns of its own, as a key may have any name.
    width = OFFSET_BUCKET
    spans = placed.select(
        *keys,
        F.col("__rn").alias("__next"),
        F.col("__start").alias("__from"),
        F.col("__end").alias("__to"),
        F.explode(
            F.sequence(
                F.floor(F.col("__start") / width), F.floor((F.col("__end") - 1) / width)
            )
        ).alias("__bucket"),
    )
    asks = placed.select(
        *keys,
        F.col("__rn").alias("__i"),
        (F.col("__start") + limit).alias("__offset"),
        F.floor((F.col("__start") + limit) / width).alias("__bucket"),
    )
    found = asks.join(spans, [*keys, "__bucket"]).where("__offset >= __from and __offset < __to")
    # A line longer than the limit holds its own offset: the chunk ends after it.
    jump = cut(
        found.select(*keys, "__i", F.greatest(F.col("__next"), F.col("__i") + 1).alias("__j")), "jump"
    )
    jump = jump.join(sizes.select(*keys, "__n"), keys).where("__j <= __n").drop("__n")
    jumps = []
    first = F.col("__i") == 1
    while not jump.where(first).isEmpty():
        jumps.append(jump)
        after = jump.select(*keys, F.col("__i").alias("__j"), F.col("__j").alias("__k"))
        jump = cut(jump.join(after, [*keys, "__j"]).select(*keys, "__i", F.col("__k").alias("__j")), "jump")
    opens = sizes.where(F.col("__n") > 0).select(*keys, F.lit(1).cast("long").alias("__i"))
    for jump in reversed(jumps):
        reached = opens.join(jump, [*keys, "__i"]).select(*keys, F.col("__j").alias("__i"))
        opens = cut(opens.unionByName(reached).distinct(), "opens")
    fits = sizes.select(*keys, "__n", (F.col("__chars") - 1 <= limit).alias("__fits"))
    opens = opens.join(fits, keys).where((F.col("__i") == 1) | ~F.col("__fits"))
    numbered = cut(ordered_prefix(opens, keys, ["__i"], None, "__no", "__running"), "numbered")
    following = numbered.select(
        *keys, (F.col("__no") - 1).alias("__no"), F.col("__i").alias("__until")
    )
    chunks = (
        numbered.join(following, [*keys, "__no"], "left")
        .withColumn("__until", F.coalesce("__until", F.col("__n") + 1))
        .select(
            *keys,
            (F.col("__no") - 1).alias("chunk_no"),
            F.col("__fits").alias("fits"),
            F.explode(F.sequence("__i", F.col("__until") - 1)).alias("__rn"),
        )
    )
    return (
        placed.join(chunks, [*keys, "__rn"])
        .groupBy(*keys, "chunk_no", "fits")
        .agg(
            F.count("*").alias("n_lines"),
            F.sort_array(F.collect_list(F.struct("__rn", "__line"))).alias("__rows"),
        )
        .select(
            *keys,
            "chunk_no",
            "n_lines",
            F.array_join("__rows.__line", "\n").alias("text"),
            "fits",
        )
    )
