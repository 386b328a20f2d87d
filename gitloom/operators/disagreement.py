"""How far summaries of the same commit differ between runs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gitloom.functions.text import bigram_set, bigrams, let
from gitloom.functions.vectors import set_cosine_distance, set_euclidean_distance
from gitloom.operators.ordering import keep_first
from gitloom.session import cut

# --- fixed values ---
HISTOGRAM_BINS = 30
TOP_PAIRS = 10
# --- end of fixed values ---


def with_bigrams(df: DataFrame, text_col: str = "semantic_summary") -> DataFrame:
    return df.withColumn("bigrams", bigrams(F.col(text_col)))


def bigram_terms(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Sparse 0/1 encoding in long form: one row per (id, bigram)."""
    return df.select(id_col, F.explode(bigram_set(F.col(text_col))).alias("bigram"))


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows ``__id, bigram, __part`` with the place of their bigram among the different
    ones of the partition. ``bigram`` stays in its first row only; a last row has the number of
    places, the first bigram and in ``__last`` the last one."""
    first, last, place = None, None, -1
    for batch in batches:
        if not batch.num_rows:
            continue
        found, part = batch.column("bigram"), batch.column("__part")
        begins = np.ones(len(found), dtype=bool)
        begins[0] = last is None or found[0].as_py() != last
        begins[1:] = pc.not_equal(found[1:], found[:-1]).to_numpy(zero_copy_only=False)
        first, last = found[0].as_py() if first is None else first, found[-1].as_py()
        places = place + np.cumsum(begins)
        place = int(places[-1])
        heads = pc.if_else(pa.array(begins), found, pa.scalar(None, found.type))
        none = pa.nulls(len(found), found.type)
        columns = [batch.column("__id"), part, pa.array(places, pa.int64()), heads, none]
        yield pa.RecordBatch.from_arrays(columns, names=_PLACED)
        ends = [pa.nulls(1, columns[0].type), part[:1], pa.array([place + 1], pa.int64())]
    if last is not None:
        yield pa.RecordBatch.from_arrays([*ends, pa.array([first], found.type), pa.array([last], found.type)], names=_PLACED)


_PLACED = ["__id", "__part", "__place", "bigram", "__last"]


def sparse_terms(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Sparse 0/1 vectors ``id, terms`` (the places of a text's bigrams, ascending) and the
    vocabulary ``bigram, term`` (every different bigram and its place, from 0, in their order),
    both as tables: neither has a bound on the number of terms.

    A text without bigrams has an empty vector. Rows with one id are one vector. Bigrams are
    dealt and sorted as texts once, by ranges, and get their places there; a range may
    end within the rows of one bigram, so frequent ones spread.
    """
    ids = df.select(F.col(id_col).alias("__id"))
    listed = cut(bigram_terms(df.withColumnRenamed(id_col, "__id"), "__id", text_col), "terms")
    ranged = listed.repartitionByRange("bigram", "__id").sortWithinPartitions("bigram")
    kinds = T.StructType([ids.schema["__id"]]).add("__part", T.IntegerType()).add("__place", T.LongType())
    kinds = kinds.add("bigram", T.StringType()).add("__last", T.StringType())
    placed = cut(ranged.withColumn("__part", F.spark_partition_id()).mapInArrow(_places, kinds), "placed")
    # One row for each range: as many as Spark is told to make partitions.
    order = Window.orderBy("__part")
    ranges = placed.where("__last is not null").select(
        "__part", F.col("__place").alias("__n"),
        F.coalesce(F.col("bigram") == F.lag("__last").over(order), F.lit(False)).alias("__goes_on"),
    )
    shared = F.sum(F.col("__goes_on").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    before = F.coalesce(F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(ranges.select("__part", "__goes_on", (before - shared).alias("__before")))
    coded = placed.where("__last is null").join(starts, "__part").withColumn("term", F.col("__before") + F.col("__place"))
    again = F.col("__goes_on") & (F.col("__place") == 0)
    words = coded.where(F.col("bigram").isNotNull() & ~again).select("bigram", "term")
    # Every id comes along once more without a term, so that empty texts have their vectors.
    every = coded.select("__id", "term").unionByName(ids.withColumn("term", F.lit(None).cast("long")))
    terms = F.sort_array(F.array_distinct(F.collect_list("term"))).alias("terms")
    return every.groupBy("__id").agg(terms).withColumnRenamed("__id", id_col), words


def sparse_distances(left: Column, right: Column) -> tuple[Column, Column]:
    """Cosine and euclidean distance of two sparse 0/1 vectors."""
    shared = F.size(F.array_intersect(left, right))
    return (
        set_cosine_distance(shared, F.size(left), F.size(right)),
        set_euclidean_distance(shared, F.size(left), F.size(right)),
    )


def run_pairs(runs: DataFrame, order: Sequence[str]) -> DataFrame:
    """Pairs of the same commit in two runs, ``source_1 < source_2``, with set distances.

    ``runs`` holds ``commit_hash, source_file, semantic_summary``. One row per commit
    and run is kept first, so a commit has at most as many rows as there are runs however
    often it was written. These meet as texts, in one row a commit: bigram sets, which are
    larger, are made there, once for each text, and never shuffled.
    """
    columns = ["commit_hash", "source_file", "semantic_summary"]
    known = runs.where("commit_hash is not null and source_file is not null")
    known = known.select(*columns, *[c for c in order if c not in columns])
    first = keep_first(known, ["commit_hash", "source_file"], order)
    texts = F.sort_array(F.collect_list(F.struct("source_file", "semantic_summary")))
    sets = F.transform(
        "texts",
        lambda t: F.struct(t["source_file"].alias("source"), bigram_set(t["semantic_summary"]).alias("b")),
    )

    def pairs(held: Column) -> Column:
        def with_later(x: Column, i: Column) -> Column:
            return F.transform(F.slice(held, i + 2, F.size(held)), lambda y: pair(x, y))

        return F.flatten(F.transform(held, with_later))

    def pair(x: Column, y: Column) -> Column:
        n1, n2 = F.size(x["b"]), F.size(y["b"])
        both = F.size(F.array_intersect(x["b"], y["b"]))
        return F.struct(x["source"].alias("source_1"), y["source"].alias("source_2"), n1.alias("n1"), n2.alias("n2"), both.alias("shared"))

    n1, n2, shared = F.col("n1"), F.col("n2"), F.col("shared")
    return (
        first.groupBy("commit_hash")
        .agg(texts.alias("texts"))
        .select("commit_hash", F.inline(let(sets, pairs)))
        .select(
            "commit_hash",
            "source_1",
            "source_2",
            set_cosine_distance(shared, n1, n2).alias("distance"),
            set_euclidean_distance(shared, n1, n2).alias("euclidean"),
        )
    )


def distance_stats(pairs: DataFrame, column: str = "distance") -> DataFrame:
    """Mean and sample standard deviation over all pairs."""
    return pairs.agg(F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"))


def with_zscore(pairs: DataFrame, column: str = "distance") -> DataFrame:
    """Add ``distance_zscore``; the two statistics are one small aggregate, no window."""
    stats = distance_stats(pairs, column)
    return pairs.withColumn(
        "distance_zscore",
        (F.col(column) - stats.select("mean").scalar()) / F.nullif(stats.select("std").scalar(), F.lit(0.0)),
    )


def histogram(pairs: DataFrame, column: str = "distance", bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins from the smallest to the largest value; the last bin is closed."""
    bounds = pairs.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    flat = lo == hi
    low = F.when(flat, lo - 0.5).otherwise(lo)
    width = F.when(flat, 1.0).otherwise(hi - lo)
    place = F.floor((F.col(column) - low) * bins / width) + 1
    return (
        pairs.where(F.col(column).isNotNull())
        .groupBy(F.least(place, F.lit(bins).cast("long")).alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def rank_pairs(pairs: DataFrame, ties: Sequence[str], column: str = "distance") -> DataFrame:
    """Largest first; pairs without a distance come last."""
    return pairs.orderBy(F.desc_nulls_last(column), *ties)


def top_pairs(
    pairs: DataFrame, ties: Sequence[str], column: str = "distance", k: int = TOP_PAIRS
) -> DataFrame:
    return rank_pairs(pairs, ties, column).limit(k)


def drop_commits(pairs: DataFrame, hashes: Sequence[str]) -> DataFrame:
    """Leave out named commits; rows without a hash stay."""
    return pairs.where(F.coalesce(~F.col("commit_hash").isin(*hashes), F.lit(True)))


def with_summaries(top: DataFrame, runs: DataFrame, order: Sequence[str]) -> DataFrame:
    """Both texts of each top pair, the first match per commit and run, in one scan of ``runs``."""
    wanted = top.select(
        "commit_hash", F.explode(F.array("source_1", "source_2")).alias("source_file")
    ).distinct()
    found = keep_first(
        runs.join(wanted, ["commit_hash", "source_file"], "left_semi"),
        ["commit_hash", "source_file"],
        order,
    ).select("commit_hash", "source_file", "semantic_summary")
    out = top
    for n in ("1", "2"):
        side = found.select(
            "commit_hash",
            F.col("source_file").alias(f"source_{n}"),
            F.col("semantic_summary").alias(f"summary_{n}"),
        )
        out = out.join(side, ["commit_hash", f"source_{n}"], "left")
    return out


def non_null_counts(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count(c).alias(c) for c in df.columns])


def sort_by_commit(df: DataFrame) -> DataFrame:
    return df.orderBy("commit_hash")
