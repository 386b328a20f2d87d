"""All pairs of similar sets through an inverted index with a prefix filter.

Two sets above a similarity share an element among the first few of each, if elements are
ordered alike everywhere. The order is rarest first, so the index holds rare elements only
and a common one is looked up by sets that have little else. Pairs that meet there are
compared on their whole sets. Equal sets are one class: a group of copies makes no pairs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gitloom.operators.ordering import ordered_prefix
from gitloom.session import cut, cut_measured, scratch_path
from gitloom.sources.paths import remove

#: Parts of the elements that are dealt out one after another.
PASSES = 4
#: Elements sent along with pairs at once: so many, or so many times those of all sets.
SENT_ENTRIES = 1 << 26
SENT_TIMES = 2
#: Elements of one block at most, about; a task holds two blocks.
BLOCK_ENTRIES = 1 << 24
#: Elements of one block at least, if more blocks are there for the cores alone.
LEAST_ENTRIES = 1 << 20
#: Blocks that are compared with all others at once.
BLOCK_ROWS = 4
#: Elements of a part of a block that is looked up at once.
PART_ENTRIES = 1 << 21
#: Cells of a part's table of pairs, and bytes of rows of bits, that are held at once.
CELLS = 1 << 22
#: An element that one set in so many has is a row of bits.
HOT_SHARE = 128


@dataclass(frozen=True)
class Classes:
    """``sets``: row, items, the sets that are not empty, stored at ``path`` until they are coded.
    ``firsts``: row, id, n, copies, of one row for each different set."""

    sets: DataFrame
    firsts: DataFrame
    path: str


def set_classes(sets: DataFrame, id_col: str, set_col: str) -> Classes:
    """The different sets that are not empty: the smallest id, how many rows have it, and the
    number of its elements. Elements are stored where they are read, and not shuffled."""
    items = F.sort_array(F.array_distinct(F.array_compact(F.col(set_col))))
    held = sets.select(F.col(id_col).alias("id"), items.alias("items")).where(F.size("items") > 0)
    path = scratch_path(sets.sparkSession, "sets")
    stored = cut(
        held.select(
            F.monotonically_increasing_id().alias("row"), "id", F.size("items").alias("n"),
            F.xxhash64("items").alias("h1"), F.xxhash64(F.lit(1), "items").alias("h2"), "items",
        ),
        path=path,
    )
    firsts = stored.groupBy("h1", "h2").agg(
        F.min("row").alias("row"), F.min("id").alias("id"), F.first("n").alias("n"), F.count("*").alias("copies")
    )
    return Classes(stored.select("row", "items"), cut(firsts.drop("h1", "h2"), "set-classes"), path)


def coded_classes(classes: Classes) -> DataFrame:
    """``id, n, copies, codes`` of the classes that have an element with another row in common:
    numbers of these elements, rarest first and alike in all classes.

    Elements are dealt out as texts in :data:`PASSES` parts, one after another, and the
    shuffle files of one go before the next, so the disk never holds them all. The stored
    sets are removed.
    """
    spark = classes.sets.sparkSession
    entries = classes.sets.select("row", F.explode("items").alias("item"))
    parts = [entries.where(F.pmod(F.xxhash64("item"), F.lit(PASSES)) == i) for i in range(PASSES)]
    shared = None
    for part in parts:
        counted = cut(part.groupBy("item").agg(F.count("*").alias("f")).where("f > 1"), "elements")
        shared = counted if shared is None else shared.unionByName(counted)
    ranked = ordered_prefix(shared.withColumn("__all", F.lit(0)), ["__all"], ["f", "item"], None, "code")
    named, seen = cut_measured(ranked.select("item", "code"), "codes", most=F.max("code"))
    kind = "int" if (seen["most"] or 0) < 1 << 31 else "long"
    named = named.withColumn("code", F.col("code").cast(kind))
    coded, paths = None, []
    for i, part in enumerate(parts):
        mine = named.where(F.pmod(F.xxhash64("item"), F.lit(PASSES)) == i)
        paths.append(scratch_path(spark, "coded-entries"))
        found = cut(part.join(mine, "item").select("row", "code"), path=paths[-1])
        coded = found if coded is None else coded.unionByName(found)
    remove(spark, classes.path)
    codes = coded.groupBy("row").agg(F.sort_array(F.collect_list("code")).alias("codes"))
    stored = cut(codes.join(classes.firsts, "row").select("id", "n", "copies", "codes"), "coded-classes")
    for path in paths:
        remove(spark, path)
    return stored


def _coded(sets: DataFrame, id_col: str, set_col: str) -> tuple[Classes, DataFrame]:
    """The classes, whose ``firsts`` alone are still there, and their codes."""
    classes = set_classes(sets, id_col, set_col)
    return classes, coded_classes(classes)


def _least_shared(n: Column, percent: int, measure: str) -> Column:
    """Elements that any partner of a set of ``n`` has in common with it, at least."""
    if measure == "jaccard":
        return F.ceil(n * percent / 100)
    return F.ceil(n * percent * percent / 10_000)


def _similar(shared: Column, n_a: Column, n_b: Column, percent: int, measure: str) -> Column:
    if measure == "jaccard":
        return shared * 100 >= (n_a + n_b - shared) * percent
    return shared * shared * 10_000 >= n_a.cast("long") * n_b * percent * percent


def meeting_pairs(coded: DataFrame, percent: int, measure: str) -> DataFrame:
    """``a, b, m_a``, ``a < b``: classes with an element in common and enough left from it on,
    and the number of codes of ``a``."""
    n, m = F.col("n"), F.size("codes")
    # Elements of one class tie nothing, but they take the first places.
    first = F.slice("codes", F.lit(1), F.greatest(m - _least_shared(n, percent, measure) + 1, F.lit(0)).cast("int"))
    index = coded.select("id", "n", m.alias("m"), F.posexplode(first).alias("place", "code"))
    index = cut(index.select("id", "n", "m", (F.col("m") - F.col("place")).alias("left"), "code"), "prefix-index")
    # Where two sets first meet, they share at most what is left of either.
    left = F.least("left_a", "left_b").cast("long")
    most = _similar(left, F.col("n_a"), F.col("n_b"), percent, measure)
    return (
        index.toDF("a", "n_a", "m_a", "left_a", "code")
        .join(index.toDF("b", "n_b", "m_b", "left_b", "code"), "code")
        .where((F.col("a") < F.col("b")) & most)
        .select("a", "b", "m_a")
        .distinct()
    )


def similar_pairs(
    sets: DataFrame, percent: int, id_col: str = "id", set_col: str = "items", measure: str = "cosine"
) -> DataFrame:
    """``a, b, shared, n_a, n_b, copies_a, copies_b``: classes ``a < b`` with a similarity of
    ``percent`` of a hundred or more (``cosine`` of 0/1 vectors, or ``jaccard``).

    Empty and null sets have no class and no pair; null elements do not count. No pair is
    lost, and none is formed between sets that share no rare element.
    """
    if measure not in ("cosine", "jaccard") or not 0 < percent <= 100:
        raise ValueError(f"no similarity of {percent} percent by {measure!r}")
    _, coded = _coded(sets, id_col, set_col)
    # A pair takes the codes of its first set along to the second.
    met, seen = cut_measured(meeting_pairs(coded, percent, measure), "met", sent=F.sum("m_a"))
    held = coded.agg(F.coalesce(F.sum(F.size("codes")), F.lit(0))).first()[0]
    turns = max(1, math.ceil((seen["sent"] or 0) / max(SENT_ENTRIES, SENT_TIMES * held)))
    if turns == 1:
        return _compared(met, coded, percent, measure)
    found = None
    for turn in range(turns):
        mine = met.where(F.pmod(F.xxhash64("a", "b"), F.lit(turns)) == turn)
        pairs = cut(_compared(mine, coded, percent, measure), "pairs")
        found = pairs if found is None else found.unionByName(pairs)
    return found


def _compared(met: DataFrame, coded: DataFrame, percent: int, measure: str) -> DataFrame:
    for side in "ab":
        names = {"id": side, "n": f"n_{side}", "codes": f"codes_{side}", "copies": f"copies_{side}"}
        met = met.join(coded.withColumnsRenamed(names), side)
    shared = F.size(F.array_intersect("codes_a", "codes_b")).cast("long")
    fits = _similar(F.col("shared"), F.col("n_a"), F.col("n_b"), percent, measure)
    columns = ["a", "b", "shared", "n_a", "n_b", "copies_a", "copies_b"]
    return met.withColumn("shared", shared).where(fits).select(*columns)


def _lookup(ends: np.ndarray, codes: np.ndarray) -> tuple:
    """Which sets have which element: rows of bits for elements that many have, lists for others."""
    n_b = len(ends)
    names, term = np.unique(codes, return_inverse=True)
    f = np.bincount(term, minlength=len(names))
    first = np.cumsum(f) - f
    order = np.argsort(term, kind="stable")
    holders = np.repeat(np.arange(n_b, dtype=np.int32), np.diff(ends, prepend=0))[order]
    hot = f > n_b // HOT_SHARE
    hot_terms = np.nonzero(hot)[0]
    bits = np.zeros((len(hot_terms), -(-n_b // 8)), np.uint8)
    step = max(1, CELLS // n_b)
    for lo in range(0, len(hot_terms), step):
        flags = np.zeros((len(hot_terms[lo : lo + step]), n_b), bool)
        for i, t in enumerate(hot_terms[lo : lo + step]):
            flags[i, holders[first[t] : first[t] + f[t]]] = True
        bits[lo : lo + step] = np.packbits(flags, axis=1)
    return n_b, names, f, first, holders, hot, np.cumsum(hot) - 1, bits


def _count_known(ends_a: np.ndarray, codes_a: np.ndarray, known: tuple) -> int:
    """Pairs of a set and a looked-up set that share an element."""
    n_a, (n_b, names, f, first, holders, hot, slot, bits) = len(ends_a), known
    at = np.minimum(np.searchsorted(names, codes_a), len(names) - 1)
    met_b = names[at] == codes_a
    row, at = np.repeat(np.arange(n_a), np.diff(ends_a, prepend=0))[met_b], at[met_b]
    cost = np.cumsum(np.bincount(row, np.where(hot[at], bits.shape[1], f[at]), n_a))
    step = max(1, CELLS // n_b)
    total = lo = 0
    while lo < n_a:
        spent = cost[lo - 1] if lo else 0
        hi = min(n_a, lo + step, max(lo + 1, int(np.searchsorted(cost, spent + CELLS, "right"))))
        here = slice(*np.searchsorted(row, [lo, hi]))
        r, t = row[here] - lo, at[here]
        cold = ~hot[t]
        n = f[t[cold]]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        met = np.zeros((hi - lo, n_b), bool)
        met[np.repeat(r[cold], n), holders[np.repeat(first[t[cold]], n) + within]] = True
        found = np.packbits(met, axis=1)
        rows, begin = np.unique(r[~cold], return_index=True)
        if len(rows):
            found[rows] |= np.bitwise_or.reduceat(bits[slot[t[~cold]]], begin, axis=0)
        total += int(np.bitwise_count(found).sum(dtype=np.int64))
        lo = hi
    return total


def _parts(ends: np.ndarray, codes: np.ndarray):
    """Consecutive sets with about ``PART_ENTRIES`` elements."""
    lo = 0
    while lo < len(ends):
        begin = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, begin + PART_ENTRIES, "right")))
        yield ends[lo:hi] - begin, codes[begin : ends[hi - 1]]
        lo = hi


def count_common(ends_a: np.ndarray, codes_a: np.ndarray, ends_b: np.ndarray, codes_b: np.ndarray) -> int:
    """Pairs of a set of one block and a set of the other that share an element.

    What is held beside the blocks is bounded by a part of each, whatever the size of a block.
    """
    total = 0
    for part in _parts(ends_b, codes_b):
        known = _lookup(*part)
        total += sum(_count_known(*other, known) for other in _parts(ends_a, codes_a))
    return total


def _common(coded: DataFrame, n_blocks: int, lo: int, hi: int) -> DataFrame:
    """``n``: for each pair of a block from ``lo`` to ``hi`` and one not before it, the pairs of
    classes that share an element. Classes are sent one by one, as rows of codes."""

    def count(key, group):
        blk = group.column("blk")

        def block(side):
            held = group.column("codes").filter(pc.equal(blk, key[side])).combine_chunks()
            return np.cumsum(pc.list_value_length(held).to_numpy(zero_copy_only=False), dtype="<i8"), held.flatten().to_numpy()

        if key[0] == key[1]:  # a block with itself: each pair twice, and each class with itself
            first = block(0)
            n = (count_common(*first, *first) - len(first[0])) // 2
        else:  # a block may have no class
            n = count_common(*block(0), *block(1)) if pc.min(blk) != pc.max(blk) else 0
        return pa.table({"n": pa.array([n], pa.int64())})

    blk = F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int")
    dealt = coded.select(blk.alias("blk"), "codes")
    low = dealt.where(F.col("blk").between(lo, hi - 1)).select(
        F.col("blk").alias("low"), F.explode(F.sequence("blk", F.lit(n_blocks - 1))).alias("high"), "blk", "codes"
    )
    high = dealt.where(F.col("blk") > lo).select(
        F.explode(F.sequence(F.lit(lo), F.least(F.col("blk"), F.lit(hi)) - 1)).alias("low"), F.col("blk").alias("high"), "blk", "codes"
    )
    return low.unionByName(high).groupBy("low", "high").applyInArrow(count, "n long")


def block_count(entries: int, cores: int, block_entries: int) -> int:
    """Blocks of ``block_entries`` at most; more while they are few for the cores and not small."""
    wanted = min(math.ceil(2 * math.sqrt(cores)), entries // LEAST_ENTRIES)
    return max(1, -(-entries // block_entries), wanted)


def pairs_without_common(
    sets: DataFrame, id_col: str = "id", set_col: str = "items", block_entries: int = BLOCK_ENTRIES
) -> DataFrame:
    """``n_classes, n_pairs, n_common``: classes, their pairs, and pairs that share an element.

    The others are as far apart as can be: they are counted. No pair is listed: classes lie in
    blocks of about ``block_entries`` elements, and a pair of blocks gives one number. Where
    there are many blocks, a few at a time meet all others, which bounds what is on disk.
    """
    classes, coded = _coded(sets, id_col, set_col)
    n_sets, entries = coded.agg(F.count("*"), F.coalesce(F.sum(F.size("codes")), F.lit(0))).first()
    cores = sets.sparkSession.sparkContext.defaultParallelism
    n_blocks = min(block_count(entries, cores, block_entries), max(1, n_sets))
    rows = max(n_blocks if n_blocks <= 2 * BLOCK_ROWS else BLOCK_ROWS, LEAST_ENTRIES // block_entries)
    counts = None
    for lo in range(0, n_blocks, rows):
        here = cut(_common(coded, n_blocks, lo, min(n_blocks, lo + rows)), "common")
        counts = here if counts is None else counts.unionByName(here)
    common = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_common"))
    n = F.col("n_classes")
    return classes.firsts.agg(F.count("*").alias("n_classes")).select(
        n, (n * (n - 1) / 2).cast("long").alias("n_pairs"), common.scalar().alias("n_common")
    )
