"""Near-duplicate documents with b-bit MinHash.

Texts with equal sets of shingles form a class. Bands of minima propose pairs of classes,
the packed low bits of all minima estimate how similar a pair is, and pairs that may reach
the threshold are compared on their full sets. Components of the links are near-duplicates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from math import sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gitloom.llm.common import small_batches, text_key, utf8, without
from gitloom.llm.components import connected_components
from gitloom.session import cut, cut_measured, scratch_path, scratch_scope

SHINGLE_WORDS = 5
#: A pair of similarity 0.85 shares no band of 5 minima among 32 in 7 of 10^9 cases.
BANDS, ROWS = 32, 5
MINIMA = BANDS * ROWS
#: Low bits kept of each minimum, and the 64-bit words that hold them.
BITS = 2
WORDS = MINIMA * BITS // 64
#: Standard deviations by which an estimate may fall short before a pair is left out.
SIGMAS = 6

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240607)
_XOR = _rng.integers(0, 1 << 63, MINIMA, np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = _rng.integers(0, 1 << 63, MINIMA, np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingles(text: bytes) -> np.ndarray:
    """The sorted set of 64-bit hashes of five-word runs; of all words if there are fewer.

    Words are runs without ASCII white space, A-Z in lower case. No words, no shingles.
    """
    words = text.lower().split()
    if not words:
        return np.array([], np.uint64)
    if len(words) < SHINGLE_WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words))], np.uint64)
    h = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)
    n = len(h) - SHINGLE_WORDS + 1
    run = h[:n]
    for i in range(1, SHINGLE_WORDS):
        run = _mix(run * _GOLDEN + h[i : i + n])
    return np.unique(run)


def minima(hashes: np.ndarray) -> np.ndarray:
    out = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), 1024):
        part = hashes[start : start + 1024, None]
        np.minimum(out, ((part ^ _XOR) * _MUL).min(axis=0), out=out)
    return out


def band_keys(low: np.ndarray) -> np.ndarray:
    """One key per band; the band's number is part of it."""
    rows = low.reshape(BANDS, ROWS)
    key = _mix(np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLDEN)
    for i in range(ROWS):
        key = _mix(key * _GOLDEN + rows[:, i])
    return key.view(np.int64)


def packed(low: np.ndarray) -> np.ndarray:
    """The low bits of all minima, side by side in 64-bit words."""
    slots = 64 // BITS
    kept = (low & np.uint64((1 << BITS) - 1)).reshape(WORDS, slots)
    return (kept << (np.arange(slots, dtype=np.uint64) * np.uint64(BITS))).sum(
        axis=1, dtype=np.uint64
    ).view(np.int64)


def estimate(a: str, b: str) -> Column:
    """Similarity from two packed signatures, corrected for low bits that agree by chance."""
    slots = F.lit(sum(1 << (BITS * i) for i in range(64 // BITS))).cast("long")
    equal: Column = F.lit(MINIMA)
    for i in range(WORDS):
        odd = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        for j in range(1, BITS):
            odd = odd.bitwiseOR(F.shiftrightunsigned(F.col(a)[i].bitwiseXOR(F.col(b)[i]), j))
        equal = equal - F.bit_count(odd.bitwiseAND(slots))
    chance = 1 / (1 << BITS)
    return (equal / MINIMA - chance) / (1 - chance)


def estimate_floor(threshold: float) -> float:
    """The least estimate at which a pair of ``threshold`` is still compared in full."""
    chance = 1 / (1 << BITS)
    p = threshold + (1 - threshold) * chance
    return threshold - SIGMAS * sqrt(p * (1 - p) / MINIMA) / (1 - chance)


_SIGNED = (
    "doc_id long, t1 long, t2 long, n_shingles long, class binary, signature array<long>, "
    "bands array<long>"
)


def signatures(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document row; texts without words have no class, signature or bands."""
    first, second = text_key(text)
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        first.alias("t1"),
        second.alias("t2"),
        F.col(f"`{text}`").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            sizes, classes, packs, bands = [], [], [], []
            for data in utf8(batch, "text"):
                hashes = shingles(data)
                sizes.append(len(hashes))
                if len(hashes):
                    low = minima(hashes)
                    classes.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                    packs.append(packed(low))
                    bands.append(band_keys(low))
                else:
                    classes.append(None)
                    packs.append(None)
                    bands.append(None)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("doc_id", "t1", "t2")],
                    pa.array(sizes, pa.int64()),
                    pa.array(classes, pa.binary()),
                    pa.array(packs, longs),
                    pa.array(bands, longs),
                ],
                names=["doc_id", "t1", "t2", "n_shingles", "class", "signature", "bands"],
            )

    return narrow.mapInArrow(run, _SIGNED)


def bucket_members(classes: DataFrame) -> DataFrame:
    """``bucket, band, cid, lot, m, first`` for buckets of two classes or more.

    ``lot`` in 0 to 1 decides when a member is compared with the rest of its bucket; ``m``
    and ``first`` are the bucket's number of classes and its smallest.
    """
    entries = classes.select(F.posexplode("bands").alias("band", "bucket"), "cid")
    shared = (
        entries.groupBy("bucket")
        .agg(F.count("*").alias("m"), F.min("cid").alias("first"))
        .where("m > 1")
    )
    lot = F.shiftrightunsigned(F.xxhash64("cid", "bucket"), 11) / float(1 << 53)
    found = entries.join(shared.hint("merge"), "bucket")
    return found.select("bucket", "band", "cid", lot.alias("lot"), "m", "first")


def full_sets(docs: DataFrame, wanted: DataFrame, text: str = "text") -> DataFrame:
    """``cid, shingles`` of the wanted classes, made again from one document of each."""
    first, second = text_key(text)
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("__id"),
        first.alias("t1"),
        second.alias("t2"),
        F.col(f"`{text}`").alias("text"),
    )
    chosen = narrow.join(wanted.hint("merge"), ["t1", "t2"])
    chosen = chosen.where(F.col("__id").eqNullSafe(F.col("doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            sets = [shingles(t).view(np.int64) for t in utf8(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("cid"), pa.array(sets, pa.list_(pa.int64()))],
                names=["cid", "shingles"],
            )

    made = chosen.select("cid", "text").mapInArrow(run, "cid long, shingles array<long>")
    return made.groupBy("cid").agg(F.first("shingles").alias("shingles"))  # repeated rows


def shared_shingles(sets: DataFrame) -> DataFrame:
    """``cid, unshared``: how many shingles of a class no other class has, where there are any.

    The sets are taken apart once; a shingle of one class is counted for its only holder.
    """
    rows = sets.select("cid", F.explode("shingles").alias("h"))
    held = rows.groupBy("h").agg(F.count("*").alias("holders"), F.min("cid").alias("cid"))
    return held.where("holders = 1").groupBy("cid").agg(F.count("*").alias("unshared"))


def recounted(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``rest`` with ``shared`` counted anew: the shingles that a class of another component
    has too. Classes that cannot reach the threshold with these have no link left."""
    who = rest.select("cid", "comp")
    rows = sets.join(who.hint("merge"), "cid").select("cid", "comp", F.explode("shingles").alias("h"))
    common = rows.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi")
    counted = rows.join(common.select("h").hint("merge"), "h").groupBy("cid").agg(F.count("*").alias("shared"))
    found = rest.drop("shared").join(counted.hint("merge"), "cid")
    return found.where(F.col("shared") * 100 >= F.col("n") * percent)


#: What a row of a class has beside its buckets.
_CLASS = ("comp", "n", "signature", "shared", "marks")


def by_class(members: DataFrame, *columns: str) -> DataFrame:
    """One row a class: ``cid``, ``columns`` and ``at``, its places in buckets (one a band).

    So that a class meets its new component once, not once in each of its buckets.
    """
    places = F.collect_list(F.struct("bucket", "band", "lot", "m")).alias("at")
    return members.groupBy("cid").agg(*[F.first(c).alias(c) for c in columns], places)


def opened(rest: DataFrame, turn: int, percent: int) -> DataFrame:
    """Members of buckets that still hold more than one component, with ``pivot`` and ``last``.

    ``rest`` has one row a class (``by_class``), the result one for each bucket of a class.

    Two classes of different components are not both in the largest one of their bucket. So
    where few members are outside of it, these are the pivots and the turn is the bucket's
    ``last``; else some of all members are, four times as many as in the turn before. Turns
    start at one, after the ``star_pairs``.
    ``slack`` is what any partner in the bucket has for itself alone: a class whose shared
    shingles do not reach the threshold over its own size and that has no link left.
    """
    live = rest.select("cid", *_CLASS, F.inline("at"))
    counted = live.groupBy("bucket", "comp").agg(
        F.count("*").alias("c"), F.min(F.col("n") - F.col("shared")).alias("alone")
    )
    buckets = (
        counted.groupBy("bucket")
        .agg(F.sum("c").alias("__m"), F.max(F.struct("c", "comp")).alias("__top"), F.min("alone").alias("__slack"))
        .where(F.col("__m") > F.col("__top.c"))
    )
    reach = 4**turn
    able = F.col("shared") * 100 >= (F.col("n") + F.col("__slack")) * percent
    return (
        live.join(buckets.hint("merge"), "bucket")
        .where(able)
        .withColumn("last", F.col("__m") - F.col("__top.c") <= reach)
        .withColumn("pivot", F.when(F.col("last"), F.col("comp") != F.col("__top.comp")).otherwise(F.col("lot") * F.col("m") < reach))
        .drop("__m", "__top", "__slack")
    )


def _sided(df: DataFrame, side: str, *columns: str) -> DataFrame:
    named = [F.col(c).alias(f"{c}_{side}") for c in columns]
    return df.select(F.col("cid").alias(side), *[c for c in ("bucket", "band") if c in df.columns], *named)


def _near(percent: int) -> Column:
    """Whether a pair may reach the threshold: sizes and shared shingles bound the similarity
    from above, and the packed signatures estimate it."""
    both = F.least("shared_a", "shared_b")
    return (
        (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
        & (both * 100 >= (F.col("n_a") + F.col("n_b") - both) * percent)
        & (estimate("signature_a", "signature_b") >= estimate_floor(percent / 100))
    )


_PAIR = ("a", "b", "comp_a", "comp_b", "n_a", "n_b")


def star_pairs(members: DataFrame, brief: DataFrame, percent: int) -> DataFrame:
    """Each class with the smallest of the classes that its buckets begin with, if they may be
    linked: one pair a class, which already ties most of a group of near copies together."""
    sides = {side: _sided(brief, side, "comp", "n", "signature", "shared").hint("merge") for side in "ab"}
    least = members.groupBy(F.col("cid").alias("a")).agg(F.min("first").alias("b")).where("a != b")
    return least.join(sides["a"], "a").join(sides["b"], "b").where(_near(percent)).select(*_PAIR)


def candidates(live: DataFrame, percent: int) -> DataFrame:
    """Pairs of this turn that may reach the threshold.

    They are tested where they are formed, and so is that no earlier band has the pair: it
    belongs to the first bucket that both are in.
    """
    columns = ("comp", "n", "signature", "shared", "marks", "pivot")
    sides = {side: _sided(live, side, *columns) for side in "ab"}
    met = sides["a"].where("pivot_a").join(sides["b"].hint("merge"), ["bucket", "band"])
    earlier = F.zip_with(
        F.slice("marks_a", 1, F.col("band")), F.slice("marks_b", 1, F.col("band")), lambda x, y: x == y
    )
    apart = (~F.col("pivot_b") | (F.col("a") < F.col("b"))) & (F.col("comp_a") != F.col("comp_b"))
    return met.where(apart & _near(percent) & ~F.exists(earlier, lambda same: same)).select(*_PAIR)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the candidates those that reach the threshold on their full sets."""
    asked = pairs
    for side in ("a", "b"):
        held = sets.withColumnsRenamed({"cid": side, "shingles": f"set_{side}"})
        asked = asked.join(held.hint("merge"), side)
    both = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    exact = both * 100 >= (F.col("n_a") + F.col("n_b") - both) * percent
    return asked.where(exact).select("a", "b", "comp_a", "comp_b")


def merged(edges: DataFrame) -> DataFrame:
    """``comp, label`` for the components of ``a, b`` whose label changes: the smallest
    component at most two edges away.

    It need not be all of what belongs together; equal labels do belong together.
    """
    both = edges.union(edges.select("b", "a"))
    near = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    further = both.join(near.withColumnsRenamed({"a": "b", "m": "further"}).hint("merge"), "b")
    least = further.groupBy("a").agg(F.min("further").alias("label"))
    return least.where("label < a").withColumnRenamed("a", "comp")


def class_components(docs: DataFrame, classes: DataFrame, percent: int, text: str) -> DataFrame | None:
    """``cid, comp`` of the classes that are linked to another one; None if none is.

    In each turn the pivots of a bucket are compared with those of the bucket that are not
    yet known to be in the same component. A bucket is left when one component holds all
    that may still be linked, so a group of near copies costs few comparisons for each copy,
    and no link between components is passed over: in the end every pair of a bucket is
    compared, known to be joined or ruled out by a bound. The links of all turns give the
    components. Joins keep their order (merge joins), as in most of them neither side is small.
    """
    members = cut(bucket_members(classes), "members")
    ends = members.select("cid").distinct()
    wanted = classes.join(ends.hint("merge"), "cid", "left_semi").select("cid", "source.*")
    sets = cut(full_sets(docs, wanted, text), "sets")
    unshared = shared_shingles(sets)
    brief = (
        classes.select(
            "cid",
            F.col("cid").alias("comp"),
            F.col("n_shingles").alias("n"),
            "signature",
            # 32 bits of each band: enough to tell whether two classes share it.
            F.transform("bands", lambda x: F.shiftright(x, 32).cast("int")).alias("marks"),
        )
        .join(unshared.hint("merge"), "cid", "left")
        .withColumn("shared", F.col("n") - F.coalesce("unshared", F.lit(0)))
        .where(F.col("shared") * 100 >= F.col("n") * percent)
        .drop("unshared")
    )
    places = by_class(members).join(brief.hint("merge"), "cid")
    edges: list[DataFrame] = []

    def linked(pairs: DataFrame, rest: DataFrame) -> DataFrame:
        """``rest`` with the components that the pairs' links tie together."""
        links, found = cut_measured(confirmed(pairs, sets, percent), "links", n=F.count("*"))
        if not found["n"]:
            return rest
        edges.append(links.select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")))
        labels = cut(merged(edges[-1]), "labels")
        known = rest.join(labels.hint("merge"), "comp", "left")
        # Dealt by class again: a large component would be one task's.
        return known.withColumn("comp", F.coalesce("label", "comp")).drop("label").repartition("cid")

    turn, rest = 1, linked(star_pairs(members, brief, percent), places)
    while True:
        if turn > 1:  # few are left: it pays to take their sets apart again
            rest = recounted(rest, sets, percent)
        live, left = cut_measured(opened(rest, turn, percent), "members", n=F.count("*"))
        if not left["n"]:
            break
        rest = by_class(live.where("not last and not pivot"), *_CLASS)
        rest = linked(candidates(live, percent), rest)
        turn += 1
    if not edges:
        return None
    roots = connected_components(reduce(DataFrame.union, edges))
    own = roots.select("root", F.col("root").alias("comp")).distinct()
    return roots.union(own).toDF("cid", "comp")


def shingle_classes(signed: DataFrame) -> DataFrame:
    """One stored row per set of shingles: copies combine before the shuffle."""
    return cut(
        signed.where("class is not null")
        .groupBy("class")
        .agg(
            F.min("doc_id").alias("least"),
            F.min(F.struct("t1", "t2", "doc_id")).alias("source"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
            F.first("bands").alias("bands"),
        )
        .withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )


def stored(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` gives, written; all that was stored on the way is removed."""
    path = scratch_path(spark, label)
    with scratch_scope(spark):
        made = make()
        made.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def text_groups(docs: DataFrame, among: DataFrame, percent: int = 80, text: str = "text") -> DataFrame:
    """``t1, t2, group`` of the texts that ``among`` names by ``t1, t2``, one row each.

    Texts of a group are tied by links as in ``near_duplicates``, whatever their ids; links
    with texts outside ``among`` do not count. Texts without words have no row. The result
    is stored.
    """

    def make() -> DataFrame:
        first, second = text_key(text)
        keyed = docs.select(F.col("doc_id"), F.col(f"`{text}`").alias(text), first.alias("__t1"), second.alias("__t2"))
        named_texts = among.select(F.col("t1").alias("__t1"), F.col("t2").alias("__t2")).distinct()
        asked = keyed.join(named_texts, ["__t1", "__t2"], "left_semi").select("doc_id", text)
        each = (
            signatures(asked, text)
            .where("class is not null")
            .groupBy("t1", "t2")
            .agg(
                F.min("doc_id").alias("doc_id"),
                *[F.first(c).alias(c) for c in ("n_shingles", "class", "signature", "bands")],
            )
        )
        signed = cut(each, "signatures")
        classes = shingle_classes(signed)
        comps = class_components(docs, classes, percent, text)
        named = classes.select("class", F.col("cid").alias("group"))
        if comps is not None:
            found = comps.select(F.col("cid").alias("group"), "comp")
            named = named.join(found, "group", "left").select("class", F.coalesce("comp", "group").alias("group"))
        return signed.select("t1", "t2", "class").join(named, "class").select("t1", "t2", "group")

    return stored(docs.sparkSession, "text-groups", make)


def near_duplicates(docs: DataFrame, percent: int = 80, text: str = "text") -> DataFrame:
    """One row per document row: ``doc_id, n_shingles, component_id, kept`` and the text's
    key ``t1, t2``.

    Two texts are linked if 100 times their common shingles are at least ``percent`` times
    all of theirs. ``component_id`` is the smallest doc_id that links reach; ``kept`` says
    that it is the row's own. Null and empty texts are linked with nothing. Equal texts are
    linked whatever their ids; rows that repeat an id are kept or not together. A null
    doc_id never names a component that has another id.
    """
    return marked_rows(docs, percent, text).drop("group")


def marked_rows(docs: DataFrame, percent: int, text: str) -> DataFrame:
    """``near_duplicates`` and ``group``, which tells components apart that have no id or
    share one; null for texts without words. The result is stored.
    """
    return stored(docs.sparkSession, "near-duplicates", lambda: _marked_rows(docs, percent, text))


def _marked_rows(docs: DataFrame, percent: int, text: str) -> DataFrame:
    signed = cut(signatures(docs, text), "signatures")
    classes = shingle_classes(signed)  # copies are one class before anything is compared
    comps = class_components(docs, classes, percent, text)
    named = classes.select("class", "cid", F.col("least").alias("component_id"), F.col("cid").alias("group"))
    if comps is not None:
        known = named.join(comps, "cid")
        least = known.groupBy("comp").agg(F.min("component_id").alias("comp_id"))
        linked_to = comps.join(least, "comp").select("cid", "comp", "comp_id")
        named = named.join(linked_to, "cid", "left")
        named = named.withColumns(
            {"component_id": F.coalesce("comp_id", "component_id"), "group": F.coalesce("comp", "group")}
        )
    named = named.select("class", "component_id", "group")
    rows = signed.select("doc_id", "n_shingles", "t1", "t2", "class")
    linked = rows.where("class is not null").join(named, "class")
    alone = rows.where("class is null").withColumn("component_id", F.col("doc_id"))
    alone = alone.withColumn("group", F.lit(None).cast("long"))
    every = linked.unionByName(alone)
    own = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return every.select("doc_id", "n_shingles", "component_id", own.alias("kept"), "t1", "t2", "group")


def keep_one(docs: DataFrame, percent: int = 80, text: str = "text", repeats: bool = True) -> DataFrame:
    """The documents that ``near_duplicates`` keeps, with all their columns.

    Rows that repeat the kept id all stay, and so do those of a component whose ids are all
    null. Without ``repeats`` exactly one row of each component stays: of the kept id the
    text with the smallest key, and of equal rows the one whose columns hash lowest. Texts
    without words are in no component and stay in either case.
    """
    kept = marked_rows(docs, percent, text).where("kept")
    if not repeats:
        counted = kept.where("group is not null").groupBy("group", "doc_id", "t1", "t2").agg(F.count("*").alias("rows"))
        chosen = counted.groupBy("group").agg(F.min(F.struct("doc_id", "t1", "t2", "rows")).alias("chosen"))
        wordless = kept.where("group is null").select("doc_id", "t1", "t2", F.lit(1).cast("long").alias("rows"))
        kept = cut(chosen.select("chosen.*").unionByName(wordless), "kept")
    renamed = {"doc_id": "__id", "t1": "__t1", "t2": "__t2"}
    kept = kept.select(*[F.col(c).alias(n) for c, n in renamed.items()], *([] if repeats else ["rows"]))
    first, second = text_key(text)
    keyed = without(docs, "__a", "__b").withColumns({"__a": first, "__b": second})
    same = (
        (F.col("__a") == F.col("__t1"))
        & (F.col("__b") == F.col("__t2"))
        & F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))
    )
    if repeats or kept.where("rows > 1").isEmpty():
        return keyed.join(kept, same, "left_semi").drop("__a", "__b")
    single = keyed.join(kept.where("rows = 1"), same, "left_semi").drop("__a", "__b")
    again = keyed.join(kept.where("rows > 1"), same, "left_semi")
    names = [F.col(f"`{c}`") for c in single.columns]
    one = again.groupBy("__a", "__b", F.col("doc_id").cast("long").alias("__id")).agg(
        F.min_by(F.struct(*names), F.xxhash64(*names)).alias("__row")
    )
    return single.unionByName(one.select("__row.*"))
