"""Discover, merge and assign categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from gitloom.functions.prompts import assignment_prompt, dedup_prompt, discovery_prompt
from gitloom.functions.text import strip
from gitloom.operators.documents import metadata_value
from gitloom.operators.inference import MAX_RETRIES, Model, infer
from gitloom.operators.near_pairs import similar_pairs
from gitloom.operators.ordering import keep_first, ordered_prefix
from gitloom.operators.packing import pack_lines
from gitloom.session import cut, cut_measured

# --- fixed values ---
OTHER = "Other"
RARE_BELOW = 10
# --- end of fixed values ---
# No text is longer: prompts are split only where the caller gives a limit.
UNLIMITED = 1 << 62
STUB_TERMS = 3
STUB_WORD = "[a-z]{4,}"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(STUB_WORD), F.lit(0))


# --- discovery -------------------------------------------------------------------


def numbered_summaries(batched: DataFrame) -> DataFrame:
    """``batch, n, line`` with ``Summary <n>: <text>`` numbered per batch by ``ord``."""
    ranked = ordered_prefix(batched.select("batch", "ord", "text"), ["batch"], ["ord"], None, "n")
    return ranked.select(
        "batch", "n", F.concat(F.lit("Summary "), F.col("n").cast("string"), F.lit(": "), "text").alias("line")
    )


def discovery_prompts(batched: DataFrame, max_chars: int | None = None) -> DataFrame:
    """One prompt per batch, or several with running numbers where ``max_chars`` is given."""
    packed = pack_lines(numbered_summaries(batched), ["batch"], "n", "line", max_chars or UNLIMITED)
    return packed.select("batch", "chunk_no", discovery_prompt(F.col("text")).alias("prompt"))


def _require_completed(replies: DataFrame, what: str, *named: str) -> None:
    """A failed reply ends the job: nothing may be missing from its result."""
    failed = replies.where("status = 'failed'")
    first = failed.select(*named, "error").orderBy(*named).first()
    if first:
        names = ", ".join(f"{n} {first[n]}" for n in named)
        raise ValueError(f"{failed.count()} replies failed in {what} ({names}): {first.error}")


def discover(
    batched: DataFrame, model: Model, max_retries: int = MAX_RETRIES, max_chars: int | None = None
) -> DataFrame:
    """``batch, chunk_no, pos, category`` as the model lists them, duplicates kept.

    A batch whose reply fails is an error.
    """
    prompts = discovery_prompts(batched, max_chars)
    replies = cut(
        infer(prompts, "prompt", "categories", model, max_retries, "array<string>"), "discovered"
    )
    _require_completed(replies, "category discovery", "batch")
    return replies.select("batch", "chunk_no", F.posexplode("value").alias("pos", "category"))


def discover_terms(batched: DataFrame, k: int = STUB_TERMS) -> DataFrame:
    """Offline stand-in for :func:`discover`: the most frequent words of each batch.

    Spark limits the ranks before the shuffle, so a large batch costs k rows per task.
    """
    counts = (
        batched.select("batch", F.explode(words(F.col("text"))).alias("category"))
        .groupBy("batch", "category")
        .agg(F.count("*").alias("n"))
    )
    order = Window.partitionBy("batch").orderBy(F.desc("n"), "category")
    return (
        counts.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("batch", F.lit(0).cast("long").alias("chunk_no"), (F.col("rank") - 1).alias("pos"), "category")
    )


def in_batch_order(discovered: DataFrame) -> DataFrame:
    """The concatenated list as rows ``n, category``: batch order, duplicates kept."""
    keyed = discovered.withColumn("__all", F.lit(0))
    return ordered_prefix(keyed, ["__all"], ["batch", "chunk_no", "pos"], None, "n").select("n", "category")


# --- merging ---------------------------------------------------------------------


def merge_spellings(categories: DataFrame) -> DataFrame:
    """Drop repeats that differ in case or spacing only; the first spelling stays."""
    key = F.lower(F.regexp_replace(strip(F.col("category")), r"(?U)\s+", " "))
    return keep_first(categories.withColumn("__key", key), ["__key"], ["n"]).select("n", "category")


def merge_similar(categories: DataFrame, percent: int = 60) -> DataFrame:
    """Merge names that are nearly the same without a model; the first of a group stays.

    Names are compared as sets of three characters in lower case, with single spaces, and
    tied at a Jaccard similarity of ``percent``; what ties connect is one category. Names of
    fewer than three characters are tied with equal ones only.
    """
    folded = F.lower(F.regexp_replace(strip(F.col("category")), r"(?U)\s+", " "))
    n = F.length("__name")
    grams = F.transform(
        F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1))), lambda i: F.substring("__name", i, 3)
    )
    named = cut(merge_spellings(categories).select("n", "category", folded.alias("__name")), "names")
    pairs = similar_pairs(named.select("n", grams.alias("items")), percent, "n", measure="jaccard")
    # Different names can have the same three-character sets: they are one class.
    sets = named.select("n", F.sort_array(F.array_distinct(grams)).alias("items"))
    first = sets.groupBy("items").agg(F.min("n").alias("first"))
    edges = pairs.select("a", "b").union(
        sets.join(first, "items").where("n != first").select(F.col("first").alias("a"), F.col("n").alias("b"))
    )
    roots = smallest_of_component(edges)
    return named.join(roots, named.n == roots.node, "left_anti").select("n", "category")


def smallest_of_component(edges: DataFrame) -> DataFrame:
    """``node, root`` for the ends of ``a < b`` that are not the smallest of their component:
    each takes the smallest root among its neighbours' until no root changes."""
    both = cut(edges.union(edges.select("b", "a")).distinct(), "ties")
    state = both.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    moved = 1
    while moved:
        beside = both.join(state.withColumnsRenamed({"node": "b", "root": "other"}), "b")
        least = beside.groupBy("a").agg(F.min("other").alias("other")).withColumnRenamed("a", "node")
        near = state.join(least, "node").select("node", F.least("root", "other").alias("low"), "root")
        # A root's own root is followed too, so rounds grow with the logarithm of a chain.
        own = near.select(F.col("node").alias("low"), F.col("low").alias("lower"))
        state, seen = cut_measured(
            near.join(own, "low").select("node", F.col("lower").alias("root"), (F.col("lower") != F.col("root")).alias("moved")),
            "roots",
            moved=F.count_if("moved"),
        )
        state, moved = state.drop("moved"), seen["moved"]
    return state.where("node != root")


def dedup_prompts(categories: DataFrame, max_chars: int | None = None) -> DataFrame:
    """``chunk_no, prompt, fits`` over the bulleted list."""
    lines = categories.select(
        F.lit(0).alias("__all"), "n", F.concat(F.lit("- "), "category").alias("line")
    )
    return pack_lines(lines, ["__all"], "n", "line", max_chars or UNLIMITED).select(
        "chunk_no", dedup_prompt(F.col("text")).alias("prompt"), "fits"
    )


def merge_with_model(
    categories: DataFrame, model: Model, max_chars: int | None = None
) -> DataFrame:
    """Let the model merge near-duplicates in one call.

    Where the caller gives ``max_chars``, a longer list is merged piece by piece and the
    result merged again, until it fits; a round that leaves as many categories is an error.
    """
    current, before = categories, None
    while True:
        replies = cut(
            infer(
                dedup_prompts(current, max_chars), "prompt", "categories", model, kind="array<string>"
            ),
            "merged",
        )
        _require_completed(replies, "category merge", "chunk_no")
        rows = replies.select(
            F.lit(0).alias("__all"), "chunk_no", F.posexplode("value").alias("pos", "category")
        )
        current = cut(
            ordered_prefix(rows, ["__all"], ["chunk_no", "pos"], None, "n").select("n", "category"),
            "categories",
        )
        if replies.where("not fits").isEmpty():
            return current
        now = current.count()
        if before is not None and now >= before:
            raise ValueError(f"the category list stays at {now} and is longer than {max_chars} characters")
        before = now


# --- assignment ------------------------------------------------------------------


def assignment_prompts(docs: DataFrame, categories: DataFrame, max_chars: int | None = None) -> DataFrame:
    """``id, piece, prompt``: the list is part of every prompt, whole or, where the caller
    gives ``max_chars``, in pieces of that length."""
    lines = categories.select(
        F.lit(0).alias("__all"), "n", F.concat(F.lit("- "), "category").alias("line")
    )
    packed = cut(pack_lines(lines, ["__all"], "n", "line", max_chars or UNLIMITED), "category-list")
    pieces = F.sort_array(F.collect_list(F.struct("chunk_no", "text")))
    texts = F.transform(pieces, lambda p: p["text"])
    listings = packed.agg(F.when(F.count("*") == 0, F.array(F.lit(""))).otherwise(texts).alias("p"))
    held = docs.select("id", "document", listings.scalar().alias("listings"))
    asked = held.select("id", "document", F.posexplode("listings").alias("piece", "listing"))
    return asked.select(
        "id", "piece", assignment_prompt(F.col("listing"), F.col("document")).alias("prompt")
    )


def assign(
    docs: DataFrame,
    categories: DataFrame,
    model: Model,
    max_retries: int = MAX_RETRIES,
    max_chars: int | None = None,
) -> DataFrame:
    """``id, category, status, error``: the model's answer as given.

    With a list in pieces a document is asked once per piece, and once more for a choice
    among the different answers. A document is failed if one of its replies is.
    """
    prompts = assignment_prompts(docs, categories, max_chars)
    replies = infer(prompts, "prompt", "category", model, max_retries)
    if max_chars is None:
        return replies.select("id", F.col("value").alias("category"), "status", "error")
    asked = cut(replies.select("id", "piece", "value", "status", "error"), "pieces")
    answers = asked.groupBy("id").agg(
        F.array_distinct(
            F.transform(F.sort_array(F.collect_list(F.struct("piece", "value"))), lambda r: r["value"])
        ).alias("found"),
        F.min(F.when(F.col("status") == "failed", F.coalesce("error", F.lit("failed")))).alias("error"),
    )
    open_ = answers.where(F.col("error").isNull() & (F.size("found") > 1)).join(docs, "id")
    listing = F.array_join(F.transform("found", lambda v: F.concat(F.lit("- "), v)), "\n")
    finals = open_.select("id", assignment_prompt(listing, F.col("document")).alias("prompt"))
    chosen = infer(finals, "prompt", "category", model, max_retries)
    chosen = chosen.select("id", F.col("value").alias("category"), "status", "error")
    settled = answers.where(F.col("error").isNotNull() | (F.size("found") <= 1)).select(
        "id",
        F.when(F.col("error").isNull(), F.try_element_at("found", F.lit(1))).alias("category"),
        F.when(F.col("error").isNull(), "completed").otherwise("failed").alias("status"),
        "error",
    )
    return settled.unionByName(chosen)


def assign_by_words(docs: DataFrame, categories: DataFrame) -> DataFrame:
    """Offline stand-in for :func:`assign`: the category whose words occur most often.

    Ties go to the smaller name; a document without any category word is ``Other``.
    """
    category_words = categories.select(
        "category", F.explode(F.array_distinct(words(F.col("category")))).alias("word")
    ).distinct()
    hits = (
        docs.select("id", F.explode(words(F.col("document"))).alias("word"))
        .join(category_words, "word")
        .groupBy("id", "category")
        .agg(F.count("*").alias("n"))
        .groupBy("id")
        .agg(F.min(F.struct((-F.col("n")).alias("n"), "category")).alias("best"))
        .select("id", F.col("best.category").alias("category"))
    )
    return docs.select("id").join(hits, "id", "left").select(
        "id", F.coalesce("category", F.lit(OTHER)).alias("category")
    )


def flag_off_list(assigned: DataFrame, categories: DataFrame, replace: bool = False) -> DataFrame:
    """Mark answers that are not on the list; ``replace`` turns them into ``Other``."""
    known = categories.select("category").distinct().withColumn("__known", F.lit(True))
    off = F.col("__known").isNull() & (F.col("category") != OTHER)
    marked = assigned.join(known, "category", "left").withColumn("off_list", off)
    if replace:
        marked = marked.withColumn("category", F.when(off, OTHER).otherwise(F.col("category")))
    return marked.drop("__known")


def categorised(collection: DataFrame, assigned: DataFrame) -> DataFrame:
    """The categorised rows, joined by id; ``off_list`` comes along where it is known."""
    flag = [c for c in ("off_list",) if c in assigned.columns]
    return collection.join(assigned.select("id", "category", *flag), "id").select(
        F.col("id").alias("commit_hash"),
        "category",
        *flag,
        F.col("document").alias("semantic_summary"),
        metadata_value("repo_id").alias("repo_id"),
        metadata_value("commit_message").alias("commit_message"),
    )


# --- roll-up ---------------------------------------------------------------------


def category_counts(df: DataFrame) -> DataFrame:
    """Rows per category, ascending; rows without category are not counted."""
    return (
        df.where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(F.count("*").alias("n"))
        .orderBy("n", "category")
    )


def with_category_count(df: DataFrame) -> DataFrame:
    """Add the row count of each row's category; null when it has none.

    Counting by aggregation and joining back keeps a category with most of the rows
    out of a single window task.
    """
    counts = df.where(F.col("category").isNotNull()).groupBy("category").agg(
        F.count("*").alias("cat_count")
    )
    return df.join(counts, "category", "left")


def roll_up_rare(df: DataFrame, threshold: int = RARE_BELOW, counted: DataFrame | None = None) -> DataFrame:
    """Categories with fewer than ``threshold`` rows become ``Other``; null stays null.

    The rows of ``counted`` are counted, by default those of ``df``. ``df`` meets the rare ones
    by category, so long texts are better joined afterwards.
    """
    rare = (
        (df if counted is None else counted).where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") < threshold)
        .select("category", F.lit(True).alias("__rare"))
    )
    return df.join(rare, "category", "left").withColumn(
        "category", F.when(F.col("__rare"), OTHER).otherwise(F.col("category"))
    ).select(*df.columns)


def unique_categories(df: DataFrame) -> DataFrame:
    return df.select("category").distinct()


def one_batch(batched: DataFrame, batch: int) -> DataFrame:
    return batched.where(F.col("batch") == batch)
