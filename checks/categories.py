"""Batches, categories and the disagreement analysis."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from checks import common as c
from gitloom.functions import prompts as pr
from gitloom.functions.text import bigram_set
from gitloom.functions.vectors import set_cosine_distance
from gitloom.operators import batches as bt
from gitloom.operators import categories as ct
from gitloom.operators import disagreement as ds
from gitloom.operators import near_pairs as np
from gitloom.operators.documents import stub_embedder, to_collection
from gitloom.operators.ordering import ordered_prefix
from gitloom.plans import categorise as plan
from gitloom.plans.analyse import analyse
from gitloom.session import cut, scratch_path
from gitloom.sources import collection as store
from gitloom.sources import tables


TEXTS_PER_TASK = 8192


def batched(spark, sf):
    """Documents in batches by source; the document id is the order."""
    return c.table(spark, sf, "documents").selectExpr(
        "cast(substr(source, 4) as int) as batch", "doc_id as ord", "text"
    )


D_BATCHED = (
    "batched as (select cast(substr(source, 4) as int) as batch, doc_id as ord, text from documents), "
    "numbered as (select *, row_number() over (partition by batch order by ord) as n from batched)"
)
D_TERMS = (
    f"{D_BATCHED}, terms as (select batch, term, count(*) as cnt from (select batch, "
    "unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) as term from batched) group by all), "
    "found as (select batch, term as category, row_number() over (partition by batch "
    "order by cnt desc, term) - 1 as pos from terms qualify pos < 3), "
    "listed as (select row_number() over (order by batch, pos) as n, category from found)"
)


def ordinals(spark, sf):
    return ordered_prefix(batched(spark, sf), ["batch"], ["ord"], None, "n").select("batch", "ord", "n")


def discovery_prompts(spark, sf):
    return ct.discovery_prompts(batched(spark, sf), 10_000_000).select(
        "batch", c.md5_of("prompt", "prompt_md5")
    )


def single_batch(spark, sf):
    return ct.one_batch(batched(spark, sf), 7).select("ord", c.md5_of("text", "text_md5"))


def discovered(spark, sf):
    return ct.discover_terms(batched(spark, sf)).select("batch", "pos", "category")


def concatenated(spark, sf):
    return ct.in_batch_order(ct.discover_terms(batched(spark, sf)))


def _spellings(spark, sf):
    return c.table(spark, sf, "part").selectExpr(
        "p_partkey as n",
        "case p_partkey % 3 when 0 then upper(p_name) when 1 then ' ' || replace(p_name, ' ', '  ') "
        "else p_name end as category",
    )


D_SPELLINGS = (
    "spellings as (select p_partkey as n, case p_partkey % 3 when 0 then upper(p_name) "
    "when 1 then ' ' || replace(p_name, ' ', '  ') else p_name end as category from part), "
    "merged as (select arg_min(category, n) as category, min(n) as n from spellings "
    "group by lower(regexp_replace(trim(category), '\\s+', ' ', 'g')))"
)


def merged(spark, sf):
    return ct.merge_spellings(_spellings(spark, sf))


def dedup_prompts(spark, sf):
    return ct.dedup_prompts(_spellings(spark, sf)).select("chunk_no", c.md5_of("prompt", "prompt_md5"))


def _category_list(spark, sf):
    return c.table(spark, sf, "documents").groupBy(F.col("source").alias("category")).agg(
        F.min("doc_id").alias("n")
    )


def assignment_prompts(spark, sf):
    docs = c.table(spark, sf, "documents").selectExpr("doc_id as id", "text as document")
    return ct.assignment_prompts(docs, _category_list(spark, sf)).select("id", c.md5_of("prompt", "prompt_md5"))


def assigned(spark, sf):
    docs = c.table(spark, sf, "documents").selectExpr("doc_id as id", "text as document")
    return ct.assign_by_words(docs, ct.merge_spellings(concatenated(spark, sf)))


D_ASSIGNED = (
    f"{D_TERMS}, choices as (select distinct category from listed), "
    "choice_words as (select distinct category, unnest(regexp_extract_all(lower(category), '[a-z]{4,}')) as word "
    "from choices), doc_words as (select doc_id, word, count(*) as cnt from (select doc_id, "
    "unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) as word from documents) group by all), "
    "scores as (select doc_id, category, sum(cnt) as s from doc_words join choice_words using (word) group by all), "
    "best as (select doc_id, category from scores qualify row_number() over "
    "(partition by doc_id order by s desc, category) = 1), "
    "assigned as (select doc_id, coalesce(category, 'Other') as category from documents left join best using (doc_id))"
)


def _collection(spark, sf):
    docs = c.table(spark, sf, "documents").selectExpr(
        "md5(cast(doc_id as string)) as commit_hash", "'org/' || source as repo_id",
        "'commit ' || doc_id as commit_message", "cast(null as string) as pr_message",
        "cast(null as long) as pr_id", "text as semantic_summary",
    )
    root = scratch_path(spark, "collection")
    store.replace_all(to_collection(docs, stub_embedder()), root)
    return root


def projected(spark, sf):
    collection = store.read_collection(spark, _collection(spark, sf))
    answers = c.table(spark, sf, "documents").selectExpr("md5(cast(doc_id as string)) as id", "lang as category")
    return ct.categorised(collection, answers).select(
        "commit_hash", "category", c.md5_of("semantic_summary", "summary_md5"), "repo_id", "commit_message"
    )


def categorise_given_batches(spark, sf):
    """The categorise job with stand-in models and the sources as batches."""
    given = c.table(spark, sf, "documents").selectExpr(
        "md5(cast(doc_id as string)) as id", "cast(substr(source, 4) as int) as batch"
    )
    out = scratch_path(spark, "categorised")
    plan.run(spark, _collection(spark, sf), out, batches=given)
    return spark.read.parquet(out).select("commit_hash", "category", "repo_id")


def rolled_up_part(spark, sf):
    rare = c.table(spark, sf, "documents").selectExpr(
        "doc_id",
        "case when doc_id % 31 = 0 then null when doc_id % 29 = 0 then lang || source else lang end as category",
    )
    return ct.roll_up_rare(rare)


D_RARE = (
    "rare as (select doc_id, case when doc_id % 31 = 0 then null when doc_id % 29 = 0 then lang || source "
    "else lang end as category from documents), counted as (select *, count(category) over "
    "(partition by category) as cat_count from rare)"
)


def category_count_column(spark, sf):
    rare = c.table(spark, sf, "documents").selectExpr(
        "doc_id",
        "case when doc_id % 31 = 0 then null when doc_id % 29 = 0 then lang || source else lang end as category",
    )
    return ct.with_category_count(rare).select("doc_id", "category", "cat_count")


def category_counts(spark, sf):
    return ct.category_counts(c.table(spark, sf, "part").select(F.col("p_brand").alias("category")))


def unique_categories(spark, sf):
    return ct.unique_categories(c.table(spark, sf, "part").select(F.col("p_type").alias("category")))


def category_sink(spark, sf):
    path = scratch_path(spark, "by-category")
    rows = c.table(spark, sf, "documents").selectExpr(
        "doc_id", "case when doc_id % 31 = 0 then null when doc_id % 2 = 0 then lang || '/x' else lang || '_x' end as category"
    )
    tables.write_by_category(rows, path)
    return spark.read.parquet(path).groupBy("category", "category_dir").agg(F.count("*").alias("n"))


def category_partition(spark, sf):
    path = scratch_path(spark, "by-category")
    rows = c.table(spark, sf, "documents").selectExpr("doc_id", "lang || '/x' as category")
    tables.write_by_category(rows, path)
    return tables.read_category(spark, path, "fr/x", rows.schema)


def stages(spark, sf):
    """A finished stage is read, not rebuilt; overwriting builds it again."""
    root = scratch_path(spark, "stages")
    docs = c.table(spark, sf, "documents")
    plan.stage(spark, root, "one", lambda: docs.select("doc_id", F.lit("first").alias("built")))
    kept = plan.stage(spark, root, "one", lambda: docs.select("doc_id", F.lit("second").alias("built")))
    kept = kept.groupBy("built").agg(F.count("*").alias("n"))
    again = plan.stage(
        spark, root, "two", lambda: docs.select("doc_id", F.lit("third").alias("built")), overwrite=True
    )
    return kept.unionByName(again.groupBy("built").agg(F.count("*").alias("n")))


def batch_numbers(spark, sf):
    """Every vector has a batch, and the number of batches is the wanted one."""
    vectors = c.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    batches = bt.kmeans_batches(vectors)
    return vectors.select("id").join(batches, "id", "left").select(
        "id",
        F.col("batch").isNotNull().alias("has_batch"),
        batches.select(F.count_distinct("batch")).scalar().alias("n_batches"),
    )


def batch_k(spark, sf):
    return bt.batch_count_column(c.table(spark, sf, "embeddings"))


# --- disagreement ----------------------------------------------------------------


def runs(spark, sf):
    """Three runs: the text, the text of the next document, and every second text with other letters."""
    docs = c.table(spark, sf, "documents")
    frames = {
        "a": docs.selectExpr("doc_id as commit_hash", "text as semantic_summary"),
        "b": docs.selectExpr("doc_id - 1 as commit_hash", "text as semantic_summary"),
        "c": docs.where("doc_id % 2 = 0").selectExpr("doc_id as commit_hash", "replace(text, 'e', 'a') as semantic_summary"),
    }
    paths = {}
    for name, frame in frames.items():
        paths[name] = scratch_path(spark, f"run-{name}")
        frame.withColumn("commit_hash", F.col("commit_hash").cast("string")).write.parquet(paths[name])
    return tables.read_runs(spark, paths)


D_RUNS = (
    "runs as (select cast(doc_id as varchar) as commit_hash, text as semantic_summary, 'a' as source_file "
    "from documents union all select cast(doc_id - 1 as varchar), text, 'b' from documents union all "
    "select cast(doc_id as varchar), replace(text, 'e', 'a'), 'c' from documents where doc_id % 2 = 0)"
)


D_TOKENS = "regexp_extract_all(lower(semantic_summary), '[\\pL\\pN_\\pM]{2,}')"
D_SETS = (
    f"{D_RUNS}, toks as (select *, {D_TOKENS} as t from runs), sets as (select commit_hash, source_file, "
    "list_distinct(list_transform(list_zip(t[:-2], t[2:]), lambda p: p[1] || ' ' || p[2])) as b from toks)"
)
D_PAIRS = (
    f"{D_SETS}, pairs as (select x.commit_hash, x.source_file as source_1, y.source_file as source_2, "
    "len(x.b) as n1, len(y.b) as n2, len(list_intersect(x.b, y.b)) as shared from sets x join sets y "
    "on x.commit_hash = y.commit_hash and x.source_file < y.source_file), "
    "distances as (select commit_hash, source_1, source_2, case when n1 > 0 and n2 > 0 then "
    "1 - shared / sqrt(n1::double * n2) end as distance, sqrt((n1 + n2 - 2 * shared)::double) as euclidean from pairs)"
)


def _pairs(spark, sf, rows=None):
    """The pairs of the runs, stored: they are small, and what follows reads them more than once."""
    return cut(ds.run_pairs(rows or runs(spark, sf), ["semantic_summary"]), "pairs")


def _rounded(df, *columns):
    return df.withColumns({name: F.round(name, 6) for name in columns})


def run_rows(spark, sf):
    return runs(spark, sf).groupBy("source_file").agg(
        F.count("*").alias("n"), F.sum(F.length("semantic_summary")).alias("chars")
    )


def bigram_rows(spark, sf):
    docs = c.table(spark, sf, "documents")
    # The bigrams of one task are sorted: with this few texts in a task that is done in memory.
    docs = docs.repartition(math.ceil(max(docs.count(), 1) / TEXTS_PER_TASK), "doc_id", "text")
    return ds.bigram_terms(docs, "doc_id", "text").groupBy("doc_id").agg(
        F.count("*").alias("n"), F.min("bigram").alias("first"), F.max("bigram").alias("last")
    )


D_DOC_BIGRAMS = (
    "toks as (select doc_id, regexp_extract_all(lower(text), '[\\pL\\pN_\\pM]{2,}') as t from documents), "
    "bigrams as (select doc_id, unnest(list_distinct(list_transform(list_zip(t[:-2], t[2:]), "
    "lambda p: p[1] || ' ' || p[2]))) as bigram from toks where len(t) > 1)"
)


def term_rows(spark, sf):
    return ds.bigram_terms(c.table(spark, sf, "documents"), "doc_id", "text")


def sparse_rows(spark, sf):
    """Each text's bigrams as places in the sorted vocabulary."""
    vectors, words = ds.sparse_terms(c.table(spark, sf, "documents"), "doc_id", "text")
    places = F.array_join(F.col("terms").cast("array<string>"), ",")
    return vectors.select(
        "doc_id", F.size("terms").cast("long").alias("n"), F.md5(places).alias("places_md5"),
        words.select(F.count("*")).scalar().alias("n_terms"),
    )


def sparse_set_distances(spark, sf):
    """Distances between neighbouring documents from their sparse vectors."""
    vectors, _ = ds.sparse_terms(c.table(spark, sf, "documents"), "doc_id", "text")
    vectors = cut(vectors, "vectors")  # both sides read them
    after = vectors.select((F.col("doc_id") - 1).alias("doc_id"), F.col("terms").alias("other"))
    cosine, euclidean = ds.sparse_distances(F.col("terms"), F.col("other"))
    return vectors.join(after, "doc_id").select(
        "doc_id", F.round(cosine, 6).alias("distance"), F.round(euclidean, 6).alias("euclidean")
    )


NEAR_PERCENT = 50


def _document_bigrams(spark, sf):
    return c.table(spark, sf, "documents").select("doc_id", bigram_set(F.col("text")).alias("bigrams"))


def near_pairs(spark, sf):
    """All pairs of texts with half their bigrams in common, nearest first."""
    pairs = np.similar_pairs(_document_bigrams(spark, sf), NEAR_PERCENT, "doc_id", "bigrams")
    distance = set_cosine_distance(F.col("shared"), F.col("n_a"), F.col("n_b"))
    return pairs.select(
        F.col("a").alias("doc_1"), F.col("b").alias("doc_2"), F.round(distance, 6).alias("distance"),
        "copies_a", "copies_b",
    )


def unlike_pairs(spark, sf):
    return np.pairs_without_common(_document_bigrams(spark, sf), "doc_id", "bigrams")


def merged_similar(spark, sf):
    return ct.merge_similar(c.table(spark, sf, "part").select(F.col("p_partkey").alias("n"), F.col("p_name").alias("category")))


def pair_distances(spark, sf):
    return _rounded(_pairs(spark, sf), "distance", "euclidean")


def pair_keys(spark, sf):
    return _pairs(spark, sf).select("commit_hash", "source_1", "source_2")


def top_texts(spark, sf):
    rows = runs(spark, sf)
    top = ds.top_pairs(_pairs(spark, sf, rows), ["commit_hash", "source_1", "source_2"])
    out = ds.with_summaries(top, rows, ["semantic_summary"])
    return out.select(
        "commit_hash", "source_1", "source_2", c.md5_of("summary_1", "md5_1"), c.md5_of("summary_2", "md5_2")
    )


def zscores(spark, sf):
    return _rounded(ds.with_zscore(_pairs(spark, sf)), "distance_zscore").select(
        "commit_hash", "source_1", "source_2", "distance_zscore"
    )


def analysed(spark, sf):
    """The largest gaps of the whole chain, without two commits."""
    top = analyse(runs(spark, sf), ["semantic_summary"], ["12", "40"]).top
    return top.select(
        "commit_hash", "source_1", "source_2", F.round("distance_zscore", 6).alias("zscore"),
        c.md5_of("summary_1", "md5_1"), c.md5_of("summary_2", "md5_2"),
    )


def statistics(spark, sf):
    """Mean and deviation before and after leaving out one commit."""
    pairs = _pairs(spark, sf)
    before = ds.distance_stats(pairs).withColumn("kind", F.lit("all"))
    after = ds.distance_stats(ds.drop_commits(pairs, ["12"])).withColumn("kind", F.lit("filtered"))
    return _rounded(before.unionByName(after), "mean", "std")


def without_outlier(spark, sf):
    return ds.drop_commits(_pairs(spark, sf), ["12", "40"]).groupBy("source_1", "source_2").agg(
        F.count("*").alias("n")
    )


def bins(spark, sf):
    return ds.histogram(c.table(spark, sf, "lineitem").select("l_extendedprice"), "l_extendedprice")


def column_counts(spark, sf):
    return ds.non_null_counts(c.summaries(spark, sf))


def ranked(spark, sf):
    """The whole ranking by euclidean distance."""
    order = ["commit_hash", "source_1", "source_2"]
    return _rounded(ds.rank_pairs(_pairs(spark, sf), order, "euclidean"), "euclidean").select(*order, "euclidean")


def top_ten(spark, sf):
    return _rounded(ds.top_pairs(_pairs(spark, sf), ["commit_hash", "source_1", "source_2"]), "distance").select(
        "commit_hash", "source_1", "source_2", "distance"
    )


def sorted_rows(spark, sf):
    return ds.sort_by_commit(runs(spark, sf)).select("commit_hash", "source_file")


def samples(spark, sf):
    return tables.head(c.table(spark, sf, "orders"), ["o_orderkey"], 100).select("o_orderkey", "o_custkey")


def csv_round_trip(spark, sf):
    path = scratch_path(spark, "csv")
    docs = c.table(spark, sf, "documents").select("doc_id", "text", "lang")
    tables.write_csv(docs, path)
    return tables.read_csv(spark, path, docs.schema).select("doc_id", c.md5_of("text", "text_md5"), "lang")


CHECKS = {
    "p20_discovery_prompt": (
        discovery_prompts,
        f"with {D_BATCHED} select batch, md5("
        + "'" + pr.CATEGORY_DISCOVERY.replace("'", "''")
        + "' || chr(10) || string_agg('Summary ' || n || ': ' || text, chr(10) order by n)) as prompt_md5 "
        "from numbered group by batch",
    ),
    "p21_dedup_prompt": (
        dedup_prompts,
        f"with {D_SPELLINGS} select cast(0 as bigint) as chunk_no, md5('"
        + pr.CATEGORY_DEDUPLICATION.replace("'", "''")
        + "' || chr(10) || string_agg('- ' || category, chr(10) order by n)) as prompt_md5 from spellings",
    ),
    "p22_assignment_prompt": (
        assignment_prompts,
        "with list as (select string_agg('- ' || source, chr(10) order by n) as l from "
        "(select source, min(doc_id) as n from documents group by source)) select doc_id as id, md5('"
        + pr.CATEGORY_ASSIGNMENT.replace("'", "''")
        + "' || chr(10) || 'Categories:' || chr(10) || l || chr(10) || chr(10) || 'Summary:' || chr(10) || text) "
        "as prompt_md5 from documents, list",
    ),
    "p23_categorised_rows": (
        projected,
        "select md5(cast(doc_id as varchar)) as commit_hash, lang as category, md5(text) as summary_md5, "
        "'org/' || source as repo_id, 'commit ' || doc_id as commit_message from documents",
    ),
    "p29_one_batch": (
        single_batch, f"with {D_BATCHED} select ord, md5(text) as text_md5 from batched where batch = 7"
    ),
    "w04_batch_ordinals": (ordinals, f"with {D_BATCHED} select batch, ord, n from numbered"),
    "m06_discover_categories": (discovered, f"with {D_TERMS} select batch, pos, category from found"),
    "a15_concatenate_lists": (concatenated, f"with {D_TERMS} select n, category from listed"),
    "m07_merge_categories": (merged, f"with {D_SPELLINGS} select n, category from merged"),
    "m08_assign_categories": (assigned, f"with {D_ASSIGNED} select doc_id as id, category from assigned"),
    "m09_categorise": (
        categorise_given_batches,
        f"with {D_ASSIGNED}, sized as (select *, count(*) over (partition by category) as n from assigned) "
        "select md5(cast(doc_id as varchar)) as commit_hash, case when n < 10 then 'Other' else category end as category, "
        "'org/' || source as repo_id from sized join documents using (doc_id)",
    ),
    "a06_roll_up_rare": (
        rolled_up_part,
        f"with {D_RARE} select doc_id, case when category is null then null when cat_count < 10 then 'Other' "
        "else category end as category from counted",
    ),
    "w01_category_count": (
        category_count_column,
        f"with {D_RARE} select doc_id, category, case when category is not null then cat_count end as cat_count from counted",
    ),
    "t04_category_counts": (
        category_counts, "select p_brand as category, count(*) as n from part group by 1 order by 2, 1"
    ),
    "a11_unique_categories": (unique_categories, "select distinct p_type as category from part"),
    "s13_category_sink": (
        category_sink,
        "select category, replace(category, '/', '_') as category_dir, count(*) as n from (select case when "
        "doc_id % 2 = 0 then lang || '/x' else lang || '_x' end as category from documents where doc_id % 31 <> 0) "
        "group by 1, 2",
    ),
    "s14_category_partition": (
        category_partition, "select doc_id, lang || '/x' as category from documents where lang = 'fr'"
    ),
    "r03_stages": (
        stages,
        "select 'first' as built, count(*) as n from documents union all select 'third', count(*) from documents",
    ),
    "v04_kmeans_batches": (
        batch_numbers,
        "select vec_id as id, true as has_batch, (select greatest(1, cast(ceil(count(*) / 20.0) as bigint)) "
        "from embeddings) as n_batches from embeddings",
    ),
    "v04_batch_count": (batch_k, "select greatest(1, cast(ceil(count(*) / 20.0) as bigint)) as k from embeddings"),
    "p24_bigrams": (
        bigram_rows,
        f"with {D_DOC_BIGRAMS} select doc_id, count(*) as n, min(bigram) as first, max(bigram) as last "
        "from bigrams group by doc_id",
    ),
    "p25_sparse_terms": (
        sparse_rows,
        f"with {D_DOC_BIGRAMS}, vocabulary as (select bigram, row_number() over (order by bigram) - 1 as term "
        "from (select distinct bigram from bigrams)), coded as (select doc_id, count(*) as n, "
        "md5(string_agg(term::varchar, ',' order by term)) as places_md5 from bigrams join vocabulary using (bigram) group by doc_id) "
        "select doc_id, coalesce(n, 0) as n, coalesce(places_md5, md5('')) as places_md5, "
        "(select count(*) from vocabulary) as n_terms from documents left join coded using (doc_id)",
    ),
    "v02_sparse_distances": (
        sparse_set_distances,
        "with toks as (select doc_id, regexp_extract_all(lower(text), '[\\pL\\pN_\\pM]{2,}') as t from documents), "
        "sets as (select doc_id, list_distinct(list_transform(list_zip(t[:-2], t[2:]), lambda p: p[1] || ' ' || p[2])) as b "
        "from toks), pairs as (select x.doc_id, len(x.b) as n1, len(y.b) as n2, len(list_intersect(x.b, y.b)) as shared "
        "from sets x join sets y on y.doc_id = x.doc_id + 1) select doc_id, case when n1 > 0 and n2 > 0 then "
        "round(1 - shared / sqrt(n1::double * n2), 6) end as distance, round(sqrt((n1 + n2 - 2 * shared)::double), 6) as euclidean from pairs",
    ),
    "j09_near_pairs": (
        near_pairs,
        f"with {D_DOC_BIGRAMS}, sets as (select doc_id, list(bigram order by bigram) as b, count(*) as n from bigrams group by doc_id), "
        "classes as (select min(doc_id) as id, count(*) as copies, any_value(n) as n from sets group by b), "
        "entries as (select id, bigram from classes join bigrams on id = doc_id), "
        "met as (select x.id as a, y.id as b, count(*) as shared from entries x join entries y "
        "on x.bigram = y.bigram and x.id < y.id group by x.id, y.id) "
        "select a as doc_1, b as doc_2, round(1 - shared / sqrt(p.n::double * q.n), 6) as distance, "
        "p.copies as copies_a, q.copies as copies_b from met join classes p on p.id = a join classes q on q.id = b "
        f"where shared * shared * 10000 >= p.n * q.n * {NEAR_PERCENT * NEAR_PERCENT}",
    ),
    "j09_unlike_pairs": (
        unlike_pairs,
        f"with {D_DOC_BIGRAMS}, sets as (select doc_id, list(bigram order by bigram) as b from bigrams group by doc_id), "
        "classes as (select min(doc_id) as id from sets group by b), "
        "entries as (select id, bigram from classes join bigrams on id = doc_id), "
        "met as (select distinct x.id as a, y.id as b from entries x join entries y on x.bigram = y.bigram and x.id < y.id) "
        "select count(*) as n_classes, count(*) * (count(*) - 1) // 2 as n_pairs, (select count(*) from met) as n_common from classes",
    ),
    "m07_merge_similar": (
        merged_similar,
        "with recursive names as (select min(p_partkey) as n, lower(regexp_replace(trim(p_name), '\\s+', ' ', 'g')) as name "
        "from part group by 2), grams as (select distinct n, name[i:i + 2] as g from (select n, name, "
        "unnest(range(1, greatest(length(name) - 2, 1) + 1)) as i from names)), sizes as (select n, count(*) as s from grams group by n), "
        "ties as (select a, b from (select x.n as a, y.n as b, count(*) as shared from grams x join grams y on x.g = y.g and x.n <> y.n "
        "group by x.n, y.n) join sizes p on p.n = a join sizes q on q.n = b where shared * 100 >= (p.s + q.s - shared) * 60), "
        "reach as (select n, n as other from names union select reach.n, ties.b from reach join ties on ties.a = reach.other), "
        "firsts as (select n from reach group by n having min(other) = n) "
        "select p_partkey as n, p_name as category from part join firsts on firsts.n = p_partkey",
    ),
    "p25_term_rows": (term_rows, f"with {D_DOC_BIGRAMS} select doc_id, bigram from bigrams"),
    "p26_drop_commits": (
        without_outlier,
        f"with {D_RUNS} select x.source_file as source_1, y.source_file as source_2, count(*) as n from runs x "
        "join runs y on x.commit_hash = y.commit_hash and x.source_file < y.source_file "
        "where x.commit_hash not in ('12', '40') group by all",
    ),
    "j10_cross_run_pairs": (
        pair_keys,
        f"with {D_RUNS} select x.commit_hash, x.source_file as source_1, y.source_file as source_2 from runs x "
        "join runs y on x.commit_hash = y.commit_hash and x.source_file < y.source_file",
    ),
    "j11_top_pair_texts": (
        top_texts,
        f"with {D_PAIRS}, top as (select * from distances order by distance desc nulls last, commit_hash, source_1, "
        "source_2 limit 10) select top.commit_hash, source_1, source_2, md5(r1.semantic_summary) as md5_1, "
        "md5(r2.semantic_summary) as md5_2 from top join runs r1 on r1.commit_hash = top.commit_hash and "
        "r1.source_file = source_1 join runs r2 on r2.commit_hash = top.commit_hash and r2.source_file = source_2",
    ),
    "v02_set_distances": (
        pair_distances,
        f"with {D_PAIRS} select commit_hash, source_1, source_2, round(distance, 6) as distance, "
        "round(euclidean, 6) as euclidean from distances",
    ),
    "w02_zscore": (
        zscores,
        f"with {D_PAIRS}, s as (select avg(distance) as m, stddev_samp(distance) as sd from distances) "
        "select commit_hash, source_1, source_2, round((distance - m) / sd, 6) as distance_zscore from distances, s",
    ),
    "r05_analyse": (
        analysed,
        f"with {D_PAIRS}, kept as (select * from distances where commit_hash not in ('12', '40')), "
        "s as (select avg(distance) as m, stddev_samp(distance) as sd from kept), "
        "top as (select * from kept order by distance desc nulls last, commit_hash, source_1, source_2 limit 10) "
        "select top.commit_hash, source_1, source_2, round((distance - m) / sd, 6) as zscore, "
        "md5(r1.semantic_summary) as md5_1, md5(r2.semantic_summary) as md5_2 from s, top join runs r1 "
        "on r1.commit_hash = top.commit_hash and r1.source_file = source_1 join runs r2 "
        "on r2.commit_hash = top.commit_hash and r2.source_file = source_2",
    ),
    "a12_distance_stats": (
        statistics,
        f"with {D_PAIRS} select 'all' as kind, round(avg(distance), 6) as mean, round(stddev_samp(distance), 6) as std "
        "from distances union all select 'filtered', round(avg(distance), 6), round(stddev_samp(distance), 6) "
        "from distances where commit_hash <> '12'",
    ),
    "a13_histogram": (
        bins,
        "with b as (select min(l_extendedprice) as lo, max(l_extendedprice) as hi from lineitem) "
        "select least(cast(floor((l_extendedprice - lo) * 30 / (hi - lo)) as bigint) + 1, 30) as bin, count(*) as n "
        "from lineitem, b group by 1",
    ),
    "a10_non_null_counts": (
        column_counts,
        f"with {c.D_SUMMARIES} select count(repo_id) as repo_id, count(commit_hash) as commit_hash, "
        "count(commit_message) as commit_message, count(pr_message) as pr_message, count(pr_id) as pr_id, "
        "count(semantic_summary) as semantic_summary, count(ord) as ord from summaries",
    ),
    "t01_rank_pairs": (
        ranked,
        f"with {D_PAIRS} select commit_hash, source_1, source_2, round(euclidean, 6) as euclidean from distances "
        "order by distances.euclidean desc, commit_hash, source_1, source_2",
    ),
    "t02_top_pairs": (
        top_ten,
        f"with {D_PAIRS} select commit_hash, source_1, source_2, round(distance, 6) as distance from distances "
        "order by distances.distance desc nulls last, commit_hash, source_1, source_2 limit 10",
    ),
    "t03_sort_by_commit": (sorted_rows, f"with {D_RUNS} select commit_hash, source_file from runs order by 1"),
    "t05_head_sample": (samples, "select o_orderkey, o_custkey from orders order by o_orderkey limit 100"),
    "s15_csv_round_trip": (csv_round_trip, "select doc_id, md5(text) as text_md5, lang from documents"),
    "s16_tagged_runs": (
        run_rows,
        f"with {D_RUNS} select source_file, count(*) as n, cast(sum(length(semantic_summary)) as bigint) as chars "
        "from runs group by 1",
    ),
}
