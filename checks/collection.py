"""Collection documents, loads, vectors and clusters."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from checks import common as c
from gitloom.functions import vectors as vx
from gitloom.operators import clusters as cl
from gitloom.operators import documents as dc
from gitloom.operators.ordering import keep_first
from gitloom.plans.load import load_frame
from gitloom.session import scratch_path
from gitloom.sources import collection as store
from gitloom.sources.tables import read_summaries
from gitloom.streaming.incremental import stream_summaries

#: Rows of a file of the stream's source, about.
ROWS_PER_FILE = 20_000


def valid(spark, sf):
    return dc.valid_summaries(c.summaries(spark, sf)).select(
        "commit_hash", "ord", c.md5_of("semantic_summary", "summary_md5")
    )


def prepared(spark, sf):
    return dc.prepare_documents(c.summaries(spark, sf), ["ord"]).select(
        "commit_hash", "repo_id", "pr_id", c.md5_of("semantic_summary", "summary_md5")
    )


def first_per_key(spark, sf):
    rows = c.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return keep_first(rows, ["l_partkey"], ["l_orderkey", "l_linenumber"])


def metadata_entries(spark, sf):
    return c.summaries(spark, sf).select(
        "ord", F.explode(F.map_entries(dc.metadata_map())).alias("e")
    ).select("ord", F.col("e.key").alias("key"), F.col("e.value").alias("value"))


def metadata_lookup(spark, sf):
    meta = c.summaries(spark, sf).select("ord", dc.metadata_map().alias("metadata"))
    return meta.select(
        "ord", dc.metadata_value("repo_id").alias("repo_id"), dc.metadata_value("pr_id").alias("pr_id")
    )


def checked_scan(spark, sf):
    path = scratch_path(spark, "summaries")
    c.summaries(spark, sf).write.parquet(path)
    return read_summaries(spark, path).groupBy("repo_id").agg(
        F.count("*").alias("n"), F.count("semantic_summary").alias("n_summaries")
    )


def _seen_ids(spark, sf):
    return c.table(spark, sf, "labels").select(F.md5(F.col("doc_id").cast("string")).alias("id"))


def new_documents(spark, sf):
    docs = dc.prepare_documents(c.summaries(spark, sf), ["ord"])
    return dc.unseen(docs, _seen_ids(spark, sf)).select("commit_hash")


def id_difference(spark, sf):
    docs = dc.prepare_documents(c.summaries(spark, sf), ["ord"])
    return dc.id_difference(docs, _seen_ids(spark, sf))


def embedded(spark, sf):
    docs = dc.prepare_documents(c.summaries(spark, sf), ["ord"]).select("commit_hash", "semantic_summary")
    out = dc.embed_column(docs, "semantic_summary", dc.stub_embedder())
    return out.select("commit_hash", F.posexplode("embedding").alias("pos", "x")).where("x > 0").select(
        "commit_hash", "pos", F.round(F.col("x").cast("double"), 4).alias("x")
    )


D_EMBEDDED = (
    "words as (select commit_hash, unnest(regexp_split_to_array(semantic_summary, '[ \\n]+')) as w "
    "from first_valid), counted as (select commit_hash, "
    "cast(('0x' || substr(md5(w), 1, 4)) as int) % 64 as pos, count(*) as n from words group by all), "
    "lengths as (select commit_hash, sqrt(sum(n * n)) as len from counted group by all)"
)


def embedded_texts(spark, sf):
    docs = c.table(spark, sf, "benchmark").select("item_id", "text")
    return dc.embed_column(docs, "text", dc.stub_embedder()).select(
        "item_id", F.size("embedding").alias("dim"), F.posexplode("embedding").alias("pos", "x")
    ).where("x > 0").select("item_id", "dim", "pos", F.round(F.col("x").cast("double"), 4).alias("x"))


def _halves(spark, sf):
    rows = c.summaries(spark, sf)
    return rows.where("ord % 4 < 2"), rows


def full_load(spark, sf):
    root = scratch_path(spark, "full")
    part, rows = _halves(spark, sf)
    load_frame(part, root, "full")
    load_frame(rows, root, "full")
    return store.read_collection(spark, root).select("id", F.md5("document").alias("document_md5"))


def incremental_load(spark, sf):
    """Even rows first, then everything: the second load adds only unseen ids."""
    root = scratch_path(spark, "incremental")
    part, rows = _halves(spark, sf)
    load_frame(part, root, "full")
    load_frame(rows, root, "incremental")
    return store.read_collection(spark, root).select("id", F.md5("document").alias("document_md5"))


def upserted(spark, sf):
    root = scratch_path(spark, "upsert")
    docs = dc.to_collection(dc.prepare_documents(c.summaries(spark, sf), ["ord"]), dc.stub_embedder())
    store.replace_all(docs, root)
    changed = docs.join(_seen_ids(spark, sf), "id", "left_semi").select(
        "id", F.concat(F.lit("changed "), "id").alias("document"), "metadata"
    )
    renewed = dc.embed_column(changed, "document", dc.stub_embedder())
    store.upsert(renewed.unionByName(renewed), root)  # a repeated id is stored once
    vector = F.array_join(F.transform("embedding", lambda x: (x > 0).cast("int")), "")
    return store.read_collection(spark, root).select(
        "id", F.md5("document").alias("document_md5"), vector.alias("slots")
    )


def scanned(spark, sf):
    root = scratch_path(spark, "scan")
    vectors = c.table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"), F.concat(F.lit("doc "), "vec_id").alias("document"),
        "embedding", F.create_map(F.lit("repo_id"), F.lit("r")).alias("metadata"),
    )
    store.replace_all(vectors, root)
    return store.read_collection(spark, root).select(
        "id", "document", F.round(vx.dot(F.col("embedding"), F.col("embedding")), 3).alias("norm2")
    )


def streamed(spark, sf):
    """All documents through the streaming front-end, read as a stream of files."""
    root, state = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    source = scratch_path(spark, "stream-source")
    rows = c.summaries(spark, sf)
    # Two batches; a commit is in one file.
    files = max(4, 2 * math.ceil(rows.count() / (2 * ROWS_PER_FILE)))
    rows.repartition(files, "commit_hash").write.parquet(source)
    schema = spark.read.parquet(source).schema
    stream_summaries(
        spark, source, root, state, schema, files_per_batch=files // 2, order=["ord"]
    ).awaitTermination()
    return store.read_collection(spark, root).select("id", F.md5("document").alias("document_md5"))


def vector_dimensions(spark, sf):
    return dc.dimensions(c.table(spark, sf, "embeddings"))


def labelled(spark, sf):
    """Collection vectors with ``label`` as cluster id; label 9 plays noise."""
    return c.table(spark, sf, "embeddings").select(
        "vec_id", "embedding",
        F.when(F.col("label") == 9, -1).otherwise(F.col("label")).alias("cluster_id"),
    )


D_LABELLED = (
    "labelled as (select vec_id, embedding, case when label = 9 then -1 else label end as cluster_id "
    "from embeddings), parts as (select vec_id, cluster_id, unnest(range(len(embedding))) as pos, "
    "cast(unnest(embedding) as double) as x from labelled), "
    "centers as (select cluster_id, pos, avg(x) as m from parts where cluster_id <> -1 group by all)"
)


def centroid_rows(spark, sf):
    return cl.centroids(labelled(spark, sf)).select(
        "cluster_id", F.posexplode("centroid").alias("pos", "m")
    ).select("cluster_id", "pos", F.round("m", 6).alias("m"))


def centroid_join(spark, sf):
    return cl.with_centroid(labelled(spark, sf)).select(
        "vec_id", "cluster_id", F.explode_outer("centroid").alias("m")
    ).groupBy("vec_id", "cluster_id").agg(
        F.count("m").alias("dim"), F.round(F.sum("m"), 6).alias("total"),
        F.round(F.sum(F.col("m") * F.col("m")), 6).alias("squares"),
    )


def centroid_distances(spark, sf):
    return cl.with_centroid_distance(labelled(spark, sf)).select(
        "vec_id", "cluster_id", F.round("distance_to_centroid", 6).alias("distance")
    )


def sizes(spark, sf):
    return cl.cluster_sizes(labelled(spark, sf))


def counts(spark, sf):
    return cl.cluster_counts(labelled(spark, sf))


def similarities(spark, sf):
    """Each vector against the vector of its successor id; the last has none."""
    vectors = c.table(spark, sf, "embeddings").select(F.col("vec_id").alias("commit_hash"), "embedding")
    shifted = vectors.select((F.col("commit_hash") - 1).alias("commit_hash"), "embedding")
    return cl.similarity_to_clusters(vectors, shifted).select(
        "commit_hash", F.round("similarity", 6).alias("similarity")
    )


def dense_cosine(spark, sf):
    """Cosine of each vector with its label's centroid."""
    return cl.with_centroid(labelled(spark, sf)).select(
        "vec_id", F.round(vx.cosine_similarity(F.col("embedding"), F.col("centroid")), 6).alias("similarity")
    )


CHECKS = {
    "s06_summary_scan": (
        checked_scan,
        f"with {c.D_SUMMARIES} select repo_id, count(*) as n, count(semantic_summary) as n_summaries "
        "from summaries group by 1",
    ),
    "p17_valid_summaries": (
        valid,
        f"with {c.D_SUMMARIES}, {c.D_VALID} select commit_hash, ord, md5(semantic_summary) as summary_md5 from valid",
    ),
    "a03_keep_first_summary": (
        prepared,
        f"with {c.D_SUMMARIES}, {c.D_VALID} select commit_hash, repo_id, pr_id, "
        "md5(semantic_summary) as summary_md5 from first_valid",
    ),
    "w03_keep_first_row": (
        first_per_key,
        "select l_orderkey, l_linenumber, l_partkey, l_quantity from (select *, row_number() over "
        "(partition by l_partkey order by l_orderkey, l_linenumber) as r from lineitem) where r = 1",
    ),
    "p18_metadata_map": (
        metadata_entries,
        f"with {c.D_SUMMARIES} select ord, 'repo_id' as key, repo_id as value from summaries union all "
        "select ord, 'commit_hash', commit_hash from summaries union all "
        "select ord, 'commit_message', commit_message from summaries union all "
        "select ord, 'pr_message', pr_message from summaries where pr_message is not null union all "
        "select ord, 'pr_id', cast(pr_id as varchar) from summaries where pr_id is not null",
    ),
    "p19_metadata_lookup": (
        metadata_lookup,
        f"with {c.D_SUMMARIES} select ord, repo_id, coalesce(cast(pr_id as varchar), '') as pr_id from summaries",
    ),
    "p28_dimension": (
        vector_dimensions,
        "select cast(len(embedding) as int) as dim, count(*) as n from embeddings group by 1",
    ),
    "j05_skip_loaded_ids": (
        new_documents,
        f"with {c.D_SUMMARIES}, {c.D_VALID} select commit_hash from first_valid where commit_hash not in "
        "(select md5(cast(doc_id as varchar)) from labels)",
    ),
    "u02_id_difference": (
        id_difference,
        f"with {c.D_SUMMARIES}, {c.D_VALID} select commit_hash as id from first_valid except all "
        "select md5(cast(doc_id as varchar)) from labels",
    ),
    "m04_embed_documents": (
        embedded,
        f"with {c.D_SUMMARIES}, {c.D_VALID}, {D_EMBEDDED} select commit_hash, pos, "
        "round(cast(n / len as float)::double, 4) as x from counted join lengths using (commit_hash)",
    ),
    "m05_embed_texts": (
        embedded_texts,
        f"with first_valid as (select item_id as commit_hash, text as semantic_summary from benchmark), "
        f"{D_EMBEDDED} select commit_hash as item_id, 64 as dim, pos, "
        "round(cast(n / len as float)::double, 4) as x from counted join lengths using (commit_hash)",
    ),
    "s08_full_load": (
        full_load,
        f"with {c.D_SUMMARIES}, {c.D_VALID} select commit_hash as id, md5(semantic_summary) as document_md5 "
        "from first_valid",
    ),
    "s09_incremental_load": (
        incremental_load,
        f"with {c.D_SUMMARIES}, {c.D_VALID}, early as (select * from (select *, row_number() over "
        "(partition by commit_hash order by ord) as k from valid where ord % 4 < 2) where k = 1) "
        "select commit_hash as id, md5(semantic_summary) as document_md5 from early union all "
        "select commit_hash, md5(semantic_summary) from first_valid where commit_hash not in "
        "(select commit_hash from early)",
    ),
    "s10_upsert": (
        upserted,
        f"with {c.D_SUMMARIES}, {c.D_VALID}, now as (select commit_hash, case when commit_hash in "
        "(select md5(cast(doc_id as varchar)) from labels) then 'changed ' || commit_hash "
        "else semantic_summary end as document from first_valid), used as (select distinct commit_hash, "
        "cast(('0x' || substr(md5(w), 1, 4)) as int) % 64 as pos from (select commit_hash, "
        "unnest(regexp_split_to_array(document, '[ \\n]+')) as w from now)), held as (select commit_hash, "
        "list(pos) as p from used group by 1) select commit_hash as id, md5(document) as document_md5, "
        "array_to_string(list_transform(range(64), lambda i: case when list_contains(p, i) then '1' else '0' end), '') "
        "as slots from now join held using (commit_hash)",
    ),
    "s11_collection_scan": (
        scanned,
        "select cast(vec_id as varchar) as id, 'doc ' || vec_id as document, "
        "round(list_sum(list_transform(embedding, lambda x: cast(x as double) * x)), 3) as norm2 from embeddings",
    ),
    "r04_streamed_load": (
        streamed,
        f"with {c.D_SUMMARIES}, {c.D_VALID} select commit_hash as id, md5(semantic_summary) as document_md5 "
        "from first_valid",
    ),
    "a05_centroids": (
        centroid_rows,
        f"with {D_LABELLED} select cluster_id, pos, round(m, 6) as m from centers",
    ),
    "j12_centroid_join": (
        centroid_join,
        f"with {D_LABELLED} select vec_id, cluster_id, count(m) as dim, round(sum(m), 6) as total, "
        "round(sum(m * m), 6) as squares from labelled left join centers using (cluster_id) group by all",
    ),
    "v01_centroid_distance": (
        centroid_distances,
        f"with {D_LABELLED}, d as (select vec_id, round(sqrt(sum((x - m) * (x - m))), 6) as distance from parts "
        "join centers using (cluster_id, pos) group by vec_id) select vec_id, cluster_id, distance "
        "from labelled left join d using (vec_id)",
    ),
    "v03_dense_cosine": (
        dense_cosine,
        f"with {D_LABELLED}, d as (select vec_id, round(sum(x * m) / (sqrt(sum(x * x)) * sqrt(sum(m * m))), 6) "
        "as similarity from parts join centers using (cluster_id, pos) group by vec_id) "
        "select vec_id, similarity from labelled left join d using (vec_id)",
    ),
    "j08_summary_cluster_similarity": (
        similarities,
        f"with {D_LABELLED}, d as (select a.vec_id, round(sum(a.x * b.x) / (sqrt(sum(a.x * a.x)) * "
        "sqrt(sum(b.x * b.x))), 6) as similarity from parts a join parts b on b.vec_id = a.vec_id + 1 "
        "and a.pos = b.pos group by a.vec_id) select vec_id as commit_hash, similarity "
        "from labelled left join d using (vec_id)",
    ),
    "a07_cluster_sizes": (sizes, f"with {D_LABELLED} select cluster_id, count(*) as n from labelled group by 1"),
    "a08_cluster_counts": (
        counts,
        f"with {D_LABELLED} select count(distinct case when cluster_id <> -1 then cluster_id end) as n_clusters, "
        "count_if(cluster_id = -1) as n_noise from labelled",
    ),
}
