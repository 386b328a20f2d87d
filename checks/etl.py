"""Sources, diff splitting, linking."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import common as c
from gitloom.functions import text as tx
from gitloom.operators.file_diffs import explode_files
from gitloom.operators.linking import first_pr_per_commit, match_commits, with_pull_request
from gitloom.plans.etl import build_file_diffs
from gitloom.plans.etl import run as run_etl
from gitloom.session import scratch_path
from gitloom.sources import dumps
from gitloom.sources.tables import append_repos, read_file_diffs, write_by_repo


def commit_dump(spark, sf):
    path = scratch_path(spark, "commits")
    c.commits(spark, sf).write.partitionBy("repo_id").json(path)
    return dumps.read_commit_dump(spark, path).select(
        "repo_id", "commit_hash", "commit_ord", c.md5_of("message", "message_md5"),
        c.md5_of("diff", "diff_md5"),
    )


def pr_pages(spark, sf):
    path = scratch_path(spark, "pages")
    page_rows = c.prs(spark, sf).select(
        "repo_id",
        F.lit(0).alias("page"),
        F.struct(
            F.col("pr_id").alias("id"), "title", "body", F.struct(F.col("user").alias("login")).alias("user"),
            "created_at", "merged_at",
        ).alias("item"),
    )
    pages = page_rows.groupBy("repo_id", "page").agg(
        F.to_json(F.sort_array(F.collect_list("item")), {"ignoreNullFields": "false"}).alias("value")
    )
    pages.write.partitionBy("repo_id", "page").text(path)
    return dumps.read_pr_pages(spark, path, whole_file=False).select(
        "repo_id", "pr_id", "title", c.md5_of("body", "body_md5"), F.col("user").alias("login"),
        "created_at", "merged_at",
    )


def normalised(spark, sf):
    raw = c.commits(spark, sf).select(
        "repo_id", "commit_hash",
        F.expr("case when commit_ord % 23 = 0 then null else message end").alias("message"),
        F.expr("case when commit_ord % 11 = 0 then null else diff end").alias("diff"),
    )
    valid, rejects = dumps.normalise_commits(raw)
    return valid.select(
        "commit_hash", F.length("diff").alias("diff_chars"), F.lit("").alias("missing")
    ).unionByName(
        rejects.select(
            "commit_hash", F.lit(None).cast("int").alias("diff_chars"),
            F.array_join("missing_fields", ",").alias("missing"),
        )
    )


def file_diff_sink(spark, sf):
    path = scratch_path(spark, "etl")
    rows = explode_files(c.commits(spark, sf)).withColumnRenamed("message", "commit_message")
    write_by_repo(rows, path)
    write_by_repo(rows, path)  # a rerun must not add rows
    return read_file_diffs(spark, path).groupBy("repo_id").agg(
        F.count("*").alias("n"), F.sum(F.length("diff")).alias("chars")
    )


def etl_rejects(spark, sf):
    """The whole job over saved inputs of which some lack a field."""
    path, out = scratch_path(spark, "etl-in"), scratch_path(spark, "etl-out")
    c.commits(spark, sf).withColumn(
        "message", F.expr("case when commit_ord % 23 = 0 then null else message end")
    ).write.partitionBy("repo_id").json(f"{path}/commits")
    pages = c.prs(spark, sf).select(
        "repo_id", F.lit(0).alias("page"),
        F.to_json(F.array(F.struct(
            F.col("pr_id").alias("id"), F.expr("case when pr_id % 5 = 0 then null else title end").alias("title"),
            "body", F.struct(F.col("user").alias("login")).alias("user"), "created_at",
        ))).alias("value"),
    )
    pages.write.partitionBy("repo_id", "page").text(f"{path}/pulls")
    run_etl(spark, f"{path}/commits", f"{path}/pulls", out)
    stored = read_file_diffs(spark, out).select(
        F.lit("stored").alias("kind"), F.col("commit_hash").alias("id"), F.lit("").alias("missing")
    )
    rejected = spark.read.parquet(f"{out}_rejects")
    return stored.distinct().unionByName(
        rejected.select("kind", "id", F.array_join("missing_fields", ",").alias("missing"))
    )


def repo_ids(spark, sf):
    return c.table(spark, sf, "pages").select(
        "page_id", tx.repo_id_from_url(F.concat("url", F.lit("//"))).alias("repo_id")
    )


def split_diffs(spark, sf):
    return c.commits(spark, sf).select(
        "commit_hash", F.posexplode(tx.file_pieces(F.col("diff"))).alias("file_ord", "diff")
    ).select("commit_hash", "file_ord", c.md5_of("diff", "diff_md5"))


def file_rows(spark, sf):
    with_blank = c.commits(spark, sf).withColumn(
        "diff", F.expr("case when commit_ord % 13 = 0 then ' ' || chr(10) else diff end")
    )
    return explode_files(with_blank).select("commit_hash", "file_ord", c.md5_of("diff", "diff_md5"))


def hash_tokens(spark, sf):
    return c.prs(spark, sf).select(
        "pr_id",
        F.explode(tx.commit_hash_tokens(tx.pr_search_text(F.col("title"), F.col("body")))).alias("token"),
    )


def token_sets(spark, sf):
    doubled = F.concat("body", F.lit(" "), "body")
    return c.prs(spark, sf).select("pr_id", F.size(tx.commit_hash_tokens(doubled)).alias("n_tokens"))


def search_text(spark, sf):
    odd = c.prs(spark, sf).selectExpr(
        "pr_id", "case when pr_id % 5 = 0 then '' else title end as title",
        "case when pr_id % 3 = 0 then null else body end as body",
    )
    return odd.select("pr_id", F.md5(tx.pr_search_text(F.col("title"), F.col("body"))).alias("text_md5"))


def sanitised(spark, sf):
    """Every third text gets a byte that is no UTF-8 in the middle."""
    odd = F.concat(
        F.substring("text", 1, 5).cast("binary"), F.unhex(F.lit("FF")), F.expr("substring(text, 6)").cast("binary")
    )
    text = F.when(F.col("doc_id") % 3 == 0, odd.cast("string")).otherwise(F.col("text"))
    return c.table(spark, sf, "documents").select(
        "doc_id", F.md5(tx.sanitize_utf8(text)).alias("text_md5")
    )


def prefix_matches(spark, sf):
    return match_commits(c.commits(spark, sf), c.prs(spark, sf)).select(
        "repo_id", "commit_hash", "token", F.col("first_pr.pr_id").alias("pr_id")
    )


def first_prs(spark, sf):
    return first_pr_per_commit(c.commits(spark, sf), c.prs(spark, sf)).select(
        "repo_id", "commit_hash", "pr_id"
    )


def enriched(spark, sf):
    return with_pull_request(c.commits(spark, sf), c.prs(spark, sf)).select(
        "repo_id", "commit_hash", "pr_id", c.md5_of("pr_message", "pr_md5")
    )


def repo_scope(spark, sf):
    linked = first_pr_per_commit(c.commits(spark, sf), c.prs(spark, sf))
    repos = c.commits(spark, sf).groupBy("repo_id").agg(F.count("*").alias("n_commits"))
    return repos.join(
        linked.groupBy("repo_id").agg(F.count("*").alias("n_linked")), "repo_id", "left"
    ).select("repo_id", "n_commits", F.coalesce("n_linked", F.lit(0)).alias("n_linked"))


def appended(spark, sf):
    docs = c.table(spark, sf, "documents").select("doc_id", "lang", "source")
    frames = [docs.where(F.col("lang") == "en"), docs.where(F.col("lang") != "en")]
    return append_repos(frames).groupBy("source").agg(F.count("*").alias("n"))


def file_diffs(spark, sf):
    return build_file_diffs(c.commits(spark, sf), c.prs(spark, sf))


def file_diff_etl(spark, sf):
    return file_diffs(spark, sf).select(
        "repo_id", "commit_hash", "file_ord", c.md5_of("commit_message", "message_md5"),
        c.md5_of("diff", "diff_md5"), c.md5_of("pr_message", "pr_md5"), "pr_id",
    )


CHECKS = {
    "s01_commit_dump": (
        commit_dump,
        f"with {c.D_COMMITS} select repo_id, commit_hash, commit_ord, md5(message) as message_md5, "
        "md5(diff) as diff_md5 from commits",
    ),
    "s02_pr_pages": (
        pr_pages,
        f"with {c.D_PRS} select repo_id, pr_id, title, md5(body) as body_md5, \"user\" as login, "
        "created_at, merged_at from prs",
    ),
    "s03_normalise": (
        normalised,
        f"with {c.D_COMMITS} select commit_hash, "
        "case when commit_ord % 23 = 0 then null when commit_ord % 11 = 0 then 0 "
        "else cast(length(diff) as int) end as diff_chars, "
        "case when commit_ord % 23 = 0 then 'message' else '' end as missing from commits",
    ),
    "s03_etl_rejects": (
        etl_rejects,
        f"with {c.D_COMMITS}, {c.D_PRS} select 'stored' as kind, commit_hash as id, '' as missing from commits "
        "where commit_ord % 23 <> 0 union all select 'commit', commit_hash, 'message' from commits "
        "where commit_ord % 23 = 0 union all select 'pull request', cast(pr_id as varchar), 'title' from prs "
        "where pr_id % 5 = 0",
    ),
    "s04_repo_partitioned_sink": (
        file_diff_sink,
        f"with {c.D_COMMITS}, {c.D_PIECES} select repo_id, count(*) as n, "
        "cast(sum(length(diff)) as bigint) as chars from files group by repo_id",
    ),
    "p01_repo_id": (
        repo_ids,
        "select page_id, array_to_string(list_slice(string_split(rtrim(url || '//', '/'), '/'), -2, -1), '/') "
        "as repo_id from pages",
    ),
    "p02_split_diff": (
        split_diffs,
        f"with {c.D_COMMITS}, {c.D_PIECES} select commit_hash, cast(file_ord as int) as file_ord, "
        "md5(diff) as diff_md5 from files where diff <> ''",
    ),
    "p03_file_rows": (
        file_rows,
        f"with {c.D_COMMITS}, {c.D_PIECES} select commit_hash, cast(file_ord as int) as file_ord, "
        "md5(diff) as diff_md5 from files where commit_ord % 13 <> 0 "
        "union all select commit_hash, 0, md5('') from commits where commit_ord % 13 = 0",
    ),
    "p04_hash_tokens": (
        hash_tokens,
        f"with {c.D_COMMITS}, {c.D_PRS}, {c.D_LINKS} select pr_id, token from tokens",
    ),
    "p05_search_text": (
        search_text,
        f"with {c.D_PRS} select pr_id, md5(case when pr_id % 5 = 0 then '' else title || ' ' end || "
        "case when pr_id % 3 = 0 then '' else body end) as text_md5 from prs",
    ),
    "p06_sanitize_utf8": (
        sanitised,
        "select doc_id, md5(case when doc_id % 3 = 0 then substr(text, 1, 5) || '?' || substr(text, 6) "
        "else text end) as text_md5 from documents",
    ),
    "a04_distinct_hashes": (
        token_sets,
        f"with {c.D_PRS} select pr_id, cast(len(list_distinct(regexp_extract_all(body, "
        "'(?i)\\b[0-9a-f]{7,40}\\b'))) as int) as n_tokens from prs",
    ),
    "j01_prefix_join": (
        prefix_matches,
        f"with {c.D_COMMITS}, {c.D_PRS}, {c.D_LINKS} select repo_id, commit_hash, token, "
        "arg_min(pr_id, pr_ord) as pr_id from hits group by all",
    ),
    "j02_first_pr_wins": (
        first_prs,
        f"with {c.D_COMMITS}, {c.D_PRS}, {c.D_LINKS} select repo_id, commit_hash, pr_id from links",
    ),
    "j03_left_enrichment": (
        enriched,
        f"with {c.D_COMMITS}, {c.D_PRS}, {c.D_LINKS} select repo_id, commit_hash, pr_id, "
        "md5(pr_message) as pr_md5 from commits left join links using (repo_id, commit_hash)",
    ),
    "j04_repo_scope": (
        repo_scope,
        f"with {c.D_COMMITS}, {c.D_PRS}, {c.D_LINKS} select repo_id, count(*) as n_commits, "
        "count(links.pr_id) as n_linked from commits left join links using (repo_id, commit_hash) "
        "group by repo_id",
    ),
    "u01_append_repos": (appended, "select source, count(*) as n from documents group by source"),
    "m00_file_diff_etl": (
        file_diff_etl,
        f"with {c.D_FILE_DIFFS} select repo_id, commit_hash, cast(file_ord as int) as file_ord, "
        "md5(message) as message_md5, md5(diff) as diff_md5, md5(pr_message) as pr_md5, pr_id "
        "from files left join links using (repo_id, commit_hash)",
    ),
}
