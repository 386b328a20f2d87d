"""Views derived from the driver's tables, in Spark and in DuckDB.

The SQL side states the semantics on its own; it never reads Spark output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gitloom.functions.text import DIFF_METADATA, WHITESPACE

Check = tuple  # (callable(spark, sf_dir) -> DataFrame, sql or None)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


_DIFF_PARTS = (
    "'diff --git a/src/f' || {i} || '.txt b/src/f' || {i} || '.txt' || chr(10) || "
    "'index 1111111..2222222 100644' || chr(10) || '--- a/src/f' || {i} || '.txt' || chr(10) || "
    "'+++ b/src/f' || {i} || '.txt' || chr(10) || '@@ -1 +1 @@' || chr(10) || '+' || x"
)


def commits(spark: SparkSession, sf: str) -> DataFrame:
    """One file section per line of a document."""
    return table(spark, sf, "documents").selectExpr(
        "'org/' || source as repo_id",
        "md5(cast(doc_id as string)) as commit_hash",
        "doc_id as commit_ord",
        r"split(text, '\n')[0] as message",
        r"array_join(transform(split(text, '\n'), (x, i) -> "
        + _DIFF_PARTS.format(i="i")
        + "), chr(10)) as diff",
    )


# A pull request for every turn; it names one of the commits, all of which are named in turn.
_PR_COLUMNS = (
    "'org/src' || (n % 20) as repo_id, pr_id, pr_id as pr_ord, 'PR ' || pr_id as title, "
    "coalesce(text, '') || ' fixes ' || substr(md5(cast(n as {text})), 1, cast(7 + pr_id % 20 as int)) "
    "as body, 'user' || pr_id % 7 as {user}, '2024-01-01T00:00:00Z' as created_at, "
    "case when pr_id % 2 = 0 then '2024-01-02T00:00:00Z' end as merged_at"
)
_PR_ID = "conv_id * 1000 + turn"
_PR_STEP = "conv_id * 37 + turn * 101"


def prs(spark: SparkSession, sf: str) -> DataFrame:
    """Every turn of every conversation as a pull request."""
    total = table(spark, sf, "documents").agg(F.count("*")).scalar()
    turns = table(spark, sf, "conversations").selectExpr(f"{_PR_ID} as pr_id", f"{_PR_STEP} as step", "text")
    numbered = turns.withColumn("n", F.pmod("step", total))
    return numbered.selectExpr(*_split_columns(_PR_COLUMNS.format(text="string", user="user")))


def _split_columns(listing: str) -> list[str]:
    """The expressions of a select list; commas inside brackets do not part them."""
    out, depth = [""], 0
    for c in listing:
        depth += (c == "(") - (c == ")")
        if c == "," and depth == 0:
            out.append("")
        else:
            out[-1] += c
    return [x.strip() for x in out]


def summaries(spark: SparkSession, sf: str) -> DataFrame:
    """Two rows for every third document; some summaries are blank or missing."""
    docs = table(spark, sf, "documents")
    base = docs.selectExpr(
        "'org/' || source as repo_id",
        "md5(cast(doc_id as string)) as commit_hash",
        "'commit ' || doc_id as commit_message",
        "case when doc_id % 4 = 0 then 'pr ' || doc_id end as pr_message",
        "case when doc_id % 4 = 0 then doc_id end as pr_id",
        "case when doc_id % 34 = 0 then ' ' || chr(10) || chr(9) when doc_id % 17 = 0 then null "
        "else text end as semantic_summary",
        "doc_id * 2 as ord",
        "doc_id",
    )
    again = base.where("doc_id % 3 = 0").selectExpr(
        "repo_id", "commit_hash", "commit_message", "pr_message", "pr_id",
        "'second ' || commit_message as semantic_summary", "ord + 1 as ord", "doc_id",
    )
    return base.unionByName(again).drop("doc_id")


def blobs(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors with one planted cluster per label."""
    return table(spark, sf, "embeddings").selectExpr(
        "cast(vec_id as string) as id",
        "transform(embedding, (x, i) -> cast(x as double) + if(i = label, 3D, 0D)) as embedding",
        "label",
    )


def md5_of(column: str, alias: str):
    return F.md5(F.col(column)).alias(alias)


# --- DuckDB side -----------------------------------------------------------------

SPACE = "'" + WHITESPACE + "'"


def d_strip(x: str) -> str:
    return f"trim({x}, {SPACE})"


D_COMMITS = (
    "commits as (select 'org/' || source as repo_id, md5(cast(doc_id as varchar)) as commit_hash, "
    "doc_id as commit_ord, string_split(text, chr(10))[1] as message, "
    "array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: "
    + _DIFF_PARTS.format(i="(i - 1)")
    + "), chr(10)) as diff from documents)"
)

D_PRS = (
    "turns as (select *, step % (select count(*) from documents) as n from "
    f"(select {_PR_ID} as pr_id, {_PR_STEP} as step, text from conversations)), "
    f"prs as (select {_PR_COLUMNS.format(text='varchar', user=chr(34) + 'user' + chr(34))} from turns)"
)

D_PIECES = (
    "pieces as (select repo_id, commit_hash, commit_ord, message, "
    "list_filter(list_transform(regexp_split_to_array(diff, '(?m)^diff --git.*$'), lambda x, i: "
    "rtrim(regexp_replace(case when i > 1 then regexp_replace(x, '^\\n', '') else x end, "
    f"'(?m)^(?:{'|'.join(DIFF_METADATA)}).*\\n?', '', 'g'), {SPACE})), lambda x: x <> '') as p "
    "from commits), "
    "files as (select repo_id, commit_hash, commit_ord, message, "
    "unnest(case when len(p) = 0 then [''] else p end) as diff, "
    "unnest(range(greatest(len(p), 1))) as file_ord from pieces)"
)

D_LINKS = (
    "tokens as (select repo_id, pr_id, pr_ord, body, unnest(list_distinct(regexp_extract_all("
    "title || ' ' || body, '(?i)\\b[0-9a-f]{7,40}\\b'))) as token from prs), "
    "hits as (select c.repo_id, c.commit_hash, t.token, t.pr_id, t.pr_ord, t.body from "
    "(select distinct repo_id, commit_hash from commits) c join tokens t "
    "on c.repo_id = t.repo_id and starts_with(c.commit_hash, t.token)), "
    "links as (select repo_id, commit_hash, arg_min(pr_id, pr_ord) as pr_id, "
    "arg_min(body, pr_ord) as pr_message from hits group by all)"
)

D_FILE_DIFFS = f"{D_COMMITS}, {D_PRS}, {D_PIECES}, {D_LINKS}"

D_SUMMARIES = (
    "base as (select 'org/' || source as repo_id, md5(cast(doc_id as varchar)) as commit_hash, "
    "'commit ' || doc_id as commit_message, "
    "case when doc_id % 4 = 0 then 'pr ' || doc_id end as pr_message, "
    "case when doc_id % 4 = 0 then doc_id end as pr_id, "
    "case when doc_id % 34 = 0 then ' ' || chr(10) || chr(9) when doc_id % 17 = 0 then null "
    "else text end as semantic_summary, doc_id * 2 as ord, doc_id from documents), "
    "summaries as (select * exclude (doc_id) from base union all by name "
    "select repo_id, commit_hash, commit_message, pr_message, pr_id, "
    "'second ' || commit_message as semantic_summary, ord + 1 as ord from base where doc_id % 3 = 0)"
)

D_VALID = (
    f"valid as (select * from summaries where semantic_summary is not null "
    f"and {d_strip('semantic_summary')} <> ''), "
    "first_valid as (select * from (select *, row_number() over "
    "(partition by commit_hash order by ord) as r from valid) where r = 1)"
)
