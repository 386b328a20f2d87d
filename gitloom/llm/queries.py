"""The registered query of each operator, with production parameters over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gitloom.llm import (
    bpe,
    decontamination,
    line_dedup,
    minhash,
    quality_classifier,
    quality_rules,
    scan_queries,
    sharding,
    toxicity,
    url_filter,
    warc,
)
from gitloom.llm.common import table
from gitloom.llm.labelled import held_out
from gitloom.llm.url_filter import UrlRule
from gitloom.session import cut, scratch_path

SHARDS = 40
RANK_FILE = "byte_bpe_50k.tiktoken"
MIN_LINE_DOCS, MIN_LINE_CHARS = 10, 1
NEAR_PERCENT = 85
KEEP_SCORE, TOXIC_SCORE = 0.3, 0.5
URL_RULES = (
    UrlRule("com", "/", "allow"),
    UrlRule("example.com", "/en/", "block"),
    UrlRule("www.example.com", "/en/", "allow"),
    UrlRule("net", "/es/", "block"),
    UrlRule("net", "/fr/", "block"),
)


def op1_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank_file, pattern = public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, rank_file, pattern).drop("text")
    return bpe.token_digests(bpe.decode(encoded, rank_file, pattern))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontamination.mark_contamination(docs, table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.drop_frequent_lines(docs, MIN_LINE_DOCS, MIN_LINE_CHARS)
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_dropped", digest)


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = minhash.near_duplicates(table(spark, sf_dir, "documents"), NEAR_PERCENT)
    return marked.select("doc_id", "n_shingles", "component_id", "kept")


def _predicted(scored: DataFrame, least: float) -> DataFrame:
    predicted = F.when(F.col("score") >= least, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return _predicted(quality_classifier.score(docs, weights), KEEP_SCORE)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    measured = [F.col(f"quality.{c}").alias(c) for c in counts]
    return quality_rules.judge(docs).select("doc_id", *measured, "base_failed", "kept")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _predicted(toxicity.score(docs, model), TOXIC_SCORE)


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    found = cut(warc.read_archives(spark, path, payloads=False), "records")
    return warc.resolve_revisits(found).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    listed = url_filter.bad_pages(pages)
    judged = url_filter.judge_urls(pages.select("page_id", "url"), listed, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


QUERIES = {
    "op1_jump_shards": op1_jump_shards,
    "op2_line_dedup": op2_line_dedup,
    "op3_minhash": op3_minhash,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_quality_rules": op6_quality_rules,
    "op7_toxicity": op7_toxicity,
    "op8_warc_revisits": op8_warc_revisits,
    "op9_decontamination": op9_decontamination,
    "op10_url_filter": op10_url_filter,
    **scan_queries.QUERIES,
}

# --- DuckDB SQL ------------------------------------------------------------------

# The checksum is folded over the bytes with a table that its polynomial gives.
_OP1 = f"""
with recursive jumps as (
  select doc_id, 0::bigint as home,
    (('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 16))::ubigint)::hugeint as state
  from (select distinct doc_id from documents)
  union all
  select doc_id, landed, next
  from (
    select doc_id, next,
      floor((home + 1) * (2147483648.0::double / ((next // 8589934592) + 1)::double))::bigint as landed
    from (select *, (state * 2862933555777941757::hugeint + 1) % 18446744073709551616::hugeint as next
          from jumps)
  )
  where landed <= {SHARDS}
),
homes as (
  select doc_id, max(home) filter (home < {SHARDS}) as shard, max(home) as grown
  from jumps group by doc_id
),
crc_table as (
  select list(x order by b) as t from (
    select b, list_reduce(range(8), lambda acc, i: case when acc % 2 = 1
      then xor(acc // 2, 3988292384::bigint) else acc // 2 end, b) as x
    from (select unnest(range(256)) as b)
  )
),
sized as (
  select doc_id, strlen(coalesce(text, '')) + 16 as size,
    xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
        lambda h: ('0x' || h)::bigint),
      lambda acc, b: xor(acc // 256, t[(xor(acc, b) % 256) + 1]), 4294967295::bigint),
      4294967295::bigint) as text_crc32
  from documents, crc_table
)
select s.doc_id, s.size, s.text_crc32, 'key' as law, h.shard::int as shard,
  h.grown::int as grown_shard,
  row_number() over (partition by h.shard order by s.doc_id nulls first, s.size, s.text_crc32) - 1
    as slot
from sized s join homes h on s.doc_id is not distinct from h.doc_id
"""

# Windows of the items and of the documents as lists of words, joined on equality.
_OP9 = f"""
with words as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents
),
item_words as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from benchmark
),
item_windows as (
  select distinct item_id, least(len(w), {decontamination.WINDOW}) as n,
    array_to_string(w[i:i + {decontamination.WINDOW} - 1], ' ') as win
  from (select item_id, w, unnest(range(1, greatest(len(w) - {decontamination.WINDOW} + 1, 1) + 1)) as i
        from item_words where len(w) > 0)
),
starts as (
  select r, w, unnest(range(1, len(w) + 1)) as i from words
),
hits as (
  select s.r, s.i, x.n, x.item_id
  from (select distinct n from item_windows) k
  join starts s on s.i + k.n - 1 <= len(s.w)
  join item_windows x on x.n = k.n and x.win = array_to_string(s.w[s.i:s.i + k.n - 1], ' ')
),
covered as (
  select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from hits)
  group by r
),
named as (
  select r, count(*) as n_items, sha256(string_agg(id, ',' order by id)) as items_sha256
  from (select distinct r, item_id::varchar as id from hits where item_id is not null) group by r
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join covered using (r) left join named using (r)
"""

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_OP2 = f"""
with docs as (
  select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as lines
  from documents
),
parts as (
  select r, i, lines[i] as line, translate(trim(lines[i], {_SPACES}), {_LOWER}) as key
  from (select r, lines, unnest(range(1, len(lines) + 1)) as i from docs)
),
frequent as (
  select key from parts where length(key) >= {MIN_LINE_CHARS}
  group by key having count(distinct r) >= {MIN_LINE_DOCS}
),
kept as (
  select r, count(*) as n_kept, string_agg(line, chr(10) order by i) as text
  from parts where key not in (select key from frequent) group by r
)
select doc_id, len(lines) as n_lines, len(lines) - coalesce(n_kept, 0) as n_dropped,
  sha256(coalesce(k.text, '')) as kept_sha256
from docs left join kept k using (r)
"""

_OP3 = f"""
with recursive words as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x20\x09-\x0D]+') as w
  from documents
),
sets as (
  select distinct r, array_to_string(w[i:i + {minhash.SHINGLE_WORDS - 1}], ' ') as s
  from (select r, w,
      unnest(range(1, greatest(len(w) - {minhash.SHINGLE_WORDS - 1}, 1) + 1)) as i
    from words where len(w) > 0)
),
sizes as (select r, count(*) as n from sets group by r),
links as (
  select c.a, c.b
  from (select x.r as a, y.r as b, count(*) as both_ from sets x join sets y on x.s = y.s and x.r <> y.r
        group by x.r, y.r) c
  join sizes p on p.r = c.a join sizes q on q.r = c.b
  where 100 * both_ >= {NEAR_PERCENT} * (p.n + q.n - both_)
),
reach as (
  select r, r as other from words
  union
  select reach.r, links.b from reach join links on links.a = reach.other
),
named as (
  select reach.r, min(w.doc_id) as component_id from reach join words w on w.r = reach.other
  group by reach.r
)
select w.doc_id, coalesce(n, 0) as n_shingles, component_id,
  w.doc_id is not distinct from component_id as kept
from words w left join sizes using (r) join named on named.r = w.r
"""


def _rule_sql(rule: quality_rules.Rule) -> str:
    share = f"{rule.share} * {rule.scale}"
    bounds = [f"{share} < {rule.of} * {rule.low}"] if rule.low is not None else []
    bounds += [f"{share} > {rule.of} * {rule.high}"] if rule.high is not None else []
    return f"(n_words >= {rule.from_words} and ({' or '.join(bounds)}))"


_STOP = ", ".join(f"'{w}'" for w in sorted({w for line in quality_rules.STOP_WORDS for w in line.split()}))

_OP6 = f"""
with docs as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text from documents
),
split as (
  select r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(text, chr(10)), lambda x: trim(x, {_SPACES}) <> '') as lines
  from docs
),
windows as (
  select r, i, array_to_string(w[i:i + 7], ' ') as win
  from (select r, w, unnest(range(1, len(w) - 6)) as i from split where len(w) >= 8)
),
again as (
  select r, i from (select r, i, count(*) over (partition by r, win) as n from windows) where n > 1
),
covered as (
  select r, count(distinct p) as n_repeat_words
  from (select r, unnest(range(i, i + 8)) as p from again) group by r
),
measured as (
  select doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
    length(text) - length(regexp_replace(text, '[!?]', '', 'g')) as n_marks,
    len(list_filter(w, lambda x: lower(x) in ({_STOP}))) as n_stop_words,
    len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words
  from split left join covered using (r)
),
based as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or {" or ".join(_rule_sql(r) for r in quality_rules.RULES)}) as kept
from based
"""

_OP8 = f"""
with bodies as (
  select page_id, strlen(coalesce(html, '')) as n, sha1(coalesce(html, '')) as digest from pages
),
judged as (
  select *, case when n >= {warc.MIN_REVISIT_BYTES}
    then max(page_id) over (partition by digest, n) end as response
  from bodies
)
select page_id, n as payload_bytes, digest as payload_digest,
  case when response is null or response is not distinct from page_id then 'response'
    else 'revisit' end as record_type,
  case when response is distinct from page_id then response end as refers_to
from judged
"""


def _fits_sql(rule: UrlRule) -> str:
    host = f"(host = '{rule.host}' or ends_with(host, '.{rule.host}'))"
    return f"when {host} and starts_with(path, '{rule.path}') then '{rule.text}'"


_LONGEST_FIRST = sorted(URL_RULES, key=lambda r: (-len(r.text), r.text))

_OP10 = f"""
with rests as (
  select page_id, coalesce(html, '') as html, case when contains(url, '://')
    then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages
),
split as (
  select page_id, coalesce(nullif(split_part(split_part(html, '<article>', 2), '</article>', 1), ''),
      html) as article, translate(regexp_extract(rest, '^[^/?#]*'), {_LOWER}) as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from rests
),
ruled as (
  select *, host || rtrim(path, '/') as key,
    case {" ".join(_fits_sql(r) for r in _LONGEST_FIRST)} end as rule
  from split
),
listed as (
  select distinct key from (select *, string_split(article, '<p>') as parts from ruled)
  where host <> '' and (regexp_matches(host, '{url_filter.SPAM_HOST}')
    or len(regexp_extract_all(regexp_replace(article, '<[^>]*>', ' ', 'g'), '{url_filter.WORD}'))
      < {url_filter.MIN_WORDS}
    or 100 * (len(parts) - len(list_distinct(parts))) > {url_filter.MAX_REPEATED_PERCENT} * len(parts))
)
select page_id, host, path, rule,
  case {" ".join(f"when rule = '{r.text}' then '{r.verdict}'" for r in URL_RULES)}
    when host <> '' and key in (select key from listed) then 'block' else 'allow' end as verdict
from ruled
"""

SQL = {
    "op1_jump_shards": _OP1,
    "op2_line_dedup": _OP2,
    "op3_minhash": _OP3,
    "op6_quality_rules": _OP6,
    "op8_warc_revisits": _OP8,
    "op9_decontamination": _OP9,
    "op10_url_filter": _OP10,
    **scan_queries.SQL,
}
