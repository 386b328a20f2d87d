"""Registered queries of license scans, periodic runs and vector codes, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gitloom.llm import licenses, periodic_runs, vector_codes
from gitloom.llm.common import table, without
from gitloom.session import cut


def op11_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan_licenses(docs)
    base = F.filter("licenses", lambda x: x["kind"] == "base")
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(base["first_word"]).alias("first_word"),
        F.array_max(base["first_word"]).alias("last_word"),
        licenses.labels_of(base).alias("base_labels"),
        licenses.labels_of(F.col("licenses")).alias("labels"),
        licenses.score_of(F.col("licenses")).alias("score"),
    )


def _crc(doc_id: str) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def repeated_on(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, by crc32 of the id (null: of no text), go on with a stretch
    of their own words; the text then has single spaces. Other texts stay as they are."""
    h = _crc("doc_id")
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n, g = F.size("__words"), F.col("__g")
    chosen = without(docs, "__words", "__g").withColumns(
        {"__words": F.when(h % 10 == 0, words), "__g": F.floor(h / 10)}
    )
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    place = lambda i: F.when(i < F.col("__a"), i).otherwise(F.col("__a") + (i - F.col("__a")) % F.col("__p"))
    again = F.transform(
        F.sequence(F.lit(0), n - 1), lambda i: F.element_at("__words", (place(i) + 1).cast("int"))
    )
    changed = F.when(F.size("__words") > 0, F.array_join(again, " ")).otherwise(F.col("text"))
    start = F.when(n > 0, a)
    return (
        chosen.withColumn("__a", start)
        .withColumn("__p", F.when(n > 0, p))
        .withColumn("text", changed)
        .drop("__words", "__g", "__a", "__p")
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.periodic_runs(repeated_on(docs)).drop("text")
    rank = F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"]))
    top = found.withColumn("top", F.array_max(rank))
    length, start, period = F.col("top.length"), -F.col("top.col2"), -F.col("top.col3")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    books = vector_codes.fit(vectors)
    encoded = vector_codes.encode(vectors, books).drop("embedding")
    measured = vector_codes.with_group_errors(cut(encoded, "vector-codes"))
    digest = F.lit(books.sha256()).alias("codebooks_sha256")
    return measured.select("vec_id", "code", "error", "label_error", digest)


QUERIES = {
    "op11_license_scans": op11_license_scans,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_vector_codes": op13_vector_codes,
}

# --- DuckDB SQL ------------------------------------------------------------------

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _rule_row(number: int, rule: licenses.Rule) -> str:
    gates = ", ".join(_literal(k.replace(" ", "  ")) for k in rule.keywords)
    names = f"{_literal(rule.label)}, {_literal(rule.kind)}, {_literal(rule.regex)}"
    return f"({number}, {names}, [{gates}], {rule.weight}::double)"


_OP11 = f"""
with docs as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents
),
spaced as (select r, ' ' || array_to_string(w, '  ') || ' ' as line from docs where len(w) > 0),
rules(rule, label, kind, pattern, gates, weight) as (values {", ".join(_rule_row(*x) for x in enumerate(licenses.RULES))}),
gates as (select rule, unnest(gates) as gate from rules),
open_rules as (
  select distinct r, rule from (select distinct gate from gates) g
  join spaced on contains(line, g.gate) join gates using (gate)
),
split as (
  select r, rule, string_split_regex(line, pattern) as gaps, regexp_extract_all(line, pattern) as found
  from open_rules join rules using (rule) join spaced using (r)
),
placed as (
  select r, rule, found[i] as hit,
    array_to_string(gaps[1:i], '') || array_to_string(found[1:i - 1], '') as before
  from (select *, unnest(range(1, len(found) + 1)) as i from split where len(found) > 0)
),
places as (
  select r, rule, (length(before) - length(replace(before, ' ', ''))) // 2 as first,
    (length(before) - length(replace(before, ' ', '')) + length(hit) - length(replace(hit, ' ', ''))) // 2 as after
  from placed
),
standing as (
  select p.r, p.first, label, kind, weight from places p join rules using (rule)
  where kind = 'base' or not exists (select 1 from places o
    where o.r = p.r and o.rule < p.rule and o.first <= p.first and o.after >= p.after)
),
summed as (
  select r, count(*) filter (kind = 'base') as n_base, min(first) filter (kind = 'base') as first_word,
    max(first) filter (kind = 'base') as last_word,
    string_agg(distinct label, ',' order by label) filter (kind = 'base') as base_labels,
    string_agg(distinct label, ',' order by label) as labels, max(weight) as score
  from standing group by r
)
select doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0::double) as score
from docs left join summed using (r)
"""

# A run of period q has six words again q later, so pairs of equal stretches of six words
# give its period; neighbouring pairs with the same distance are one stretch.
_OP12 = """
with bytes as (
  select list(x order by b) as t from (
    select b, list_reduce(range(8), lambda acc, i: case when acc % 2 = 1
      then xor(acc // 2, 3988292384::bigint) else acc // 2 end, b) as x
    from (select unnest(range(256)) as b)
  )
),
hashed as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w,
    xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(doc_id::varchar, ''))), '..'),
        lambda h: ('0x' || h)::bigint),
      lambda acc, b: xor(acc // 256, t[(xor(acc, b) % 256) + 1]), 4294967295::bigint),
      4294967295::bigint) as h
  from documents, bytes
),
shaped as (
  select *, case when h % 10 = 0 and len(w) > 0 then (h // 10) % len(w) end as a,
    case when h % 10 = 0 and len(w) > 0
      then 1 + (len(w) - (h // 10) % len(w)) // (3 + (h // 10) % 8) end as p
  from hashed
),
docs as (
  select r, doc_id, case when a is null then w
    else list_transform(range(len(w)), lambda i: w[(case when i < a then i else a + (i - a) % p end) + 1]) end as w
  from shaped
),
sixes as (
  select r, i, array_to_string(w[i + 1:i + 6], ' ') as six
  from (select r, w, unnest(range(0, len(w) - 5)) as i from docs where len(w) >= 6)
),
again as (select * from sixes qualify count(*) over (partition by r, six) > 1),
pairs as (
  select x.r, x.i, y.i - x.i as q from again x join again y on x.r = y.r and x.six = y.six and x.i < y.i
),
islands as (
  select r, q, min(i) as s, max(i) + 6 + q as e
  from (select *, i - row_number() over (partition by r, q order by i) as island from pairs)
  group by r, q, island
),
long as (select * from islands where e - s >= greatest(12, 2 * q)),
runs as (
  select r, s as start, e - s as length, q as period from long l
  where not exists (select 1 from long o where o.r = l.r and o.q < l.q and o.s <= l.s and o.e >= l.e)
),
listed as (
  select r, count(*) as n_runs,
    sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period)) as runs_sha256,
    arg_min(struct_pack(start := start, length := length, period := period), (-length, start, period)) as top
  from runs group by r
),
gone as (select distinct r, unnest(range(start + period, start + length)) as i from runs),
stayed as (
  select r, string_agg(word, ' ' order by i) as text
  from (select r, unnest(w) as word, unnest(range(len(w))) as i from docs) anti join gone using (r, i) group by r
)
select doc_id, coalesce(n_runs, 0) as n_runs, top.start as start, top.length as length, top.period as period,
  1000 * top.length // top.period as exponent_milli, coalesce(runs_sha256, sha256('')) as runs_sha256,
  sha256(coalesce(text, '')) as collapsed_sha256
from docs left join listed using (r) left join stayed using (r)
"""


def _round_sql(n: int) -> str:
    """Nearest entries by codebook n, and codebook n + 1."""
    return f"""
dist{n} as (
  select r, p, e, sum((x - c) * (x - c)) as s from dims join book{n} using (p, d) group by r, p, e
),
near{n} as (select r, p, arg_min(e, (s, e)) as e, min(s) as s from dist{n} group by r, p),
sums{n} as (
  select p, e, d, sum(x)::bigint as total, count(*) as n from near{n} join dims using (r, p) group by p, e, d
),
book{n + 1} as (
  select p, e, d, case when n is null then c else (total - ((total % n) + n) % n) // n end as c
  from book{n} left join sums{n} using (p, e, d)
)"""


_OP13 = f"""
with kept as (
  select row_number() over (order by vec_id nulls last, embedding) as r, vec_id, label,
    list_transform(embedding, lambda x: floor(256 * x)::bigint) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
dims as (
  select r, (i * {vector_codes.PARTS}) // len(v) as p, i % (len(v) // {vector_codes.PARTS}) as d, v[i + 1] as x
  from (select r, v, unnest(range(len(v))) as i from kept)
),
book0 as (select p, r - 1 as e, d, x as c from dims where r <= {vector_codes.ENTRIES}),
{",".join(_round_sql(n) for n in range(vector_codes.ROUNDS + 1))},
coded as (
  select r, string_agg(printf('%02x', e), '' order by p) as code, sum(s)::bigint as error
  from near{vector_codes.ROUNDS} group by r
),
named as (
  select sha256(string_agg(c::bigint::varchar, ',' order by p, e, d)) as codebooks_sha256 from book{vector_codes.ROUNDS}
)
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256
from kept join coded using (r), named
"""

SQL = {"op11_license_scans": _OP11, "op12_periodic_runs": _OP12, "op13_vector_codes": _OP13}
