"""Prompts, replies and the summary stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import common as c
from gitloom.functions import prompts as pr
from gitloom.functions import replies as rp
from gitloom.functions import text as tx
from gitloom.operators import summarise as sm
from gitloom.operators.file_diffs import explode_files
from gitloom.operators.inference import infer, stub_model
from gitloom.operators.packing import pack_lines
from gitloom.plans import summarise as plan
from gitloom.schemas import FILE_SUMMARIES
from gitloom.session import cut, scratch_path

LIMIT = 1500


def doc_files(spark, sf):
    """File rows whose headers vary: both, only the new path, none, blank."""
    rows = explode_files(c.commits(spark, sf)).withColumnRenamed("message", "commit_message")
    return rows.withColumn("kind", F.expr("(commit_ord + file_ord) % 7")).withColumn(
        "diff",
        F.expr(
            r"case kind when 1 then regexp_replace(diff, r'(?m)\A--- a/[^\n]*\n', '') "
            r"when 2 then regexp_replace(diff, r'(?m)\A--- a/[^\n]*\n\+\+\+ b/[^\n]*\n', '') "
            r"when 3 then ' NaN' || chr(10) when 4 then '  ' when 5 then 'None' else diff end"
        ),
    )


D_DOC_FILES = (
    f"{c.D_COMMITS}, {c.D_PIECES}, doc_files as (select repo_id, commit_hash, commit_ord, "
    "file_ord, message as commit_message, case (commit_ord + file_ord) % 7 "
    "when 1 then regexp_replace(diff, '^--- a/[^\\n]*\\n', '') "
    "when 2 then regexp_replace(diff, '^--- a/[^\\n]*\\n\\+\\+\\+ b/[^\\n]*\\n', '') "
    "when 3 then ' NaN' || chr(10) when 4 then '  ' when 5 then 'None' else diff end as diff "
    f"from files), live as (select * exclude (diff), {c.d_strip('diff')} as diff from doc_files "
    f"where {c.d_strip('diff')} <> '' and lower({c.d_strip('diff')}) not in ('nan', 'none')), "
    "pathed as (select *, case when regexp_matches(diff, '(?:^|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}])(?:--- a/|\\+\\+\\+ b/)') "
    "then regexp_extract(diff, '(?:^|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}])(?:--- a/|\\+\\+\\+ b/)([^\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]*)', 1) "
    "else 'unknown_' || file_ord end as file_path from live)"
)


def sql_text(template: str, **values: str) -> str:
    """A SQL concatenation for a prompt template, written from the template text."""
    out = template.replace("'", "''").replace("{{", "\0").replace("}}", "\1")
    for name, value in values.items():
        out = out.replace("{" + name + "}", f"' || {value} || '")
    return "('" + out.replace("\0", "{").replace("\1", "}") + "')"


def d_file_prompt(diff: str = "diff") -> str:
    return sql_text(pr.FILE_SUMMARY, file_path="file_path", diff=diff)[:-1] + " || chr(10) || '/no_think')"


def d_synthesis_prompt(message: str, lines: str) -> str:
    text = sql_text(pr.COMMIT_SYNTHESIS, commit_message=message, file_summaries=lines)
    return text[:-1] + " || chr(10) || '/no_think')"


def d_stub(prompt: str) -> str:
    return f"'stub ' || md5({prompt}) || ' of ' || length({prompt}) || ' chars'"


def live_files(spark, sf):
    return doc_files(spark, sf).where(~tx.is_blank_diff(F.col("diff"))).select("commit_hash", "file_ord")


def file_paths(spark, sf):
    return sm.summarisable_files(doc_files(spark, sf)).select("commit_hash", "file_ord", "file_path")


def truncated(spark, sf):
    docs = c.table(spark, sf, "documents")
    return docs.select(
        "doc_id",
        F.md5(tx.truncate_diff(F.col("text"), LIMIT)).alias("text_md5"),
        (F.length("text") > LIMIT).alias("truncated"),
    )


def file_prompts(spark, sf):
    return sm.summarisable_files(doc_files(spark, sf), LIMIT).select(
        "commit_hash", "file_ord", c.md5_of("prompt", "prompt_md5")
    )


def synthesis_prompts(spark, sf):
    docs = c.table(spark, sf, "documents")
    return docs.select(
        "doc_id", F.md5(pr.synthesis_prompt(F.col("source"), F.col("text"), False)).alias("prompt_md5")
    )


def no_think(spark, sf):
    docs = c.table(spark, sf, "documents")
    return docs.select("doc_id", F.md5(pr.finish(F.col("text"), True)).alias("prompt_md5"))


_ESCAPED = r"replace(replace(replace(text, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n')"
_BASE = f"'{{\"file_summary\": \"' || {_ESCAPED} || '\"}}'"
_REPLY_FORMS = (
    "case doc_id % 9 when 0 then {base} "
    "when 1 then '```json' || chr(10) || {base} || chr(10) || '```' "
    "when 2 then '```' || chr(10) || {base} || '```' "
    "when 3 then substr({base}, 1, length({base}) - 1) "
    "when 4 then substr({base}, 1, length({base}) - 2) "
    "when 5 then 'The answer: ' || {base} || ' hope it helps' "
    "when 6 then '{{\"other\": 1}}' "
    "when 7 then ' ' || chr(10) "
    "else substr({base}, 1, 20 + cast(length({base}) / 2 as int)) end"
)
S_REPLIES = _REPLY_FORMS.format(base=_BASE)
_D_BASE = "'{\"file_summary\": \"' || replace(replace(replace(text, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n') || '\"}'"
D_REPLIES = "replies as (select doc_id, " + _REPLY_FORMS.format(base=_D_BASE).replace(
    "cast(length(" + _D_BASE + ") / 2 as int)", "length(" + _D_BASE + ") // 2"
) + " as raw from documents)"
# The four readings, stated once more in SQL.
D_READ = (
    f"{D_REPLIES}, r1 as (select *, {c.d_strip('raw')} as c from replies), "
    f"r2 as (select *, {c.d_strip('''regexp_replace(regexp_replace(c, '^```(?:json)?\\s*\\n?', ''), '\\n?```\\s*$', '')''')} as st from r1), "
    "r3 as (select *, case when ends_with(st, '}') then st else st || "
    "case when length(regexp_replace(regexp_replace(st, '(?s)\\\\.', '', 'g'), '[^\"]', '', 'g')) % 2 = 1 "
    "then '\"' else '' end || '}' end as rp from r2), "
    "r4 as (select *, case when json_valid(c) then json_extract_string(c, '$.file_summary') end as v1, "
    "case when json_valid(st) then json_extract_string(st, '$.file_summary') end as v2, "
    "case when json_valid(rp) then json_extract_string(rp, '$.file_summary') end as v3, "
    "case when regexp_matches(c, '\"file_summary\"\\s*:\\s*\"') then "
    "replace(replace(replace(regexp_extract(c, '(?s)\"file_summary\"\\s*:\\s*\"((?:[^\"\\\\]|\\\\.)*)', 1), "
    "'\\\"', '\"'), '\\n', chr(10)), '\\\\', '\\') end as v4 from r3), "
    "recovered as (select *, coalesce(v1, v2, v3, v4) as value from r4)"
)


def replies(spark, sf):
    return c.table(spark, sf, "documents").selectExpr("doc_id", S_REPLIES + " as raw")


def recovered(spark, sf):
    out = replies(spark, sf).select("doc_id", rp.read_reply(F.col("raw"), "file_summary").alias("r"))
    return out.select(
        "doc_id", F.md5("r.value").alias("value_md5"), F.col("r.value").isNull().alias("failed")
    )


def empty_replies(spark, sf):
    out = replies(spark, sf).select("doc_id", rp.read_reply(F.col("raw"), "file_summary").alias("r"))
    return out.where(F.col("r.error") == "empty reply").select("doc_id")


def lines_of_conversations(spark, sf):
    return c.table(spark, sf, "conversations").select(
        "conv_id", "turn", tx.summary_line(F.col("role"), F.col("text")).alias("line")
    )


def summary_lines(spark, sf):
    return lines_of_conversations(spark, sf).select("conv_id", "turn", c.md5_of("line", "line_md5"))


def packed(spark, sf):
    return pack_lines(lines_of_conversations(spark, sf), ["conv_id"], "turn", "line", LIMIT).select(
        "conv_id", "chunk_no", "n_lines", c.md5_of("text", "text_md5"), "fits"
    )


def packed_in_order(spark, sf):
    return pack_lines(
        lines_of_conversations(spark, sf), ["conv_id"], "turn", "line", sm.MAX_SYNTHESIS_LENGTH
    ).select("conv_id", "n_lines", c.md5_of("text", "text_md5"))


D_LINES = "lines as (select conv_id, turn, '- ' || role || ': ' || text as line from conversations)"
D_PACKED = (
    f"{D_LINES}, ranked as (select *, row_number() over (partition by conv_id order by turn) as r, "
    "sum(length(line) + 1) over (partition by conv_id) - 1 as joined from lines), "
    "walk as (select conv_id, r, line, joined, length(line) + 1 as used, 0 as chunk_no from ranked "
    "where r = 1 union all select n.conv_id, n.r, n.line, n.joined, "
    f"case when n.joined > {LIMIT} and w.used + length(n.line) + 1 > {LIMIT} then length(n.line) + 1 "
    "else w.used + length(n.line) + 1 end, "
    f"case when n.joined > {LIMIT} and w.used + length(n.line) + 1 > {LIMIT} then w.chunk_no + 1 "
    "else w.chunk_no end from walk w join ranked n on n.conv_id = w.conv_id and n.r = w.r + 1), "
    "chunks as (select conv_id, chunk_no, count(*) as n_lines, "
    "string_agg(line, chr(10) order by r) as text, "
    f"any_value(joined) <= {LIMIT} as fits from walk group by conv_id, chunk_no)"
)


def reduced(spark, sf):
    lines = lines_of_conversations(spark, sf)
    messages = lines.select("conv_id").distinct().select(
        "conv_id", F.concat(F.lit("conversation "), "conv_id").alias("commit_message")
    )
    return sm.synthesise(
        lines, messages, stub_model("semantic_summary"), ["conv_id"], "turn", "line", LIMIT
    ).select("conv_id", "value", "status", "levels")


_SYN1 = d_synthesis_prompt("'conversation ' || conv_id", "text")
D_REDUCED = (
    f"{D_PACKED}, first_level as (select conv_id, chunk_no, fits, {d_stub(_SYN1)} as value from chunks), "
    "second_text as (select conv_id, string_agg(value, chr(10) order by chunk_no) as text "
    "from first_level where not fits group by conv_id)"
)


def file_summaries(spark, sf):
    files = sm.summarisable_files(doc_files(spark, sf))
    return sm.summarise_files(files, stub_model("file_summary")).select(
        "commit_hash", "file_ord", "file_path", "summary", "status", "attempts"
    )


def commit_summaries(spark, sf):
    """One synthesis per document, its text taken as the packed file summaries."""
    prompts = c.table(spark, sf, "documents").select(
        "doc_id", pr.synthesis_prompt(F.col("source"), F.col("text")).alias("prompt")
    )
    return infer(prompts, "prompt", "semantic_summary", stub_model("semantic_summary")).select(
        "doc_id", "value", "status"
    )


def summarised(spark, sf):
    return plan.summarise_commits(
        doc_files(spark, sf).withColumns({"pr_message": F.lit(None).cast("string"), "pr_id": F.lit(None).cast("long")}),
        spark.createDataFrame([], FILE_SUMMARIES),
        stub_model("file_summary"),
        stub_model("semantic_summary"),
    )


def summarise_all(spark, sf):
    return summarised(spark, sf).select(
        "repo_id", "commit_hash", c.md5_of("commit_message", "message_md5"), "semantic_summary", "status"
    )


_SYN_COMMIT = d_synthesis_prompt("commit_message", "text")
D_FILE_SUMMARIES = (
    f"{D_DOC_FILES}, file_summaries as (select *, {d_stub(d_file_prompt())} as summary from pathed)"
)
D_SUMMARISED = (
    f"{D_FILE_SUMMARIES}, joined as (select repo_id, commit_hash, any_value(commit_message) as commit_message, "
    "string_agg('- ' || file_path || ': ' || summary, chr(10) order by file_ord) as text "
    "from file_summaries group by repo_id, commit_hash), "
    f"made as (select repo_id, commit_hash, {d_stub(_SYN_COMMIT)} as semantic_summary from joined)"
)


def no_changes(spark, sf):
    only_blank = doc_files(spark, sf).withColumns(
        {
            "diff": F.expr("case when commit_ord % 3 = 0 then ' ' else diff end"),
            "pr_message": F.lit(None).cast("string"),
            "pr_id": F.lit(None).cast("long"),
        }
    )
    none = spark.createDataFrame([], FILE_SUMMARIES)
    made = plan.summarise_commits(only_blank, none, stub_model("file_summary"), stub_model("semantic_summary"))
    summary = F.col("semantic_summary")
    return made.select("commit_hash", F.when(summary == sm.NO_CHANGES, summary).alias("semantic_summary"))


def grouped(spark, sf):
    return sm.commits_per_hash(doc_files(spark, sf))


def first_attributes(spark, sf):
    rows = doc_files(spark, sf).withColumns(
        {
            "commit_message": F.concat("commit_hash", F.lit("/"), F.col("file_ord").cast("string")),
            "pr_message": F.lit(None).cast("string"),
            "pr_id": F.when(F.col("commit_ord") % 2 == 0, F.col("commit_ord")),
        }
    )
    return sm.commit_attributes(rows).select("repo_id", "commit_hash", "commit_message", "pr_id")


def unsummarised(spark, sf):
    rows = doc_files(spark, sf)
    stored = c.summaries(spark, sf).where("pr_id is not null")
    return sm.not_summarised(rows, stored).groupBy("commit_hash").agg(F.count("*").alias("n_files"))


def undone_files(spark, sf):
    files = sm.summarisable_files(doc_files(spark, sf))
    stored = files.where("(commit_ord + file_ord) % 2 = 0").select(*sm.COMMIT_KEYS, "file_path")
    return sm.not_done(files, stored).select("commit_hash", "file_ord", "file_path")


def resume(spark, sf):
    """Summarise the even commits, then everything: the second run skips the first."""
    rows = cut(
        doc_files(spark, sf).withColumns(
            {"pr_message": F.lit(None).cast("string"), "pr_id": F.lit(None).cast("long")}
        )
    )
    out = scratch_path(spark, "resume")
    first = plan.run(spark, rows.where("commit_ord % 2 = 0"), out)
    second = plan.run(spark, rows, out)
    counts = [
        (name, run[name]) for run in (first, second) for name in ("processed", "skipped", "failed")
    ]
    stored = spark.read.parquet(f"{out}/summaries").agg(
        F.count("*").alias("rows"), F.count_distinct("commit_hash").alias("commits")
    )
    labels = [F.lit(n).cast("long").alias(f"{k}_{i // 3 + 1}") for i, (k, n) in enumerate(counts)]
    return stored.select("*", *labels)


def run_states(spark, sf):
    made = c.table(spark, sf, "events").select(F.col("event_type").alias("status"))
    return plan.status_counts(made)


def totals(spark, sf):
    return sm.row_totals(doc_files(spark, sf))


def distinct_commits(spark, sf):
    return sm.distinct_commits(c.summaries(spark, sf))


def sketched_commits(spark, sf):
    """Sketches of two loads, united, next to the exact counts of both together."""
    rows = c.commits(spark, sf)
    halves = [sm.commit_sketches(rows.where(F.col("commit_ord") % 2 == k)) for k in (0, 1)]
    found = sm.estimated_commits(sm.united(halves[0].unionByName(halves[1])))
    counted = rows.groupBy("repo_id").agg(F.count_distinct("commit_hash").alias("exact"))
    close = F.abs(F.col("n_commits") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * 0.03)
    return counted.join(found, "repo_id", "left").select("repo_id", "exact", close.alias("close"))


def short_hashes(spark, sf):
    return c.commits(spark, sf).select("commit_hash", tx.short_hash(F.col("commit_hash")).alias("short"))


def typed_lists(spark, sf):
    docs = c.table(spark, sf, "documents").selectExpr(
        "doc_id",
        "case when doc_id % 5 = 0 then '{\"categories\": 3' else "
        "'{\"categories\": [\"' || lang || '\", \"' || source || '\"]}' end as reply",
    )
    out = docs.select("doc_id", rp.read_typed(F.col("reply"), "categories", "array<string>").alias("r"))
    return out.select(
        "doc_id", F.array_join("r.value", "|").alias("categories"), F.col("r.error").isNotNull().alias("bad")
    )


CHECKS = {
    "p07_skip_blank_diffs": (live_files, f"with {D_DOC_FILES} select commit_hash, file_ord from live"),
    "p08_file_path": (file_paths, f"with {D_DOC_FILES} select commit_hash, file_ord, file_path from pathed"),
    "p09_truncate": (
        truncated,
        f"select doc_id, md5(case when length(text) > {LIMIT} then substr(text, 1, {LIMIT}) || chr(10) || "
        f"chr(10) || '[... DIFF TRUNCATED ...]' else text end) as text_md5, length(text) > {LIMIT} as truncated "
        "from documents",
    ),
    "p10_file_prompt": (
        file_prompts,
        f"with {D_DOC_FILES}, cutdiff as (select *, case when length(diff) > {LIMIT} then "
        f"substr(diff, 1, {LIMIT}) || chr(10) || chr(10) || '[... DIFF TRUNCATED ...]' else diff end as d "
        f"from pathed) select commit_hash, file_ord, md5({d_file_prompt('d')}) as prompt_md5 from cutdiff",
    ),
    "p11_synthesis_prompt": (
        synthesis_prompts,
        f"select doc_id, md5({sql_text(pr.COMMIT_SYNTHESIS, commit_message='source', file_summaries='text')}) "
        "as prompt_md5 from documents",
    ),
    "p12_no_think": (no_think, "select doc_id, md5(text || chr(10) || '/no_think') as prompt_md5 from documents"),
    "p13_recover_reply": (
        recovered,
        f"with {D_READ} select doc_id, md5(value) as value_md5, value is null as failed from recovered",
    ),
    "p14_empty_reply": (empty_replies, f"with {D_READ} select doc_id from recovered where c = ''"),
    "p15_summary_line": (
        summary_lines, f"with {D_LINES} select conv_id, turn, md5(line) as line_md5 from lines"
    ),
    "p16_no_changes": (
        no_changes,
        f"with {D_DOC_FILES} select h.commit_hash, case when count(l.commit_hash) = 0 "
        "then 'No file changes to summarize.' end as semantic_summary from commits h left join "
        "(select * from live where commit_ord % 3 <> 0) l using (repo_id, commit_hash) group by all",
    ),
    "p27_short_hash": (
        short_hashes, f"with {c.D_COMMITS} select commit_hash, substr(commit_hash, 1, 8) as short from commits"
    ),
    "m10_typed_output": (
        typed_lists,
        "select doc_id, case when doc_id % 5 = 0 then null else lang || '|' || source end as categories, "
        "doc_id % 5 = 0 as bad from documents",
    ),
    "a01_group_by_commit": (
        grouped,
        f"with {D_DOC_FILES} select repo_id, commit_hash, count(*) as n_files from doc_files group by all",
    ),
    "a02_first_row_attributes": (
        first_attributes,
        f"with {D_DOC_FILES} select repo_id, commit_hash, commit_hash || '/0' as commit_message, "
        "case when commit_ord % 2 = 0 then commit_ord end as pr_id from commits",
    ),
    "a09_commit_sketch": (
        sketched_commits,
        f"with {c.D_COMMITS} select repo_id, count(distinct commit_hash) as exact, true as close from commits group by repo_id",
    ),
    "a09_distinct_commits": (
        distinct_commits,
        f"with {c.D_SUMMARIES} select count(distinct commit_hash) as n_commits from summaries",
    ),
    "a14_status_counts": (run_states, "select event_type as status, count(*) as n from events group by 1"),
    "a16_chunk_packing": (
        packed,
        f"with recursive {D_PACKED} select conv_id, chunk_no, n_lines, md5(text) as text_md5, fits from chunks",
    ),
    "a17_hierarchical_reduce": (
        reduced,
        f"with recursive {D_REDUCED} select conv_id, value, 'completed' as status, 1 as levels from first_level "
        f"where fits union all select conv_id, {d_stub(_SYN1)}, 'completed', 2 from second_text",
    ),
    "a18_pack_in_order": (
        packed_in_order,
        f"with {D_LINES} select conv_id, count(*) as n_lines, "
        "md5(string_agg(line, chr(10) order by turn)) as text_md5 from lines group by conv_id",
    ),
    "a19_totals": (
        totals,
        f"with {D_DOC_FILES} select count(*) as n_rows, count(distinct commit_hash) as n_commits from doc_files",
    ),
    "j06_skip_summarised_commits": (
        unsummarised,
        f"with {D_DOC_FILES} select commit_hash, count(*) as n_files from doc_files where commit_hash not in "
        "(select md5(cast(doc_id as varchar)) from documents where doc_id % 4 = 0) group by 1",
    ),
    "j07_skip_done_files": (
        undone_files,
        f"with {D_DOC_FILES} select commit_hash, file_ord, file_path from pathed p where not exists "
        "(select 1 from pathed d where d.commit_hash = p.commit_hash and d.file_path = p.file_path "
        "and (d.commit_ord + d.file_ord) % 2 = 0)",
    ),
    "m01_file_summaries": (
        file_summaries,
        f"with {D_FILE_SUMMARIES} select commit_hash, file_ord, file_path, summary, 'completed' as status, "
        "1 as attempts from file_summaries",
    ),
    "m02_commit_synthesis": (
        commit_summaries,
        f"select doc_id, {d_stub(d_synthesis_prompt('source', 'text'))} as value, 'completed' as status "
        "from documents",
    ),
    "m03_summarise_commits": (
        summarise_all,
        f"with {D_SUMMARISED} select repo_id, commit_hash, md5(message) as message_md5, "
        "coalesce(semantic_summary, 'No file changes to summarize.') as semantic_summary, "
        "'completed' as status from commits left join made using (repo_id, commit_hash)",
    ),
    "r01_resume_commits": (
        resume,
        "select count(*) as rows, count(*) as commits, count_if(doc_id % 2 = 0) as processed_1, "
        "cast(0 as bigint) as skipped_1, cast(0 as bigint) as failed_1, count_if(doc_id % 2 = 1) as processed_2, "
        "count_if(doc_id % 2 = 0) as skipped_2, cast(0 as bigint) as failed_2 from documents",
    ),
}
