"""Commit to pull request links and the whole transformation."""

import pytest
from pyspark.sql import functions as F

from gitloom.operators.linking import first_pr_per_commit, with_pull_request
from gitloom.plans.etl import build_file_diffs, run
from gitloom.schemas import COMMITS, PRS
from gitloom.session import scratch_path, scratch_root
from gitloom.sources.dumps import normalise_commits, read_commit_dump, read_pr_pages
from gitloom.sources.paths import child_names
from gitloom.sources.tables import read_file_diffs, write_by_repo

HASH_A, HASH_B = "abc1234" + "0" * 33, "def5678" + "1" * 33


def commits(spark, *rows):
    return spark.createDataFrame([(r, h, n, "m", d) for n, (r, h, d) in enumerate(rows)], COMMITS)


def prs(spark, *rows):
    return spark.createDataFrame(
        [(r, i, n, t, b, "u", "2024", None) for n, (r, i, t, b) in enumerate(rows)], PRS
    )


def links(spark, commit_rows, pr_rows):
    found = first_pr_per_commit(commits(spark, *commit_rows), prs(spark, *pr_rows)).collect()
    return {(r.repo_id, r.commit_hash): r.pr_id for r in found}


def test_first_request_wins_and_repos_are_separate(spark):
    got = links(
        spark,
        [("o/r", HASH_A, ""), ("o/r", HASH_B, ""), ("o/s", HASH_A, "")],
        [("o/r", 9, "first abc1234", None), ("o/r", 1, "t", f"again {HASH_A}"), ("o/s", 5, "x", "nothing")],
    )
    assert got == {("o/r", HASH_A): 9}


def test_upper_case_and_longer_tokens_do_not_match(spark):
    got = links(spark, [("o/r", HASH_A, "")], [("o/r", 1, "ABC1234", "abc12341")])
    assert got == {}


def test_token_quoted_by_many_requests(spark):
    many = [("o/r", 1000 - n, f"pr {n}", "see abc1234") for n in range(200)]
    assert links(spark, [("o/r", HASH_A, "")], many) == {("o/r", HASH_A): 1000}


def test_enrichment_is_left_outer(spark):
    out = with_pull_request(commits(spark, ("o/r", HASH_A, ""), ("o/r", HASH_B, "")), prs(spark, ("o/r", 3, "abc1234", None)))
    assert {r.commit_hash: (r.pr_id, r.pr_message) for r in out.collect()} == {HASH_A: (3, None), HASH_B: (None, None)}


def test_every_occurrence_of_a_commit_gets_rows(spark):
    rows = build_file_diffs(
        commits(spark, ("o/r", HASH_A, "diff --git a b\n+1\ndiff --git c d\n+2"), ("o/r", HASH_A, "")),
        prs(spark, ("o/r", 3, "abc1234", "body")),
    ).collect()
    assert sorted((r.commit_ord, r.file_ord, r.diff, r.pr_id) for r in rows) == [(0, 0, "+1", 3), (0, 1, "+2", 3), (1, 0, "", 3)]


def test_reject_and_default(spark):
    df = spark.createDataFrame([("r", "h", 0, None, "d"), ("r", "h2", 1, "m", None)], COMMITS)
    valid, rejects = normalise_commits(df)
    assert [(r.commit_hash, r.diff) for r in valid.collect()] == [("h2", "")]
    assert [r.missing_fields for r in rejects.collect()] == [["message"]]


def test_dump_to_parquet_and_back(spark):
    source, pages, out = (scratch_path(spark, x) for x in ("dump", "pages", "out"))
    # hashes that a type guess would read as numbers, repos with a slash
    commits(spark, ("o/r", "1234567", "diff --git a b\n+1"), ("o/r", "12e4567", ""), ("p/q", "abc", "")).write.partitionBy("repo_id").json(source)
    assert {r.commit_hash for r in read_commit_dump(spark, source).collect()} == {"1234567", "12e4567", "abc"}
    page = '[{"id": 4, "title": "t 1234567", "body": null, "user": {"login": "u"}, "created_at": "c", "merged_at": null}]'
    spark.createDataFrame([(page, "o/r", 0), ('{"message": "Not Found"}', "p/q", 0)], "value string, repo_id string, page int").write.partitionBy("repo_id", "page").text(pages)
    assert [(r.repo_id, r.pr_id, r.user) for r in read_pr_pages(spark, pages).collect()] == [("o/r", 4, "u")]
    assert read_pr_pages(spark, pages + "-missing").isEmpty()
    for _ in range(2):  # a rerun replaces, it does not add
        assert run(spark, source, pages, out) == {"written": True, "rejected": 0}
    rows = read_file_diffs(spark, out).collect()
    assert sorted((r.repo_id, r.commit_hash, r.pr_id) for r in rows) == [
        ("o/r", "1234567", 4), ("o/r", "12e4567", None), ("p/q", "abc", None),
    ]


def test_rows_that_lack_a_field_are_kept_apart(spark):
    source, pages, out = (scratch_path(spark, x) for x in ("dump", "pages", "out"))
    rows = commits(spark, ("o/r", "aaa1111", ""), ("o/r", "bbb2222", "")).withColumn(
        "message", F.when(F.col("commit_hash") == "aaa1111", F.lit("m"))
    )
    rows.write.partitionBy("repo_id").json(source)
    assert run(spark, source, pages, out) == {"written": True, "rejected": 1}
    assert [(r.kind, r.id, r.missing_fields) for r in spark.read.parquet(f"{out}_rejects").collect()] == [
        ("commit", "bbb2222", ["message"])
    ]


def test_files_follow_bytes_not_tasks(spark):
    path = scratch_path(spark, "files")
    rows = spark.range(2000).selectExpr("'r' || id % 20 as repo_id", "id as v").repartition(16)
    assert write_by_repo(rows, path) is True
    files = spark.read.parquet(path).select(F.input_file_name()).distinct().count()
    assert 20 <= files <= 40


def test_jobs_leave_no_scratch_tables(spark):
    source, pages, out = (scratch_path(spark, x) for x in ("dump", "pages", "out"))
    commits(spark, ("o/r", "aaa1111", "diff --git a b\n+1")).write.partitionBy("repo_id").json(source)
    before = set(child_names(spark, scratch_root(spark)))
    run(spark, source, pages, out)
    made = set(child_names(spark, scratch_root(spark))) - before
    assert made == {out.rsplit("/")[-1], out.rsplit("/")[-1] + "_rejects"}


def test_tables_with_spaced_names_can_be_read(spark):
    path = scratch_path(spark, "spaced")
    rows = [("o/r", "abc", "msg", "--- a/x\n+1", None, None)]
    names = "`Repo ID` string, `commit hash` string, `commit message` string, diff string, `PR message` string, `PR ID` long"
    spark.createDataFrame(rows, names).write.option("compression", "none").parquet(path)
    assert read_file_diffs(spark, path).columns == ["repo_id", "commit_hash", "commit_message", "diff", "pr_message", "pr_id"]


def test_empty_sink_and_checked_scan(spark):
    path = scratch_path(spark, "none")
    assert write_by_repo(commits(spark).drop("x"), path) is False
    with pytest.raises(FileNotFoundError):
        read_file_diffs(spark, path)
    spark.range(1).write.parquet(path)
    with pytest.raises(ValueError, match="Missing required columns"):
        read_file_diffs(spark, path)
