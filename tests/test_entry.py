"""The driver contract."""

import importlib.util
import sys

import __spark_entry__ as entry
from checks import all_checks
from checks.compare import compare

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    assert set(all_checks()) <= set(sql)
    assert all(callable(fn) for fn in queries.values())


def test_core_queries_do_not_need_what_optional_modules_need(monkeypatch):
    """A dependency that is not there leaves the optional queries out and no others."""
    optional = "gitloom." + "llm"
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith(optional)]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)
    monkeypatch.setitem(sys.modules, "xxhash", None)
    spec = importlib.util.spec_from_file_location("entry_again", entry.__file__)
    again = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(again)
    assert set(again.queries()) == set(again.oracle_sql()) == set(all_checks())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["repo_id", "commit_hash", "file_ord"] and df.count() > 0


def test_a_query_per_slice_equals_its_sql(spark):
    queries, sql = entry.queries(), entry.oracle_sql()
    for name in ("j03_left_enrichment", "p13_recover_reply", "a16_chunk_packing", "s09_incremental_load", "m08_assign_categories", "w02_zscore"):
        assert compare(spark, SF, name, queries[name], sql[name]).startswith("OK"), name


def test_link_plan_moves_no_diff_text_to_find_requests(spark):
    """The link reads hashes only, and no Python worker takes part in the transformation."""
    from checks import common as c
    from gitloom.operators.linking import first_pr_per_commit
    from gitloom.plans.etl import build_file_diffs

    commits = c.commits(spark, SF)
    link = first_pr_per_commit(commits, c.prs(spark, SF))
    plan = link._jdf.queryExecution().executedPlan().toString()
    # the commits side of the link scans ids and repos; the text column is pruned
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan
    whole = build_file_diffs(commits, c.prs(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in whole and "CartesianProduct" not in whole and "NestedLoop" not in whole
