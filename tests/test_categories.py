"""Categories, batches, sinks, disagreement."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gitloom.operators import categories as ct
from gitloom.operators import disagreement as ds
from checks import categories as category_checks
from gitloom.operators.batches import batch_count, kmeans_batches
from gitloom.operators.far_pairs import far_pairs
from gitloom.operators.inference import Model
from gitloom.plans import categorise as plan
from gitloom.session import scratch_path
from gitloom.sources import collection as store
from gitloom.sources import tables
from gitloom.plans.load import load_frame


def test_rare_categories_roll_up_and_null_stays(spark):
    rows = [("big",)] * 10 + [("small",)] * 9 + [(None,)] * 3
    got = ct.roll_up_rare(spark.createDataFrame(rows, "category string")).groupBy("category").count().collect()
    assert {r["category"]: r["count"] for r in got} == {"big": 10, "Other": 9, None: 3}


def test_category_sink_keeps_both_names(spark):
    path = scratch_path(spark, "cat")
    df = spark.createDataFrame([("a/b", 1), ("a_b", 2), (None, 3)], "category string, v int")
    tables.write_by_category(df, path)
    assert sorted(r.v for r in tables.read_category(spark, path, "a/b", df.schema).collect()) == [1, 2]


def test_batch_counts_and_exact_numbers_of_batches(spark):
    assert [batch_count(n, 20) for n in (0, 1, 20, 21, 100)] == [1, 1, 1, 2, 5]
    rng = np.random.RandomState(42)
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(rng.randn(100, 8))]
    df = spark.createDataFrame(rows, "id int, embedding array<double>")
    flat = kmeans_batches(df, 20, restarts=2).toPandas()
    assert sorted(flat.id) == list(range(100)) and flat.batch.nunique() == 5
    many = kmeans_batches(df, 1, restarts=2).toPandas()
    assert many.batch.nunique() == 100
    # fewer distinct vectors than batches, copies stay together
    copies = df.unionByName(df).unionByName(df).withColumn("id", F.monotonically_increasing_id())
    few = kmeans_batches(copies.where("embedding[0] > 1"), 1, restarts=1)
    n = df.where("embedding[0] > 1").count()
    assert few.select("batch").distinct().count() == n and few.groupBy("batch").count().where("count != 3").isEmpty()


def test_more_batches_than_one_block_of_centres_holds(spark):
    rng = np.random.RandomState(1)
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(rng.randn(2600, 4))]
    df = spark.createDataFrame(rows, "id int, embedding array<double>")
    got = kmeans_batches(df, 2, restarts=1).toPandas()
    assert sorted(got.id) == list(range(2600)) and got.batch.nunique() == 1300


def test_batches_find_planted_groups(spark):
    rows = [(i, [float(10 * (i % 4)) + (i // 4) * 0.01, float(i % 4)]) for i in range(80)]
    got = kmeans_batches(spark.createDataFrame(rows, "id int, embedding array<double>"), 20).toPandas()
    assert got.groupby(got.id % 4).batch.nunique().tolist() == [1] * 4 and got.batch.nunique() == 4


def test_failures_are_not_silent(spark):
    """A failed batch or assignment ends the job, keeps its stages and loses no document."""
    batched = spark.createDataFrame([(0, 1, "good"), (1, 2, "bad")], "batch int, ord int, text string")
    half = Model("d", reply=lambda p: F.when(p.contains("bad"), "junk").otherwise('{"categories": ["A"]}'))
    with pytest.raises(ValueError, match="batch 1"):
        ct.discover(batched, half)
    root, work = scratch_path(spark, "col"), scratch_path(spark, "work")
    load_frame(spark.createDataFrame([(f"h{i}", f"text {i}") for i in range(10)], "commit_hash string, semantic_summary string"), root)
    given = spark.createDataFrame([(f"h{i}", 0) for i in range(10)], "id string, batch int")
    odd = Model("a", reply=lambda p: F.when(p.contains("text 7"), "junk").otherwise('{"category": "Odd"}'))
    with pytest.raises(ValueError, match="1 documents got no category"):
        plan.categorise(spark, root, work, batches=given, assignment=odd)
    assert spark.read.parquet(f"{work}/stages/assigned").count() == 9
    whole = Model("a", reply=lambda p: F.lit('{"category": "Odd"}'))
    done = plan.categorise(spark, root, work, batches=given, assignment=whole, other_off_list=True).collect()
    assert len(done) == 10 and {r.category for r in done} == {"Other"}


def test_long_lists_are_assigned_in_pieces(spark):
    docs = spark.createDataFrame([("x", "doc x"), ("y", "doc y")], "id string, document string")
    listed = spark.createDataFrame([(i, f"Cat{i}") for i in range(6)], "n long, category string")
    choose = Model("a", reply=lambda p: F.when(p.contains("- Cat4"), '{"category": "Cat4"}').when(p.contains("- Cat1"), '{"category": "Cat1"}').otherwise('{"category": "Cat0"}'))
    got = {r.id: (r.category, r.status) for r in ct.assign(docs, listed, choose, max_chars=14).collect()}
    assert got == {"x": ("Cat4", "completed"), "y": ("Cat4", "completed")}


def test_model_driven_categories(spark):
    batched = spark.createDataFrame([(0, 1, "t1"), (0, 2, "t2"), (1, 3, "t3")], "batch int, ord int, text string")
    discovery = Model("d", reply=lambda p: F.when(p.contains("Summary 2: t2"), '{"categories": ["B", "A"]}').otherwise('{"categories": ["A"]}'))
    listed = ct.in_batch_order(ct.discover(batched, discovery))
    assert [r.category for r in listed.orderBy("n").collect()] == ["B", "A", "A"]
    merge = Model("m", reply=lambda p: F.when(p.contains("- B"), '{"categories": ["A"]}').otherwise('{"categories": ["A"]}'))
    assert [r.category for r in ct.merge_with_model(listed, merge).collect()] == ["A"]
    # a list over the prompt size is merged in pieces and then once more
    small = ct.merge_with_model(listed, merge, max_chars=8)
    assert [r.category for r in small.collect()] == ["A"]
    docs = spark.createDataFrame([("x", "doc x"), ("y", "doc y")], "id string, document string")
    choose = Model("a", reply=lambda p: F.when(p.contains("doc x"), '{"category": "A"}').otherwise('{"category": "Odd"}'))
    answers = ct.assign(docs, listed, choose).select("id", "category")
    marked = {r.id: (r.category, r.off_list) for r in ct.flag_off_list(answers, listed).collect()}
    assert marked == {"x": ("A", False), "y": ("Odd", True)}
    strict = {r.id: r.category for r in ct.flag_off_list(answers, listed, replace=True).collect()}
    assert strict == {"x": "A", "y": "Other"}


def test_spellings_merge(spark):
    df = spark.createDataFrame([(1, "Bug  Fix"), (2, "bug fix "), (3, "API")], "n long, category string")
    assert [r.category for r in ct.merge_spellings(df).orderBy("n").collect()] == ["Bug  Fix", "API"]


def test_categorise_assigns_late_documents_only(spark):
    root, work = scratch_path(spark, "col"), scratch_path(spark, "work")
    df = spark.createDataFrame([("h1", "parser parser fixed"), ("h2", "parser speed")], "commit_hash string, semantic_summary string")
    load_frame(df, root)
    given = spark.createDataFrame([("h1", 0), ("h2", 0)], "id string, batch int")
    first = plan.categorise(spark, root, work, batches=given).collect()
    assert len(first) == 2 and {r.category for r in first} == {"Other"}  # below the threshold
    load_frame(spark.createDataFrame([("h3", "parser again")], df.schema), root, "incremental")
    assert len(plan.categorise(spark, root, work, batches=given).collect()) == 3
    assigned = spark.read.parquet(f"{work}/stages/assigned")
    assert {(r.id, r.category) for r in assigned.collect()} == {("h1", "parser"), ("h2", "parser"), ("h3", "parser")}


def test_run_pairs_and_reports(spark):
    rows = [("c1", "a", "fix the bug", 1), ("c1", "b", "fix the bug", 1), ("c1", "a", "later copy", 2),
            ("c2", "a", "one two three", 1), ("c2", "b", "four five six", 1), ("c3", "a", "alone", 1), ("c3", "b", "x y z", 1)]
    runs = spark.createDataFrame(rows, "commit_hash string, source_file string, semantic_summary string, o int")
    pairs = ds.run_pairs(runs, ["o"])
    got = {r.commit_hash: r for r in pairs.collect()}
    assert math.isclose(got["c1"].distance, 0, abs_tol=1e-12) and got["c2"].distance == 1.0 and got["c3"].distance is None
    assert got["c2"].euclidean == 2.0
    ranked = [r.commit_hash for r in ds.rank_pairs(pairs, ["commit_hash"]).collect()]
    assert ranked == ["c2", "c1", "c3"]  # no distance comes last
    texts = {r.commit_hash: (r.summary_1, r.summary_2) for r in ds.with_summaries(ds.top_pairs(pairs, ["commit_hash"], k=2), runs, ["o"]).collect()}
    assert texts["c1"] == ("fix the bug", "fix the bug")
    assert ds.drop_commits(pairs, ["c1"]).count() == 2
    bins = {r.bin: r.n for r in ds.histogram(pairs).collect()}
    assert bins == {1: 1, 30: 1}
    z = {r.commit_hash: r.distance_zscore for r in ds.with_zscore(pairs).collect()}
    assert math.isclose(z["c2"], -z["c1"]) and z["c3"] is None


def brute_far(texts, metric, k):
    import re

    sets = []
    for t in texts:
        w = re.findall(r"(?u)\b\w\w+\b", t.lower())
        sets.append({f"{a} {b}" for a, b in zip(w, w[1:])})
    out = []
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            a, b, s = len(sets[i]), len(sets[j]), len(sets[i] & sets[j])
            if metric == "cosine" and a and b:
                out.append((-(1 - s / math.sqrt(a * b)), i, j))
            elif metric == "euclidean":
                out.append((-math.sqrt(a + b - 2 * s), i, j))
    return [(i, j, round(-d, 9)) for d, i, j in sorted((round(d, 12), i, j) for d, i, j in out)[:k]]


def test_far_pairs_match_all_pairs(spark):
    rng = np.random.RandomState(3)
    vocabulary = [f"w{i}" for i in range(6)]
    # few words: no disjoint pairs at first, so every block has to be compared
    texts = [" ".join(rng.choice(vocabulary, rng.randint(1, 25))) for _ in range(60)] + ["", "one"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    for metric in ("cosine", "euclidean"):
        got = far_pairs(df, "id", "t", metric, 10, block_docs=7).collect()
        assert [(r.i, r.j, round(r.distance, 9)) for r in got] == brute_far(texts, metric, 10)


def test_csv_keeps_line_ends_and_quotes(spark):
    path = scratch_path(spark, "csv")
    df = spark.createDataFrame([(1, 'a "quoted"\nline, with comma'), (2, "plain")], "i int, t string")
    tables.write_csv(df, path)
    assert tables.read_csv(spark, path, df.schema).orderBy("i").collect() == df.collect()


def test_export_names(spark):
    df = spark.createDataFrame([("r", "h", 1)], "repo_id string, commit_hash string, pr_id int")
    assert tables.export_view(df).columns == ["Repo ID", "commit hash", "PR ID"]


def test_rare_categories_can_be_counted_elsewhere(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, category string")
    counted = spark.createDataFrame([("a",)] * 10 + [("b",)] * 9, "category string")
    got = {r.id: r.category for r in ct.roll_up_rare(rows, counted=counted).collect()}
    assert got == {1: "a", 2: "Other", 3: None}


def test_texts_do_not_meet_rare_categories(spark):
    root, work = scratch_path(spark, "collection"), scratch_path(spark, "work")
    rows = [(f"h{i}", f"alpha beta {'gamma' if i else 'delta'}", "r") for i in range(12)]
    load_frame(spark.createDataFrame(rows, "commit_hash string, semantic_summary string, repo_id string"), root)
    given = spark.createDataFrame([(f"h{i}", 0) for i in range(12)], "id string, batch int")
    found = plan.categorise(spark, root, work, batches=given)
    assert found.count() == 12
    # A join by category would take all texts of a category through one task.
    joins = [x for x in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in x]
    assert joins and "Inner" in joins[0]


def test_bigrams_are_sorted_in_tasks_of_few_texts(spark, monkeypatch, tmp_path):
    rows = [(i, f"one two three{i % 3}") for i in range(40)] + [(40, None), (0, "one two")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    whole = sorted(map(tuple, category_checks.bigram_rows(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(category_checks, "TEXTS_PER_TASK", 5)
    split = category_checks.bigram_rows(spark, str(tmp_path))
    assert "REPARTITION_BY_NUM" in split._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, split.collect())) == whole
    assert whole[0] == (0, 3, "one two", "two three0") and len(whole) == 40
