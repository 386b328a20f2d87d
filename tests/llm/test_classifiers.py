"""Held-out accuracy on the driver's labels, and edge cases."""

from gitloom.llm import quality_classifier, toxicity
from gitloom.llm.common import table
from gitloom.llm.labelled import held_out, training_sample

SF = "/root/testdata/sf0.1"
EDGES = [(1, None, "x", 0.5), (1, "", "y", None), (None, "word " * 50_000, "z", 1.0)]
SCHEMA = "doc_id long, text string, features string, Score double"


def _auc(pairs):
    ranked = sorted(pairs)
    good = [i for i, (_, y) in enumerate(ranked, 1) if y]
    n, m = len(good), len(ranked) - len(good)
    return (sum(good) - n * (n + 1) / 2) / (n * m)


def _held_out_pairs(scored, labels, label):
    rows = scored.where(held_out()).join(labels, "doc_id").select("score", label).collect()
    return [(r[0], r[1]) for r in rows]


def test_quality_on_rows_that_were_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    weights = quality_classifier.fit(docs.select("doc_id", "text"), labels)
    scored = quality_classifier.score(docs.select("doc_id", "text"), weights)
    pairs = _held_out_pairs(scored, labels, "quality")
    assert _auc(pairs) > 0.97
    assert sum((s >= 0.3) == (y == 1) for s, y in pairs) / len(pairs) > 0.95
    edge = quality_classifier.score(spark.createDataFrame(EDGES, SCHEMA), weights).collect()
    assert len(edge) == 3 and all(0 <= r["score"] <= 1 for r in edge)
    assert edge[0]["score"] == edge[1]["score"]


def test_toxicity_on_rows_that_were_held_out(spark):
    docs, labels = table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "labels")
    model = toxicity.fit(docs, labels)
    pairs = _held_out_pairs(toxicity.score(docs, model), labels, "toxic")
    caught = [s >= 0.5 for s, y in pairs if y]
    clean = [s < 0.5 for s, y in pairs if not y]
    assert sum(caught) / len(caught) > 0.8 and sum(clean) / len(clean) > 0.97
    edge = toxicity.score(spark.createDataFrame(EDGES, SCHEMA), model).collect()
    assert len(edge) == 3 and all(0 <= r["score"] <= 1 for r in edge)


def test_without_labels_scores_are_defined(spark):
    docs = spark.createDataFrame(EDGES, SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one_class = spark.createDataFrame([(2, None, 0), (3, 1, 0)], none.schema)
    for labels in (none, one_class):
        weights = quality_classifier.fit(docs, labels)
        assert {r["score"] for r in quality_classifier.score(docs, weights).collect()} == {0.5}
        model = toxicity.fit(docs, labels)
        assert {r["score"] for r in toxicity.score(docs, model).collect()} == {0.0}
    assert quality_classifier.score(docs.limit(0), weights).count() == 0


def test_sample_is_bounded_and_leaves_the_fold_out(spark):
    docs = spark.range(5000).selectExpr("id as doc_id", "'t' as text").union(
        spark.range(3).selectExpr("id", "'s'")
    )
    labels = spark.range(5000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    drawn = training_sample(docs, labels, "quality", 1000)
    assert 800 < drawn.count() < 1200 and drawn.where(held_out()).isEmpty()
    assert training_sample(docs, labels, "quality", 10_000).where("doc_id = 1").collect()[0]["text"] == "s"


def test_features_see_hidden_words_and_pronouns():
    named = lambda t: dict(zip(toxicity.FEATURES, toxicity.features(t, frozenset(["abcde"])), strict=True))
    f = named("YOU are an 1d10t! and i.d.i.o.t, abcdefg")
    assert f["hidden_rate"] > 0 and f["near_rate"] > 0 and f["stem_rate"] > 0 and f["capital_rate"] > 0
    assert named("it's a well-known fact")["hidden_rate"] == 0
    assert set(named("").values()) == {0.0}
