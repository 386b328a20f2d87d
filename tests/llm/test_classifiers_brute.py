"""Scores of both classifiers next to plain Python: FTRL row by row, and a walk of the trees."""

import math
import zlib
from bisect import bisect_right

import pytest
import xxhash
from pyspark.sql import functions as F

from gitloom.llm import queries, quality_classifier, toxicity
from gitloom.llm.common import table

SF = "/root/testdata/sf0.001"
MASK = (1 << 64) - 1


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def grams(text):
    """Slot to value of a text's one- and two-word runs."""
    tokens = [xxhash.xxh3_64_intdigest(t) for t in quality_classifier.words(text)]
    golden = 0x9E3779B97F4A7C15
    pairs = [((a * golden & MASK) ^ b) * golden & MASK for a, b in zip(tokens, tokens[1:], strict=False)]
    counts = {}
    for h in tokens + pairs:
        counts[h >> 46] = counts.get(h >> 46, 0) + 1
    logs = {s: math.log1p(n) for s, n in counts.items()}
    size = math.sqrt(sum(v * v for v in logs.values()))
    return {s: v / size for s, v in logs.items()}


def ftrl(rows, how):
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= how.l1:
            return 0.0
        rate = (how.beta + math.sqrt(n[i])) / how.alpha + how.l2
        return -(z[i] - math.copysign(how.l1, z[i])) / rate

    for _ in range(how.epochs):
        for values, label in rows:
            x = {**values, "bias": 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * x[i] for i in x)))
            for i in x:
                g = (p - label) * x[i]
                step = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / how.alpha
                z[i] = z.get(i, 0.0) + g - step * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z}


def test_quality_scores_equal_plain_ftrl(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect() if r["quality"] is not None}
    train = [i for i in labels if not held(i) and i in texts]
    assert 0 < len(train) < quality_classifier.REPLICA_ROWS  # one replica
    train.sort(key=lambda i: xxhash.xxh3_64_intdigest(str(i)))
    w = ftrl([(grams(texts[i] or ""), labels[i]) for i in train], quality_classifier.Ftrl())
    for r in queries.op5_quality_classifier(spark, SF).collect():
        found = grams(texts[r["doc_id"]] or "")
        expected = 1 / (1 + math.exp(-(w["bias"] + sum(w.get(s, 0.0) * v for s, v in found.items()))))
        assert r["score"] == pytest.approx(expected, abs=1e-6)
        assert r["held_out"] == held(r["doc_id"]) and r["predicted"] == int(r["score"] >= 0.3)


def test_quality_labels_without_documents(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(77, 1), (78, 0), (79, 1)], "doc_id long, quality int")
    weights = quality_classifier.fit(docs, labels)
    assert {r["score"] for r in quality_classifier.score(docs, weights).collect()} == {0.5}


def leaf(node, x):
    while node.subtreeDepth() > 0:
        split = node.split()
        node = node.leftChild() if x[split.featureIndex()] <= split.threshold() else node.rightChild()
    return node.prediction()


def interpolated(x, bounds, values):
    at = bisect_right(bounds, x)
    if at == 0:
        return values[0]
    if at == len(bounds) or bounds[at - 1] == x:
        return values[at - 1]
    share = (x - bounds[at - 1]) / (bounds[at] - bounds[at - 1])
    return values[at - 1] + share * (values[at] - values[at - 1])


def test_toxicity_scores_equal_a_walk_of_the_trees(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "You are an 1d10t!!! " * 900)], docs.schema)
    docs = docs.union(odd)
    model = toxicity.fit(docs, table(spark, SF, "labels"))
    assert model.trees is not None
    roots = [t._java_obj.rootNode() if hasattr(t, "_java_obj") else t._call_java("rootNode") for t in model.trees.trees]
    weights = list(model.trees.treeWeights)
    bounds = values = None
    if model.calibration is not None:
        bounds, values = model.calibration.boundaries.toArray().tolist(), model.calibration.predictions.toArray().tolist()
    for r in toxicity.score(docs, model).collect():
        x = toxicity.features(r["text"] or "", model.stems)
        margin = sum(w * leaf(root, x) for w, root in zip(weights, roots, strict=True))
        chance = 1 / (1 + math.exp(-2 * margin))
        expected = chance if bounds is None else interpolated(chance, bounds, values)
        assert r["score"] == pytest.approx(expected, abs=1e-9)
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_toxicity_of_any_small_sample(spark):
    ids = spark.range(400).where("crc32(cast(cast(id as string) as binary)) % 5 <> 0")
    part = F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(5 * 1_000_003)) % 5
    rows = ids.select("id", (part == 0).alias("calibrates")).collect()
    calibrates = [r["id"] for r in rows if r["calibrates"]][:4]
    grows = [r["id"] for r in rows if not r["calibrates"]][:4]
    docs = spark.range(400).selectExpr("id as doc_id", "concat('you text ', id) as text")

    def scores(chosen):
        labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(chosen)], "doc_id long, toxic int")
        return toxicity.score(docs, toxicity.fit(docs, labels)).collect()

    assert {r["score"] for r in scores(calibrates)} == {0.5}  # no row for the trees
    assert {r["score"] for r in scores([grows[0], calibrates[0], calibrates[1]])} == {1 / 3}  # one class only
    for chosen in (grows[:2], grows, [*grows, *calibrates], [grows[0], calibrates[1]]):
        assert all(0 <= r["score"] <= 1 for r in scores(chosen))
