import random

from pyspark.sql import functions as F

from gitloom.llm import minhash
from gitloom.llm.components import connected_components
from tests.llm import brute


def _texts(seed=9):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(30):
        base = rng.choices(vocabulary, k=rng.randint(8, 120))
        out.append(" ".join(base))
        for _ in range(rng.randint(0, 5)):
            changed = list(base)
            for _ in range(rng.randint(0, 4)):
                changed[rng.randrange(len(changed))] = rng.choice(vocabulary)
            out.append(" ".join(changed).upper())
    # A chain: each text is linked with its neighbours only.
    long = rng.choices(vocabulary, k=300)
    out += [" ".join(long[i * 12 : i * 12 + 200]) for i in range(8)]
    # A large group of near copies, and exact copies.
    out += [" ".join([*long[:100], f"n{i}", *long[100:]]) for i in range(60)]
    out += [" ".join(long)] * 30
    out += [None, "", " \t", "one", "ONE", "one two three four", "one two three four five"]
    rng.shuffle(out)
    return out


def test_equals_brute_force(spark):
    texts = _texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    for percent in (85, 80):
        found = minhash.near_duplicates(docs, percent).orderBy("doc_id").collect()
        assert [r["component_id"] for r in found] == brute.components(texts, percent)
        assert [r["n_shingles"] for r in found] == [len(brute.shingles(t)) for t in texts]
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_a_large_group_of_linked_and_unlinked_copies(spark):
    """Buckets that hold many components take several turns; no link may be lost."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(220):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 12])):
            at = rng.randrange(len(words))
            kind = rng.random()
            if kind < 0.5:
                words[at] = f"e{rng.randrange(9)}"
            elif kind < 0.8:
                del words[at : at + 3]
            else:
                words.insert(at, f"x{i}")
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    expected = brute.components(texts, 85)
    assert 20 < len(set(expected)) < 200
    found = minhash.near_duplicates(docs, 85).orderBy("doc_id").collect()
    assert [r["component_id"] for r in found] == expected


def test_keep_one_nulls_repeats_and_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text, 1, "a"), (4, text, 2, "b"), (4, text, 2, "b"), (9, text + " x", 3, "c")]
    rows += [(5, None, 4, "d"), (5, "", 5, "e"), (None, "other words", 6, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, class int, bucket string")
    kept = minhash.keep_one(docs, 85)
    assert kept.columns == docs.columns
    assert sorted(r["class"] for r in kept.collect()) == [2, 2, 4, 5, 6]
    assert minhash.keep_one(docs.limit(0), 85).count() == 0
    marked = minhash.near_duplicates(docs, 85).where("n_shingles > 20").collect()
    assert {r["component_id"] for r in marked} == {4}


def test_estimate_follows_similarity(spark):
    words = [f"w{i}" for i in range(1200)]
    texts = [" ".join(words[i * 50 : i * 50 + 600]) for i in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    signed = minhash.signatures(docs).select("doc_id", "signature")
    pairs = signed.alias("a").join(signed.withColumnsRenamed({"doc_id": "o", "signature": "t"}), F.expr("doc_id < o"))
    for r in pairs.withColumn("e", minhash.estimate("signature", "t")).collect():
        a, b = brute.shingles(texts[r["doc_id"]]), brute.shingles(texts[r["o"]])
        assert abs(r["e"] - len(a & b) / len(a | b)) < 0.17


def test_components_of_a_path_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    roots = {r["node"]: r["root"] for r in found}
    assert roots == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one_without_repeats_keeps_one_row_of_each_group(spark):
    texts = [" ".join(f"{name}{i}" for i in range(30)) for name in "wvu"]
    rows = [(4, texts[0], 1)] * 3 + [(4, texts[0] + " x", 2), (9, texts[0] + " y", 3)]
    rows += [(None, texts[1], 4)] * 5 + [(None, texts[1] + " x", 4), (None, texts[2], 5), (None, "", 6), (7, None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, class int").repartition(3)
    for _ in range(2):
        kept = minhash.keep_one(docs, 85, repeats=False)
        assert kept.columns == docs.columns
        found = sorted(r["class"] for r in kept.collect())
        assert found in ([1, 4, 5, 6, 7], [2, 4, 5, 6, 7])
    assert sorted(r["class"] for r in minhash.keep_one(docs.where("class > 4"), 85, repeats=False).collect()) == [5, 6, 7]


def test_a_class_is_one_row_until_its_buckets_are_opened(spark):
    """Ten classes in three buckets each are ten rows for a turn's labels, not thirty."""
    rows = [(c, b, b, 0.5, 10, c % 5, 20, [c], 20, [b]) for c in range(10) for b in range(3)]
    names = "cid long, bucket long, band int, lot double, m long, comp long, n long, signature array<long>, shared long, marks array<int>"
    rest = minhash.by_class(spark.createDataFrame(rows, names).repartition(4), "comp", "n", "signature", "shared", "marks")
    held = {r.cid: r for r in rest.collect()}
    assert sorted(held) == list(range(10)) and all(r.comp == c % 5 for c, r in held.items())
    assert all(sorted((p.bucket, p.band) for p in r["at"]) == [(0, 0), (1, 1), (2, 2)] for r in held.values())
    live = minhash.opened(rest, 1, 85).collect()
    assert sorted((r.cid, r.bucket) for r in live) == [(c, b) for c in range(10) for b in range(3)]
