"""The pipeline next to brute force, the stages' contract, and the driver's entry."""

import os
import random
import re

import public_tokenizers
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import compare
from gitloom.llm import bpe, quality_rules, queries
from tests.llm import brute

SF = "/root/testdata/sf0.001"
STOP = {w for line in quality_rules.STOP_WORDS for w in line.split()}


def _kept_by_rules(text):
    m = brute.quality(text)
    m["n_stop_words"] = sum(w.lower() in STOP for w in re.findall("[^\x20\x09-\x0d]+", text or ""))
    if m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"]:
        return False
    for r in quality_rules.RULES:
        share, of = m[r.share] * r.scale, m[r.of]
        if m["n_words"] >= r.from_words and (
            (r.low is not None and share < of * r.low) or (r.high is not None and share > of * r.high)
        ):
            return False
    return True


def _brute(rows, items):
    rows = [r for r in rows if _kept_by_rules(r[1])]
    cut = brute.drop_lines_by_groups([t for _, t in rows], 10, corpus_pipeline.NEAR_PERCENT)
    rows = [(i, t) for (i, _), (t, _, gone) in zip(rows, cut, strict=True) if not gone or t.strip(brute.SPACES)]
    roots = brute.components([t for _, t in rows], corpus_pipeline.NEAR_PERCENT)
    smallest = {}
    for (i, _), root in zip(rows, roots, strict=True):
        smallest[root] = min(i, smallest.get(root, i))
    rows = [r for r, root in zip(rows, roots, strict=True) if r[0] == smallest[root]]
    return [r for r in rows if not brute.contamination(r[1], items)[1]]


def _groups():
    """Texts of which groups of near copies, and of unlike ones, share lines."""
    rng = random.Random(21)
    vocabulary = [f"{a}{b}" for a in "the of and sun moon tree river stone".split() for b in ("", "s", "ly", "ing", "er")]

    def prose(n):
        return [f"{rng.choice(vocabulary)} the {rng.choice(vocabulary)}{i}" for i in range(n)]

    def lines(parts):
        return "\n".join(" ".join(parts[i : i + 8]) for i in range(0, len(parts), 8))

    shared = lines(prose(8))
    out = []
    for size in (4, 11, 14):
        base = prose(80)
        out += [lines([*base[:72], *prose(1), *base[73:]]) for _ in range(size)]
    out += [lines(prose(40)) + "\n" + shared for _ in range(12)]
    out += [lines(prose(40)) + "\n" + shared.upper() for _ in range(3)] + [out[0]] * 12
    return out


def test_pipeline_equals_brute_force(spark, tmp_path):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [(r[0], r[1]) for r in given.select("doc_id", "text").collect()]
    more = [(100_000 + i, t) for i, t in enumerate(_groups())]
    added = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in more], given.schema)
    given.unionByName(added).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = _brute(docs + more, items)
    assert 20 < len(kept) < len(docs)
    ours = {i: t for i, t in kept if i >= 100_000}
    assert len(ours) == 18 and all(t.count("\n") in (4, 9) for t in ours.values())
    # Counting documents, or distinct texts, gives something else.
    assert brute.drop_lines([t for _, t in more], 10, 1) != brute.drop_lines_by_groups([t for _, t in more], 10, 80)
    encoding = bpe.load_encoding(public_tokenizers.path(corpus_pipeline.RANK_FILE), public_tokenizers.PATTERN)
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: list(r["token_ids"]) for r in found} == {i: encoding.encode_ordinary(t) for i, t in kept}
    assert all(r["round_trip"] for r in found)


def test_no_more_jobs_than_needed(spark):
    """The driver's memory follows the number of plans: a bound on a small input."""
    jobs = lambda: spark._jsc.sc().dagScheduler().nextJobId()
    before = jobs()
    corpus_pipeline.run(spark, SF).collect()
    assert jobs() - before <= 120


def test_stages_keep_the_columns_and_take_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0)] * 2, docs.schema)
    wide = docs.unionByName(odd).withColumns({"kept": F.lit("c"), "n_hit": F.lit(1), "shingles": F.lit(2)})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, SF)
        assert out.columns == wide.columns and [f.dataType for f in out.schema] == [f.dataType for f in wide.schema], name
        assert 0 < out.count() <= wide.count()
        assert stage(spark, wide.limit(0), SF).count() == 0
    assert corpus_pipeline.token_stage(spark, wide, SF).count() == wide.count()


def test_queries_equal_their_sql(spark):
    known, sql = entry.queries(), entry.oracle_sql()
    assert set(queries.QUERIES) <= set(known) and "pipeline" in known
    for name in queries.SQL:
        assert compare(spark, SF, name, known[name], sql[name]).startswith("OK"), name


def test_nothing_else_imports_the_subpackage():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for folder in ("gitloom", "checks", "tests"):
        for at, _, names in os.walk(os.path.join(root, folder)):
            if "llm" not in at.split(os.sep):
                for name in (n for n in names if n.endswith(".py")):
                    with open(os.path.join(at, name)) as f:
                        assert "gitloom.llm" not in f.read(), name


def test_line_stage_leaves_a_text_of_each_group_of_copies(spark):
    def prose(name, n=60):
        return [f"{name}{i}" for i in range(n)]

    def lines(words):
        return "\n".join(" ".join(words[i : i + 20]) for i in range(0, len(words), 20))

    exact, near, junk = prose("e"), prose("n", 120), "read more here\nall rights reserved"
    texts = [lines(exact)] * 25
    texts += [lines(near).replace("\n", "\n" + " " * i) for i in range(12)]  # emptied by near copies alone
    texts += [lines([*near[:119], f"own{i}"]) for i in range(12)]  # each keeps a line of its own
    texts += [lines(prose(f"p{i}x")) + "\n" + junk for i in range(15)] + [junk]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    docs = spark.createDataFrame(rows, schema).repartition(5)
    out = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_stage(spark, docs, SF).collect()}
    # Lines of 15 different texts go and so does the text of nothing else; groups stay whole.
    assert out == {i: t.removesuffix("\n" + junk) for i, t in enumerate(texts) if t != junk}
    left = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame([(i, t, "en", "s", 0) for i, t in out.items()], schema), SF)
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 25, *range(49, 64)]
