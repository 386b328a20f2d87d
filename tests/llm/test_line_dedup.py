import random

import numpy as np

from gitloom.llm import line_dedup
from tests.llm import brute


def _texts():
    rng = random.Random(4)
    pool = [f"line {i} é" for i in range(60)]
    texts = ["\n".join(rng.choices(pool, k=rng.randint(1, 9))) for _ in range(120)]
    texts += ["Common Line\nown %d\n  COMMON line\t" % i for i in range(40)]
    texts += ["copy of a text\nwith two lines"] * 25
    texts += [None, "", "\n\n", " \t\n\x0b", "x" * 5000 + "\n" + "common line\n" * 4000]
    return texts


def _run(docs, **how):
    found = line_dedup.drop_frequent_lines(docs, **how).orderBy("doc_id").collect()
    return [(r["text"], r["n_lines"], r["n_dropped"]) for r in found]


def test_equals_brute_force(spark, monkeypatch):
    texts = _texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    for min_docs, min_chars in ((10, 1), (3, 8), (1, 1)):
        expected = brute.drop_lines(texts, min_docs, min_chars)
        assert _run(docs, min_docs=min_docs, min_chars=min_chars) == expected
    # Many shards, and hot shards dealt to several tasks, change nothing.
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 16)
    monkeypatch.setattr(line_dedup, "TASK_PROBES", 8)
    assert _run(docs, min_docs=10) == brute.drop_lines(texts, 10, 1)


def test_repeated_rows_clashing_columns_and_empty_table(spark):
    rows = [(1, "a\nb", "x", 5)] * 12 + [(None, "b", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, N_LINES string, h1 int")
    found = line_dedup.drop_frequent_lines(docs).collect()
    assert {(r["doc_id"], r["text"], r["n_dropped"], r["h1"]) for r in found} == {
        (1, "", 2, 5),
        (None, "", 1, None),
    }
    assert line_dedup.drop_frequent_lines(docs.limit(0)).count() == 0


def test_perfect_hash_numbers_keys_without_gaps():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        h = rng.integers(0, 1 << 63, (2, n), np.uint64)
        levels = line_dedup.unpack_levels(line_dedup.pack_levels(line_dedup.build_levels(*h)))
        numbers = line_dedup.rank(levels, *h)
        assert sorted(numbers) == list(range(n))
        assert sum(map(len, levels)) * 64 <= 4 * n + 64 * 24


def test_copies_of_a_text_are_one_probe_of_a_key(spark):
    rows = [(i, "hot\nline\nhot") for i in range(300)] + [(i, f"hot\nown {i}") for i in range(300, 320)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    lines = line_dedup.document_lines(docs, 1)
    assert lines.count() == 2 + 20 * 2
    index = line_dedup.build_index(lines, 1).collect()[0]
    assert (index["n_keys"], index["n_probes"]) == (22, 42)
    assert sorted(np.frombuffer(index["counts"], np.uint32))[-2:] == [300, 320]
    hits = line_dedup.probe(lines, line_dedup.build_index(lines, 1), 1, 10).collect()
    assert len(hits) == 22 and {r["n"] for r in hits} == {300, 320}
