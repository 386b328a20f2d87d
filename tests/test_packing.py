"""Ordering helpers and greedy packing; the distributed path equals the array path."""

import random

import pytest
from pyspark.sql import functions as F

from gitloom.operators.ordering import keep_first, ordered_prefix, preceding_marked
from gitloom.operators.packing import pack_lines


def greedy(lines, limit):
    if len("\n".join(lines)) <= limit:
        return ["\n".join(lines)]
    chunks, current, used = [], [], 0
    for line in lines:
        if current and used + len(line) + 1 > limit:
            chunks.append("\n".join(current))
            current, used = [], 0
        current.append(line)
        used += len(line) + 1
    return chunks + ["\n".join(current)]


def lines_for(seed, groups=6, most=60):
    rng = random.Random(seed)
    return {g: ["x" * rng.choice([0, 1, 5, 20, 30, 90]) + str(i) for i in range(rng.randint(1, most))] for g in range(groups)}


def packed(spark, data, limit, **options):
    rows = [(g, i, line) for g, lines in data.items() for i, line in enumerate(lines)]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "g int, i int, line string").repartition(3)
    out = {}
    for r in pack_lines(df, ["g"], "i", "line", limit, **options).orderBy("g", "chunk_no").collect():
        assert r.n_lines == r.text.count("\n") + 1
        out.setdefault(r.g, []).append(r.text)
    return out


def test_array_path(spark):
    data = lines_for(1)
    assert packed(spark, data, 60) == {g: greedy(lines, 60) for g, lines in data.items()}


def test_distributed_path_gives_the_same_chunks(spark):
    data = lines_for(2)
    data[99] = ["short", "y" * 3000, "z" * 3000, "end"]  # lines over the limit
    data[98] = ["fits"]
    expected = {g: greedy(lines, 60) for g, lines in data.items()}
    assert packed(spark, data, 60, hot_lines=0) == expected
    # only the long keys are hot
    assert packed(spark, data, 60, hot_lines=30) == expected


@pytest.mark.parametrize("key", ["k", "i", "q", "running"])
def test_tied_ordinals_and_any_key_name_give_one_result(spark, key):
    """Lines with one ordinal go by their text, on either path and whatever the key is called."""
    lines = ["bb" * 9, "a" * 25, "c" * 3, "bb" * 9, "d" * 30, "", "zz", "y" * 12]
    rows = [(7, n // 4, line) for n, line in enumerate(lines)] + [(8, 0, "x")]
    df = spark.createDataFrame(rows, f"{key} int, o int, line string").repartition(3)
    ordered = sorted(lines[:4]) + sorted(lines[4:])
    for options in ({"hot_lines": 0}, {}):
        got = pack_lines(df, [key], "o", "line", 40, **options).where(f"{key} = 7").orderBy("chunk_no").collect()
        assert [r.text for r in got] == greedy(ordered, 40)


def test_null_lines_count_as_empty_on_both_paths(spark):
    rows = [(1, i, x) for i, x in enumerate(["aaaa", None, "bbbb", "cccc", "dddd", None])]
    df = spark.createDataFrame(rows, "g int, i int, line string")
    expected = greedy(["aaaa", "", "bbbb", "cccc", "dddd", ""], 10)
    for options in ({}, {"hot_lines": 0}):
        got = pack_lines(df, ["g"], "i", "line", 10, **options).orderBy("chunk_no").collect()
        assert [r.text for r in got] == expected


def test_null_keys_keep_their_rows(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (3, 1, "c")], "k int, o int, v string")
    got = {(r.k, r.o): r.rn for r in ordered_prefix(df, ["k"], ["o"]).collect()}
    assert got == {(None, 1): 1, (None, 2): 2, (3, 1): 1}
    marked = preceding_marked(df, ["k"], ["o"], F.col("o") == 1, F.col("v"), "before").collect()
    assert {(r.k, r.o): r.before for r in marked} == {(None, 1): None, (None, 2): "a", (3, 1): None}


def test_exact_fit_is_one_chunk(spark):
    assert packed(spark, {1: ["ab", "cd"]}, 5) == {1: ["ab\ncd"]}
    assert packed(spark, {1: ["ab", "cd"]}, 5, hot_lines=0) == {1: ["ab\ncd"]}


def test_prefix_over_a_hot_key(spark):
    rows = [(0, i, i % 5) for i in range(3000)] + [(k, 1, k) for k in range(1, 40)]
    df = spark.createDataFrame(rows, "k int, o int, v int").repartition(5)
    got = ordered_prefix(df, ["k"], ["o"], F.col("v")).where("k = 0").orderBy("o").collect()
    total = 0
    for i, r in enumerate(got):
        total += i % 5
        assert (r.rn, r.running) == (i + 1, total)


def test_preceding_marked_crosses_partitions(spark):
    rows = [(0, i) for i in range(2000)] + [(1, 5), (1, 6)]
    df = spark.createDataFrame(rows, "k int, o int").repartition(5)
    mark = F.col("o") % 700 == 3
    got = {(r.k, r.o): r.p for r in preceding_marked(df, ["k"], ["o"], mark, F.col("o"), "p").collect()}
    for k, o in rows:
        earlier = [x for x in range(o) if x % 700 == 3] if k == 0 else []
        assert got[(k, o)] == (earlier[-1] if earlier else None)


def test_keep_first_takes_the_whole_row(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, None), ("b", 3, "x")], "k string, o int, v string")
    assert sorted((r.k, r.o, r.v) for r in keep_first(df, ["k"], ["o"]).collect()) == [("a", 1, None), ("b", 3, "x")]
