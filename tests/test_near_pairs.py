"""Similar pairs, names merged without a model, and sparse terms, next to plain Python."""

import random
import time
from pathlib import Path

import numpy as np
import pytest

from gitloom.operators import categories as ct
from gitloom.operators import disagreement as ds
from gitloom.operators import near_pairs
from gitloom.operators.near_pairs import pairs_without_common, similar_pairs
from gitloom.session import cut


def _sets():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    out = {i: rng.sample(words, rng.randint(1, 25)) for i in range(90)}
    for i in range(90, 140):  # near copies of earlier sets
        base = list(out[rng.randrange(90)])
        base[rng.randrange(len(base))] = rng.choice(words)
        out[i] = base + ["hot"]
    return out | {200: ["hot"], 201: ["hot"], 202: [], 203: None, 204: ["hot", None, "hot"], 205: list(reversed(out[3]))}


def _classes(sets):
    held = {}
    for i, items in sets.items():
        found = frozenset(x for x in items or () if x is not None)
        if found:
            held.setdefault(found, []).append(i)
    return {min(ids): (found, len(ids)) for found, ids in held.items()}


@pytest.mark.parametrize(("measure", "percent"), [("cosine", 50), ("cosine", 85), ("jaccard", 30), ("jaccard", 70), ("jaccard", 100)])
def test_similar_pairs_equal_all_pairs(spark, measure, percent):
    sets = _sets()
    df = spark.createDataFrame(list(sets.items()), "id long, items array<string>").repartition(5)
    classes = _classes(sets)
    wanted = set()
    for a, (x, c) in classes.items():
        for b, (y, d) in classes.items():
            both, union = len(x & y), len(x | y)
            if measure == "cosine":
                fits = both * both * 10_000 >= len(x) * len(y) * percent * percent
            else:
                fits = both * 100 >= union * percent
            if a < b and fits:
                wanted.add((a, b, both, len(x), len(y), c, d))
    found = similar_pairs(df, percent, measure=measure).collect()
    assert {tuple(r) for r in found} == wanted and len(found) == len(wanted)
    assert similar_pairs(df.limit(0), percent, measure=measure).count() == 0


def test_unlike_pairs_are_counted(spark):
    sets = _sets()
    df = spark.createDataFrame(list(sets.items()), "id long, items array<string>")
    held = [x for x, _ in _classes(sets).values()]
    common = sum(bool(x & y) for i, x in enumerate(held) for y in held[:i])
    assert tuple(pairs_without_common(df).first()) == (len(held), len(held) * (len(held) - 1) // 2, common)
    assert tuple(pairs_without_common(df.limit(0)).first()) == (0, 0, 0)


def test_common_pairs_are_counted_by_blocks(spark):
    """Blocks of any size give the same number, and no plan lists the pairs."""
    sets = _sets()
    df = spark.createDataFrame(list(sets.items()), "id long, items array<string>")
    wanted = tuple(pairs_without_common(df).first())
    for entries in (1, 40, 300):
        assert tuple(pairs_without_common(df, block_entries=entries).first()) == wanted
    rng = np.random.RandomState(4)
    held = [[np.unique(rng.randint(0, 900, rng.randint(1, 30))) for _ in range(n)] for n in (300, 500)]
    blocks = [(np.cumsum([len(x) for x in xs]), np.concatenate(xs)) for xs in held]
    common = sum(bool(np.intersect1d(x, y).size) for x in held[0] for y in held[1])
    for cells, share in ((1 << 22, 128), (1 << 22, 2), (700, 5)):
        near_pairs.CELLS, near_pairs.HOT_SHARE, kept = cells, share, (near_pairs.CELLS, near_pairs.HOT_SHARE)
        try:
            assert near_pairs.count_common(*blocks[0], *blocks[1]) == common
        finally:
            near_pairs.CELLS, near_pairs.HOT_SHARE = kept


def test_pairs_that_cannot_be_similar_are_not_compared(spark):
    """Sets that share an element but have too little left after it do not meet."""
    rows = [(i, [*[f"x{i}_{j}" for j in range(6)], "tie", "b", "c"]) for i in range(40)]
    rows += [(100 + i, [*items[:8], f"z{i}"]) for i, items in rows[:5]]
    coded = near_pairs.coded_classes(near_pairs.set_classes(spark.createDataFrame(rows, "id long, items array<string>"), "id", "items"))
    met = near_pairs.meeting_pairs(coded, 50, "cosine").collect()
    assert {(r.a, r.b) for r in met} == {(i, 100 + i) for i in range(5)}


def test_names_that_are_nearly_the_same_become_one(spark):
    names = ["Bug Fixes", "bug  fixes", "Bug Fix", "Bug fixing", "Documentation", "Documentations", "Refactoring", "ab", "AB", "ba", "é"]
    names += ["chain of many parts 1", "chain of many parts 2", "chain of more parts 2", "chain of more ports 2"]
    rows = [(i, n) for i, n in enumerate(names)]
    kept = {r.category for r in ct.merge_similar(spark.createDataFrame(rows, "n int, category string")).collect()}

    def grams(name):
        name = " ".join(name.lower().split())
        return {name[i : i + 3] for i in range(max(1, len(name) - 2))}

    group = list(range(len(names)))
    for _ in names:  # the smallest neighbour's group, until nothing changes
        for i, a in enumerate(names):
            near = [j for j, b in enumerate(names) if 100 * len(grams(a) & grams(b)) >= 60 * len(grams(a) | grams(b))]
            group[i] = min(group[j] for j in near)
    assert kept == {names[i] for i in set(group)}
    assert {"Bug Fixes", "Documentation", "ab"} <= kept and not {"bug  fixes", "Documentations", "AB"} & kept
    assert ct.merge_similar(spark.createDataFrame([], "n int, category string")).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 130)]
    found = ct.smallest_of_component(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == {i: 0 for i in range(1, 51)} | {i: 100 for i in range(101, 130)}


def test_sparse_terms_equal_the_sets(spark):
    texts = [(1, "the cat sat on the cat"), (2, "on the mat"), (3, ""), (4, None), (5, "one"), (2, "on the mat again")]
    df = spark.createDataFrame(texts, "id int, text string")
    vectors, words = ds.sparse_terms(df, "id", "text")
    listed = {r.bigram: r.term for r in words.collect()}
    assert listed == {b: i for i, b in enumerate(sorted(listed))}
    got = {r.id: r.terms for r in vectors.collect()}
    expected = {1: ["the cat", "cat sat", "sat on", "on the"], 2: ["on the", "the mat", "mat again"], 3: [], 4: [], 5: []}
    assert got == {i: sorted(listed[b] for b in found) for i, found in expected.items()}


def test_places_go_on_over_ranges(spark):
    """Bigrams meet their places where they are sorted, not in a join; one may fill several ranges."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    texts = [(i, "the same") for i in range(300)] + [(i, f"a{i} the same z{i % 7}") for i in range(300, 340)]
    texts += [(None, "the same"), (None, "b c dd ee"), (340, None), (301, "the same")]
    df = spark.createDataFrame(texts, "id int, text string").repartition(4)
    spark.conf.set(name, "false")
    try:
        vectors, words = ds.sparse_terms(df, "id", "text")
        listed = {r.bigram: r.term for r in words.collect()}
        got = {r.id: r.terms for r in vectors.collect()}
    finally:
        spark.conf.unset(name)
    sets = {i: set() for i, _ in texts}
    for i, text in texts:
        found = [w for w in (text or "").split() if len(w) > 1]
        sets[i] |= {f"{a} {b}" for a, b in zip(found, found[1:])}
    assert listed == {b: n for n, b in enumerate(sorted(set().union(*sets.values())))} and words.count() == len(listed)
    assert got == {i: sorted(listed[b] for b in found) for i, found in sets.items()} and vectors.count() == len(sets)
    plan = vectors._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Join" in line and "bigram" in line for line in plan.splitlines())
    nothing, none = ds.sparse_terms(df.where("id = 340"), "id", "text")
    assert none.count() == 0 and [r.terms for r in nothing.collect()] == [[]]


def test_run_pairs_meet_as_texts(spark):
    """One row a commit: no join of bigram sets, and the text is carried once where it is the order."""
    rows = [("c1", "a", "x y z"), ("c1", "a", "w w w"), ("c1", "b", "aa bb cc"), ("c1", "c", "bb cc dd"), ("c2", "a", "aa bb"), ("c2", "b", None)]
    rows += [(None, "a", "aa bb"), (None, "b", "aa bb"), ("c3", None, "aa bb"), ("c3", "a", "aa bb"), ("c4", "b", "aa bb"), ("c4", "a", "aa bb")]
    runs = spark.createDataFrame(rows, "commit_hash string, source_file string, semantic_summary string")
    pairs = ds.run_pairs(runs, ["semantic_summary"])
    got = {(r.commit_hash, r.source_1, r.source_2): r.distance for r in pairs.collect()}
    assert got == {("c1", "a", "b"): None, ("c1", "a", "c"): None, ("c1", "b", "c"): 0.5, ("c2", "a", "b"): None, ("c4", "a", "b"): 0.0}
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "min_by" not in plan


def test_pairs_meet_their_sets_in_turns(spark, monkeypatch):
    """What is sent along with the pairs is bounded; turns and parts give the same rows."""
    df = spark.createDataFrame(list(_sets().items()), "id long, items array<string>").repartition(3)
    wanted = {tuple(r) for r in similar_pairs(df, 50).collect()}
    compared, turns = near_pairs._compared, []
    monkeypatch.setattr(near_pairs, "_compared", lambda met, *rest: turns.append(met.count()) or compared(met, *rest))
    monkeypatch.setattr(near_pairs, "SENT_ENTRIES", 1200)
    monkeypatch.setattr(near_pairs, "SENT_TIMES", 0)
    monkeypatch.setattr(near_pairs, "PASSES", 2)
    found = [tuple(r) for r in similar_pairs(df, 50).collect()]
    assert set(found) == wanted and len(found) == len(wanted)
    assert len(turns) > 1 and max(turns) < sum(turns)


def test_shuffle_files_go_with_their_query(spark):
    """What a stored table was shuffled by is not on disk while the next one is made."""
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()

    def files():
        return {f for d in folders for f in Path(d.getPath()).glob("*/shuffle_*.data")}

    before = files()
    stored = cut(spark.range(1000).groupBy("id").count())
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert stored.count() == 1000


def test_copies_and_rows_without_id_are_classes(spark):
    rows = [(1, ["x", "y"]), (2, ["y", "x"]), (None, ["y", "x"]), (None, ["x", "z"]), (5, ["p", "q"]), (5, ["q", "p"])]
    df = spark.createDataFrame(rows, "id long, items array<string>")
    assert tuple(pairs_without_common(df).first()) == (3, 3, 1)
    assert {tuple(r) for r in similar_pairs(df, 50).collect()} == set()
    more = df.unionByName(spark.createDataFrame([(7, ["x", "z", None])], df.schema))
    assert {tuple(r) for r in similar_pairs(more, 50).collect()} == {(1, 7, 1, 2, 2, 3, 2)}


def test_large_blocks_are_looked_up_in_parts(spark, monkeypatch):
    """A task holds two blocks, and of the rest only what two parts of them need."""
    rng = np.random.RandomState(6)
    sets = [np.unique(rng.randint(0, 2000, rng.randint(1, 60))) for _ in range(700)]
    block = np.cumsum([len(x) for x in sets]), np.concatenate(sets)
    common = sum(bool(np.intersect1d(x, y).size) for x in sets for y in sets)
    lookup, seen = near_pairs._lookup, []
    monkeypatch.setattr(near_pairs, "_lookup", lambda ends, codes: seen.append(len(codes)) or lookup(ends, codes))
    monkeypatch.setattr(near_pairs, "PART_ENTRIES", 500)
    assert near_pairs.count_common(*block, *block) == common
    assert max(seen) <= 500 and sum(seen) == len(block[1])
    # Small inputs use the cores, large ones keep to the size of a block.
    assert near_pairs.block_count(100, 12, 1 << 24) == 1
    assert near_pairs.block_count(10 << 20, 12, 1 << 24) == 7
    assert near_pairs.block_count(1 << 30, 12, 1 << 24) == 64
