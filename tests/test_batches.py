"""K-means batches: starts by oversampling, bounds for the nearest centre."""

import io
from contextlib import redirect_stdout

import numpy as np
import pytest
from pyspark.sql import functions as F

from gitloom.operators import batches as bt
from gitloom.operators import nearest, seeding
from gitloom.operators.nearest import assign, in_cells, reached, _opened
from gitloom.operators.neighbours import build_space

CLUSTERS = 25


def planted(n, dim=6, seed=3):
    rng = np.random.RandomState(seed)
    middles = rng.randn(CLUSTERS, dim) * 100
    return middles, [(i, (middles[i % CLUSTERS] + rng.randn(dim)).tolist()) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, embedding array<double>")


def unpacked(near, space, seed):
    """Point number to (centre, bound above, bound below) of one seed."""
    out = {}
    ids = {r.blk: r.ids for r in space.blocks.select("blk", "ids").collect()}
    for r in near.where(F.col("seed") == seed).collect():
        parts = np.frombuffer(r.c, "<i8"), np.frombuffer(r.near, "<f8"), np.frombuffer(r.next, "<f8")
        out |= {i: p for i, *p in zip(ids[r.blk], *parts)}
    return out


def vectors_of(space):
    out = {}
    for r in space.blocks.collect():
        out |= dict(zip(r.ids, np.array(r.flat).reshape(len(r.ids), -1)))
    return out


@pytest.mark.parametrize("block_rows", [64, 1024])
def test_starts_alone_find_every_planted_cluster(spark, block_rows):
    """In one cell and over several ones."""
    middles, rows = planted(500)
    space = build_space(frame(spark, rows), "id", "embedding", block_rows=block_rows)
    assert (len(space.pivots) > 1) == (block_rows == 64)
    got = seeding.starts(space, CLUSTERS, [42, 43, 44]).toPandas()
    assert got.seed.nunique() == 3
    found = []
    for _, mine in got.groupby("seed"):
        assert sorted(mine.c) == list(range(1, CLUSTERS + 1))
        x = np.stack(mine.vec.to_numpy())
        found.append(len(set(((x[:, None] - middles[None]) ** 2).sum(2).argmin(1))))
    assert found == [CLUSTERS] * 3


def test_nearest_centres_equal_brute_force_over_moves(spark):
    _, rows = planted(2500)
    space = build_space(frame(spark, rows), "id", "embedding", block_rows=32)
    x = vectors_of(space)
    rng = np.random.RandomState(0)
    centres = {c: x[i] + rng.randn(6) for c, i in enumerate(rng.choice(sorted(x), 60, False), 1)}
    near, moved = None, {}
    for size in (0.0, 0.3, 30.0, 1e-9):
        steps = {c: rng.randn(6) * size for c in centres}
        centres = {c: v + steps[c] for c, v in centres.items()}
        if near is not None:
            moved = {7: max(np.linalg.norm(s) for s in steps.values())}
        table = spark.createDataFrame(
            [(7, c, v.tolist()) for c, v in centres.items()], "seed long, c long, vec array<double>"
        )
        placed = in_cells(table, space)
        at = reached(placed, space)
        before = near
        near = assign(space, placed, at, near, moved)
        got = unpacked(near, space, 7)
        names, y = np.array(list(centres)), np.stack(list(centres.values()))
        for i, v in x.items():
            d = np.linalg.norm(y - v, axis=1)
            c, above, below = got[i]
            assert c == names[d.argmin()]
            assert above >= d.min() - 1e-6 and below <= np.partition(d, 1)[1] + 1e-6
    # Hardly moved: most blocks open no cell; from nothing, far from all are opened.
    blocks = space.n_blocks
    visits = _opened(space, before, at, moved, False).where("cell >= 0")
    assert visits.select("blk").distinct().count() < 0.5 * blocks
    fresh = _opened(space, None, at, {}, False).where("cell >= 0").count()
    assert fresh < 0.5 * blocks * len(space.pivots)


@pytest.mark.parametrize("block_rows", [64, 1024])
def test_batches_are_settled_and_cost_little(spark, block_rows):
    """Every vector is in the batch of the nearest mean, at the cost of the planted groups."""
    _, rows = planted(500)
    got = bt.kmeans_batches(frame(spark, rows), 20, block_rows=block_rows).toPandas().set_index("id").batch
    x = np.array([v for _, v in rows])
    labels = got.loc[range(500)].to_numpy()
    assert sorted(set(labels)) == list(range(CLUSTERS))
    means = np.stack([x[labels == b].mean(0) for b in range(CLUSTERS)])
    d = ((x[:, None] - means[None]) ** 2).sum(2)
    assert (d.argmin(1) == labels).all()
    group = np.arange(500) % CLUSTERS
    truth = sum(((x[group == g] - x[group == g].mean(0)) ** 2).sum() for g in range(CLUSTERS))
    assert d.min(1).sum() <= 1.05 * truth


def test_a_centre_without_points_has_no_row(spark):
    df = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(10)], "id long, embedding array<double>")
    space = build_space(df, "id", "embedding", listed=False)
    rows = [(42, 1, [1.0, 0.0]), (42, 2, [8.0, 0.0]), (42, 3, [500.0, 0.0])]
    centres = in_cells(spark.createDataFrame(rows, "seed long, c long, vec array<double>"), space).localCheckpoint()
    near = assign(space, centres, reached(centres, space))
    moved = {r.c: (r.vec, r.cost, r.shift) for r in bt._moved(space, near, centres).collect()}
    assert moved == {1: ([2.0, 0.0], 10.0, 1.0), 2: ([7.0, 0.0], 10.0, 1.0)}


def test_no_join_without_keys(spark):
    _, rows = planted(200)
    space = build_space(frame(spark, rows), "id", "embedding", block_rows=32)
    placed = in_cells(seeding._first(space, [1, 2]).select("seed", "c", "vec"), space)
    from gitloom.operators.nearest import _visited

    opened = _opened(space, None, reached(placed, space), {}, False)
    text = io.StringIO()
    with redirect_stdout(text):
        _visited(space, opened, placed).explain("formatted")
    assert "CartesianProduct" not in text.getvalue() and "NestedLoop" not in text.getvalue()


def test_copies_weigh_and_empty_input(spark):
    rows = [(i, [0.0, float(i % 3)]) for i in range(90)] + [(100, [50.0, 0.0])]
    got = bt.kmeans_batches(frame(spark, rows), 45, restarts=2).toPandas().set_index("id").batch
    assert len(got) == 91 and got.nunique() == 3
    assert (got.loc[range(90)] != got.loc[100]).any()
    assert bt.kmeans_batches(frame(spark, rows).limit(0)).isEmpty()


def test_blocks_meet_centres_in_tiles(spark, monkeypatch):
    """One result of a tile for a block, not one for each cell it opens; any grid gives the same."""
    rng = np.random.RandomState(9)
    x = rng.randn(700, 5)  # without structure: most cells stay open
    df = frame(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    space = build_space(df, "id", "embedding", block_rows=32, listed=False)
    rows = [(s, c, (x[i] + 0.1).tolist()) for s in (1, 2) for c, i in enumerate(rng.choice(700, 40, False), 1)]
    centres = in_cells(spark.createDataFrame(rows, "seed long, c long, vec array<double>"), space).localCheckpoint()
    at, got = reached(centres, space), []
    for grid in ((1, 1), (3, 2)):
        monkeypatch.setattr(nearest, "_grid", lambda space, grid=grid: grid)
        opened = _opened(space, None, at, {}, False)
        assert opened.where("cell >= 0").groupBy("blk", "seed").count().agg(F.max("count")).first()[0] > 3
        met = nearest._visited(space, opened, centres).select(F.max(F.size("met"))).first()[0]
        assert met == 1 + grid[1]
        near = assign(space, centres, at)
        got.append({s: unpacked(near, space, s) for s in (1, 2)})
    assert got[0] == got[1]
    vectors = vectors_of(space)
    for s in (1, 2):
        y = {c: np.array(v) for t, c, v in rows if t == s}
        for i, v in vectors.items():
            d = np.sort([np.linalg.norm(v - w) for w in y.values()])
            c, near, other = got[0][s][i]
            assert np.linalg.norm(v - y[c]) <= d[0] + 1e-9
            assert abs(near - d[0]) < 1e-6 and other <= d[1] + 1e-6
