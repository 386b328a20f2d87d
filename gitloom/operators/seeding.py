"""Starts of k-means by oversampling (k-means||), for several restarts at once.

Each round draws points with a probability that grows with their squared distance to the
candidates so far, twice as many as there are centres on average. The candidates, weighted
by the points nearest to them, are then picked by weighted k-means++ within groups of
neighbouring candidates of bounded size, and the picks that save most, over all groups,
are the centres.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gitloom.operators.nearest import assign, in_cells, reached, unpack, values
from gitloom.operators.neighbours import Space, squared
from gitloom.operators.ordering import ordered_prefix
from gitloom.session import cut

ROUNDS = 2
OVERSAMPLING = 2
#: Candidates of one group.
GROUP_ROWS = 2048

CANDIDATE = "seed long, c long, vec array<double>, mult long"


def lots(ids: np.ndarray, seed: int, turn: int) -> np.ndarray:
    """Numbers in (0, 1), a function of id, seed and turn alone (the splitmix64 finish)."""
    with np.errstate(over="ignore"):
        z = np.asarray(ids).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z += np.uint64((seed * 1_000_003 + turn) & 0xFFFFFFFF) * np.uint64(0xD1B54A32D192ED03)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
        z ^= z >> np.uint64(31)
    return ((z >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def _first(space: Space, seeds: list[int]) -> DataFrame:
    """One point for each seed, drawn in proportion to its multiplicity."""
    dim = space.dim

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {name: [] for name in ("seed", "c", "vec", "mult", "lot")}
            for i in range(batch.num_rows):
                ids, mult = values(batch.column("ids"), i), values(batch.column("mult"), i)
                x = values(batch.column("flat"), i).reshape(-1, dim)
                for seed in seeds:
                    lot = -np.log(lots(ids, seed, 0)) / mult
                    at = lot.argmin()
                    drawn = (seed, int(ids[at]), x[at].tolist(), int(mult[at]), lot[at])
                    for name, value in zip(out, drawn, strict=True):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict(out)

    drawn = space.blocks.select("ids", "mult", "flat").mapInArrow(draw, CANDIDATE + ", lot double")
    chosen = F.min_by(F.struct("c", "vec", "mult"), F.struct("lot", "c")).alias("p")
    return drawn.groupBy("seed").agg(chosen).select("seed", "p.*")


def _cost(known: DataFrame) -> dict[int, float]:
    """Sum of squared distances of each seed."""
    return {r["seed"]: r["cost"] for r in known.groupBy("seed").agg(F.sum("cost").alias("cost")).collect()}


def _points_of(space: Space, known: DataFrame, turn: int, factor: dict[int, float] | None) -> DataFrame:
    """``CANDIDATE, near``: the points a round draws, or all of them without ``factor``."""
    dim = space.dim

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {name: [] for name in ("seed", "c", "vec", "mult", "near")}
            for i in range(batch.num_rows):
                ids, mult = values(batch.column("ids"), i), values(batch.column("mult"), i)
                x = values(batch.column("flat"), i).reshape(-1, dim)
                near = unpack(batch.column("near"), i, "<f8")
                seed = batch.column("seed")[i].as_py()
                at = np.arange(len(ids))
                if factor is not None:
                    at = at[lots(ids, seed, turn) < factor[seed] * mult * near**2]
                out["seed"] += [seed] * len(at)
                out["c"] += ids[at].tolist()
                out["vec"] += x[at].tolist()
                out["mult"] += mult[at].tolist()
                out["near"] += near[at].tolist()
            yield pa.RecordBatch.from_pydict({k: pa.array(v, _KINDS[k]) for k, v in out.items()})

    rows = known.select("blk", "seed", "near").join(space.blocks, "blk").select("seed", "near", "ids", "mult", "flat")
    return rows.mapInArrow(draw, CANDIDATE + ", near double")


_KINDS = {
    "seed": pa.int64(), "c": pa.int64(), "vec": pa.list_(pa.float64()), "mult": pa.int64(), "near": pa.float64(),
}


def _weights(space: Space, known: DataFrame) -> DataFrame:
    """``seed, c, w``: the points nearest to each candidate."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"seed": [], "c": [], "w": []}
            for i in range(batch.num_rows):
                names, at = np.unique(unpack(batch.column("c"), i, "<i8"), return_inverse=True)
                out["seed"] += [batch.column("seed")[i].as_py()] * len(names)
                out["c"] += names.tolist()
                out["w"] += np.bincount(at, values(batch.column("mult"), i), len(names)).tolist()
            kinds = (pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds, strict=True)})

    rows = known.select("blk", "seed", "c").join(space.blocks.select("blk", "mult"), "blk")
    parts = rows.select("seed", "c", "mult").mapInArrow(count, "seed long, c long, w double")
    return parts.groupBy("seed", "c").agg(F.sum("w").alias("w"))


def picks(x: np.ndarray, w: np.ndarray, most: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order of weighted k-means++, the best of some draws each time, and what
    each saves of the squared distances, as a falling sequence that begins at infinity."""
    lot = np.random.RandomState(seed % (1 << 32))
    trials = 2 + int(math.log(len(x)))
    order, saved = [], []
    near, before = np.full(len(x), np.inf), np.inf
    for _ in range(min(most, len(x))):
        mass = np.cumsum(w * near if order else w)
        if mass[-1] <= 0:  # the rest are copies up to rounding
            rest = np.setdiff1d(np.arange(len(x)), order)[: most - len(order)]
            order += rest.tolist()
            saved += [0.0] * len(rest)
            break
        drawn = np.searchsorted(mass, lot.rand(trials) * mass[-1], "right").clip(0, len(x) - 1)
        after = np.minimum(near[:, None], squared(x, x[drawn]))
        cost = w @ after
        best = int(cost.argmin())
        order.append(int(drawn[best]))
        saved.append(max(before - cost[best], 0.0))
        near, before = after[:, best], cost[best]
        near[order] = 0.0
    return np.array(order), np.minimum.accumulate(saved)


def starts(space: Space, k: int, seeds: list[int]) -> DataFrame:
    """``seed, c, vec`` with ``c`` from 1 to ``k``, at most the number of points, for each seed."""
    drawn = cut(in_cells(_first(space, seeds), space), "candidates")
    candidates = drawn
    known = assign(space, drawn, reached(drawn, space), add=True)
    for turn in range(1, ROUNDS + 1):
        factor = {s: OVERSAMPLING * k / cost if cost > 0 else 0.0 for s, cost in _cost(known).items()}
        new = _points_of(space, known, turn, factor).drop("near")
        drawn = cut(in_cells(new.join(candidates.select("seed", "c"), ["seed", "c"], "left_anti"), space), "candidates")
        at = reached(drawn, space)
        if not at:
            break
        fresh = assign(space, drawn, at, known.where(F.col("seed").isin(*at)), add=True)
        known = fresh.unionByName(known.where(~F.col("seed").isin(*at)))
        candidates = candidates.unionByName(drawn)
    weighed = candidates.join(_weights(space, known), ["seed", "c"], "left")
    held = cut(weighed.withColumn("w", F.coalesce("w", F.col("mult").cast("double"))), "weighted")
    counts = {r["seed"]: r["count"] for r in held.groupBy("seed").count().collect()}
    short = {s: k - n for s, n in counts.items() if n < k}
    if short:  # as when there are few more points than centres: the farthest others
        left = _points_of(space, known.where(F.col("seed").isin(*short)), 0, None).join(
            candidates.select("seed", "c"), ["seed", "c"], "left_anti"
        )
        ranked = ordered_prefix(left.withColumn("far", -F.col("near")), ["seed"], ["far", "c"], None, "place")
        wanted = F.create_map(*[F.lit(v).cast("long") for pair in short.items() for v in pair])
        more = in_cells(ranked.where(F.col("place") <= wanted[F.col("seed")]).drop("near", "far", "place"), space)
        held = cut(held.unionByName(more.withColumn("w", F.col("mult").cast("double"))), "weighted")
    return _thinned(held, k)


def _thinned(held: DataFrame, k: int) -> DataFrame:
    # Shells of a cell by distance from its pivot: neighbours mostly stay together.
    shells = ordered_prefix(held, ["seed", "cell"], ["reach", "c"], None, "place").withColumn(
        "shell", F.floor((F.col("place") - 1) / GROUP_ROWS)
    )

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("c", ignore_index=True)
        w = group["w"].to_numpy()
        key = int(group["seed"].iloc[0]) * 1_000_003 + int(group["c"].iloc[0])
        order, saved = picks(np.stack(group["vec"].to_numpy()), w, k, key)
        chosen = group.loc[order, ["seed", "c", "vec"]]
        return chosen.assign(loss=-saved, weight=-w.sum(), turn=np.arange(len(order)))

    picked = shells.select("seed", "cell", "shell", "c", "vec", "w").groupBy("seed", "cell", "shell").applyInPandas(
        choose, "seed long, c long, vec array<double>, loss double, weight double, turn long"
    )
    ranked = ordered_prefix(picked, ["seed"], ["loss", "weight", "turn", "c"], None, "place")
    return ranked.where(F.col("place") <= k).select("seed", F.col("place").alias("c"), "vec")
