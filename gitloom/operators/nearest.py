"""The nearest centre of every point, exactly, visiting only centres that bounds leave open.

Points lie in the blocks and pivot cells of :class:`gitloom.operators.neighbours.Space`.
Centres (of several restarts, the ``seed``) go to the cell of their nearest pivot. A block
meets the centres of a cell only where the triangle inequality over the pivot cannot rule
them out for one of its points, so points and centres meet by keys and never all with all.

Between two calls each point keeps an upper bound of the distance to its centre and a lower
bound of that to any other one; a point whose bounds do not cross opens no cell. What the
driver holds is one range of distances for each seed and cell, of which there are at most
``neighbours.MAX_PIVOTS``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gitloom.operators.neighbours import BLOCK_BYTES, TILE_BLOCKS, Space, exact, slack, squared
from gitloom.session import cut

# Centres of one row: two to this power.
CENTRE_BITS = 10
STATE = "blk long, seed long, c binary, near binary, next binary, cost double"
NOT_KNOWN = -1

Ranges = dict[int, tuple[np.ndarray, np.ndarray]]


def in_cells(centres: DataFrame, space: Space) -> DataFrame:
    """Add ``cell``, that of the pivot nearest to ``vec``, and ``reach``, its distance."""
    pivots = space.pivots

    def to_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = np.stack(batch["vec"].to_numpy())
                cell = squared(x, pivots).argmin(1)
                yield batch.assign(cell=cell.astype("int32"), reach=exact(x, pivots[cell]))

    kept = [f for f in centres.schema.fields if f.name not in ("cell", "reach")]
    schema = T.StructType(kept).add("cell", T.IntegerType()).add("reach", T.DoubleType())
    return centres.mapInPandas(to_cells, schema)


def ranges(found: list, space: Space) -> Ranges:
    """Least and largest reach for each seed and cell, from rows ``seed, cell, low, high``."""
    out: Ranges = {}
    for r in found:
        if r["seed"] not in out:
            cells = len(space.pivots)
            out[r["seed"]] = np.full(cells, np.inf), np.full(cells, -np.inf)
        low, high = out[r["seed"]]
        low[r["cell"]], high[r["cell"]] = r["low"], r["high"]
    return out


def reached(placed: DataFrame, space: Space) -> Ranges:
    per_cell = placed.groupBy("seed", "cell").agg(F.min("reach").alias("low"), F.max("reach").alias("high"))
    return ranges(per_cell.collect(), space)  # at most MAX_PIVOTS rows a seed


def values(column: pa.Array, row: int) -> np.ndarray:
    return column[row].values.to_numpy(zero_copy_only=False)


def unpack(column: pa.Array, row: int, kind: str) -> np.ndarray:
    return np.frombuffer(column[row].as_py(), kind)


_KINDS = {"blk": pa.int64(), "seed": pa.int64(), "cell": pa.int64(), "cost": pa.float64()} | {
    k: pa.binary() for k in ("c", "near", "next", "mult")
}
_MET = "blk long, seed long, c binary, near binary, next binary, mult binary"


def _batch(columns: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array(v, _KINDS[k]) for k, v in columns.items()})


def _opened(
    space: Space, known: DataFrame | None, at: Ranges, moved: dict[int, float], add: bool
) -> DataFrame:
    """Rows ``blk, seed, cell``, the cells that may hold the nearest centre of a point of the
    block, and one row for each block and seed with its bounds and a ``cell`` below zero,
    which is the block's own so that these rows spread over the join's partitions."""
    dim, pivots = space.dim, space.pivots
    taken = space.blocks.select("blk", "mult", "flat")
    if known is None:
        listed = F.explode(F.array(*[F.lit(s).cast("long") for s in at])).alias("seed")
        nothing = [F.lit(None).cast("binary").alias(name) for name in ("c", "near", "next")]
        asked = taken.select("blk", "mult", "flat", listed, *nothing)
    else:
        asked = known.drop("cost").join(taken, "blk")

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {name: [] for name in ("blk", "seed", "cell", "c", "near", "next", "mult")}
            for i in range(batch.num_rows):
                x = values(batch.column("flat"), i).reshape(-1, dim)
                blk, seed = batch.column("blk")[i].as_py(), batch.column("seed")[i].as_py()
                low, high = at[seed]
                to_pivot = np.sqrt(squared(x, pivots))
                doubt = 4 * slack(x, pivots)
                if batch.column("c")[i].as_py() is None:
                    c = np.full(len(x), NOT_KNOWN, "<i8")
                    near, other = np.full(len(x), np.inf), np.full(len(x), -np.inf)
                else:
                    c = unpack(batch.column("c"), i, "<i8").copy()
                    near = unpack(batch.column("near"), i, "<f8") + moved.get(seed, 0.0)
                    other = unpack(batch.column("next"), i, "<f8") - moved.get(seed, 0.0)
                floor = to_pivot - high[None, :] - doubt
                ceiling = np.minimum(near, (to_pivot + low[None, :]).min(1)) + doubt
                if not add:
                    lost = near + doubt >= other - doubt
                    c[lost], near[lost] = NOT_KNOWN, np.inf
                    ceiling[~lost] = -np.inf
                # An empty cell has its floor at infinity.
                open_cell = np.isfinite(floor).any(0) & (floor <= ceiling[:, None]).any(0)
                if not add:
                    closed = floor[:, ~open_cell]
                    other[lost] = closed.min(1)[lost] if closed.shape[1] else np.inf
                cells = np.nonzero(open_cell)[0].tolist()
                out["blk"] += [blk] * (len(cells) + 1)
                out["seed"] += [seed] * (len(cells) + 1)
                out["cell"] += [-1 - blk, *cells]
                mult = values(batch.column("mult"), i).astype("<i8")
                for name, held in (("c", c), ("near", near), ("next", other), ("mult", mult)):
                    out[name] += [held.tobytes()] + [None] * len(cells)
            yield _batch(out)

    return asked.mapInArrow(bound, "blk long, seed long, cell long, " + _MET.split("seed long, ")[1])


def _grid(space: Space) -> tuple[int, int]:
    """Groups of blocks, one for each core unless one would be too large, and of cells of centres."""
    full = 8 * space.n * space.dim / (TILE_BLOCKS * BLOCK_BYTES)
    cores = space.blocks.sparkSession.sparkContext.defaultParallelism
    return max(1, min(space.n_blocks, cores), math.ceil(full)), max(1, math.ceil(full / 4))


def _visited(space: Space, opened: DataFrame, centres: DataFrame) -> DataFrame:
    """``blk, seed, met``: the bounds of a block, which alone have ``mult``, and the nearest
    centre with its distance and the next distance among the centres it visits.

    Groups of blocks meet the centres of one seed in tiles, so a block or a centre is sent
    once to a tile and not once for each pair of a block and a cell.
    """
    dim, (groups, columns) = space.dim, _grid(space)
    held = F.sort_array(F.collect_list(F.struct("c", "vec")))
    sent = (
        centres.groupBy("seed", "cell", F.shiftright("c", CENTRE_BITS).alias("part"))
        .agg(held.alias("rows"))
        .select(
            "seed", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("row"),
            F.pmod("cell", F.lit(columns)).cast("int").alias("column"), F.col("cell").cast("long").alias("cell"),
            F.col("rows.c").alias("cs"), F.flatten("rows.vec").alias("cflat"),
        )
    )

    def compare(key, asked: pa.Table, given: pa.Table) -> pa.Table:
        parts, cells, out = {}, {}, {name: [] for name in ("blk", "seed", "c", "near", "next", "mult")}
        given, asked = given.combine_chunks(), asked.combine_chunks()
        for i, cell in enumerate(given.column("cell").to_pylist()):
            y = values(given.column("cflat"), i).reshape(-1, dim)
            parts.setdefault(cell, []).append((values(given.column("cs"), i).astype("<i8"), y))
        listed = list(zip(asked.column("blk").to_pylist(), asked.column("cell").to_pylist(), strict=True))
        for blk, cell in listed:
            if cell >= 0:
                cells.setdefault(blk, []).append(cell)
        for i, (blk, cell) in enumerate(listed):
            if cell >= 0:
                continue
            if asked.column("mult")[i].is_valid:
                for name in out:
                    out[name].append(asked.column(name)[i].as_py())
            if blk not in cells:
                continue
            x = values(asked.column("flat"), i).reshape(-1, dim)
            rows = np.arange(len(x))
            c, near, other = np.full(len(x), NOT_KNOWN, "<i8"), np.full(len(x), np.inf), np.full(len(x), np.inf)
            for names, y in (part for cell in cells[blk] for part in parts.get(cell, ())):
                d = np.sqrt(squared(x, y))
                at = d.argmin(1)
                best = d[rows, at]
                second = np.partition(d, 1, axis=1)[:, 1] if len(names) > 1 else np.full(len(d), np.inf)
                better = (best < near) | (best == near) & (names[at] < c)
                other = np.minimum(other, np.minimum(np.where(better, near, best), second))
                near, c = np.where(better, best, near), np.where(better, names[at], c)
            out["blk"].append(blk)
            out["seed"].append(key[0].as_py())
            for name, found in (("c", c), ("near", near), ("next", other)):
                out[name].append(found.tobytes())
            out["mult"].append(None)
        return pa.table({k: pa.array(v, _KINDS[k]) for k, v in out.items()})

    # Only the row with the bounds takes the vectors of the block along.
    own = F.when(F.col("cell") < 0, F.col("blk")).otherwise(-1 - F.col("blk"))
    payload = space.blocks.select(F.col("blk").alias("own"), "flat")
    column = F.when(F.col("cell") < 0, F.sequence(F.lit(0), F.lit(columns - 1))).otherwise(
        F.array(F.pmod("cell", F.lit(columns)).cast("int"))
    )
    asked = opened.withColumn("own", own).join(payload, "own", "left").select(
        "seed", F.pmod(F.xxhash64("blk"), F.lit(groups)).cast("int").alias("row"), F.explode(column).alias("column"),
        "blk", "cell", "c", "near", "next", "mult", "flat",
    )
    asked = asked.withColumn("mult", F.when((F.col("column") == 0), F.col("mult")))
    tile = ["seed", "row", "column"]
    compared = asked.groupBy(*tile).cogroup(sent.groupBy(*tile)).applyInArrow(compare, _MET)
    return compared.groupBy("blk", "seed").agg(F.collect_list(F.struct("c", "near", "next", "mult")).alias("met"))


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {name: [] for name in ("blk", "seed", "c", "near", "next", "cost")}
        for i in range(batch.num_rows):
            met = batch.column("met")[i].as_py()
            kept = next(m for m in met if m["mult"] is not None)
            c, near, other = _arrays(kept)
            asked = c == NOT_KNOWN
            for found in met:
                if found["mult"] is None:
                    names, d, second = _arrays(found)
                    better = (d < near) | (d == near) & (names < c)
                    beaten = np.minimum(np.where(better, near, d), second)
                    other = np.where(asked, np.minimum(other, beaten), other)
                    near, c = np.where(better, d, near), np.where(better, names, c)
            for name, value in (("c", c), ("near", near), ("next", other)):
                out[name].append(value.tobytes())
            out["cost"].append(float(np.frombuffer(kept["mult"], "<i8") @ near**2))
            out["blk"].append(batch.column("blk")[i].as_py())
            out["seed"].append(batch.column("seed")[i].as_py())
        yield _batch(out)


def _arrays(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(row[k], t) for k, t in (("c", "<i8"), ("near", "<f8"), ("next", "<f8")))


def assign(
    space: Space,
    centres: DataFrame,
    at: Ranges,
    known: DataFrame | None = None,
    moved: dict[int, float] | None = None,
    add: bool = False,
) -> DataFrame:
    """``blk, seed, c, near, next, cost`` as a stored table, arrays in the order of the block's ids.

    ``c`` is the nearest of ``centres`` (``seed, c, vec, cell``; ties to the smaller ``c``),
    ``near`` an upper bound of its distance, exact where ``known`` is None or with ``add``,
    ``next`` a lower bound of the distance to any other and ``cost`` the sum of the squares
    of ``near`` over the block. ``known`` is the table of an earlier call for the seeds of
    ``at``, ``moved`` how far a centre of a seed has moved since at most. With ``add`` the
    centres are new ones beside those of ``known``, which stay where they are.
    """
    opened = _opened(space, known, at, moved or {}, add)
    return cut(_visited(space, opened, centres).mapInArrow(_settle, STATE), "nearest")
