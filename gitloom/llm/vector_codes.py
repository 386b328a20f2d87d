"""Product codes of vectors, with codebooks fitted by Lloyd rounds in integers.

Vectors become integers and are cut into parts. The distinct values of a part, in
lexicographic order, are a trie over their dimensions: a node holds the distances of its
prefix to all entries of the codebook, added up once for all values below it. The trie is
walked depth first; stretches of few values are done at once, a level at a time. A leaf takes
the nearest entry and adds its value, as often as it occurs, to the entry's sum.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gitloom.llm.common import extended, with_columns, without

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components that a task holds at once, and values below a node that are done at once.
CHUNK_VALUES = 1 << 22
BLOCK = 2048


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry, position]``; vectors have ``dimensions`` components."""

    entries: np.ndarray
    dimensions: int

    def sha256(self) -> str:
        """Over all components in decimal, by part, entry and position, with commas between."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def limit(dimensions: int) -> int:
    """Components beyond this are held at it, so that no sum of squares leaves 63 bits."""
    return isqrt((1 << 62) // max(1, dimensions)) // 2


def integers(values: np.ndarray, parts: int) -> np.ndarray:
    """``floor(256 x)`` as rows, parts, positions; zeros fill up the last part."""
    rows, dimensions = values.shape
    width = -(-dimensions // parts)
    most = limit(dimensions)
    scaled = np.clip(np.floor(values.astype(np.float64) * SCALE), -most, most).astype(np.int64)
    return np.pad(scaled, ((0, 0), (0, width * parts - dimensions))).reshape(rows, parts, width)


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different rows in lexicographic order, how often each occurs, and which each row is."""
    order = np.lexsort(values.T[::-1])
    ordered = values[order]
    new = np.ones(len(values), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    which = np.empty(len(values), np.int64)
    which[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return ordered[first], np.diff(np.append(first, len(values))), which


def _block(values: np.ndarray, book: np.ndarray, depth: int, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and distance of values that share ``depth`` components."""
    parents, sums = np.zeros(len(values), np.int64), shared[None, :]
    new = np.zeros(len(values), bool)
    new[0] = True
    for d in range(depth, values.shape[1]):
        new[1:] |= values[1:, d] != values[:-1, d]
        at = np.flatnonzero(new)
        sums = sums[parents[at]] + (values[at, d, None] - book[None, :, d]) ** 2
        parents = np.cumsum(new) - 1
    nearest = sums.argmin(axis=1)  # the lowest of equal ones
    return nearest[parents], sums[np.arange(len(sums)), nearest][parents]


def walk(values: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (ties: the lowest) and squared distance of distinct, ordered values."""
    nearest, distance = np.empty(len(values), np.int64), np.empty(len(values), np.int64)
    open_nodes = [(0, 0, len(values), np.zeros(len(book), np.int64))]
    while open_nodes:
        depth, lo, hi, shared = open_nodes.pop()
        if hi - lo <= BLOCK:
            if hi > lo:
                nearest[lo:hi], distance[lo:hi] = _block(values[lo:hi], book, depth, shared)
            continue
        column = values[lo:hi, depth]
        ends = [*(np.flatnonzero(column[1:] != column[:-1]) + lo + 1).tolist(), hi]
        below, start = [], lo
        for i, end in enumerate(ends):
            left = ends[i - 1] if i else lo
            if end - left > BLOCK:  # a large child is a node of its own
                below.append((depth, start, left, shared))
                below.append((depth + 1, left, end, shared + (column[left - lo] - book[:, depth]) ** 2))
                start = end
            elif end - start > BLOCK:  # small ones go together, the prefix that they share once
                below.append((depth, start, left, shared))
                start = left
        below.append((depth, start, hi, shared))
        open_nodes += reversed(below)
    return nearest, distance


def _finite(vector: str) -> Column:
    """False for null vectors and for those that hold a null, NaN or infinite component."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.coalesce(F.forall(vector, fine), F.lit(False))


def _rows(batch: pa.RecordBatch, vector: str, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have a usable vector of that size, and those vectors."""
    lists = batch.column(vector)
    fits = np.array(lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False) == dimensions)
    flat = lists.filter(pa.array(fits)).flatten()
    return fits, flat.to_numpy(zero_copy_only=False).reshape(int(fits.sum()), max(0, dimensions))


def _chunks(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[pa.RecordBatch]:
    """The rows again in batches of about ``CHUNK_VALUES`` components."""
    rows, held, many = max(1, CHUNK_VALUES // max(1, dimensions)), [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            held.append(batch.slice(start, rows))
            many += held[-1].num_rows
            if many >= rows:
                yield pa.concat_batches(held)
                held, many = [], 0
    if many:
        yield pa.concat_batches(held)


def _sums(vectors: DataFrame, vector: str, books: Codebooks) -> DataFrame:
    """``part, entry, position, total, n`` over all vectors; each task gives its own sums."""
    parts, entries, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in _chunks(batches, books.dimensions):
            rows = integers(_rows(batch, vector, books.dimensions)[1], parts)
            for p in range(parts):
                values, weights, _ = distinct(rows[:, p])
                nearest, _ = walk(values, books.entries[p])
                np.add.at(totals[p], nearest, values * weights[:, None])
                np.add.at(counts[p], nearest, weights)
        p, e = np.nonzero(counts)
        columns = [
            np.repeat(p, width),
            np.repeat(e, width),
            np.tile(np.arange(width), len(p)),
            totals[p, e].ravel(),
            np.repeat(counts[p, e], width),
        ]
        names = ["part", "entry", "position", "total", "n"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    schema = "part long, entry long, position long, total long, n long"
    given = vectors.select(F.col(f"`{vector}`").alias(vector)).mapInArrow(run, schema)
    return given.groupBy("part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def fit(
    df: DataFrame,
    vector: str = "embedding",
    key: str = "vec_id",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> Codebooks:
    """Codebooks that begin as the vectors of the smallest keys and follow ``rounds`` rounds.

    Every vector counts in each round; an entry becomes the floor of its parts' mean, one
    that no part is nearest to stays. Vectors that are null or hold a null or a non-finite
    component take no part, nor do empty ones and those of another size than the first one's. Of equal
    keys the smaller vector comes first, null keys come last. With fewer vectors than
    entries there are fewer entries; without any, none. The driver holds codebooks only:
    ``entries`` times the dimensions.
    """
    kept = df.where(_finite(vector) & (F.size(vector) > 0))
    order = [F.col(key).asc_nulls_last(), F.col(vector)]
    first = kept.orderBy(*order).select(F.size(vector).alias("n")).first()
    if first is None:
        return Codebooks(np.zeros((parts, 0, 0), np.int64), -1)
    dimensions = first["n"]
    kept = kept.where(F.size(vector) == dimensions)
    seeds = [r[0] for r in kept.orderBy(*order).limit(entries).select(vector).collect()]
    book = integers(np.array(seeds, np.float64), parts).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        for r in _sums(kept, vector, Codebooks(book, dimensions)).collect():
            book[r["part"], r["entry"], r["position"]] = r["total"] // r["n"]
    return Codebooks(book, dimensions)


def encode(df: DataFrame, books: Codebooks, vector: str = "embedding") -> DataFrame:
    """Add ``code`` (two hex digits for each part's entry) and ``error`` (long), the squared
    distances summed over the parts.

    Rows whose vector is null or holds a null or a non-finite component go; one of another
    size than the codebooks' stays with null ``code`` and ``error``. Other columns and
    repeated rows pass, columns of the added names are replaced.
    """
    base = without(df, "code", "error").where(_finite(vector))
    parts, entries, _ = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches, books.dimensions):
            fits, vectors = _rows(batch, vector, books.dimensions if entries else -1)
            rows = integers(vectors, parts) if entries else vectors
            codes, errors = np.zeros((len(rows), parts), np.uint8), np.zeros(len(rows), np.int64)
            for p in range(parts if len(rows) else 0):
                values, _, which = distinct(rows[:, p])
                nearest, distance = walk(values, books.entries[p])
                codes[:, p] = nearest[which]
                errors += distance[which]
            digits = codes.tobytes().hex()
            written = iter([digits[i : i + 2 * parts] for i in range(0, len(digits), 2 * parts)])
            measured = np.zeros(batch.num_rows, np.int64)
            measured[fits] = errors
            yield with_columns(
                batch,
                code=pa.array([next(written) if fit else None for fit in fits], pa.string()),
                error=pa.array(measured, pa.int64(), mask=~fits),
            )

    return base.mapInArrow(run, extended(base.schema, code=T.StringType(), error=T.LongType()))


def decode(df: DataFrame, books: Codebooks, code: str = "code", out: str = "approximate") -> DataFrame:
    """Add ``out``, the vector whose parts are the entries of the code (null code: null)."""
    base = without(df, out)
    entries = (books.entries.astype(np.float64) + 0.5) / SCALE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text in batch.column(code).to_pylist():
                chosen = None if text is None else entries[np.arange(len(entries)), list(bytes.fromhex(text))]
                made.append(None if text is None else chosen.ravel()[: books.dimensions])
            yield with_columns(batch, **{out: pa.array(made, pa.list_(pa.float64()))})

    return base.mapInArrow(run, extended(base.schema, **{out: T.ArrayType(T.DoubleType())}))


def with_group_errors(encoded: DataFrame, group: str = "label") -> DataFrame:
    """Add ``{group}_error``, the error summed over the rows with the same value (nulls together).

    ``encoded`` is read twice and should be stored. The sums combine before their shuffle and
    are joined back: Spark broadcasts them where they are small and splits a hot value otherwise.
    """
    sums = encoded.groupBy(F.col(group).alias("__group")).agg(F.sum("error").alias(f"{group}_error"))
    return without(encoded, f"{group}_error").join(sums, F.col(group).eqNullSafe(F.col("__group"))).drop("__group")
