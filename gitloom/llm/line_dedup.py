"""Line dedup over the whole corpus with a sharded minimal perfect hash.

Distinct line hashes are dealt to shards by hash. Each shard becomes a minimal perfect hash
that numbers its keys without storing them, an array of fingerprints and an array of
document counts. Documents probe these arrays with their line hashes; lines themselves are
never shuffled, joined or compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gitloom.llm.common import extended, small_batches, text_key, utf8, with_columns, without
from gitloom.session import cut

SPACES = b" \t\n\x0b\x0c\r"
#: Keys of one shard, on average, and probes of one task at most (about; a power of two less).
SHARD_KEYS = 1 << 17
TASK_PROBES = 1 << 19
#: Bits of a level of the perfect hash per key that it is offered.
GAMMA = 2
MAX_LEVELS = 64


def line_key(line: bytes) -> bytes:
    """The line without white space at its ends, A-Z in lower case."""
    return line.strip(SPACES).lower()


def key_hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def code_points(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode("utf-8", "replace"))


# --- the perfect hash --------------------------------------------------------------


def _places(h1: np.ndarray, h2: np.ndarray, level: int, bits: int) -> np.ndarray:
    mixed = (h1 + h2 * np.uint64(2 * level + 1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return (mixed ^ (mixed >> np.uint64(29))) % np.uint64(bits)


def build_levels(h1: np.ndarray, h2: np.ndarray) -> list[np.ndarray]:
    """Bit arrays of the levels: a key sits where it is alone, the others go one level on."""
    levels = []
    while len(h1):
        if len(levels) == MAX_LEVELS:
            raise ValueError("the keys of a perfect hash are not distinct")
        bits = 64 * -(-GAMMA * len(h1) // 64)
        places = _places(h1, h2, len(levels), bits)
        alone = np.bincount(places.astype(np.int64), minlength=bits)[places] == 1
        flags = np.zeros(bits, bool)
        flags[places[alone]] = True
        levels.append(np.packbits(flags, bitorder="little").view("<u8"))
        h1, h2 = h1[~alone], h2[~alone]
    return levels


def rank(levels: list[np.ndarray], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """The number of each key, from 0 without gaps; -1 for keys that no level holds."""
    found = np.full(len(h1), -1, np.int64)
    open_ = np.arange(len(h1))
    base = 0
    for level, words in enumerate(levels):
        ones = np.bitwise_count(words).astype(np.int64)
        before = np.cumsum(ones) - ones
        places = _places(h1[open_], h2[open_], level, 64 * len(words))
        word, bit = (places >> np.uint64(6)).astype(np.int64), places & np.uint64(63)
        held = (words[word] >> bit) & np.uint64(1) == 1
        below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        number = base + before[word] + np.bitwise_count(below)
        found[open_[held]] = number[held]
        open_ = open_[~held]
        base += int(ones.sum())
    return found


def fingerprint(h2: np.ndarray) -> np.ndarray:
    return (h2 >> np.uint64(32)).astype(np.uint32)


def pack_levels(levels: list[np.ndarray]) -> bytes:
    sizes = np.array([len(levels), *map(len, levels)], "<u8")
    return np.concatenate([sizes, *levels]).astype("<u8").tobytes()


def unpack_levels(data: bytes) -> list[np.ndarray]:
    words = np.frombuffer(data, "<u8")
    n = int(words[0])
    ends = 1 + n + np.cumsum(words[1 : 1 + n]).astype(np.int64)
    return [words[a:b] for a, b in zip([1 + n, *ends[:-1]], ends, strict=True)] if n else []


# --- the operator ------------------------------------------------------------------


def _unsigned(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().view(np.uint64)


def document_lines(docs: DataFrame, min_chars: int, text: str = "text") -> DataFrame:
    """``t1, t2, h1, h2, copies``: for each text the distinct keys of its lines, as hashes.

    ``t1, t2`` name the text, and ``copies`` are its document rows; they combine before the
    shuffle. Keys of fewer than ``min_chars`` code points are left out.
    """
    first, second = text_key(text)
    narrow = docs.select(first.alias("t1"), second.alias("t2"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            found = [
                [k for k in {line_key(x) for x in t.split(b"\n")} if code_points(k) >= min_chars]
                for t in utf8(batch, "text")
            ]
            counts = [len(keys) for keys in found]
            digests = b"".join(key_hash(k) for keys in found for k in keys)
            h = np.frombuffer(digests, "<i8").reshape(-1, 2)
            t1 = np.repeat(batch.column("t1").to_numpy(), counts)
            t2 = np.repeat(batch.column("t2").to_numpy(), counts)
            columns = [t1, t2, h[:, 0].copy(), h[:, 1].copy()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["t1", "t2", "h1", "h2"]
            )

    made = narrow.mapInArrow(run, "t1 long, t2 long, h1 long, h2 long")
    return made.groupBy("t1", "t2", "h1", "h2").agg(F.count("*").alias("copies"))


def build_index(lines: DataFrame, shards: int, once_a_text: bool = False) -> DataFrame:
    """One row per shard: ``shard, n_keys, n_probes, levels, fingerprints, counts``.

    ``counts`` are documents per key, or texts (32 bits, the largest value standing for all
    above); ``n_probes`` are texts. A key's documents are added up before the shuffle; a
    shard has distinct keys only, so its size does not depend on how often a line occurs.
    """
    keys = (
        lines.groupBy("h1", "h2")
        .agg(F.count("*").alias("texts"), F.sum("copies").alias("copies"))
        .withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))
    )

    def build(key, group):
        h1, h2 = _unsigned(group.column("h1")), _unsigned(group.column("h2"))
        texts = group.column("texts").to_numpy()
        n = texts if once_a_text else group.column("copies").to_numpy()
        levels = build_levels(h1, h2)
        order = rank(levels, h1, h2)
        prints, counts = np.empty(len(n), np.uint32), np.empty(len(n), np.uint32)
        prints[order] = fingerprint(h2)
        counts[order] = np.minimum(n, 0xFFFFFFFF)
        return pa.table(
            {
                "shard": pa.array([key[0].as_py()], pa.int32()),
                "n_keys": pa.array([len(n)], pa.int64()),
                "n_probes": pa.array([int(texts.sum())], pa.int64()),
                "levels": pa.array([pack_levels(levels)], pa.binary()),
                "fingerprints": pa.array([prints.tobytes()], pa.binary()),
                "counts": pa.array([counts.tobytes()], pa.binary()),
            }
        )

    return keys.groupBy("shard").applyInArrow(
        build,
        "shard int, n_keys long, n_probes long, levels binary, fingerprints binary, counts binary",
    )


def probe(lines: DataFrame, index: DataFrame, shards: int, min_docs: int) -> DataFrame:
    """``t1, t2, h1, h2, n`` of the lines that at least ``min_docs`` documents have.

    A shard with more probes than a task should take (a line of very many documents) is
    dealt to several tasks by text, each with a copy of the arrays. Copies of a text are one
    row, so no part has more of them than another.
    """
    tasks = index.select(
        "shard", F.ceil(F.col("n_probes") / TASK_PROBES).cast("int").alias("tasks")
    )
    dealt = (
        lines.drop("copies")
        .withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))
        .join(tasks, "shard")
        .withColumn("part", F.pmod("t1", F.col("tasks")).cast("int"))
        .drop("tasks")
    )
    arrays = index.join(tasks, "shard").select(
        "shard",
        F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("part"),
        "levels",
        "fingerprints",
        "counts",
    )

    def look_up(asked, held):
        columns = asked.select(["t1", "t2", "h1", "h2"])
        if held.num_rows == 0 or asked.num_rows == 0:
            return columns.slice(0, 0).append_column("n", pa.array([], pa.int64()))
        row = held.to_pylist()[0]
        h1, h2 = _unsigned(asked.column("h1")), _unsigned(asked.column("h2"))
        number = rank(unpack_levels(row["levels"]), h1, h2)
        prints = np.frombuffer(row["fingerprints"], np.uint32)
        counts = np.frombuffer(row["counts"], np.uint32)
        known = (number >= 0) & (prints[number] == fingerprint(h2))
        n = np.where(known, counts[number], 0).astype(np.int64)
        hit = pa.array(n >= min_docs)
        return columns.append_column("n", pa.array(n)).filter(hit)

    pairs = dealt.groupBy("shard", "part").cogroup(arrays.groupBy("shard", "part"))
    return pairs.applyInArrow(look_up, "t1 long, t2 long, h1 long, h2 long, n long")


def shared_by_groups(hits: DataFrame, groups: DataFrame, min_docs: int) -> DataFrame:
    """Of ``hits`` those whose key at least ``min_docs`` groups of texts have."""
    held = hits.join(groups, ["t1", "t2"]).select("h1", "h2", "group").distinct()
    frequent = held.groupBy("h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs)
    return hits.join(frequent.select("h1", "h2"), ["h1", "h2"], "left_semi")


def drop_frequent_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    text: str = "text",
    groups: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Drop every line whose key at least ``min_docs`` document rows have; add ``n_lines``
    (before) and ``n_dropped``, both long.

    The text is split at line feeds; a null or empty text is one empty line, and its result
    the empty text. Keys of fewer than ``min_chars`` code points always stay. Each row is a
    document of its own, repeated rows and ids included. Columns of the added names are
    replaced, all others pass; an empty table stays empty.

    With ``groups`` a key counts once for each group of texts instead: it takes the documents
    and the ``t1, t2`` of all texts with a line that ``min_docs`` distinct texts have, and
    gives ``t1, t2, group`` for these.
    """
    if min_chars < 1 or min_docs < 1:
        raise ValueError("min_docs and min_chars start at 1")
    source = without(docs, "n_lines", "n_dropped", "__t1", "__t2", "__drop")
    lines = cut(document_lines(source, min_chars, text), "lines")
    shards = max(1, -(-lines.count() // SHARD_KEYS))
    index = cut(build_index(lines, shards, once_a_text=groups is not None), "line-index")
    hits = probe(lines, index, shards, min_docs)
    if groups is not None:
        hits = cut(hits, "line-hits")
        hits = shared_by_groups(hits, groups(source, hits.select("t1", "t2")), min_docs)
    # Copies of a text have the same hits: they become one row before the shuffle.
    dropped = hits.groupBy(F.col("t1").alias("__t1"), F.col("t2").alias("__t2")).agg(
        F.collect_set(F.struct("h1", "h2")).alias("__drop")
    )
    first, second = text_key(text)
    keyed = source.withColumns({"__t1": first, "__t2": second})
    joined = keyed.join(dropped, ["__t1", "__t2"], "left").drop("__t1", "__t2")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            kept, n_lines, n_dropped = [], [], []
            for data, drop in zip(utf8(batch, text), batch.column("__drop"), strict=True):
                parts = data.split(b"\n")
                n_lines.append(len(parts))
                if drop.is_valid:
                    pairs = np.array([[p["h1"], p["h2"]] for p in drop.as_py()], "<i8")
                    gone = {p.tobytes() for p in pairs}
                    stay = [x for x in parts if key_hash(line_key(x)) not in gone]
                    data = b"\n".join(stay)
                    n_dropped.append(len(parts) - len(stay))
                else:
                    n_dropped.append(0)
                kept.append(data)
            at = batch.schema.get_field_index(text)
            texts = pa.array(kept, pa.binary()).cast(batch.schema.field(at).type)
            batch = batch.set_column(at, batch.schema.field(at), texts)
            yield with_columns(
                batch.drop_columns(["__drop"]),
                n_lines=pa.array(n_lines, pa.int64()),
                n_dropped=pa.array(n_dropped, pa.int64()),
            )

    schema = extended(source.schema, n_lines=T.LongType(), n_dropped=T.LongType())
    return joined.select(*[f"`{c}`" for c in source.columns], "__drop").mapInArrow(rebuild, schema)
