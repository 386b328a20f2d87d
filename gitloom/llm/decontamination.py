"""Benchmark decontamination with one Aho-Corasick automaton over normalised items.

Texts become their words, A-Z in lower case, each between single spaces. The automaton
holds every window of the benchmark in that form and passes over each document once;
a match names the words it covers, and those their place in the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gitloom.llm.common import extended, small_batches, utf8, with_columns, without

WINDOW = 10
#: Bytes of normalised benchmark text in one automaton (ten times as much in windows).
#: A larger benchmark is scanned for in several passes over the documents.
AUTOMATON_BYTES = 4 << 20

# Letters and digits of ASCII and all other code points make words; the rest are spaces.
_TO_SPACES = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
_WORD = re.compile(rb"[^ ]+")


def normalise(text: bytes) -> bytes:
    """Lower-case A-Z and blank what is no word; offsets stay those of the text."""
    return text.lower().translate(_TO_SPACES)


def windows(text: bytes, size: int = WINDOW) -> set[str]:
    """Runs of ``size`` words, spaces at both ends; a shorter item is one run, none has none."""
    words = normalise(text).split()
    if not words:
        return set()
    runs = range(max(1, len(words) - size + 1))
    return {(b" %b " % b" ".join(words[i : i + size])).decode("latin-1") for i in runs}


def build_automaton(items: list[tuple[object, bytes]], size: int = WINDOW):
    """Automaton whose values are (words of the window, ids of the items that have it)."""
    owners: dict[str, set] = {}
    for item, text in items:
        for window in windows(text, size):
            owners.setdefault(window, set()).add(item)
    automaton = ahocorasick.Automaton()
    for window, ids in owners.items():
        automaton.add_word(window, (window.count(" ") - 1, tuple(ids)))
    if owners:
        automaton.make_automaton()
    return automaton


def scan(automaton, text: bytes) -> tuple[int, list[tuple[int, int]], set]:
    """Number of words, hit word ranges (first, after last; merged) and items found."""
    words = normalise(text).split()
    if not words or len(automaton) == 0:
        return len(words), [], set()
    line = (b" %b " % b" ".join(words)).decode("latin-1")
    ranges: list[list[int]] = []
    items: set = set()
    word, seen = 0, 0  # words before position ``seen``; matches come in order of their end
    for end, (length, ids) in automaton.iter(line):
        word += line.count(" ", seen, end)
        seen = end
        first = word - length
        items.update(ids)
        while ranges and ranges[-1][1] >= first:
            first = min(first, ranges.pop()[0])
        ranges.append([first, word])
    return len(words), [(a, b) for a, b in ranges], items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def original_spans(text: bytes, ranges: list[tuple[int, int]]) -> list[dict]:
    """Character offsets in the original text of ascending ranges of words, in one pass."""
    if not ranges:
        return []
    places = [m.span() for m in _WORD.finditer(normalise(text))]
    found, at, n_chars = [], 0, 0
    for a, b in ranges:
        ends = []
        for offset in (places[a][0], places[b - 1][1]):
            n_chars += len(text[at:offset].decode("utf-8", "replace"))
            at = offset
            ends.append(n_chars)
        found.append({"start": ends[0], "end": ends[1]})
    return found


def item_chunks(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[object, bytes]]]:
    """The benchmark's items in lists of about ``limit`` bytes; one empty list if it is empty."""
    chunk, size, given = [], 0, False
    rows = benchmark.select("item_id", F.col("text").cast("binary").alias("text"))
    for item, text in rows.where("text is not null").toLocalIterator():
        chunk.append((item, bytes(text)))
        size += len(text)
        if size >= limit:
            yield chunk
            chunk, size, given = [], 0, True
    if chunk or not given:
        yield chunk


def mark_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """Add ``n_words, n_hit`` (long), ``items`` (ids, sorted as strings), ``spans`` and
    ``contaminated``.

    A word is hit if it lies in an occurrence of a window; ``spans`` has the character
    offsets of runs of hit words. Null and empty texts have no words and no hits. An item
    without words or with a null text is found nowhere; one with a null id hits but is not
    named. Repeated items count once by id. Columns of the added names are replaced, all
    others pass.
    """
    base = without(docs, "n_words", "n_hit", "items", "spans", "contaminated", "__ranges")
    pair = pa.struct([("a", pa.int32()), ("b", pa.int32())])
    place = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = extended(
        base.schema,
        n_words=T.LongType(),
        n_hit=T.LongType(),
        items=T.ArrayType(T.StringType()),
        spans=T.ArrayType(T.StructType().add("start", T.LongType()).add("end", T.LongType())),
        __ranges=T.ArrayType(T.StructType().add("a", T.IntegerType()).add("b", T.IntegerType())),
    )
    marked = base
    for chunk in item_chunks(benchmark, automaton_bytes):
        items = docs.sparkSession.sparkContext.broadcast(chunk)

        def search(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            automaton = build_automaton(items.value, size)
            for batch in small_batches(batches, "text"):
                rows = {name: [] for name in ("n_words", "n_hit", "items", "spans", "__ranges")}
                texts = utf8(batch, "text")
                known = [{}] * len(texts)
                if "__ranges" in batch.schema.names:  # what an earlier pass has found
                    known = batch.select(["items", "__ranges"]).to_pylist()
                    batch = batch.drop_columns(list(rows))
                for text, old in zip(texts, known, strict=True):
                    n, ranges, ids = scan(automaton, text)
                    if old.get("__ranges"):
                        ranges = merged(ranges + [(r["a"], r["b"]) for r in old["__ranges"]])
                    named = {str(i) for i in ids if i is not None}
                    rows["n_words"].append(n)
                    rows["n_hit"].append(sum(b - a for a, b in ranges))
                    rows["items"].append(sorted(named.union(old.get("items", ()))))
                    rows["spans"].append(original_spans(text, ranges))
                    rows["__ranges"].append([{"a": a, "b": b} for a, b in ranges])
                yield with_columns(
                    batch,
                    n_words=pa.array(rows["n_words"], pa.int64()),
                    n_hit=pa.array(rows["n_hit"], pa.int64()),
                    items=pa.array(rows["items"], pa.list_(pa.string())),
                    spans=pa.array(rows["spans"], pa.list_(place)),
                    __ranges=pa.array(rows["__ranges"], pa.list_(pair)),
                )

        marked = marked.mapInArrow(search, schema)
    return marked.withColumn("contaminated", F.col("n_hit") > 0).drop("__ranges")
