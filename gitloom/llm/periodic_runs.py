"""Stretches of a text that repeat themselves, by a dictionary of basic factors.

The dictionary names the stretches of 1, 2, 4, 8, ... words so that equal ones of a document
share a name; a name of one length comes from two of half the length, and only stretches that
occur twice go on to the next. Occurrences of a stretch of n words less than 2n words apart
propose a period. Each proposal is extended to both sides by the same dictionary, and
equal results are one run. All documents of an Arrow batch go through it together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gitloom.llm.common import extended, small_batches, utf8, with_columns, without

#: Words that a run has at least.
MIN_WORDS = 12

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def split_words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after the other, and where each text's begin (one place more
    than texts). Words are runs without ASCII white space."""
    buffer = np.frombuffer(b" %b " % b" ".join(texts), np.uint8)
    inside = ~_SPACE[buffer]
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    words = pa.Array.from_buffers(
        pa.large_binary(),
        len(starts),
        [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(buffer[inside])],
    )
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    return words, np.searchsorted(starts - 1, bounds)


def named(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose key occurs twice or more, ascending, and a name for each key."""
    _, names, counts = np.unique(keys, return_inverse=True, return_counts=True)
    again = counts[names] > 1
    return places[again], names[again]


class Factors:
    """Names of the stretches of 1, 2, 4, ... words that occur twice or more in a document."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray):
        n = len(words)
        self.document = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        size = int(words.max(initial=0)) + 1
        self.levels = [named(self.document * size + words, np.arange(n))]
        while len(self.levels[-1][0]):
            step = 1 << (len(self.levels) - 1)
            places, names = self.levels[-1]
            second = self.names(len(self.levels) - 1, places + step)
            # Names of documents differ, so a stretch over the end of one occurs once.
            both = second >= 0
            keys = names[both] * (int(names.max()) + 1) + second[both]
            self.levels.append(named(keys, places[both]))
        self.levels.pop()

    def names(self, level: int, at: np.ndarray) -> np.ndarray:
        """The name at each place, -1 where the stretch occurs only there or there is none."""
        places, names = self.levels[level]
        found = np.minimum(np.searchsorted(places, at), len(places) - 1)
        return np.where(places[found] == at, names[found], -1) if len(places) else np.full(len(at), -1)

    def proposals(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and periods of at least the level's stretch and less than twice as long.

        Occurrences at most half the stretch apart form a progression whose step is the
        stretch's own period. A run of period q, n <= q < 2n, has its first n words again q
        later, in another progression. Where the step goes on for less than q words after the
        run's start, it breaks off a second time q later: the last places of both
        progressions are q apart. Where it goes on for longer, the second progression starts
        at that place, so every place proposes its distance to the first one of the next
        progressions. More than three cannot start within 2n words. So the proposals are a
        few times the places, and every run is among them.
        """
        places, names = self.levels[level]
        size = 1 << level
        order = np.argsort(names, kind="stable")
        at, name = places[order], names[order]
        begins = np.ones(len(at), bool)
        begins[1:] = (name[1:] != name[:-1]) | (2 * (at[1:] - at[:-1]) > size)
        chain = np.cumsum(begins) - 1
        first = np.flatnonzero(begins)
        last = np.append(first[1:], len(at)) - 1
        found = [np.empty((2, 0), np.int64)]
        for ahead in range(1, min(4, len(first))):
            same = name[first[:-ahead]] == name[first[ahead:]]
            begin = np.append(np.where(same, at[first[ahead:]], -1), np.full(ahead, -1))
            for here, there in ((at, begin[chain]), (at[last[:-ahead]][same], at[last[ahead:]][same])):
                near = (there >= 0) & (there - here >= size) & (there - here < 2 * size)
                found.append(np.stack([here[near], (there - here)[near]]))
        at, period = np.concatenate(found, axis=1)
        order = np.lexsort((at, period))
        at, period = at[order], period[order]
        # Neighbouring places with one period lie in the same run: the first stands for them.
        alone = np.ones(len(at), bool)
        alone[1:] = (period[1:] != period[:-1]) | (at[1:] > at[:-1] + 1)
        return at[alone], period[alone]

    def extent(self, at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word, and the one after the last, of the longest stretches around the places
        in which words a period apart are the same."""
        lo, hi = at.copy(), at.copy()
        for level in reversed(range(len(self.levels))):
            step = 1 << level
            here = self.names(level, hi)
            hi = np.where((here >= 0) & (here == self.names(level, hi + period)), hi + step, hi)
            here = self.names(level, lo - step)
            lo = np.where((here >= 0) & (here == self.names(level, lo - step + period)), lo - step, lo)
        return lo, hi + period

    def runs(self, least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and period of all runs, by start and period."""
        found = [np.empty((3, 0), np.int64)]
        for level in range(len(self.levels)):
            at, period = self.proposals(level)
            lo, hi = self.extent(at, period)
            long = hi - lo >= np.maximum(least, 2 * period)
            found.append(np.stack([lo, hi - lo, period])[:, long])
        start, length, period = np.concatenate(found, axis=1)
        order = np.lexsort((period, length, start))
        start, length, period = start[order], length[order], period[order]
        # A stretch with a multiple of the smallest period has the same ends.
        own = np.ones(len(start), bool)
        own[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
        start, length, period = start[own], length[own], period[own]
        order = np.lexsort((period, start))
        return start[order], length[order], period[order]


def collapsed(words: pa.Array, bounds: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> pa.Array:
    """Each text's words that no run holds after its first period, with a space between."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    stay = np.cumsum(change)[: len(words)] == 0
    kept = np.concatenate([[0], np.cumsum(stay)])[bounds]
    lists = pa.LargeListArray.from_arrays(pa.array(kept, pa.int64()), words.filter(pa.array(stay)))
    return pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())).cast(pa.binary()).cast(pa.string())


def periodic_runs(docs: DataFrame, text: str = "text", least: int = MIN_WORDS) -> DataFrame:
    """Add ``n_words`` (long), ``runs`` and ``collapsed``.

    A run is a stretch of words with smallest period q, of at least ``least`` and 2q words,
    that no neighbouring word goes on with period q; ``runs`` has ``start, length, period``
    in words, by start and then period. ``collapsed`` has the words that no run holds beyond
    its first q, with single spaces. Words are runs without ASCII white space and compared
    as they are. Null and empty texts have no words, no runs and an empty ``collapsed``;
    repeated rows give the same; columns of the added names are replaced.
    """
    base = without(docs, "n_words", "runs", "collapsed")
    run_type = T.StructType().add("start", T.LongType()).add("length", T.LongType()).add("period", T.LongType())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            words, bounds = split_words(utf8(batch, text))
            ids = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            start, length, period = Factors(ids, bounds).runs(least)
            owner = np.searchsorted(bounds, start, "right") - 1
            fields = [start - bounds[owner], length, period]
            rows = pa.StructArray.from_arrays([pa.array(f, pa.int64()) for f in fields], names=run_type.names)
            offsets = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            yield with_columns(
                batch,
                n_words=pa.array(np.diff(bounds), pa.int64()),
                runs=pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows),
                collapsed=collapsed(words, bounds, start, length, period),
            )

    added = extended(base.schema, n_words=T.LongType(), runs=T.ArrayType(run_type), collapsed=T.StringType())
    return base.mapInArrow(search, added)
