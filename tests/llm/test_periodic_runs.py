import itertools
import random
import zlib

import numpy as np
import pytest

from gitloom.llm import periodic_runs, scan_queries
from tests.llm import brute


def runs(w, least):
    """Every period in turn: longest stretches, of which one inside a smaller period's goes."""
    found = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                found.append((i, j - i + q, q))
            i = j + 1
    inside = lambda x, y: y[2] < x[2] and y[0] <= x[0] and y[0] + y[1] >= x[0] + x[1]
    return sorted((x for x in found if not any(inside(x, y) for y in found)), key=lambda x: (x[0], x[2]))


def through_the_dictionary(texts, least):
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in texts])])
    flat = np.array([x for w in texts for x in w], np.int64)
    start, length, period = periodic_runs.Factors(flat, bounds).runs(least)
    out = [[] for _ in texts]
    for s, n, q in zip(start.tolist(), length.tolist(), period.tolist(), strict=True):
        owner = int(np.searchsorted(bounds, s, "right")) - 1
        out[owner].append((s - int(bounds[owner]), n, q))
    return out


@pytest.mark.parametrize("n", [1, 5, 9, 12])
def test_every_text_of_two_words(n):
    texts = list(itertools.product((0, 1), repeat=n))
    for w, got in zip(texts, through_the_dictionary(texts, 2), strict=True):
        assert got == runs(w, 2), w


@pytest.mark.parametrize("q", [5, 7, 8, 11])
def test_every_square_of_two_words(q):
    texts = [u + u for u in itertools.product((0, 1), repeat=q)]
    for w, got in zip(texts, through_the_dictionary(texts, 2), strict=True):
        assert got == runs(w, 2), w


def test_periods_in_periods():
    rng = random.Random(3)
    texts = []
    for _ in range(1500):
        q, kinds = rng.randint(1, 40), rng.choice([2, 2, 3])
        u, root = [rng.randrange(kinds) for _ in range(rng.randint(1, 4))], []
        while len(root) < q:
            root += u * rng.randint(1, 4) + [rng.randrange(kinds)] * rng.randint(0, 2)
        a, root = rng.randrange(q), root[:q]
        middle = (root * 5)[a : a + rng.randint(2 * q, 3 * q)]
        texts.append([rng.randrange(kinds) for _ in range(3)] + middle + [rng.randrange(kinds) for _ in range(3)])
    fibonacci = [[0], [0, 1]]
    while len(fibonacci[-1]) < 400:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    # A stretch of period 3 that changes its phase: runs of many periods around one place.
    texts += [fibonacci[-1], [0, 0, 1] * 30 + [0] + [0, 0, 1] * 30, [], [0], [0] * 300, [0, 1] * 150]
    for w, got in zip(texts, through_the_dictionary(texts, 2), strict=True):
        assert got == runs(w, 2), w


def changed(doc_id, text):
    words = [w for w in text.replace("\t", " ").replace("\n", " ").split(" ") if w] if text else []
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def _rows():
    rng = random.Random(9)
    rows = [(None, "a b c " * 40), (None, None), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "é ü " * 30)]
    for i in range(6, 300):
        vocabulary = [f"w{k}" for k in range(rng.choice([2, 3, 30, 400]))]
        some = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(some * rng.choice([1, 1, 2, 4]))))
    rows += [(10, rows[10][1]), (10, rows[10][1]), (400, "x" * 200_000), (401, "go on " * 30_000)]
    return rows


def test_operator_equals_brute_force(spark):
    rows = _rows()
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, RUNS string")
    found = periodic_runs.periodic_runs(docs).collect()
    assert len(found) == len(rows) and [*found[0].asDict()] == ["doc_id", "text", "n_words", "runs", "collapsed"]
    for r in found:
        words = (r["text"] or "").replace("\t", " ").replace("\n", " ").split(" ")
        words = [w for w in words if w]
        assert r["n_words"] == len(words)
        got = [tuple(x) for x in r["runs"]]
        if r["doc_id"] == 401:
            assert got == [(0, 60_000, 2)] and r["collapsed"] == "go on"
            continue
        assert got == runs(words, periodic_runs.MIN_WORDS)
        gone = {i for s, n, q in got for i in range(s + q, s + n)}
        assert r["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in gone)
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark, tmp_path):
    rows = [r for r in _rows() if r[0] != 401]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    wanted = []
    for doc_id, text in rows:
        words = changed(doc_id, text)
        found = runs(words, 12)
        top = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        milli = None if top[1] is None else 1000 * top[1] // top[2]
        wanted.append((doc_id, len(found), *top, milli, brute.sha256(lines), brute.sha256(kept)))
    got = [tuple(r) for r in scan_queries.op12_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    assert sum(w[1] > 0 for w in wanted) > 50
