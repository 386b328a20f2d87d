import math
import random

import numpy as np
import pytest

from gitloom.llm import scan_queries, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def lloyd(rows, parts, entries, rounds):
    """Codebooks, and for each kept row its code and error, by comparing with every entry."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    kept = [(i, [[math.floor(256 * x) for x in v[p * width : (p + 1) * width]] for p in range(parts)], n) for i, v, n in kept]
    books = [[list(k[1][p]) for k in kept[:entries]] for p in range(parts)]

    def nearest(value, book):
        return min((sum((x - c) ** 2 for x, c in zip(value, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            members = [[] for _ in book]
            for _, v, _ in kept:
                members[nearest(v[p], book)[1]].append(v[p])
            for e, values in enumerate(members):
                if values:
                    book[e] = [sum(c) // len(values) for c in zip(*values, strict=True)]
    coded = []
    for i, v, n in kept:
        best = [nearest(v[p], books[p]) for p in range(parts)]
        coded.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), n))
    return books, coded


def _rows():
    rng = random.Random(4)
    hot = [np.float32(rng.uniform(-1, 1)).item() for _ in range(32)]
    rows = []
    for i in range(400):
        vector = [np.float32(rng.choice([rng.uniform(-1, 1), 0.25, -0.5])).item() for _ in range(32)]
        rows.append((i + 1, hot if i % 3 == 0 else vector, rng.choice([None, 0, 1, 1, 1])))
    nan, inf = float("nan"), float("inf")
    rows += [(0, None, 1), (-1, [nan] * 32, 1), (-2, [0.0] * 31 + [inf], None), (-3, [None] + [0.0] * 31, 2)]
    rows += [(None, hot, 3), (None, None, None), (7, rows[6][1], 0), (7, rows[6][1], 0)]
    return rows


def test_query_equals_comparing_with_every_entry(spark, tmp_path):
    rows = _rows()
    spark.createDataFrame(rows, SCHEMA).repartition(7).write.parquet(f"{tmp_path}/embeddings.parquet")
    books, coded = lloyd(rows, 16, 64, 2)
    flat = [x for book in books for entry in book for x in entry]
    digest = vector_codes.Codebooks(np.array(books), 32).sha256()
    assert np.array(books).ravel().tolist() == flat
    by_label = {}
    for _, _, error, label in coded:
        by_label[label] = by_label.get(label, 0) + error
    wanted = [(i, code, error, by_label[label], digest) for i, code, error, label in coded]
    got = [tuple(r) for r in scan_queries.op13_vector_codes(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)


@pytest.mark.parametrize("block", [1, 2, 7, 50])
def test_walk_equals_all_distances(monkeypatch, block):
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    rng = np.random.default_rng(block)
    for width in (1, 2, 4):
        rows = rng.integers(-4, 4, (300, width))
        book = rng.integers(-4, 4, (9, width))
        values, counts, which = vector_codes.distinct(rows)
        assert counts.sum() == 300 and (values[which] == rows).all()
        assert [tuple(v) for v in values.tolist()] == sorted(set(map(tuple, rows.tolist())))
        nearest, distance = vector_codes.walk(values, book)
        all_distances = ((values[:, None, :] - book[None]) ** 2).sum(axis=2)
        assert (nearest == all_distances.argmin(axis=1)).all()
        assert (distance == all_distances.min(axis=1)).all()


def test_chunks_do_not_change_the_codes(spark, monkeypatch):
    df = spark.createDataFrame(_rows(), SCHEMA)
    whole = vector_codes.fit(df)
    expected = sorted(map(repr, vector_codes.encode(df, whole).select("vec_id", "code", "error").collect()))
    monkeypatch.setattr(vector_codes, "CHUNK_VALUES", 100)
    assert vector_codes.fit(df).sha256() == whole.sha256()
    assert sorted(map(repr, vector_codes.encode(df, whole).select("vec_id", "code", "error").collect())) == expected


def test_sizes_columns_decoding_and_empty_tables(spark):
    rows = [(i, [float(i % 5), 0.5, -1.0, i / 7, 2e9], "clash") for i in range(20)] + [(50, [1.0], "short"), (51, [], "none")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, CODE string")
    books = vector_codes.fit(df, parts=2, entries=4, rounds=3)
    assert books.entries.shape == (2, 4, 3) and books.dimensions == 5
    out = vector_codes.encode(df, books)
    assert out.columns == ["vec_id", "embedding", "code", "error"] and out.count() == 22
    assert {r["vec_id"] for r in out.where("code is null and error is null").collect()} == {50, 51}
    for r in vector_codes.decode(out, books).where("code is not null").collect():
        assert len(r["approximate"]) == 5 and abs(r["approximate"][1] - 0.5) < 0.01
    assert (books.entries[1, :, 1] == vector_codes.limit(5)).all()  # 2e9 is held at the limit
    few = vector_codes.fit(df.where("vec_id < 3"), parts=2, entries=4)
    assert few.entries.shape == (2, 3, 3)
    for empty in (df.limit(0), df.where("vec_id > 50")):
        none = vector_codes.fit(empty, parts=2)
        assert none.entries.shape == (2, 0, 0)
        assert vector_codes.encode(df, none).where("code is not null").isEmpty()
    assert vector_codes.encode(df.limit(0), books).count() == 0


def test_query_without_rows(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert scan_queries.op13_vector_codes(spark, str(tmp_path)).count() == 0
