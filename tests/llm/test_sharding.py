import hashlib
import zlib

from gitloom.llm import sharding
from tests.llm import brute


def _key(doc_id):
    text = "" if doc_id is None else str(doc_id)
    return int(hashlib.md5(text.encode()).hexdigest()[:16], 16)


def test_shards_equal_the_plain_generator(spark):
    rows = [(i, "x" * (i % 7), "clash") for i in range(500)] + [(None, None, "a"), (3, "x", "b")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    found = sharding.shard_documents(docs, 40).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["shard"] == brute.jump(_key(r["doc_id"]), 40)
        assert r["grown_shard"] == brute.jump(_key(r["doc_id"]), 41)
        assert r["grown_shard"] in (r["shard"], 40)
        assert r["law"] == "key"
    by = {}
    for r in found:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())
    texts = sorted((t or "") for _, t, _ in rows)
    assert sorted(r["size"] for r in found) == sorted(len(t) + 16 for t in texts)
    assert sorted(r["text_crc32"] for r in found) == sorted(zlib.crc32(t.encode()) for t in texts)


def test_a_hot_id_and_an_empty_table(spark):
    docs = spark.createDataFrame([(7, "same")] * 300 + [(i, "é") for i in range(50)], "doc_id long, text string")
    found = sharding.shard_documents(docs, 3).collect()
    assert len({r["shard"] for r in found if r["doc_id"] == 7}) == 1
    assert {r["size"] for r in found if r["doc_id"] == 8} == {18}
    hot = [r["slot"] for r in found if r["shard"] == brute.jump(_key(7), 3)]
    assert sorted(hot) == list(range(len(hot)))
    assert sharding.shard_documents(docs.limit(0), 3).count() == 0


def test_one_shard_more_moves_only_its_share(spark):
    keyed = spark.range(4000).selectExpr("id as doc_id", "'x' as text")
    moved = sharding.with_shards(keyed, "doc_id", 9).where("shard != grown_shard")
    assert {r["grown_shard"] for r in moved.collect()} == {9}
    assert 300 < moved.count() < 500
