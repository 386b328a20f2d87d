"""Loads into the collection, embedding slices, the stream, clusters."""

import math
import pathlib
import re
from hashlib import md5

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks import collection as collection_checks
from gitloom.operators import clusters as cl
from gitloom.operators import documents
from gitloom.operators.documents import (
    Embedder,
    embed_column,
    metadata_map,
    metadata_value,
    require_one_dimension,
    stub_embedder,
)
from gitloom.plans.load import load_frame, load_summaries
from gitloom.schemas import SUMMARIES
from gitloom.session import scratch_path
from gitloom.sources import collection as store
from gitloom.streaming.incremental import stream_summaries


def summaries(spark, *rows):
    return spark.createDataFrame([("o/r", h, "m", None, None, s, "stub", n) for n, (h, s) in enumerate(rows)], SUMMARIES)


def stored(spark, root):
    return {r.id: r.document for r in store.read_collection(spark, root).collect()}


def test_full_and_incremental(spark):
    root = scratch_path(spark, "c")
    with pytest.raises(ValueError, match="empty or has no embeddings"):
        store.read_collection(spark, root)
    assert load_frame(summaries(spark, ("a", "one"), ("a", None), ("b", " \t"), ("c", "three")), root) == 2
    assert stored(spark, root) == {"a": "one", "c": "three"}
    assert load_frame(summaries(spark, ("a", "changed"), ("d", "four")), root, "incremental") == 1
    assert stored(spark, root) == {"a": "one", "c": "three", "d": "four"}
    assert load_frame(summaries(spark, ("a", "x")), root, "incremental") == 0
    # nothing to load: a full load drops nothing
    assert load_frame(summaries(spark, ("a", " ")), root, "full") == 0
    assert len(stored(spark, root)) == 3
    assert load_frame(summaries(spark, ("z", "only")), root, "full") == 1
    assert stored(spark, root) == {"z": "only"}
    with pytest.raises(ValueError, match="unknown mode"):
        load_frame(summaries(spark), root, "other")


def test_the_first_summary_by_ordinal_is_loaded(spark):
    root = scratch_path(spark, "c")
    rows = summaries(spark, ("a", "zeta first"), ("a", "alpha second"), ("b", "only"))
    assert load_frame(rows, root) == 2
    assert stored(spark, root) == {"a": "zeta first", "b": "only"}
    with pytest.raises(ValueError, match="pass order"):
        load_frame(rows.drop("ord"), root)
    assert load_frame(rows.where("commit_hash = 'b'").drop("ord"), root) == 1


def test_upsert_embeds_once_and_stores_an_id_once(spark, tmp_path):
    root, log = scratch_path(spark, "c"), str(tmp_path / "log")

    def factory():
        def client(texts):
            with open(log, "a") as f:
                f.writelines("text\n" for _ in texts)
            return [[float(len(t))] for t in texts]

        return client

    base = spark.createDataFrame([(f"i{n}", f"d{n}", {"k": "v"}) for n in range(10)], "id string, document string, metadata map<string,string>")
    store.replace_all(embed_column(base, "document", stub_embedder()), root)
    more = base.withColumn("document", F.concat("document", F.lit(" new")))
    store.upsert(embed_column(more, "document", Embedder("counting", factory)), root)
    assert sum(1 for _ in open(log)) == 10
    again = embed_column(more.unionByName(more), "document", stub_embedder())
    store.upsert(again, root)
    assert len(stored(spark, root)) == store.read_collection(spark, root).count() == 10


def test_missing_input(spark):
    with pytest.raises(FileNotFoundError):
        load_summaries(spark, scratch_path(spark, "nothing"), scratch_path(spark, "c"))


def test_metadata(spark):
    rows = spark.createDataFrame([("r", "h", None, None, None), ("r", "h", "m", "p", 7)],
                                 "repo_id string, commit_hash string, commit_message string, pr_message string, pr_id long")
    maps = [r.m for r in rows.select(metadata_map().alias("m")).collect()]
    assert maps[0] == {"repo_id": "r", "commit_hash": "h", "commit_message": ""}
    assert maps[1]["pr_id"] == "7" and maps[1]["pr_message"] == "p"
    got = rows.select(metadata_map().alias("metadata")).select(metadata_value("pr_id").alias("v")).collect()
    assert [r.v for r in got] == ["", "7"]


def test_embedding_slices_keep_order(spark):
    """150 texts go out as 100 and 50; each vector names the size of its slice."""
    model = Embedder("sized", lambda: (lambda texts: [[float(len(texts)), float(t)] for t in texts]))
    df = spark.range(150).select(F.col("id"), F.col("id").cast("string").alias("t")).coalesce(1)
    rows = embed_column(df, "t", model).collect()
    assert sorted({r.embedding[0] for r in rows}) == [50.0, 100.0]
    assert all(r.embedding[1] == r.id for r in rows)


def test_mixed_dimensions_are_refused(spark):
    df = spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "embedding array<double>")
    with pytest.raises(ValueError, match="mixed dimensions"):
        require_one_dimension(df)


def test_stream_catches_up_and_skips_known_ids(spark):
    source, root, state = (scratch_path(spark, x) for x in ("src", "col", "state"))
    summaries(spark, ("a", "one")).write.parquet(source)
    stream_summaries(spark, source, root, state).awaitTermination()
    summaries(spark, ("a", "again"), ("b", "two")).write.mode("append").parquet(source)
    stream_summaries(spark, source, root, state).awaitTermination()
    assert stored(spark, root) == {"a": "one", "b": "two"}


def test_cluster_table(spark):
    df = spark.createDataFrame(
        [("h1", "d", [0.0, 0.0], {"repo_id": "r"}, 0), ("h2", None, [2.0, 0.0], {}, 0), ("h3", "d", [9.0, 9.0], {}, -1)],
        "id string, document string, embedding array<double>, metadata map<string,string>, cluster_id int",
    )
    rows = {r.commit_hash: r for r in cl.cluster_table(df).collect()}
    assert [rows[h].distance_to_centroid for h in ("h1", "h2", "h3")] == [1.0, 1.0, None]
    assert (rows["h1"].repo_id, rows["h2"].repo_id, rows["h2"].semantic_summary) == ("r", "", "")
    exported = {r.commit_hash: r.distance_to_centroid for r in cl.nan_for_noise(cl.cluster_table(df)).collect()}
    assert math.isnan(exported["h3"])
    assert cl.cluster_counts(df).first().asDict() == {"n_clusters": 1, "n_noise": 1}


def test_silhouette_over_several_centroid_blocks(spark, monkeypatch):
    monkeypatch.setattr(cl, "CENTROID_BLOCK", 1)
    df = spark.createDataFrame(
        [(1, [0.0], 0), (2, [2.0], 0), (3, [10.0], 1), (4, [20.0], 2), (5, [50.0], -1)],
        "id int, embedding array<double>, cluster_id int",
    )
    got = {r.id: r.silhouette for r in cl.silhouettes(df).collect()}
    assert got[1] == pytest.approx((10 - 1) / 10) and got[2] == pytest.approx((8 - 1) / 8)
    assert got[3] == pytest.approx(1.0) and got[5] is None
    assert cl.mean_silhouette(df.where("cluster_id < 2")) > 0


def test_sample_silhouettes_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(cl, "CENTROID_BLOCK", 2)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(100 + i % 5, 1, 3)], i % 5) for i in range(40)]
    rows += [(40, [0.0, 0.0, 0.0], -1), (41, [90.0, 90.0, 90.0], 7)]  # noise and a lone member
    rows += [(i, [5.0, 5.0, 5.0], 8 + i % 2) for i in (50, 51, 52, 53)]  # two clusters in one place
    df = spark.createDataFrame(rows, "id int, embedding array<double>, cluster_id int")
    got = {r.id: r.silhouette for r in cl.sample_silhouettes(df).collect()}
    assert len(got) == len(rows)
    for i, x, label in rows:
        gaps = {}
        for j, y, other in rows:
            if j != i and other != -1:
                gaps.setdefault(other, []).append(sum((p - q) ** 2 for p, q in zip(x, y, strict=True)))
        means = {k: sum(v) / len(v) for k, v in gaps.items()}
        b = min(m for k, m in means.items() if k != label)
        a = means.get(label)
        if label == -1:
            assert got[i] is None
        elif a is None or max(a, b) == 0:
            assert got[i] == 0
        else:
            assert got[i] == pytest.approx((b - a) / max(a, b), abs=1e-9)
    one = cl.sample_silhouettes(df.where("cluster_id = 0")).select("silhouette").collect()
    assert [r[0] for r in one] == [None] * 8
    assert cl.sample_silhouettes(df.limit(0)).isEmpty()


def _many(spark, numbers, suffix=""):
    rows = [(f"i{n}", f"d{n}{suffix}", {"k": "v"}) for n in numbers]
    base = spark.createDataFrame(rows, "id string, document string, metadata map<string,string>")
    return embed_column(base, "document", stub_embedder())


def _files(root):
    return {str(p.relative_to(root)) for p in pathlib.Path(root).rglob("part-*.parquet")}


def test_upsert_rewrites_touched_buckets_only(spark):
    root = scratch_path(spark, "buckets")
    store.replace_all(_many(spark, range(200)), root, buckets=16)
    before = _files(root)
    assert len({f.split("/")[2] for f in before}) == 16
    store.upsert(_many(spark, [3, 500], " new"), root)
    written = {f.split("/")[2] for f in _files(root) - before}
    assert 1 <= len(written) <= 2
    expected = {f"i{n}": f"d{n}" for n in range(200)} | {"i3": "d3 new", "i500": "d500 new"}
    assert stored(spark, root) == expected
    assert store.read_collection(spark, root).count() == 201
    store.append_new(_many(spark, [600]), root)
    assert stored(spark, root) == expected | {"i600": "d600"}
    store.upsert(_many(spark, range(200), " all"), root)  # every bucket: laid out anew
    assert stored(spark, root)["i7"] == "d7 all" and len(stored(spark, root)) == 202
    store.replace_all(_many(spark, [1]), root)
    store.replace_all(_many(spark, [2]), root)
    assert stored(spark, root) == {"i2": "d2"}
    assert len(list(pathlib.Path(root, "data").iterdir())) == 2  # the version and its predecessor


def test_crash_between_data_and_manifest_leaves_the_old_version(spark, monkeypatch):
    root = scratch_path(spark, "crash")
    store.replace_all(_many(spark, range(20)), root, buckets=4)

    def fail(*args):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(store, "write_text", fail)
        for change in (store.upsert, store.append_new, store.replace_all):
            with pytest.raises(OSError):
                change(_many(spark, [1, 99], " new"), root)
            assert stored(spark, root) == {f"i{n}": f"d{n}" for n in range(20)}
    store.upsert(_many(spark, [1], " new"), root)
    assert stored(spark, root)["i1"] == "d1 new" and len(stored(spark, root)) == 20
    named = {name for v in store._versions(spark, root) for name, _ in store._manifest(spark, root, v)["folders"]}
    assert {p.name for p in pathlib.Path(root, "data").iterdir()} == named  # nothing of the lost jobs


def test_appends_merge_their_folders(spark, monkeypatch):
    monkeypatch.setattr(store, "MAX_FOLDERS", 3)
    root = scratch_path(spark, "appends")
    store.replace_all(_many(spark, [0]), root)
    for n in range(1, 6):
        store.append_new(_many(spark, [n]), root)
        assert len(store._manifest(spark, root)["folders"]) <= 3
    assert stored(spark, root) == {f"i{n}": f"d{n}" for n in range(6)}


def test_offline_embedder_hashes_a_word_once(spark, monkeypatch):
    hashed = []
    monkeypatch.setattr(documents, "md5", lambda word: hashed.append(word) or md5(word))
    texts = ["a b  a\n\nc", "", None, " c a ", "\u00e9 b"]
    got = documents._word_counts.func(pa.array(texts, pa.string())).to_pylist()
    for text, vector in zip(texts, got, strict=True):
        if text is None:
            assert vector == [None] * 64
            continue
        counts = np.zeros(64)
        for word in re.split("[ \n]+", text):
            counts[int(md5(word.encode()).hexdigest()[:4], 16) % 64] += 1
        assert vector == (counts / np.sqrt((counts**2).sum())).astype(np.float32).tolist()
    assert len(hashed) == len(set(hashed)) == 5


def test_stream_source_grows_by_files(spark, monkeypatch, tmp_path):
    rows = [(i, f"text {i}", "src1", "en") for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    made = []
    monkeypatch.setattr(collection_checks, "stream_summaries", lambda *args, **more: made.append((args[1], more)) or stream_summaries(*args, **more))
    whole = sorted(map(tuple, collection_checks.streamed(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(collection_checks, "ROWS_PER_FILE", 5)
    assert sorted(map(tuple, collection_checks.streamed(spark, str(tmp_path)).collect())) == whole
    counts = [more["files_per_batch"] for _, more in made]
    assert counts[0] == 2 and counts[1] == 8
