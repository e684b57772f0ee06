"""The keyed store: commits, retries, interruptions, ties, compaction."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from corpusflow.sources.index_store import IndexStore
from corpusflow.streaming import streams as st


def rows(spark, data):
    return spark.createDataFrame(data, "id string, version int, v double")


def now(store):
    return sorted((r["id"], r["version"], r["v"]) for r in store.read().collect())


@pytest.fixture
def store(spark):
    return IndexStore(spark, tempfile.mkdtemp(prefix="cf-store-"), "id", 4)


def test_commits_replace_delete_and_compact(spark, store):
    with pytest.raises(ValueError):
        store.read()
    store.commit(rows(spark, [("a", 1, 1.0), ("b", 1, 2.0), ("c", 1, 3.0), (None, 1, 0.0)]), version="version")
    store.commit(rows(spark, [("a", 2, 9.0), ("d", 1, 4.0), ("d", 3, 5.0), ("d", 3, 6.0)]), deletes=rows(spark, [("b", 0, 0.0), ("a", 0, 0.0)]), version="version")
    want = [("a", 2, 9.0), ("c", 1, 3.0), ("d", 3, 6.0)]
    assert now(store) == want
    store.compact()
    assert now(store) == want and store.state()["deltas"] == []
    assert store.compact() == store.state()["number"]
    store.commit(deletes=rows(spark, [("c", 0, 0.0), ("none", 0, 0.0)]))
    assert now(store) == [want[0], want[2]]
    store.commit(rows(spark, [("c", 7, 7.0)]))
    store.compact()
    assert now(store) == [want[0], ("c", 7, 7.0), want[2]]
    assert sorted((r["id"], r["v"]) for r in store.read(["c", "zz", "a"]).collect()) == [("a", 9.0), ("c", 7.0)]
    store.commit(deletes=store.read().select("id"))
    store.compact()
    assert now(store) == []


def test_a_batch_commits_once(spark, store):
    store.commit(rows(spark, [("a", 1, 1.0)]), writer="w", batch=0)
    n = store.commit(rows(spark, [("a", 1, 2.0)]), writer="w", batch=0)
    assert now(store) == [("a", 1, 1.0)] and n == store.state()["number"] == 1
    store.commit(rows(spark, [("a", 1, 3.0)]), writer="other", batch=0)
    assert now(store) == [("a", 1, 3.0)]


def test_interrupted_commits_change_nothing(spark, store, monkeypatch):
    store.commit(rows(spark, [("a", 1, 1.0)]))
    monkeypatch.setattr(IndexStore, "_write_manifest", lambda self, state: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        store.commit(rows(spark, [("a", 2, 2.0), ("b", 1, 1.0)]))
    monkeypatch.undo()
    assert now(store) == [("a", 1, 1.0)]
    # a manifest that was cut off counts for nothing, and its number is not used again
    with open(os.path.join(store.base, "commits", "0000000002.json"), "w") as f:
        f.write('{"number": 2, "base"')
    assert now(store) == [("a", 1, 1.0)]
    store.commit(rows(spark, [("b", 1, 5.0)]))
    assert now(store) == [("a", 1, 1.0), ("b", 1, 5.0)] and store.state()["number"] == 3


def test_two_writers_at_once(spark, store, monkeypatch):
    """The slower writer commits on top of the faster one."""
    real, raced = IndexStore._write_manifest, []

    def race(self, state):
        if not raced:
            raced.append(1)
            IndexStore(spark, store.base, "id", 4).commit(rows(spark, [("x", 1, 1.0)]))
        return real(self, state)

    monkeypatch.setattr(IndexStore, "_write_manifest", race)
    store.commit(rows(spark, [("y", 1, 2.0)]))
    assert now(store) == [("x", 1, 1.0), ("y", 1, 2.0)]


def test_only_hit_buckets_are_read(spark, store):
    store.commit(spark.range(200).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("version"), F.lit(0.5).alias("v")))
    store.compact()
    base = store.state()["base"]
    store.commit(rows(spark, [("7", 2, 1.0)]))
    (hit,) = store.state()["deltas"][0]["buckets"]
    store.compact()
    after = store.state()["base"]
    old = next(iter(base))
    assert after[old]["buckets"] == [b for b in range(4) if b != hit] and len(after) == 2
    files = store.read(["7"]).inputFiles()
    assert files and store.read().count() == 200
    plan = store.read(["7"])._jdf.queryExecution().optimizedPlan().toString()
    assert f"_bucket#" in plan and f"= {hit})" in plan


def test_a_new_checkpoint_adds_to_the_index(spark):
    d, base = tempfile.mkdtemp(prefix="cf-two-"), tempfile.mkdtemp(prefix="cf-base-")
    schema = "doc_id long, text string"
    for i, data in enumerate(([(1, "first text"), (3, "third text")], [(2, "second text"), (3, "")])):
        spark.createDataFrame(data, schema).write.parquet(f"{d}/{i}")
        st.stream_ingest(spark.readStream.schema(schema).parquet(f"{d}/{i}"), base, f"{d}/ck{i}").awaitTermination()
    assert sorted((r["doc_id"], r["content"]) for r in st.read_index(spark, base).collect()) == [(1, "first text"), (2, "second text")]
    # the same stream started again has nothing new
    st.stream_ingest(spark.readStream.schema(schema).parquet(f"{d}/1"), base, f"{d}/ck1").awaitTermination()
    assert st.read_index(spark, base).count() == 2
