"""A keyed store of index rows: hash buckets, small commits, merge on read.

    base/data/<folder>/_bucket=<b>/part-*.parquet
    base/commits/<number>.json

A commit writes the rows of one batch, dealt to buckets by their key, into a
folder of its own and then a manifest that names every folder in force. Nothing
written is touched again, a folder that no manifest names is never read, and a
manifest that was cut off counts for nothing, so an interrupted commit leaves
the index as it was. A commit reads nothing of the index; what it costs is the
size of its batch. Readers merge only buckets that commits have hit since they
were last compacted; compaction rewrites those buckets alone.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType
from pyspark.sql.window import Window

BUCKETS = 32


class IndexStore:
    """All rows of a key stand together: a key's rows in a commit replace all
    rows that it had before. ``buckets`` is fixed by the first commit."""

    def __init__(self, spark: SparkSession, base: str, key: str = "id", buckets: int = BUCKETS):
        self.spark, self.base, self.key, self.buckets = spark, base.rstrip("/"), key, buckets

    # ------------------------------------------------------------ manifests

    def _fs(self):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.base}/commits")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def state(self) -> dict:
        """The newest whole manifest; an empty one for a new store."""
        fs, folder = self._fs()
        empty = {"number": 0, "buckets": self.buckets, "base": {}, "deltas": [], "writers": {}, "taken": 0}
        if not fs.exists(folder):
            return empty
        names = sorted((s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json")), reverse=True)
        taken = int(names[0].split(".")[0]) if names else 0
        for name in names:
            try:
                found = json.loads(read_small(self.spark, f"{self.base}/commits/{name}"))
            except ValueError:  # cut off while it was written
                continue
            return found | {"taken": taken}
        return empty | {"taken": taken}

    def _write_manifest(self, state: dict) -> bool:
        """Claim the next number; False if another writer has it."""
        fs, folder = self._fs()
        number = state["taken"] + 1
        body = {k: v for k, v in state.items() if k != "taken"} | {"number": number}
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, f"{number:010d}.json")
        try:
            out = fs.create(path, False)
        except Exception as e:
            if fs.exists(path):
                return False
            raise e
        out.write(json.dumps(body).encode())
        out.close()
        return True

    # -------------------------------------------------------------- writing

    def bucket_of(self, key: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")

    def commit(
        self, rows: DataFrame | None = None, deletes: DataFrame | None = None, writer: str = "", batch: int | None = None, version: str | None = None
    ) -> int:
        """Insert or replace the keys of ``rows`` and delete those of
        ``deletes`` (a key in both keeps its new rows). With ``version`` a key
        has one row: of rows that repeat it the one of the highest version,
        among equal ones the greatest as JSON. A ``batch`` number that
        ``writer`` has already committed changes nothing. Returns the number of
        the manifest in force."""
        state = self.state()
        if batch is not None and state["writers"].get(writer, -1) >= batch:
            return state["number"]
        if version and rows is not None:
            best = Window.partitionBy(self.key).orderBy(F.col(version).desc_nulls_last(), F.to_json(F.struct("*")).desc())
            rows = rows.withColumn("_rank", F.row_number().over(best)).where("_rank = 1").drop("_rank")
        parts = []
        if rows is not None:
            parts.append(rows.where(F.col(self.key).isNotNull()).withColumn("_gone", F.lit(False)))
        if deletes is not None:
            parts.append(deletes.select(self.key).where(F.col(self.key).isNotNull()).distinct().withColumn("_gone", F.lit(True)))
        if not parts:
            return state["number"]
        both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        folder = self._write(both, state["buckets"])
        while True:
            delta = {"folder": folder, "schema": both.schema.json(), "buckets": self._hit(folder)}
            new = state | {"deltas": [*state["deltas"], delta], "schema": delta["schema"] if rows is not None else state.get("schema", delta["schema"])}
            if batch is not None:
                new = new | {"writers": state["writers"] | {writer: batch}}
            if self._write_manifest(new):
                return state["taken"] + 1
            state = self.state()  # another writer was first: commit on top of it
            if batch is not None and state["writers"].get(writer, -1) >= batch:
                return state["number"]

    def _write(self, rows: DataFrame, buckets: int) -> str:
        folder = uuid.uuid4().hex
        dealt = rows.withColumn("_bucket", self.bucket_of(F.col(self.key), buckets))
        dealt.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.base}/data/{folder}")
        return folder

    def _hit(self, folder: str) -> list[int]:
        fs, _ = self._fs()
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.base}/data/{folder}")
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("_bucket="))

    def compact(self) -> int:
        """Merge the hit buckets into a new base; the others stay where they
        are. Commits that arrive meanwhile stay on top."""
        state = self.state()
        hit = sorted({b for d in state["deltas"] for b in d["buckets"]})
        if not hit:
            return state["number"]
        merged = self._merged(state, hit)
        folder = self._write(merged, state["buckets"])
        while True:
            now = self.state()
            kept = {f: e | {"buckets": [b for b in e["buckets"] if b not in hit]} for f, e in now["base"].items()}
            kept = {f: e for f, e in kept.items() if e["buckets"]} | {folder: {"schema": merged.schema.json(), "buckets": self._hit(folder)}}
            kept = {f: e for f, e in kept.items() if e["buckets"]}
            if self._write_manifest(now | {"base": kept, "deltas": now["deltas"][len(state["deltas"]) :]}):
                return now["taken"] + 1

    # -------------------------------------------------------------- reading

    def _folder(self, folder: str, schema: str, buckets: list[int]) -> DataFrame:
        s = StructType.fromJson(json.loads(schema)).add("_bucket", IntegerType())
        return self.spark.read.schema(s).parquet(f"{self.base}/data/{folder}").where(F.col("_bucket").isin(buckets))

    def _merged(self, state: dict, buckets: list[int]) -> DataFrame:
        """The rows in force of some buckets."""
        parts = [self._folder(f, e["schema"], b).withColumn("_seq", F.lit(0)) for f, e in state["base"].items() if (b := _both(e["buckets"], buckets))]
        for i, d in enumerate(state["deltas"]):
            if b := _both(d["buckets"], buckets):
                parts.append(self._folder(d["folder"], d["schema"], b).withColumn("_seq", F.lit(i + 1)))
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        newest = rows.groupBy("_bucket", self.key).agg(F.max("_seq").alias("_seq"))
        live = rows.where("_gone is null or not _gone").join(newest, ["_bucket", self.key, "_seq"], "left_semi")
        return live.drop("_bucket", "_seq", "_gone")

    def read(self, keys: list | None = None) -> DataFrame:
        """The rows in force; with ``keys`` those of these keys, from their
        buckets alone."""
        state = self.state()
        wanted = list(range(state["buckets"]))
        if keys is not None:
            found = self.spark.createDataFrame([(str(k),) for k in keys], "k string").select(self.bucket_of(F.col("k"), state["buckets"]).alias("b"))
            wanted = sorted({r["b"] for r in found.collect()})
        hit = _both(sorted({b for d in state["deltas"] for b in d["buckets"]}), wanted)
        still = [b for b in wanted if b not in hit]
        parts = [self._folder(f, e["schema"], b).drop("_bucket") for f, e in state["base"].items() if (b := _both(e["buckets"], still))]
        if hit:
            parts.append(self._merged(state, hit))
        if not parts:
            if "schema" not in state:
                raise ValueError(f"no commit in {self.base}")
            return self.spark.createDataFrame([], StructType.fromJson(json.loads(state["schema"]))).drop("_gone")
        out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        return out if keys is None else out.where(F.col(self.key).cast("string").isin([str(k) for k in keys]))


def _both(a: list[int], b: list[int]) -> list[int]:
    there = set(b)
    return [x for x in a if x in there]


def read_small(spark: SparkSession, path: str) -> str:
    """A small text file of any store, read on the driver."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
