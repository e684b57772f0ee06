"""Committed levels of a crawl, so that it goes on where it stopped.

    base/levels/<depth>-<id>/_bucket=<b>/part-*.parquet
    base/commits/<depth>.json

A level's visits are dealt to buckets by (root, url) and written to a folder of
their own; a small manifest that names the folder is written last and never
overwritten. A level without a whole manifest was interrupted: it is never read
and written anew. A level that looks for what is visited already reads the
buckets that its own candidates hit, by partition pruning.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from corpusflow.sources.index_store import read_small

BUCKETS = 64


class CrawlStore:
    """One crawl below ``base``, a folder that all executors share. ``buckets``
    is fixed by the first level; one writer at a time."""

    def __init__(self, spark: SparkSession, base: str, buckets: int = BUCKETS):
        self.spark, self.base, self.buckets = spark, base.rstrip("/"), buckets

    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _commits(self) -> list[dict]:
        """The whole manifests from level 0 on, up to the first that lacks."""
        found: list[dict] = []
        while True:
            fs, path = self._path(f"commits/{len(found):06d}.json")
            if not fs.exists(path):
                return found
            try:
                found.append(json.loads(read_small(self.spark, path.toString())))
            except ValueError:  # cut off while it was written
                fs.delete(path, False)
                return found

    def bucket(self, root: Column, url: Column) -> Column:
        return F.pmod(F.xxhash64(root, url), F.lit(self.buckets)).cast("int")

    def levels(self, settings: dict) -> list[DataFrame]:
        """The committed levels in order. A crawl goes on with the settings it
        began with; others raise ValueError."""
        commits = self._commits()
        if commits and commits[0]["settings"] != settings:
            raise ValueError(f"this crawl was begun with {commits[0]['settings']}, not {settings}")
        if commits:
            self.buckets = commits[0]["buckets"]
        return [self._read(c["folder"], c["schema"]) for c in commits]

    def _read(self, folder: str, schema: dict) -> DataFrame:
        s = StructType.fromJson(schema).add("_bucket", IntegerType())
        return self.spark.read.schema(s).parquet(f"{self.base}/levels/{folder}")

    def commit(self, depth: int, level: DataFrame, settings: dict) -> DataFrame:
        """Write the visits of a level and then its manifest. A rebalance keeps
        a bucket's files few and cuts a large bucket over tasks."""
        folder = f"{depth:06d}-{uuid.uuid4().hex[:16]}"
        rows = level.withColumn("_bucket", self.bucket(F.col("root"), F.col("url"))).hint("rebalance", "_bucket")
        rows.write.partitionBy("_bucket").parquet(f"{self.base}/levels/{folder}")
        body = {"folder": folder, "schema": json.loads(level.schema.json()), "settings": settings, "buckets": self.buckets}
        fs, path = self._path(f"commits/{depth:06d}.json")
        out = fs.create(path, False)
        out.write(json.dumps(body).encode())
        out.close()
        return self._read(folder, body["schema"])

    def hit(self, visited: DataFrame, keys: DataFrame) -> DataFrame:
        """The rows of ``visited`` in the buckets of ``keys(root, url)``: at
        most ``buckets`` numbers become a partition filter of the scan."""
        asked = keys.select(self.bucket(F.col("root"), F.col("url")).alias("b")).distinct().collect()
        return visited.where(F.col("_bucket").isin([r["b"] for r in asked]))


def union_levels(levels: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, levels)
