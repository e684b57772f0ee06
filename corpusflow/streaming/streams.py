"""Structured Streaming forms of batch operators.

Every query keeps its progress in a checkpoint under the shared
``spark.checkpoint.dir`` and its state bounded by a watermark, so a restarted
or re-planned query resumes where it stopped. ``trigger(availableNow=True)``
drains what is there and stops, which is how a folder ingest runs as a job.
"""

from __future__ import annotations

import json
import os
import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from corpusflow.functions.urls import normalize_url
from corpusflow.operators.chunking import chunk_text
from corpusflow.operators.index import embed_column
from corpusflow.session import shared_path
from corpusflow.sources.index_store import IndexStore, read_small


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run of a stream, inside the shared checkpoint folder."""
    return shared_path(spark, f"streams/{name}-{uuid.uuid4().hex[:12]}")


# ---------------------------------------------------------------- I1


def index_writer(base: str, id_col: str = "doc_id", writer: str = ""):
    """foreachBatch sink of I1, called with a batch's documents and their
    chunks: one commit of the keyed store, in which a document's new chunks
    replace all that it had (none, if it has none now). A batch that ``writer``
    has already committed changes nothing, and a batch costs its own size, not
    the index's."""

    def write(docs: DataFrame, chunks: DataFrame, batch_id: int) -> None:
        IndexStore(docs.sparkSession, base, id_col).commit(chunks, deletes=docs.select(id_col), writer=writer, batch=int(batch_id))

    return write


def read_index(spark: SparkSession, base: str, id_col: str = "doc_id") -> DataFrame:
    """The current index: of every document the chunks of its newest commit
    alone, so chunks that a shorter or blank version lost are gone."""
    return IndexStore(spark, base, id_col).read()


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint: the same after a restart,
    another one for a new checkpoint."""
    return json.loads(read_small(spark, os.path.join(checkpoint, "metadata")))["id"]


def stream_ingest(stream: DataFrame, base: str, checkpoint: str, id_col: str = "doc_id", text_col: str = "text",
                  dim: int = 64, available_now: bool = True):
    """New rows (or files) -> chunks -> hashed vectors -> upsert, incrementally.
    Chunking and embedding are one projection inside each micro-batch. A batch
    that repeats a document keeps one of its texts, the greatest. Batches are
    committed under the stream's own id, so several streams, or one that starts
    anew, add to the same index."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        docs = batch.groupBy(id_col).agg(F.max(text_col).alias(text_col))
        rows = chunk_text(docs, id_col, text_col).withColumn("embedding", embed_column("content", dim)).where("embedding is not null")
        rows = rows.withColumn("chunk_id", F.concat_ws(":", F.col(id_col).cast("string"), F.col("chunk_index").cast("string")))
        index_writer(base, id_col, stream_id(batch.sparkSession, checkpoint))(docs, rows, batch_id)

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


# ---------------------------------------------------------------- I2, I3


def stream_dedupe_urls(stream: DataFrame, url_col: str = "url", ts_col: str = "ts", delay: str = "1 hour") -> DataFrame:
    """The crawl's visited set over a URL stream: the first sight of each
    normalised URL passes, repeats within the watermark delay are dropped,
    state older than the watermark is evicted."""
    s = stream.withColumn("nurl", normalize_url(url_col)).withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    return s.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(["nurl"])


def stream_visited_urls(stream: DataFrame, url_col: str = "url") -> DataFrame:
    """I2 without a watermark: a normalised URL passes at its first sight,
    however late it comes again, also after a restart from the checkpoint.

    The visited set is keyed state. It grows with the distinct URLs, so a
    cluster keeps it in RocksDB on the executors' disks, with changes written to
    the checkpoint (``spark.sql.streaming.stateStore.providerClass``). Output:
    ``nurl``."""
    return stream.select(normalize_url(url_col).alias("nurl")).dropDuplicates(["nurl"])


def stream_revisits(stream: DataFrame, ttl: timedelta, url_col: str = "url", ts_col: str = "ts", delay: str = "1 hour") -> DataFrame:
    """I2 with a time to live: a normalised URL passes at its first sight and
    again once ``ttl`` of event time lies between, as in a crawl that visits its
    pages anew; in one micro-batch at most once, at the earliest time that may
    pass. State is dropped when the watermark is past the time to live, so it
    holds the URLs of one ``ttl``. Needs the RocksDB state store. Output:
    ``nurl``, ``ts``."""
    rows = stream.select(normalize_url(url_col).alias("nurl"), F.col(ts_col).cast("timestamp").alias("ts")).where("nurl is not null and ts is not null")
    keyed = rows.withWatermark("ts", delay).withColumn("us", F.unix_micros("ts")).groupBy("nurl")
    passed = keyed.transformWithState(_Revisits(ttl // timedelta(microseconds=1)), "nurl string, us long", "append", "EventTime")
    return passed.select("nurl", F.timestamp_micros("us").alias("ts"))


class _Revisits(StatefulProcessor):
    """The time (in microseconds) at which a key passed last; cleared by a timer
    ``ttl`` later."""

    def __init__(self, ttl: int):
        self.ttl = ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.last = handle, handle.getValueState("last", "us long")

    def handleInputRows(self, key, rows, timerValues):
        after = self.last.get()[0] + self.ttl if self.last.exists() else None
        at = min((r["us"] for r in rows if after is None or r["us"] >= after), default=None)
        if at is not None:
            self.last.update((at,))
            self.handle.registerTimer(-(-(at + self.ttl) // 1000))
            yield Row(nurl=key[0], us=at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        # A later pass has a timer of its own.
        if self.last.exists() and self.last.get()[0] + self.ttl <= expiredTimerInfo.getExpiryTimeInMs() * 1000:
            self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_rate(stream: DataFrame, rpm: int, ts_col: str = "ts", delay: str = "10 minutes", key: str | None = None) -> DataFrame:
    """Calls per tumbling minute (per key), flagged above ``rpm``."""
    s = stream.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, delay)
    g = [F.window(ts_col, "1 minute")] + ([F.col(key)] if key else [])
    out = s.groupBy(*g).agg(F.count(F.lit(1)).alias("calls"))
    return out.withColumn("over_budget", F.col("calls") > F.lit(rpm))


def updates_writer(base: str):
    """foreachBatch sink for update-mode aggregates: every micro-batch appends
    the rows it changed; the greatest count of a window is its final value."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(int(batch_id)).cast("long")).write.mode("overwrite").parquet(
            os.path.join(base, f"b={int(batch_id):010d}")
        )

    return write


def run_available_now(df: DataFrame, checkpoint: str, mode: str = "append", sink=None, path: str | None = None):
    """Start a query that drains the available input and stops; wait for it."""
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if sink is not None:
        q = w.foreachBatch(sink).start()
    else:
        q = w.format("parquet").option("path", path).start()
    q.awaitTermination()
    return q


def file_stream(spark: SparkSession, folder: str, name: str, schema) -> DataFrame:
    """A parquet stream over the table ``name`` in ``folder``, which may be one
    file or a folder of files: a glob that only this name matches, as a stream
    takes no plain file."""
    return spark.readStream.schema(schema).parquet(os.path.join(folder, f"[{name[0]}]{name[1:]}"))
