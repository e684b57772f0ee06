"""Physical choices shared by the operators.

* ``bounded_broadcast``: a side is written once, its rows and bytes are
  measured, and only then is it hinted as a broadcast. Beyond the bound the
  caller gets the plain frame and a shuffle join of the same rows.
* ``dense_position`` and ``running_sum``: positions and running totals inside
  groups of any size without gathering a group in one task.
* ``materialize``: lineage cuts as parquet tables in the shared folder.
* ``spread``: rows of a table that is small for the work they make.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows and bytes of a side that we are willing to ship to every executor.
MAX_BROADCAST_ROWS = 50_000
MAX_BROADCAST_BYTES = 64_000_000


#: Tasks per core that ``spread`` deals rows to.
TASKS_PER_CORE = 4


def spread(df: DataFrame) -> DataFrame:
    """Deal rows evenly over the cluster's cores. A scan is cut by bytes, so a
    narrow table whose rows make much work would be read by a few tasks. Equal
    rows and keys are dealt like any others."""
    return df.repartition(TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism)


def fits_broadcast(written: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Has a frame that is already written at most ``max_rows`` rows and
    ``max_bytes`` bytes (as JSON)?"""
    size = written.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("b")
    ).first()
    return size["n"] <= max_rows and size["b"] <= max_bytes


def bounded_broadcast(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> tuple[DataFrame, bool]:
    """Write ``df`` once and broadcast it if it fits. Returns the written
    frame, hinted or not, and whether it was. Its plan runs once either way."""
    side = materialize(df, "side")
    small = fits_broadcast(side, max_rows, max_bytes)
    return (F.broadcast(side) if small else side), small


def dense_position(df: DataFrame, part: list[str], order: list[str], name: str = "position") -> DataFrame:
    """1-based position of each row inside its ``part`` group by ``order``
    (which must make the order total), without gathering a group in one task.

    A range-partitioned sort spreads even a group holding a third of all rows
    over many tasks; ``monotonically_increasing_id`` then carries (task,
    index-in-task); a tiny per-task count table turns that into a global
    index, and each group's first index (a partial aggregate) into a position.
    The numbered frame is written to the shared checkpoint folder so both
    uses see the same numbering, and so a lost executor cannot re-deal it.
    """
    keys = [*part, *order]
    s = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    s = materialize(s.withColumn("_mid", F.monotonically_increasing_id()), "positions")
    s = s.withColumn("_task", F.shiftright("_mid", 33)).withColumn(
        "_idx", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    )
    counts = s.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    # One row per task: a window over it is tiny.
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).select("_task", "_off")
    g = s.join(F.broadcast(offsets), "_task").withColumn("_g", F.col("_off") + F.col("_idx"))
    if not part:
        return g.withColumn(name, F.col("_g") + 1).drop("_mid", "_task", "_idx", "_off", "_g")
    # First global index of each group, via the small (task, group) table: a
    # group that spans many tasks has one row per task there, and the join
    # back is on (task, group), so no key holds more than one task's rows.
    per_task = g.groupBy("_task", *part).agg(F.min("_g").alias("_tmin"))
    first = per_task.withColumn("_first", F.min("_tmin").over(Window.partitionBy(*part))).select("_task", *part, "_first")
    first, _ = bounded_broadcast(first)
    return (
        g.join(first, ["_task", *part])
        .withColumn(name, F.col("_g") - F.col("_first") + 1)
        .drop("_mid", "_task", "_idx", "_off", "_g", "_first")
    )


def running_sum(df: DataFrame, part: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Running total of ``value`` per ``part`` in ``order`` (a total order),
    skew-safe: a range-partitioned sort cuts even a group holding a third of
    all rows across tasks; each task sums its own slice, and a tiny table of
    per-(task, group) totals gives every slice its starting offset."""
    keys = [*part, *order]
    s = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_task", F.spark_partition_id())
    s = materialize(s, "running")
    local = Window.partitionBy("_task", *part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumn("_local", F.sum(value).over(local))
    tot = s.groupBy("_task", *part).agg(F.sum(value).alias("_tot"))
    before = Window.partitionBy(*part).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.withColumn("_off", F.sum("_tot").over(before)).select("_task", *part, "_off")
    off, _ = bounded_broadcast(off)
    out = s.join(off, ["_task", *part], "left")
    zero = F.lit(0).cast(df.schema[value].dataType)
    return out.withColumn(name, F.coalesce(F.col("_off"), zero) + F.col("_local")).drop("_task", "_local", "_off")


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Cut lineage by writing ``df`` as a parquet table in the shared
    checkpoint folder (``spark.checkpoint.dir``) and reading it back.

    Unlike ``checkpoint()`` the plan runs once (no separate count job) and the
    rows are stored columnar. The folder is shared, so a lost executor costs
    nothing already written; nothing goes to a machine-local folder. The tables
    stay readable until ``drop_materialized``.
    """
    from corpusflow.session import shared_path

    spark = df.sparkSession
    path = shared_path(spark, f"tables/{name}-{uuid.uuid4().hex[:16]}")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def drop_materialized(spark: SparkSession) -> None:
    """Delete every table that ``materialize`` wrote in this application, once
    the caller has written or collected its results."""
    from corpusflow.session import shared_path

    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_path(spark, "tables"))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
