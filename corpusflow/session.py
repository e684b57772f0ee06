"""Session helpers.

Library code never changes session settings: the cluster owns shuffle sizing,
AQE and the checkpoint folder (on a local master alone an unset folder is made). ``local_session`` is for tests, the bench and
the driver contract only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local[N] session with the settings we also expect on a cluster."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusflow")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared folder and is used as is. Where
    it is unset, a local master gets a temporary folder; any other master is an
    error, as its executors could not see one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="corpusflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
