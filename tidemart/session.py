"""Session and shared-folder helpers.

Scratch data (test marts, versioned copies made by flat compaction) lives under
the shared folder the cluster names in ``spark.checkpoint.dir``.  A folder of
our own is created only when that setting is missing, as in unit tests.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "tidemart", driver_memory: str = "8g") -> SparkSession:
    """Local session used by tests and the bench (the cluster brings its own)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder from ``spark.checkpoint.dir`` (set only if unset)."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getCheckpointDir()
    if not conf_dir:
        # only a local session without a shared folder (a unit test) gets one of its own
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemart-ckpt-"))
        conf_dir = spark.sparkContext.getCheckpointDir()
    return conf_dir.rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused location under the shared folder."""
    return f"{shared_dir(spark)}/tidemart/{label}-{uuid.uuid4().hex[:12]}"


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: one result for all later jobs, with its
    lineage cut, also when executors are lost."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unique_name(label: str) -> str:
    """A catalog table name that does not collide with earlier runs."""
    return f"tm_{label}_{uuid.uuid4().hex[:10]}"
