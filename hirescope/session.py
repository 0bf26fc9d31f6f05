"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "hirescope") -> SparkSession:
    """SparkSession with the settings every job here assumes.

    UTC session time zone (week truncation and timestamp rendering depend on
    it), AQE with partition coalescing and skew-join splitting, Arrow for the
    few pandas hand-offs, and no web UI. On a cluster, pass ``master=None`` and
    let the launcher decide; ``shuffle_partitions`` should then be sized so a
    shuffle partition stays around 128-256 MB at the target scale (AQE
    coalesces small ones at run time).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    # in local mode the driver JVM also runs the tasks
    conf["spark.driver.memory"] = os.environ.get("HIRESCOPE_DRIVER_MEMORY", "8g")
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    prepare(spark)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def prepare(spark: SparkSession) -> None:
    """The settings that every query relies on, on a session from elsewhere too.

    UTC, and generated methods of 8,000 bytes of bytecode at most: HotSpot never compiles larger
    ones, so a projection of some fifty columns would run interpreted. Beyond that limit
    Spark cuts it into methods that are compiled.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir`` (or a checkpoint dir already set
    on the context). Only when neither is set and the session runs in local
    mode (tests, a laptop) is a fresh local folder made and registered; on a
    cluster a machine-local folder would not be shared, so that is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no context: use the setting only
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object "
                               "store): fact tables, models and checkpoints are written there")
        configured = tempfile.mkdtemp(prefix="hirescope-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def session_id(spark: SparkSession) -> str:
    """An id of the running application (keys of per-session artifacts)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect: no context
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/hirescope/{name}-{uuid.uuid4().hex[:12]}"
