"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "cropwire") -> SparkSession:
    """Local session for tests and the bench (the cluster owns its own session)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(os.environ.get("CROPWIRE_SHUFFLE_PARTITIONS", 8)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CROPWIRE_DRIVER_MEMORY", "8g"))
    )
    # Extra settings for trying other session behaviour, e.g.
    # CROPWIRE_SESSION_CONF="spark.sql.ansi.enabled=false;spark.sql.session.timeZone=America/New_York"
    for kv in filter(None, os.environ.get("CROPWIRE_SESSION_CONF", "").split(";")):
        k, v = kv.split("=", 1)
        builder = builder.config(k.strip(), v.strip())
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_base(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Set by the cluster. Only a local session without it gets a fresh folder
    under the machine's temp dir (tests); a cluster session without it is an
    error, since a machine-local folder is not shared between executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        base = tempfile.mkdtemp(prefix="cropwire-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder; removed when the driver's JVM ends."""
    folder = f"{checkpoint_base(spark)}/cropwire/{spark.sparkContext.applicationId}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop)
    fs.deleteOnExit(hadoop)
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"
