"""Session helpers.

The engine never hard-codes cluster settings. ``ensure_session_defaults``
only fills in settings the engine relies on for exact results (UTC session
zone, ANSI mode, legacy charsets for cp1252 input) and leaves everything the
cluster already configured untouched.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings required for byte-exact ids and for the cp1252 fallback.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.legacy.javaCharsets": "true",
}

# Performance settings applied only when the cluster did not set them at
# launch.  The cleaning/hashing projections are wide; generated methods above
# HotSpot's 8000-byte JIT limit would run interpreted, so such stages use
# per-operator compiled projections instead.
PERF_CONF = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Defaults that only apply when the cluster did not choose its own.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_local_session(cores: int = 8, app: str = "tallyspark") -> SparkSession:
    """A local session for tests and the bench (UI off, small shuffle count)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in {**REQUIRED_CONF, **DEFAULT_CONF, **PERF_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_session_defaults(spark: SparkSession) -> None:
    """Apply the settings the engine needs for exact results, and the
    performance defaults the cluster did not set at launch."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)  # raises where it cannot be set: ids would be wrong
    launch = spark.sparkContext.getConf()
    for k, v in PERF_CONF.items():
        if not launch.contains(k):
            try:
                spark.conf.set(k, v)
            except Exception:
                pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the cluster.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only when it is unset (local tests) a fresh scratch folder is
    created and registered.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tallyspark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"
