"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Configuration a cluster job wants from the start: adaptive execution (runtime
# re-planning, partition coalescing, skew-join splitting) and the runtime
# broadcast threshold that AQE checks against measured shuffle sizes.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
}


# Suggested settings for a large cluster (not applied by this library: a job
# takes its session as configured).  Start with many shuffle partitions and let
# AQE coalesce them to ~256 MB each; split skewed join partitions; read input
# splits of 256 MB.
CLUSTER_CONF = {
    **DEFAULT_CONF,
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "adlake",
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, no server)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set one only when the session has none.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder;
    it is never replaced here.  Only an unset local session (tests) gets a scratch
    one; an unset cluster session is an error, as its executors share no local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = os.path.join(os.environ.get("TMPDIR", "/tmp"), f"adlake-ckpt-{uuid.uuid4().hex[:8]}")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


_MADE: list[tuple[str, str]] = []


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (for landed files); ``clear_shared`` removes it."""
    base = ensure_checkpoint_dir(spark)
    path = "/".join([base.rstrip("/"), *parts, uuid.uuid4().hex[:12]])
    _MADE.append((spark.sparkContext.applicationId, path))
    return path


def clear_shared(spark: SparkSession) -> int:
    """Remove the folders that this application made in the shared folder, and say how many there were.

    For long-lived sessions, between jobs: DataFrames that read such a folder cannot be used after it.
    """
    own = [p for app, p in _MADE if app == spark.sparkContext.applicationId]
    _MADE[:] = [x for x in _MADE if x[1] not in own]
    conf, gone = spark.sparkContext._jsc.hadoopConfiguration(), 0
    for p in own:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone
