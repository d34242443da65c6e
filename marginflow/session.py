"""SparkSession defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  Cluster-level values a deployment sets
# itself (executor memory, shuffle partitions at scale, checkpoint dir) are
# only filled in when absent.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the join's partitioning feeds a grouping
    # on the same key (unified ad metrics): AQE then adds the extra exchange,
    # but only when it measured skew.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Python call-site capture for error context costs milliseconds per
    # Column expression on the driver; plans here build thousands of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "marginflow",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


# Performance-only runtime settings (no effect on results), applied to any
# session handed to the query catalogue, including one built elsewhere.
RUNTIME_DEFAULTS = {k: v for k, v in _DEFAULTS.items() if k.startswith("spark.sql.adaptive.")}


def apply_runtime_defaults(spark: SparkSession) -> None:
    for key, value in RUNTIME_DEFAULTS.items():
        spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting it on the context.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that value
    always wins.  Only a local-mode session (tests, laptops) without that
    setting gets a fresh folder of its own under the system temp dir, when
    a job first asks for it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder shared by "
            "all executors (HDFS/S3/...) before running marginflow jobs")
    path = tempfile.mkdtemp(prefix="marginflow-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def local_session(cpus: int | None = None, shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark: ``local[cpus]``."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return get_session(
        master=f"local[{cpus}]",
        shuffle_partitions=shuffle_partitions,
        extra_conf={"spark.driver.memory": "8g"},
    )
