"""Session helpers. The library never creates a session on import."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the operators rely on: UTC session time, ANSI casts (bad text is
# handled with try_cast), and adaptive execution for partition coalescing and
# skew-join splitting at runtime.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "signalbox",
    shuffle_partitions: int = 8,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Session for tests, benchmarks and local runs (UI off).

    A ``spark.checkpoint.dir`` of the deployment (``spark-defaults.conf``) is
    kept; ``checkpoint_base`` makes a folder only where none is set.
    """
    conf = {**REQUIRED_CONF, **(extra_conf or {})}
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_base(spark)
    return spark


def checkpoint_base(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Reads the setting from the session. A local folder is created only when
    the setting is absent (local runs); on a cluster the deployment sets it.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if sc.getCheckpointDir() is not None:
            return sc.getCheckpointDir()
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; cluster jobs need a shared folder for "
                "checkpoints and written intermediates"
            )
        base = tempfile.mkdtemp(prefix="signalbox-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    return f"{checkpoint_base(spark).rstrip('/')}/{name}"


def cluster_conf(total_cores: int, advisory_mb: int = 256) -> dict[str, str]:
    """Settings for large clusters (apply at submit time or on the session).

    Shuffle partitions start at three per core so each task's share of a
    large shuffle fits in memory; adaptive execution then merges small
    partitions toward ``advisory_mb`` and splits skewed ones (a key holding
    a large share of the rows) at run time.
    """
    return {
        **REQUIRED_CONF,
        "spark.sql.shuffle.partitions": str(max(200, 3 * int(total_cores))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{advisory_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{advisory_mb * 2}m",
        "spark.sql.files.maxPartitionBytes": f"{advisory_mb}m",
        # Explicit broadcasts are size-checked; keep the planner's own
        # automatic broadcast conservative.
        "spark.sql.autoBroadcastJoinThreshold": "32m",
    }
