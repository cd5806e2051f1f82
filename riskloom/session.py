"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "riskloom", driver_memory: str = "8g") -> SparkSession:
    """A local session configured like a small cluster: AQE on, UI off, UTC clock."""
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
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster the setting names a shared file system folder and is only read;
    without it this raises, since a machine-local folder would lose rows there.
    With a local master (tests) a fresh scratch folder is created and set.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext handle (e.g. Spark Connect): use the conf only
        sc = None
    configured = sc.getCheckpointDir() if sc is not None else None
    if configured:
        return configured
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not spark.conf.get("spark.master", "").startswith("local[") and spark.conf.get("spark.master", "") != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="riskloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if sc is None:
        return conf_dir
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder (never machine-local on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def cluster_settings(
    input_bytes: int,
    task_slots: int,
    target_partition_bytes: int = 256 * 1024**2,
    shuffle_growth: float = 1.3,
) -> dict[str, str]:
    """Spill-aware sizing for a run over ``input_bytes`` of parquet.

    * scan splits of ``target_partition_bytes`` (``maxPartitionBytes``);
    * the one wide shuffle (behaviour windows) carries about the input plus a
      narrow context copy per row (``shuffle_growth``).  It is cut into whole
      waves of ``task_slots`` partitions near the target size; AQE coalesces
      smaller stages;
    * AQE skew-join splitting for the user joins; broadcasts only under the
      default measured-size threshold.

    Returns settings to pass to ``SparkSession.builder.config``."""
    shuffle_bytes = int(input_bytes * shuffle_growth)
    waves = max(1, -(-shuffle_bytes // (target_partition_bytes * task_slots)))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(waves * task_slots),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
