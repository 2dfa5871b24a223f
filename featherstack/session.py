"""Session defaults and the shared checkpoint folder.

The engine never builds its own session on a cluster: it takes the one it is
given and only reads settings from it.  ``local_session`` exists for tests,
the bench and the smoke entry point.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Settings every plan in this package assumes.  ANSI stays on (division uses
# try_divide explicitly), time zone is pinned so day arithmetic is stable.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "featherstack") -> SparkSession:
    """A local-mode session for tests and the bench (never used on a cluster)."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
               .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g")))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` (or the directory already set on the
    context).  Where it is unset, a folder below the warehouse, which driver
    and executors share, is set; never a machine-local temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    sc.setCheckpointDir(configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_featherstack")
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage by a reliable checkpoint in the shared folder.

    Used at the boundaries the design names (wide feature table, iterative
    fits, small tables whose size is checked before a broadcast).  A reliable
    checkpoint survives executor loss; ``localCheckpoint`` would not.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cluster_conf(input_bytes: int, executor_cores: int, executors: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Opt-in settings for a cluster session sized from the input volume.

    Shuffle partitions are sized so each holds ~``target_partition_bytes``
    of the largest shuffled input (aggregations shrink it; AQE coalesces
    small partitions and splits skewed ones at run time), and never fewer
    than two waves of the available cores.  File splits match the target so
    scans produce partitions that fit executor memory without spilling.
    The engine never overrides a session it is given; apply these when the
    session is built.
    """
    cores = max(1, executor_cores * executors)
    partitions = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        **DEFAULT_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
