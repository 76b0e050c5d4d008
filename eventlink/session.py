"""Session helpers.

The library never creates a machine-local scratch folder on a cluster: lineage
is cut by writing a stage as Parquet into the folder that the cluster names in
``spark.checkpoint.dir`` and reading it back.  Where that is unset, a local
session (tests) uses a folder below the warehouse, and any other one raises.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "eventlink",
                  checkpoint_dir: str | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("EVENTLINK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir:
        ensure_checkpoint_dir(spark, checkpoint_dir)
    return spark


def _configured_dir(spark: SparkSession) -> str | None:
    return (spark.sparkContext.getCheckpointDir()
            or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
            or spark.conf.get("spark.checkpoint.dir", None))


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Return the cluster's checkpoint dir; set ``fallback`` only when unset.

    ``spark.checkpoint.dir`` is a static setting, so an unset dir is given to
    the running context with ``setCheckpointDir`` (never ``conf.set``)."""
    current = _configured_dir(spark)
    if current:
        return current
    spark.sparkContext.setCheckpointDir(fallback)
    return spark.sparkContext.getCheckpointDir() or fallback


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder: ``spark.checkpoint.dir``; in a local session
    without one, a folder under the warehouse dir."""
    d = _configured_dir(spark)
    if not d and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not d:
        wh = spark.conf.get("spark.sql.warehouse.dir")
        d = wh.rstrip("/") + "/_eventlink_checkpoints"
        ensure_checkpoint_dir(spark, d)
    return d


_WRITTEN: list[str] = []


def drop_materialized(spark: SparkSession) -> int:
    """Delete every stage table this process wrote with :func:`materialize`
    (call when the DataFrames built on them are no longer needed)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _WRITTEN:
        p = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        if p.getFileSystem(conf).delete(p, True):
            n += 1
    return n


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path below the checkpoint folder, deleted with the stages."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def materialize(df: DataFrame, name: str, compression: str | None = "zstd") -> DataFrame:
    """Write ``df`` once as parquet under the checkpoint folder and read it back.

    Cuts lineage (an executor loss later re-reads files instead of recomputing
    the upstream plan), lets a stage reused several times run once, and gives
    AQE exact sizes for the joins that follow.  ``compression``: a Parquet codec,
    or None for the session's.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)  # known schema: no footer/inference pass


def cluster_conf(input_bytes: float, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large cluster, sized from the input volume.

    * scan splits of ``target_partition_bytes`` (256 MB: ~400k tasks for 100 TB);
    * initial shuffle partitions = max(input / target, 3 x cores), so a shuffle
      of the whole input still gives ~256 MB partitions that fit executor memory
      and sort without heavy spill; AQE then coalesces small ones;
    * skew join on, with thresholds at the same partition size: a hot person or
      geocode partition is split and the other side replicated;
    * broadcast threshold kept at 64 MB; AQE applies it to measured sizes.
    """
    shuffle = max(int(input_bytes // target_partition_bytes), 3 * int(total_cores))
    size = f"{target_partition_bytes // (1 << 20)}m"
    return {
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": size,
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.session.timeZone": "UTC",
    }
