"""Session helpers.

The library never builds its own session inside an operator: every operator is a
function ``DataFrame -> DataFrame``.  These helpers only exist for tests, the bench
and the command-line entry points, and for applying the runtime SQL settings the
operators are designed around (AQE, skew-join splitting, UTC).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the plans assume.  All of them are session-level SQL
# confs, so they can be applied to a session the cluster already created.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed stay joined to its window must be split even when the split adds
    # a shuffle before the per-stay aggregate (partial aggregation then runs in
    # the split tasks, so one hot stay never lands in a single task).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
}


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's ``spark.checkpoint.dir``; set a scratch one only when unset.

    On a cluster the setting names a shared folder and is used as is.  Only local
    runs (tests, bench) without the setting get a fresh scratch directory.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the checkpoint dir
        return current or ""
    sc_dir = sc.getCheckpointDir()
    if current and not sc_dir:
        sc.setCheckpointDir(current)
    if not current:
        current = sc_dir
    if not current:
        if not sc.master.startswith("local"):
            # a machine-local folder is not shared by executors: the cluster must name one
            raise RuntimeError("spark.checkpoint.dir is not set; set it to a folder shared by the cluster")
        current = tempfile.mkdtemp(prefix="stayflow-ckpt-")
        sc.setCheckpointDir(current)
    return current


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "stayflow") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("STAYFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables, in the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stayflow-{spark.sparkContext.applicationId}"


def materialize(df, compression: str | None = None):
    """``df`` written once as Parquet in the shared scratch folder and read back: cuts the lineage
    where several actions read one expensive plan, and keeps column pruning."""
    path = f"{scratch_root(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df) -> None:
    """Remove a table of :func:`materialize` that nothing reads any more."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if path.rsplit("/", 1)[1].startswith("table-"):
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove this application's intermediate tables, when no frame that reads them is needed any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
