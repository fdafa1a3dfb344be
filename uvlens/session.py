"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on. AQE coalesces the many small shuffle
# partitions of the UV aggregations and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Settings for a large cluster (hundreds of executors, tens of TB). Shuffles
# start with many partitions and AQE coalesces them to ~256 MiB each, so a
# stage never has partitions that outgrow executor memory; input splits are
# 256 MiB; skewed partitions over 5x the median (and 512 MiB) are split.
# RocksDB state with changelog checkpointing keeps large streaming state on
# local disk with small incremental checkpoints. A streaming query fixes its
# number of state partitions from spark.sql.shuffle.partitions at its first
# start; streams should override it to about 2-3x the total cores (the
# launcher's --state-partitions).
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def build_session(master: str | None = None, app: str = "uvlens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None,
                  cluster: bool = False) -> SparkSession:
    """Session with DEFAULT_CONF; ``cluster=True`` adds CLUSTER_CONF; values in
    ``extra`` win over both."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_FALLBACK_ROOT: str | None = None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch data.

    In order: ``spark.checkpoint.dir`` from the session (set by the
    deployment to shared storage), the context's checkpoint folder (set by
    the application), and only when neither exists (local tests) a folder
    under the temp dir, which is then registered as the checkpoint folder.
    On a cluster no machine-local folder stands in: executors would write to
    their own disks and later reads would miss those files, so it is an error.
    """
    global _FALLBACK_ROOT
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect has no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if _FALLBACK_ROOT is None:
        _FALLBACK_ROOT = tempfile.mkdtemp(prefix="uvlens-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(_FALLBACK_ROOT)
    return _FALLBACK_ROOT


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/uvlens/{kind}/{uuid.uuid4().hex}"


def written(df: DataFrame, kind: str) -> DataFrame:
    """``df`` as a fresh table below the shared checkpoint folder: the lineage is cut, and
    all later uses read the same rows."""
    path = scratch_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, in any file system that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a folder, in any file system that Spark reads;
    none if it does not exist."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
