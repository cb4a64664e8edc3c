"""Session helpers for tests, the bench and the job runner.

Library code never creates a session. These helpers exist for entry points only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.errors import PySparkAttributeError
from pyspark.sql import DataFrame, SparkSession

# Settings that hold from local[8] up to a large cluster. Values that depend on
# the cluster (shuffle partitions, file split size) are arguments.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str = "local[8]",
    app: str = "quarry",
    shuffle_partitions: int = 8,
    max_partition_bytes: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if max_partition_bytes:
        conf["spark.sql.files.maxPartitionBytes"] = max_partition_bytes
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is. Only a local-mode session with nothing configured (a bare test
    session) gets a fresh scratch folder; a cluster session without the
    setting is an error, since a machine-local folder would not survive the
    loss of the machine that wrote it.
    """
    try:
        sc = spark.sparkContext
    except PySparkAttributeError:  # a remote (Connect) session: the server's setting rules
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for reliable checkpoints")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for reliable checkpoints")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write a relation that several questions share to the shared folder as Parquet, and read it from there.

    Later questions read only the columns and rows they need, and a lost executor costs a re-read.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kept/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._kept_at = path
    return out


def drop_kept(*frames: DataFrame) -> None:
    """Remove the files of relations from ``kept`` once no question reads them; frames that were not kept are left alone."""
    for df in frames:
        if path := getattr(df, "_kept_at", None):
            remove_path(df.sparkSession, path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of the caller's own, in whichever file system it lies."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def require_ansi(spark: SparkSession) -> None:
    """Runners refuse a session in which overflow and bad casts pass silently."""
    if spark.conf.get("spark.sql.ansi.enabled", "true").lower() != "true":
        raise RuntimeError("set spark.sql.ansi.enabled=true")


def cluster_conf(input_bytes: int, cores: int, target_partition_bytes: int = 200 * 1024**2) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster run, from the input size and core count.

    Shuffle partitions start at about one per ``target_partition_bytes`` of
    input (at least three waves of the cores) so no reducer must hold more
    than that in memory; adaptive execution coalesces the small ones and
    splits skewed ones at run time.
    """
    partitions = max(3 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024**2),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # integer-unit money sums rely on overflow raising, never wrapping
        "spark.sql.ansi.enabled": "true",
        # delete reliable checkpoint files once their DataFrames are gone
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
