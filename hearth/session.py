"""Session defaults and the few cluster-facing helpers every job shares.

Nothing here changes query semantics; it only fixes the execution settings the
library is designed around (AQE with skew-join splitting, UTC session time,
no UI) and gives jobs a shared folder to cut lineage into.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the library relies on.  AQE re-plans joins from runtime sizes (a
# planned shuffle join becomes a broadcast only when the measured side is
# small), coalesces tiny shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(total_cores: int, advisory_mb: int = 256, split_mb: int = 256) -> dict[str, str]:
    """Sizing for a large cluster (e.g. 1000 executors x 8 cores on 100 TB).

    Shuffles start with ~3 partitions per core so no reducer holds more than
    a few hundred MB even for the largest stage, and AQE coalesces small ones
    back to ``advisory_mb`` (by size, not by parallelism).  File splits are
    capped at ``split_mb`` so each scan task's input fits executor memory.
    Skewed partitions above 4x the median (and 1 GB) are split by AQE.
    """
    n = str(max(200, 3 * total_cores))
    return {
        "spark.sql.shuffle.partitions": n,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": n,
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{advisory_mb}m",
        "spark.sql.files.maxPartitionBytes": f"{split_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
    }


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "hearth", driver_memory: str | None = None,
                total_cores: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster ``master`` is left to spark-submit and ``total_cores`` applies
    ``cluster_conf``; tests pass ``local[*]`` and a small partition count.
    """
    builder = SparkSession.builder.appName(app_name)
    if total_cores:
        for k, v in cluster_conf(total_cores).items():
            builder = builder.config(k, v)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names this folder (a distributed file system path every
    executor can reach).  Only when it is unset on a local master -- local
    runs and tests -- do we pick a fresh scratch folder of our own; on a
    cluster an unset folder is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if conf_dir:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(conf_dir)
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a shared folder every "
                           "executor can reach (a machine-local folder would not survive a lost executor)")
    local = tempfile.mkdtemp(prefix="hearth-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (reliable checkpoint).

    Used between long multi-stage layers (flat -> mart -> reports) so that a
    lost executor re-reads the written result instead of recomputing the whole
    upstream plan.  Never a local checkpoint: those die with their executor.
    """
    spark = spark or df.sparkSession
    ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


@contextmanager
def shuffles_given_back(spark: SparkSession):
    """Writes inside drop their shuffle files as each ends.  Spark by itself keeps
    them until the driver happens to collect its garbage, so the shuffles of one
    written table would still hold disk while the next ones are made."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def written(df: DataFrame, name: str, parts: int = 1, by: Sequence[str] = (), **options: str) -> DataFrame:
    """``df`` as a parquet table in the shared checkpoint folder: what reads it
    next scans files (pruned columns, known size) instead of the plan behind it.
    ``options``: of the writer.

    With ``parts`` the rows are written in so many turns, so the disk holds the
    shuffles of one turn at a time; the turn comes from a hash of the first of
    the columns ``by`` that is not null (rows without any: the same turn).  Each
    turn runs ``df`` anew: its rows must not change from run to run, and ``by``
    should be columns whose filter reaches the scans."""
    spark = df.sparkSession
    path = scratch_table_path(spark, name)
    with shuffles_given_back(spark):
        for i in range(parts):
            turn = df if parts == 1 else df.where(F.pmod(F.xxhash64(F.coalesce(*by)), F.lit(parts)) == i)
            turn.write.mode("append").parquet(path, **options)
    return spark.read.schema(df.schema).parquet(path)
