"""Session construction and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the library relies on.
#  * UTC: an event time without offset is read as UTC (the event format is naive-means-UTC).
#  * ANSI on: bad casts fail loudly; boundary code uses try_* forms.
#  * duplicate JSON keys keep the last value, as a standard JSON object decoder does.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Scale settings: AQE re-plans joins and partition counts at run time, splits skewed
# join partitions, and converts sort-merge joins into broadcast joins only when the
# measured size of a side is below the threshold.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app: str = "earshot",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or get) a session with the library's settings.

    On a cluster pass ``master=None`` and let the launcher decide; in tests use
    ``local[*]`` with a handful of shuffle partitions.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            **REQUIRED_CONF, **SCALE_CONF}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> None:
    """Apply the settings the library's semantics depend on to a running session."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A folder under the cluster's shared checkpoint location.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only when
    neither is set in local runs and tests, a fresh folder is created and registered
    as the checkpoint dir, so later calls agree on it; on a cluster that is an error
    (each node would write to its own disk).
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
        base = tempfile.mkdtemp(prefix="earshot-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    path = base.rstrip("/") + "/earshot"
    if parts:
        path += "/" + "/".join(p.strip("/") for p in parts)
    if unique:
        path += "-" + uuid.uuid4().hex[:12]
    return path


def hadoop_fs(spark: SparkSession, path: str):
    """(FileSystem, Path) for a location; works for any Hadoop-compatible store."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def input_bytes(df) -> int:
    """Size of the tables that ``df`` reads, as the planner knows it."""
    leaves, total = df._jdf.queryExecution().optimizedPlan().collectLeaves(), 0
    for i in range(leaves.size()):
        total += int(str(leaves.apply(i).stats().sizeInBytes()))
    return total


def is_broadcast(df) -> bool:
    """Is ``df`` small enough, as the planner knows it, to be broadcast in a join?"""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def guard_checkpoint(spark: SparkSession, checkpoint: str, outputs: list[str]) -> None:
    """Refuse to start a stream without its checkpoint when its outputs already hold
    data: batch ids would restart at 0 and overwrite committed batches."""
    if path_exists(spark, checkpoint):
        return
    existing = [o for o in outputs if path_exists(spark, o)]
    if existing:
        raise RuntimeError(
            f"checkpoint {checkpoint} is missing but {existing} already exist; batch ids "
            "would restart and overwrite committed batches. Restore the checkpoint or use "
            "new output folders.")


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty when it does not exist)."""
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


__all__ = ["build_session", "ensure_conf", "shared_dir", "path_exists",
           "list_dirs", "guard_checkpoint", "input_bytes", "is_broadcast", "REQUIRED_CONF", "SCALE_CONF"]
