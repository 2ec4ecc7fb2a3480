"""Table writes on plain Parquet.

* ``append_table`` honours its mode and reports the row count through an
  ``Observation`` (no second pass over the data).
* ``write_batch_partitions`` overwrites only the partitions a batch produces
  (dynamic partition overwrite), so re-running the same batch after a failure
  replaces its own output and nothing else.
* Snapshots (``v=<n>``) give atomic table versions without a table format: a
  reader takes the highest version whose ``_SUCCESS`` marker exists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..session import hadoop_fs, list_dirs


def append_table(df: DataFrame, path: str, mode: str = "append",
                 partition_by: list[str] | None = None) -> int:
    """Write ``df`` with ``mode`` and return the number of rows written."""
    obs = Observation()
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return int(obs.get["rows"])


def write_batch_partitions(df: DataFrame, path: str, partition_by: list[str],
                           sort_within: list[str] | None = None) -> int:
    """Idempotent write of the partitions present in ``df`` (others untouched)."""
    obs = Observation()
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if sort_within:
        out = out.sortWithinPartitions(*partition_by, *sort_within)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))
    return int(obs.get["rows"])


def write_fact(fact: DataFrame, path: str, batch_id: int | None = None,
               cluster_partitions: int | None = None, salt: int = 64) -> int:
    """Fact layout: partitioned by ``date_key`` (report filters on the date prune
    whole folders), rows sorted by (event_timestamp, user_key, action) inside each
    file so Parquet min/max statistics skip row groups on time ranges.

    By default there is no repartition: each task writes the dates it holds, so a user or
    a day holding a third of all rows is still spread over all writer tasks. With
    ``cluster_partitions`` the rows are range-partitioned by (date, salt) into so many
    tasks first: a task holds few days (few files), and a hot day is cut by its ``salt``
    values into several tasks. With a ``batch_id`` the batch's folders are overwritten on
    retry (idempotent append).
    """
    if cluster_partitions:
        fact = (fact.withColumn("_salt", F.pmod(F.xxhash64("listen_key"), F.lit(salt)))
                .repartitionByRange(int(cluster_partitions), "date_key", "_salt").drop("_salt"))
    parts = ["date_key"] if batch_id is None else ["batch_id", "date_key"]
    df = fact if batch_id is None else fact.withColumn("batch_id", F.lit(int(batch_id)))
    return write_batch_partitions(df, path, parts, ["event_timestamp", "user_key", "action"])


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions under ``root`` (folders ``v=<n>``) whose write committed."""
    out = []
    for name in list_dirs(spark, root):
        if name.startswith("v="):
            fs, p = hadoop_fs(spark, f"{root}/{name}/_SUCCESS")
            if fs.exists(p):
                out.append(int(name[2:]))
    return sorted(out)


def latest_version(spark: SparkSession, root: str, below: int | None = None) -> int | None:
    """The newest committed version (under ``below``), looked for from the newest folder on."""
    found = sorted((int(n[2:]) for n in list_dirs(spark, root) if n.startswith("v=")), reverse=True)
    for v in found:
        if below is None or v < below:
            fs, p = hadoop_fs(spark, f"{root}/v={v}/_SUCCESS")
            if fs.exists(p):
                return v
    return None


def latest_snapshot(spark: SparkSession, root: str, below: int | None = None) -> str | None:
    v = latest_version(spark, root, below)
    return None if v is None else f"{root}/v={v}"


def write_snapshot(df: DataFrame, root: str, version: int, sort_by: str | None = None) -> int:
    """Write a full new version; a retry of the same version replaces it. ``sort_by``: the
    table's sort key; files then hold ranges of it, each sorted."""
    if sort_by:
        df = df.repartitionByRange(sort_by).sortWithinPartitions(sort_by)
    return append_table(df, f"{root}/v={int(version)}", mode="overwrite")


def next_snapshot(df: DataFrame, root: str) -> int:
    """Write ``df`` as the version after the newest one; readers keep the old one until it is
    committed."""
    newest = latest_version(df.sparkSession, root)
    return write_snapshot(df, root, 0 if newest is None else newest + 1)


def drop_versions(spark: SparkSession, root: str, keep: int = 3) -> list[int]:
    """Remove all but the newest ``keep`` committed versions (a reader that started before the
    last ``keep - 1`` writes must have finished). Returns what was removed."""
    old = committed_versions(spark, root)[:-keep]
    for v in old:
        fs, p = hadoop_fs(spark, f"{root}/v={v}")
        fs.delete(p, True)
    return old


def read_snapshot(spark: SparkSession, root: str, schema=None, below: int | None = None):
    path = latest_snapshot(spark, root, below)
    if path is None:
        return None if schema is None else spark.createDataFrame([], schema)
    return spark.read.parquet(path)


def write_jsonl(df: DataFrame, path: str, value: str = "value", mode: str = "overwrite") -> int:
    """One JSON document per line (the text of column ``value``)."""
    obs = Observation()
    df.select(value).observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).text(path)
    return int(obs.get["rows"])
