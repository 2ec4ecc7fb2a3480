"""Versioned tables in parts: a write replaces the parts it touches, a manifest names what is current.

``data/v=<version>/part=<p>`` holds the rows of a part as that version wrote them, and
``manifest/v=<version>`` one row per part with the version that holds it now. A write makes the
files of the touched parts first and its manifest last, so readers that took an earlier manifest
go on reading whole parts, and a write that fails half way is never seen; its retry replaces it.
What a part is, the caller says: a hash bucket of the key (``bucket``), a day, ... A manifest has a
row per part, so it is small whatever the table holds, and the driver may read it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..session import hadoop_fs, list_dirs
from .files import committed_versions, latest_version, write_snapshot

PART = "part"
MANIFEST = T.StructType([T.StructField(PART, T.LongType()), T.StructField("version", T.LongType()),
                         T.StructField("rows", T.LongType())])


def bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("bigint")


def buckets_of(spark: SparkSession, root: str, default: int) -> int:
    """How many hash buckets a table has: written beside it when it is first asked for."""
    path = f"{root}/buckets"
    if latest_version(spark, path) is None:
        write_snapshot(spark.createDataFrame([(int(default),)], "buckets int").coalesce(1), path, 0)
    return spark.read.schema("buckets int").parquet(f"{path}/v=0").first()[0]


def newest(spark: SparkSession, root: str, below: int | None = None) -> int | None:
    """The newest committed version (under ``below``)."""
    return latest_version(spark, f"{root}/manifest", below)


def manifest(spark: SparkSession, root: str, below: int | None = None) -> dict[int, tuple[int, int]]:
    """{part: (version that holds it, rows)} as of the newest version (under ``below``)."""
    v = newest(spark, root, below)
    if v is None:
        return {}
    rows = spark.read.schema(MANIFEST).parquet(f"{root}/manifest/v={v}").collect()     # a row per part
    return {r[PART]: (r["version"], r["rows"]) for r in rows}


def read_parts(spark: SparkSession, root: str, schema: T.StructType, below: int | None = None,
               only: list[int] | None = None) -> DataFrame:
    """The table as of the newest version (under ``below``), or its parts ``only``: other folders
    are not even listed."""
    held = manifest(spark, root, below)
    paths = [f"{root}/data/v={v}/{PART}={p}" for p, (v, rows) in sorted(held.items()) if rows and (only is None or p in set(only))]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def replace_parts(df: DataFrame, part: Column, touched: list[int], root: str, version: int, sort_by: list[str],
                  options: dict[str, str] | None = None) -> int:
    """Write ``df``, which holds all rows of the parts ``touched``, as ``version``; other parts stay as
    the version before has them. Files hold sorted ranges of (part, ``sort_by``). A touched part
    without rows is gone. Returns the rows of the whole table."""
    spark, data = df.sparkSession, f"{root}/data/v={int(version)}"
    held = manifest(spark, root, version)
    if touched:
        (df.withColumn(PART, part).repartitionByRange(PART, *sort_by).sortWithinPartitions(PART, *sort_by)
         .write.mode("overwrite").options(**(options or {})).partitionBy(PART).parquet(data))
        written = {}
        if any(n.startswith(f"{PART}=") for n in list_dirs(spark, data)):
            schema = T.StructType([*df.schema.fields, T.StructField(PART, T.LongType())])
            written = dict(spark.read.schema(schema).parquet(data).groupBy(PART).count().collect())     # from the footers
        if not set(written) <= set(touched):
            raise ValueError(f"rows of parts {sorted(set(written) - set(touched))[:5]} among those of the touched ones")
        held = {p: v for p, v in held.items() if p not in set(touched)} | {p: (int(version), n) for p, n in written.items()}
    rows = spark.createDataFrame([(p, v, n) for p, (v, n) in sorted(held.items())], MANIFEST)
    write_snapshot(rows.coalesce(1), f"{root}/manifest", version)
    return sum(n for _, n in held.values())


def drop_unused(spark: SparkSession, root: str, keep: int = 3) -> int:
    """Remove old manifests but the newest ``keep``, and the part folders none of these names. A reader
    of an older version must have finished. Returns the part folders removed."""
    versions = committed_versions(spark, f"{root}/manifest")
    if not versions:
        return 0
    used = set()
    for v in versions[-keep:]:
        used |= {(at, p) for p, (at, _) in manifest(spark, root, v + 1).items()}
    gone = 0
    for name in list_dirs(spark, f"{root}/data"):
        v = int(name[2:])
        if v > versions[-1]:                        # a write that hasn't committed
            continue
        parts = [int(n[len(PART) + 1:]) for n in list_dirs(spark, f"{root}/data/{name}") if n.startswith(f"{PART}=")]
        old = [p for p in parts if (v, p) not in used]
        for p in ([None] if len(old) == len(parts) else old):
            fs, path = hadoop_fs(spark, f"{root}/data/{name}" + ("" if p is None else f"/{PART}={p}"))
            fs.delete(path, True)
        gone += len(old)
    for v in versions[:-keep]:
        fs, path = hadoop_fs(spark, f"{root}/manifest/v={v}")
        fs.delete(path, True)
    return gone
