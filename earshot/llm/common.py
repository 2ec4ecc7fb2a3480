"""Helpers the operators share: reading tables, scratch tables, Arrow row mapping, ranks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import hadoop_fs, shared_dir

#: Rows and bytes of one Arrow batch to a Python worker: bounds a worker's memory, also for long texts.
BATCH_ROWS = "1000"
BATCH_BYTES = str(8 << 20)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session by rows and bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


_made: list[str] = []           # scratch folders of this driver, in the order they were made


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the cluster's shared folder and read again: its
    lineage ends there, and a lost executor costs no recomputation of what came before. The
    folder is the caller's: ``scratch`` removes it when what it served has been written itself."""
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name, unique=True)
    _made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession, keep: list[str] | None = None) -> Iterator[list[str]]:
    """Remove, at the end, the folders that ``written`` has made inside, but those added to the list
    that this gives. What reads them must have been written or collected inside."""
    first, kept = len(_made), [] if keep is None else keep
    try:
        yield kept
    finally:
        for path in _made[first:]:
            if path not in kept:
                remove(spark, path)
        _made[first:] = [path for path in _made[first:] if path in kept]


def remove(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_fs(spark, path)
    fs.delete(p, True)


def last_written() -> str:
    """The folder that ``written`` made last."""
    return _made[-1]


def map_arrow(df: DataFrame, columns: list[str], fields: list[T.StructField], make: Callable,
              keep: list[str] | None = None) -> DataFrame:
    """Append ``fields`` to the columns ``keep`` (default: all) of ``df``, batch by batch.

    ``make()`` runs once in each task and returns a function from the Arrow arrays of
    ``columns`` to the arrays of ``fields``. A name in ``fields`` must not be in ``keep``.
    """
    keep = df.columns if keep is None else keep
    small_batches(df.sparkSession)
    need = list(dict.fromkeys([*keep, *columns]))
    src = df.select(*(F.col(f"`{c}`") for c in need))
    out = T.StructType([src.schema[c] for c in keep] + fields)
    arrow_types = [f.type for f in to_arrow_schema(T.StructType(fields))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in batches:
            if b.num_rows == 0:
                continue
            new = f(*(b.column(need.index(c)) for c in columns))
            arrays = [b.column(need.index(c)) for c in keep]
            arrays += [a if isinstance(a, pa.Array) else pa.array(a, t)
                       for a, t in zip(new, arrow_types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in out.fields])

    return src.mapInArrow(run, out)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have (in any letter case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Rows of ``df`` with their global 0-based position ``name`` in ``order``.

    One range partitioning (which splits any hot value that ``order`` can tell apart), a
    sort in each partition and one row of offsets per partition; no task sees all rows. The
    sorted rows are written, so that offsets and positions come from one and the same layout.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    mid = free_name(df, "_mid")
    placed = written(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                     .withColumn(mid, F.monotonically_increasing_id()), "ranked")
    pid = F.shiftright(F.col(mid), 33)                       # partition, then row in the partition
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))      # a row per partition
              .select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_at")))
    return (placed.join(F.broadcast(starts), pid == F.col("_pid"))
            .withColumn(name, F.col("_at") + F.col(mid).bitwiseAND((1 << 33) - 1))
            .drop("_pid", "_at", "_n", mid))


def spans_text(spans: list[tuple[str, int, int]], kinds: list[str]) -> str:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    order = {k: i for i, k in enumerate(kinds)}
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], order[x[0]], x[2])))
