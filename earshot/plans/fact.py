"""The stored fact as readers see it: compacted runs of batches, and the batch folders behind them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..operators import conform as C
from ..schemas import FACT_LISTENS
from ..session import path_exists
from ..sinks.files import latest_version

FACT, RUN_FOLDER = "fact_listens", "fact_listens_runs"
RUNS = T.StructType([T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType()), T.StructField("bytes", T.LongType())])


def fact_path(warehouse: str) -> str:
    return f"{warehouse.rstrip('/')}/{FACT}"


def runs_path(warehouse: str) -> str:
    return f"{warehouse.rstrip('/')}/{RUN_FOLDER}"


def run_path(warehouse: str, lo: int, hi: int) -> str:
    return f"{runs_path(warehouse)}/lo={lo}/hi={hi}"


def live_runs(spark: SparkSession, warehouse: str, version: int | None = None) -> list[tuple[int, int, int]]:
    """(first batch, last batch, bytes) of the runs that stand for their batches, in order."""
    marker = f"{runs_path(warehouse)}/marker"
    v = latest_version(spark, marker) if version is None else version
    if v is None:
        return []
    rows = spark.read.schema(RUNS).parquet(f"{marker}/v={v}").collect()         # about log(batches) rows
    return sorted((r["lo"], r["hi"], r["bytes"]) for r in rows)


def fact_schema(spark: SparkSession) -> T.StructType:
    """The fact's contract plus ``batch_id``, so folder values are read with the contract's types instead
    of inferred ones."""
    base = C.conform(spark.range(0), FACT_LISTENS).schema
    return T.StructType(base.fields + [T.StructField("batch_id", T.LongType())])


def read_rows(spark: SparkSession, warehouse: str, last: int | None, above: int | None = None) -> DataFrame:
    """The fact with its ``batch_id``, up to batch ``last`` (None: nothing has committed), or only batches
    ``above`` one. Batches load in order, so every batch up to the last committed one is complete."""
    schema = fact_schema(spark)
    if last is None:
        return spark.createDataFrame([], schema)
    runs = live_runs(spark, warehouse)
    done = runs[-1][1] if runs else -1
    found, path = [], fact_path(warehouse)
    if last > done and path_exists(spark, path):
        found.append(spark.read.schema(schema).parquet(path).where(
            (F.col("batch_id") <= F.lit(int(last))) & (F.col("batch_id") > F.lit(int(max(done, -1 if above is None else above))))))
    wanted = [run_path(warehouse, lo, hi) for lo, hi, _ in runs if above is None or hi > above]
    if wanted:
        placed = T.StructType([*schema.fields, T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType())])
        rows = spark.read.schema(placed).option("basePath", runs_path(warehouse)).parquet(*wanted).drop("lo", "hi")
        rows = rows.where(F.col("batch_id") <= F.lit(int(last)))
        found.append(rows if above is None else rows.where(F.col("batch_id") > F.lit(int(above))))
    if not found:
        return spark.createDataFrame([], schema)
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out


def read_fact(spark: SparkSession, warehouse: str, last: int | None, above: int | None = None) -> DataFrame:
    return read_rows(spark, warehouse, last, above).drop("batch_id")
