"""Sharding along a Hilbert curve over several metadata columns.

Each dimension is quantised at its quantiles (numbers and times by their values; strings, compared
whole, by the row counts of their distinct values), the cell's index on the Hilbert curve is computed
with column expressions, rows are ranked by it, and the ranking is cut into runs of equal row
counts. A shard then covers a compact region, so filters on any of the columns prune files:
``write_shards`` writes each as sorted files.

Law ``rows``: shards differ by at most one row. Skew: ties on the curve are broken by the key
and the content, so a cell with a third of all rows is cut like any other run.

Nulls form the first cell of a dimension; null text has no bytes and checksum 0. Equal rows
take neighbouring slots. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from .common import free_name, ranked, written

BITS = 5
SHARDS = 24


def measure(df: DataFrame, name: str) -> Column | None:
    """A number that grows with the column's values; None for kinds that are compared as text."""
    kind, value = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return value.cast("long")
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(value.cast("timestamp"))
    return None


def number_cuts(df: DataFrame, dims: list[str], bits: int) -> dict[str, list]:
    """2 ** bits - 1 quantiles of each of the columns, in one pass."""
    if not dims:
        return {}
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    row = df.agg(*(F.percentile_approx(d, F.array(*map(F.lit, shares)), 10_000).alias(d) for d in dims)).first()
    return {d: row[d] or [] for d in dims}


def text_cuts(df: DataFrame, name: str, bits: int) -> list[str]:
    """At most 2 ** bits - 1 of the column's values (one may stand more than once), at which the rows' order
    by it is cut into about equal parts. Distinct values are counted (combined map side), range-partitioned and counted up within
    their partitions; partitions meet as one row each."""
    counted = df.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    placed = written(counted.repartitionByRange("v").withColumn("part", F.spark_partition_id()), "values")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("part").agg(F.sum("n").alias("rows")).select(             # a row per partition
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"), F.sum("rows").over(Window.partitionBy()).alias("total"))
    inside = F.sum("n").over(Window.partitionBy("part").orderBy("v")) - F.col("n")
    cell = F.floor((F.col("start") + F.col("inside")) * (1 << bits) / F.col("total"))
    rows = (placed.withColumn("inside", inside).join(F.broadcast(starts), "part").select("v", cell.alias("cell"))
            .where("cell > 0").groupBy("cell").agg(F.min("v").alias("v")))
    cuts, cell = [], 0
    for r in sorted(rows.collect(), key=lambda r: r["cell"]):                          # < 2 ** bits rows
        cuts += [r["v"]] * (r["cell"] - cell)                                           # a cut for each cell that ends there
        cell = r["cell"]
    return cuts


def cells(df: DataFrame, dims: list[str], bits: int = BITS) -> DataFrame:
    """``df`` with coordinates 0 .. 2 ** bits - 1 in place of ``dims`` (numbers or strings): the number of
    cuts at or below the value; null 0."""
    texts = [d for d in dims if isinstance(df.schema[d].dataType, T.StringType)]
    cuts = number_cuts(df, [d for d in dims if d not in texts], bits) | {d: text_cuts(df, d, bits) for d in texts}

    def below(d: str) -> Column:
        if not cuts[d]:
            return F.lit(0).cast("long")
        return F.coalesce(F.size(F.filter(F.array(*map(F.lit, cuts[d])), lambda c: c <= F.col(d))), F.lit(0)).cast("long")
    return df.withColumns({d: below(d) for d in dims})


def curve_index(df: DataFrame, dims: list[str], name: str, bits: int = BITS) -> DataFrame:
    """``df`` with the Hilbert index of the coordinates ``dims`` (long, ``bits`` bits each) as ``name``.
    The coordinates are turned level by level into the index's transposed bits, then interleaved."""
    x = [f"_x{i}" for i in range(len(dims))]
    df = df.withColumns({a: F.col(d) for a, d in zip(x, dims, strict=True)})
    for level in range(bits - 1, 0, -1):                      # undo the turns of the larger cells
        q, p = 1 << level, (1 << level) - 1
        for i, a in enumerate(x):
            set_ = F.col(a).bitwiseAND(q) != 0
            t = F.col(x[0]).bitwiseXOR(F.col(a)).bitwiseAND(p)
            new = {x[0]: F.when(set_, F.col(x[0]).bitwiseXOR(F.lit(p))).otherwise(F.col(x[0]).bitwiseXOR(t))}
            if i:
                new[a] = F.when(set_, F.col(a)).otherwise(F.col(a).bitwiseXOR(t))
            df = df.withColumns(new)
    for i in range(1, len(x)):                                # Gray code
        df = df.withColumn(x[i], F.col(x[i]).bitwiseXOR(F.col(x[i - 1])))
    t = F.lit(0).cast("long")
    for level in range(bits - 1, 0, -1):
        t = t.bitwiseXOR(F.when(F.col(x[-1]).bitwiseAND(1 << level) != 0, F.lit((1 << level) - 1)).otherwise(F.lit(0)))
    df = df.withColumn("_t", t)
    index = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for a in x:
            one = F.shiftright(F.col(a).bitwiseXOR(F.col("_t")), bit).bitwiseAND(1)
            index = F.shiftleft(index, 1).bitwiseOR(one)
    return df.withColumn(name, index).drop(*x, "_t")


def _placed(docs: DataFrame, dims: list[str], text: str, key: str, n: int, keep: list[str]) -> DataFrame:
    """Per row: _key, _size, _crc, curve, _shard, _slot, and the columns ``keep`` (as _c0, _c1, ...)."""
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8
    crc = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    own = [f"_d{i}" for i in range(len(dims))]
    # the row's size stands for its text among the dimensions
    values = {o: size if d == text else measure(docs, d) for o, d in zip(own, dims, strict=True)}
    values = {o: F.col(f"`{d}`").cast("string") if v is None else v for (o, v), d in zip(values.items(), dims, strict=True)}
    kept = [f"_c{i}" for i in range(len(keep))]
    rows = docs.select(F.col(key).alias("_key"), size.alias("_size"), crc.alias("_crc"), *(v.alias(o) for o, v in values.items()),
                       *(F.col(f"`{c}`").alias(o) for o, c in zip(kept, keep, strict=True)))
    placed = curve_index(cells(rows, own), own, "curve")
    order = [F.col(c) for c in ("curve", "_key", "_crc", "_size")]
    placed = ranked(placed.select("_key", "_size", "_crc", "curve", *kept), order, "_rank")
    total = placed.agg(F.count(F.lit(1)).alias("_total"))                      # one row
    at = placed.join(F.broadcast(total), F.lit(True))
    first = F.expr(f"(_shard * _total + {n - 1}) div {n}")                     # least rank of the shard
    return at.withColumn("_shard", F.expr(f"(_rank * {n}) div _total")).withColumn("_slot", F.col("_rank") - first)


def shards(docs: DataFrame, dims: list[str], text: str = "text", key: str = "doc_id", n: int = SHARDS) -> DataFrame:
    """Per row: key, size, text_crc32, law, shard, slot, grown_shard, and its index on the curve."""
    return _placed(docs, dims, text, key, n, []).select(
        F.col("_key").alias(key), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
        F.lit("rows").alias("law"), F.col("_shard").cast("int").alias("shard"),
        F.col("_slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve")


def write_shards(docs: DataFrame, dims: list[str], path: str, text: str = "text", key: str = "doc_id", n: int = SHARDS,
                 file_rows: int = 1_000_000) -> None:
    """Write ``docs`` in folders shard=<k>: files of at most ``file_rows`` rows along the curve, whose
    column statistics cover few values of each dimension, so a filter on any of them skips most."""
    rows = _placed(docs, dims, text, key, n, docs.columns)
    out = free_name(docs, "shard")
    placed = rows.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)), F.col("_shard").cast("int").alias(out),
                         F.floor(F.col("_slot") / file_rows).alias("_file"), F.col("_slot").alias("_at"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (placed.repartitionByRange(parts, out, "_file").sortWithinPartitions(out, "_at").drop("_file", "_at")
     .write.option("maxRecordsPerFile", file_rows).partitionBy(out).parquet(path))
