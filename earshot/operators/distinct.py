"""Several exact distinct counts per group, with sums beside them, without tripling the rows.

Spark plans ``count(DISTINCT a), count(DISTINCT b)`` by an ``Expand`` ahead of the shuffle: each row is
shuffled once per distinct column and once more for the sums. Here the rows are shuffled once, by the
group's key. A task then groups them by (key, all distinct columns), deals each result out to one
row per distinct column, groups these by (key, column, value) and counts, all without another exchange.

That puts a group into one task, so groups that hold many rows are told apart first, where the input
is large: one pass over the key (a heavy-hitter sketch per task, one row each) names the keys that
may hold more than ``HOT_ROWS`` rows and one in ``HOT_SHARE`` of all. Their rows are grouped by
(key, column, value) across all tasks, with partial sums before each shuffle. Which keys are named
changes where the work is done, not the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import input_bytes

HOT_ROWS, HOT_SHARE = 100_000, 1000
SKETCH_KEYS, SKETCH_ITEMS = 1000, 10_000       # keys reported; keys followed (errors below rows / items)
ONE_TASK = 64 << 20                            # bytes of input that a single task may well read


def hot_keys(df: DataFrame, keys: list[str]) -> list[int]:
    """Hashes of the keys that may hold many rows: at most ``SKETCH_KEYS``, none in a small input."""
    if input_bytes(df) <= ONE_TASK:
        return []
    top = F.call_function("approx_top_k", F.xxhash64(*keys), F.lit(SKETCH_KEYS), F.lit(SKETCH_ITEMS))
    row = df.agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    least = max(HOT_ROWS, row["n"] / HOT_SHARE)
    return [t["item"] for t in row["top"] or [] if t["count"] >= least]


def _grouped(df: DataFrame, by: list[str], sums: list[Column]) -> DataFrame:
    return df.groupBy(*by).agg(*sums) if sums else df.select(*by).distinct()


def _counted(rows: DataFrame, keys: list[str], distinct: dict[str, str], totals: dict[str, Column]) -> DataFrame:
    """One row per key, by the groupings of the module's notes; an exchange of ``rows`` by the keys serves
    them all, without one each has its own."""
    columns = list(distinct.values())
    own = _grouped(rows, [*keys, *columns], [c.alias(f"_{a}") for a, c in totals.items()])
    dealt = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), *(
        (F.col(c) if k == i else F.lit(None).cast(rows.schema[c].dataType)).alias(f"v{k}") for k, c in enumerate(columns)),
        *((F.col(f"_{a}") if i == 0 else F.lit(None).cast("bigint")).alias(a) for a in totals)) for i in range(len(columns)))))
    values = [f"v{k}" for k in range(len(columns))]
    once = _grouped(own.select(*keys, dealt.alias("_d")).select(*keys, "_d.*"), [*keys, "i", *values],
                    [F.sum(a).alias(a) for a in totals])
    return once.groupBy(*keys).agg(*(F.count(v).alias(name) for v, name in zip(values, distinct, strict=True)),
                                   *(F.sum(a).alias(a) for a in totals))


def distinct_totals(df: DataFrame, keys: list[str], distinct: dict[str, str], totals: dict[str, Column],
                    hot: list[int] | None = None) -> DataFrame:
    """(keys, distinct counts by name, totals by name) of the rows whose keys are all present.

    ``distinct``: name -> column counted without repeats (NULL isn't counted); ``totals``: name -> an
    additive aggregate of whole numbers (a count or a sum). ``hot``: hashes of keys with many rows,
    looked for if None.
    """
    known = df
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    hot = hot_keys(known, keys) if hot is None else hot
    few = known.where(~F.xxhash64(*keys).isin(hot)) if hot else known
    out = _counted(few.repartition(*keys), keys, distinct, totals)
    if hot:
        out = out.unionByName(_counted(known.where(F.xxhash64(*keys).isin(hot)), keys, distinct, totals))
    return out
