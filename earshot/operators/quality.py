"""Declared constraints turned into checks (the warehouse declares but does not enforce them).

Each check is one aggregate, combined map side, so its shuffle carries partial
counts, not rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..schemas import TableContract

PK_COLUMNS = ["table_name", "key_column", "total_rows", "null_keys", "duplicate_keys",
              "duplicate_rows"]
FK_COLUMNS = ["fk_column", "ref_table", "null_rows", "orphan_keys", "orphan_rows"]
COLUMN_CHECK_COLUMNS = ["table_name", "column_name", "check_name", "violations"]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def check_pk(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per table: rows, NULL keys, keys seen more than once and the surplus rows."""
    out = []
    for name, (df, key) in tables.items():
        per_key = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
        out.append(per_key.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total_rows"),
            F.coalesce(F.sum(F.when(F.col("_k").isNull(), F.col("_n"))), F.lit(0))
             .cast("bigint").alias("null_keys"),
            F.count_if(F.col("_k").isNotNull() & (F.col("_n") > 1)).alias("duplicate_keys"),
            F.coalesce(F.sum(F.when(F.col("_k").isNotNull() & (F.col("_n") > 1), F.col("_n") - 1)),
                       F.lit(0)).cast("bigint").alias("duplicate_rows"),
        ).select(F.lit(name).alias("table_name"), F.lit(key).alias("key_column"),
                 "total_rows", "null_keys", "duplicate_keys", "duplicate_rows"))
    return _union(out)


def check_fk(fact: DataFrame, refs: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Orphans per foreign key: fact keys absent from the referenced dimension.

    ``refs``: fk column -> (dimension, its key column, table name). The fact is read once and
    reduced to one row per (foreign key, value) with its row count, combined map side, so the
    join sees distinct keys only, never the fact's rows (the dimension side is deduplicated,
    so a key repeated in it cannot multiply counts).
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(fk).alias("fk_column"), F.col(fk).cast("bigint").alias("_k"))
                                for fk in refs]))
    per_key = (fact.select(pairs.alias("_p")).groupBy("_p.fk_column", "_p._k")
               .agg(F.count(F.lit(1)).alias("_n")))
    known = _union([dim.select(F.lit(fk).alias("fk_column"), F.col(pk).cast("bigint").alias("_k"))
                    for fk, (dim, pk, _) in refs.items()])
    known = known.where(F.col("_k").isNotNull()).distinct().withColumn("_found", F.lit(True))
    orphan = F.col("_k").isNotNull() & F.col("_found").isNull()
    counts = per_key.join(known, ["fk_column", "_k"], "left").groupBy("fk_column").agg(
        F.coalesce(F.sum(F.when(F.col("_k").isNull(), F.col("_n"))), F.lit(0)).cast("bigint").alias("null_rows"),
        F.count_if(orphan).alias("orphan_keys"),
        F.coalesce(F.sum(F.when(orphan, F.col("_n"))), F.lit(0)).cast("bigint").alias("orphan_rows"))
    # a row per reference, also for a fact without rows
    names = F.explode(F.array(*[F.struct(F.lit(fk).alias("fk_column"), F.lit(ref).alias("ref_table"))
                                for fk, (_, _, ref) in refs.items()]))
    listed = fact.sparkSession.range(1).select(names.alias("_r")).select("_r.*")
    zero = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("null_rows", "orphan_keys", "orphan_rows")]
    return listed.join(counts, "fk_column", "left").select("fk_column", "ref_table", *zero)


def check_columns(df: DataFrame, contract: TableContract) -> DataFrame:
    """NOT NULL and VARCHAR(n) violations of every constrained column, in one scan.

    Result: one row per (column, check) with its violation count.
    """
    aggs, labels = [], []
    for c in contract.columns:
        if c.name not in df.columns:
            continue
        if not c.nullable:
            labels.append((c.name, "not_null"))
            aggs.append(F.count_if(F.col(c.name).isNull()).alias(f"{c.name}__not_null"))
        if c.max_len is not None:
            labels.append((c.name, f"max_len_{c.max_len}"))
            aggs.append(F.count_if(F.char_length(F.col(c.name)) > F.lit(c.max_len))
                        .alias(f"{c.name}__max_len_{c.max_len}"))
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{n}', '{chk}', `{n}__{chk}`" for n, chk in labels)
    return wide.selectExpr(f"stack({len(labels)}, {pairs}) AS (column_name, check_name, violations)") \
        .select(F.lit(contract.name).alias("table_name"), "column_name", "check_name",
                F.col("violations").cast("bigint").alias("violations"))


def check_domain(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Values outside the allowed set (NULL is a NOT NULL matter, not a domain one)."""
    return (df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
            .where(F.col("value").isNotNull() & ~F.col("value").isin(*allowed))
            .select(F.lit(column).alias("column_name"), "value", "rows"))
