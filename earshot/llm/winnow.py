"""Document fingerprints by winnowing, in column expressions.

Tokens are lower-case runs of at most 16 characters between white space (a character of a
script without spaces is a token). Every k consecutive tokens have a Karp-Rabin hash (built by
doubling: the hash of 2n tokens from two of n), every w consecutive hashes give up their
minimum, the rightmost of equal ones, and a minimum that several windows share is kept once,
with its position. Texts that share a run of k + w - 1 tokens share a fingerprint there.

``edited`` pairs each document with the next one in descending key order: documents are cut
into key ranges at quantiles, each range is one window partition, and the document at a cut is
copied into the range above it, so one exchange of the texts is all.

Null text is empty; an empty text has an empty fingerprint, and two such are alike (1.0).
Texts of fewer than k tokens have one hash of all; of fewer than w hashes, one minimum. Null
keys are the smallest; rows that share a key are ordered by their text. Extra columns are
ignored. A single row is its own next one; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

K, W = 4, 8             # tokens in a hash, hashes in a window; powers of two
PRIME, BASE = (1 << 31) - 1, 1_000_003
_LAST = (1 << 31) - 1   # positions count down from here, so that the rightmost of equal hashes is least
#: Scripts written without spaces.
_SINGLE = "\\u0E00-\\u0EFF\\u1000-\\u109F\\u1780-\\u17FF\\u2E80-\\u9FFF\\uAC00-\\uD7AF\\uF900-\\uFAFF"
_TOKEN = f"[{_SINGLE}]|[^\\s{_SINGLE}]{{1,16}}"


def _pairs(values: str, apart: int, both) -> Column:
    """``both(v[i], v[i + apart])`` for every i; empty if there are not so many values."""
    n = F.greatest(F.size(values) - apart, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(1), n), F.slice(values, F.lit(apart + 1), n), both)


def _joined(power: int):
    """Hash of two neighbouring runs of tokens; ``power``: the base to the length of the second."""
    return lambda a, b: (a * power + b) % PRIME


def fingerprinted(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the array ``name``: hash * 2 ** 32 + countdown of the position, by position."""
    keep, v = df.columns, f"_{name}"
    tokens = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(_TOKEN), F.lit(0))
    df = df.withColumn(v, F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(PRIME))))
    all_ = F.aggregate(v, F.lit(0).cast("long"), lambda a, x: (a * BASE + x) % PRIME)
    df = df.withColumn(f"{v}_all", F.when((F.size(v) > 0) & (F.size(v) < K), F.array(all_))
                       .otherwise(F.array().cast("array<bigint>")))
    n = 1
    while n < K:
        df = df.withColumn(v, _pairs(v, n, _joined(pow(BASE, n, PRIME))))
        n *= 2
    df = df.withColumn(v, F.concat(v, f"{v}_all"))            # one of the two is empty
    df = df.withColumn(v, F.transform(v, lambda h, i: F.shiftleft(h, 32) + (_LAST - i)))
    df = df.withColumn(f"{v}_all", F.when((F.size(v) > 0) & (F.size(v) < W), F.array(F.array_min(v)))
                       .otherwise(F.array().cast("array<bigint>")))
    n = 1
    while n < W:
        df = df.withColumn(v, _pairs(v, n, lambda a, b: F.least(a, b)))
        n *= 2
    return df.select(*keep, F.array_distinct(F.concat(v, f"{v}_all")).alias(name))


def as_text(values: Column) -> Column:
    """``hash:position`` of each kept minimum, comma-joined; hash in hexadecimal."""
    return F.array_join(F.transform(values, lambda v: F.concat_ws(
        ":", F.lower(F.hex(F.shiftright(v, 32))), (F.lit(_LAST) - v.bitwiseAND((1 << 32) - 1)).cast("string"))), ",")


def hashes(values: Column) -> Column:
    return F.array_distinct(F.transform(values, lambda v: F.shiftright(v, 32)))


def likeness(a: str, b: str) -> Column:
    """Share of the hashes (arrays without repeats) that two fingerprints have in common, 0 to 1."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / both)


def _ranges(docs: DataFrame, parts: int) -> DataFrame:
    """``docs`` (_id long, _text) with _range and _copy: 0 for the row itself, 1 for its copy at the
    low end of the range above, 2 for the copy of the greatest behind the least."""
    shares = [i / parts for i in range(1, parts)] + [1.0]
    found = docs.agg(F.percentile_approx("_id", F.array(*map(F.lit, shares)), 100 * parts).alias("c"),
                     F.max("_id").alias("top")).first()
    cuts = sorted({*(found["c"] or []), found["top"] if found["top"] is not None else 0})
    bounds, steps = F.array(*map(F.lit, cuts)).cast("array<bigint>"), [1 << i for i in range(len(cuts).bit_length())][::-1]
    # binary search: the number of cuts below the key
    at = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda pos, s: F.when(
        F.get(bounds, pos + s - 1) < F.col("_id"), pos + s).otherwise(pos))
    placed = docs.withColumn("_at", at)
    last = len(cuts) - 1
    own = F.struct(F.col("_at").alias("_range"), F.lit(0).alias("_copy"))
    copy = F.struct(F.when(F.col("_at") == last, 0).otherwise(F.col("_at") + 1).alias("_range"),
                    F.when(F.col("_at") == last, 2).otherwise(1).alias("_copy"))
    to = F.when(F.get(bounds, F.col("_at")) == F.col("_id"), F.array(own, copy)).otherwise(F.array(own))
    return placed.withColumn("_to", F.explode(to)).select("*", "_to.*").drop("_to", "_at")


def edited(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, n_chars, digest of the edited text, both fingerprints, likeness of the
    fingerprint to the edited text's and to the next document's.

    The edited text ends in the next document's beginning: the last floor(n / 2) of its n code
    points give way to the first as many (or all) of the next text."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("_text"))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = Window.partitionBy("_range").orderBy("_copy", F.desc("_id"), "_text")
    rows = _ranges(rows, parts).withColumn("_next", F.lead("_text").over(order))
    n, cut = F.length("_text"), F.floor(F.length("_text") / 2).cast("int")
    rows = rows.withColumn("_edited", F.concat(F.substring("_text", F.lit(1), n - cut),
                                               F.substring(F.coalesce("_next", F.lit("")), F.lit(1), cut)))
    rows = rows.withColumns({"_n": n.cast("long"), "_sha": F.sha2(F.col("_edited").cast("binary"), 256)})
    rows = fingerprinted(rows, "_text", "_fp")
    rows = fingerprinted(rows, "_edited", "_fe").drop("_edited", "_next")
    rows = rows.withColumns({"_h": hashes(F.col("_fp")), "_he": hashes(F.col("_fe"))})
    rows = rows.withColumn("_hn", F.lead("_h").over(order)).where("_copy = 0")
    return rows.select(F.col("_key").alias(key), F.col("_n").alias("n_chars"), F.col("_sha").alias("edited_sha256"),
                       as_text(F.col("_fp")).alias("fingerprint"), as_text(F.col("_fe")).alias("edited_fingerprint"),
                       likeness("_h", "_he").alias("near_edited"), likeness("_h", "_hn").alias("near_next"))
