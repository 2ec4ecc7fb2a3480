"""Filter interaction audit: what each filter would do at each place of every filter order.

Every document fails a set of filters, its mask. A mask (with the document's two labels) maps to
one wide integer: 64-bit fields, six for each of the steps of all orders, hold what a document
of that mask does there. The sum of these integers over a part's documents holds all counts of
the part at once; a field is as wide as a long, so no count can carry into the next field. Tasks
sum their own documents, sums are added in two levels, and a part's last sum is unpacked into rows.

Null text: empty. A document without an id is never a copy of another, nor is another its copy;
rows that share an id and a text are no copies of each other, as neither id is smaller. Several
label rows of one id count if any of them does. A null part is the empty string. An empty table
has no parts, so no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import map_arrow, small_batches, written
from pyspark.sql import types as T

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
COPY, GOOD, TOXIC = 1 << 4, 1 << 5, 1 << 6         # bits of a code beside the mask's A to D
FIELD = 8                                          # bytes of a field
WIDTH = FIELD * len(COUNTS) * len(FILTERS) * len(ORDERS)
PARTS = 256                                        # sums a task holds before it passes them on
SALTS = 64                                         # first-level sums of one part
_CAPITALS, _MARKS = bytes(range(65, 91)), set(b"#$%&*|")


def failures(text: str | None) -> int:
    """Mask of the filters A to D that a text fails."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()                           # bytes are cut at \x20 and \x09-\x0D alone
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    return ((len(words) < 100) | (100 * len(set(words)) < 80 * len(words)) << 1
            | (100 * capitals > 10 * len(text or "")) << 2 | (not _MARKS.isdisjoint(data)) << 3)


@cache
def outcomes(code: int) -> int:
    """The wide integer of one document with these failures and labels."""
    mask = code & (1 << len(FILTERS)) - 1
    fields = np.zeros((len(ORDERS), len(FILTERS), len(COUNTS)), "<u8")
    for order, steps in zip(ORDERS, fields, strict=True):
        gone = False
        for step, name in zip(steps, order, strict=True):
            own = 1 << FILTERS.index(name)
            fails = bool(mask & own)
            here = fails and not gone
            step[:] = (not (gone or fails), here, fails and gone, mask == own,
                       here and bool(code & GOOD), here and bool(code & TOXIC))
            gone |= fails
    return int.from_bytes(fields.tobytes(), "little")


def unpacked(total: int) -> np.ndarray:
    """(orders, steps, counts) of a sum of ``outcomes``."""
    return np.frombuffer(total.to_bytes(WIDTH, "little"), "<u8").reshape(len(ORDERS), len(FILTERS), len(COUNTS))


def _batch(parts: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.string()),
                                       pa.array([n.to_bytes(WIDTH, "little") for n in parts.values()], pa.binary())],
                                      names=["part", "total"])


def _held(pairs: Iterable[tuple[str, int]]) -> Iterator[pa.RecordBatch]:
    """Sums by part; no more than ``PARTS`` of them are held at a time."""
    held: dict[str, int] = {}
    for part, n in pairs:
        if part not in held and len(held) >= PARTS:
            yield _batch(held)
            held = {}
        held[part] = held.get(part, 0) + n
    if held:
        yield _batch(held)


def _first_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def pairs():
        for b in batches:
            counted = pa.table({"part": b.column(0), "code": b.column(1)}).group_by(["part", "code"]).aggregate([([], "count_all")])
            for row in counted.to_pylist():
                yield row["part"], row["count_all"] * outcomes(row["code"])
    return _held(pairs())


def _more_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _held((p.as_py(), int.from_bytes(t.as_py(), "little")) for b in batches for p, t in zip(b.column(0), b.column(1)))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole sums, by part one after the other -> a row for each step of each order."""
    def table(part: str, total: int) -> pa.RecordBatch:
        counts = unpacked(total).astype(np.int64)
        letters = np.array([list(o) for o in ORDERS])
        removed = {f: int(counts[:, :, COUNTS.index("removed")][letters == f].sum()) for f in FILTERS}
        steps = len(ORDERS) * len(FILTERS)
        arrays = [pa.array([part] * steps, pa.string()), pa.array([o for o in ORDERS for _ in FILTERS], pa.string()),
                  pa.array(list(range(1, len(FILTERS) + 1)) * len(ORDERS), pa.int32()),
                  *(pa.array(counts[:, :, k].ravel()) for k in range(len(COUNTS))),
                  pa.array([removed[f] for o in ORDERS for f in o], pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=["part", "filter_order", "step", *COUNTS, "shapley"])
    part, total = None, 0
    for b in batches:
        for p, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if part is not None and p != part:
                yield table(part, total)
                total = 0
            part, total = p, total + int.from_bytes(t, "little")
    if part is not None:
        yield table(part, total)


def judged(docs: DataFrame, text: str = "text", key: str = "doc_id", part: str = "lang") -> DataFrame:
    """(id, part, mask, digest): the mask of all filters, the copies found table-wide.

    Of each text (by its 128-bit digest) the smallest id is an aggregate that combines map side.
    Rows find it by digest *and* id, so a text that a third of all rows share is no hot key."""
    def make():
        def f(texts):
            values = texts.to_pylist()
            return (pa.array([failures(t) for t in values], pa.int32()),
                    pa.array([xxhash.xxh3_128_digest((t or "").encode("utf-8", "surrogatepass")) for t in values], pa.binary()))
        return f
    src = docs.select(F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                      F.col(text).alias("text"))
    seen = written(map_arrow(src, ["text"], [T.StructField("mask", T.IntegerType()), T.StructField("digest", T.BinaryType())],
                             make, keep=["id", "part"]), "masks")
    first = seen.where("id is not null").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    return (seen.join(first.hint("merge"), ["digest", "id"], "left")
            .select("id", "part", "digest", (F.col("mask") + F.when(copy, COPY).otherwise(0)).alias("mask")))


def audit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", part: str = "lang") -> DataFrame:
    """One row per part, filter order and step, with the document counts of that step."""
    spark = docs.sparkSession
    small_batches(spark)
    marks = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, GOOD).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, TOXIC).otherwise(0)).alias("toxic"))
    codes = judged(docs, text, key, part).join(marks.hint("merge"), "id", "left").select(
        "part", (F.col("mask") + F.coalesce("good", F.lit(0)) + F.coalesce("toxic", F.lit(0))).alias("code"))
    sums = codes.mapInArrow(_first_sums, "part string, total binary")
    sums = sums.repartition("part", F.pmod(F.spark_partition_id(), F.lit(SALTS))).mapInArrow(_more_sums, sums.schema)
    sums = sums.repartition("part").sortWithinPartitions("part")
    fields = ", ".join(f"{c} long" for c in [*COUNTS, "shapley"])
    return sums.mapInArrow(_rows, f"part string, filter_order string, step int, {fields}")
