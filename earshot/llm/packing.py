"""Packing by patterns: non-negative least squares over a histogram of lengths.

Lengths are counted; from here on only the histogram (at most ``SIZE`` rows) matters to the
plan, so the driver's work is the same for any number of documents. In bins of ``WIDTH``
tokens, all patterns of up to ``DEPTH`` bins that fill a sequence are enumerated, and
non-negative least squares finds how often to repeat each so that their bins add up to the
histogram. Repeats are rounded down, patterns take their pieces as exact lengths, and what
remains is packed best fit, longest first, into the gaps and then into new sequences.

Pieces then learn their place from their global rank by length, a range partitioning that
splits any hot length; the plan is a table of rank intervals (bounded, broadcast).

Null text is empty: one piece with the end id. Repeated rows are packed each for itself.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from .common import map_arrow, ranked, written
from .tokens import VOCABULARY, Encoder

SIZE = 4096
WIDTH = 8
DEPTH = 3


def patterns(bins: int, depth: int) -> np.ndarray:
    """All multisets of up to ``depth`` bins (1 .. bins) that add up to ``bins``; 0 pads."""
    found = [np.array([[bins]])]
    if depth > 1:
        a = np.arange(1, bins // 2 + 1)
        found.append(np.stack((bins - a, a), axis=1))
    if depth > 2:
        b, c = np.triu_indices(bins, 0)
        b, c = c + 1, b + 1                                  # b >= c
        a = bins - b - c
        ok = a >= b
        found.append(np.stack((a[ok], b[ok], c[ok]), axis=1))
    return np.concatenate([np.pad(f, ((0, 0), (0, depth - f.shape[1]))) for f in found])


def nnls(shapes: np.ndarray, target: np.ndarray, weight: np.ndarray, at_once: int = 16, rounds: int = 400) -> np.ndarray:
    """Repeats x >= 0 of each pattern that minimise ``sum(weight * (counts(x) - target) ** 2)``:
    active-set method that lets in up to ``at_once`` patterns of different bins a round."""
    n, bins = len(shapes), len(target)
    root = np.sqrt(weight)
    goal = root * target

    def column(k: int) -> np.ndarray:
        return np.bincount(shapes[k], minlength=bins + 1)[1:] * root

    x, inside, cols = np.zeros(n), [], np.zeros((bins, 0))
    padded = np.zeros(bins + 1)
    for _ in range(rounds):
        rest = goal - cols @ x[inside]
        padded[1:] = rest * root
        gain = padded[shapes].sum(axis=1)
        gain[inside] = 0
        best, used, new = np.argsort(-gain)[:4 * at_once], set(), []
        for k in best.tolist():
            own = set(shapes[k].tolist()) - {0}
            if gain[k] > 1e-9 * max(target.max(), 1) and not own & used and len(new) < at_once:
                used |= own
                new.append(k)
        if not new:
            break
        inside += new
        cols = np.column_stack([cols, *map(column, new)])
        while True:
            s = np.linalg.lstsq(cols, goal, rcond=None)[0]
            if (s > 1e-12).all():
                x[inside] = s
                break
            now, bad = x[inside], s <= 1e-12
            step = np.min(np.where(bad, now / np.maximum(now - s, 1e-300), 1.0))
            now = np.maximum(now + step * (s - now), 0)
            keep = ~((now <= 1e-12) & bad)
            x[inside] = 0
            inside = [k for k, ok in zip(inside, keep.tolist(), strict=True) if ok]
            x[inside] = now[keep]
            cols = cols[:, keep]
        if len(inside) > 2 * bins:
            break
    return x


def plan(histogram: dict[int, int], size: int = SIZE, width: int = WIDTH, depth: int = DEPTH) -> list[tuple[list[tuple[int, int]], int]]:
    """Sequences as (runs of (length, times), repeats); all together hold exactly the histogram."""
    left = {n: c for n, c in histogram.items() if c}
    bins = size // width
    whole = left.pop(size, 0)
    done: list[tuple[list[tuple[int, int]], int]] = [([(size, 1)], whole)] if whole else []
    target = np.zeros(bins)
    members = defaultdict(list)
    for n in sorted(left):
        b = -(-n // width)
        target[b - 1] += left[n]
        members[b].append(n)
    opened: dict[int, list] = defaultdict(list)             # gap -> [runs, repeats]
    if left:
        shapes = patterns(bins, depth)
        shapes = shapes[[all(b == 0 or target[b - 1] for b in s) for s in shapes.tolist()]]
        # short pieces fit any gap, so they weigh less
        weight = np.minimum(np.arange(1, bins + 1) / (bins / 8), 1.0)
        times = np.floor(nnls(shapes, target, weight) + 1e-6).astype(np.int64) if len(shapes) else np.zeros(0, np.int64)

        def take(b: int, most: int, longest: bool) -> tuple[int, int]:
            """A length of bin ``b`` with pieces left, and how many of ``most`` it can give."""
            n = members[b][-1 if longest else 0]
            got = min(left[n], most)
            left[n] -= got
            if not left[n]:
                members[b].remove(n)
            return n, got

        for k in np.argsort(-times).tolist():
            want = int(times[k])
            own = [b for b in shapes[k].tolist() if b]
            while want > 0:
                if any(len(members[b]) == 0 or sum(left[n] for n in members[b]) < own.count(b) for b in own):
                    break
                # one repeat count for which every slot has one exact length
                lens = [members[b][-1 if i % 2 == 0 else 0] for i, b in enumerate(own)]
                can = min([want] + [left[n] // lens.count(n) for n in lens])
                if can == 0:                                  # a length runs out inside one sequence
                    lens = [take(b, 1, i % 2 == 0)[0] for i, b in enumerate(own)]
                    can = 1
                else:
                    for n in lens:
                        left[n] -= can
                    for b in set(own):
                        members[b] = [n for n in members[b] if left[n]]
                opened[size - sum(lens)].append([[(n, 1) for n in lens], can])
                want -= can
    for n in sorted((n for n in left if left[n]), reverse=True):
        count = left[n]
        while count:
            gap = min((g for g in opened if g >= n and opened[g]), default=None)
            if gap is None:
                fit = size // n
                full, rest = divmod(count, fit)
                if full:
                    opened[size - fit * n].append([[(n, fit)], full])
                if rest:
                    opened[size - rest * n].append([[(n, rest)], 1])
                break
            runs, repeats = opened[gap].pop()
            if not opened[gap]:
                del opened[gap]
            fit = gap // n
            full = min(repeats, count // fit)
            if full:
                opened[gap - fit * n].append([[*runs, (n, fit)], full])
                count -= full * fit
            if full < repeats and count and count < fit:
                opened[gap - count * n].append([[*runs, (n, count)], 1])
                full, count = full + 1, 0
            if full < repeats:
                opened[gap].append([runs, repeats - full])
    return done + [(runs, repeats) for gap in sorted(opened) for runs, repeats in opened[gap]]


def intervals(histogram: dict[int, int], made: list[tuple[list[tuple[int, int]], int]]) -> dict[str, np.ndarray]:
    """Rank intervals, in rank order (pieces by length): first rank, repeats, first sequence, offset, length."""
    lengths = sorted(histogram)
    free = dict(zip(lengths, accumulate([0] + [histogram[n] for n in lengths]), strict=False))
    rows, sequence = [], 0
    for runs, repeats in made:
        offset = 0
        for n, times in runs:
            rows.append((free[n], repeats, sequence, offset, n))
            free[n] += repeats * times
            offset += n * times
        sequence += repeats
    rows.sort()
    return dict(zip(("first", "repeats", "sequence", "offset", "length"),
                    np.array(rows, np.int64).reshape(-1, 5).T, strict=True))


def pieces(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = SIZE,
           vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, piece, start, length, ids_crc32) of every whole text, cut only where longer than ``size``."""
    def make():
        encoder = Encoder.shared(vocabulary)

        def f(texts):
            out = []
            for t in texts.to_pylist():
                ids = encoder.ids(t).astype("<u4")
                out.append([{"length": len(p), "crc": zlib.crc32(p.tobytes())}
                            for p in (ids[i:i + size] for i in range(0, len(ids), size))])
            return (out,)
        return f
    kind = T.ArrayType(T.StructType([T.StructField("length", T.LongType()), T.StructField("crc", T.LongType())]))
    cut = map_arrow(docs, [text], [T.StructField("_pieces", kind)], make, keep=[key])
    return (cut.select(key, F.posexplode("_pieces").alias("piece", "_p"))
            .select(key, "piece", (F.col("piece").cast("long") * size).alias("start"),
                    F.col("_p.length").alias("length"), F.col("_p.crc").alias("ids_crc32")))


def packed(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = SIZE, **options) -> DataFrame:
    """The pieces of ``docs`` with sequence_id and offset."""
    cut = written(pieces(docs, text, key, size, **options), "pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}     # <= size rows
    held = cut.sparkSession.sparkContext.broadcast(intervals(histogram, plan(histogram, size)))
    placed = ranked(cut, [F.col("length"), F.col(key), F.col("piece"), F.col("ids_crc32")], "_rank")

    def make():
        t = held.value

        def f(ranks):
            r = ranks.to_numpy()
            i = np.searchsorted(t["first"], r, "right") - 1
            inside = r - t["first"][i]
            return (pa.array(t["sequence"][i] + inside % t["repeats"][i]),
                    pa.array(t["offset"][i] + inside // t["repeats"][i] * t["length"][i]))
        return f
    fields = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    return map_arrow(placed, ["_rank"], fields, make, keep=[key, "piece", "start", "length", "ids_crc32"])
