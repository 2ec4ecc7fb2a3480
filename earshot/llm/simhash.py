"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components.

Of b blocks of a fingerprint, two fingerprints within d bits share at least b - d. So every
choice of b - d blocks makes a key, close pairs meet under at least one, and all pairs under
a key are verified by their Hamming distance. b grows with the number of different
fingerprints, so that a key holds few by chance.

Skew: equal fingerprints are one row before the join. A key with more than ``TILE``
fingerprints is cut into tiles, each pair of tiles a group of its own, so no task holds more
than two tiles. Of a group only a spanning forest of its links is written, never all pairs.

Null text: no words, like an empty one. Fewer words than a shingle: the words are one
shingle; none: fingerprint 0. Equal rows get equal results; rows that share a doc_id keep
their own fingerprint. Extra columns are ignored by ``near_duplicates`` and kept by
``deduplicated``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from .common import free_name, map_arrow, small_batches, written
from .graph import components

SHINGLE, DISTANCE, SEED = 4, 4, 42
TILE = 1024
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_CHUNK = 1 << 16        # shingles hashed at a time


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the text's word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))[:len(words) - size + 1].tolist()
    stops = ends[size - 1:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(begins), _CHUNK):
        h = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(begins[k:k + _CHUNK], stops[k:k + _CHUNK],
                                                                    strict=True)), dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(begins)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """(key, fp): the fingerprint as a signed long."""
    def make():
        def f(texts):
            fp = np.array([fingerprint(t, shingle) for t in texts.to_pylist()], np.uint64)
            return (pa.array(fp.view(np.int64)),)
        return f
    return map_arrow(docs, [text], [T.StructField("fp", T.LongType())], make, keep=[key])


def block_masks(n: int, distance: int) -> list[int]:
    """Bit masks (signed) of the keys for ``n`` different fingerprints."""
    blocks = distance + 2
    while blocks < 2 * distance and n >> (64 * (blocks - distance) // blocks - 3):
        blocks += 1
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [(1 << cuts[i + 1]) - (1 << cuts[i]) for i in range(blocks)]
    masks = (sum(c) for c in combinations(parts, blocks - distance))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def forest(fp: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Index pairs: a spanning forest of the links among different fingerprints ``fp``."""
    links, rest = [], np.arange(len(fp))
    while len(rest):
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            near = np.bitwise_count(fp[front[:64], None] ^ fp[rest][None, :]) <= distance
            hit = near.any(axis=0)
            new = rest[hit]
            links += zip(front[near[:, hit].argmax(axis=0)].tolist(), new.tolist(), strict=True)
            front, rest = np.concatenate((front[64:], new)), rest[~hit]
    return links


def _group_links(distance: int):
    """Arrow batches of (key, i, j, fp), sorted by group -> batches of links (u, v)."""
    def groups(key: np.ndarray, fp: np.ndarray, tiles: np.ndarray):
        cuts = np.flatnonzero((key[1:] != key[:-1]) | (tiles[1:] != tiles[:-1]).any(axis=1)) + 1
        begins, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(key)]))
        size = ends - begins
        few = size <= 8
        where = np.flatnonzero(few & (size > 1))
        for step in range(1, 8):                        # small groups: all at once
            where = where[size[where] > step]
            if not len(where):
                break
            for off in range(8 - step):
                g = where[size[where] > off + step]
                a, b = fp[begins[g] + off], fp[begins[g] + off + step]
                ok = np.bitwise_count(a ^ b) <= distance
                yield a[ok], b[ok]
        for g in np.flatnonzero(~few):
            own = np.unique(fp[begins[g]:ends[g]])
            if links := forest(own, distance):
                at = np.array(links)
                yield own[at[:, 0]], own[at[:, 1]]

    def run(batches):
        held: list[tuple] = []

        def emit(parts):
            key, fp, tiles = (np.concatenate([p[k] for p in parts]) for k in range(3))
            for a, b in groups(key, fp, tiles):
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                                     names=["u", "v"])
        for b in batches:
            if not b.num_rows:
                continue
            key, i, j, fp = (b.column(c).to_numpy() for c in range(4))
            tiles, fp = np.stack((i, j), axis=1), fp.view(np.uint64)
            last = (key == key[-1]) & (tiles == tiles[-1]).all(axis=1)
            first_of_last = len(key) - int(last.sum())
            if first_of_last:
                yield from emit([*held, (key[:first_of_last], fp[:first_of_last], tiles[:first_of_last])])
                held = []
            elif held and (held[-1][0][-1] != key[0] or (held[-1][2][-1] != tiles[0]).any()):
                yield from emit(held)
                held = []
            held.append((key[first_of_last:], fp[first_of_last:], tiles[first_of_last:]))
        if held:
            yield from emit(held)
    return run


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(u, v): a spanning forest, per block key, of the pairs of different fingerprints in
    ``fps`` (column fp, distinct) within ``distance`` bits. It connects what the pairs connect."""
    spark = fps.sparkSession
    masks = block_masks(fps.count(), distance)
    keyed = fps.select("fp", F.explode(F.array(*(
        F.xxhash64(F.lit(c), F.col("fp").bitwiseAND(F.lit(m))) for c, m in enumerate(masks)))).alias("key"))
    hot = written(keyed.groupBy("key").count().where(F.col("count") > TILE)
                  .select("key", F.ceil(F.col("count") / TILE).cast("int").alias("tiles")), "hot")
    n = hot.count()
    if n:
        keyed = keyed.join(F.broadcast(hot) if n <= 1_000_000 else hot, "key", "left")
        own = F.pmod(F.xxhash64("fp", "key"), F.coalesce("tiles", F.lit(1))).cast("int")
        keyed = (keyed.withColumn("own", own)
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("tiles", F.lit(1)) - 1)))
                 .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp"))
    else:
        keyed = keyed.select("key", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp")
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    grouped = keyed.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    return grouped.mapInArrow(_group_links(distance), "u long, v long")


def _rooted(marked: DataFrame, first, distance: int) -> DataFrame:
    """(fp, root, first) for every fingerprint of ``marked``: the root of its group, and the
    aggregate ``first`` of its rows. Equal fingerprints are one row, so a hot one is no hot key."""
    fps = written(marked.groupBy("fp").agg(first.alias("first")), "distinct")
    roots = components(links(fps.select("fp"), distance))
    linked = fps.join(roots, fps["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    return written(linked, "linked")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE,
                    distance: int = DISTANCE) -> DataFrame:
    """(key, fp, component): component is the smallest key among the documents that links of at
    most ``distance`` bits reach."""
    marked = written(fingerprints(docs, text, key, shingle), "fingerprints")
    linked = _rooted(marked, F.min(key), distance)
    least = linked.groupBy("root").agg(F.min("first").alias("component"))
    labels = written(linked.join(least, "root").select("fp", "component"), "labels")
    return marked.join(labels, "fp").select(key, "fp", "component")


def deduplicated(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE,
                 distance: int = DISTANCE, unique_keys: bool = True) -> DataFrame:
    """One row of each group stays: the one with the smallest ``key`` (null behind all others), then
    the smallest hash of the row. Rows are told apart by a number given in a written table, so groups
    without a key stay apart. With ``unique_keys``, of the rows that stay and share a key that isn't
    null only one does; without, groups that share a key keep a row each."""
    row = free_name(docs, "_row")
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    content = F.xxhash64(*(F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()))
    first = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), content.alias("tie"), F.col(row).alias("row"))
    marked = written(fingerprints(rows.select(F.col(text).alias("text"), first.alias("first")), "text", "first", shingle),
                     "fingerprints")
    stay = _rooted(marked, F.min("first"), distance).groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    if unique_keys:
        stay = stay.groupBy("key", F.when(F.col("none"), F.col("row")).alias("none")).agg(
            F.min(F.struct("tie", "row")).alias("first")).select("first.row")
    stay = written(stay.select(F.col("row").alias("_stays")), "stay")
    # the rows that stay grow with the documents: joined by a shuffle at every size, never broadcast
    own = free_name(rows, "_stays")
    stay = stay.withColumnRenamed("_stays", own).hint("merge")
    return rows.join(stay, F.col(row) == F.col(own), "left_semi").select(*docs.columns)
