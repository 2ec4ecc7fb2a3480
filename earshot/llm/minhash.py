"""MinHash near-duplicates: universal hash minima, bands, signature check, full-set check, components.

A document's set holds its distinct word shingles (as 64-bit hashes). ``LANES`` universal hash
functions give its minima, a byte of each is kept as the signature, and runs of ``ROWS`` lanes are
its bands. Two documents of similarity 0.85 share no band with a chance of 6e-9. Documents with
one set are one node before any comparison.

Links are found in three steps, each of which only looks at buckets (documents that share a band)
whose documents are not yet connected:

1. every member with its bucket's first node, a star;
2. members not in one group by that, with a node drawn per bucket;
3. what is left of buckets that still hold several groups, all against all that are not connected, exactly. Rows of a bucket that already
   form its largest connected group are never compared with each other. Tiles of bounded size
   keep a task's rows bounded. Nodes whose signatures are near any not connected node are flagged,
   only these bring their sets, and a tile writes a spanning forest of its links, never all pairs.

So a large group of near copies costs one or two comparisons a document. Work in a bucket stays
quadratic only in documents that have near signatures and yet are not connected; it is spread over
pairs of tiles. Every link is confirmed on full sets. No size leads to dropped rows.

Null or empty text, or one without words: empty set, a component of its own. Fewer words than a
shingle: the words are one shingle. Equal rows get equal results. Rows that share an id keep their
own sets. The component is the smallest id that isn't null (null if there is none), and a row is
kept if that is its own id. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from .common import map_arrow, small_batches, written
from .graph import components

SHINGLE, PERCENT = 5, 85
ROWS, BANDS = 6, 40
LANES = ROWS * BANDS
NEAR = round(LANES * 0.71)          # lanes that agree: 6 deviations below what 0.85 gives
TILE = 512                          # nodes of a tile, fewer where their sets are long
TILE_SHINGLES = 1 << 22
BLOCK = 1 << 14                     # shingles hashed at a time: stays in the processor's cache
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_rng = np.random.default_rng(20240229)
_FACTOR = _rng.integers(0, 1 << 63, LANES, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_SHIFT = _rng.integers(0, 1 << 63, LANES, dtype=np.uint64)


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))[:len(words) - size + 1].tolist()
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.fromiter((digest(joined[s:e]) for s, e in zip(begins, ends[size - 1:].tolist(), strict=True)),
                                 np.uint64, len(begins)))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, LANES) bytes: a byte of each lane's minimum; zeros for an empty set."""
    least = np.full((len(sets), LANES), np.iinfo(np.uint64).max, np.uint64)

    def add(block: np.ndarray, begins: list[int], rows: list[int]) -> None:
        hashed = np.empty_like(block)
        for lane in range(LANES):
            np.multiply(block, _FACTOR[lane], out=hashed)
            np.add(hashed, _SHIFT[lane], out=hashed)
            least[rows, lane] = np.minimum(least[rows, lane], np.minimum.reduceat(hashed, begins))
    held, begins, rows, size = [], [], [], 0
    for row, own in enumerate(sets):
        for k in range(0, len(own), BLOCK):
            piece = own[k:k + BLOCK]
            if size + len(piece) > BLOCK:
                add(np.concatenate(held), begins, rows)
                held, begins, rows, size = [], [], [], 0
            begins.append(size)
            held.append(piece)
            rows.append(row)
            size += len(piece)
    if held:
        add(np.concatenate(held), begins, rows)
    return ((least * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.uint8)


def sketches(docs: DataFrame, text: str, key: str, shingle: int) -> DataFrame:
    """(key, h, n, digest, sig): hash of the text, size and 128-bit digest of the set, signature."""
    fields = [T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("sig", T.BinaryType())]

    def make():
        def f(texts):
            sets = [shingle_hashes(t, shingle) for t in texts.to_pylist()]
            return (pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in signatures(sets)], pa.binary()))
        return f
    src = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    return written(map_arrow(src, ["text"], fields, make, keep=["id", "h"]), "sketches")


def full_sets(docs: DataFrame, known: DataFrame, text: str, key: str, shingle: int) -> DataFrame:
    """(node, members): the set of each node of ``known``, made again from a text that has it."""
    src = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    wanted = known.select("node", F.col("rep.id").alias("rep_id"), F.col("rep.h").alias("rep_h")).hint("merge")
    found = src.join(wanted, F.col("id").eqNullSafe(F.col("rep_id")) & (F.col("h") == F.col("rep_h"))).select("node", "text")

    def make():
        return lambda texts: (pa.array([shingle_hashes(t, shingle).tobytes() for t in texts.to_pylist()], pa.binary()),)
    sets = written(map_arrow(found, ["text"], [T.StructField("members", T.BinaryType())], make, keep=["node"]), "sets")
    if sets.count() > known.count():                 # repeated rows
        sets = written(sets.dropDuplicates(["node"]), "sets")
    return sets


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sets (sorted, distinct) are similar enough."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _pair_filter(columns: tuple[str, str], test: Callable) -> Callable:
    """Arrow batches with u, v and two binary columns -> the (u, v) whose values pass ``test``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.schema.names
            x, y = (b.column(names.index(c)).to_pylist() for c in columns)
            keep = pa.array(test(x, y), pa.bool_())
            yield b.select(["u", "v"]).filter(keep)
    return run


def _near_signatures(x: list[bytes], y: list[bytes]) -> np.ndarray:
    a, b = (np.frombuffer(b"".join(s), np.uint8).reshape(-1, LANES) for s in (x, y))
    return (a == b).sum(axis=1) >= NEAR


def _similar_sets(percent: int) -> Callable:
    return lambda x, y: [linked(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), percent)
                         for p, q in zip(x, y, strict=True)]


def _with_both(pairs: DataFrame, of: DataFrame, column: str) -> DataFrame:
    """``pairs`` (u, v) with ``column`` of both nodes; shuffle joins at every size, which the
    adaptive planner splits at a node with many pairs."""
    a = of.select(F.col("node").alias("u"), F.col(column).alias("a")).hint("merge")
    b = of.select(F.col("node").alias("v"), F.col(column).alias("b")).hint("merge")
    return pairs.join(a, "u").join(b, "v").select("u", "v", "a", "b")


def confirmed(pairs: DataFrame, known: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that pass the signature check and then the check of full sets."""
    near = written(_with_both(pairs, known, "sig").mapInArrow(_pair_filter(("a", "b"), _near_signatures), "u long, v long"), "near")
    return written(_with_both(near, sets, "members").mapInArrow(_pair_filter(("a", "b"), _similar_sets(percent)), "u long, v long"),
                   "links")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Columns of each group (key, i, j) of rows sorted by these: numbers as arrays, binary ones as lists."""
    held: list[pa.RecordBatch] = []

    def emit(parts):
        whole = pa.Table.from_batches(parts)
        return {c: whole.column(c).to_pylist() if pa.types.is_binary(whole.schema.field(c).type) else whole.column(c).to_numpy()
                for c in whole.column_names}
    own = None
    for b in batches:
        if not b.num_rows:
            continue
        tags = np.stack([b.column(b.schema.names.index(c)).to_numpy() for c in ("key", "i", "j")], axis=1)
        cuts = [0, *(np.flatnonzero((tags[1:] != tags[:-1]).any(axis=1)) + 1).tolist(), len(tags)]
        for s, e in zip(cuts, cuts[1:]):
            if held and tuple(tags[s]) != own:
                yield emit(held)
                held = []
            own = tuple(tags[s])
            held.append(b.slice(s, e - s))
    if held:
        yield emit(held)


def _open_pairs(g: dict, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of a group that are not connected, near by size and signature, and meet in this
    band first."""
    sig = np.frombuffer(b"".join(g["sig"]), np.uint8).reshape(-1, LANES)
    i, j, band = int(g["i"][0]), int(g["j"][0]), int(g["band"][0])
    rows, others = np.flatnonzero(g["own"] == i), np.flatnonzero(g["own"] == j)
    found = [], []
    for k in range(0, len(rows), 32):
        r = rows[k:k + 32]
        same = (sig[r][:, None, :] == sig[others][None]).sum(axis=2, dtype=np.int16)
        n, m = g["n"][r][:, None], g["n"][others][None]
        ok = ((same >= NEAR) & (g["root"][r][:, None] != g["root"][others][None])
              & (100 * np.minimum(n, m) >= percent * np.maximum(n, m)))
        if i == j:
            ok &= r[:, None] < others[None]
        x, y = np.nonzero(ok)
        found[0].append(r[x])
        found[1].append(others[y])
    x, y = (np.concatenate(f) if f else np.zeros(0, np.int64) for f in found)
    first = (sig[x] == sig[y]).reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) if len(x) else x
    return x[first == band], y[first == band]


def _flagged(percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches):
            rows = np.unique(np.concatenate(_open_pairs(g, percent)))
            if len(rows):
                yield pa.RecordBatch.from_arrays([pa.array(g[c][rows]) for c in ("key", "i", "j", "band", "own", "node", "root", "n")],
                                                 names=["key", "i", "j", "band", "own", "node", "root", "n"])
    return run


def _forest(percent: int) -> Callable:
    """Links of each group that connect what its similar pairs connect."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches):
            part: dict[int, int] = {}

            def root(x: int) -> int:
                while part.get(x, x) != x:
                    x = part[x]
                return x
            u, v, sets = [], [], [np.frombuffer(m, np.uint64) for m in g["members"]]
            for x, y in zip(*(p.tolist() for p in _open_pairs(g, percent)), strict=True):
                a, b = root(int(g["root"][x])), root(int(g["root"][y]))
                if a != b and linked(sets[x], sets[y], percent):
                    part[max(a, b)] = min(a, b)
                    u.append(int(g["node"][x]))
                    v.append(int(g["node"][y]))
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
    return run


def _groups_so_far(links: DataFrame) -> DataFrame:
    """(node, root): each node's least neighbour's least neighbour. Nodes of one root are connected; not
    all that are connected have one root, which costs comparisons but loses none."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("least")), "least")
    up = least.select(F.col("node").alias("least"), F.col("least").alias("up")).hint("merge")
    return least.join(up, "least", "left").select("node", F.coalesce("up", "least").alias("root"))


def _mixed(members: DataFrame, links: DataFrame, *more: Column) -> DataFrame:
    """Members, with their root, of the buckets that hold several roots; without each bucket's first
    node, which was compared with all others."""
    rest = members.where("node <> first").join(_groups_so_far(links).hint("merge"), "node", "left").select(
        *members.columns, F.coalesce("root", "node").alias("root"))
    placed = written(rest, "placed")
    keys = placed.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"), *more).where("a <> b").drop("a", "b")
    return placed.join(keys.hint("merge"), "key").drop("first")


def _tiled(mixed: DataFrame) -> DataFrame:
    """Rows of ``mixed`` for every pair of tiles (i, j) they belong to. A bucket's largest connected
    group has tiles behind those of the rest and meets only these."""
    sizes = mixed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("rows"), F.max("n").alias("n"))
    per = sizes.groupBy("key").agg(F.max_by("root", F.struct("rows", "root")).alias("main"), F.max("rows").alias("large"),
                                   (F.sum("rows") - F.max("rows")).alias("rest"), F.max("n").alias("longest"))
    tile = F.greatest(F.lit(1), F.least(F.lit(TILE), F.floor(F.lit(TILE_SHINGLES) / F.col("longest"))))
    per = per.select("key", "main", F.ceil(F.col("rest") / tile).cast("int").alias("s"), F.ceil(F.col("large") / tile).cast("int").alias("l"))
    at, is_main = F.xxhash64("node", "key"), F.col("root") == F.col("main")
    own = F.when(is_main, F.col("s") + F.pmod(at, F.col("l"))).otherwise(F.pmod(at, F.col("s"))).cast("int")
    last = F.when(is_main, F.col("s")).otherwise(F.col("s") + F.col("l")) - 1
    return (mixed.join(per.hint("merge"), "key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
            .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "band", "own", "node", "root", "n"))


def _grouped(rows: DataFrame) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j")


def links_of(docs: DataFrame, nodes: DataFrame, text: str, key: str, shingle: int, percent: int) -> DataFrame:
    """(u, v): confirmed links that connect whatever any similar nodes of ``nodes`` connect."""
    keyed = (nodes.select("node", "n", "sig", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
             .select("node", "n", "band", F.xxhash64("band", F.expr(f"substring(sig, band * {ROWS} + 1, {ROWS})")).alias("key")))
    buckets = written(keyed.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"))
                      .where("first <> last").select("key", "first"), "buckets")
    members = written(keyed.join(buckets.hint("merge"), "key"), "members")
    known = written(nodes.join(members.select("node").distinct().hint("merge"), "node", "left_semi"), "known")
    sets = full_sets(docs, known, text, key, shingle)

    star = written(members.where("node <> first").select(F.col("node").alias("u"), F.col("first").alias("v")).distinct(), "pairs")
    links = confirmed(star, known, sets, percent)

    one = F.min_by(F.struct("node", "root"), F.xxhash64("key", "node")).alias("one")
    drawn = (_mixed(members, links, one).where("root <> one.root")
             .select(F.greatest("node", "one.node").alias("u"), F.least("node", "one.node").alias("v")).distinct())
    links = links.unionByName(confirmed(written(drawn, "pairs"), known, sets, percent))

    tiles = written(_tiled(written(_mixed(members, links), "mixed")), "tiles")
    signed = tiles.join(known.select("node", "sig").hint("merge"), "node")
    fields = "key long, i int, j int, band int, own int, node long, root long, n long"
    flagged = written(_grouped(signed).mapInArrow(_flagged(percent), fields), "flagged")
    whole = flagged.join(known.select("node", "sig").hint("merge"), "node").join(sets.hint("merge"), "node")
    return links.unionByName(written(_grouped(whole).mapInArrow(_forest(percent), "u long, v long"), "links"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE,
                    percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row; documents are linked whose sets have
    at least ``percent`` per cent of their union in common."""
    small_batches(docs.sparkSession)
    found = sketches(docs, text, key, shingle)
    rep = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h"))
    nodes = written(found.where("n > 0").groupBy("digest", "n", "sig").agg(rep.alias("rep"))
                    .withColumn("node", F.monotonically_increasing_id()), "nodes")
    roots = components(links_of(docs, nodes, text, key, shingle, percent)).hint("merge")
    rooted = written(nodes.join(roots, "node", "left").select("digest", F.col("rep.id").alias("id"), F.coalesce("root", "node").alias("root")),
                     "rooted")
    least = rooted.groupBy("root").agg(F.min("id").alias("component"))
    labels = written(rooted.join(least.hint("merge"), "root").select("digest", "component"), "labels")
    out = found.select("id", "n", "digest").join(labels.hint("merge"), "digest", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))
