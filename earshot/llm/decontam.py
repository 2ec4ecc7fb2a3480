"""Benchmark decontamination by training suffix arrays.

Documents are cut into shards of whole texts inside the tasks that read them. A shard's words
become numbers (0: not a benchmark word, which no benchmark text can match), its suffixes that
begin with a benchmark word are sorted into a suffix array, and every suffix of the benchmark
is binary-searched in it. A benchmark suffix gives the interval of document positions that
begin with its window (verbatim occurrences, which mark words as hit) and its longest verbatim
match in the shard with one place of it. No shuffle: a document's result depends on its own
words and on the benchmark alone.

The benchmark is the stated query set: it is broadcast in blocks of at most ``BLOCK_BYTES`` of
text, one pass over the documents per block, passes cut by a written table.

Null text has no words, so neither hits nor items; it is never contaminated. Null benchmark
texts have no windows. Equal item texts count as so many items; repeated document rows get
equal results. Extra columns pass through ``flagged`` (its own columns are named free of them).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from .common import free_name, map_arrow, written

WINDOW = 13
BLOCK_BYTES = 8 << 20
SHARD_WORDS = 1 << 20
#: Bytes between words: ASCII without letters and digits. A-Z are lower-cased.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
               for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


class Benchmark:
    """A block's items as one array of word numbers, and its windows."""

    def __init__(self, items: list[tuple], window: int) -> None:
        self.ids = [str(i) for i, _ in items]
        self.number: dict[bytes, int] = {}
        texts = [[self.number.setdefault(w, len(self.number) + 1) for w in words(t)] for _, t in items]
        self.word = np.array([x for t in texts for x in [*t, 0]], np.int64)
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        own = [(k, starts[k] + i, min(window, len(t))) for k, t in enumerate(texts)
               for i in range(max(len(t) - window, 0) + 1 if t else 0)]
        self.item, self.at, self.size = (np.array([o[c] for o in own], np.int64) for c in range(3))
        self.bits = max(1, len(self.number).bit_length())
        self.width = 62 // self.bits                       # words in one sort key
        self.depth = -(-window // self.width)              # keys that windows reach
        self.full = max(self.depth, -(-max(map(len, texts), default=0) // self.width))

    def key(self, word: np.ndarray, at: np.ndarray, level: int, before: np.ndarray | None = None) -> np.ndarray:
        """Words ``level * width ...`` behind each position as one number. A word that no benchmark
        text has ends the suffix: it and all behind it count as 0. ``before``: the keys of the level
        above (computed if not given), whose last word tells whether the suffix goes on."""
        if level and before is None:
            before = self.key(word, at, level - 1)
        open_ = (before & ((1 << self.bits) - 1)) > 0 if level else np.ones(len(at), bool)
        out = np.zeros(len(at), np.int64)
        for j in range(level * self.width, (level + 1) * self.width):
            pos = at + j
            w = np.where(pos < len(word), word[np.minimum(pos, len(word) - 1)], 0)
            open_ = open_ & (w > 0)
            out = (out << self.bits) | np.where(open_, w, 0)
        return out


def suffix_array(bench: Benchmark, word: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions of ``word`` that hold benchmark words, sorted by the words that follow, up to
    ``depth`` keys, and those keys by level. Deeper levels are computed for ties only; they end
    with the ties."""
    at = np.flatnonzero(word)
    first = bench.key(word, at, 0)
    order = np.argsort(first, kind="stable")
    at, keys = at[order], [first[order]]
    begins = np.concatenate(([True], keys[0][1:] != keys[0][:-1]))[:len(at)]   # a group of ties begins
    for level in range(1, depth):
        tied = ~begins
        tied[:-1] |= tied[1:]
        where = np.flatnonzero(tied)
        if not len(where):
            break
        k = np.zeros(len(at), np.int64)
        found = bench.key(word, at[where], level, keys[-1][where])
        group = np.cumsum(begins)[where]
        order = np.lexsort((found, group))
        at[where], k[where] = at[where][order], found[order]
        begins[where[1:]] |= k[where[1:]] != k[where[1:] - 1]
        begins[where[k[where] == 0]] = True                 # ended alike: no need to look deeper
        keys.append(k)
    return at, keys


def occurrences(bench: Benchmark, word: np.ndarray, at: np.ndarray, keys: list[np.ndarray]):
    """For every window of the block: the interval [lo, hi) of the suffix array that begins with it."""
    n = len(bench.at)
    lo, hi = np.zeros(n, np.int64), np.full(n, len(at), np.int64)
    for level in range(bench.depth):
        # the window's words on this level, then the least and the greatest continuation
        left = np.clip(bench.size - level * bench.width, 0, bench.width)
        live = np.flatnonzero((left > 0) & (lo < hi))
        if not len(live):
            break
        full = bench.key(bench.word, bench.at[live], level)
        cut = (bench.width - left[live]) * bench.bits
        low = full >> cut << cut
        high = low + (np.int64(1) << cut)
        if level == 0:
            lo[live], hi[live] = np.searchsorted(keys[0], low), np.searchsorted(keys[0], high)
            continue
        for i, a, b in zip(live.tolist(), low.tolist(), high.tolist(), strict=True):
            s, e = lo[i], hi[i]
            k = keys[level][s:e] if e - s > 1 else bench.key(word, at[s:e], level)   # ties only have deep keys
            lo[i], hi[i] = s + np.searchsorted(k, a), s + np.searchsorted(k, b)
    return lo, hi


def longest_matches(bench: Benchmark, word: np.ndarray, at: np.ndarray, keys: list[np.ndarray]):
    """For every benchmark suffix: length of its longest verbatim match and its position (-1: none).
    In a suffix array, the longest match stands next to where the suffix would be inserted."""
    q = np.flatnonzero(bench.word)
    best, place = np.zeros(len(q), np.int64), np.full(len(q), -1, np.int64)
    lo, hi = np.zeros(len(q), np.int64), np.full(len(q), len(at), np.int64)
    spot = None
    k = None
    for level in range(len(keys)):
        k = bench.key(bench.word, q, level, k)
        if level == 0:
            lo, hi = np.searchsorted(keys[0], k), np.searchsorted(keys[0], k, "right")
            spot = lo.copy()
            continue
        for i in np.flatnonzero(hi - lo > 1).tolist():
            s, part = lo[i], keys[level][lo[i]:hi[i]]
            lo[i], hi[i] = s + np.searchsorted(part, k[i]), s + np.searchsorted(part, k[i], "right")
            spot[i] = lo[i]
    for near in (-1, 0):
        there = spot + near
        ok = (there >= 0) & (there < len(at))
        p, same, size = at[np.where(ok, there, 0)] if len(at) else q * 0, ok.copy(), np.zeros(len(q), np.int64)
        for j in range(len(bench.word)):
            same = same & (p + j < len(word)) & (q + j < len(bench.word))
            if not same.any():
                break
            w = word[np.minimum(p + j, len(word) - 1)]
            same &= (w > 0) & (w == bench.word[np.minimum(q + j, len(bench.word) - 1)])
            size += same
        more = size > best
        best, place = np.where(more, size, best), np.where(more, p, place)
    return q, best, place


def _shards(texts: list[list[bytes]], limit: int):
    """(from, to) document ranges of at most ``limit`` words, or one longer document."""
    begin, total = 0, 0
    for i, t in enumerate(texts):
        if total and total + len(t) > limit:
            yield begin, i
            begin, total = i, 0
        total += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def shard_matches(bench: Benchmark, texts: list[list[bytes]], longest: bool = False):
    """Per document of one shard: hit words (mask) and items with occurring windows; with
    ``longest`` also each document's longest match among those of the shard's suffix array
    (length, item, word in the item, word in the document)."""
    get = bench.number.get
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))
    word = np.zeros(starts[-1], np.int64)
    for t, s in zip(texts, starts.tolist(), strict=False):
        word[s:s + len(t)] = np.fromiter((get(w, 0) for w in t), np.int64, len(t))
    edge, items = np.zeros(len(word) + 1, np.int64), [set() for _ in texts]
    most = [(0, -1, -1, -1)] * len(texts)
    if word.any() and len(bench.at):
        at, keys = suffix_array(bench, word, bench.full if longest else bench.depth)
        lo, hi = occurrences(bench, word, at, keys)
        for w in np.flatnonzero(lo < hi).tolist():
            places = at[lo[w]:hi[w]]
            np.add.at(edge, places, 1)
            np.add.at(edge, places + bench.size[w], -1)
            for d in np.unique(np.searchsorted(starts, places, "right") - 1).tolist():
                items[d].add(int(bench.item[w]))
        if longest:
            item_starts = np.concatenate(([0], np.flatnonzero(bench.word == 0) + 1))
            for q, size, p in zip(*(x.tolist() for x in longest_matches(bench, word, at, keys)), strict=True):
                if p >= 0:
                    d = int(np.searchsorted(starts, p, "right")) - 1
                    i = int(np.searchsorted(item_starts, q, "right")) - 1
                    if size > most[d][0]:
                        most[d] = (size, i, q - int(item_starts[i]), p - int(starts[d]))
    hit = np.cumsum(edge[:-1]) > 0
    return [hit[s:s + n] for s, n in zip(starts.tolist(), sizes.tolist(), strict=False)], items, most


def _blocks(benchmark: DataFrame, item: str, text: str, limit: int) -> list[list[tuple]]:
    """The query set in blocks of at most ``limit`` bytes of text (or one longer item)."""
    blocks, size = [[]], 0
    for row in benchmark.select(item, text).orderBy(item, text).toLocalIterator():
        n = len((row[1] or "").encode("utf-8", "surrogatepass"))
        if blocks[-1] and size + n > limit:
            blocks.append([])
            size = 0
        blocks[-1].append((row[0], row[1]))
        size += n
    return blocks


_OWN = (("n_words", T.LongType()), ("n_hit", T.LongType()), ("items", T.ArrayType(T.StringType())),
        ("hit", T.BinaryType()), ("longest", T.LongType()), ("longest_item", T.StringType()),
        ("longest_item_word", T.LongType()), ("longest_doc_word", T.LongType()))


def flagged(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
            window: int = WINDOW, block_bytes: int = BLOCK_BYTES, longest: bool = False) -> tuple[DataFrame, dict]:
    """``docs`` with the match columns, and a map from their names here to the names given to them
    (free of clashes): n_words, n_hit, items (ids, sorted as strings), hit (bit per word), and, with
    ``longest``, the longest verbatim match of a benchmark suffix found at this document and its place."""
    spark = docs.sparkSession
    names = {n: free_name(docs, f"_{n}") for n, _ in _OWN}
    fields = [T.StructField(names[n], t) for n, t in _OWN]
    columns, out = docs.columns, docs
    for i, block in enumerate(_blocks(benchmark, item, item_text, block_bytes)):
        held = spark.sparkContext.broadcast(block)
        before = [names[n] for n, _ in _OWN] if i else []
        if i:
            out = written(out, "decontam")

        def make(held=held):
            bench = Benchmark(held.value, window)

            def f(texts, *old):
                found = [words(t) for t in texts.to_pylist()]
                cols = [[] for _ in _OWN]
                earlier = [c.to_pylist() for c in old]
                for a, b in _shards(found, SHARD_WORDS):
                    part = found[a:b]
                    for k, (hit, own, most) in enumerate(zip(*shard_matches(bench, part, longest), strict=True), a):
                        ids, top = {bench.ids[x] for x in own}, (most[0], bench.ids[most[1]] if most[0] else None,
                                                                 *most[2:])
                        ids = sorted([bench.ids[x] for x in own])
                        if earlier:
                            hit = hit | np.unpackbits(np.frombuffer(earlier[3][k], np.uint8))[:len(hit)].astype(bool)
                            ids = sorted(ids + earlier[2][k])
                            top = max(top, tuple(earlier[c][k] for c in range(4, 8)), key=lambda x: x[0])
                        for c, v in zip(cols, (len(hit), int(hit.sum()), ids, np.packbits(hit).tobytes(), *top),
                                        strict=True):
                            c.append(v)
                return cols
            return f
        new = [f"{n}__" for n in before]
        step = map_arrow(out, [text, *before], [T.StructField(x, f.dataType) for x, f in
                                                zip(new or [f.name for f in fields], fields, strict=True)],
                         make, keep=columns)
        out = step.withColumnsRenamed(dict(zip(new, before, strict=True)))
    return out, names


def contaminated(n_words, n_hit):
    """The contamination rule on columns: at least one word in twenty is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """Per document row: key, n_words, n_hit, n_items, digest of its items, contaminated, and the
    longest match columns."""
    found, n = flagged(docs.select(key, options.get("text", "text")), benchmark, longest=True, **options)
    return found.select(
        key, F.col(n["n_words"]).alias("n_words"), F.col(n["n_hit"]).alias("n_hit"),
        F.size(n["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(n["items"], ",").cast("binary"), 256).alias("items_sha256"),
        contaminated(F.col(n["n_words"]), F.col(n["n_hit"])).alias("contaminated"),
        F.col(n["longest"]).alias("longest"), F.col(n["longest_item"]).alias("longest_item"),
        F.col(n["longest_item_word"]).alias("longest_item_word"),
        F.col(n["longest_doc_word"]).alias("longest_doc_word"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated documents."""
    found, n = flagged(docs, benchmark, **options)
    return found.where(~contaminated(F.col(n["n_words"]), F.col(n["n_hit"]))).select(*docs.columns)
