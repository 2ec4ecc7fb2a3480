"""Cross-tokenizer alignment: the ids of two tokenizers for one text, grouped where both end a token.

Each tokenizer's cumulative byte ends go into a dictionary from end to index. The ends that both
have, in order, slice both id lists into groups; within a group the tokens whose bytes overlap are
linked. How many links of the whole corpus hold a pair of ids, and which pairs are a B id's most
frequent, is known after a first pass only. So a first pass writes each document's links against
the pairs of its chunk (a bounded batch of texts); a chunk's pairs, not each document's, are then
joined with the corpus counts and meet the chunk's documents again.

Most text is words between single spaces. No token of either vocabulary reaches from one such
word into the next (the vocabularies are looked at for that), so both end a token there: words are
aligned one by one, and a worker remembers a bounded number of them.

Skew: a pair found in every document is one row per chunk, and the aggregate combines map side;
the join with the counts reads shuffled sides, which the adaptive planner splits. The highest count
of each B id is broadcast: one row per id of a vocabulary. A chunk is bounded by rows and bytes
(one very long text is a chunk alone), whatever ids its documents have.

Null or empty text, or one that a tokenizer doesn't give back byte by byte: no tokens, all counts
zero, empty digest. Repeated rows and rows that share an id each count. An empty table gives no
rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import small_batches, written
from .tokens import kept, vocabulary

BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK_ROWS, CHUNK_BYTES = 512, 1 << 20
_A_BITS = 32                                       # a pair of ids is a * 2^32 + b

WORD, MEMORY = 64, 200_000                         # longest remembered part of a text, and how many (twice)
MARKS = 10_000                                     # remembered marks behind words
#: A single space between two characters that are surely no white space.
_BETWEEN = re.compile(r"(?<=[\w!-~]) (?=[\w!-~])")
#: Words of printable ASCII and Latin letters, which every version of Unicode cuts alike, and the
#: cut that a byte-level vocabulary stands for.
_PLAIN = re.compile("[ !-~À-ÖØ-öø-ÿ]{1,64}").fullmatch
#: A word and marks behind it: a byte-level cut parts them, and a sentence-piece vocabulary without pieces of both.
_MARKED = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]+)").fullmatch
_MIXED = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ][!-/:-@\[-`{-~]").search
_CUT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_BEFORE = "a"
_NO_TOKENS = 0, 0, 0, "", np.zeros(0, np.int64)

Groups = list[tuple[tuple[int, ...], tuple[int, ...]]]


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones stand
    for themselves, the others are numbered from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteTokens:
    """Ids of a byte-level vocabulary; special tokens inside a text are plain text."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        chars = byte_characters()
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.tokens = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if token not in special:
                self.tokens[i] = bytes(chars[c] for c in token)
        how = json.loads(self.tokenizer.to_str())
        cut = how["pre_tokenizer"] or {}
        #: A space between words begins a piece, and pieces are encoded one by one.
        self.by_word = how["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex") is True
        self.plain_ids = None
        merged = [vocab["".join(m)] for m in how["model"]["merges"]]
        if self.by_word and merged == sorted(merged) and len({*merged}) == len(merged):
            # ids rank the merges, so the same vocabulary can be read as ranks, which is faster
            import tiktoken
            ranks = {t: i for i, t in enumerate(self.tokens) if t}
            self.plain_ids = tiktoken.Encoding("own", pat_str=_CUT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def ids(self, text: str) -> list[int]:
        if self.plain_ids and _PLAIN(text):
            return self.plain_ids(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids


class PieceTokens:
    """Ids of a sentence-piece vocabulary, which puts a space before the text itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.tokens = [bytes([int(p[1:-1], 16)]) if model.is_byte(i) else
                       b"" if model.is_control(i) or model.is_unknown(i) else p.replace("▁", " ").encode()
                       for i, p in enumerate(pieces)]
        #: Spaces stand at the beginning of a piece alone, so no merge reaches over one.
        self.by_word = not any("▁" in p.lstrip("▁") for p in pieces)
        #: Nor over the end of a word's letters, before marks; what stands before marks alone is one piece.
        self.by_marks = (self.by_word and len(model.encode(_BEFORE)) == 1 and not any(
            _MIXED(p) for i, p in enumerate(pieces) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))))

    def ids(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)

    def mark_ids(self, marks: str) -> list[int]:
        """Ids of marks behind a word."""
        return self.ids(_BEFORE + marks)[1:]


def grouped(a: list[int], b: list[int], tokens_a: list[bytes], tokens_b: list[bytes]) -> tuple[Groups, list[int]]:
    """Groups of ids between the byte offsets where both lists end a token, and the linked pairs
    (a * 2^32 + b), one for each two token occurrences whose bytes overlap."""
    ends_a = [*accumulate([len(tokens_a[i]) for i in a])]
    ends_b = [*accumulate([len(tokens_b[i]) for i in b])]
    if ends_a == ends_b:
        return [((x,), (y,)) for x, y in zip(a, b)], [x << _A_BITS | y for x, y in zip(a, b)]
    at_a, at_b = dict(zip(ends_a, range(1, len(a) + 1))), dict(zip(ends_b, range(1, len(b) + 1)))
    groups, pairs = [], []
    i = j = 0
    for end in sorted(at_a.keys() & at_b.keys()):
        i2, j2 = at_a[end], at_b[end]
        if i2 - i == 1 and j2 - j == 1:
            x, y = a[i], b[j]
            groups.append(((x,), (y,)))
            pairs.append(x << _A_BITS | y)
        else:
            own_a, own_b = tuple(a[i:i2]), tuple(b[j:j2])
            groups.append((own_a, own_b))
            k, m = i, j                            # tokens overlap until the one that ends first is used up
            while k < i2 and m < j2:
                pairs.append(a[k] << _A_BITS | b[m])
                if ends_a[k] <= ends_b[m]:
                    k, m = k + 1, m + (ends_a[k] == ends_b[m])
                else:
                    m += 1
        i, j = i2, j2
    return groups, pairs


def joined(a: list[int], b: list[int], long_a: list[int], long_b: list[int]) -> tuple[str, list[int]]:
    """The text of the groups and the linked pairs of ``grouped``, for tokens of the same bytes that all have some:
    the token that ends first makes way for the next one."""
    i = j = 0
    x, y = a[0], b[0]
    end_a, end_b, own_a, own_b = long_a[x], long_b[y], str(x), str(y)
    groups, pairs = [], [x << _A_BITS | y]
    while True:
        if end_a < end_b:
            i += 1
            x = a[i]
            end_a += long_a[x]
            own_a = f"{own_a},{x}"
        elif end_b < end_a:
            j += 1
            y = b[j]
            end_b += long_b[y]
            own_b = f"{own_b}.{y}"
        else:
            groups.append(f"{own_a}|{own_b}")
            i, j = i + 1, j + 1
            if i == len(a):
                return ";".join(groups), pairs
            x, y = a[i], b[j]
            end_a, end_b, own_a, own_b = end_a + long_a[x], end_b + long_b[y], str(x), str(y)
        pairs.append(x << _A_BITS | y)


def groups_text(groups: Groups) -> str:
    """``a1,a2|b1;a3|b2.b3``: a point between the B ids, so that separators tell how many ids of either there are."""
    return ";".join([f"{a[0]}|{b[0]}" if len(a) == len(b) == 1 else f"{','.join(map(str, a))}|{'.'.join(map(str, b))}"
                     for a, b in groups])


class _Words(dict):
    """A part of a text with a space before it: how many pairs it has (4 bytes), the pairs and the
    groups' text in one string of bytes, which takes half the memory of a tuple of them; None if a
    tokenizer doesn't give it back. Parts not met since the memory was last full are forgotten."""

    def __init__(self, a: ByteTokens, b: PieceTokens) -> None:
        super().__init__()
        self.a, self.b, self.before = a, b, {}
        self.long_a, self.long_b = ([*map(len, t.tokens)] for t in (a, b))
        self.empty = [{i for i, n in enumerate(long) if not n} for long in (self.long_a, self.long_b)]
        self.by_marks, self.marks = a.by_word and b.by_marks, {}

    def __missing__(self, part: str):
        found = self.before[part] if part in self.before else self.aligned(part)
        if len(part) <= WORD:
            if len(self) >= MEMORY:
                self.before = dict(self)
                self.clear()
            self[part] = found
        return found

    def aligned(self, part: str) -> bytes | None:
        marked = self.by_marks and _MARKED(part)
        if not marked:
            return self.linked(f" {part}", self.a.ids(" " + part), self.b.ids(part))
        word, marks = marked.groups()              # many words meet few marks, so either is aligned alone
        head, tail = self[word], self.marks.get(marks)
        if tail is None:
            tail = self.linked(marks, self.a.ids(marks), self.b.mark_ids(marks))
            if len(self.marks) < MARKS and len(marks) <= WORD:
                self.marks[marks] = tail
        if head is None or tail is None:
            return None
        n, m = (int.from_bytes(p[:4], "little") for p in (head, tail))
        return b"".join(((n + m).to_bytes(4, "little"), head[4:4 + 8 * n], tail[4:4 + 8 * m], head[4 + 8 * n:], b";",
                         tail[4 + 8 * m:]))

    def linked(self, text: str, a: list[int], b: list[int]) -> bytes | None:
        raw = text.encode()
        if b"".join(map(self.a.tokens.__getitem__, a)) != raw or b"".join(map(self.b.tokens.__getitem__, b)) != raw:
            return None
        if self.empty[0].isdisjoint(a) and self.empty[1].isdisjoint(b):
            shown, pairs = joined(a, b, self.long_a, self.long_b)
        else:
            groups, pairs = grouped(a, b, self.a.tokens, self.b.tokens)
            shown = groups_text(groups)
        return len(pairs).to_bytes(4, "little") + array("q", pairs).tobytes() + shown.encode()


class Aligner:
    """(n_a, n_b, n_groups, digest of the groups, pairs) of a text."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        self.words = _Words(ByteTokens(byte_path), PieceTokens(piece_path))
        self.by_word = self.words.a.by_word and self.words.b.by_word

    def __call__(self, text: str | None):
        if not text:
            return _NO_TOKENS
        try:
            parts = [self.words[p] for p in (_BETWEEN.split(text) if self.by_word else [text])]
        except UnicodeEncodeError:                 # no UTF-8, so no bytes to give back
            return _NO_TOKENS
        if None in parts:
            return _NO_TOKENS
        ends = [4 + 8 * int.from_bytes(p[:4], "little") for p in parts]
        groups = b";".join([p[e:] for p, e in zip(parts, ends)])
        n = groups.count(b";") + 1
        return (n + groups.count(b","), n + groups.count(b"."), n, hashlib.sha256(groups.replace(b".", b",")).hexdigest(),
                np.frombuffer(b"".join([p[4:e] for p, e in zip(parts, ends)]), np.int64))


# A row of the first pass is either a document (pair and n null) or a pair of its chunk (id null).
_DOCUMENT = [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")] + [
    T.StructField("groups_sha256", T.StringType()), T.StructField("at", T.BinaryType()), T.StructField("times", T.BinaryType())]
_PAIR = [T.StructField("pair", T.LongType()), T.StructField("n", T.LongType())]


def first_pass(docs: DataFrame, text: str, key: str, byte_vocabulary: str, piece_vocabulary: str) -> DataFrame:
    """(chunk, pair, n) rows and (chunk, id, counts, at, times) rows: a document's links are the
    pairs ``at`` of its chunk (by place among the chunk's sorted pairs), ``times`` often each."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    out = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("id", src.schema["id"].dataType),
                        *_DOCUMENT, *_PAIR])
    arrow = to_arrow_schema(out)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, start, size = b.column(1).to_pylist(), 0, 0
            for k, t in enumerate(texts):
                grown = size + len(t or "")
                if k > start and (k - start >= CHUNK_ROWS or grown > CHUNK_BYTES):
                    yield b.column(0).slice(start, k - start), texts[start:k]
                    start, grown = k, len(t or "")
                size = grown
            if texts:
                yield b.column(0).slice(start), texts[start:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = kept(f"aligner {byte_vocabulary} {piece_vocabulary}",
                     lambda: Aligner(vocabulary(byte_vocabulary), vocabulary(piece_vocabulary)))
        chunk = TaskContext.get().partitionId() << 32
        for ids, texts in chunks(batches):
            found = [align(t) for t in texts]
            links = [f[4] for f in found]
            pairs, places, n = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
            at, times, begin = [], [], 0
            for own in links:
                where, often = np.unique(places[begin:begin + len(own)], return_counts=True)
                at.append(where.astype("<u4").tobytes())
                times.append(often.astype("<u4").tobytes())
                begin += len(own)
            rows = len(texts)
            columns = [[chunk] * rows, ids, *([f[k] for f in found] for k in range(3)), [len(x) for x in links],
                       [f[3] for f in found], at, times, [None] * rows, [None] * rows]
            yield _records(columns, arrow)
            if len(pairs):
                blank = [[None] * len(pairs)] * (1 + len(_DOCUMENT))
                yield _records([[chunk] * len(pairs), *blank, pairs, n], arrow)
            chunk += 1
    return written(src.mapInArrow(run, out), "links")


def _records(columns, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type)
                                       for c, f in zip(columns, schema, strict=True)], names=schema.names)


def _scored(schema: pa.Schema, names: list[str]):
    """Rows sorted by chunk, its pairs (by place) ahead of its documents -> the documents with
    ``n_best`` and ``count_sum``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts, best = None, [], []
        for b in batches:
            chunk, total, top = (pc.fill_null(b.column(names.index(c)), none).to_numpy(zero_copy_only=False)
                                 for c, none in (("chunk", 0), ("total", 0), ("best", False)))
            is_doc = b.column(names.index("pair")).is_null().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((chunk[1:] != chunk[:-1]) | (is_doc[1:] != is_doc[:-1])) + 1
            for s, e in zip([0, *cuts], [*cuts, len(chunk)]):
                if own != chunk[s]:
                    own, counts, best = chunk[s], [], []
                if not is_doc[s]:
                    counts.append(total[s:e])
                    best.append(top[s:e])
                    continue
                if len(counts) != 1:
                    counts = [np.concatenate([np.zeros(0, np.int64), *counts])]
                    best = [np.concatenate([np.zeros(0, bool), *best])]
                part = b.slice(s, e - s)
                at, times = (part.column(names.index(c)).to_pylist() for c in ("at", "times"))
                n_best, count_sum = [], []
                for a, t in zip(at, times, strict=True):
                    a, t = np.frombuffer(a, "<u4"), np.frombuffer(t, "<u4").astype(np.int64)
                    n_best.append(int(t[best[0][a]].sum()))
                    count_sum.append(int((t * counts[0][a]).sum()))
                columns = [part.column(names.index(c)) for c in ("id", "n_a", "n_b", "n_groups", "n_links")]
                yield _records([*columns, n_best, count_sum, part.column(names.index("groups_sha256"))], schema)
    return run


def aligned(docs: DataFrame, text: str = "text", key: str = "doc_id", byte_vocabulary: str = BYTE_VOCABULARY,
            piece_vocabulary: str = PIECE_VOCABULARY) -> DataFrame:
    """One row per document: its tokens, groups and links, how many of its links hold their B id's
    most frequent pair, and the sum of its links' corpus counts."""
    first = first_pass(docs, text, key, byte_vocabulary, piece_vocabulary)
    pairs = first.where("pair is not null").select("chunk", "pair", "n")
    counts = written(pairs.groupBy("pair").agg(F.sum("n").alias("total"))
                     .withColumn("b", F.col("pair").bitwiseAND((1 << _A_BITS) - 1)), "pair_counts")
    highest = counts.groupBy("b").agg(F.max("total").alias("most"))              # a row per id of B
    counts = counts.join(F.broadcast(highest), "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))
    known = pairs.drop("n").join(counts.hint("merge"), "pair")
    both = known.unionByName(first.where("pair is null").drop("pair", "n"), allowMissingColumns=True)
    names = ["chunk", "pair", "total", "best", "id", *(f.name for f in _DOCUMENT)]
    # the pairs of a chunk come sorted, as its documents count them, and (not null) ahead of those
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = both.select(*names).repartition(parts, "chunk").sortWithinPartitions("chunk", F.col("pair").asc_nulls_last())
    out = T.StructType([T.StructField(key, docs.schema[key].dataType)] + [T.StructField(c, T.LongType()) for c in (
        "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] + [T.StructField("groups_sha256", T.StringType())])
    return met.mapInArrow(_scored(to_arrow_schema(out), names), out)
