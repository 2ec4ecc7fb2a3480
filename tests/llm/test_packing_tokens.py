import io
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard

from earshot.llm import packing, token_files, tokens

from . import fixtures as X


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokens.vocabulary())


def test_ids_equal_the_tokenizer(encoder):
    rng = random.Random(4)
    parts = ["a", "B", "é", "é", "́", " ", "\n", "\t", "\xa0", "　", "\x85", "\x1c", "'s", "'T", "<|endoftext|>", "😂",
             "12", "½", "漢字", "ß", "İ", "ﬁ", "  ", "\r\n", ".", "!!", "‍", "Wort", "über", "ªº", "×"]
    for t in [X.LONG, "", *("".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(1500))]:
        assert encoder.ids(t).tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids + [1], repr(t)


def test_ids_of_another_vocabulary():
    """Its settings aren't the known ones, so whole texts go through the library."""
    other = tokens.Encoder(tokens.vocabulary("byte_bpe_50k.json"))
    assert not other.by_word
    for t in ["Hello World, two  spaces", "naïve\n\n x", "", None, X.LONG]:
        assert other.ids(t).tolist() == other.tokenizer.encode(t or "", add_special_tokens=False).ids + [1]


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "MEMORY", 10)
    own = tokens.Encoder(tokens.vocabulary())
    assert own.ids(X.LONG).tolist() == own.tokenizer.encode(X.LONG, add_special_tokens=False).ids + [1]
    assert len(own.words) <= 10


def test_vocabulary_read_as_ranks(encoder):
    """New plain words take one call, and have the ids of the vocabulary's own merges."""
    rng = random.Random(6)
    letters = [*map(chr, range(33, 127)), *"àéîõüßÿÀÉ"]
    words = ["".join(rng.choices(letters[64:90] + letters[94:] if k % 3 else letters, k=rng.randint(1, 12))) for k in range(3000)]
    for w in (w for w in words if "<|" not in w):
        merged = b"".join(encoder.piece(p) for p in tokens._PIECES(w.lower()))
        assert encoder.word(w) == merged, w
    asked = len(encoder.pieces)
    encoder.ids("Brandneue Worte xqzzv, qqjjxw!")
    assert encoder.plain_ids and len(encoder.pieces) == asked


def test_vocabulary_that_ranks_differ_from():
    """``a bc`` would be merged by ranks as ``ab c``, which these merges leave apart."""
    import json
    how = json.loads(tokens.Encoder(tokens.vocabulary()).tokenizer.to_str())["model"]
    from tokenizers import models
    base = {t: i for t, i in how["vocab"].items() if i < 512}
    def read(merges):
        vocab = base | {"".join(m): 512 + i for i, m in enumerate(merges)}
        model = models.BPE(vocab=vocab, merges=merges, end_of_word_suffix="</w>")
        return tokens._ranked(model, how | {"vocab": vocab, "merges": merges})
    assert read([("a", "b"), ("ab", "c")])
    assert read([("b", "c"), ("a", "b"), ("ab", "c")]) is None


@pytest.mark.parametrize("histogram", [
    {}, {1: 1}, {4096: 5, 1: 3}, {3000: 10}, {1: 5000}, {2049: 7, 2047: 9},
    dict(Counter(np.clip(np.random.default_rng(1).lognormal(6.4, 1, 3000).astype(int), 1, 4096).tolist()))])
def test_plan_holds_the_histogram(histogram):
    made, held = packing.plan(histogram), Counter()
    for runs, repeats in made:
        assert repeats > 0 and sum(n * t for n, t in runs) <= 4096
        for n, t in runs:
            held[n] += t * repeats
    assert held == Counter(histogram)
    if len(histogram) > 100:
        assert sum(r for _, r in made) <= 1.02 * -(-sum(n * c for n, c in histogram.items()) // 4096)


def test_nnls_finds_exact_mixtures():
    shapes = packing.patterns(16, 3)
    rng = np.random.default_rng(2)
    true = np.zeros(len(shapes))
    true[rng.choice(len(shapes), 6, replace=False)] = rng.integers(1, 50, 6)
    target = sum(x * np.bincount(s, minlength=17)[1:] for x, s in zip(true, shapes, strict=True))
    x = packing.nnls(shapes, target, np.ones(16))
    fit = sum(x * np.bincount(s, minlength=17)[1:] for x, s in zip(x, shapes, strict=True))
    assert (x >= 0).all() and np.allclose(fit, target, atol=1e-6)


def test_pieces_and_places(spark, encoder):
    found = packing.packed(X.table(spark)).toPandas()
    texts = Counter((r[0], len(encoder.ids(r[1]))) for r in X.rows())
    assert sorted(found.groupby("sequence_id").length.sum())[-1] <= 4096
    for _, s in found.sort_values("offset").groupby("sequence_id"):
        assert (s.offset == s.length.cumsum() - s.length).all()
    assert found.length.sum() == sum(n * c for (_, n), c in texts.items())
    long = found[found.doc_id == 70].sort_values("piece")
    ids = encoder.ids(X.LONG).astype("<u4")
    assert [zlib.crc32(ids[s:s + n].tobytes()) for s, n in zip(long.start, long.length, strict=True)] == long.ids_crc32.tolist()
    assert (long.length[:-1] == 4096).all() and (long.start == long.piece * 4096).all()


def test_round_trip(spark, encoder):
    docs = X.table(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    found = token_files.round_trip(docs, file_text_bytes=40_000).toPandas().sort_values("doc_id")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    at = 0
    for r in found.itertuples():
        ids = encoder.ids(texts[r.doc_id])
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
        at += len(ids)


class Counting(io.BytesIO):
    def __init__(self, data):
        super().__init__(data)
        self.taken = 0

    def read(self, n=-1):
        out = super().read(n)
        self.taken += len(out)
        return out


def test_reader_takes_only_what_is_asked(encoder):
    docs = [encoder.ids(f"text number {i} " * (i + 1)).astype("<u2") for i in range(200)]
    body, entries = b"", []
    import xxhash
    for d in docs:
        f = token_files.frame(d.tobytes())
        body += f + token_files.SEPARATOR.encode()
        entries.append((len(f) + 8, 2 * len(d), xxhash.xxh64_intdigest(d.tobytes()) & 0xFFFFFFFF))
    body += token_files.trailer([None, *range(1, 200)], 2, entries) + token_files.SEPARATOR.encode()
    whole = zstandard.ZstdDecompressor().stream_reader(body, read_across_frames=True).read()
    assert whole == b"".join(d.tobytes() for d in docs)    # any reader can read the whole file
    file = Counting(body)
    reader = token_files.TokenFile(file)
    opened = file.taken
    assert (reader.ids(7) == docs[7]).all() and reader.keys[0] is None and reader.keys[7] == 7
    assert file.taken - opened == entries[7][0] - 8
    broken = bytearray(body)
    broken[int(reader.at[7]) + 12] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_files.TokenFile(io.BytesIO(bytes(broken))).ids(7)
