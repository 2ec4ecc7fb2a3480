"""Cross-tokenizer alignment against a brute-force version that compares byte ranges."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from earshot.llm import alignment
from earshot.llm.tokens import vocabulary

from . import fixtures as X

TEXTS = [*X.TEXTS[:-4], "Hello World, two  spaces\t\tand tabs\r\n", "<|endoftext|> and <s> </s> <unk> <0x41>", "a▁b", " lead",
         "naïve café — “quoted” 😂👍🏽 漢字", "x" * 500, "\x00\x01 control", "Hello World, two  spaces\t\tand tabs\r\n"]


def tokens(text):
    """[(id, begin, end)] of both tokenizers, or none."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer, decoders
    if not text:
        return [], []
    a_tok = Tokenizer.from_file(vocabulary(alignment.BYTE_VOCABULARY))
    a_tok.encode_special_tokens = True
    sp = SentencePieceProcessor(model_file=vocabulary(alignment.PIECE_VOCABULARY))
    raw, chars = (" " + text).encode(), {v: k for k, v in alignment.byte_characters().items()}
    a = [(i, bytes(b for c in a_tok.id_to_token(i) for b in [next(k for k, v in chars.items() if v == c)]))
         for i in a_tok.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode())
         for i in sp.encode(text)]
    assert decoders.ByteLevel()
    if any(b"".join(t for _, t in x) != raw for x in (a, b)):
        return [], []
    out = []
    for found in (a, b):
        at, spans = 0, []
        for i, t in found:
            spans.append((i, at, at + len(t)))
            at += len(t)
        out.append(spans)
    return out


def brute(texts):
    rows, links = [], []
    for text in texts:
        a, b = tokens(text)
        own = [(x, y) for x, s, e in a for y, s2, e2 in b if s < e2 and s2 < e]
        groups, i, j = [], 0, 0
        for end in sorted({e for *_, e in a} & {e for *_, e in b}):
            i2, j2 = (sum(e <= end for *_, e in x) for x in (a, b))
            groups.append(f"{','.join(str(x[0]) for x in a[i:i2])}|{','.join(str(x[0]) for x in b[j:j2])}")
            i, j = i2, j2
        rows.append([len(a), len(b), len(groups), len(own),
                     hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""])
        links.append(own)
    counts = Counter(x for own in links for x in own)
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    return [(*r[:4], sum(counts[x] == most[x[1]] for x in own), sum(counts[x] for x in own), r[4])
            for r, own in zip(rows, links, strict=True)]


@pytest.mark.parametrize("rows, size", [(512, 1 << 20), (2, 1 << 20), (512, 100)])
def test_equals_brute_force(spark, monkeypatch, rows, size):
    """Also where a chunk holds few documents, so that pairs are counted over many chunks."""
    monkeypatch.setattr(alignment, "CHUNK_ROWS", rows)
    monkeypatch.setattr(alignment, "CHUNK_BYTES", size)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    found = {r[0]: tuple(r[1:]) for r in alignment.aligned(docs).collect()}
    assert [found[i] for i in range(len(TEXTS))] == brute(TEXTS)


def test_registered_query_on_prose(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("n_chars").limit(60)
    rows = docs.select("doc_id", "text").collect()
    found = {r[0]: tuple(r[1:]) for r in alignment.aligned(docs).collect()}
    assert [found[r[0]] for r in rows] == brute([r[1] for r in rows])


def test_words_align_like_whole_texts(monkeypatch):
    """Texts of words and odd spaces, cut into words (with a memory of few) and taken whole."""
    monkeypatch.setattr(alignment, "MEMORY", 20)
    rng, paths = random.Random(6), [vocabulary(v) for v in (alignment.BYTE_VOCABULARY, alignment.PIECE_VOCABULARY)]
    words, whole = alignment.Aligner(*paths), alignment.Aligner(*paths)
    whole.by_word = False
    assert words.by_word
    parts = ["a", "Word", "é", " ", " ", " ", "  ", "\n", "\t", "\xa0", "'s", "'", "12", "½", "漢字", "<s>", "<|endoftext|>", "😂", "_", ".",
             "́", "x" * 70, "İ", "️"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        x, y = words(text), whole(text)
        assert x[:4] == y[:4] and x[4].tolist() == y[4].tolist(), repr(text)
    assert len(words.words) <= 20


def test_ids_as_ranks_equal_the_tokenizer():
    a = alignment.ByteTokens(vocabulary(alignment.BYTE_VOCABULARY))
    rng = random.Random(9)
    common = [t.decode() for t in a.tokens if t.isascii() and t.strip().isalnum()]
    chars = [chr(c) for c in range(32, 127)] + list("éÈßñöÀ")
    for _ in range(30_000):
        parts = [rng.choice(common) if rng.random() < 0.5 else rng.choice(chars) for _ in range(rng.randint(1, 8))]
        text = " " + "".join(parts)[:60]
        assert a.ids(text) == a.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_texts_not_given_back_have_no_tokens(spark):
    docs = spark.createDataFrame([(1, "a▁b"), (2, None), (3, ""), (None, "a")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in alignment.aligned(docs.withColumn("chunk", F.lit(0))).collect()}
    assert all(found[i]["n_a"] == found[i]["n_links"] == 0 and found[i]["groups_sha256"] == "" for i in (1, 2, 3))
    assert found[None]["n_a"] == 1


def test_groups_of_random_cuts():
    rng = random.Random(4)
    for _ in range(200):
        size = rng.randint(1, 30)
        cuts = [sorted({*rng.sample(range(1, size + 1), rng.randint(0, size)), size}) for _ in range(2)]
        spans = [list(zip([0, *c], c)) for c in cuts]
        toks = [[b"x" * (e - s) for s, e in x] for x in spans]
        groups, pairs = alignment.grouped(*(list(range(len(x))) for x in spans), *toks)
        want = [(i, j) for i, (s, e) in enumerate(spans[0]) for j, (s2, e2) in enumerate(spans[1]) if s < e2 and s2 < e]
        assert sorted((p >> 32, p & (1 << 32) - 1) for p in pairs) == want
        assert [x for g, _ in groups for x in g] == list(range(len(spans[0])))
        assert len(groups) == len(set(cuts[0]) & set(cuts[1]))


def test_memory_of_words_is_small():
    """A full memory takes at most 128 MB of a worker."""
    import tracemalloc
    align = alignment.Aligner(vocabulary(alignment.BYTE_VOCABULARY), vocabulary(alignment.PIECE_VOCABULARY))
    align("warm up")
    words = [f"{random.Random(i).choice(['ka', 'lo', 'Te'])}{i * 7919 % 99991}x" for i in range(4000)]
    tracemalloc.start()
    align(" ".join(words))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(align.words) >= 4000
    assert held / len(align.words) * 2 * alignment.MEMORY <= 128 << 20


def test_joined_equals_grouped():
    rng = random.Random(8)
    tokens_of = [b"x" * n for n in (1, 1, 2, 3, 4)]
    sizes = [len(t) for t in tokens_of]
    for _ in range(300):
        total = rng.randint(1, 15)
        def cut():
            out = []
            while (rest := total - sum(sizes[i] for i in out)):
                out.append(rng.choice([i for i, n in enumerate(sizes) if n <= rest]))
            return out
        a, b = cut(), cut()
        groups, pairs = alignment.grouped(a, b, tokens_of, tokens_of)
        assert alignment.joined(a, b, sizes, sizes) == (alignment.groups_text(groups), pairs)


def test_marks_behind_a_word_are_aligned_alone(monkeypatch):
    """A known word with other marks behind it isn't encoded again."""
    paths = vocabulary(alignment.BYTE_VOCABULARY), vocabulary(alignment.PIECE_VOCABULARY)
    own, rng = alignment.Aligner(*paths), random.Random(9)
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    words = ["".join(rng.choices("abcdenrstàéßÖ", k=rng.randint(1, 9))) + "".join(rng.choices(marks, k=rng.randint(1, 4)))
             for _ in range(2000)]
    for w in words:
        whole = own.words.linked(f" {w}", own.words.a.ids(" " + w), own.words.b.ids(w))
        assert own.words[w] == whole, w
    own("Straße und! Haus.")
    monkeypatch.setattr(own.words.b, "ids", lambda text: pytest.fail(f"{text} is encoded again"))
    assert own("Straße. Haus! und.")[2] > 0
