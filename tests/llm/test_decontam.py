import random

import pytest

from earshot.llm import decontam as D


def brute(items, texts, window):
    out = []
    for t in texts:
        w = D.words(t)
        hit, own = [0] * len(w), set()
        for k, (_, x) in enumerate(items):
            y = D.words(x)
            n = min(window, len(y))
            wins = {tuple(y[a:a + n]) for a in range(len(y) - n + 1)} if n else set()
            for p in range(len(w) - n + 1 if n else 0):
                if tuple(w[p:p + n]) in wins:
                    own.add(k)
                    hit[p:p + n] = [1] * n
        out.append((hit, own))
    return out


def longest(items, texts):
    best = 0
    for _, x in items:
        y = D.words(x)
        for a in range(len(y)):
            for t in map(D.words, texts):
                for p in range(len(t)):
                    n = 0
                    while a + n < len(y) and p + n < len(t) and y[a + n] == t[p + n]:
                        n += 1
                    best = max(best, n)
    return best


def cases(n, seed):
    rng = random.Random(seed)
    for _ in range(n):
        many, window = rng.choice([1, 2, 3, 30, 3000]), rng.choice([1, 2, 5, 13])
        some = lambda k: " ".join(f"w{rng.randrange(many)}" for _ in range(k))  # noqa: E731, B023
        items = [(i, some(rng.randint(0, 30))) for i in range(rng.randint(1, 5))]
        texts = []
        for _ in range(6):
            y = rng.choice(items)[1].split()
            a = rng.randint(0, len(y))
            texts.append(some(rng.randint(0, 40)) + (" " + " ".join(y[a:a + rng.randint(1, 40)]) + " zz " + some(3)
                                                     if rng.random() < 0.6 else ""))
        yield items, texts, window


def test_hits_items_and_longest_match():
    for items, texts, window in cases(150, 2):
        hits, own, most = D.shard_matches(D.Benchmark(items, window), [D.words(t) for t in texts], True)
        for (h, i), got, ids in zip(brute(items, texts, window), hits, own, strict=True):
            assert (h, i) == (got.astype(int).tolist(), ids)
        assert max(m[0] for m in most) == longest(items, texts)


@pytest.mark.parametrize("block", [1, 60, 1 << 20])
def test_blocks_and_shards_change_nothing(spark, block, monkeypatch):
    items, texts, window = next(c for c in cases(50, 7) if c[2] == 5 and len(c[0]) > 2)
    docs = spark.createDataFrame([*enumerate(texts), (99, None)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(D, "SHARD_WORDS", 20)
    got = {r["doc_id"]: r for r in D.report(docs, bench, window=window, block_bytes=block).collect()}
    for i, (h, own) in enumerate(brute(items, texts, window)):
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["n_items"]) == (len(h), sum(h), len(own))
    assert got[99]["n_words"] == 0 and not got[99]["contaminated"]


def test_words():
    assert D.words("Don't STOP x_y é2 \x00Ä") == [b"don", b"t", b"stop", b"x", b"y", "é2".encode(), "Ä".encode()]
