import random

import numpy as np
import pytest
import xxhash

from earshot.llm import simhash


def brute_fingerprint(text, k=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in low).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(len(words) - k, 0) + 1)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps, distance):
    part = list(range(len(ids)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                part[root(i)] = root(j)
    groups = {}
    for i, d in enumerate(ids):
        groups.setdefault(root(i), []).append(d)
    return {d: min(groups[root(i)]) for i, d in enumerate(ids)}


def test_fingerprint():
    for t in (None, "", "A b", "one two three four five", "É x\ty\x0bz w\xa0q", "the cat sat on the mat the cat sat"):
        assert simhash.fingerprint(t) == brute_fingerprint(t)


@pytest.mark.parametrize("n", [300])
def test_components_equal_all_pairs(spark, n, monkeypatch):
    """Chains of fingerprints a few bits apart, with keys cut into many tiles."""
    monkeypatch.setattr(simhash, "TILE", 16)
    rng, fps = random.Random(3), []
    for _ in range(n):
        base = rng.choice(fps) if fps and rng.random() < 0.8 else rng.getrandbits(64)
        for b in rng.sample(range(64), rng.randint(0, 6)):
            base ^= 1 << b
        fps.append(base)
    from earshot.llm import graph
    rows = [(f - (1 << 64) if f >> 63 else f,) for f in sorted(set(fps))]
    df = spark.createDataFrame(rows, "fp long")
    found = {r["node"]: r["root"] for r in graph.components(simhash.links(df)).collect()}
    signed = [r[0] for r in rows]
    want = brute_components(signed, [s & (1 << 64) - 1 for s in signed], 4)
    assert {s: found.get(s, s) for s in signed} == want


def test_forest_spans_what_pairs_connect():
    rng = np.random.default_rng(5)
    fp = np.unique(rng.integers(0, 1 << 12, 400).astype(np.uint64))
    tree = simhash.forest(fp, 2)
    assert all((int(fp[a]) ^ int(fp[b])).bit_count() <= 2 for a, b in tree)
    ids = list(range(len(fp)))
    want = brute_components(ids, [int(x) for x in fp], 2)
    assert len(tree) == len(ids) - len(set(want.values()))


def test_masks_leave_no_close_pair_apart():
    rng = random.Random(9)
    for n in (10, 10_000_000, 10 ** 11):
        masks = simhash.block_masks(n, 4)
        for _ in range(500):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), 4):
                b ^= 1 << bit
            assert any((a ^ b) & m & (1 << 64) - 1 == 0 for m in masks)


def test_each_group_keeps_a_row(spark):
    """Groups without an id, and groups that share one, lose no text; copies go whatever their ids."""
    a, b, c, d = (" ".join(f"{w}{i}" for i in range(40)) for w in ("alpha", "beta", "gamma", "delta"))
    rows = [(None, a, 1), (None, b, 2), (None, b, 2), (None, c, 3), (1, c, 4), (7, a.upper() + " ", 5), (9, d, 6), (9, d[::-1], 7), (9, d, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(3)
    found = sorted(((r[0] or 0), r[1], r[2]) for r in simhash.deduplicated(docs, unique_keys=False).collect())
    assert found == sorted([(0, b, 2), (1, c, 4), (7, a.upper() + " ", 5), (9, d, 6), (9, d[::-1], 7)])
    once = sorted((r[0] or 0) for r in simhash.deduplicated(docs).collect())
    assert once == [0, 1, 7, 9]
    two = spark.createDataFrame([(None, a), (None, b), (None, a)], "doc_id long, text string")
    assert sorted(r["text"] for r in simhash.deduplicated(two).collect()) == sorted([a, b])
