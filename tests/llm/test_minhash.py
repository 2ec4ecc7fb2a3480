"""MinHash near-duplicates against all pairs of full sets, and against DuckDB."""

import random

import numpy as np
import pytest
from harness import compare, duck

from earshot.llm import minhash, queries

from . import fixtures as X

SF = "/root/testdata/sf0.01"


def brute_set(text, k=5):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in low).split(" ") if w]
    return {" ".join(words[i:i + k]) for i in range(max(len(words) - k, 0) + 1)} if words else set()


def brute(rows):
    """[(n_shingles, component)] by row."""
    sets = [brute_set(t) for _, t in rows]
    part = list(range(len(rows)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                part[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [(len(s), least.get(root(i), rows[i][0])) for i, s in enumerate(sets)]


def found(spark, rows, parts=4):
    docs = spark.createDataFrame(list(rows), "doc_id long, text string").repartition(parts)
    out = minhash.near_duplicates(docs).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)
    return sorted(map(repr, ((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out)))


def wanted(rows):
    return sorted(map(repr, ((d, n, c) for (d, _), (n, c) in zip(rows, brute(rows), strict=True))))


def edited(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"x{rng.random()}"
    return " ".join(words)


@pytest.mark.parametrize("tile", [512, 8])
def test_groups_of_near_copies_equal_all_pairs(spark, monkeypatch, tile):
    """Copies of a few texts edited in one to eight places: many pairs lie around the limit, so that links
    between not connected nodes have to be found over many small tiles."""
    monkeypatch.setattr(minhash, "TILE", tile)
    rng = random.Random(tile)
    bases = [[f"{b}w{rng.randrange(400)}" for _ in range(n)] for b, n in enumerate((40, 120, 120, 300))]
    bases.append([w if rng.random() > 0.02 else "y" for w in bases[1]])        # two groups close to each other
    rows = [(i, edited(rng, rng.choice(bases), rng.randint(0, 8))) for i in range(260)]
    rows += [(1000 + i, rows[i * 5][1].upper()) for i in range(40)]
    assert found(spark, rows) == wanted(rows)


def test_chain(spark):
    """Neighbours of a chain are linked, its ends share nothing: one component."""
    words = [f"c{i}" for i in range(200)]
    rows = []
    for i in range(25):
        words[i * 8: i * 8 + 2] = [f"n{i}a", f"n{i}b"]
        rows.append((100 - i, " ".join(words)))
    assert found(spark, rows) == wanted(rows)
    assert {c for _, c in brute(rows)} == {76}


def test_query_equals_duckdb(spark):
    name = "op12_minhash"
    r = compare(spark, duck(SF), name, queries.queries()[name](spark, SF), queries.oracle_sql()[name])
    assert r["ok"], r


def test_hard_rows_and_empty_table(spark):
    rows = [(r[0], r[1]) for r in X.rows()] + [(None, X.LONG), (None, "a text without an id")]
    assert found(spark, rows) == wanted(rows)
    clashing = X.table(spark, id=1, h=2, n=3, digest=4, sig=5, node=6, component=7)
    assert minhash.near_duplicates(clashing).count() == len(X.rows())
    assert minhash.near_duplicates(X.empty(spark)).count() == 0


def test_signature_agrees_with_similarity():
    rng = np.random.default_rng(2)
    base = np.unique(rng.integers(0, 1 << 63, 40_000, dtype=np.uint64))
    for share in (0.5, 0.85, 0.95):
        cut = int(len(base) * share)
        other = np.unique(np.concatenate((base[:cut], rng.integers(0, 1 << 63, len(base) - cut, dtype=np.uint64))))
        a, b = minhash.signatures([base, other])
        true = len(np.intersect1d(base, other)) / len(np.union1d(base, other))
        assert abs((a == b).mean() - true) < 0.12
    assert minhash.linked(base[:20], base[:17]) and not minhash.linked(base[:20], base[:16])


def test_last_step_alone_finds_what_the_stars_leave(spark, monkeypatch):
    """With no node drawn and no groups known after the first star, all other links come from the tiles."""
    real, calls = minhash.confirmed, []

    def only_first(pairs, *rest):
        calls.append(1)
        return real(pairs if len(calls) == 1 else pairs.where("false"), *rest)
    monkeypatch.setattr(minhash, "TILE", 16)
    monkeypatch.setattr(minhash, "confirmed", only_first)
    monkeypatch.setattr(minhash, "_groups_so_far", lambda links: links.selectExpr("u as node", "u as root").where("false"))
    rng = random.Random(11)
    bases = [[f"{b}w{rng.randrange(400)}" for _ in range(n)] for b, n in enumerate((40, 120, 300))]
    rows = [(i, edited(rng, rng.choice(bases), rng.randint(0, 8))) for i in range(150)]
    assert found(spark, rows) == wanted(rows) and len(calls) == 2
