import math
from collections import Counter

import numpy as np

from earshot.llm import langid as L

SF = "/root/testdata/sf0.01"


def brute_logp(texts, order=3):
    """Interpolated Kneser-Ney by its definition, over strings."""
    grams = Counter()
    for t in texts:
        s = " " * (order - 1) + "".join(map(chr, L.normal(t)))
        grams.update(s[i - order + 1:i + 1] for i in range(order, len(s)))
    counts = [None] * (order + 1)
    counts[order] = grams
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])

    def p(g):
        if not g:
            return 1 / L.ALPHABET
        c = counts[len(g)]
        n1, n2 = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        d = min(max(n1 / max(n1 + 2 * n2, 1), 0.1), 0.9)
        same = [v for k, v in c.items() if k[:-1] == g[:-1]]
        if not same:
            return p(g[1:])
        return max(c.get(g, 0) - d, 0) / sum(same) + d * len(same) / sum(same) * p(g[1:])
    return p


def test_probabilities_equal_the_definition(monkeypatch):
    monkeypatch.setattr(L, "ORDER", 3)
    a, b = ["the cat sat on the mat", "that cat"], ["die katze sass auf der matte"]
    models = L.Models({"a": L.train(a, 3), "b": L.train(b, 3)})
    ce, n = models.entropies(["the matze", "zq"])
    for i, t in enumerate(["the matze", "zq"]):
        s = "  " + "".join(map(chr, L.normal(t)))
        for k, texts in enumerate((a, b)):
            p = brute_logp(texts)
            want = -sum(math.log(p(s[j - 2:j + 1])) for j in range(3, len(s))) / n[i]
            assert abs(ce[i, k] - want) < 1e-4


def test_pieces_of_long_texts_add_up(monkeypatch):
    model = L.Models({"a": L.train(["some words of a language, more words"])})
    text = "words of more language some " * 50
    whole = model.entropies([text, "words"])[0]
    monkeypatch.setattr(L, "_CHUNK", 64)
    assert np.allclose(model.entropies([text, "words"])[0], whole)


def test_normal():
    assert "".join(map(chr, L.normal("Ab1, Ç--d!"))) == " ab ç d "
    assert len(L.normal("12 !?")) == 0


def test_held_out_accuracy_and_rejection(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10 ** 6, "漢字 漢字文字列 漢字"), (10 ** 6 + 1, None), (10 ** 6 + 2, "12 34")], "doc_id long, text string")
    models = L.fit(docs)
    found, n = L.identified(docs.select("doc_id", "text", "lang").unionByName(extra, allowMissingColumns=True), models)
    rows = found.withColumn("fold", L.fold()).toPandas()
    held = rows[(rows.fold == 2) & (rows.doc_id < 10 ** 6)]
    assert (held[n["lang_pred"]] == held.lang).mean() >= 0.98
    assert rows[rows.doc_id >= 10 ** 6][n["rejected"]].all()
    assert rows[rows.doc_id < 10 ** 6][n["rejected"]].mean() <= 0.002
    assert (rows[rows.doc_id > 10 ** 6][n["lang_pred"]] == "und").all()


def test_a_language_that_is_not_learned_is_rejected():
    """Each language left out of fitting in turn; the held-out texts of the others stay."""
    import zlib

    import pyarrow.parquet as pq
    by, held = {}, []
    for r in pq.read_table(f"{SF}/documents.parquet").to_pylist():
        if r["text"] and r["lang"]:
            if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2:
                held.append((r["lang"], r["text"]))
            else:
                by.setdefault(r["lang"], []).append(r["text"])
    trained = {k: L.train(v[:len(v) * 2 // 3]) for k, v in by.items()}
    for out in by:
        models = L.Models({k: m for k, m in trained.items() if k != out})
        rows = [(k, t) for k in models.langs for t in by[k][len(by[k]) * 2 // 3:]]
        ce, n = models.entropies([t for _, t in rows])
        models.calibrate([(k, int(c), e) for (k, _), c, e in zip(rows, n, ce.tolist(), strict=True)])
        rejected = np.array(models.predict([t for _, t in held])[2])
        own = np.array([k != out for k, _ in held])
        assert rejected[own].mean() <= 0.02, out
        assert rejected[~own].mean() >= 0.9, out


def test_sample_holds_where_rows_share_an_id(spark):
    """A third of all rows under one id, no ids at all, a language of copies, a rare one: each language is
    learned, from no more texts than stated, all of them eligible."""
    say = {"a": "the cat sat on number {} of the mats", "b": "die katze sass auf matte {} von allen", "c": "le chat sur le tapis {} la"}
    rows = [(6, say["a"].format(i), "a") for i in range(1500)] + [(None, say["b"].format(i % 7), "b") for i in range(1500)]
    rows += [(i, say["c"].format(i), "c") for i in range(1499)] + [(7, "ein einziger satz", "d"), (8, "", "e"), (9, None, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    able = docs.where("text is not null").select("lang", "text")
    sample = L.drawn(able, 500, 250).toPandas()
    assert len(sample) == len(sample.drop_duplicates())
    n = sample.groupby("lang").fit.agg(["sum", "size"])
    assert n.loc["a", "size"] == n.loc["c", "size"] == 750 and n.loc["a", "sum"] == 500 and n.loc["b", "size"] == 7
    assert list(n.loc["d"]) == [1, 1] and "f" not in n.index
    rows, names = L.identified(docs, L.fit(docs))
    found = Counter((r["lang"], r[names["lang_pred"]]) for r in rows.where("text <> ''").collect())
    assert {k: v for k, v in found.items() if k[0] in "abc"} == {("a", "a"): 1500, ("b", "b"): 1500, ("c", "c"): 1499}
    kept = L.accepted(docs).groupBy("lang").count().toPandas().set_index("lang")["count"]
    assert kept["a"] > 1450 and kept["b"] > 1450 and kept["c"] > 1450


def test_sample_is_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(L, "SAMPLE_BYTES", 5000)
    monkeypatch.setattr(L, "LONG_BYTES", 1000)
    rows = [("a", f"{i} " + "x" * 100) for i in range(300)] + [("a", f"{i} " + "y" * 2000) for i in range(50)] + [("b", "z" * 9000)]
    sample = L.drawn(spark.createDataFrame(rows, "lang string, text string"), 500, 250).toPandas()
    sizes = sample.text.str.len().groupby(sample.lang).sum()
    assert 4000 < sizes["a"] <= 5000 and sizes["b"] == 9000 and sample[sample.lang == "a"].text.str.len().max() < 1000
