"""Filter audit against a brute-force run of every order, and against DuckDB."""

from itertools import permutations

from harness import compare, duck

from earshot.llm import filter_audit, queries

from . import fixtures as X

SF = "/root/testdata/sf0.01"
TEXTS = [None, "", "Plain words only", "UPPER CASE TEXT", "one two two two two", " ".join(f"w{i}" for i in range(120)),
         " ".join(f"w{i % 60}" for i in range(120)), " ".join(f"w{i}" for i in range(120)) + " 100%", "a\x0bb\x85c d",
         " ".join(f"W{i}" for i in range(120))]


def fails(rows, k):
    doc_id, text, _ = rows[k]
    text = text or ""
    words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in text).split(" ") if w]
    out = set()
    if len(words) < 100:
        out.add("A")
    if 100 * len(set(words)) < 80 * len(words):
        out.add("B")
    if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text):
        out.add("C")
    if any(c in "#$%&*|" for c in text):
        out.add("D")
    if doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows):
        out.add("E")
    return out


def brute(rows, good, toxic):
    bad = [fails(rows, k) for k in range(len(rows))]
    out = {}
    for part in {r[2] or "" for r in rows}:
        own = [(rows[k][0], bad[k]) for k in range(len(rows)) if (rows[k][2] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                redundant = sum(f in x[1] for x in own) - len(gone)
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), redundant, sum(x[1] == {f} for x in own),
                                                   sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def result(df):
    return {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in df.collect()}


def test_equals_every_order_run(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "PARTS", 2)           # sums are passed on early
    rows = [(i % 25 if i else None, t, [None, "", "en", "de"][i % 4]) for i, t in enumerate(TEXTS * 4)]
    rows += rows[5:9]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2, i % 3 // 2) for i in range(1, 30, 2)] + [(2, 0, 1), (2, 1, None), (None, 1, 1), (4, None, None)],
                                   "doc_id long, quality int, toxic int")
    good = {r["doc_id"] for r in labels.where("quality = 1 and doc_id is not null").collect()}
    toxic = {r["doc_id"] for r in labels.where("toxic = 1 and doc_id is not null").collect()}
    assert result(filter_audit.audit(docs, labels)) == brute(rows, good, toxic)


def test_query_equals_duckdb(spark):
    name = "op13_filter_audit"
    r = compare(spark, duck(SF), name, queries.queries()[name](spark, SF), queries.oracle_sql()[name])
    assert r["ok"] and r["spark_rows"] == 600 * 4, r


def test_fields_do_not_overflow():
    total = sum((2 ** 55) * filter_audit.outcomes(code) for code in range(128))
    assert filter_audit.unpacked(total)[:, 0, 0].max() == 2 ** 55 * 64


def test_empty_and_hard_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(X.empty(spark), labels).count() == 0
    found = filter_audit.audit(X.table(spark, part=1, mask=2, digest=3, id=4, code=5), labels).toPandas()
    assert set(found.part) == {"", "en", "de"} and len(found) == 3 * 600
    ends = found[found.step == 5].groupby("part")[["kept", "removed"]].first()
    assert (ends.kept >= 0).all()
