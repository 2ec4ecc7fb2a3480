"""Each operator and stage on hard rows, on an empty table and beside columns of clashing names."""

import pytest
from pyspark.sql import functions as F

from earshot.llm import (decontam, hilbert, langid, licenses, packing, pii, secret_scan, simhash, token_files, winnow)

from . import fixtures as X

BENCH = "item_id long, text string"
CLASHING = {n: 1 for n in ("fp", "spans", "rank", "_rank", "_mid", "score", "rejected", "_score", "_rejected", "_clean",
                           "n_words", "_n_words", "hit", "_hit", "key", "component", "_key", "shard", "_text", "_id",
                           "curve", "license", "piece", "sequence_id", "frame", "found", "base")}


def benchmark(spark):
    return spark.createDataFrame([(1, "the same words again"), (2, None), (3, "")], BENCH)


OPERATORS = {
    "winnow": lambda s, d: winnow.edited(d),
    "pii": lambda s, d: pii.scan(d),
    "packing": lambda s, d: packing.packed(d),
    "decontam": lambda s, d: decontam.report(d, benchmark(s)),
    "langid": lambda s, d: langid.predictions(d),
    "hilbert": lambda s, d: hilbert.shards(d, ["source", "lang", "text"]),
    "token_files": lambda s, d: token_files.round_trip(d),
    "simhash": lambda s, d: simhash.near_duplicates(d),
    "licenses": lambda s, d: licenses.scan(d, F.concat_ws("/", "source", F.col("doc_id").cast("string"))),
    "secret_scan": lambda s, d: secret_scan.scan(d),
}
STAGES = {
    "language_id": lambda s, d: langid.accepted(d),
    "near_duplicates": lambda s, d: simhash.deduplicated(d),
    "decontamination": lambda s, d: decontam.decontaminated(d, benchmark(s)),
    "secrets": lambda s, d: secret_scan.redact(d, length="n_chars"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operator_on_hard_rows(spark, name):
    found = OPERATORS[name](spark, X.table(spark, **CLASHING))
    rows, ids = found.collect(), [r[0] for r in X.rows()]
    assert len(set(found.columns)) == len(found.columns)
    assert sorted({str(r["doc_id"]) for r in rows}) == sorted({str(i) for i in ids})
    assert name == "packing" or len(rows) == len(ids)
    none = OPERATORS[name](spark, X.empty(spark))
    assert none.columns == found.columns and none.count() == 0


@pytest.mark.parametrize("name", STAGES)
def test_stage_on_hard_rows(spark, name):
    docs = X.table(spark, **CLASHING)
    out = STAGES[name](spark, docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert 0 < out.count() <= docs.count()
    assert STAGES[name](spark, X.empty(spark)).count() == 0


def test_stage_decisions(spark):
    docs = X.table(spark)
    once = simhash.deduplicated(docs).groupBy("doc_id").count().where("count > 1").count()
    assert once == 0
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redact(docs, length="n_chars").collect()}
    assert clean[84] == '[SECRET]" and [SECRET]' and clean[70] == X.LONG
    kept = {r["doc_id"] for r in decontam.decontaminated(docs, benchmark(spark)).collect()}
    assert 28 not in kept and 42 not in kept and 70 in kept
