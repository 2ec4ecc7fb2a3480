"""The pipeline against its stages in plain Python, on the smallest tables."""

import corpus_pipeline as P
from earshot.llm import decontam, langid, simhash
from earshot.llm.common import table, written

from . import fixtures as X
from .test_decontam import brute
from .test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


def test_run_equals_the_stages(spark):
    packed = P.run(spark, SF).toPandas()
    docs = table(spark, SF, "documents")
    found, n = langid.identified(docs, langid.fit(docs))
    kept = {r["doc_id"]: r["text"] for r in found.collect() if not r[n["rejected"]]}
    groups = brute_components(sorted(kept), [brute_fingerprint(kept[d]) for d in sorted(kept)], 4)
    kept = {d: t for d, t in kept.items() if groups[d] == d}
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    hits = brute(items, [kept[d] for d in sorted(kept)], 13)
    kept = {d: kept[d] for d, (h, _) in zip(sorted(kept), hits, strict=True) if not (sum(h) and 20 * sum(h) >= len(h))}
    assert set(packed.doc_id) == set(kept) and len(kept) > 0.8 * docs.count()
    assert [s for s, _ in P.STAGES] == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "secret_scan", "best_fit_packing"]
    assert packed.groupby("sequence_id").length.sum().max() <= 4096
    assert simhash.DISTANCE == 4 and decontam.WINDOW == 13


def folders(spark):
    import os

    from earshot.session import shared_dir
    root = shared_dir(spark, "llm").removeprefix("file:")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_run_leaves_only_its_result(spark):
    before = folders(spark)
    packed = P.run(spark, SF)
    left = folders(spark) - before
    assert len(left) == 1 and left.pop().startswith("best_fit_packing") and packed.count() > 0


CLASHING = {n: 1 for n in ("_row", "_stays", "_rejected", "_score", "_n_words", "_hit", "_text", "fp", "_mid", "_rank", "piece", "start",
                           "sequence_id", "offset", "rank", "key", "node")}


def test_stages_on_hard_rows_and_empty_tables(spark):
    """The registered stages themselves, one after the other."""
    for docs in (X.table(spark), X.table(spark, **CLASHING), X.empty(spark)):
        rows, first = docs.count(), docs
        for name, stage in P.STAGES[:-1]:
            out = written(stage(spark, docs, SF), name)
            assert out.columns == first.columns and out.dtypes == first.dtypes, name
            assert out.count() <= docs.count()
            docs = out
        kept = [r["doc_id"] for r in docs.collect()]
        packed = P.STAGES[-1][1](spark, docs, SF).toPandas()
        assert set(packed["doc_id"].isna().map(bool)) <= {False, None in kept} and (len(packed) > 0) == (rows > 0)
        assert {int(i) for i in packed["doc_id"].dropna()} == {i for i in kept if i is not None}
        assert packed.empty or packed.groupby("sequence_id").length.sum().max() <= 4096
