"""Training-corpus pipeline over ``documents``: each stage filters, edits or packs what the one
before it kept. Stages are (name, function(spark, docs, sf_dir)); ``run`` applies them all,
writing every stage's result as Parquet in the shared folder and reading it again. Only the last
result stays there.

Nulls, empty texts, repeated rows, empty tables and extra columns have the results that the
called operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from earshot.llm import decontam, langid, packing, secret_scan, simhash
from earshot.llm.common import last_written, remove, scratch, table, written


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose text is null, has no letter, or is foreign to every learned language."""
    return langid.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked fingerprints stays, the one with the smallest doc_id. Groups whose
    row has no id, or the id of another group's, stay too."""
    return simhash.deduplicated(docs, unique_keys=False)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go of whose words at least one in twenty stands in a benchmark passage."""
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; no document goes."""
    return secret_scan.redact(docs, length="n_chars")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text's token pieces with their places in training sequences."""
    return packing.packed(docs)


STAGES = [
    ("language_id", languages),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmarks),
    ("secret_scan", secrets),
    ("best_fit_packing", sequences),
]

#: Language models, XXH64 and the tokenizer can't be expressed in DuckDB's SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch(spark) as keep:                # what a stage wrote on its way goes
            docs = written(stage(spark, docs, sf_dir), name)
            keep.append(last_written())
        if before:                                  # and the result that it read
            remove(spark, before)
        before = keep[-1]
    return docs
