"""Registered queries: each dealt operator over its whole table, with its contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (alignment, decontam, filter_audit, hilbert, langid, licenses, minhash, packing, pii, secret_scan, simhash,
               token_files, winnow)
from .common import table


def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.edited(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(table(spark, sf_dir, "documents"))


def op6_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shards(table(spark, sf_dir, "documents"), ["source", "lang", "text"])


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no paths: a document is the file <source>/<lang>/<doc_id>."""
    return licenses.scan(table(spark, sf_dir, "documents"), F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_winnowing, op2_pii, op3_packing, op4_decontamination, op5_language_id,
                                    op6_hilbert_shards, op7_token_files, op8_simhash, op9_licenses, op10_secrets,
                                    op11_alignment, op12_minhash, op13_filter_audit)}


#: Windows are compared as space-joined words; rowid keeps documents that share an id apart.
DECONTAMINATION_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT *, least(13, len(w)) AS n, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i
        FROM b WHERE len(w) > 0) x),
dw AS (
  SELECT r, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM d, (SELECT DISTINCT n FROM bw) s WHERE len(w) >= n) x),
hits AS (SELECT dw.r, dw.i, dw.n, bw.item FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
marked AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT r, i, n FROM hits) h) x GROUP BY r),
found AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM hits) x GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN marked USING (r) LEFT JOIN found USING (r)"""


#: Copies of one set are one node; every pair of nodes that shares a shingle is compared.
MINHASH_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_sort(list_distinct([array_to_string(list_slice(w, i, i + least(5, len(w)) - 1), ' ')
         for i in generate_series(1, len(w) - least(5, len(w)) + 1) if len(w) > 0])) AS g FROM d),
nodes AS (SELECT min(doc_id) AS node, g FROM s WHERE len(g) > 0 GROUP BY g),
e AS (SELECT node, len(g) AS n, unnest(g) AS x FROM nodes),
links AS (
  SELECT a.node AS u, b.node AS v FROM e a JOIN e b ON a.x = b.x AND a.node <> b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT node AS u, node AS v FROM nodes UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
least_of AS (SELECT u, min(v) AS c FROM reach GROUP BY u),
found AS (
  SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, coalesce(m.c, s.doc_id) AS component_id
  FROM s LEFT JOIN nodes USING (g) LEFT JOIN least_of m ON m.u = nodes.node)
SELECT *, doc_id = component_id AS kept FROM found"""

FILTER_AUDIT_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (
  SELECT w.part, coalesce(q.quality = 1, false) AS good, coalesce(q.toxic = 1, false) AS toxic,
         [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
          100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t), regexp_matches(t, '[#$%&*|]'),
          doc_id > min(doc_id) OVER (PARTITION BY t)] AS fails
  FROM w LEFT JOIN labels q USING (doc_id)),
m AS (SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, step, ascii(filter_order[step]) - 64 AS own,
         [ascii(filter_order[i]) - 64 for i in generate_series(1, step - 1)] AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s),
c AS (
  SELECT part, filter_order, step, own, n, good, toxic, fails[own] AS bad,
         list_bool_or([false] || [fails[i] for i in earlier]) AS gone, len(list_filter(fails, lambda x: x)) = 1 AS alone
  FROM m, steps),
r AS (
  SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT gone AND NOT bad), 0) AS kept,
         coalesce(sum(n) FILTER (bad AND NOT gone), 0) AS removed, coalesce(sum(n) FILTER (bad AND gone), 0) AS redundant,
         coalesce(sum(n) FILTER (bad AND alone), 0) AS unique_fails,
         coalesce(sum(n) FILTER (bad AND NOT gone AND good), 0) AS good_lost,
         coalesce(sum(n) FILTER (bad AND NOT gone AND toxic), 0) AS toxic_lost
  FROM c GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r"""


def oracle_sql() -> dict[str, str]:
    """DuckDB twins. The other operators rest on XXH64, CRC-32, tokenizers, fitted models or automata,
    which its SQL doesn't have; tests hold them against brute force."""
    return {"op4_decontamination": DECONTAMINATION_SQL, "op12_minhash": MINHASH_SQL,
            "op13_filter_audit": FILTER_AUDIT_SQL}
