"""Compaction of the stored fact: many small batch folders become few files near a target size.

Loads append ``batch_id=<n>/date_key=<d>`` folders, each with as many files as tasks had rows of the
day. A compaction takes a run of adjacent batches and earlier runs, packs their days into bins of
about the target size (``bins``: best fit by the days' bytes; a day larger than a bin is cut into
several), and one task writes each bin, sorted. The new run ``fact_listens_runs/lo=<a>/hi=<b>`` is seen once the marker
``fact_listens_runs/marker/v=<k>``, the list of all runs, has been written; until then readers use the batch
folders, which ``clean`` removes later. A compaction that fails half way leaves files that nobody
reads and that the next one replaces.

Which runs are taken again: going back from the newest, those no larger than what is behind them
together (so a row is rewritten about log(n) times in n batches). Sizes are those of the files,
listed by Spark; the plan has a row per day and bin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import hadoop_fs, list_dirs, path_exists
from ..sinks.files import append_table, committed_versions, latest_version, write_snapshot
from . import load as L
from .fact import RUNS, fact_path, live_runs, read_rows, run_path, runs_path

TARGET = 256 << 20                  # bytes of a file
SALTS = 1 << 10                     # pieces that a day may be cut into
ORDER = ["event_timestamp", "user_key", "action"]


def file_sizes(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(date_key, bytes, files) of the Parquet files under the folders ``paths``."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(paths)
    day = F.nullif(F.regexp_extract("path", r"date_key=([^/]+)/", 1), F.lit("__HIVE_DEFAULT_PARTITION__")).cast("int")
    return found.select(day.alias("date_key"), "length").groupBy("date_key").agg(
        F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"))


def bins(days: list[tuple[int | None, int]], target: int = TARGET) -> list[tuple[int | None, int, int]]:
    """(day, first bin, bins of the day): a day of more than the target has bins of its own, the others
    share them, best fit by decreasing size."""
    out, room, n = [], [], 0                        # room: (bytes left, bin)
    for day, size in sorted(days, key=lambda d: (-d[1], d[0] is None, d[0] or 0)):
        pieces = min(max(-(-size // target), 1), SALTS)
        if pieces > 1:
            out.append((day, n, pieces))
            n += pieces
            continue
        fits = [(left, b) for left, b in room if left >= size]
        left, b = min(fits, default=(target, n))
        if fits:
            room.remove((left, b))
        else:
            n += 1
        room.append((left - size, b))
        out.append((day, b, 1))
    return out


def candidates(runs: list[tuple[int, int, int]], fresh: int) -> list[tuple[int, int, int]]:
    """The newest runs to be merged with ``fresh`` bytes of new batches: each no larger than all behind it."""
    taken: list[tuple[int, int, int]] = []
    for run in reversed(runs):
        if run[2] > fresh + sum(r[2] for r in taken):
            break
        taken.insert(0, run)
    return taken


def compact_fact(spark: SparkSession, warehouse: str, target: int = TARGET, keep: int = 2) -> dict[str, int] | None:
    """Merge the batches since the last compaction into a run. Returns the files and bytes before and
    after, or None if there is nothing to merge. Old markers but the newest ``keep`` go, with what
    only they name: readers of an older one must have finished."""
    fact, last = fact_path(warehouse), L.committed_batch(spark, warehouse)
    runs = live_runs(spark, warehouse)
    done = runs[-1][1] if runs else -1
    if last is None or last <= done:
        return None
    folders = [f"{fact}/{n}" for n in list_dirs(spark, fact) if n.startswith("batch_id=") and done < int(n[9:]) <= last]
    if not folders:
        return None
    fresh = file_sizes(spark, folders).agg(F.sum("bytes")).first()[0] or 0
    taken = candidates(runs, fresh)
    lo, hi = (taken[0][0] if taken else done + 1), last
    before = file_sizes(spark, folders + [run_path(warehouse, a, b) for a, b, _ in taken]).collect()     # a row per day
    plan = bins([(r["date_key"], r["bytes"]) for r in before], target)
    rows = read_rows(spark, warehouse, last).where(F.col("batch_id").between(lo, hi))
    places = F.broadcast(spark.createDataFrame(plan, "_day int, _bin int, _bins int"))                   # a row per day
    salt = F.pmod(F.xxhash64("listen_key"), F.col("_bins"))
    binned = (rows.join(places, F.col("date_key").eqNullSafe(F.col("_day")))
              .withColumn("_bin", (F.col("_bin") + salt).cast("int")).drop("_day", "_bins"))
    n_bins = max(b + n for _, b, n in plan)
    path = run_path(warehouse, lo, hi)
    # a task per bin, which writes a file for each of its days
    out = binned.repartitionById(n_bins, "_bin").sortWithinPartitions("date_key", *ORDER).drop("_bin")
    append_table(out, path, mode="overwrite", partition_by=["date_key"])
    after = file_sizes(spark, [path]).agg(F.sum("bytes").alias("bytes"), F.sum("files").alias("files")).first()
    now = [r for r in runs if r not in taken] + [(lo, hi, after["bytes"])]
    # the swap: readers take the new run from here on
    version = latest_version(spark, f"{runs_path(warehouse)}/marker")
    write_snapshot(spark.createDataFrame(now, RUNS).coalesce(1), f"{runs_path(warehouse)}/marker", 0 if version is None else version + 1)
    clean(spark, warehouse, keep)
    return {"files_before": sum(r["files"] for r in before), "files_after": after["files"],
            "bytes_before": sum(r["bytes"] for r in before), "bytes_after": after["bytes"], "bins": n_bins}


def clean(spark: SparkSession, warehouse: str, keep: int = 2) -> list[str]:
    """Remove markers but the newest ``keep``, runs that none of these names, and batch folders that all
    of these cover. Returns the folders removed."""
    root, fact = runs_path(warehouse), fact_path(warehouse)
    versions = committed_versions(spark, f"{root}/marker")
    kept = [live_runs(spark, warehouse, v) for v in versions[-keep:]]
    if len(versions) < keep:
        kept.append([])                             # readers from before the first compaction
    used = {(lo, hi) for runs in kept for lo, hi, _ in runs}
    covered = min((runs[-1][1] if runs else -1 for runs in kept), default=-1)
    newest = kept[-1][-1][1] if kept and kept[-1] else -1
    gone = [f"{root}/marker/v={v}" for v in versions[:-keep]]
    for a in list_dirs(spark, root):
        for b in list_dirs(spark, f"{root}/{a}") if a.startswith("lo=") else []:
            if (int(a[3:]), int(b[3:])) not in used and int(b[3:]) <= newest:
                gone.append(f"{root}/{a}/{b}")
    if path_exists(spark, fact):
        gone += [f"{fact}/{n}" for n in list_dirs(spark, fact) if n.startswith("batch_id=") and int(n[9:]) <= covered]
    for path in gone:
        fs, p = hadoop_fs(spark, path)
        fs.delete(p, True)
    return gone
