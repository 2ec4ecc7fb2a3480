"""The hourly star load: new event files -> dimensions (upserted) + fact (appended).

``start_star_load`` runs it as a file-source stream with ``availableNow``: the
checkpoint remembers which files were processed (an incremental scan), each
micro-batch is loaded by ``load_batch``, and a run with no new files commits
nothing. Per batch:

1. empty batch -> return (the checkpoint still advances);
2. persist the events (they feed three dimensions and the fact) and read them once; events
   that a column's type can't hold go to ``load_rejects/batch_id=<n>`` with the reason;
3. each dimension is kept in hash buckets of its key (``sinks.parts``): the buckets that the batch's
   keys fall into are read, merged with the batch's rows and written as version ``v=<batch_id>``,
   sorted by the key (a retry rewrites them); the other buckets' files stay;
4. fact: conformed rows into ``batch_id=<n>/date_key=<d>`` (overwrite of that
   batch's folders only: an idempotent append);
5. row counts per table -> ``load_commits/v=<n>``: the commit. Readers take dimension versions and
   fact batches up to the newest committed batch, so a batch that fails half way shows nothing;
6. bucket files that none of the newest few versions of a dimension uses are removed;
7. optionally bring the marts up to this batch (``plans.refresh``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions.dates import date_key
from ..functions.keys import content_key
from ..operators import conform as C
from ..operators import dims, facts, merge
from ..schemas import DIM_DATE, DIM_TRACKS, DIM_USERS, EVENT_FIELDS, FACT_LISTENS
from ..schemas import Column as ContractColumn
from ..session import ensure_conf, guard_checkpoint, path_exists
from ..sinks import parts
from ..sinks.files import latest_version, write_batch_partitions, write_fact, write_snapshot
from ..sources.files import is_table
from .fact import read_fact

TABLES = ["dim_date", "dim_tracks", "dim_users", "fact_listens"]
COMMITS, REJECTS = "load_commits", "load_rejects"
FILE_ROW = "_file_row"        # arrival id taken from the Parquet file path and row index
# event field -> fact column whose type it must fit
FACT_SOURCES = {"listen_duration_ms": "duration_ms"}
# sort key of each dimension's files
SORT_KEYS = {"dim_date": "date_key", "dim_tracks": "track_key", "dim_users": "user_key"}
# hash buckets of each dimension: fixed once a table has been written
DIM_BUCKETS = {"dim_date": 1, "dim_tracks": 16, "dim_users": 16}
# stored beside the contract's columns: the time of the event that gave a track its values
EXTRA = {"dim_tracks": [ContractColumn(merge.LAST_EVENT, T.TimestampNTZType())]}


def table_path(warehouse: str, name: str) -> str:
    return f"{warehouse.rstrip('/')}/{name}"


def committed_batch(spark: SparkSession, warehouse: str, below: int | None = None) -> int | None:
    """The newest batch whose load committed: its marker is written after all of its tables."""
    return latest_version(spark, table_path(warehouse, COMMITS), below)


def current_dim(spark: SparkSession, warehouse: str, name: str, contract, below: int | None = None,
                only: list[int] | None = None):
    """The dimension (or its buckets ``only``) as of the newest committed batch (under ``below``)."""
    last = committed_batch(spark, warehouse, below)
    schema = C.conform(spark.range(0), contract).schema
    return parts.read_parts(spark, table_path(warehouse, name), schema, 0 if last is None else last + 1, only)


def drop_redelivered(events: DataFrame, batch_id: int, warehouse: str,
                     arrival: str | None = None) -> DataFrame:
    """Events whose content (the nine fields, arrival ignored) was not loaded before.

    Contents are compared field by field, NULL equal to NULL; a key over them only brings
    equal ones together. Copies inside the batch collapse to one (an aggregate on the nine
    fields, combined map side, so a large group of copies is no hot spot); earlier loads are
    found in ``seen_events`` (by ``batch_id`` and day; day 0: events without a time), read
    only for the batch's days and without this batch's own folder (so a retry gives the same
    answer). With an ``arrival`` id the earliest copy is the one kept, so a retry also keeps
    the same copy (and the same ``listen_key``).
    """
    spark = events.sparkSession
    rest = [c for c in events.columns if c not in EVENT_FIELDS]
    if rest:
        first = F.min_by(F.struct(*rest), F.col(arrival)) if arrival else F.min(F.struct(*rest))
        once = events.groupBy(*EVENT_FIELDS).agg(first.alias("_rest")).select(
            *EVENT_FIELDS, *[F.col(f"_rest.{c}").alias(c) for c in rest]).select(*events.columns)
    else:
        once = events.distinct()
    seen_path = table_path(warehouse, "seen_events")
    if not path_exists(spark, seen_path):
        return once
    # one row per calendar day, from the batch itself (not from its deduplicated form)
    days = F.broadcast(events.select(_day().alias("day")).distinct())
    seen = (spark.read.schema(_seen_schema(events)).parquet(seen_path)
            .where(F.col("batch_id") != F.lit(int(batch_id)))
            .join(days, "day", "left_semi"))
    seen = seen.select(F.col("content_key").alias("_key"), *[F.col(c).alias(f"_s_{c}") for c in EVENT_FIELDS])
    same = F.col("_ck") == F.col("_key")
    for c in EVENT_FIELDS:
        same = same & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    keyed = once.withColumn("_ck", content_key(once, EVENT_FIELDS))
    return keyed.join(seen, same, "left_anti").drop("_ck")


def _day():
    return F.coalesce(date_key("event_timestamp"), F.lit(0))


def _seen_schema(events: DataFrame) -> T.StructType:
    return T.StructType([T.StructField("content_key", T.LongType()), *[events.schema[c] for c in EVENT_FIELDS],
                         T.StructField("batch_id", T.LongType()), T.StructField("day", T.IntegerType())])


def record_seen(events: DataFrame, batch_id: int, warehouse: str) -> None:
    keys = events.select(content_key(events, EVENT_FIELDS).alias("content_key"), *EVENT_FIELDS,
                         F.lit(int(batch_id)).cast("bigint").alias("batch_id"), _day().alias("day"))
    write_batch_partitions(keys, table_path(warehouse, "seen_events"), ["batch_id", "day"])


def reject_reason(events: DataFrame):
    """Why the star can't hold an event, or NULL: a value that its column's type can't."""
    reason = F.lit(None).cast("string")
    for source, target in FACT_SOURCES.items():
        value, kind = F.col(source), FACT_LISTENS.column(target).dtype
        if events.schema[source].dataType != kind:
            bad = value.isNotNull() & value.try_cast(kind).isNull()
            reason = F.coalesce(reason, F.when(bad, F.lit(f"bad_{source}")))
    return reason


def load_batch(events: DataFrame, batch_id: int, warehouse: str, arrival: str | None = None,
               loaded_at: dt.datetime | None = None, tie: list[str] | None = None,
               refreshes: Sequence[Callable[[SparkSession, str], object]] = (), dedupe: bool = False,
               cluster_partitions: int | None = None, keep_versions: int | None = 3,
               dim_buckets: dict[str, int] | None = None) -> dict[str, int] | None:
    """Load one batch (see the module notes). With ``dedupe`` an event already
    loaded (same content) is dropped instead of appended again; ``refreshes`` run after the commit;
    ``cluster_partitions`` clusters the fact write by day (backfills);
    ``keep_versions`` older versions of a dimension stay (None: all); ``dim_buckets``: hash buckets
    of each dimension, for its first load (more for more keys: a load rewrites whole buckets)."""
    spark = events.sparkSession
    ensure_conf(spark)              # UTC: instants become wall-clock days and keys in UTC
    if dedupe:
        events = drop_redelivered(events, batch_id, warehouse, arrival)
    every = events.withColumn("_reject", reject_reason(events)).persist()
    try:
        # reads the batch once, before several jobs share it
        rows, rejected = every.agg(F.count(F.lit(1)), F.count("_reject")).first()
        if rows == 0:
            return None
        ev = every.where(F.col("_reject").isNull()).drop("_reject")
        bad = every.where(F.col("_reject").isNotNull()).select(
            *[F.col(c).cast("string").alias(c) for c in EVENT_FIELDS], F.col("_reject").alias("reason"),
            F.lit(int(batch_id)).cast("bigint").alias("batch_id"))
        new_date = C.conform(dims.dim_date(ev), DIM_DATE)
        plan = [("dim_date", DIM_DATE, new_date, None),
                ("dim_tracks", DIM_TRACKS, dims.dim_tracks(ev, tie=tie, arrival=arrival, with_time=True),
                 merge.track_rules()),
                ("dim_users", DIM_USERS, dims.dim_users(ev, tie=tie, arrival=arrival),
                 merge.user_rules_with_device())]

        def write_dim(name, contract, new, rules):
            stored, key = C.with_columns(contract, EXTRA.get(name, [])), SORT_KEYS[name]
            place = parts.bucket(key, parts.buckets_of(spark, table_path(warehouse, name), (dim_buckets or DIM_BUCKETS)[name]))
            touched = [r[0] for r in new.select(place).distinct().collect()]        # a row per bucket at most
            cur = current_dim(spark, warehouse, name, stored, below=batch_id, only=touched)
            merged = merge.upsert(cur, new, stored, rules, loaded_at=loaded_at)
            return name, parts.replace_parts(merged, place, touched, table_path(warehouse, name), batch_id, [key])

        def write_facts():
            fact = C.conform(facts.fact_listens(ev, arrival=arrival), FACT_LISTENS, loaded_at=loaded_at)
            return "fact_listens", write_fact(fact, table_path(warehouse, "fact_listens"), batch_id,
                                              cluster_partitions=cluster_partitions)

        def write_rejects():
            if rejected:
                write_batch_partitions(bad, table_path(warehouse, REJECTS), ["batch_id"])
            return REJECTS, rejected

        # Independent jobs over the cached batch: submitted together they share the executors
        # instead of queueing one after another. The threads keep the query's job group.
        with ThreadPoolExecutor(max_workers=5) as pool:
            run = lambda f, *a: pool.submit(inheritable_thread_target(spark)(f), *a)
            futures = [run(write_dim, *p) for p in plan] + [run(write_facts), run(write_rejects)]
            counts = dict(f.result() for f in futures)
        if dedupe:
            record_seen(ev, batch_id, warehouse)
        summary = spark.createDataFrame([(int(batch_id), k, int(v)) for k, v in counts.items()],
                                        "batch_id bigint, table_name string, rows bigint")
        # the commit: readers see the batch's tables from here on, all of them
        write_snapshot(summary, table_path(warehouse, COMMITS), batch_id)
        if keep_versions:
            for name in SORT_KEYS:
                parts.drop_unused(spark, table_path(warehouse, name), keep_versions)
        for refresh in refreshes:
            refresh(spark, warehouse)
        return counts
    finally:
        every.unpersist()


def start_star_load(spark: SparkSession, source: str, schema, warehouse: str, checkpoint: str,
                    arrival: str | None = FILE_ROW, loaded_at: dt.datetime | None = None,
                    tie: list[str] | None = None,
                    refreshes: Sequence[Callable[[SparkSession, str], object]] = (),
                    dedupe: bool = False, every: str | None = None,
                    cluster_partitions: int | None = None, max_files: int | None = None,
                    max_bytes: int | None = None):
    """Incremental load of every Parquet file under ``source`` (a path, or a table of the catalog) not yet
    processed.

    By default one run takes what is new and stops (``availableNow``: a scheduled
    job); ``every="1 hour"`` keeps the query running with that trigger instead.
    ``arrival`` names the column that identifies an event's arrival; by default
    (``FILE_ROW``) that is its file and row index, so exact copies have distinct fact keys.
    ``max_files`` and ``max_bytes`` bound a micro-batch (a backlog is then loaded in many).
    """
    ensure_conf(spark)
    guard_checkpoint(spark, checkpoint, [table_path(warehouse, t) for t in TABLES])
    limits = {"maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes}
    reader = spark.readStream.options(**{k: v for k, v in limits.items() if v is not None})
    stream = reader.table(source) if is_table(spark, source) else reader.schema(schema).parquet(source)
    if arrival == FILE_ROW:
        # the row's place in its (immutable) file: unique and stable across retries
        stream = stream.withColumn(FILE_ROW, F.concat_ws(
            ":", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string")))
    writer = (stream.writeStream
              .foreachBatch(lambda df, bid: load_batch(df, bid, warehouse, arrival, loaded_at, tie,
                                                       refreshes, dedupe, cluster_partitions))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def read_star(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    out = {name: current_dim(spark, warehouse, name, c)
           for name, c in (("dim_date", DIM_DATE), ("dim_tracks", DIM_TRACKS), ("dim_users", DIM_USERS))}
    out["fact_listens"] = read_fact(spark, warehouse, committed_batch(spark, warehouse))
    return out


def read_rejects(spark: SparkSession, warehouse: str) -> DataFrame:
    """Events that the star couldn't hold, as text, with the reason and the batch."""
    schema = T.StructType([*[T.StructField(c, T.StringType()) for c in EVENT_FIELDS],
                           T.StructField("reason", T.StringType()), T.StructField("batch_id", T.LongType())])
    path, last = table_path(warehouse, REJECTS), committed_batch(spark, warehouse)
    if last is None or not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).where(F.col("batch_id") <= F.lit(int(last)))


def load_summary(spark: SparkSession, warehouse: str) -> DataFrame:
    """Rows per table as stored now (dimensions: latest version; fact: all batches)."""
    star = read_star(spark, warehouse)
    frames = [star[t].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table_name"), "rows")
              for t in TABLES]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
