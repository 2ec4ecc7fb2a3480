"""Micro-batch ingest of record batches into the state log.

readStream (files of envelopes here; any source yielding the same columns works)
-> explode records -> ``parse_records`` -> foreachBatch:
accepted items -> state log partition ``batch_id=<n>``, rejects -> dead letters
``batch_id=<n>``, counters -> summary ``batch_id=<n>``. All three writes
overwrite only their batch's partition, so a batch re-run after a failure (the
checkpoint replays it with the same id) leaves exactly one copy. No watermark:
late events are always written (their expiry is handled by ``live_state``).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import ingest
from ..schemas import ENVELOPE_SCHEMA
from ..session import ensure_conf, guard_checkpoint, hadoop_fs, list_dirs, path_exists
from ..sinks import parts
from ..sinks.files import write_batch_partitions
from ..sources.files import explode_envelopes, with_line_order
from .state import ITEM_COLUMNS, LOG_SCHEMA, compact_state, epoch_seconds, latest_state, live_state, write_order


def state_paths(root: str) -> dict[str, str]:
    return {"log": f"{root}/state_log", "dead": f"{root}/dead_letters",
            "summary": f"{root}/batch_summary", "compacted": f"{root}/state_compacted"}


def process_batch(records: DataFrame, batch_id: int, root: str, payload: str | None = None) -> None:
    """Parse one micro-batch of records and write its three outputs.

    ``records`` has ``seq``, ``source_file``, ``pos`` and either base64 ``data`` or a
    binary ``payload`` column (named by ``payload``); or it is a batch of envelopes
    (a ``Records`` column), which is exploded here.
    """
    paths = state_paths(root)
    ensure_conf(records.sparkSession)
    if "Records" in records.columns:          # envelopes: number lines, then explode
        records = explode_envelopes(with_line_order(records))
    spark = records.sparkSession
    own = records.columns
    parallelism = spark.sparkContext.defaultParallelism
    if payload is not None and "data" not in records.columns:
        records = records.withColumn("data", F.base64(F.col(payload)))   # kept for dead letters
    parsed = (ingest.parse_records(records, partitions=parallelism, payload=payload)
              .withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
              # the raw payload is kept only where it is needed: dead letters
              .withColumn("data", F.when(F.col("error").isNotNull(), F.col("data")))
              .withColumns(write_order(F.col("seq"), F.col("source_file"), F.col("pos"),
                                       F.col("line") if "line" in own else F.lit(0),
                                       F.col("file_time") if "file_time" in own else F.lit(0)))
              .persist())
    try:
        parsed.count()              # parses the batch once, before several jobs share it
        items = parsed.where(F.col("error").isNull()).select(
            *ITEM_COLUMNS, "seq_len", "seq", "file_time", "source_file", "line", "pos", "batch_id")
        dead = parsed.where(F.col("error").isNotNull()).select(
            "batch_id", "source_file", "pos", "seq", "data", "error")
        summary = ingest.summary(parsed).withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
        # independent jobs over the cached parse, submitted together
        with ThreadPoolExecutor(max_workers=3) as pool:
            write = inheritable_thread_target(spark)(write_batch_partitions)
            for f in [pool.submit(write, items, paths["log"], ["batch_id"]),
                      pool.submit(write, dead, paths["dead"], ["batch_id"]),
                      pool.submit(write, summary, paths["summary"], ["batch_id"])]:
                f.result()
    finally:
        parsed.unpersist()


def envelope_records(spark: SparkSession, source: str,
                     max_files_per_trigger: int | None = None,
                     max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Streaming envelopes from files (one ``{"Records": [...]}`` per line); each
    micro-batch is exploded into records by ``process_batch``. The limits bound a
    micro-batch (a backlog is then read in many)."""
    reader = spark.readStream.schema(ENVELOPE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
    return reader.json(source).withColumns({
        "source_file": F.col("_metadata.file_path"),
        "file_time": F.unix_micros("_metadata.file_modification_time")})


def keyed_log_records(messages: DataFrame) -> DataFrame:
    """Records from a keyed log source with Kafka's columns (topic, partition, offset,
    value): the offset orders writes within a partition, and a user's records share a
    partition, so (partition, offset) is the per-user arrival order."""
    return messages.select(
        F.col("offset").cast("string").alias("seq"),
        F.concat_ws(":", F.col("topic"), F.col("partition").cast("string")).alias("source_file"),
        F.lit(0).alias("pos"),
        F.col("value").cast("binary").alias("payload"))


def run_ingest(records: DataFrame, root: str, checkpoint: str, available_now: bool = True,
               processing_time: str | None = None, payload: str | None = None):
    """Start the ingest stream over any streaming DataFrame of records (or envelopes)."""
    ensure_conf(records.sparkSession)
    guard_checkpoint(records.sparkSession, checkpoint, [state_paths(root)["log"]])
    writer = (records.writeStream
              .foreachBatch(lambda df, bid: process_batch(df, bid, root, payload))
              .option("checkpointLocation", checkpoint))
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def start_ingest(spark: SparkSession, source: str, root: str, checkpoint: str,
                 available_now: bool = True, max_files_per_trigger: int | None = None,
                 processing_time: str | None = None, max_bytes_per_trigger: int | None = None):
    """Start the ingest stream over envelope files under ``source``."""
    return run_ingest(envelope_records(spark, source, max_files_per_trigger, max_bytes_per_trigger), root, checkpoint,
                      available_now, processing_time)


STATE_BUCKETS = 16          # of a store's first compaction: hash buckets of the user
#: A lookup of one user skips the files and row groups that surely don't hold them.
_BLOOM = {"parquet.bloom.filter.enabled#user_id": "true", "parquet.bloom.filter.expected.ndv#user_id": "100000"}


def _newer(spark: SparkSession, root: str, done: int | None) -> DataFrame:
    """Log batches after the last compaction (pruned by ``batch_id``)."""
    path = state_paths(root)["log"]
    if not path_exists(spark, path):
        return spark.createDataFrame([], LOG_SCHEMA)
    log = spark.read.schema(LOG_SCHEMA).parquet(path)
    return log if done is None else log.where(F.col("batch_id") > F.lit(int(done)))


def read_log(spark: SparkSession, root: str) -> DataFrame:
    """The state log to read: the newest committed compaction (covering batches up to
    its version) plus only the log batches after it."""
    store = state_paths(root)["compacted"]
    done = parts.newest(spark, store)
    log = _newer(spark, root, done)
    return log if done is None else parts.read_parts(spark, store, LOG_SCHEMA, done + 1).unionByName(log)


def lookup(spark: SparkSession, root: str, user_id: str, timestamp: str | None = None, as_of=None) -> DataFrame:
    """The latest items of one user (at one time, if given; live at ``as_of``, if given): reads the user's
    bucket of the compacted state, with the filters pushed to its sorted files, and the newer batches."""
    store = state_paths(root)["compacted"]
    done = parts.newest(spark, store)
    log = _newer(spark, root, done)
    if done is not None:
        n = parts.buckets_of(spark, store, STATE_BUCKETS)
        own = spark.createDataFrame([(user_id,)], "user_id string").select(parts.bucket("user_id", n)).first()[0]
        log = parts.read_parts(spark, store, LOG_SCHEMA, done + 1, only=[own]).unionByName(log)
    log = log.where(F.col("user_id") == F.lit(user_id))
    if timestamp is not None:
        log = log.where(F.col("timestamp") == F.lit(timestamp))
    found = latest_state(log)
    return found if as_of is None else live_state(found, as_of)


def compact(spark: SparkSession, root: str, as_of, trim: bool = True, buckets: int = STATE_BUCKETS) -> int:
    """Fold the log batches written since the last compaction into the compacted state, which holds the
    latest items in hash buckets of the user (``sinks.parts``), sorted by key. Only buckets that new
    items fall into are rewritten, without what has expired; a bucket whose items have all expired
    is dropped. Later reads skip the log up to that batch. Returns the items live at ``as_of``. With
    no new batch nothing is rewritten. ``trim`` removes the log batches that an earlier compaction
    covers, and files that neither of the two newest compactions uses."""
    paths = state_paths(root)
    store = paths["compacted"]
    batches = [int(n.split("=")[1]) for n in list_dirs(spark, paths["log"]) if n.startswith("batch_id=")]
    upto, done = max(batches, default=None), parts.newest(spark, store)
    if upto is None and done is None:
        return 0
    if upto is not None and (done is None or upto > done):
        place = parts.bucket("user_id", parts.buckets_of(spark, store, buckets))
        new = _newer(spark, root, done)
        touched = [r[0] for r in new.select(place).distinct().collect()]           # a row per bucket at most
        held = parts.read_parts(spark, store, LOG_SCHEMA, only=touched)
        kept = compact_state(held.unionByName(new), as_of).select(
            *ITEM_COLUMNS, F.lit(-1).cast("int").alias("seq_len"), F.lit("").alias("seq"), F.lit(0).cast("bigint").alias("file_time"),
            F.lit("").alias("source_file"), F.lit(0).cast("bigint").alias("line"), F.lit(0).alias("pos"), F.lit(-1).cast("bigint").alias("batch_id"))
        rest = [p for p in parts.manifest(spark, store) if p not in set(touched)]
        ends = parts.read_parts(spark, store, LOG_SCHEMA, only=rest).groupBy(place.alias("part")).agg(F.max("ttl").alias("ttl"))
        gone = [r["part"] for r in ends.where(F.coalesce("ttl", F.lit(0)) <= F.lit(epoch_seconds(as_of))).collect()]
        parts.replace_parts(kept, place, touched + gone, store, int(upto), ["user_id", "timestamp"], _BLOOM)
        if trim:
            for b in batches:           # the version before this one has long replaced these batches
                if done is not None and b <= done:
                    fs, p = hadoop_fs(spark, f"{paths['log']}/batch_id={b}")
                    fs.delete(p, True)
            parts.drop_unused(spark, store, 2)
    return live_state(parts.read_parts(spark, store, LOG_SCHEMA), as_of).count()
