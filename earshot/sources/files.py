"""Event files: Parquet tables, JSON Lines, JSON arrays, stream envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..schemas import ENVELOPE_SCHEMA, EVENT_FIELDS, EVENT_SCHEMA

# Event as written in JSON: the time is ISO-8601 text.
EVENT_JSON_SCHEMA = T.StructType(
    [f if f.name != "event_timestamp" else T.StructField("event_timestamp", T.StringType())
     for f in EVENT_SCHEMA.fields])


def register_events(spark: SparkSession, name: str, path: str, schema: T.StructType = EVENT_SCHEMA,
                    partitioned_by: list[str] | None = None) -> None:
    """Name a folder of Parquet event files in Spark's catalog, with its schema and partition columns
    (the last ones of ``schema``). Files and partitions added later are found when it is read."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING PARQUET {by} LOCATION '{path}'")
    refresh_events(spark, name)


def refresh_events(spark: SparkSession, name: str) -> None:
    """Find partitions and files that were added to a named table's folder."""
    state = spark._jsparkSession.sessionState()
    held = state.catalog().getTableMetadata(state.sqlParser().parseTableIdentifier(name))
    if held.tracksPartitionsInCatalog():            # a metastore's; else they are listed from the folder
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def is_table(spark: SparkSession, source: str) -> bool:
    """Is ``source`` the name of a table (and not a path)?"""
    return "/" not in source and spark.catalog.tableExists(source)


def read_events(spark: SparkSession, source: str, arrival: bool = False, schema: T.StructType | None = None) -> DataFrame:
    """Scan Parquet event files, by a table's name or a path (then with ``schema``, if given, instead of
    one inferred from a file). With ``arrival`` an ``_arrival`` id (file and row index) is added: unique
    per input row, stable across re-reads."""
    if is_table(spark, source):
        df = spark.table(source)
    else:
        df = (spark.read.schema(schema) if schema else spark.read).parquet(source)
    if arrival:
        df = df.withColumn("_arrival", F.concat_ws(
            ":", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string")))
    return df


def with_event_time(df: DataFrame) -> DataFrame:
    """ISO-8601 text -> instant (offset honoured, none = UTC); invalid -> NULL."""
    from ..functions.ingest import parse_event_time
    return df.withColumn("event_timestamp", parse_event_time(F.col("event_timestamp")))


RAW = "_raw"      # the text of a line or file that isn't an event
_READ_SCHEMA = T.StructType(
    [f if f.name != "listen_duration_ms" else T.StructField(f.name, T.DecimalType(38, 9))
     for f in EVENT_JSON_SCHEMA.fields] + [T.StructField(RAW, T.StringType())])


def _read_json(spark: SparkSession, path: str, whole_files: bool) -> DataFrame:
    """(source_file, value, e): each line (or file) of text and the event (or events) in it; e is NULL
    where there is none. Blank lines are skipped."""
    text = (spark.read.text(path, wholetext=whole_files)
            .select(F.col("_metadata.file_path").alias("source_file"), "value").where(F.trim("value") != ""))
    parsed = F.from_json("value", T.ArrayType(_READ_SCHEMA) if whole_files else _READ_SCHEMA,
                         {"columnNameOfCorruptRecord": RAW})
    read = text.withColumn("e", parsed)
    return read if whole_files else read.withColumn("e", F.when(F.col(f"e.{RAW}").isNull(), F.col("e")))


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON Lines of events (e.g. a redirected producer) with the event schema; durations are
    decimal. Lines that aren't events are left out; ``json_rejects`` has them."""
    events = _read_json(spark, path, False).where(F.col("e").isNotNull()).select("e.*")
    return with_event_time(events).select(*EVENT_FIELDS)


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """Files that each hold one JSON array of events; see ``read_json_lines``."""
    events = _read_json(spark, path, True).select(F.inline("e"))
    return with_event_time(events).select(*EVENT_FIELDS)


def json_rejects(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """(source_file, raw): text under ``path`` that ``read_json_lines`` (or, with ``whole_files``,
    ``read_json_array``) can't read as an event."""
    return (_read_json(spark, path, whole_files).where(F.col("e").isNull())
            .select("source_file", F.col("value").alias("raw")))


def with_line_order(envelopes: DataFrame) -> DataFrame:
    """``line``: grows with the envelope's position inside its file (a file's splits
    are read in offset order), the order of envelopes without sequence numbers.
    Batch DataFrames only (streaming plans refuse the id; ingest adds it per batch)."""
    return envelopes.withColumn("line", F.monotonically_increasing_id())


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Record batches ``{"Records": [...]}``, one per line."""
    return with_line_order(spark.read.schema(ENVELOPE_SCHEMA).json(path)
                           .withColumn("source_file", F.col("_metadata.file_path")))


def explode_envelopes(envelopes: DataFrame) -> DataFrame:
    """One row per record: (source_file, line, pos, seq, data).

    A missing or empty ``Records`` yields no rows; a record without ``kinesis``
    yields NULL data and is counted as failed by ingest.
    """
    keep = [c for c in ("source_file", "file_time", "line", "batch_id") if c in envelopes.columns]
    return envelopes.select(*keep, F.posexplode("Records").alias("pos", "rec")).select(
        *keep, "pos", F.col("rec.kinesis.sequenceNumber").alias("seq"),
        F.col("rec.kinesis.data").alias("data"))
