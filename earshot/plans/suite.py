"""Registered queries: (spark, sf_dir) -> DataFrame, one per operator of the inventory.

All of them start from the driver's tables through ``sources.overlay`` and run
over the whole tables.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import dims, facts, ingest, latest, marts, merge, quality, reports
from ..operators.distinct import distinct_totals
from ..operators.conform import conform, ntz_literal
from ..plans import compaction as CO
from ..plans import load as L
from ..plans import refresh as RF
from ..schemas import ACTIONS, DIM_DATE, DIM_TRACKS, DIM_USERS, FACT_LISTENS
from ..session import ensure_conf, shared_dir
from ..sinks import files as W
from ..sinks.publish import keyed_records, publish
from ..sources import files as R
from ..sources.overlay import listening_events
from ..sources.records import clean_records, envelopes, event_json, test_records
from ..streaming import ingest_stream as S
from ..streaming import state as ST

AS_OF = dt.date(2024, 2, 10)          # report date inside the test data
LOADED_AT = dt.datetime(2024, 2, 1)   # fixed load time for audit columns


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    return listening_events(spark, sf_dir)


def _dim_users(ev):
    return conform(dims.dim_users(ev, tie=["event_id"]), DIM_USERS, loaded_at=LOADED_AT)


def most_skipped_tracks(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return reports.most_skipped_tracks(facts.fact_listens(ev, arrival="event_id"),
                                       dims.dim_tracks(ev, tie=["event_id"]), dims.dim_date(ev),
                                       as_of=AS_OF, top=10)


def mv_daily_user_summary(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return marts.daily_user_summary(facts.fact_listens(ev, arrival="event_id"), _dim_users(ev),
                                    dims.dim_date(ev))


def mv_track_performance(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return marts.track_performance(facts.fact_listens(ev, arrival="event_id"),
                                   dims.dim_tracks(ev, tie=["event_id"]))


def dim_date(spark, sf_dir):
    return dims.dim_date(_events(spark, sf_dir))


def dim_tracks(spark, sf_dir):
    return dims.dim_tracks(_events(spark, sf_dir), tie=["event_id"])


def dim_users(spark, sf_dir):
    return dims.dim_users(_events(spark, sf_dir), tie=["event_id"])


def fact_listens(spark, sf_dir):
    return facts.fact_listens(_events(spark, sf_dir), arrival="event_id")


# ---- overlay variants ------------------------------------------------------------------


HALF = dt.datetime(2024, 1, 15)
MERGED_AT = dt.datetime(2024, 2, 2)


def _before(ev: DataFrame, t: dt.datetime) -> DataFrame:
    return ev.where(F.col("event_timestamp") < ntz_literal(t))


def _parts(ev: DataFrame) -> list[DataFrame]:
    """Even, then odd event ids: both have events of every day and of most users and tracks."""
    return [ev.where(F.col("event_id") % 2 == r) for r in (0, 1)]


def _from(ev: DataFrame, t: dt.datetime) -> DataFrame:
    return ev.where(F.col("event_timestamp") >= ntz_literal(t))


def day_events(ev: DataFrame) -> DataFrame:
    """Event time truncated to the day: keys of the same user and day collide."""
    return ev.withColumn("event_timestamp", F.to_date("event_timestamp").cast("timestamp_ntz"))


def flawed_events(ev: DataFrame) -> DataFrame:
    """NULL action where event_id % 97 = 0, out-of-domain 'REWIND' where % 89 = 0."""
    return ev.withColumn("action", F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("string"))
                         .when(F.col("event_id") % 89 == 0, F.lit("REWIND"))
                         .otherwise(F.col("action")))


def _fact(spark, sf_dir):
    return facts.fact_listens(_events(spark, sf_dir), arrival="event_id")


def scan_events(spark, sf_dir):
    return _events(spark, sf_dir)


def scan_catalog(spark, sf_dir):
    """Events of a partitioned table in the catalog, half of its days added after it was named."""
    root, name = _run_dir(spark, "catalog"), f"events_{uuid.uuid4().hex[:12]}"
    ev = _events(spark, sf_dir).withColumn("arrival_day", F.to_date("event_timestamp"))
    for i, part in enumerate((_before(ev, HALF), _from(ev, HALF))):
        part.repartition("arrival_day").write.partitionBy("arrival_day").mode("append").parquet(root)
        if i == 0:
            R.register_events(spark, name, root, ev.schema, ["arrival_day"])
    R.refresh_events(spark, name)
    week = F.col("arrival_day").between(F.lit(HALF.date() - dt.timedelta(days=3)), F.lit(HALF.date() + dt.timedelta(days=3)))
    return R.read_events(spark, name).where(week).drop("arrival_day")


def load_catalog(spark, sf_dir):
    """The fact loaded from a table of the catalog instead of a path."""
    root, name = _run_dir(spark, "catalog-load"), f"events_{uuid.uuid4().hex[:12]}"
    ev = _events(spark, sf_dir)
    _write_source(ev, root, 0)
    R.register_events(spark, name, f"{root}/src/part=0", ev.schema)
    L.start_star_load(spark, name, None, f"{root}/warehouse", f"{root}/ckpt", arrival="event_id", loaded_at=LOADED_AT,
                      tie=["event_id"]).awaitTermination()
    return L.read_star(spark, f"{root}/warehouse")["fact_listens"].select(*facts.FACT_COLUMNS)


def source_count(spark, sf_dir):
    return _events(spark, sf_dir).agg(F.count(F.lit(1)).alias("rows"))


def project_events(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "event_id", "user_id", "track_id", "action",
        F.col("listen_duration_ms").alias("duration_ms"), F.col("event_timestamp").alias("played_at"))


def filter_action(spark, sf_dir):
    return (_events(spark, sf_dir).where(F.col("action") == F.lit("SKIP"))
            .select("event_id", "user_id", "track_id", "listen_duration_ms"))


def filter_last_month(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return reports.last_month(facts.fact_listens(ev, arrival="event_id"), dims.dim_date(ev), AS_OF) \
        .select("listen_key", "date_key", "full_date")


def action_counts(spark, sf_dir):
    return _fact(spark, sf_dir).groupBy("date_key").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(marts.action_is("PLAY")).alias("plays"),
        F.count_if(marts.action_is("SKIP")).alias("skips"),
        F.count_if(marts.action_is("COMPLETE")).alias("completes"))


def listening_minutes(spark, sf_dir):
    return _fact(spark, sf_dir).groupBy("user_key").agg(
        marts.minutes(F.sum("duration_ms")).alias("total_minutes"))


def avg_listen_seconds(spark, sf_dir):
    return _fact(spark, sf_dir).groupBy("track_key").agg(
        (F.avg("duration_ms") / F.lit(1000.0)).alias("avg_listen_seconds"))


def distinct_counts(spark, sf_dir):
    return distinct_totals(_fact(spark, sf_dir).select("date_key", "user_key", "track_key", "session_id"), ["date_key"],
                           {"unique_users": "user_key", "unique_tracks": "track_key", "sessions": "session_id"}, {})


def skip_rate(spark, sf_dir):
    n, s = F.count(F.lit(1)), F.count_if(marts.action_is("SKIP"))
    return _fact(spark, sf_dir).groupBy("track_key").agg(
        n.alias("total_events"), s.alias("skips"),
        F.round(marts.safe_ratio(F.lit(100.0) * s, n), 2).alias("skip_rate"))


def distinct_dates(spark, sf_dir):
    return _events(spark, sf_dir).select(F.to_date("event_timestamp").alias("full_date")).distinct()


def latest_track_record(spark, sf_dir):
    return latest.latest_per_key(_events(spark, sf_dir), ["track_id"], ["event_timestamp"],
                                 tie=["event_id"],
                                 cols=["track_title", "artist", "event_timestamp", "event_id"])


def user_first_seen(spark, sf_dir):
    return _events(spark, sf_dir).groupBy("user_id").agg(F.min("event_timestamp").alias("first_seen"))


def user_last_seen(spark, sf_dir):
    return _events(spark, sf_dir).groupBy("user_id").agg(F.max("event_timestamp").alias("last_seen"))


def user_primary_device(spark, sf_dir):
    return _events(spark, sf_dir).groupBy("user_id").agg(
        F.max_by("device_type", F.struct("event_timestamp", "event_id")).alias("primary_device"))


def _known(ev: DataFrame, name: str) -> DataFrame:
    """Events whose ``name`` doesn't end in 7: what else refers to those has no dimension row."""
    return ev.where(~F.col(name).cast("string").endswith("7"))


def _stored(spark, dim: DataFrame, name: str) -> DataFrame:
    """The dimension as a load would have stored it. A join reads it through an exchange of its own,
    so the planner can split a hot key of the event side."""
    path = _run_dir(spark, name)
    W.append_table(dim, path)
    return spark.read.schema(dim.schema).parquet(path)


def lookup_user_key(spark, sf_dir):
    ev = _events(spark, sf_dir)
    du = _stored(spark, dims.dim_users(_known(ev, "user_id"), tie=["event_id"]), "dim-users")
    return facts.lookup_key(ev.select("event_id", "user_id"), du, "user_id", "user_key")


def lookup_track_key(spark, sf_dir):
    ev = _events(spark, sf_dir)
    dtr = _stored(spark, dims.dim_tracks(_known(ev, "track_id"), tie=["event_id"]), "dim-tracks")
    return facts.lookup_key(ev.select("event_id", "track_id"), dtr, "track_id", "track_key")


def conform_users(spark, sf_dir):
    return conform(dims.dim_users(_events(spark, sf_dir), tie=["event_id"]), DIM_USERS,
                   loaded_at=LOADED_AT)


def upsert_dimension(spark, sf_dir):
    ev = _events(spark, sf_dir)
    target = conform(dims.dim_users(_before(ev, HALF), tie=["event_id"]), DIM_USERS, loaded_at=LOADED_AT)
    source = dims.dim_users(_from(ev, HALF), tie=["event_id"])
    return merge.upsert(target, source, DIM_USERS, merge.user_rules_with_device(), loaded_at=MERGED_AT)


def check_pk(spark, sf_dir):
    """Dimensions appended per batch (as a plain append load does) repeat their keys."""
    ev = day_events(_events(spark, sf_dir))
    h1, h2 = _before(ev, HALF), _from(ev, HALF)
    tie = ["event_id"]
    return quality.check_pk({
        "dim_date": (dims.dim_date(h1).unionByName(dims.dim_date(h2)), "date_key"),
        "dim_tracks": (dims.dim_tracks(h1, tie=tie).unionByName(dims.dim_tracks(h2, tie=tie)), "track_key"),
        "dim_users": (dims.dim_users(h1, tie=tie).unionByName(dims.dim_users(h2, tie=tie)), "user_key"),
        "fact_listens": (facts.fact_listens(h1).unionByName(facts.fact_listens(h2)), "listen_key"),
    })


def check_fk(spark, sf_dir):
    ev = _events(spark, sf_dir)
    days = _known(ev.withColumn("_day", F.date_format("event_timestamp", "yyyyMMdd")), "_day")
    return quality.check_fk(facts.fact_listens(ev, arrival="event_id"), {
        "user_key": (dims.dim_users(_known(ev, "user_id"), tie=["event_id"]), "user_key", "dim_users"),
        "track_key": (dims.dim_tracks(_known(ev, "track_id"), tie=["event_id"]), "track_key", "dim_tracks"),
        "date_key": (dims.dim_date(days), "date_key", "dim_date"),
    })


def check_columns(spark, sf_dir):
    """NOT NULL and length checks of all four star tables (the fact with flawed actions)."""
    ev = flawed_events(_events(spark, sf_dir))
    tie = ["event_id"]
    checks = [quality.check_columns(facts.fact_listens(ev, arrival="event_id"), FACT_LISTENS),
              quality.check_columns(conform(dims.dim_date(ev), DIM_DATE), DIM_DATE),
              quality.check_columns(conform(dims.dim_tracks(ev, tie=tie), DIM_TRACKS), DIM_TRACKS),
              quality.check_columns(conform(dims.dim_users(ev, tie=tie), DIM_USERS), DIM_USERS)]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def check_action_domain(spark, sf_dir):
    f = facts.fact_listens(flawed_events(_events(spark, sf_dir)), arrival="event_id")
    return quality.check_domain(f, "action", ACTIONS)


# ---- ingest -------------------------------------------------------------------------------


def _parsed(spark, sf_dir):
    """The events are dealt out before their fields are written and rendered: writing and parsing a record is the work."""
    ensure_conf(spark)
    ev = listening_events(spark, sf_dir,
                          lambda rows, key: ingest.spread(rows, spark.sparkContext.defaultParallelism, key))
    return ingest.parse_records(test_records(ev))


def decode_payload(spark, sf_dir):
    return _parsed(spark, sf_dir).select("event_id", "decoded")


def parse_payload(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        "event_id", "parsed", F.when(F.col("parsed"), F.col("user_id")).alias("user_id"))


def validate_required(spark, sf_dir):
    return _parsed(spark, sf_dir).where("parsed").select("event_id", "missing_field")


def parse_event_time(spark, sf_dir):
    return _parsed(spark, sf_dir).where("parsed").select(
        "event_id", F.unix_micros("event_time").alias("event_time_us"))


def event_ttl(spark, sf_dir):
    return _parsed(spark, sf_dir).where(F.col("parsed") & F.col("event_time").isNotNull()) \
        .select("event_id", "ttl")


def apply_defaults(spark, sf_dir):
    return _parsed(spark, sf_dir).where("parsed").select("event_id", "track_title", "artist",
                                                         "device_type")


def duration_decimal(spark, sf_dir):
    return _parsed(spark, sf_dir).where("parsed").select("event_id", "listen_duration_ms")


def split_rejects(spark, sf_dir):
    return ingest.rejected(_parsed(spark, sf_dir)).select("event_id", "error")


def ingest_summary(spark, sf_dir):
    return ingest.summary(_parsed(spark, sf_dir))


def state_items(spark, sf_dir):
    return ingest.state_items(_parsed(spark, sf_dir))


# ---- files, streams, loads -------------------------------------------------------------------

LIVE_AS_OF = dt.datetime(2024, 1, 20)


def _run_dir(spark, name):
    return shared_dir(spark, "runs", name, unique=True)


def _ntz(df, col="event_timestamp"):
    return df.withColumn(col, F.col(col).cast("timestamp_ntz"))


def _whole_ms(df):
    return df.withColumn("listen_duration_ms", F.col("listen_duration_ms").cast("bigint"))


def json_rejects(spark, sf_dir):
    """Every 59th line is cut short, every 61st has a fractional duration (which is kept)."""
    root = _run_dir(spark, "jsonl-bad")
    ev, i = _events(spark, sf_dir), F.col("event_id")
    text = F.when(i % 59 == 0, F.substring(event_json(ev), 1, 20)).when(i % 61 == 0, F.regexp_replace(
        event_json(ev), '"listen_duration_ms":([0-9]+)', '"listen_duration_ms":$1.5')).otherwise(event_json(ev))
    W.write_jsonl(ev.select(text.alias("value")), root)
    good = R.read_json_lines(spark, root).agg(F.count("user_id").alias("events"), F.sum("listen_duration_ms").cast("decimal(20,1)").cast("string").alias("total"))
    bad = R.json_rejects(spark, root).agg(F.count("raw").alias("rejects"), F.min(F.length("raw")).cast("bigint").alias("least"))
    return good.crossJoin(bad)              # one row each


def explode_envelopes(spark, sf_dir):
    root = _run_dir(spark, "envelopes")
    ev = _events(spark, sf_dir)
    W.write_jsonl(envelopes(test_records(ev), bare_every=7), root)
    return R.explode_envelopes(R.read_envelopes(spark, root)).select(
        F.col("seq").cast("bigint").alias("event_id"), "pos", F.col("data").isNotNull().alias("has_data"))


def read_jsonl(spark, sf_dir):
    root = _run_dir(spark, "jsonl")
    ev = _events(spark, sf_dir)
    W.write_jsonl(ev.select(event_json(ev).alias("value")), root)
    return _whole_ms(_ntz(R.read_json_lines(spark, root)))


def read_json_array(spark, sf_dir):
    root = _run_dir(spark, "jsonarray")
    ev = _events(spark, sf_dir)
    arrays = (ev.groupBy(F.floor(F.col("event_id") / 2000).alias("chunk"))      # records of one file
              .agg(F.to_json(F.collect_list(F.from_json(event_json(ev), R.EVENT_JSON_SCHEMA)))
                   .alias("value")))
    arrays.select("value").write.mode("overwrite").option("maxRecordsPerFile", 1).text(root)
    return _whole_ms(_ntz(R.read_json_array(spark, root)))


def write_jsonl(spark, sf_dir):
    root = _run_dir(spark, "jsonl-out")
    ev = _events(spark, sf_dir)
    W.write_jsonl(keyed_records(ev), root)
    return spark.read.text(root).select(
        F.get_json_object("value", "$.user_id").alias("user_id"),
        F.get_json_object("value", "$.track_id").alias("track_id"),
        F.get_json_object("value", "$.event_timestamp").alias("event_timestamp"))


def publish_keyed(spark, sf_dir):
    ev = _events(spark, sf_dir)
    rec = keyed_records(ev)
    parsed = F.from_json("value", R.EVENT_JSON_SCHEMA)
    return rec.select("key", parsed.alias("e")).select(
        "key", "e.user_id", "e.track_id", "e.action", "e.listen_duration_ms",
        F.col("e.event_timestamp").alias("event_timestamp"))


def _halves(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return _before(ev, HALF), _from(ev, HALF)


def _write_source(df, root, part):
    df.write.mode("overwrite").parquet(f"{root}/src/part={part}")


def incremental_scan(spark, sf_dir):
    """Three runs of one incremental scan over a folder that gains files: each run
    sees only new files; the sink ends with every row exactly once."""
    root = _run_dir(spark, "incremental")
    h1, h2 = _halves(spark, sf_dir)
    schema = h1.schema
    sink = f"{root}/sink"

    def run():
        q = (spark.readStream.schema(schema).parquet(f"{root}/src/*")
             .writeStream.format("parquet").option("path", sink)
             .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
        q.awaitTermination()

    _write_source(h1, root, 1)
    run()
    _write_source(h2, root, 2)
    run()
    run()
    return spark.read.schema(schema).parquet(sink)


def _ingest_runs(spark, parts, name):
    """Envelope files written part after part, one availableNow run after each."""
    root = _run_dir(spark, name)
    for i, recs in enumerate(parts):
        W.write_jsonl(envelopes(recs), f"{root}/in/part={i}")
        S.start_ingest(spark, f"{root}/in/*", root, f"{root}/ckpt").awaitTermination()
    return root


def _ingest_more(spark, root, recs, part):
    W.write_jsonl(envelopes(recs), f"{root}/in/part={part}")
    S.start_ingest(spark, f"{root}/in/*", root, f"{root}/ckpt").awaitTermination()


def stream_ingest(spark, sf_dir):
    h1, h2 = _halves(spark, sf_dir)
    root = _ingest_runs(spark, [test_records(h1), test_records(h2)], "stream")
    return ST.latest_state(S.read_log(spark, root))


def _day_records(ev):
    return clean_records(ev, F.date_format("event_timestamp", "yyyy-MM-dd"))


def latest_state(spark, sf_dir):
    """The second batch overwrites keys (user and day) of the first."""
    even, odd = _parts(_events(spark, sf_dir))
    root = _ingest_runs(spark, [_day_records(even), _day_records(odd)], "latest")
    return ST.latest_state(S.read_log(spark, root))


def live_state(spark, sf_dir):
    return ST.live_state(latest_state(spark, sf_dir), LIVE_AS_OF)


def late_events_kept(spark, sf_dir):
    """Newer events first, older ones in a later batch: all are written."""
    h1, h2 = _halves(spark, sf_dir)
    root = _ingest_runs(spark, [clean_records(h2), clean_records(h1)], "late")
    log = S.read_log(spark, root)
    return log.where(F.col("batch_id") == 1).select("user_id", "timestamp", "ttl",
                                                    F.col("batch_id").cast("bigint").alias("batch_id"))


def append_table(spark, sf_dir):
    root = _run_dir(spark, "append")
    ev = _events(spark, sf_dir)
    path = f"{root}/fact_listens"
    for half in (_before(ev, HALF), _from(ev, HALF)):
        W.append_table(facts.fact_listens(half, arrival="event_id"), path, mode="append")
    return spark.read.parquet(path)


def fact_layout(spark, sf_dir):
    root = _run_dir(spark, "layout")
    path = f"{root}/fact_listens"
    W.write_fact(_fact(spark, sf_dir), path)
    return spark.read.parquet(path).select(*facts.FACT_COLUMNS)


def _load_parts(spark, parts, **options):
    """The star after one load per part, each of a new folder of files."""
    root = _run_dir(spark, "star")
    wh = f"{root}/warehouse"
    options = {"arrival": "event_id", "tie": ["event_id"]} | options
    for i, part in enumerate(parts):
        _write_source(part, root, i)
        L.start_star_load(spark, f"{root}/src/*", parts[0].schema, wh, f"{root}/ckpt", loaded_at=LOADED_AT,
                          **options).awaitTermination()
    return wh


def _loaded_star(spark, sf_dir, **options):
    return _load_parts(spark, _parts(_events(spark, sf_dir)), **options)


def star_load_dims(spark, sf_dir):
    """The three stored dimensions when the newer half of the events arrives first."""
    star = L.read_star(spark, _load_parts(spark, _halves(spark, sf_dir)[::-1]))
    time = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    def rows(name, key, *texts):
        return star[name].select(F.lit(name).alias("table_name"), F.col(key).cast("bigint").alias("key"),
                                 *[F.col(t).cast("string").alias(f"v{i}") if isinstance(t, str) else t.alias(f"v{i}")
                                   for i, t in enumerate(texts)])
    return (rows("dim_date", "date_key", "full_date", "day_name", "month_name", "quarter")
            .unionByName(rows("dim_tracks", "track_key", "track_id", "title", "artist", "album"))
            .unionByName(rows("dim_users", "user_key", "user_id", time("first_seen"), time("last_seen"), "primary_device")))


def star_load_empty(spark, sf_dir):
    """A file without rows commits nothing: the row counts of all commits are the first batch's."""
    ev = _events(spark, sf_dir)
    wh = _load_parts(spark, [ev, ev.limit(0)])
    return spark.read.parquet(f"{L.table_path(wh, L.COMMITS)}/v=*").select("batch_id", "table_name", "rows")


def check_pk_load(spark, sf_dir):
    """Events without an arrival id, every one twice: the default load gives each its own key."""
    ev = _events(spark, sf_dir).drop("event_id")
    wh = _load_parts(spark, [ev, ev], arrival=L.FILE_ROW, tie=None)
    return quality.check_pk({"fact_listens": (L.read_star(spark, wh)["fact_listens"], "listen_key")})


def odd_events(ev: DataFrame) -> DataFrame:
    """NULL time where event_id % 41 = 0; where event_id % 43 is 1 or 2, one event each whose title and
    artist differ but have the same text when joined by '|'."""
    c, joint = F.col("event_id") % 43, F.col("event_id") - F.col("event_id") % 43
    pair = c.isin(1, 2)
    same = {name: F.when(pair, F.lit(text)).otherwise(F.col(name)) for name, text in
            (("user_id", "user_pair"), ("session_id", "sess_pair"), ("track_id", "tpair"), ("action", "PLAY"), ("device_type", "MOBILE"))}
    return ev.withColumns(same | {
        "track_title": F.when(c == 1, F.concat(joint.cast("string"), F.lit("A|B"))).when(c == 2, F.concat(joint.cast("string"), F.lit("A"))).otherwise(F.col("track_title")),
        "artist": F.when(c == 1, F.lit("C")).when(c == 2, F.lit("B|C")).otherwise(F.col("artist")),
        "listen_duration_ms": F.when(pair, 1000).otherwise(F.col("listen_duration_ms")),
        "event_timestamp": F.when((F.col("event_id") % 41 == 0) | pair, F.lit(None)).otherwise(F.col("event_timestamp"))})


def dedupe_load(spark, sf_dir):
    """Even events, then all events twice: each different event is loaded once."""
    ev = odd_events(_events(spark, sf_dir))
    wh = _load_parts(spark, [_parts(ev)[0], ev.unionByName(ev)], dedupe=True)
    return L.read_star(spark, wh)["fact_listens"].select(
        "user_key", "track_key", "date_key", "session_id", "action", "duration_ms", "device_type", "event_timestamp")


def load_rejects(spark, sf_dir):
    """A duration that the fact's type can't hold goes to the rejects; the rest of its batch is loaded."""
    ev = _events(spark, sf_dir)
    ev = ev.withColumn("listen_duration_ms", F.when(F.col("event_id") % 101 == 0, F.lit(3_000_000_000))
                       .otherwise(F.col("listen_duration_ms")).cast("bigint"))
    wh = _load_parts(spark, _parts(ev))
    bad = L.read_rejects(spark, wh).select("user_id", "session_id", "listen_duration_ms", "reason", "batch_id")
    loaded = L.read_star(spark, wh)["fact_listens"].agg(F.count(F.lit(1)).alias("n"))
    return bad.unionByName(loaded.select(F.lit(None).cast("string").alias("user_id"), F.lit(None).cast("string").alias("session_id"),
                                         F.col("n").cast("string").alias("listen_duration_ms"), F.lit("loaded").alias("reason"),
                                         F.lit(-1).cast("bigint").alias("batch_id")))


def publish_counts(spark, sf_dir):
    """Counters of a publish in which every 53rd record has no value."""
    ev = _events(spark, sf_dir)
    records = ev.select("event_id", F.col("user_id").alias("key"), event_json(ev).alias("value")).withColumn(
        "value", F.when(F.col("event_id") % 53 != 0, F.col("value"))).drop("event_id")
    path = _run_dir(spark, "published")
    counts = publish(records, "json", path=path)
    sent = spark.read.schema("key string, value string").json(path).agg(F.count("value").alias("stored"))
    return sent.select(F.lit(counts["sent"]).cast("bigint").alias("sent"), F.lit(counts["failed"]).cast("bigint").alias("failed"), "stored")


def star_load(spark, sf_dir):
    wh = _loaded_star(spark, sf_dir)
    return L.read_star(spark, wh)["fact_listens"].select(*facts.FACT_COLUMNS)


def load_summary(spark, sf_dir):
    return L.load_summary(spark, _loaded_star(spark, sf_dir))


def refresh_daily_by_date(spark, sf_dir):
    """The daily mart, brought up to date after each of two loads."""
    return RF.read_daily(spark, _loaded_star(spark, sf_dir, refreshes=[RF.refresh_daily]))


def refresh_track_performance(spark, sf_dir):
    """The track mart after three loads: refreshed by the first, and for the other two together."""
    ev = _events(spark, sf_dir)
    wh = _load_parts(spark, [ev.where(F.col("event_id") % 3 == 0)], refreshes=[RF.refresh_tracks])
    for batch in (1, 2):
        L.load_batch(ev.where(F.col("event_id") % 3 == batch), batch, wh, arrival="event_id", tie=["event_id"], loaded_at=LOADED_AT)
    RF.refresh_tracks(spark, wh)
    return RF.read_tracks(spark, wh)


ROLLING = [dt.date(2024, 1, 31), AS_OF, dt.date(2024, 2, 20)]


def most_skipped_rolling(spark, sf_dir):
    """The report at three dates from the daily skips, kept up to date over two loads."""
    wh = _loaded_star(spark, sf_dir, refreshes=[RF.refresh_skips])
    out = None
    for day in ROLLING:
        found = RF.rolling_report(spark, wh, day).withColumn("as_of", F.lit(day))
        out = found if out is None else out.unionByName(found)
    return out


def compact_fact(spark, sf_dir):
    """Five loads, compacted after the third and the last: the fact as it was."""
    ev = _events(spark, sf_dir)
    root = _run_dir(spark, "compact-fact")
    for batch in range(5):
        L.load_batch(ev.where(F.col("event_id") % 5 == batch), batch, root, arrival="event_id", tie=["event_id"], loaded_at=LOADED_AT)
        if batch in (2, 4):
            CO.compact_fact(spark, root)
    return L.read_star(spark, root)["fact_listens"].select(*facts.FACT_COLUMNS)


def compact_state(spark, sf_dir):
    """Log rewritten without overwritten and expired items; latest state unchanged for
    everything still live. Live items stand on both sides of the compaction."""
    even, odd = _parts(_events(spark, sf_dir))
    root = _ingest_runs(spark, [_day_records(even)], "compact")
    S.compact(spark, root, LIVE_AS_OF)
    _ingest_more(spark, root, _day_records(odd), 1)
    return ST.live_state(ST.latest_state(S.read_log(spark, root)), LIVE_AS_OF)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources and scans
    "scan_events": scan_events, "scan_catalog": scan_catalog, "load_catalog": load_catalog, "source_count": source_count, "incremental_scan": incremental_scan,
    "explode_envelopes": explode_envelopes, "read_jsonl": read_jsonl,
    "read_json_array": read_json_array, "json_rejects": json_rejects,
    # ingest
    "decode_payload": decode_payload, "parse_payload": parse_payload,
    "validate_required": validate_required, "parse_event_time": parse_event_time,
    "event_ttl": event_ttl, "apply_defaults": apply_defaults, "duration_decimal": duration_decimal,
    "split_rejects": split_rejects, "ingest_summary": ingest_summary, "state_items": state_items,
    # projections, filters, joins, aggregates, windows
    "project_events": project_events, "filter_action": filter_action,
    "filter_last_month": filter_last_month, "action_counts": action_counts,
    "lookup_user_key": lookup_user_key, "lookup_track_key": lookup_track_key,
    "listening_minutes": listening_minutes, "avg_listen_seconds": avg_listen_seconds,
    "distinct_counts": distinct_counts, "skip_rate": skip_rate, "distinct_dates": distinct_dates,
    "latest_track_record": latest_track_record, "user_first_seen": user_first_seen,
    "user_last_seen": user_last_seen, "user_primary_device": user_primary_device,
    # star, marts, report
    "dim_date": dim_date, "dim_tracks": dim_tracks, "dim_users": dim_users,
    "fact_listens": fact_listens, "mv_daily_user_summary": mv_daily_user_summary,
    "mv_track_performance": mv_track_performance, "most_skipped_tracks": most_skipped_tracks,
    # stream and state
    "stream_ingest": stream_ingest, "latest_state": latest_state, "live_state": live_state,
    "compact_state": compact_state, "late_events_kept": late_events_kept,
    # loads, sinks, maintenance
    "star_load": star_load, "load_summary": load_summary, "star_load_dims": star_load_dims,
    "star_load_empty": star_load_empty, "check_pk_load": check_pk_load, "dedupe_load": dedupe_load,
    "load_rejects": load_rejects, "publish_counts": publish_counts,
    "refresh_daily_by_date": refresh_daily_by_date,
    "refresh_track_performance": refresh_track_performance, "most_skipped_rolling": most_skipped_rolling, "append_table": append_table,
    "upsert_dimension": upsert_dimension, "conform_users": conform_users,
    "publish_keyed": publish_keyed, "write_jsonl": write_jsonl, "fact_layout": fact_layout, "compact_fact": compact_fact,
    # quality
    "check_pk": check_pk, "check_fk": check_fk, "check_columns": check_columns,
    "check_action_domain": check_action_domain,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
