"""Event format, stream envelope and the four table contracts of the star."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---- fixed values: the event format -------------------------------------------------
# Nine fields of a listening event, in their documented order.
EVENT_FIELDS = ["user_id", "session_id", "track_id", "track_title", "artist", "action",
                "device_type", "listen_duration_ms", "event_timestamp"]
# Fields that must be present (an explicit JSON null counts as present).
REQUIRED_FIELDS = ["user_id", "session_id", "track_id", "action", "event_timestamp"]
# Defaults for optional fields that are absent.
OPTIONAL_DEFAULTS = {"track_title": "Unknown", "artist": "Unknown",
                     "device_type": "UNKNOWN", "listen_duration_ms": 0}
# Allowed actions (documented domain).
ACTIONS = ["PLAY", "PAUSE", "SKIP", "COMPLETE"]
# Device types the producer emits.
DEVICE_TYPES = ["MOBILE", "DESKTOP", "SMART_SPEAKER", "SMART_TV", "WEARABLE"]
# State retention after the event time.
TTL_HOURS = 24
# Records per published batch.
PUBLISH_BATCH_SIZE = 100
# ---------------------------------------------------------------------------------------

EVENT_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("track_id", T.StringType()),
    T.StructField("track_title", T.StringType()),
    T.StructField("artist", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("listen_duration_ms", T.LongType()),
    T.StructField("event_timestamp", T.TimestampType()),
])

# A stream record batch: {"Records": [{"kinesis": {"data": <base64>, "sequenceNumber": ..}}]}
# (fixed values: the field names Records, kinesis, data, sequenceNumber, partitionKey belong to
# the record format the stream delivers)
RECORD_SCHEMA = T.StructType([
    T.StructField("kinesis", T.StructType([
        T.StructField("data", T.StringType()),
        T.StructField("sequenceNumber", T.StringType()),
        T.StructField("partitionKey", T.StringType()),
    ])),
])
ENVELOPE_SCHEMA = T.StructType([T.StructField("Records", T.ArrayType(RECORD_SCHEMA))])

# Keyed state item (key: user_id, timestamp).
STATE_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("track_id", T.StringType()),
    T.StructField("track_title", T.StringType()),
    T.StructField("artist", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("listen_duration_ms", T.DecimalType(38, 9)),
    T.StructField("ttl", T.LongType()),
])
STATE_KEY = ["user_id", "timestamp"]


@dataclass(frozen=True)
class Column:
    name: str
    dtype: T.DataType
    nullable: bool = True
    max_len: int | None = None
    default: object = None          # literal default; "now" = load time


@dataclass(frozen=True)
class TableContract:
    name: str
    columns: list[Column]
    key: str
    foreign: dict[str, str] = field(default_factory=dict)   # column -> dimension table

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)


NOW = "now"

# ---- fixed values: star table contracts (types, NOT NULL, lengths, defaults, keys) ----
DIM_DATE = TableContract("dim_date", [
    Column("date_key", T.IntegerType(), False),
    Column("full_date", T.DateType(), False),
    Column("day_of_week", T.ShortType(), False),
    Column("day_name", T.StringType(), False, 10),
    Column("month", T.ShortType(), False),
    Column("month_name", T.StringType(), False, 10),
    Column("quarter", T.ShortType(), False),
    Column("year", T.ShortType(), False),
    Column("is_weekend", T.BooleanType(), False),
], key="date_key")

DIM_TRACKS = TableContract("dim_tracks", [
    Column("track_key", T.LongType(), False),
    Column("track_id", T.StringType(), False, 50),
    Column("title", T.StringType(), False, 255),
    Column("artist", T.StringType(), False, 255),
    Column("album", T.StringType(), True, 255),
    Column("genre", T.StringType(), True, 100),
    Column("duration_ms", T.IntegerType(), True),
    Column("release_date", T.DateType(), True),
    Column("created_at", T.TimestampNTZType(), True, default=NOW),
    Column("updated_at", T.TimestampNTZType(), True, default=NOW),
], key="track_key")

DIM_USERS = TableContract("dim_users", [
    Column("user_key", T.LongType(), False),
    Column("user_id", T.StringType(), False, 50),
    Column("subscription_tier", T.StringType(), True, 20, default="FREE"),
    Column("signup_date", T.DateType(), True),
    Column("region", T.StringType(), True, 50),
    Column("first_seen", T.TimestampNTZType(), True),
    Column("last_seen", T.TimestampNTZType(), True),
    Column("primary_device", T.StringType(), True, 50),
    Column("created_at", T.TimestampNTZType(), True, default=NOW),
    Column("updated_at", T.TimestampNTZType(), True, default=NOW),
], key="user_key")

FACT_LISTENS = TableContract("fact_listens", [
    Column("listen_key", T.LongType(), False),
    Column("user_key", T.LongType(), False),
    Column("track_key", T.LongType(), False),
    Column("date_key", T.IntegerType(), False),
    Column("session_id", T.StringType(), False, 50),
    Column("action", T.StringType(), False, 20),
    Column("duration_ms", T.IntegerType(), False),
    Column("device_type", T.StringType(), False, 30),
    Column("event_timestamp", T.TimestampNTZType(), False),
    Column("loaded_at", T.TimestampNTZType(), True, default=NOW),
], key="listen_key", foreign={"user_key": "dim_users", "track_key": "dim_tracks",
                              "date_key": "dim_date"})
# ---------------------------------------------------------------------------------------

CONTRACTS = {c.name: c for c in (DIM_DATE, DIM_TRACKS, DIM_USERS, FACT_LISTENS)}
