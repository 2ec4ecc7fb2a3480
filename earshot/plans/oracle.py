"""DuckDB SQL twins of the registered queries (the correctness oracle).

Every statement starts from the same listening overlay as ``sources.overlay``
(over the views ``events`` and ``part``), written once here.
"""

from __future__ import annotations

KEY60 = "('0x' || substr(md5({x}), 1, 15))::BIGINT"


def key60(x: str) -> str:
    return KEY60.format(x=x)


OVERLAY = """
ev AS (
  SELECT e.event_id,
         'user_' || lpad(CAST(e.user_id AS VARCHAR), 5, '0') AS user_id,
         'sess_' || CAST(e.user_id AS VARCHAR) || '_' || strftime(e.ts, '%Y%m%d') AS session_id,
         't' || lpad(CAST(e.k AS VARCHAR), 3, '0') AS track_id,
         p.p_name AS track_title,
         p.p_brand AS artist,
         CASE e.event_type WHEN 'view' THEN 'PLAY' WHEN 'signup' THEN 'PLAY'
              WHEN 'click' THEN 'PAUSE' WHEN 'error' THEN 'SKIP'
              WHEN 'purchase' THEN 'COMPLETE' END AS action,
         (['MOBILE','DESKTOP','SMART_SPEAKER','SMART_TV','WEARABLE'])[e.event_id % 5 + 1] AS device_type,
         CASE WHEN e.event_type IN ('view', 'signup') THEN 0
              ELSE CAST(round(e.value * 1000) AS INTEGER) END AS listen_duration_ms,
         e.ts AS event_timestamp
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events) e
  LEFT JOIN part p ON p.p_partkey = e.k + 100 * (e.event_id % 2)
)"""

NULLS = "'\\N'"
LISTEN_KEY = key60(
    "concat_ws('|', " + ", ".join(
        [f"coalesce(replace(replace({c}, '\\', '\\\\'), '|', '\\|'), {NULLS})" for c in
         ("user_id", "session_id", "track_id", "track_title", "artist", "action", "device_type")]
        + [f"coalesce(CAST(listen_duration_ms AS VARCHAR), {NULLS})",
           f"coalesce(CAST(epoch_us(event_timestamp) AS VARCHAR), {NULLS})",
           "CAST(event_id AS VARCHAR)"]) + ")")
LISTEN_KEY_NO_ARRIVAL = LISTEN_KEY.replace(", CAST(event_id AS VARCHAR)", "")

def dims_sql(src: str, suffix: str = "", arrival: bool = True) -> str:
    """CTEs dim_date{suffix}, dim_tracks{suffix}, dim_users{suffix}, fact{suffix} over ``src``."""
    return STAR_TEMPLATE.replace("FROM ev", "FROM " + src).replace(
        "dim_date AS", f"dim_date{suffix} AS").replace(
        "dim_tracks AS", f"dim_tracks{suffix} AS").replace(
        "dim_users AS", f"dim_users{suffix} AS").replace(
        "fact AS", f"fact{suffix} AS").replace(
        "LISTEN_KEY_EXPR", LISTEN_KEY if arrival else LISTEN_KEY_NO_ARRIVAL)


STAR_TEMPLATE = """
dim_date AS (
  SELECT full_date,
         CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key,
         CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week,
         strftime(full_date, '%A') AS day_name,
         CAST(month(full_date) AS INTEGER) AS month,
         strftime(full_date, '%B') AS month_name,
         CAST(quarter(full_date) AS INTEGER) AS quarter,
         CAST(year(full_date) AS INTEGER) AS year,
         dayofweek(full_date) IN (0, 6) AS is_weekend
  FROM (SELECT DISTINCT CAST(event_timestamp AS DATE) AS full_date FROM ev
        WHERE event_timestamp IS NOT NULL) d
),
dim_tracks AS (
  SELECT """ + key60("track_id") + """ AS track_key, track_id, track_title AS title, artist
  FROM (SELECT *, row_number() OVER (PARTITION BY track_id
                                     ORDER BY event_timestamp DESC NULLS LAST, event_id DESC) AS rn
        FROM ev WHERE track_id IS NOT NULL) t
  WHERE rn = 1
),
dim_users AS (
  SELECT """ + key60("user_id") + """ AS user_key, user_id,
         'FREE' AS subscription_tier,
         min(event_timestamp) AS first_seen, max(event_timestamp) AS last_seen,
         arg_max(device_type, (event_timestamp, event_id)) AS primary_device
  FROM ev WHERE user_id IS NOT NULL GROUP BY user_id
),
fact AS (
  SELECT LISTEN_KEY_EXPR AS listen_key,
         """ + key60("user_id") + """ AS user_key,
         """ + key60("track_id") + """ AS track_key,
         CAST(strftime(event_timestamp, '%Y%m%d') AS INTEGER) AS date_key,
         session_id, action, listen_duration_ms AS duration_ms, device_type, event_timestamp
  FROM ev
)"""

STAR = OVERLAY + ",\n" + dims_sql("ev").strip()


def with_(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body.strip()


MOST_SKIPPED = with_(STAR, """
SELECT t.title, t.artist,
       count(*) AS skip_count,
       round(avg(f.duration_ms) / 1000.0, 1) AS avg_sec_before_skip,
       count(DISTINCT f.user_key) AS unique_skippers
FROM fact f
JOIN dim_tracks t ON f.track_key = t.track_key
JOIN dim_date d ON f.date_key = d.date_key
WHERE f.action = 'SKIP' AND d.full_date >= DATE '2024-02-10' - INTERVAL 1 MONTH
GROUP BY t.title, t.artist
ORDER BY skip_count DESC, t.title, t.artist
LIMIT 10""")

DAILY_USER_SUMMARY = with_(STAR, """
SELECT d.full_date, u.user_id, u.subscription_tier,
       count(*) AS total_events,
       CAST(sum(CASE WHEN f.action = 'PLAY' THEN 1 ELSE 0 END) AS BIGINT) AS plays,
       CAST(sum(CASE WHEN f.action = 'SKIP' THEN 1 ELSE 0 END) AS BIGINT) AS skips,
       CAST(sum(CASE WHEN f.action = 'COMPLETE' THEN 1 ELSE 0 END) AS BIGINT) AS completes,
       CAST(sum(f.duration_ms) AS DOUBLE) / 1000.0 / 60.0 AS total_minutes,
       count(DISTINCT f.track_key) AS unique_tracks,
       count(DISTINCT f.session_id) AS sessions
FROM fact f
JOIN dim_users u ON f.user_key = u.user_key
JOIN dim_date d ON f.date_key = d.date_key
GROUP BY d.full_date, u.user_id, u.subscription_tier""")

TRACK_PERFORMANCE = with_(STAR, """
SELECT t.track_id, t.title, t.artist,
       count(*) AS total_events,
       CAST(sum(CASE WHEN f.action = 'COMPLETE' THEN 1 ELSE 0 END) AS BIGINT) AS completions,
       CAST(sum(CASE WHEN f.action = 'SKIP' THEN 1 ELSE 0 END) AS BIGINT) AS skips,
       round(100.0 * sum(CASE WHEN f.action = 'SKIP' THEN 1 ELSE 0 END)::DOUBLE
             / NULLIF(count(*), 0), 2) AS skip_rate,
       avg(f.duration_ms) / 1000.0 AS avg_listen_seconds,
       count(DISTINCT f.user_key) AS unique_listeners
FROM fact f
JOIN dim_tracks t ON f.track_key = t.track_key
GROUP BY t.track_id, t.title, t.artist""")


def base_sql() -> dict[str, str]:
    return {
        "most_skipped_tracks": MOST_SKIPPED,
        "mv_daily_user_summary": DAILY_USER_SUMMARY,
        "mv_track_performance": TRACK_PERFORMANCE,
        "dim_date": with_(STAR, "SELECT * FROM dim_date"),
        "dim_tracks": with_(STAR, "SELECT * FROM dim_tracks"),
        "dim_users": with_(STAR, """SELECT user_key, user_id, first_seen, last_seen, primary_device
                                    FROM dim_users"""),
        "fact_listens": with_(STAR, "SELECT * FROM fact"),
    }


# ---- overlay variants ------------------------------------------------------------------
DAY_EVENTS = """
ev_day AS (
  SELECT * REPLACE (CAST(CAST(event_timestamp AS DATE) AS TIMESTAMP) AS event_timestamp) FROM ev
)"""
FLAWED_EVENTS = """
ev_flawed AS (
  SELECT * REPLACE (CASE WHEN event_id % 97 = 0 THEN NULL
                         WHEN event_id % 89 = 0 THEN 'REWIND' ELSE action END AS action) FROM ev
)"""
KNOWN_USERS = "ev_ku AS (SELECT * FROM ev WHERE NOT ends_with(user_id, '7'))"
KNOWN_TRACKS = "ev_kt AS (SELECT * FROM ev WHERE NOT ends_with(track_id, '7'))"
KNOWN_DAYS = "ev_kd AS (SELECT * FROM ev WHERE NOT ends_with(strftime(event_timestamp, '%Y%m%d'), '7'))"
HALVES = """
ev_h1 AS (SELECT * FROM ev WHERE event_timestamp < TIMESTAMP '2024-01-15 00:00:00'),
ev_h2 AS (SELECT * FROM ev WHERE event_timestamp >= TIMESTAMP '2024-01-15 00:00:00')"""


def _cte(*parts: str) -> str:
    return ",\n".join(p.strip() for p in parts)


def _contract_checks(contract, rel: str, present: set[str] | None = None) -> list[str]:
    """One SELECT per (column, check) of ``contract`` over ``rel``; a column the
    relation does not have is all NULL (0 violations)."""
    sel = []
    for c in contract.columns:
        has = present is None or c.name in present
        if not c.nullable:
            v = f"count_if({c.name} IS NULL)" if has else "count(*)"
            sel.append(f"SELECT '{contract.name}' AS table_name, '{c.name}' AS column_name, "
                       f"'not_null' AS check_name, {v} AS violations FROM {rel}")
        if c.max_len is not None:
            v = f"count_if(length({c.name}) > {c.max_len})" if has else "count_if(false)"
            sel.append(f"SELECT '{contract.name}', '{c.name}', 'max_len_{c.max_len}', {v} FROM {rel}")
    return sel


def _fact_contract_checks(rel: str) -> str:
    from ..schemas import FACT_LISTENS
    cols = {c.name for c in FACT_LISTENS.columns if c.name != "loaded_at"}
    return "\nUNION ALL\n".join(_contract_checks(FACT_LISTENS, rel, cols))


def _star_contract_checks(fact_rel: str, suffix: str) -> str:
    from ..schemas import DIM_DATE, DIM_TRACKS, DIM_USERS
    parts = _contract_checks(DIM_DATE, "dim_date" + suffix)
    parts += _contract_checks(DIM_TRACKS, "dim_tracks" + suffix,
                              {"track_key", "track_id", "title", "artist"})
    parts += _contract_checks(DIM_USERS, "dim_users" + suffix,
                              {"user_key", "user_id", "subscription_tier", "first_seen", "last_seen",
                               "primary_device"})
    return _fact_contract_checks(fact_rel) + "\nUNION ALL\n" + "\nUNION ALL\n".join(parts)


PK_SQL = """
SELECT '{t}' AS table_name, '{k}' AS key_column,
       CAST(coalesce(sum(n), 0) AS BIGINT) AS total_rows,
       CAST(coalesce(sum(CASE WHEN k IS NULL THEN n END), 0) AS BIGINT) AS null_keys,
       count_if(k IS NOT NULL AND n > 1) AS duplicate_keys,
       CAST(coalesce(sum(CASE WHEN k IS NOT NULL AND n > 1 THEN n - 1 END), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT {k} AS k, count(*) AS n FROM {rel} GROUP BY {k}) g"""

FK_SQL = """
SELECT '{fk}' AS fk_column, '{ref}' AS ref_table,
       CAST(coalesce(sum(CASE WHEN g.k IS NULL THEN g.n END), 0) AS BIGINT) AS null_rows,
       count_if(g.k IS NOT NULL AND d.k IS NULL) AS orphan_keys,
       CAST(coalesce(sum(CASE WHEN g.k IS NOT NULL AND d.k IS NULL THEN g.n END), 0) AS BIGINT) AS orphan_rows
FROM (SELECT {fk} AS k, count(*) AS n FROM {fact} GROUP BY {fk}) g
LEFT JOIN (SELECT DISTINCT {pk} AS k FROM {ref}{suffix} WHERE {pk} IS NOT NULL) d ON g.k = d.k"""


def more_sql() -> dict[str, str]:
    star = STAR
    q = {}
    q["scan_events"] = with_(OVERLAY, "SELECT * FROM ev")
    q["scan_catalog"] = with_(OVERLAY, """
        SELECT * FROM ev WHERE CAST(event_timestamp AS DATE) BETWEEN DATE '2024-01-12' AND DATE '2024-01-18'""")
    q["source_count"] = with_(OVERLAY, "SELECT count(*) AS rows FROM ev")
    q["project_events"] = with_(OVERLAY, """
        SELECT event_id, user_id, track_id, action, listen_duration_ms AS duration_ms,
               event_timestamp AS played_at FROM ev""")
    q["filter_action"] = with_(OVERLAY, """
        SELECT event_id, user_id, track_id, listen_duration_ms FROM ev WHERE action = 'SKIP'""")
    q["filter_last_month"] = with_(star, """
        SELECT f.listen_key, f.date_key, d.full_date FROM fact f JOIN dim_date d ON f.date_key = d.date_key
        WHERE d.full_date >= DATE '2024-02-10' - INTERVAL 1 MONTH""")
    q["action_counts"] = with_(star, """
        SELECT date_key, count(*) AS total_events,
               count_if(action = 'PLAY') AS plays, count_if(action = 'SKIP') AS skips,
               count_if(action = 'COMPLETE') AS completes
        FROM fact GROUP BY date_key""")
    q["listening_minutes"] = with_(star, """
        SELECT user_key, CAST(sum(duration_ms) AS DOUBLE) / 1000.0 / 60.0 AS total_minutes
        FROM fact GROUP BY user_key""")
    q["avg_listen_seconds"] = with_(star, """
        SELECT track_key, avg(duration_ms) / 1000.0 AS avg_listen_seconds FROM fact GROUP BY track_key""")
    q["distinct_counts"] = with_(star, """
        SELECT date_key, count(DISTINCT user_key) AS unique_users,
               count(DISTINCT track_key) AS unique_tracks, count(DISTINCT session_id) AS sessions
        FROM fact GROUP BY date_key""")
    q["skip_rate"] = with_(star, """
        SELECT track_key, count(*) AS total_events, count_if(action = 'SKIP') AS skips,
               round(100.0 * count_if(action = 'SKIP')::DOUBLE / NULLIF(count(*), 0), 2) AS skip_rate
        FROM fact GROUP BY track_key""")
    q["distinct_dates"] = with_(OVERLAY, """
        SELECT DISTINCT CAST(event_timestamp AS DATE) AS full_date FROM ev""")
    q["latest_track_record"] = with_(OVERLAY, """
        SELECT track_id, track_title, artist, event_timestamp, event_id FROM (
          SELECT *, row_number() OVER (PARTITION BY track_id
                    ORDER BY event_timestamp DESC NULLS LAST, event_id DESC) AS rn FROM ev) t
        WHERE rn = 1""")
    q["user_first_seen"] = with_(OVERLAY, """
        SELECT user_id, min(event_timestamp) AS first_seen FROM ev GROUP BY user_id""")
    q["user_last_seen"] = with_(OVERLAY, """
        SELECT user_id, max(event_timestamp) AS last_seen FROM ev GROUP BY user_id""")
    q["user_primary_device"] = with_(OVERLAY, """
        SELECT user_id, arg_max(device_type, (event_timestamp, event_id)) AS primary_device
        FROM ev GROUP BY user_id""")
    known = _cte(OVERLAY, KNOWN_USERS, KNOWN_TRACKS, KNOWN_DAYS, dims_sql("ev_ku", "_u"), dims_sql("ev_kt", "_t"),
                 dims_sql("ev_kd", "_d"), dims_sql("ev"))
    q["lookup_user_key"] = with_(known, """
        SELECT ev.event_id, ev.user_id, u.user_key FROM ev LEFT JOIN dim_users_u u ON ev.user_id = u.user_id""")
    q["lookup_track_key"] = with_(known, """
        SELECT ev.event_id, ev.track_id, t.track_key FROM ev LEFT JOIN dim_tracks_t t ON ev.track_id = t.track_id""")
    q["conform_users"] = with_(star, """
        SELECT user_key, user_id, subscription_tier, CAST(NULL AS DATE) AS signup_date,
               CAST(NULL AS VARCHAR) AS region, first_seen, last_seen, primary_device,
               TIMESTAMP '2024-02-01 00:00:00' AS created_at, TIMESTAMP '2024-02-01 00:00:00' AS updated_at
        FROM dim_users""")
    halves = _cte(OVERLAY, HALVES, dims_sql("ev_h1", "_1"), dims_sql("ev_h2", "_2"))
    q["upsert_dimension"] = with_(halves, """
        SELECT coalesce(s.user_key, t.user_key) AS user_key,
               coalesce(s.user_id, t.user_id) AS user_id,
               coalesce(t.subscription_tier, 'FREE') AS subscription_tier,
               CAST(NULL AS DATE) AS signup_date, CAST(NULL AS VARCHAR) AS region,
               CASE WHEN s.user_key IS NOT NULL AND t.user_key IS NOT NULL THEN least(t.first_seen, s.first_seen)
                    WHEN s.user_key IS NOT NULL THEN s.first_seen ELSE t.first_seen END AS first_seen,
               CASE WHEN s.user_key IS NOT NULL AND t.user_key IS NOT NULL THEN greatest(t.last_seen, s.last_seen)
                    WHEN s.user_key IS NOT NULL THEN s.last_seen ELSE t.last_seen END AS last_seen,
               CASE WHEN s.user_key IS NULL THEN t.primary_device
                    WHEN t.user_key IS NULL THEN s.primary_device
                    WHEN t.last_seen IS NULL OR (s.last_seen IS NOT NULL AND s.last_seen >= t.last_seen)
                         THEN s.primary_device ELSE t.primary_device END AS primary_device,
               CASE WHEN t.user_key IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00'
                    ELSE TIMESTAMP '2024-02-02 00:00:00' END AS created_at,
               CASE WHEN s.user_key IS NOT NULL THEN TIMESTAMP '2024-02-02 00:00:00'
                    ELSE TIMESTAMP '2024-02-01 00:00:00' END AS updated_at
        FROM dim_users_1 t FULL OUTER JOIN dim_users_2 s ON t.user_key = s.user_key""")
    day_halves = _cte(OVERLAY, DAY_EVENTS,
                      "ev_h1 AS (SELECT * FROM ev_day WHERE event_timestamp < TIMESTAMP '2024-01-15 00:00:00')",
                      "ev_h2 AS (SELECT * FROM ev_day WHERE event_timestamp >= TIMESTAMP '2024-01-15 00:00:00')",
                      dims_sql("ev_h1", "_1", arrival=False), dims_sql("ev_h2", "_2", arrival=False),
                      """app_date AS (SELECT * FROM dim_date_1 UNION ALL SELECT * FROM dim_date_2),
                         app_tracks AS (SELECT * FROM dim_tracks_1 UNION ALL SELECT * FROM dim_tracks_2),
                         app_users AS (SELECT * FROM dim_users_1 UNION ALL SELECT * FROM dim_users_2),
                         app_fact AS (SELECT * FROM fact_1 UNION ALL SELECT * FROM fact_2)""")
    q["check_pk"] = with_(day_halves, "\nUNION ALL\n".join(
        PK_SQL.format(t=t, k=k, rel=r) for t, k, r in
        [("dim_date", "date_key", "app_date"), ("dim_tracks", "track_key", "app_tracks"),
         ("dim_users", "user_key", "app_users"), ("fact_listens", "listen_key", "app_fact")]))
    q["check_fk"] = with_(known, "\nUNION ALL\n".join(
        FK_SQL.format(fk=f, ref=r, pk=p, fact="fact", suffix=x) for f, r, p, x in
        [("user_key", "dim_users", "user_key", "_u"), ("track_key", "dim_tracks", "track_key", "_t"),
         ("date_key", "dim_date", "date_key", "_d")]))
    flawed = _cte(OVERLAY, FLAWED_EVENTS, dims_sql("ev_flawed", "_f"))
    q["check_columns"] = with_(flawed, _star_contract_checks("fact_f", "_f"))
    q["check_action_domain"] = with_(flawed, """
        SELECT 'action' AS column_name, action AS value, count(*) AS rows FROM fact_f
        WHERE action IS NOT NULL AND action NOT IN ('PLAY', 'PAUSE', 'SKIP', 'COMPLETE')
        GROUP BY action""")
    return q


# ---- ingest: expected outcome of every test record --------------------------------------
ISO_Z = ("strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(event_timestamp) % 1000000 <> 0 "
         "THEN '.' || strftime(event_timestamp, '%f') ELSE '' END || 'Z'")
ISO_P2 = ("strftime(event_timestamp + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') || "
          "CASE WHEN epoch_us(event_timestamp) % 1000000 <> 0 "
          "THEN '.' || strftime(event_timestamp + INTERVAL 2 HOUR, '%f') ELSE '' END || '+02:00'")
RECORDS = """
rec AS (
  SELECT event_id, c,
         c <> 2 AS decoded,
         c NOT IN (1, 2, 3, 9, 14, 18) AS parsed,
         CASE WHEN c = 8 THEN NULL ELSE user_id END AS j_user_id,
         CASE WHEN c = 4 THEN 'session_id' END AS missing_field,
         CASE WHEN c = 5 THEN NULL WHEN c = 17 THEN CAST(CAST(event_timestamp AS DATE) AS TIMESTAMP)
              ELSE event_timestamp END AS event_time,
         CASE WHEN c = 15 THEN """ + ISO_P2 + """
              WHEN c = 17 THEN strftime(event_timestamp, '%Y-%m-%d')
              WHEN c = 5 THEN 'junk'
              ELSE """ + ISO_Z + """ END AS ts_text,
         CASE WHEN c = 4 THEN NULL ELSE session_id END AS j_session_id,
         track_id, track_title,
         CASE WHEN c = 7 THEN 'Unknown' WHEN c = 11 THEN NULL ELSE artist END AS j_artist,
         action,
         CASE WHEN c = 7 THEN 'UNKNOWN' ELSE device_type END AS j_device_type,
         CASE WHEN c = 12 THEN CAST(0 AS DECIMAL(38, 9)) WHEN c = 6 THEN NULL
              ELSE CAST(listen_duration_ms AS DECIMAL(38, 9)) END AS j_duration,
         CASE c WHEN 1 THEN 'bad_json' WHEN 2 THEN 'bad_base64' WHEN 3 THEN 'bad_json'
                WHEN 4 THEN 'missing:session_id' WHEN 5 THEN 'bad_timestamp'
                WHEN 6 THEN 'bad_duration' WHEN 8 THEN 'null_key' WHEN 9 THEN 'bad_json'
                WHEN 14 THEN 'bad_utf8' WHEN 18 THEN 'not_object' END AS error
  FROM (SELECT *, event_id % 47 AS c FROM ev) x
),
rec_t AS (
  SELECT *, CAST(epoch_us(event_time) // 1000000 AS BIGINT) + 86400 AS ttl FROM rec
)"""

STATE_SELECT = """
SELECT j_user_id AS user_id, ts_text AS timestamp, j_session_id AS session_id, track_id, track_title,
       j_artist AS artist, action, j_device_type AS device_type, j_duration AS listen_duration_ms, ttl"""


def ingest_sql() -> dict[str, str]:
    base = _cte(OVERLAY, RECORDS)
    q = {
        "decode_payload": "SELECT event_id, decoded FROM rec_t",
        "parse_payload": "SELECT event_id, parsed, CASE WHEN parsed THEN j_user_id END AS user_id FROM rec_t",
        "validate_required": "SELECT event_id, missing_field FROM rec_t WHERE parsed",
        "parse_event_time": "SELECT event_id, epoch_us(event_time) AS event_time_us FROM rec_t WHERE parsed",
        "event_ttl": "SELECT event_id, ttl FROM rec_t WHERE parsed AND event_time IS NOT NULL",
        "apply_defaults": """SELECT event_id, track_title, j_artist AS artist, j_device_type AS device_type
                             FROM rec_t WHERE parsed""",
        "duration_decimal": "SELECT event_id, j_duration AS listen_duration_ms FROM rec_t WHERE parsed",
        "split_rejects": "SELECT event_id, error FROM rec_t WHERE error IS NOT NULL",
        "ingest_summary": """SELECT count_if(error IS NULL) AS records_processed,
                                    count_if(error IS NOT NULL) AS records_failed FROM rec_t""",
        "state_items": STATE_SELECT + " FROM rec_t WHERE error IS NULL",
    }
    return {k: with_(base, v) for k, v in q.items()}


def io_sql() -> dict[str, str]:
    q = {}
    q["explode_envelopes"] = with_(OVERLAY, """
        SELECT event_id, CAST(row_number() OVER (PARTITION BY event_id // 100 ORDER BY event_id) - 1
                              AS INTEGER) AS pos, true AS has_data FROM ev
        UNION ALL
        SELECT CAST(NULL AS BIGINT), CAST(count(*) AS INTEGER), false FROM ev
        GROUP BY event_id // 100 HAVING (event_id // 100) % 7 = 3""")
    q["read_jsonl"] = with_(OVERLAY, "SELECT " + ", ".join(
        ["user_id", "session_id", "track_id", "track_title", "artist", "action", "device_type",
         "CAST(listen_duration_ms AS BIGINT) AS listen_duration_ms", "event_timestamp"]) + " FROM ev")
    q["read_json_array"] = q["read_jsonl"]
    q["json_rejects"] = with_(OVERLAY, """
        SELECT count_if(event_id % 59 <> 0) AS events,
               CAST(CAST(sum(CASE WHEN event_id % 59 = 0 THEN 0 ELSE CAST(listen_duration_ms AS DECIMAL(20, 1)) + CASE
                        WHEN event_id % 61 = 0 THEN 0.5 ELSE 0 END END) AS DECIMAL(20, 1)) AS VARCHAR) AS total,
               count_if(event_id % 59 = 0) AS rejects, CAST(20 AS BIGINT) AS least FROM ev""")
    q["write_jsonl"] = with_(OVERLAY, "SELECT user_id, track_id, " + ISO_Z + " AS event_timestamp FROM ev")
    q["publish_keyed"] = with_(OVERLAY, "SELECT user_id AS key, user_id, track_id, action, "
                                        "CAST(listen_duration_ms AS BIGINT) AS listen_duration_ms, "
                                        + ISO_Z + " AS event_timestamp FROM ev")
    q["incremental_scan"] = with_(OVERLAY, "SELECT * FROM ev")
    q["stream_ingest"] = with_(_cte(OVERLAY, RECORDS), STATE_SELECT + """
        FROM (SELECT *, row_number() OVER (PARTITION BY j_user_id, ts_text ORDER BY event_id DESC) AS rn
              FROM rec_t WHERE error IS NULL) s WHERE rn = 1""")
    day_state = with_(OVERLAY, """
        SELECT user_id, timestamp, session_id, track_id, track_title, artist, action, device_type,
               CAST(listen_duration_ms AS DECIMAL(38, 9)) AS listen_duration_ms, ttl
        FROM (SELECT *, strftime(event_timestamp, '%Y-%m-%d') AS timestamp,
                     CAST(epoch(CAST(CAST(event_timestamp AS DATE) AS TIMESTAMP)) AS BIGINT) + 86400 AS ttl,
                     row_number() OVER (PARTITION BY user_id, CAST(event_timestamp AS DATE)
                                        ORDER BY event_id % 2 DESC, event_id DESC) AS rn
              FROM ev) s WHERE rn = 1""")
    q["latest_state"] = day_state
    q["live_state"] = "SELECT * FROM (" + day_state + ") l WHERE ttl > " + \
        "CAST(epoch(TIMESTAMP '2024-01-20 00:00:00') AS BIGINT)"
    q["late_events_kept"] = with_(OVERLAY, "SELECT user_id, " + ISO_Z + " AS timestamp, "
                                  "CAST(epoch_us(event_timestamp) // 1000000 AS BIGINT) + 86400 AS ttl, "
                                  "CAST(1 AS BIGINT) AS batch_id FROM ev "
                                  "WHERE event_timestamp < TIMESTAMP '2024-01-15 00:00:00'")
    q["append_table"] = with_(STAR, "SELECT * FROM fact")
    q["fact_layout"] = q["append_table"]
    q["star_load"] = q["append_table"]
    q["compact_fact"] = q["append_table"]
    q["load_catalog"] = q["append_table"]
    q["most_skipped_rolling"] = with_(STAR, " UNION ALL ".join(f"""
        SELECT * FROM (
          SELECT DATE '{day}' AS as_of, t.title, t.artist, count(*) AS skip_count,
                 round(avg(f.duration_ms) / 1000.0, 1) AS avg_sec_before_skip, count(DISTINCT f.user_key) AS unique_skippers
          FROM fact f JOIN dim_tracks t ON f.track_key = t.track_key JOIN dim_date d ON f.date_key = d.date_key
          WHERE f.action = 'SKIP' AND d.full_date >= DATE '{day}' - INTERVAL 1 MONTH
          GROUP BY t.title, t.artist ORDER BY skip_count DESC, t.title, t.artist LIMIT 10) r"""
        for day in ("2024-01-31", "2024-02-10", "2024-02-20")))
    q["load_summary"] = with_(STAR, """
        SELECT 'dim_date' AS table_name, count(*) AS rows FROM dim_date
        UNION ALL SELECT 'dim_tracks', count(*) FROM dim_tracks
        UNION ALL SELECT 'dim_users', count(*) FROM dim_users
        UNION ALL SELECT 'fact_listens', count(*) FROM fact""")
    time = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"
    q["star_load_dims"] = with_(STAR, f"""
        SELECT 'dim_date' AS table_name, CAST(date_key AS BIGINT) AS key, CAST(full_date AS VARCHAR) AS v0, day_name AS v1,
               month_name AS v2, CAST(quarter AS VARCHAR) AS v3 FROM dim_date
        UNION ALL SELECT 'dim_tracks', track_key, track_id, title, artist, NULL FROM dim_tracks
        UNION ALL SELECT 'dim_users', user_key, user_id, {time.format("first_seen")}, {time.format("last_seen")},
               primary_device FROM dim_users""")
    q["star_load_empty"] = with_(STAR, """
        SELECT CAST(0 AS BIGINT) AS batch_id, 'dim_date' AS table_name, count(*) AS rows FROM dim_date
        UNION ALL SELECT 0, 'dim_tracks', count(*) FROM dim_tracks
        UNION ALL SELECT 0, 'dim_users', count(*) FROM dim_users
        UNION ALL SELECT 0, 'fact_listens', count(*) FROM fact
        UNION ALL SELECT 0, 'load_rejects', 0""")
    q["check_pk_load"] = with_(OVERLAY, """
        SELECT 'fact_listens' AS table_name, 'listen_key' AS key_column, 2 * count(*) AS total_rows,
               CAST(0 AS BIGINT) AS null_keys, CAST(0 AS BIGINT) AS duplicate_keys, CAST(0 AS BIGINT) AS duplicate_rows
        FROM ev""")
    q["dedupe_load"] = with_(OVERLAY, f"""
        SELECT {key60("user_id")} AS user_key, {key60("track_id")} AS track_key,
               CAST(strftime(event_timestamp, '%Y%m%d') AS INTEGER) AS date_key, session_id, action,
               listen_duration_ms AS duration_ms, device_type, event_timestamp
        FROM (SELECT DISTINCT
          CASE WHEN event_id % 43 IN (1, 2) THEN 'user_pair' ELSE user_id END AS user_id,
          CASE WHEN event_id % 43 IN (1, 2) THEN 'sess_pair' ELSE session_id END AS session_id,
          CASE WHEN event_id % 43 IN (1, 2) THEN 'tpair' ELSE track_id END AS track_id,
          CASE event_id % 43 WHEN 1 THEN CAST(event_id - 1 AS VARCHAR) || 'A|B' WHEN 2 THEN CAST(event_id - 2 AS VARCHAR) || 'A'
               ELSE track_title END AS track_title,
          CASE event_id % 43 WHEN 1 THEN 'C' WHEN 2 THEN 'B|C' ELSE artist END AS artist,
          CASE WHEN event_id % 43 IN (1, 2) THEN 'PLAY' ELSE action END AS action,
          CASE WHEN event_id % 43 IN (1, 2) THEN 'MOBILE' ELSE device_type END AS device_type,
          CASE WHEN event_id % 43 IN (1, 2) THEN 1000 ELSE listen_duration_ms END AS listen_duration_ms,
          CASE WHEN event_id % 41 = 0 OR event_id % 43 IN (1, 2) THEN NULL ELSE event_timestamp END AS event_timestamp
          FROM ev) d""")
    q["load_rejects"] = with_(OVERLAY, """
        SELECT user_id, session_id, '3000000000' AS listen_duration_ms, 'bad_listen_duration_ms' AS reason,
               CAST(event_id % 2 AS BIGINT) AS batch_id FROM ev WHERE event_id % 101 = 0
        UNION ALL SELECT NULL, NULL, CAST(count(*) AS VARCHAR), 'loaded', -1 FROM ev WHERE event_id % 101 <> 0""")
    q["publish_counts"] = with_(OVERLAY, """
        SELECT count_if(event_id % 53 <> 0) AS sent, count_if(event_id % 53 = 0) AS failed,
               count_if(event_id % 53 <> 0) AS stored FROM ev""")
    q["refresh_daily_by_date"] = DAILY_USER_SUMMARY
    q["refresh_track_performance"] = TRACK_PERFORMANCE
    q["compact_state"] = q["live_state"]
    return q


def sql() -> dict[str, str]:
    out = base_sql()
    for part in (more_sql(), ingest_sql(), io_sql()):
        out.update(part)
    return out
