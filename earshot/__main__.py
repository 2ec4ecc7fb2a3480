"""Command line for the jobs: ``python -m earshot <command> ...``.

  load     new event files -> star schema (incremental; once, or on a schedule)
  ingest   envelope files -> keyed state log (incremental; once, or on a schedule)
  marts    bring both marts up to the stored star (what newer batches change)
  compact-fact  merge the small files of past loads
  report   most-skipped tracks of the month before a date, from the stored star
  compact  rewrite the state log as its live latest items

Paths may be any Hadoop-compatible location. On a cluster, leave ``--master`` out.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import types as T

from .operators import reports
from .plans import compaction as CO
from .plans import load as L
from .plans import refresh as RF
from .schemas import EVENT_SCHEMA
from .session import build_session
from .streaming import ingest_stream as S


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="earshot")
    p.add_argument("--master", default=None)
    p.add_argument("--shuffle-partitions", type=int, default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    ld = sub.add_parser("load")
    ld.add_argument("--source", required=True)
    ld.add_argument("--warehouse", required=True)
    ld.add_argument("--checkpoint", required=True)
    ld.add_argument("--every", default=None, help='e.g. "1 hour"; default: one run')
    ld.add_argument("--arrival", default=L.FILE_ROW,
                    help="column that identifies an event's arrival; default: file and row index")
    ld.add_argument("--max-bytes", type=int, default=64 << 30, help="input of a micro-batch at most")
    ld.add_argument("--cluster-partitions", type=int, default=None, help="cluster the fact by day (backfills)")
    ld.add_argument("--dedupe", action="store_true")
    ld.add_argument("--refresh-marts", action="store_true", help="bring both marts up to each batch")

    ing = sub.add_parser("ingest")
    ing.add_argument("--source", required=True)
    ing.add_argument("--root", required=True)
    ing.add_argument("--checkpoint", required=True)
    ing.add_argument("--every", default=None)
    ing.add_argument("--max-bytes", type=int, default=64 << 30, help="input of a micro-batch at most")

    mt = sub.add_parser("marts")
    mt.add_argument("--warehouse", required=True)

    cf = sub.add_parser("compact-fact")
    cf.add_argument("--warehouse", required=True)
    cf.add_argument("--target-bytes", type=int, default=CO.TARGET, help="size of a file")

    rp = sub.add_parser("report")
    rp.add_argument("--warehouse", required=True)
    rp.add_argument("--as-of", default=None, help="YYYY-MM-DD; default today")
    rp.add_argument("--top", type=int, default=10)

    cp = sub.add_parser("compact")
    cp.add_argument("--root", required=True)
    cp.add_argument("--as-of", default=None, help="YYYY-MM-DDTHH:MM:SS (UTC); default now")
    return p


def _event_schema(arrival: str | None) -> T.StructType:
    if not arrival or arrival == L.FILE_ROW:
        return EVENT_SCHEMA
    return T.StructType(EVENT_SCHEMA.fields + [T.StructField(arrival, T.StringType())])


def main(argv: list[str] | None = None) -> dict:
    a = _parser().parse_args(argv)
    spark = build_session(a.master, app=f"earshot-{a.cmd}", shuffle_partitions=a.shuffle_partitions)
    out: dict = {"command": a.cmd}
    if a.cmd == "load":
        q = L.start_star_load(spark, a.source, _event_schema(a.arrival), a.warehouse, a.checkpoint,
                              arrival=a.arrival, refreshes=[RF.refresh_daily, RF.refresh_tracks] if a.refresh_marts else [], dedupe=a.dedupe,
                              every=a.every, max_bytes=a.max_bytes, cluster_partitions=a.cluster_partitions)
        q.awaitTermination()
        out["tables"] = {r.table_name: r.rows for r in L.load_summary(spark, a.warehouse).collect()}
    elif a.cmd == "ingest":
        q = S.start_ingest(spark, a.source, a.root, a.checkpoint, processing_time=a.every, max_bytes_per_trigger=a.max_bytes)
        q.awaitTermination()
    elif a.cmd == "marts":
        # what the batches since the last refresh change; readers keep the versions before until it commits
        out["mv_daily_user_summary"] = RF.refresh_daily(spark, a.warehouse)
        out["mv_track_performance"] = RF.refresh_tracks(spark, a.warehouse)
    elif a.cmd == "compact-fact":
        out["merged"] = CO.compact_fact(spark, a.warehouse, a.target_bytes)
    elif a.cmd == "report":
        star = L.read_star(spark, a.warehouse)
        rows = reports.most_skipped_tracks(star["fact_listens"], star["dim_tracks"], star["dim_date"],
                                           as_of=a.as_of, top=a.top).collect()   # top-k rows only
        out["rows"] = [r.asDict() for r in rows]
    elif a.cmd == "compact":
        as_of = dt.datetime.fromisoformat(a.as_of) if a.as_of else dt.datetime.now(dt.timezone.utc)
        out["kept"] = S.compact(spark, a.root, as_of)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main()
