"""spark-submit entry point.

    spark-submit --py-files squall.zip squall/__main__.py silver alerts-live  --bronze 'landing/alerts_feed_*.json' --silver lake/silver/alerts
    spark-submit --py-files squall.zip squall/__main__.py gold --alerts lake/silver/alerts --weather lake/silver/weather --gold lake/gold --batch-id 42
    spark-submit --py-files squall.zip squall/__main__.py run --alert-bronze 'landing/alerts_feed_*.json' --weather-bronze 'landing/forecast_*.json' --silver lake/silver --gold lake/gold --batch-id 43
    spark-submit --py-files squall.zip squall/__main__.py stream --alert-bronze 'landing/alerts/*' --silver lake/silver --gold lake/gold --checkpoint lake/_checkpoints
    spark-submit --py-files squall.zip squall/__main__.py import-csv alerts --csv 'old/alerts_*.csv' --silver lake/silver/alerts --source live

(``python -m squall ...`` locally; ``squall.zip`` is the zipped package). Prints the run metrics as JSON.
"""

from __future__ import annotations

import argparse
import json

from squall import constants as K
from squall import schemas
from squall.plans import flows, silver
from squall.session import build_session
from squall.sources import commits
from squall.streaming import incremental

SILVER = {
    "alerts-live": flows.alerts_live,
    "alerts-historical": flows.alerts_historical,
    "weather-live": flows.weather_live,
    "weather-historical": flows.weather_historical,
}
CONTRACTS = {"alerts": schemas.ALERT, "weather": schemas.WEATHER}


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="squall")
    sub = ap.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("silver", help="newest bronze file of one feed -> silver snapshot")
    s.add_argument("feed", choices=sorted(SILVER))
    s.add_argument("--bronze", required=True, nargs="+")
    s.add_argument("--silver", required=True)
    s.add_argument("--source-tz", help="zone of offset-less dates (alerts-historical); default UTC")
    g = sub.add_parser("gold", help="silver snapshots -> fact, summary, view, export")
    g.add_argument("--alerts", required=True)
    g.add_argument("--weather", required=True)
    r = sub.add_parser("run", help="one poll: both live silver flows, then gold")
    r.add_argument("--weather-bronze", required=True, nargs="+")
    t = sub.add_parser("stream", help="alert files -> silver -> fact, incrementally")
    t.add_argument("--checkpoint", required=True)
    t.add_argument("--every", help="a processing-time interval such as '5 minutes'; default: what is there, once")
    for p in (r, t):
        p.add_argument("--alert-bronze", required=True, nargs="+" if p is r else None)
        p.add_argument("--silver", required=True)
    for p in (g, r, t):
        p.add_argument("--gold", required=True)
    for p in (g, r):
        p.add_argument("--batch-id", type=int, required=True)
        p.add_argument("--no-export", action="store_true")
    k = sub.add_parser("compact", help="rewrite the fact's batches as large files, remove what they replace")
    k.add_argument("--gold", required=True)
    k.add_argument("--everything", action="store_true")
    k.add_argument("--keep-seconds", type=float, default=7 * 86400)
    c = sub.add_parser("import-csv", help="CSV snapshots -> silver layout")
    c.add_argument("contract", choices=sorted(CONTRACTS))
    c.add_argument("--csv", required=True, nargs="+")
    c.add_argument("--silver", required=True)
    c.add_argument("--source", choices=[K.SOURCE_LIVE, K.SOURCE_HISTORICAL], default=K.SOURCE_LIVE)
    return ap


def _stream(spark, args) -> dict:
    """Two streams: alert files into silver, and silver's live snapshots into
    the fact. With ``--every`` both run until they are stopped."""
    alerts_root, totals = f"{args.silver}/alerts", {"new_rows": 0, "pending": 0, "expired": 0}

    def add(counts: dict) -> None:
        totals.update(pending=counts["pending"], new_rows=totals["new_rows"] + counts["new_rows"],
                      expired=totals["expired"] + counts["expired"])

    feed = incremental.read_json_stream(spark, args.alert_bronze, schemas.LIVE_ALERT_FEED, multiline=True)
    first = incremental.ingest_snapshots(feed, silver.live_alert_rows, alerts_root, f"{args.checkpoint}/silver",
                                         dedup_key=K.ALERT_DEDUP_KEY, trigger=args.every)
    if not args.every:
        incremental.run_to_end(first)
    live = incremental.read_parquet_stream(spark, f"{alerts_root}/source={K.SOURCE_LIVE}/*", schemas.ALERT)
    second = incremental.enrich_and_append(live, incremental.silver_weather(spark, f"{args.silver}/weather"),
                                           f"{args.gold}/fact", f"{args.checkpoint}/gold", trigger=args.every, on_batch=add)
    if args.every:
        spark.streams.awaitAnyTermination()
    else:
        incremental.run_to_end(second)
    return totals


def main(argv=None) -> dict:
    args = _parser().parse_args(argv)
    spark = build_session(app_name=f"squall-{args.cmd}")
    if args.cmd == "silver":
        more = {"source_tz": args.source_tz} if args.source_tz and args.feed == "alerts-historical" else {}
        out = SILVER[args.feed](spark, args.bronze, args.silver, **more)
    elif args.cmd == "gold":
        out = flows.gold_run(spark, args.alerts, args.weather, args.gold, args.batch_id, export=not args.no_export)
    elif args.cmd == "run":
        out = flows.run_all(spark, args.alert_bronze, args.weather_bronze, args.silver, args.gold, args.batch_id,
                            export=not args.no_export)
    elif args.cmd == "stream":
        out = _stream(spark, args)
    elif args.cmd == "compact":
        out = {"compacted": commits.compact(spark, f"{args.gold}/fact", everything=args.everything),
               "removed": commits.vacuum(spark, f"{args.gold}/fact", args.keep_seconds)}
    else:
        out = flows.import_csv_snapshots(spark, args.csv, CONTRACTS[args.contract], args.silver, args.source)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main()
