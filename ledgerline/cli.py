"""Run a refresh job: ``spark-submit --py-files ledgerline.zip ledgerline/cli.py <job> --sources map.json --out <base>``.

``map.json`` maps logical source names to catalog tables or ``format:path``
(see ``sources.tables.TableSources``). ``--as-of`` defaults to today (UTC);
the turnaround window is the three months before it.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from ledgerline.functions.caltime import calendar_from_intervals
from ledgerline.operators.keys import BUCKET_SECONDS
from ledgerline.params import BusinessHours, RunParams
from ledgerline.plans import refresh
from ledgerline.plans.snapshot import CONTRACT_PASS_THROUGH, FUNDING_PASS_THROUGH, SnapshotSources
from ledgerline.sources.tables import TableSources

SNAPSHOT_SOURCES = {
    "ca": "ca", "ca_status": "ca_status", "date_dim": "date_dim", "dealer": "dealer", "ams": "ams",
    "mk_program": "mk_program", "funding": "funding_data", "trans_return": "trans_return",
    "delinq_summary": "delinq_summary", "delinq_detail": "delinq_detail", "status_log": "s_c_log",
    "decisions": "ino_decisions", "app": "app", "history_t": "wf_history_t", "ino_c": "ino_c",
    "l_def": "l_def", "major_dgg": "major_dgg", "bureau": "bureau", "res_adj": "res_adj",
    "exposure": "exposure", "dis_report": "dis_report",
}

PASSED_ON = {"ca": CONTRACT_PASS_THROUGH, "funding_data": FUNDING_PASS_THROUGH}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="ledgerline")
    ap.add_argument("job", choices=["turnaround", "snapshot"])
    ap.add_argument("--sources", required=True, help="JSON file: logical name -> table or format:path")
    ap.add_argument("--out", required=True, help="base folder of the published tables")
    ap.add_argument("--as-of", default=None, help="run date (YYYY-MM-DD); default today UTC")
    ap.add_argument("--months", type=int, default=3)
    ap.add_argument("--open", default="09:00")
    ap.add_argument("--close", default="17:00")
    ap.add_argument("--calendar-from", default="2000-01-01")
    ap.add_argument("--calendar-to", default="2040-12-31")
    ap.add_argument("--holidays", default="", help="comma-separated YYYY-MM-DD dates")
    ap.add_argument("--yearly-holidays", default="", help="comma-separated MM-DD closed every year")
    ap.add_argument("--opening-intervals", default=None, metavar="SOURCE=STARTS,ENDS",
                    help="turnaround: a source of opening intervals, in place of the hours, weekdays and holidays above")
    ap.add_argument("--bucket-seconds", type=int, default=BUCKET_SECONDS, help="time bucket of the pairing shuffle")
    ap.add_argument("--blank-date", default=None, help="date of an absent approval or funding (YYYY-MM-DD); default NULL")
    ap.add_argument("--scope-logs", action="store_true", help="snapshot: drop log rows of contracts out of scope at the scan")
    ap.add_argument("--unread", action="append", default=[], metavar="SOURCE=KEY",
                    help="a left-joined source of which no column is used, with its key (checked to be unique)")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"ledgerline-{args.job}").getOrCreate()
    with open(args.sources) as fh:
        src = TableSources(spark, json.load(fh), job=args.job, also=PASSED_ON if args.job == "snapshot" else None)
    as_of = dt.date.fromisoformat(args.as_of) if args.as_of else dt.datetime.now(dt.timezone.utc).date()
    params = RunParams.trailing_months(as_of, args.months)
    secs = lambda hhmm: int(hhmm[:2]) * 3600 + int(hhmm[3:5]) * 60
    hours = BusinessHours(
        first_day=dt.date.fromisoformat(args.calendar_from),
        last_day=dt.date.fromisoformat(args.calendar_to),
        open_seconds=secs(args.open),
        close_seconds=secs(args.close),
        holidays=tuple(dt.date.fromisoformat(d) for d in args.holidays.split(",") if d),
        yearly_holidays=tuple((int(d[:2]), int(d[3:5])) for d in args.yearly_holidays.split(",") if d),
    )
    unread = {name: (src[name], key) for name, _, key in (u.partition("=") for u in args.unread)}
    if args.job == "turnaround":
        calendar = None
        if args.opening_intervals:
            name, _, columns = args.opening_intervals.partition("=")
            calendar = calendar_from_intervals(src[name], *columns.split(","), hours)
        names = ("ca", "date_dim", "dealer", "app", "wf_history", "ca_status")
        out = refresh.refresh_turnaround(
            spark, {n: src[n] for n in names}, params, hours, args.out,
            bucket_seconds=args.bucket_seconds, unread=unread, calendar=calendar,
        )
    else:
        s = SnapshotSources(**{field: src[name] for field, name in SNAPSHOT_SOURCES.items()})
        out = {"snapshot": refresh.refresh_snapshot(
            spark, s, params, args.out, blank_date=dt.date.fromisoformat(args.blank_date) if args.blank_date else None,
            unread=unread, scope_logs=args.scope_logs,
        )}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
