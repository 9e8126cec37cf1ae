"""Command line: build every model from a date-partitioned raw session dataset.

    python -m journeyline --raw PATH [--out PATH] [--start 20170701] [--end 20170731] [--no-tests]
"""

from __future__ import annotations

import argparse
import datetime as dt

from .plans.project import build_project
from .session import get_spark
from .sources.raw_sessions import REFERENCE_END, REFERENCE_START, read_sessions


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="journeyline")
    ap.add_argument("--raw", required=True, help="date=yyyyMMdd partitioned Parquet of raw sessions")
    ap.add_argument("--out", default=None, help="output folder (default: under spark.checkpoint.dir)")
    ap.add_argument("--start", default=REFERENCE_START)
    ap.add_argument("--end", default=REFERENCE_END)
    ap.add_argument("--no-tests", action="store_true")
    args = ap.parse_args(argv)
    spark = get_spark()
    raw = read_sessions(spark, args.raw, args.start, args.end)
    day = lambda s: dt.date(int(s[:4]), int(s[4:6]), int(s[6:]))
    built = build_project(spark, raw, args.out, day(args.start), day(args.end), run_tests=not args.no_tests)
    if "test_report" in built:
        built["test_report"].where("status != 'pass'").show(200, truncate=False)


if __name__ == "__main__":
    main()
