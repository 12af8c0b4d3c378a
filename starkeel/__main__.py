"""Entry of the daily job, for one or more dates.

    python -m starkeel --raw <uri> --curated <uri> --run-date 2026-06-02 [...]

With ``--landing`` the day's CSV files are first published to the raw zone.
"""

from __future__ import annotations

import argparse

from .plans.daily import backfill, check_zone
from .plans.session import build_session
from .sources.raw import publish


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="starkeel", description=__doc__.splitlines()[0])
    parser.add_argument("--run-date", nargs="+", required=True, metavar="YYYY-MM-DD")
    parser.add_argument("--raw", required=True)
    parser.add_argument("--curated", required=True)
    parser.add_argument("--landing")
    parser.add_argument("--register", action="store_true", help="define the tables in the catalog")
    parser.add_argument("--check", action="store_true", help="fail if a constraint of the zone is violated")
    args = parser.parse_args(argv)
    spark = build_session()
    if args.landing:
        for day in args.run_date:
            publish(spark, args.landing, args.raw, day)
    backfill(spark, args.run_date, args.raw, args.curated, register=args.register)
    if args.check:
        last = max(args.run_date)
        broken = [n for n, df in check_zone(spark, args.curated, last).items() if not df.isEmpty()]
        if broken:
            raise SystemExit("violated: " + ", ".join(broken))


if __name__ == "__main__":
    main()
