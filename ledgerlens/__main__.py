"""Run the analysis: ``python -m ledgerlens SALES.csv OUT --ts-format ...``."""

from __future__ import annotations

import argparse
import datetime as dt

from ledgerlens.plans.flows import write_analysis
from ledgerlens.schema import AMOUNT_SCALE, HOME_COUNTRY
from ledgerlens.session import build_session, partitions_for, shuffle_partitions
from ledgerlens.sources.sales import read_sales, read_segments
from ledgerlens.sources.segments import default_segments


def main() -> None:
    parser = argparse.ArgumentParser(prog="ledgerlens")
    parser.add_argument("sales")
    parser.add_argument("out")
    parser.add_argument("--format", default="csv", help="csv or parquet")
    parser.add_argument("--ts-format", help="pattern of text dates, e.g. 'dd/MM/yyyy HH:mm'")
    parser.add_argument("--segments", help="CSV with columns rfm, Categoria; default: built-in rules")
    parser.add_argument("--as-of", type=dt.datetime.fromisoformat, help="default: now")
    parser.add_argument("--home", default=HOME_COUNTRY)
    parser.add_argument("--amount-scale", type=int, default=AMOUNT_SCALE, help="decimals of an amount")
    parser.add_argument("--on-bad-edges", choices=["collapse", "error"], default="collapse")
    parser.add_argument(
        "--quarantine", action="store_true", help="write rows with unreadable dates or amounts to OUT/rejects; default: fail"
    )
    parser.add_argument("--overwrite", action="store_true", help="replace tables of an earlier run in OUT")
    parser.add_argument("--input-bytes", type=int, help="size of SALES: sets the shuffle partitions; default: as configured")
    args = parser.parse_args()
    spark = build_session()
    lookup = read_segments(spark, args.segments) if args.segments else default_segments(spark)
    wanted = partitions_for(args.input_bytes) if args.input_bytes else None
    with shuffle_partitions(spark, wanted):
        written = write_analysis(
            spark,
            read_sales(spark, args.sales, args.format),
            lookup,
            args.out,
            args.as_of or dt.datetime.now(),
            args.ts_format,
            args.home,
            args.on_bad_edges,
            args.amount_scale,
            "overwrite" if args.overwrite else "error",
            args.quarantine,
        )
    print("\n".join(written))


if __name__ == "__main__":
    main()
