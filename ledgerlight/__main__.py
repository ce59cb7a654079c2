"""Command line: run the daily ETL, or one registered query into a folder.

    python -m ledgerlight etl --source DIR --target DIR [--as-of YYYY-MM-DD]
    python -m ledgerlight query KEY --source DIR --out DIR [--format parquet|csv]
    python -m ledgerlight list

The master and cluster settings come from ``spark-submit`` / the
environment; ``--local N`` runs on ``local[N]`` instead.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ledgerlight")
    ap.add_argument("--local", type=int, default=None, help="run on local[N]")
    sub = ap.add_subparsers(dest="cmd", required=True)
    e = sub.add_parser("etl", help="validate, stage, transform, load and report one day")
    e.add_argument("--source", required=True)
    e.add_argument("--target", required=True)
    e.add_argument("--as-of", default=None)
    q = sub.add_parser("query", help="run one registered query and write its result")
    q.add_argument("key")
    q.add_argument("--source", required=True)
    q.add_argument("--out", required=True)
    q.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    sub.add_parser("list", help="list registered query keys")
    args = ap.parse_args(argv)

    from .plans import catalog
    if args.cmd == "list":
        for k, entry in sorted(catalog.load_all().items()):
            print(f"{k}\t{','.join(entry.survey_ids)}\t{'sql' if entry.sql else 'rows-only'}")
        return 0

    from .session import build_session
    master = f"local[{args.local}]" if args.local else None
    spark = build_session(master, shuffle_partitions=(args.local * 2 if args.local else None),
                          cluster=not args.local)
    try:
        if args.cmd == "etl":
            from .plans.etl import daily_etl
            done = daily_etl(spark, args.source, args.target, args.as_of)
            for name, keys in sorted(done.manifest.folders.items()):
                print(f"{name}\tversion {done.manifest.version}\t{len(keys)} folders below {done.root}")
            print(f"reports\t{done.reports}")
        else:
            df = catalog.load_all()[args.key].build(spark, args.source)
            w = df.write.mode("overwrite")
            if args.format == "csv":
                w = w.option("header", "true")
            getattr(w, args.format)(args.out)
            print(args.out)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
