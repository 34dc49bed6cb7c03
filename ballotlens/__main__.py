"""Command line: ``python -m ballotlens <command>`` (or via spark-submit).

  extract  --source DIR --out DIR [--only a,b] [--full] [--settled-through N]
           build / update the datasets (one Spark job per dataset)
  kpis     --out DIR --dest DIR [--source DIR]
           write every KPI (K1.x, DOC, P*) as parquet from the persisted datasets
  views    --out DIR
           register dataset and K1 views in this session and print their row counts
"""

from __future__ import annotations

import argparse
import sys


def _session():
    from pyspark.sql import SparkSession

    from ballotlens.session import build_session, ensure_session
    active = SparkSession.getActiveSession()
    return ensure_session(active) if active is not None else build_session()


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ballotlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ex = sub.add_parser("extract")
    ex.add_argument("--source", required=True)
    ex.add_argument("--out", required=True)
    ex.add_argument("--only", default="")
    ex.add_argument("--full", action="store_true")
    ex.add_argument("--settled-through", type=int, default=None)
    kp = sub.add_parser("kpis")
    kp.add_argument("--out", required=True)
    kp.add_argument("--dest", required=True)
    kp.add_argument("--source", default=None)
    vw = sub.add_parser("views")
    vw.add_argument("--out", required=True)
    args = ap.parse_args(argv)

    spark = _session()
    from ballotlens.sources.tables import Tables
    if args.cmd == "extract":
        from ballotlens.plans.job import extract_all
        only = [s for s in args.only.split(",") if s] or None
        done = extract_all(spark, Tables.from_catalog(spark, args.source), args.out, only=only,
                           full=args.full, settled_through=args.settled_through)
        for name, epochs in done.items():
            print(f"{name}: {len(epochs)} epoch(s) written")
    elif args.cmd == "kpis":
        from ballotlens.plans.kpis import KPI_FUNCS, Datasets
        tables = Tables.from_catalog(spark, args.source) if args.source else None
        ds = Datasets.from_outputs(spark, args.out, tables)
        for name, fn in KPI_FUNCS.items():
            try:
                fn(ds).write.mode("overwrite").parquet(f"{args.dest}/{name}")
            except KeyError as e:              # needs source tables, none given
                print(f"{name}: skipped ({e})")
                continue
            print(f"{name}: written")
    else:
        from ballotlens.sources.catalog import register_kpi_views, register_outputs
        for view in register_outputs(spark, args.out) + register_kpi_views(spark):
            print(f"{view}: {spark.table(view).count()} rows")
    return 0


if __name__ == "__main__":
    sys.exit(main())
