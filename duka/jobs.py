"""Batch entry points for spark-submit.

    zip -r duka.zip duka
    spark-submit --py-files duka.zip duka/jobs.py build --sf RAW --out STAR
    spark-submit --py-files duka.zip duka/jobs.py run revenue_kpis \\
        --sf RAW --store STAR --out REPORTS/revenue_kpis
    ... run monthly_revenue --param target_year=2000 ...

(locally: `python -m duka.jobs build ...`).

The session is the one the cluster provides (`getOrCreate`); its
`spark.checkpoint.dir` must name shared storage (the numbering operator
writes its lineage-cut tables there). Report results are written as Parquet
(full reload), never collected to the driver.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from duka.plans import registry
from duka.session import apply_defaults, ensure_checkpoint_dir
from duka.sources.store import build_warehouse
from duka.sources.warehouse import Warehouse


def _params(pairs: list[str]) -> dict:
    out = {}
    for p in pairs:
        key, _, value = p.partition("=")
        out[key] = int(value) if value.lstrip("-").isdigit() else value
    return out


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="duka.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="write the warehouse tables")
    b.add_argument("--sf", required=True, help="folder of the raw order tables")
    b.add_argument("--out", required=True, help="warehouse folder (overwritten)")
    r = sub.add_parser("run", help="write one report")
    r.add_argument("name", choices=sorted(registry.PLANS))
    r.add_argument("--sf", required=True)
    r.add_argument("--store", default=None, help="warehouse folder from `build`")
    r.add_argument("--out", required=True, help="output folder (overwritten)")
    r.add_argument("--param", action="append", default=[], help="key=value")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"duka-{args.cmd}").getOrCreate()
    ensure_checkpoint_dir(apply_defaults(spark))
    if args.cmd == "build":
        times = build_warehouse(Warehouse(spark, args.sf), args.out)
        print(json.dumps({"built": args.out, "seconds": times}))
    else:
        w = registry.warehouse(spark, args.sf, args.store)
        fn = registry.PLANS[args.name]
        params = _params(args.param)
        df = fn(w, **params) if params else fn(w)
        df.write.mode("overwrite").parquet(args.out)
        print(json.dumps({"report": args.name, "out": args.out}))


if __name__ == "__main__":
    main()
