"""Print the formatted physical plan of registered queries.

Usage: python -m duka.plans.explain [--sf DIR] [--store DIR] [--run] name [name ...]

`--run` executes the query once first (collecting its rows, so use it on
reports, not on whole facts), so the adaptive plan printed is the final one
(joins AQE turned into broadcasts, split skewed partitions, coalesced
shuffles).
"""

from __future__ import annotations

import argparse

from duka.plans import registry
from duka.session import local_session


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("names", nargs="+")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--store", default=None)
    ap.add_argument("--run", action="store_true")
    args = ap.parse_args()
    spark = local_session()
    for name in args.names:
        df = registry.run(name, spark, args.sf, store_dir=args.store)
        if args.run:
            df.collect()  # the DataFrame's own execution, so its plan is final
        print(f"===== {name}")
        df.explain("formatted")


if __name__ == "__main__":
    main()
