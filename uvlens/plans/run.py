"""Run registered queries from the command line.

    python -m uvlens.plans.run uv_exact top_pages --tables /data/sf1 --out /data/results
    python -m uvlens.plans.run --list

Each result is written as Parquet to ``<out>/<query>`` (or shown with
``--show N``). ``--cluster`` applies the large-cluster settings.
"""

from __future__ import annotations

import argparse
import time

from uvlens.plans import QUERIES
from uvlens.session import build_session


def main(argv=None) -> None:
    p = argparse.ArgumentParser(description="Run uvlens queries")
    p.add_argument("names", nargs="*")
    p.add_argument("--tables", default="/root/testdata/sf0.01")
    p.add_argument("--out")
    p.add_argument("--show", type=int, default=0)
    p.add_argument("--list", action="store_true")
    p.add_argument("--master")
    p.add_argument("--cluster", action="store_true")
    args = p.parse_args(argv)
    if args.list:
        for name, fn in sorted(QUERIES.items()):
            doc = (fn.__doc__ or "").strip().splitlines()
            print(f"{name:28s} {doc[0] if doc else ''}")
        return
    spark = build_session(args.master, app="uvlens-run", cluster=args.cluster)
    for name in args.names:
        t0 = time.perf_counter()
        df = QUERIES[name](spark, args.tables)
        if args.out:
            df.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
        elif args.show:
            df.show(args.show, truncate=False)
        else:
            df.write.format("noop").mode("overwrite").save()
        print(f"{name}: {time.perf_counter() - t0:.2f}s")


if __name__ == "__main__":
    main()
