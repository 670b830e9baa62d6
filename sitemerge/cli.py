"""Command line: run the whole load (PIPE-ALL) on staging files.

    python -m sitemerge.cli --staging DIR --store DIR [--run ID] [--load-ts "2024-11-24 00:00:00"]
        [--strict] [--tables order,order_detail]

``--staging`` holds one parquet folder per staging table (``Stg_*.parquet``).  ``--store``
holds the ODS (:mod:`sitemerge.sources.store`); an empty folder is an empty ODS.  Each run
continues from the last committed one, writes the ranges it changes, commits and prints
its id.  After a run that ended early, ``--run`` with its id finishes it.  Paths may be on
any file system Spark reads.
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import SparkSession

from .plans.incremental import run_stored
from .plans.loads import Options
from .sources.staging import read_staging
from .sources.store import Store


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--staging", required=True)
    ap.add_argument("--store", required=True)
    ap.add_argument("--run", help="id of the run; that of a run that ended early finishes it")
    ap.add_argument("--load-ts", help="stamp of the run (default: the current time)")
    ap.add_argument("--strict", action="store_true")
    ap.add_argument("--tables", help="comma-separated subset of the loads, in order")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("sitemerge").getOrCreate()
    run_id = args.run or uuid.uuid4().hex[:12]
    print(f"run={run_id}", flush=True)  # at once: it names the run if this process ends
    done = run_stored(spark, read_staging(spark, args.staging), Store(spark, args.store), args.load_ts,
                      Options(strict=args.strict), run_id, args.tables.split(",") if args.tables else None)
    for name, state in done.tables.items():
        print(f"{name}: {state.rows} rows in {len(state.ranges)} ranges")
    print(f"commit={done.seq}")


if __name__ == "__main__":
    main()
