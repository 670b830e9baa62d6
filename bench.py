"""Benchmark: the whole ODS pipeline and its loads on the test tables.

Prints one JSON line.  Environment: ``BENCH_SF_DIR`` (default
/root/testdata/sf0.1), ``BENCH_CPUS`` (default 8).

Timed items (seconds, each materialised with a count):
* ``pipeline_first``   all eleven loads on an empty ODS (states published
                       bucketed by source key, ``BENCH_BUCKETS``, default the
                       shuffle partition count; 0 for plain parquet);
* ``pipeline_rerun``   all eleven loads again on the result (little changes);
* ``store_first``      all loads, strict, into an empty store (key ranges, commit);
* ``store_rerun``      the same again: nothing changes, no state file is written;
* ``store_batch``      a run of the order lines of the lowest 1% of keys, one in
                       ten changed: only the ranges they meet are written;
* ``prior_state``      the test fixture state (a load of 80% of the rows);
* ``load_<table>``     one table's load on the prior state, parents loaded;
* ``assign_ids``       KEY-ID over all order lines, checked against a global
                       ``row_number`` (not timed: the check).
``value`` is ``pipeline_first + pipeline_rerun``.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import Window  # noqa: E402

from sitemerge.operators.keys import assign_ids  # noqa: E402
from sitemerge.plans.incremental import run_stored  # noqa: E402
from sitemerge.plans.loads import ORDER, Options  # noqa: E402
from sitemerge.plans.pipeline import run_pipeline  # noqa: E402
from sitemerge.plans.queries import after_load, fixture  # noqa: E402
from sitemerge.session import ensure_checkpoint_dir, local_session, materialize  # noqa: E402
from sitemerge.sources.fixtures import derive_staging  # noqa: E402
from sitemerge.sources.store import Store  # noqa: E402

BIG_LOADS = ["address", "customer", "product", "order", "order_detail"]


def timed(fn):
    t = time.perf_counter()
    out = fn()
    return out, time.perf_counter() - t


def few_lines(stg):
    """Staging of a small batch: the lowest 1% of the line keys, a tenth changed."""
    line = F.col("OrderLineId")
    top = stg["Stg_OrderLine"].agg(F.max(line)).first()[0]
    changed = F.when(line % 10 == 1, F.col("Quantity") + 1).otherwise(F.col("Quantity"))
    return {**stg, "Stg_OrderLine": stg["Stg_OrderLine"].where(line <= top // 100).withColumn("Quantity", changed),
            "Stg_OrderDetails": stg["Stg_OrderDetails"].limit(0)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=max(8, cpus * 2))
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    stg = derive_staging(spark, sf_dir)
    # warm-up: JVM, scans and codegen of the staging derivation
    for df in stg.values():
        df.count()

    times: dict[str, float] = {}

    def whole(state):
        return {k: v.count() for k, v in state.items()}

    # states published bucketed by their source key (as many buckets as
    # shuffle partitions): the rerun's update and anti joins do not shuffle them
    buckets = int(os.environ.get("BENCH_BUCKETS", spark.conf.get("spark.sql.shuffle.partitions")))
    opts = Options(buckets=buckets or None)
    first, times["pipeline_first"] = timed(lambda: run_pipeline(spark, stg, load_ts="2024-11-24 00:00:00", options=opts))
    counts_first = whole(first)
    second, times["pipeline_rerun"] = timed(lambda: run_pipeline(spark, stg, first, "2024-11-25 00:00:00", opts))
    counts_second = whole(second)

    store = Store(spark, f"{ensure_checkpoint_dir(spark)}/bench-store-{uuid.uuid4().hex}")
    strict = Options(strict=True)
    done, times["store_first"] = timed(lambda: run_stored(spark, stg, store, "2024-11-24 00:00:00", strict))
    again, times["store_rerun"] = timed(lambda: run_stored(spark, stg, store, "2024-11-25 00:00:00", strict))
    batch = few_lines(stg)
    some, times["store_batch"] = timed(lambda: run_stored(
        spark, batch, store, "2024-11-26 00:00:00", strict, tables=["order_detail"]))
    lines = {w: set(c.tables["order_detail"].pieces) for w, c in (("first", done), ("again", again), ("batch", some))}

    fx, times["prior_state"] = timed(lambda: fixture(spark, sf_dir)["prior"].of(ORDER))
    for name in ["site", "region", "address", "customer", "employee", "supplier",
                 "territory", "employee_territory", "product", "order", "order_detail"]:
        df, sec = timed(lambda n=name: after_load(spark, sf_dir, n))
        if name in BIG_LOADS:
            times[f"load_{name}"] = sec

    # distinct rows ordered by all columns: a total order, so ids are exact
    items = spark.read.parquet(os.path.join(sf_dir, "lineitem.parquet")).distinct()
    order = items.columns
    ids, times["assign_ids"] = timed(lambda: materialize(assign_ids(items, "id", order), "bench"))
    ref = items.withColumn("rid", F.row_number().over(Window.orderBy(*order)))
    id_mismatch = ids.join(ref, order, "full_outer").where(
        ~F.col("id").eqNullSafe(F.col("rid"))).count()

    out = {
        "metric": "pipeline_first_plus_rerun",
        "value": round(times["pipeline_first"] + times["pipeline_rerun"], 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "rows_after_first_run": counts_first,
        "rows_after_rerun": counts_second,
        "assign_ids_mismatches": id_mismatch,
        "cpus": cpus,
        "state_buckets": buckets,
        "store_pieces_of_lines": len(lines["first"]),
        "store_pieces_written_by_rerun": sum(len(set(t.pieces) - set(done.tables[n].pieces)) for n, t in again.tables.items()),
        "store_pieces_written_by_batch": len(lines["batch"] - lines["again"]),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
