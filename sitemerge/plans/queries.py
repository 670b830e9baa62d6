"""Named queries over the test tables: one per update, insert arm and load.

Each takes ``(spark, sf_dir)``: the staging tables are derived from the raw
tables in ``sf_dir`` and the prior ODS state is built from them
(:mod:`sitemerge.plans.fixture_state`), so every query's work grows with the
input.  A prior table is written once per session and directory, when a query
first needs it, and shared by the queries.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..operators.upsert import to_target
from ..session import drop_shuffles, session_key
from ..sources.fixtures import derive_staging
from ..sources.targets import TABLES
from .fixture_state import PriorStates
from .loads import DEFAULT_LOAD_TS, LOADS, ORDER, Ctx, Options, ts_literal
from .pipeline import READS, arm_rows, levels, pipeline_counts, publish, run_load, run_updates, with_reads

_CACHE: dict[tuple, dict] = {}


def fixture(spark: SparkSession, sf_dir: str) -> dict:
    """Staging, prior state and (filled lazily) each table's state after its
    load, for one directory of test tables; each table built once per session."""
    key = (session_key(spark), sf_dir)
    if key not in _CACHE:
        drop_shuffles(spark)
        stg = derive_staging(spark, sf_dir)
        _CACHE[key] = {"stg": stg, "prior": PriorStates(spark, stg), "after": {}}
    return _CACHE[key]


def context(spark: SparkSession, sf_dir: str, name: str, options: Options | None = None) -> Ctx:
    """Context for ``name``'s load: its own prior state, and the states of the
    tables it reads after their loads."""
    fx = fixture(spark, sf_dir)
    state = fx["prior"].of([name])
    for parent in READS[name]:
        state[parent] = after_load(spark, sf_dir, parent)
    return Ctx(spark, fx["stg"], state, ts_literal(DEFAULT_LOAD_TS), options or Options())


def after_load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table's state after its load (parents loaded first, the loads of
    one level from driver threads at once); computed once per session."""
    fx = fixture(spark, sf_dir)
    if name not in fx["after"]:
        for level in levels([t for t in with_reads([name]) if t not in fx["after"]]):
            ctxs = {t: context(spark, sf_dir, t) for t in level}
            with ThreadPoolExecutor(max_workers=len(level)) as pool:
                futures = {t: pool.submit(lambda t=t: publish(run_load(ctxs[t], t), t, None, ""))
                           for t in level}
                fx["after"].update({t: f.result() for t, f in futures.items()})
    return fx["after"][name]


def _u(name: str, upto: int) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ctx = context(spark, sf_dir, name)
        return to_target(run_updates(ctx, name, upto), TABLES[name])

    return run


def _n(name: str, arm: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return arm_rows(context(spark, sf_dir, name), name, arm)

    return run


def _load(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run_load(context(spark, sf_dir, name), name)

    return run


def _pipeline_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fixture(spark, sf_dir)
    after = {name: after_load(spark, sf_dir, name) for name in ORDER}
    return pipeline_counts(fx["prior"], after)


def load_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable] = {}
    for name in ORDER:
        load = LOADS[name]
        n_up = len(load.updates)
        for i in range(1, n_up + 1):
            out[f"u_{name}" if n_up == 1 else f"u_{name}_{i}"] = _u(name, i)
        if name == "site":  # the site rows are fixed literals: covered by the pipeline
            continue
        for arm in load.arms:
            out[f"n_{arm.name}"] = _n(name, arm.name)
        out[f"load_{name}"] = _load(name)
    out["pipeline_counts"] = _pipeline_counts
    return out
