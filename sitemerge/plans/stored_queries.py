"""Queries on a store: the fixture's prior ODS taken into a new store under the
checkpoint folder, one run on it, and each table read back from its commit.  A query
takes in and loads the tables it reads, and those that their loads read.

The expected rows are those of the loads: the store changes where rows are written,
not which.  The kept reports are made on the prior ODS and brought forward by the run."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, session_key
from ..sources.fixtures import raw_staging
from ..sources.store import Store
from .fixture_state import PRIOR_TS
from .incremental import publish_states, read_states, run_stored
from .kept_checks import KINDS, KeptChecks, feeds
from .loads import DEFAULT_LOAD_TS, ORDER, Options
from .pipeline import pipeline_counts, with_reads
from .queries import fixture

_CACHE: dict[tuple, dict[tuple[str, ...], tuple[Store, dict[str, DataFrame]]]] = {}
_LOCK = threading.Lock()


def _store(spark: SparkSession, sf_dir: str, names: list[str]) -> Store:
    """A new store that holds the prior state of some tables."""
    store = Store(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/sitemerge/store-{uuid.uuid4().hex}")
    publish_states(store, fixture(spark, sf_dir)["prior"].of(names), "prior", PRIOR_TS)
    return store


def _run(spark: SparkSession, sf_dir: str, names: list[str]) -> tuple[Store, dict[str, DataFrame]]:
    """A store and its tables after a run on the prior ODS of some tables and all those
    their loads read; an earlier run of the session that holds them is taken."""
    todo = tuple(with_reads(names))
    with _LOCK:
        runs = _CACHE.setdefault((session_key(spark), sf_dir), {})
        for done, found in runs.items():
            if set(todo) <= set(done):
                return found
        store = _store(spark, sf_dir, list(todo))
        tables = list(todo) if set(todo) < set(ORDER) else None
        done = run_stored(spark, fixture(spark, sf_dir)["stg"], store, DEFAULT_LOAD_TS, run_id="load", tables=tables)
        runs[todo] = store, read_states(store, done.tables, todo)
        return runs[todo]


def states_after_run(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every table after a run on the prior ODS, from the store."""
    return _run(spark, sf_dir, ORDER)[1]


def kept_reports(spark: SparkSession, sf_dir: str, kind: str) -> KeptChecks:
    """Key counts of one kind made on the prior ODS, then brought forward to the run's commit."""
    store, _ = _run(spark, sf_dir, [n for n in ORDER if any(f.kind == kind for f in feeds(n))])
    kept = KeptChecks(store, (kind,))
    with _LOCK:
        kept.refresh(store.commit_at(1))
        kept.refresh()
    return kept


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run on raw customers and stock items keeps out, with reasons; the prior
    states of the two tables and of those their loads read are taken into a store before it."""
    loads = ["customer", "product"]
    store = _store(spark, sf_dir, with_reads(loads))
    stg = fixture(spark, sf_dir)["stg"]
    run_stored(spark, raw_staging(stg), store, DEFAULT_LOAD_TS, Options(rejects=True), "raw", loads)
    return store.rejects("raw").select(
        "table_name", "statement", "key_text", F.array_join("reasons", ",").alias("reasons")).distinct()


def _table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _run(spark, sf_dir, [name])[1][name]


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    after = states_after_run(spark, sf_dir)
    return pipeline_counts(fixture(spark, sf_dir)["prior"], after)


def _report(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: getattr(kept_reports(spark, sf_dir, name), name)()


def stored_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**{f"stored_{n}": _table(n) for n in ORDER if n != "site"}, "stored_counts": _counts}


def report_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"q_reject": rejected, **{f"kept_{r}": _report(r) for r in KINDS}}


def stored_statements(loads: dict[str, str]) -> dict[str, str]:
    """The loads' own statements."""
    return {**{f"stored_{n}": loads[f"load_{n}"] for n in ORDER if n != "site"},
            "stored_counts": loads["pipeline_counts"]}
