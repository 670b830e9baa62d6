"""PIPE-ALL on a :class:`~sitemerge.sources.store.Store`: touched ranges only.

Per load:

1. the ranges of the staged source keys are found (a distinct over the key column,
   at most as many values as the table has ranges) and only those of the own state
   are scanned, for the updates and for the anti-joins;
2. fingerprints tell which rows of that scan an update may change
   (:mod:`~sitemerge.operators.suspects`); the updates run over the ranges that hold
   one, and those ranges as they are after them are written once to the checkpoint folder;
3. the new rows get their ids after the largest one, which the record knows;
4. :meth:`Store.publish` rewrites the ranges that hold a changed row, adds a folder to
   those that only grow and carries the others over.

The run's work therefore grows with the batch and the ranges it meets, not with the
state.  Finished tables are recorded one by one; the commit is written when all are.
A run that ended early is restarted under its id: finished tables are taken as they
are, the others are loaded again, with the stamp the run began with.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import GROWS, gate
from ..operators.rejects import accepted, counted, judged, refused
from ..operators.suspects import all_suspects, narrowed
from ..operators.upsert import UpdateSpec, apply_update, new_with_ids, state_heavy_keys
from ..session import materialize
from ..sources.store import Commit, Store, TableState, range_of
from ..sources.targets import TABLES, Table
from .loads import LOADS, ORDER, STAGED_KEYS, Ctx, Options, ts_literal
from .pipeline import READS, levels, matches_changed_columns, now

MOST_RANGES = 10_000  # ranges named in a scan's filter; a batch that meets more reads them all


def staged_ranges(staging: dict[str, DataFrame], name: str, width: int) -> set[str] | None:
    """Ranges of the table ``name`` that a staged key may match; None: any."""
    if name not in STAGED_KEYS:
        return None
    keys = [staging[t].select(range_of(F.expr(k), F.lit(None), width).alias("r")) for t, k in STAGED_KEYS[name]]
    found = keys[0]
    for k in keys[1:]:
        found = found.unionByName(k)
    rows = found.where("r is not null").distinct().limit(MOST_RANGES + 1).collect()
    return {r["r"] for r in rows} if len(rows) <= MOST_RANGES else None


def read_states(store: Store, tables: dict[str, TableState], names=ORDER) -> dict[str, DataFrame]:
    """The tables of a commit as DataFrames with their declared columns."""
    return {n: store.read(tables.get(n), TABLES[n]).select(*TABLES[n].names) for n in names}


@dataclass
class Judge:
    """Takes rows that don't fit the table out of its load and keeps their report.

    A staged row that would update a row of the state is judged by the columns the
    update sets and reported under the update's name, a new one by all columns it
    provides; a row that would do neither is not reported."""

    table: Table
    own: DataFrame
    reports: list[DataFrame] = field(default_factory=list)
    counts: list[tuple] = field(default_factory=list)

    def update(self, spec: UpdateSpec) -> UpdateSpec:
        told = judged(spec.source, {t.target: t.value for t in spec.tracks}, self.table)
        keys = [F.col(e) if isinstance(e, str) else e for e, _ in spec.match]
        self.reports.append(refused(gate(told, self.own, spec.match), self.table, spec.name, keys))
        return replace(spec, source=accepted(told))

    def insert(self, rows: DataFrame) -> DataFrame:
        told, seen = counted(judged(rows, {c: F.col(c) for c in rows.columns}, self.table), f"{self.table.name}_rows")
        told = materialize(told, f"judged-{self.table.name}")
        name = f"n_{self.table.name}"
        self.counts.append((name, seen.get["accepted"], seen.get["rejected"]))
        keys = [F.col(c) for c in ([self.table.orig_col] if self.table.orig_col else self.table.pk)]
        self.reports.append(refused(told, self.table, name, keys))
        return accepted(told)

    def put(self, store: Store, run: str) -> None:
        report = self.reports[0]
        for r in self.reports[1:]:
            report = report.unionByName(r)
        store.put_rejects(run, self.table.name, report, self.counts)


def updated_ranges(ctx: Ctx, store: Store, old: TableState, name: str, own: DataFrame,
                   judge: Judge | None = None) -> DataFrame | None:
    """All rows of the ranges that hold a suspect as they are after the load's updates,
    with their ``key_range`` and ``_hit``, whether they changed; None where no row is suspected."""
    table = TABLES[name]
    specs = [build(ctx) for build in LOADS[name].updates]
    if judge is not None:
        specs = [judge.update(s) for s in specs]
    # both passes below read the updates' sources
    specs = [replace(s, source=materialize(s.source, f"source-{s.name}")) if s.joined else s for s in specs]
    sketched: dict[tuple, list[int]] = {}
    for s in specs:
        if (s.repeats, matched(s)) not in sketched:
            sketched[s.repeats, matched(s)] = state_heavy_keys(own, s)
    heavy = [sketched[s.repeats, matched(s)] for s in specs]
    found = materialize(all_suspects(own, specs, table, ["key_range"], heavy), f"suspects-{name}")
    ranges = [r["key_range"] for r in found.select("key_range").distinct().limit(MOST_RANGES + 1).collect()]
    if not ranges:
        return None
    state = store.read(old, table, set(ranges)) if len(ranges) <= MOST_RANGES else own
    state = state.withColumn("_hit", F.lit(False))
    for spec, known in zip(specs, heavy):
        state = apply_update(state, narrowed(spec, found), table, ctx.load_ts, known)
    return materialize(state, f"updated-{name}")


def matched(spec: UpdateSpec) -> tuple[str, ...]:
    return tuple(t for _, t in spec.match)


def load_table(store: Store, staging: dict[str, DataFrame], tables: dict[str, TableState], name: str,
               load_ts: str, options: Options, run_id: str = "") -> TableState:
    """One load on the store: the table's state after it (not yet recorded)."""
    table, old = TABLES[name], tables.get(name)
    state = read_states(store, tables, READS[name])
    empty = old is None or not old.pieces
    own = store.read(old, table, None if empty else staged_ranges(staging, name, old.width))
    state[name] = own
    ctx = Ctx(store.spark, staging, state, ts_literal(load_ts), options, frozenset({name} if empty else ()))
    judge = Judge(table, own) if options.rejects else None
    updated = changed = None
    if LOADS[name].updates and not empty:
        updated = updated_ranges(ctx, store, old, name, own, judge)
    if updated is not None:
        changed = updated.where("_hit").drop("_hit")
    target = None if empty else own
    if changed is not None and matches_changed_columns(name):
        target = own.join(changed.select(*table.pk).hint(GROWS), list(table.pk), "left_anti").unionByName(changed)
    arms = [a.build(ctx, target).drop("_n") for a in LOADS[name].arms]
    new = new_with_ids(own, arms, table, start=old.max_id if old else 0,
                       judge=judge.insert if judge else None)
    if judge:
        judge.put(store, run_id)
    return store.publish(table, old, changed, new, updated)


def run_stored(
    spark: SparkSession,
    staging: dict[str, DataFrame],
    store: Store,
    load_ts: str | None = None,
    options: Options | None = None,
    run_id: str | None = None,
    tables: list[str] | None = None,
) -> Commit:
    """Run the loads on the store's current ODS and commit the result.

    ``tables`` limits the run to some loads; the others are carried over.  The loads
    of one level run from driver threads at once.  With the id of a run that ended
    early, that run is finished; with that of the current commit nothing is done."""
    options = options or Options()
    run_id = run_id or uuid.uuid4().hex[:12]
    todo = [n for n in ORDER if n in (tables or ORDER)]
    now_at = store.current()
    if now_at and now_at.run == run_id:
        return now_at
    base, done, load_ts = store.begin(run_id, load_ts or now(), json.dumps([asdict(options), todo]))
    states = {**(base.tables if base else {}), **done}

    def one(name: str, before: dict[str, TableState]) -> TableState:
        after = load_table(store, staging, before, name, load_ts, options, run_id)
        store.finished(run_id, after)
        return after

    for level in levels(todo):
        open_ = [n for n in level if n not in done]
        before = dict(states)
        with ThreadPoolExecutor(max_workers=max(1, len(open_))) as pool:
            futures = {n: pool.submit(one, n, before) for n in open_}
            states.update({n: f.result() for n, f in futures.items()})
    return store.commit(base, run_id, load_ts, states)


def publish_states(store: Store, states: dict[str, DataFrame], run_id: str, load_ts: str) -> Commit:
    """Take an ODS (say, of an earlier system), or some of its tables, into an empty store."""
    base, done, load_ts = store.begin(run_id, load_ts, "states")
    if base:
        raise ValueError("the store holds an ODS already")

    def one(name: str) -> TableState:
        state = store.publish(TABLES[name], None, None, states[name])
        store.finished(run_id, state)
        return state

    open_ = [n for n in ORDER if n in states and n not in done]
    with ThreadPoolExecutor(max_workers=4) as pool:
        done.update(zip(open_, pool.map(one, open_)))
    return store.commit(base, run_id, load_ts, done)
