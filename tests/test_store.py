"""Runs on a store: touched ranges only, commit record, restart, contract."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sitemerge.plans.fixture_state import PRIOR_TS
from sitemerge.plans.incremental import publish_states, read_states, run_stored, staged_ranges
from sitemerge.plans.loads import LOADS, ORDER, STAGED_KEYS, Ctx, Options, ts_literal
from sitemerge.plans.pipeline import pipeline_counts, run_pipeline
from sitemerge.plans.queries import fixture
from sitemerge.sources.store import StateError, Store, range_of
from sitemerge.sources.targets import TABLES

from .conftest import SMALL

TS, LATER = "2024-11-24 00:00:00", "2024-11-25 00:00:00"


def rows_of(states, names=ORDER):
    return {n: Counter(map(tuple, states[n].select(TABLES[n].names).collect())) for n in names}


def data_files(root):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs
                  if f.endswith(".parquet") and "/write=" in d)


@pytest.fixture(scope="module")
def fx(spark):
    return fixture(spark, SMALL)


@pytest.fixture(scope="module")
def rewritten(spark, fx):
    """The tables after a run that rewrites them whole."""
    return {n: Counter(map(tuple, df.collect())) for n, df in run_pipeline(spark, fx["stg"], fx["prior"], TS).items()}


@pytest.fixture(scope="module")
def settled(spark, fx, tmp_path_factory):
    """A store after one strict run on an empty ODS."""
    store = Store(spark, str(tmp_path_factory.mktemp("store")), ranges=16)
    run_stored(spark, fx["stg"], store, TS, Options(strict=True), run_id="first")
    return store


def test_equals_the_whole_rewrite(spark, fx, rewritten, tmp_path):
    store = Store(spark, str(tmp_path), ranges=8)
    publish_states(store, fx["prior"], "prior", PRIOR_TS)
    done = run_stored(spark, fx["stg"], store, TS)
    assert rows_of(read_states(store, done.tables)) == rewritten


def test_strict_equals_the_whole_rewrite(spark, fx, settled):
    want = run_pipeline(spark, fx["stg"], load_ts=TS, options=Options(strict=True))
    assert rows_of(read_states(settled, settled.current().tables)) == rows_of(want)


def test_strict_rerun_writes_no_state_file(spark, fx, settled):
    before, files = settled.current(), data_files(settled.root)
    after = run_stored(spark, fx["stg"], settled, LATER, Options(strict=True))
    assert after.seq == before.seq + 1 and after.tables == before.tables
    assert data_files(settled.root) == files


def small_batch(spark, fx, store):
    """A few order lines of site 1 that the ODS holds, one of them changed, and a new one."""
    held = store.read(store.current().tables["order_detail"], TABLES["order_detail"]).where(
        "site_id = 1 and ODS_order_id is not null and ODS_product_id is not null")
    low = [r[0] for r in held.select("orig_order_detail_id").orderBy("orig_order_detail_id").limit(3).collect()]
    few = fx["stg"]["Stg_OrderLine"].where(F.col("OrderLineId").isin(low))
    changed = F.when(F.col("OrderLineId") == low[0], F.col("Quantity") + 1).otherwise(F.col("Quantity"))
    # line numbers end in 1 to 7
    new = few.where(F.col("OrderLineId") == low[0]).withColumn("OrderLineId", F.lit(low[0] // 10 * 10 + 9).cast("long"))
    stg = dict(fx["stg"])
    stg["Stg_OrderLine"] = few.withColumn("Quantity", changed).unionByName(new)
    stg["Stg_OrderDetails"] = stg["Stg_OrderDetails"].limit(0)  # site 2 sends nothing
    return stg, low


def test_small_batch_touches_few_ranges(spark, fx, settled):
    before, files = settled.current(), data_files(settled.root)
    stg, low = small_batch(spark, fx, settled)
    old = before.tables["order_detail"]
    some = staged_ranges(stg, "order_detail", old.width)
    assert 0 < len(some) < len(old.ranges) / 4
    # the state scan is pruned to those ranges
    scan = settled.read(old, TABLES["order_detail"], some)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "key_range" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    read = {r[0] for r in scan.select(F.input_file_name()).distinct().collect()}
    assert read and {f.split("key_range=")[1].split("/")[0] for f in read} <= some
    after = run_stored(spark, stg, settled, LATER, Options(strict=True), tables=["order_detail"])
    new = after.tables["order_detail"]
    changed = {p for p in new.pieces if p not in old.pieces}
    assert {r for r, *_ in changed} <= some and len(changed) >= 1
    assert all("/order_detail/" in f for f in set(data_files(settled.root)) - set(files))
    assert {n: after.tables[n] for n in ORDER if n != "order_detail"} == {
        n: before.tables[n] for n in ORDER if n != "order_detail"}
    rows = settled.read(new, TABLES["order_detail"])
    assert [r["orig_order_detail_id"] for r in rows.where(F.col("last_update") == LATER).collect()] == [low[0]]
    added = rows.where(F.col("date_created") == LATER).collect()
    assert [(r["orig_order_detail_id"], r["ODS_order_detail_id"]) for r in added] == [(low[0] // 10 * 10 + 9, old.max_id + 1)]
    assert new.rows == rows.count() == old.rows + 1


class Stopped(Exception):
    pass


@pytest.mark.parametrize("stop_at", ["customer", "commit"])
def test_broken_run_and_restart(spark, fx, rewritten, tmp_path, monkeypatch, stop_at):
    root = str(tmp_path)
    store = Store(spark, root, ranges=4)
    publish_states(store, fx["prior"], "prior", PRIOR_TS)
    prior = store.current()

    def finished(self, run, state):
        if state.name == stop_at:
            raise Stopped
        kept(self, run, state)

    def commit(self, *a):
        raise Stopped

    kept = Store.finished
    with monkeypatch.context() as m:
        m.setattr(Store, "finished", finished)
        if stop_at == "commit":
            m.setattr(Store, "commit", commit)
        with pytest.raises(Stopped):
            run_stored(spark, fx["stg"], store, TS, run_id="r1")
    # the ODS is still the one before the run, for any reader
    assert Store(spark, root).current() == prior
    # tables that finished are not loaded again
    loaded = []
    with monkeypatch.context() as m:
        m.setattr(Store, "finished", lambda self, run, state: (loaded.append(state.name), kept(self, run, state)))
        # the restart keeps the stamp the run began with
        after = run_stored(spark, fx["stg"], Store(spark, root), LATER, run_id="r1")
    assert after.load_ts == TS and stop_at not in (set(ORDER) - set(loaded)) and "region" not in loaded
    assert (loaded == []) == (stop_at == "commit")
    assert rows_of(read_states(store, after.tables)) == rewritten
    # a committed run is not run again
    assert run_stored(spark, fx["stg"], store, LATER, run_id="r1") == store.current() == after


def test_other_run_in_between(spark, fx, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    stg = fx["stg"]
    with monkeypatch.context() as m:
        m.setattr(Store, "commit", lambda self, *a: (_ for _ in ()).throw(Stopped))
        with pytest.raises(Stopped):
            run_stored(spark, stg, store, TS, run_id="a", tables=["site", "region"])
    run_stored(spark, stg, store, TS, run_id="b", tables=["site"])
    with pytest.raises(StateError, match="began on commit 0"):
        run_stored(spark, stg, store, TS, run_id="a", tables=["site", "region"])
    with pytest.raises(ValueError):
        publish_states(store, fx["prior"], "late", TS)


def test_contract_is_checked(spark, fx, settled, monkeypatch):
    from dataclasses import replace

    table = TABLES["customer"]
    wider = replace(table, cols=tuple(replace(c, width=9) if c.name == "orig_customer_id" else c for c in table.cols))
    with pytest.raises(StateError, match="orig_customer_id: stored string width 5, declared string width 9"):
        settled.read(settled.current().tables["customer"], wider)
    with pytest.raises(StateError, match="phone: stored string.*declared absent"):
        settled.read(settled.current().tables["customer"],
                     replace(table, cols=tuple(c for c in table.cols if c.name != "phone")))


def test_many_small_runs_are_compacted(spark, fx, tmp_path):
    from sitemerge.sources import store as s

    store = Store(spark, str(tmp_path), ranges=1)
    table = TABLES["region"]
    state = None
    for i in range(2 * s.MOST_FOLDERS + 3):
        new = spark.createDataFrame([(i + 1, i, f"r{i}", None, None)], table.schema)
        state = store.publish(table, state, None, new)
    kept = [p for p in state.pieces if p[0] == "k0"]
    assert max(sum(p[0] == r for p in state.pieces) for r in state.ranges) <= s.MOST_FOLDERS
    rows = store.read(state, table)
    assert sorted(r["orig_region_id"] for r in rows.collect()) == list(range(2 * s.MOST_FOLDERS + 3)) and kept
    assert state.rows == rows.count() and state.max_id == 2 * s.MOST_FOLDERS + 3


def test_both_sides_of_a_key_share_a_range(spark):
    df = spark.createDataFrame([(1, "7"), (1, "007"), (2, "ALFKI"), (3, None), (4, "-3"), (5, " 7"), (6, "")], "id long, k string")
    got = {(r["id"], r["k"]): r["r"] for r in df.withColumn("r", range_of(F.col("k"), F.col("id"), 2)).collect()}
    assert got[1, "7"] == "k3" and got[1, "007"] == "k3" and got[4, "-3"] == "k-2" and got[3, None] == "n1"
    assert got[2, "ALFKI"].startswith("h") and got[6, ""].startswith("h")
    n = spark.createDataFrame([(7,)], "k long").select(range_of(F.col("k"), F.lit(None), 2).alias("r")).first()["r"]
    assert n == "k3"


def test_staged_keys_name_what_the_updates_match(spark, fx):
    from sitemerge.sources.targets import empty_state

    state = {n: empty_state(spark, TABLES[n]) for n in ORDER}
    for strict in (False, True):
        ctx = Ctx(spark, fx["stg"], state, ts_literal(TS), Options(strict=strict))
        for name in STAGED_KEYS:
            for build in LOADS[name].updates:
                assert build(ctx).match[0][1] == TABLES[name].orig_col


def test_command_line_on_staging_files(spark, fx, rewritten, tmp_path, capsys):
    """Staging files read with their declared schemas, loaded and committed."""
    from sitemerge.cli import main
    from sitemerge.sources.staging import STAGING, read_staging

    staging, root = str(tmp_path / "staging"), str(tmp_path / "store")
    for name, df in fx["stg"].items():
        # another column order and one column more, as files of a source system may have
        df.select(*reversed(df.columns), F.lit(1).alias("extra")).write.parquet(f"{staging}/{name}.parquet")
    read = read_staging(spark, staging)
    assert {n: read[n].schema for n in STAGING} == STAGING
    store = Store(spark, root, ranges=4)
    publish_states(store, fx["prior"], "prior", PRIOR_TS)
    main(["--staging", staging, "--store", root, "--load-ts", TS, "--run", "cli"])
    out = capsys.readouterr().out
    assert out.startswith("run=cli\n") and out.endswith("commit=2\n")
    assert store.current().run == "cli" and rows_of(read_states(store, store.current().tables)) == rewritten
    main(["--staging", staging, "--store", root, "--strict", "--tables", "site,region"])
    assert store.current().seq == 3 and store.current().tables["order"] == store.current().tables["order"]


def test_counts(spark, fx, settled):
    got = read_states(settled, settled.current().tables)
    rows = {r["table_name"]: r["rows"] for r in pipeline_counts(got, got, TS).collect()}
    assert rows == {n: settled.current().tables[n].rows for n in ORDER}
