"""Runs on a store move fewer rows: hashed references, one sketch a key, ranges written from
the updated rows, ids sorted by one number first."""

import random
from collections import Counter

from sitemerge.operators import keys
from sitemerge.operators.joins import gate, lookup, new_rows
from sitemerge.plans import incremental
from sitemerge.plans.fixture_state import PRIOR_TS
from sitemerge.plans.incremental import publish_states, read_states, run_stored
from sitemerge.plans.loads import DEFAULT_LOAD_TS
from sitemerge.plans.pipeline import with_reads
from sitemerge.plans.queries import fixture
from sitemerge.sources import store as stores
from sitemerge.sources.store import Store
from sitemerge.sources.targets import TABLES

from .conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_hashed_references_equal_merged_ones(spark):
    a = spark.createDataFrame([(1, "p"), (1, "q"), (2, "r"), (None, "s"), (5, "t")], "x long, y string")
    b = spark.createDataFrame([(1, 10), (1, 11), (None, 12), (3, 13), (5, None)], "k long, v long")
    for join in (lambda **o: gate(a, b, [("x", "k")], **o), lambda **o: new_rows(a, b, [("x", "k")], **o),
                 lambda **o: lookup(a, b, [("x", "k")], {"w": "v"}, **o),
                 lambda **o: lookup(a, b, [("x", "k")], {"w": "v"}, lowest=True, **o),
                 lambda **o: lookup(a, b, [("x", "k")], {"w": "v"}, how="inner", **o)):
        assert rows(join(hashed=True)) == rows(join())
        told = plan(join(hashed=True))
        assert "ShuffledHashJoin" in told and "SortMergeJoin" not in told and "Broadcast" not in told


def test_ids_follow_the_order_beside_extreme_keys(spark):
    rng = random.Random(3)
    sites = [None, 1, 2, -7, 1 << 15, (1 << 15) + 1, 1 << 40, -(1 << 15), -(1 << 40), (1 << 63) - 1, -(1 << 63)]
    numbers = [None, 0, 1, -1, 9, 1 << 46, (1 << 46) + 1, -(1 << 46), -(1 << 50), (1 << 63) - 1, -(1 << 63)]
    data = [(s, k, v) for s in sites for k in numbers for v in ("a", None)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "site_id long, k long, v string")
    assert keys.leading(df, ["site_id", "k", "v"]) and not keys.leading(df, ["site_id", "v"])
    got = keys.assign_ids(df, "id", ["site_id", "k", "v"], start=5, partitions=4)
    first = lambda x: (x is not None, x if x is not None else 0)  # noqa: E731  NULLs first
    want = sorted(data, key=lambda r: (first(r[0]), first(r[1]), (r[2] is not None, r[2] or "")))
    assert [tuple(r) for r in got.orderBy("id").select("site_id", "k", "v").collect()] == want
    assert [r["id"] for r in got.orderBy("id").collect()] == list(range(6, 6 + len(data)))


def test_one_sketch_and_no_second_look_at_the_state(spark, tmp_path, monkeypatch):
    fx = fixture(spark, SMALL)
    names = with_reads(["order_detail"])
    store = Store(spark, str(tmp_path), ranges=4)
    publish_states(store, fx["prior"].of(names), "prior", PRIOR_TS)
    sketched, read = [], []
    monkeypatch.setattr(incremental, "state_heavy_keys",
                        lambda s, u, f=incremental.state_heavy_keys: sketched.append(u.name) or f(s, u))
    monkeypatch.setattr(stores.Store, "read", lambda self, state, table, ranges=None, f=stores.Store.read:
                        read.append((table.name, ranges)) or f(self, state, table, ranges))
    done = run_stored(spark, fx["stg"], store, DEFAULT_LOAD_TS, tables=names)
    assert [n for n in sketched if n.startswith("u_order_detail")] == ["u_order_detail_1"]
    assert ("order_detail", set()) in read  # publish looks for no row that the updates did not change
    after = read_states(store, done.tables, names)["order_detail"]
    assert after.where("last_update is not null").count() > 0
    assert after.count() == after.select("ODS_order_detail_id").distinct().count()


def test_a_row_beside_its_changed_double_stays(spark, tmp_path):
    """Rows may share a primary key; the one that no update changes is not lost."""
    table = TABLES["region"]
    store = Store(spark, str(tmp_path), ranges=2)
    prior = spark.createDataFrame([(1, 1, "old", None, None), (1, 2, "same", None, None), (None, 3, "old", None, None)], table.schema)
    publish_states(store, {"region": prior}, "prior", PRIOR_TS)
    stg = {"Stg_Region": spark.createDataFrame([(1, "new"), (2, "same"), (3, "new")], "RegionID long, RegionDescription string")}
    done = run_stored(spark, stg, store, DEFAULT_LOAD_TS, tables=["region"])
    got = read_states(store, done.tables, ["region"])["region"]
    assert rows(got.select("ODS_region_id", "orig_region_id", "description")) == Counter(
        [(1, 1, "new"), (1, 2, "same"), (None, 3, "new")])
