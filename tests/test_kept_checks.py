"""Kept key counts: equal to the full reports after every run, and made from the changed folders."""

from collections import Counter
from functools import reduce

import pytest
from pyspark.sql import functions as F

from sitemerge.operators.quality import ambiguous, check_fk, check_pk
from sitemerge.plans.fixture_state import PRIOR_TS
from sitemerge.plans.incremental import publish_states, read_states, run_stored
from sitemerge.plans.kept_checks import LOOKUPS, KeptChecks, changed_pieces, clash_tables, state_clashes
from sitemerge.plans.loads import ORDER, Options
from sitemerge.plans.queries import fixture
from sitemerge.sources.store import Store
from sitemerge.sources.targets import TABLES

from .conftest import SMALL

TS = ["2024-11-24 00:00:00", "2024-11-25 00:00:00", "2024-11-26 00:00:00"]


def rows(df):
    return Counter(tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in df.collect())


def union(parts):
    return reduce(lambda a, b: a.unionByName(b), parts)


def text(cols):
    return F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in cols))


def full_reports(states):
    """The reports by full scans."""
    pk, fk, fan, clash, n_rows = [], [], [], [], F.count(F.lit(1)).alias("n")
    for n in ORDER:
        cols = list(TABLES[n].pk)
        pk.append(check_pk(states[n], cols).select(F.lit(n).alias("t"), text(cols).alias("k"), "problem", "n"))
        for f in TABLES[n].fks:
            lost = check_fk(states[n], list(f.cols), states[f.parent], list(f.parent_cols)).agg(n_rows)
            fk.append(lost.select(F.lit(n).alias("t"), F.lit(",".join(f.cols)).alias("c"), F.lit(f.parent).alias("p"), "n"))
    for name, where, cols in LOOKUPS:
        ref = states["address"].where(where) if where else states["address"]
        fan.append(ambiguous(ref, cols, "ODS_address_id").select(
            F.lit(name).alias("t"), text(cols).alias("k"), "matches", "min_id", "max_id"))
    for n in clash_tables():
        clash.append(state_clashes(states[n], TABLES[n]).agg(n_rows).select(F.lit(n).alias("t"), "n"))
    return {"pk": rows(union(pk)), "fk": rows(union(fk)), "fan": rows(union(fan)), "clash": rows(union(clash))}


def kept_reports(kept):
    return {"pk": rows(kept.pk()), "fk": rows(kept.fk()), "fan": rows(kept.fan()), "clash": rows(kept.clash())}


def faulty(prior):
    """The prior ODS with repeated and null keys, orphans, an address text held three
    times and source keys of both sites."""
    out = dict(prior)
    customer = prior["customer"]
    low = customer.agg(F.min("ODS_customer_id")).first()[0]
    odd = customer.where(F.col("ODS_customer_id") == low)
    out["customer"] = (customer.unionByName(odd)
                       .unionByName(odd.withColumn("ODS_customer_id", F.lit(None).cast("long")))
                       .unionByName(odd.withColumn("ODS_customer_id", F.lit(900001).cast("long"))
                                    .withColumn("record_orig_site_id", (3 - F.col("record_orig_site_id")).cast("smallint"))))
    order = prior["order"]
    out["order"] = order.withColumn("ODS_customer_id", F.when(
        F.col("ODS_order_id") % 50 == 0, F.lit(777777).cast("long")).otherwise(F.col("ODS_customer_id")))
    address = prior["address"]
    one = address.where(F.col("full_address").isNotNull()).orderBy("ODS_address_id").limit(1)
    for extra in (910001, 910002):
        address = address.unionByName(one.withColumn("ODS_address_id", F.lit(extra).cast("long")))
    out["address"] = address
    return out


@pytest.fixture(scope="module")
def fx(spark):
    return fixture(spark, SMALL)


@pytest.fixture(scope="module")
def store(spark, fx, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("kept")), ranges=8)
    publish_states(store, faulty(fx["prior"]), "prior", PRIOR_TS)
    return store


def test_equals_the_full_reports_after_three_runs(spark, fx, store):
    kept = KeptChecks(store)
    kept.refresh()
    got, want = kept_reports(kept), full_reports(read_states(store, store.current().tables))
    assert got == want
    assert {r[2] for r in got["pk"]} == {"null", "duplicate"}
    assert any(r[3] for r in got["fk"]) and got["fan"] and any(r[1] for r in got["clash"])
    for i, ts in enumerate(TS):
        stg, tables = dict(fx["stg"]), None
        if i == 1:  # keys of the other site come in
            stg["Stg_Orders"] = stg["Stg_Orders"].withColumn("OrderID", F.col("OrderID") + 1)
            tables = ["order"]
        if i == 2:  # all customers of a site at one address
            stg["Stg_Customers"] = stg["Stg_Customers"].withColumn("Address", F.lit("1 Same Street"))
            tables = ["address", "customer"]
        run_stored(spark, stg, store, ts, Options(strict=i > 0), tables=tables)
        kept.refresh()
        assert kept_reports(kept) == full_reports(read_states(store, store.current().tables)), i
    assert kept.refresh() == 0  # the commit's counts are there
    least = kept.counts().agg(F.min("a"), F.min("b")).first()
    assert least[0] >= 0 and least[1] >= 0  # nothing is subtracted that was not counted
    fresh = KeptChecks(Store(spark, store.root))
    assert rows(fresh.counts(bad=True)) == rows(kept.counts(bad=True))


def test_a_lost_address_is_looked_up_again(spark, fx, tmp_path):
    store = Store(spark, str(tmp_path), ranges=4)
    states = faulty(fx["prior"])
    publish_states(store, states, "prior", PRIOR_TS)
    kept = KeptChecks(store)
    kept.refresh()
    old = store.current()
    table, was = TABLES["address"], old.tables["address"]
    now = store.read(was, table)
    gone = now.where("ODS_address_id = 910002").withColumn("full_address", F.lit("moved away"))
    new = store.publish(table, was, gone, now.limit(0).drop("key_range"))
    done = store.commit(old, "moved", TS[0], {**old.tables, "address": new})
    assert [s for s, _ in changed_pieces(was, new)] == [1, -1]
    kept.refresh()
    got = kept_reports(kept)
    assert got == full_reports(read_states(store, done.tables))
    fans = [r for r in got["fan"] if r[0] == "full_address"]
    assert any(r[2] == 2 and r[4] == 910001 for r in fans)  # was three, up to 910002


def test_a_small_change_reads_and_writes_few_intervals(spark, fx, tmp_path):
    store = Store(spark, str(tmp_path), ranges=32)
    publish_states(store, fx["prior"], "prior", PRIOR_TS)
    kept = KeptChecks(store)
    whole = kept.refresh()
    old = store.current()
    table, was = TABLES["order_detail"], old.tables["order_detail"]
    some = store.read(was, table).where("key_range is not null").limit(1)
    new = store.publish(table, was, some.withColumn("ODS_order_id", F.lit(1).cast("long")),
                        store.read(was, table).limit(0).drop("key_range"))
    store.commit(old, "small", TS[0], {**old.tables, "order_detail": new})
    before, after = set(was.pieces), set(new.pieces)
    assert len(before - after) == len(after - before) == 1
    few = kept.refresh()
    assert 0 < few <= 4 < whole  # at most the line's old and new order
    assert kept_reports(kept) == full_reports(read_states(store, store.current().tables))
    plan = kept.counts(bad=True)._jdf.queryExecution().executedPlan().toString()
    assert "bad" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_a_broken_refresh_leaves_the_earlier_counts(spark, fx, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path), ranges=4)
    publish_states(store, fx["prior"], "prior", PRIOR_TS)
    kept = KeptChecks(store)
    kept.refresh()
    run_stored(spark, fx["stg"], store, TS[0], tables=["customer"])
    before = kept_reports_at(kept, store.commit_at(1))

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(store, "_put", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            kept.refresh()
    assert kept_reports_at(kept, store.commit_at(1)) == before
    with pytest.raises(ValueError, match="refresh first"):
        kept.pk()
    kept.refresh()
    assert kept_reports(kept) == full_reports(read_states(store, store.current().tables))


def kept_reports_at(kept, commit):
    return rows(kept.counts(commit=commit))


def test_an_empty_ods(spark, tmp_path, fx):
    store = Store(spark, str(tmp_path), ranges=4)
    publish_states(store, {n: fx["prior"][n].limit(0) for n in ORDER}, "none", PRIOR_TS)
    kept = KeptChecks(store)
    kept.refresh()
    got = kept_reports(kept)
    assert not got["pk"] and not got["fan"] and {r[3] for r in got["fk"]} == {0}
