"""Kept counts are netted on the keys' numbers, and a first refresh writes them once."""

from sitemerge.plans import kept_checks
from sitemerge.plans.fixture_state import PRIOR_TS
from sitemerge.plans.incremental import publish_states, read_states
from sitemerge.plans.kept_checks import Feed, KeptChecks, key_names, netted
from sitemerge.plans.queries import fixture
from sitemerge.sources.store import Store

from .conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keys_are_netted_as_numbers(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "c long")
    parent = spark.createDataFrame([(1,), (3,)], "p short")
    texts = spark.createDataFrame([("1",), ("01",)], "p string")
    fk = lambda other: [(Feed("fk:c:c:p", ("c",)), child, 1), (Feed("fk:c:c:p", ("p",), side="b"), other, 1),
                        (Feed("fk:c:c:p", ("c",)), child.where("c = 2"), -1)]
    told = lambda df: sorted((tuple(r["key"]), r["a"], r["b"]) for r in df.collect())
    assert told(netted("fk:c:c:p", fk(parent))) == [(("1",), 2, 1), (("3",), 0, 1)]
    assert told(netted("fk:c:c:p", fk(texts))) == [(("01",), 0, 1), (("1",), 2, 1)]  # compared as text
    shuffled = [line for line in plan(netted("fk:c:c:p", fk(parent))).splitlines() if "Exchange hashpartitioning" in line]
    assert shuffled and all("measure" not in line and "array" not in line for line in shuffled)
    nulls = netted("pk:c", [(Feed("pk:c", ("c",), nulls=True), child, 1)])
    assert sorted((r["key"], r["a"]) for r in nulls.where("key[0] is null").collect()) == [([None], 1)]
    assert key_names(2) == ["_k0", "_k1"]


def test_a_first_refresh_writes_counts_once(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path), ranges=4)
    publish_states(store, fixture(spark, SMALL)["prior"].of(["site", "address"]), "prior", PRIOR_TS)
    written = []
    monkeypatch.setattr(kept_checks, "materialize", lambda df, label: written.append(label) or df)
    kept = KeptChecks(store, ("pk",))
    assert kept.refresh() > 0 and not written
    assert kept.counts().where("measure = 'pk:address'").count() == read_states(
        store, store.current().tables, ["address"])["address"].count()
