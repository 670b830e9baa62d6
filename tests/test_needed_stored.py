"""Stored queries take in and load the tables they read; kept counts of one kind equal those of all."""

from collections import Counter

from sitemerge.plans import stored_queries
from sitemerge.plans.fixture_state import PRIOR_TS
from sitemerge.plans.incremental import publish_states, run_stored
from sitemerge.plans.kept_checks import KINDS, KeptChecks
from sitemerge.plans.loads import DEFAULT_LOAD_TS
from sitemerge.plans.queries import fixture
from sitemerge.sources.store import Store

from .conftest import SMALL


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_a_stored_table_needs_no_other(spark, monkeypatch):
    monkeypatch.setattr(stored_queries, "_CACHE", {})
    got = stored_queries.stored_queries()["stored_supplier"](spark, SMALL)
    (runs,) = stored_queries._CACHE.values()
    (done,) = runs
    assert set(done) == {"address", "supplier"}
    store, _ = runs[done]
    assert set(store.current().tables) == {"address", "supplier"} and store.current().seq == 2
    assert got.count() > 0
    stored_queries.stored_queries()["stored_address"](spark, SMALL)
    assert len(runs) == 1  # the earlier run holds it


def test_kept_by_kind_equals_kept_together(spark, tmp_path):
    fx = fixture(spark, SMALL)
    names = ["address", "customer"]
    store = Store(spark, str(tmp_path), ranges=4)
    publish_states(store, fx["prior"].of(names), "prior", PRIOR_TS)
    together, single = KeptChecks(store), {k: KeptChecks(store, (k,)) for k in KINDS}
    for step in range(2):
        if step:
            run_stored(spark, fx["stg"], store, DEFAULT_LOAD_TS, tables=names)
        together.refresh()
        for kind, kept in single.items():
            kept.refresh()
            want = [r for r in together.counts().collect() if r["measure"].split(":")[0] == kind]
            assert Counter(map(str, kept.counts().select(*together.counts().columns).collect())) == Counter(map(str, want))
            assert _rows(getattr(kept, kind)()) == _rows(getattr(together, kind)())
