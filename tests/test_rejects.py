"""Rejects: what a column can't hold is reported and kept out, everything else is loaded."""

from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sitemerge.operators.rejects import accepted, judged, refused
from sitemerge.plans.fixture_state import PRIOR_TS
from sitemerge.plans.incremental import publish_states, run_stored
from sitemerge.plans.loads import Options
from sitemerge.plans.queries import fixture
from sitemerge.sources.fixtures import raw_staging
from sitemerge.sources.store import Store
from sitemerge.sources.targets import TABLES

from .conftest import SMALL

TS = "2024-11-24 00:00:00"


def test_reasons(spark):
    table = TABLES["product"]
    rows = spark.createDataFrame(
        [(1, "n" * 100, "1.005"), (2, "n" * 101, "999.99"), (3, None, None), (4, "", "1000.00"), (5, "é" * 100, "-999.99"),
         (6, "n" * 101, "-1000.00")], "k long, name string, p string").withColumn("p", F.col("p").cast("decimal(12,3)"))
    told = judged(rows, {"name": F.col("name"), "unit_price": F.col("p")}, table)
    assert sorted(r["k"] for r in accepted(told).collect()) == [1, 3, 5]
    report = {r["key_text"]: r["reasons"] for r in refused(told, table, "s", [F.col("k")]).collect()}
    assert report == {"2": ["width:name"], "4": ["range:unit_price"], "6": ["range:unit_price", "width:name"]}
    assert accepted(told.limit(0)).count() == 0


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    """A judged run on raw staging, and a plain run without the staged rows that don't fit."""
    fx = fixture(spark, SMALL)
    raw = raw_staging(fx["stg"])
    out = {}
    fits = {
        **raw,
        "Stg_Customer": raw["Stg_Customer"].where(
            "length(CAST(CustomerId AS string)) <= 5 and coalesce(length(ContactName), 0) <= 50"),
        "Stg_StockItem": raw["Stg_StockItem"].where("abs(Cost) < 1000 and abs(RetailPrice) < 1000"),
    }
    for name, stg, rejects in (("judged", raw, True), ("plain", fits, False)):
        store = Store(spark, str(tmp_path_factory.mktemp(name)), ranges=8)
        publish_states(store, fx["prior"], "prior", PRIOR_TS)
        run_stored(spark, stg, store, TS, Options(rejects=rejects), "raw", ["customer", "product"])
        out[name] = store
    return out


def test_the_rest_is_loaded(runs):
    judged_, plain = runs["judged"], runs["plain"]
    for name in ("customer", "product"):
        a, b = (Counter(map(tuple, s.read(s.current().tables[name], TABLES[name]).select(TABLES[name].names).collect()))
                for s in (judged_, plain))
        assert a == b


def test_what_does_not_fit_is_reported(runs):
    store = runs["judged"]
    report = store.rejects("raw").collect()
    kinds = {(r["statement"], reason) for r in report for reason in r["reasons"]}
    assert ("n_customer", "width:orig_customer_id") in kinds
    assert ("u_product_1", "range:unit_price") in kinds
    customers = store.read(store.current().tables["customer"], TABLES["customer"])
    assert customers.where("length(orig_customer_id) > 5").isEmpty()
    refused_ids = {r["key_text"] for r in report if "width:orig_customer_id" in r["reasons"]}
    assert refused_ids and all(len(k) > 5 for k in refused_ids)
    counts = {r["statement"]: (r["accepted"], r["rejected"]) for r in store.reject_counts("raw").collect()}
    inserts = Counter(r["statement"] for r in report if r["statement"].startswith("n_"))
    assert {s: n for s, (_, n) in counts.items()} == {s: inserts.get(s, 0) for s in counts}
    assert set(counts) == {"n_customer", "n_product"}


def test_a_run_that_does_not_judge_has_no_rejects(runs):
    assert runs["plain"].rejects("raw").count() == 0
    assert runs["plain"].reject_counts("raw").count() == 0
