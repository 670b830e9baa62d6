"""Connected components with a hub, and the embedding links against brute force."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sitemerge.llm import components as comp
from sitemerge.llm import pivots, queries as q
from sitemerge.llm.components import components
from tests.conftest import SMALL


def roots(links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_components_equal_union_find(spark):
    rng = np.random.default_rng(5)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))]
    links += [(900, x) for x in range(901, 1500)] + [(7, 7), (None, 3)]
    got = {r["vertex"]: r["component"] for r in components(
        spark.createDataFrame(links, "u long, v long")).collect()}
    want = {v: r for v, r in roots([x for x in links if None not in x and x[0] != x[1]]).items() if v != r}
    assert got == want


def test_the_join_of_a_hub_is_split(spark, monkeypatch):
    """Nine tenths of the links on one vertex: the adaptive plan of a step's join
    splits its partition."""
    plans = []

    def kept(df, label, plain=comp.cut):
        if label == "large-star":
            df.collect()  # the final adaptive plan needs a run
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, label)

    monkeypatch.setattr(comp, "cut", kept)
    # many small scan tasks: a partition is split between the tasks that wrote it
    conf = {"spark.sql.files.maxPartitionBytes": "32k", "spark.sql.files.openCostInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        links = spark.range(n, numPartitions=8).select(
            F.when(F.col("id") % 10 < 9, F.lit(-1)).otherwise(F.col("id") * 7 % n).alias("u"), F.col("id").alias("v"))
        assert components(links).where("component = -1").count() >= 0.9 * n
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plans[0]


def brute(rows, threshold=0.93):
    """n_links, component and kept of each (id, label, vector), from all pairs."""
    out, by_label = {}, {}
    links = []
    for i, label, v in rows:
        ok = v is not None and label is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        out[i] = 0
        if ok:
            by_label.setdefault((label, len(v)), []).append((i, np.asarray(v, dtype=np.float64)))
    for group in by_label.values():
        ids = np.array([i for i, _ in group])
        x = np.array([v for _, v in group])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a in range(len(ids)):
            near = np.flatnonzero(x @ x[a] >= threshold)
            for b in near[near != a]:
                out[int(ids[a])] += 1
                links.append((int(ids[a]), int(ids[b])))
    root = roots(links)
    return {i: (n, root.get(i, i), root.get(i, i) == i) for i, n in out.items()}


def test_op6_query_equals_brute_force(spark):
    t = pq.read_table(f"{SMALL}/embeddings.parquet").to_pylist()
    name = next(n for n in q.llm_queries() if n.startswith("op6_"))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in q.llm_queries()[name](spark, SMALL).collect()}
    assert got == brute([(r["vec_id"], r["label"], r["embedding"]) for r in t])


@pytest.mark.parametrize("count", [256, 1024])
def test_op6_recall_just_above_the_threshold(count):
    """Pairs of cosine 0.932 in 64 dimensions that share two of eight nearest reference points."""
    rng = np.random.default_rng(count)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    pivot = pivots.choose_pivots(unit(rng.normal(size=(pivots.SAMPLE, 64))), count)
    a = unit(rng.normal(size=(4000, 64)))
    side = rng.normal(size=a.shape)
    side = unit(side - (side * a).sum(1, keepdims=True) * a)
    b = 0.932 * a + np.sqrt(1 - 0.932**2) * side
    p, r = (pivots.permutation_prefix(x, pivot, 8) for x in (a, b))
    shared = (p[:, :, None] == r[:, None, :]).sum((1, 2))
    recall = float((shared >= pivots.PivotParams().min_shared).mean())
    print(f"recall with {count} reference points: {recall:.5f}")
    assert recall >= 0.995
