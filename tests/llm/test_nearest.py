"""The graph index of ``ann.py``: what its build costs and what a search finds."""

import numpy as np

from sitemerge.llm import ann


def sphere(n, dim=64, seed=3):
    return ann.unit_rows(np.random.default_rng(seed).normal(size=(n, dim))).astype(np.float32)


def test_best_columns_are_the_largest():
    sims = sphere(40, 700, 1)
    for count in (1, 7, 48, 700):
        got = ann.best_columns(sims, count)
        assert np.array_equal(np.sort(got, axis=1), np.sort(np.argsort(-sims, axis=1)[:, :count], axis=1))


def test_a_graph_is_built_without_a_search_per_node(monkeypatch):
    """A node's edges come from matrix products, start with its nearest node, and lead to every node."""
    def none(*args):
        raise AssertionError("a beam search in the build")

    units, p = sphere(3000), ann.GraphParams()
    monkeypatch.setattr(ann, "beam_search", none)
    edges, entries = ann.build_graph(units, p)
    sims = units @ units.T
    np.fill_diagonal(sims, -1)
    assert np.array_equal(edges[:, 0], sims.argmax(axis=1))
    tied = edges[:, :-p.loose]
    assert np.bincount(tied[tied >= 0], minlength=len(units)).min() > 0
    assert all(len(set(row[row >= 0])) == (row >= 0).sum() for row in tied)
    assert len(entries) in (p.entries, p.entries + 1)


def test_recall_over_full_shards():
    """Vectors without any structure, in shards of the full size, from outside the table."""
    p = ann.GraphParams()
    units, asked = sphere(4 * p.shard_rows), sphere(100, seed=4)
    found = [[] for _ in asked]
    for a in range(0, len(units), p.shard_rows):
        part = units[a:a + p.shard_rows]
        edges, entries = ann.build_graph(part, p)
        for mine, row in zip(found, ann.beam_search(part, edges, entries, asked, p.beam, p.width)):
            assert len(set(row)) == p.beam and row.min() >= 0
            assert (np.diff(part[row] @ asked[0]) <= 1e-6).all() or mine is not found[0]
            mine.extend((a + row).tolist())
    sims = asked @ units.T
    hits = sum(len({*sorted(mine, key=lambda j: -sims[i, j])[:5]} & {*np.argsort(-sims[i])[:5].tolist()})
               for i, mine in enumerate(found))
    assert hits >= 0.9 * 5 * len(asked)
