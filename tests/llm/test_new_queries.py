"""op11 to op13: the registered queries against brute force, and their cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sitemerge.llm import periodic, queries as q, spelling
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()


def ascii_lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def near(a, b):
    """Exactly one edit, by trying them all."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(n, factor=5):
    """word -> (form, root, n, n_near, form_n) by comparing all pairs."""
    by_size = defaultdict(list)
    for w in n:
        by_size[len(w)].append(w)
    close = {w: [v for k in (-1, 0, 1) for v in by_size[len(w) + k] if near(w, v)] for w in n}
    form = {}
    for w, vs in close.items():
        if vs:
            best = min(vs, key=lambda v: (-n[v], v))
            if n[best] >= factor * n[w]:
                form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(close[w]), n[form[w]] if w in form else None)
    return out


def told(df):
    rows = df.collect()
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(got) == len(rows)
    return got


def test_op11_brute_force(spark, docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = ascii_lower(run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    got = told(q.op11_spelling_variants(spark, SMALL))
    assert got == variants(n) and any(f for f, *_ in got.values())


@pytest.mark.parametrize("hot", [0, 1, 3, 1000])
def test_variants_of_dense_words(spark, hot):
    """Few letters, equal neighbours, words of any length: all links, whatever is hot."""
    rng = np.random.default_rng(hot)
    words = {"".join(rng.choice(list("abé"), size=rng.integers(2, 9))) for _ in range(500)}
    words |= {"x" * k for k in range(2, 12)} | {"prefixprefix" + a + b for a in "abcdefgh" for b in "abcdefgh"}
    n = {w: int(rng.integers(1, 3000)) for w in words}
    df = spark.createDataFrame([(w, c) for w, c in n.items()], "word string, n long")
    pairs = [tuple(r) for r in spelling.near_pairs(df, hot=hot).collect()]
    want = {(min(a, b, key=lambda w: (len(w), w)), max(a, b, key=lambda w: (len(w), w)))
            for a in words for b in words if near(a, b)}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want
    assert told(spelling.group_variants(df)) == variants(n)


def test_spelling_cases(spark):
    rows = [(1, "Straße straße STRASSE x×y ÷", "z", 1), (2, None, None, 2), (None, "", "z", 3), (None, "Ünal ünal", "z", 4),
            (1, "ab" * 200_000, "z", 5), (1, "ab" * 200_000, "z", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, run string, n int")
    runs = spelling.runs_of_letters(df)
    assert Counter(r["run"] for r in runs.collect()) == Counter(
        ["straße", "straße", "strasse", "x×y", "÷", "Ünal", "ünal", "ab" * 200_000, "ab" * 200_000])
    words = spelling.frequent_words(runs, F.col("run"), min_length=4, min_count=1)
    got = told(spelling.group_variants(words, factor=2))
    assert got["Ünal"] == (None, "Ünal", 1, 1, None) and got["straße"] == (None, "straße", 2, 0, None)
    assert got["ab" * 200_000][2] == 2
    empty = spelling.runs_of_letters(df.limit(0))
    assert spelling.group_variants(spelling.frequent_words(empty, F.col("run"))).count() == 0
    # ties of n go to the smaller word; a chain of forms ends at the last
    n = {"aaaaaa": 5, "aaaaab": 25, "aaaaac": 25, "aaaabb": 125}
    df = spark.createDataFrame([(w, c, "x") for w, c in n.items()], "word string, n long, form string")
    got = told(spelling.group_variants(df))
    assert got == variants(n) and got["aaaaaa"][:2] == ("aaaaab", "aaaabb")


def brute_runs(w, least=24, times=3):
    out = []
    for p in range(1, len(w) // times + 1):
        i = 0
        while i + p < len(w):
            s = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            if i - s + p >= max(least, times * p) and not any(
                    all(w[x] == w[x + d] for x in range(s, i + p - d)) for d in range(1, p)):
                out.append((s, i - s + p, p))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(w, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_op13_brute_force(spark, tmp_path):
    """All short documents of the table, and long ones cut to what brute force can do."""
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    rows = [(i, t) for i, t in rows if len((t or "").split()) < 1500]
    rng = np.random.default_rng(5)
    for i in range(300):
        w = []
        while len(w) < 120:
            w += list(rng.choice(["a", "b", "ç"], size=rng.integers(1, 9))) * int(rng.integers(1, 12))
        rows.append((1_000_000 + i, "\x0b\t ".join(w) + "\n"))
    rows += [(2_000_000, None), (2_000_001, ""), (2_000_002, " \n"), (2_000_003, "\x85 \x1c " * 30), (None, "x " * 30)]
    rows += [(-i, "one two three four five six seven eight nine ten eleven twelve") for i in range(1, 40)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in q.op13_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    looped = 0
    for i, text in rows:
        w = [x.decode() for x in (text or "").encode().split()]
        h = zlib.crc32(("" if i is None else str(i)).encode())
        g = h // 10
        if h % 10 == 0 and w:
            looped += 1
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
        runs = brute_runs(w)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        assert tuple(got[i]) == (
            i, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapse(w, runs).encode()).hexdigest()), i
    assert looped > 20


def test_op13_whole_table(spark, docs):
    got = q.op13_periodic_runs(spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in docs)
    assert any(r["n_runs"] for r in got)
    for r in got:
        if r["n_runs"]:
            assert r["length"] >= max(24, 3 * r["period"]) and r["exponent_milli"] == 1000 * r["length"] // r["period"]


def test_periodic_cases(spark):
    long = " ".join(f"w{i % 70000}" for i in range(210_000))
    rows = [(1, "a " * 30, "kept", 7), (1, "a " * 30, "kept", 7), (2, None, "kept", 7), (None, "", "kept", 7), (3, long, "kept", 7)]
    df = spark.createDataFrame(rows, "id long, text string, collapsed string, start int")
    got = periodic.find_runs(df)
    assert got.columns == ["id", "text", "start", "runs", "collapsed"]
    seen = Counter((r["id"], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in got.collect())
    assert seen == Counter({(1, ((0, 30, 1),), "a"): 2, (2, (), ""): 1, (None, (), ""): 1,
                            (3, ((0, 210_000, 70_000),), " ".join(f"w{i}" for i in range(70_000))): 1})
    assert periodic.find_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.runs_of(np.zeros(3), min_times=2)
    with pytest.raises(ValueError):
        periodic.find_runs(df, text_col="collapsed")
