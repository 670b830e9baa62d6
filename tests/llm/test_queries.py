"""The registered queries against their SQL or a brute-force version."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sitemerge.llm import bpe, minhash, queries as q
from tests.conftest import SMALL

TABLES = ("documents", "embeddings", "pages", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def docs(duck):
    return duck.execute("SELECT doc_id, text, lang, source FROM documents").fetchall()


@pytest.mark.parametrize("name", sorted(q.llm_oracle()))
def test_sql(spark, duck, name):
    got = q.llm_queries()[name](spark, SMALL)
    want = duck.execute(q.llm_oracle()[name])
    cols = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(cols)
    assert Counter(map(tuple, got.select(cols).collect())) == Counter(want.fetchall())


def test_op3_equals_the_library(spark, docs):
    import hashlib

    import public_tokenizers
    import tiktoken

    ranks = bpe.read_ranks(public_tokenizers.path(q.TOKENIZER_FILE))
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in q.op3_bpe(spark, SMALL).collect()}
    for i, text, *_ in docs:
        ids = lib.encode_ordinary(text or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_op4_base_places(spark, docs):
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    got = {r["doc_id"]: r for r in q.op4_license_scan(spark, SMALL).collect()}
    assert len(got) == len(docs)
    for i, text, *_ in docs:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at = [(s, label) for p, label in phrases.items() for s in range(len(words))
              if words[s:s + len(p.split())] == p.split()]
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(words), len(at))
        assert r["first_word"] == (min(at)[0] if at else None)
        assert r["last_word"] == (max(at)[0] if at else None)
        assert r["base_labels"] == ",".join(sorted({x for _, x in at}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1


def test_op7_targets_and_limits(spark, docs):
    rows = q.op7_mixing(spark, SMALL).collect()
    assert len(rows) == len(docs)
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in docs}
    total = Counter()
    for i, _, _, s in docs:
        total[s] += size[i]
    left, weights = float(sum(total.values())), (5, 2, 1)
    weight = {s: weights[n % 3] for n, s in enumerate(sorted(total))}
    want, open_ = {}, set(total)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 3 * total[s]}
        want.update({s: 3.0 * total[s] for s in full} if full else share)
        left -= sum(want[s] for s in full)
        open_ = open_ - full if full else set()
    source = {i: s for i, _, _, s in docs}
    taken, longest = Counter(), Counter()
    for r in rows:
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], total[s])
        assert math.isclose(r["target"], want[s], rel_tol=1e-9)
        assert r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        taken[s] += r["taken"]
        longest[s] = max(longest[s], r["size"])
    for s in total:
        assert abs(taken[s] - want[s]) <= longest[s]
    again = q.op7_mixing(spark, SMALL).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))


def test_op8_pairs(spark, docs):
    idf = np.ones(1 << minhash.BUCKET_BITS, dtype=np.float32)
    known = minhash._WordHash()
    got = {r["doc_id"]: r["class_id"] for r in q.op8_minhash_dedup(spark, SMALL).collect()}
    assert len(got) == len(docs)
    vecs = {i: minhash.weighted_shingles(minhash.word_hashes(t, known), idf, 5) for i, t, *_ in docs}
    ids = sorted(vecs)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            s = minhash.weighted_jaccard(vecs[a], vecs[b])
            if s >= 0.86:  # plain Jaccard; idf weights move it a little
                assert got[a] == got[b]
    for c in set(got.values()):
        assert got[c] == c == min(i for i in got if got[i] == c)


def test_op9_held_out_accuracy(spark, docs):
    lang = {i: x for i, _, x, _ in docs}
    rows = [r for r in q.op9_language_id(spark, SMALL).collect()]
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(docs) and held
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_op10_recall(spark, duck):
    rows = duck.execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    got = {}
    for r in q.op10_nearest(spark, SMALL).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    hits = 0
    for i in np.flatnonzero(ids % 50 == 0):
        sims = u @ u[i]
        best = [n for n in sorted(range(len(ids)), key=lambda n: (-sims[n], ids[n])) if n != i][:5]
        hits += len({int(ids[n]) for n in best} & {v for v, _ in got[int(ids[i])]})
        for v, s in got[int(ids[i])]:
            assert math.isclose(s, float(sims[np.flatnonzero(ids == v)[0]]), abs_tol=1e-9)
    assert hits >= 0.9 * 5 * (ids % 50 == 0).sum()


def test_pipeline(spark, docs):
    import corpus_pipeline as c

    rows = c.run(spark, SMALL).collect()
    assert rows and all(r["round_trip"] for r in rows)
    times = Counter(r["doc_id"] for r in rows)
    assert set(times) <= {i for i, *_ in docs} and max(times.values()) <= 3
    kept = {r["doc_id"] for r in c.language_id(spark, spark.read.parquet(f"{SMALL}/documents.parquet"), SMALL)
            .select("doc_id").collect()}
    assert kept == {i for i, t, *_ in docs if re.search(r"[^\W\d_]", t or "")}


def test_pipeline_rejects_unlearned_languages(spark, docs):
    import corpus_pipeline as c

    strange = ["Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и "
               "совестью и должны поступать в отношении друг друга в духе братства.",
               "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。",
               "xqzv kjwq pzxk vvqj wkzx qqjx zkpw xvzq jkqw pvxz qkzj wxvq zzkq jpxw qvkz xwqj kzpv qxzw jvkq"]
    known = spark.read.parquet(f"{SMALL}/documents.parquet")
    for held in (None, "es"):
        # texts of the held-out language carry no label, so nothing is learned from them
        table = known.withColumn("lang", F.when(F.col("lang") != held, F.col("lang"))) if held else known
        extra = [(-1 - i, t) for i, t in enumerate(strange)]
        more = table.unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True)
        kept = {r[0] for r in c.language_id(spark, more, SMALL).select("doc_id").collect()}
        assert not kept & {i for i, _ in extra}
        clean = {i for i, t, lang, _ in docs if lang != held and re.search(r"[^\W\d_]", t or "")}
        assert clean <= kept
        if held:
            rest = {i for i, _, lang, _ in docs if lang == held}
            assert len(rest & kept) <= 0.1 * len(rest)
