"""Nulls, empty texts and tables, ties, repeats, clashing columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitemerge.llm import ann, bpe, chat, langid, licenses, lines, minhash, mixing, pivots, urls

DOCS = "doc_id long, text string, source string, lang string, n_lines int, keep int, score int, ids int, hash long"


def frame(spark, rows):
    """Documents with other columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, 1, 1, 1, 1, 1) for r in rows], DOCS)


SAME = "one two three four five six seven eight nine ten"
ROWS = [(1, SAME, "a", "en"), (1, SAME, "a", "en"), (2, SAME, None, None), (3, None, "b", None), (4, "", "b", "fr"),
        (None, SAME, "a", "en"), (5, "  12 !? ", "b", "fr"), (6, "x " * 30000, "a", "en")]
VECTORS = "vec_id long, embedding array<float>, label int, n long, dim int, shard int"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 0, 0, 0) for r in rows], VECTORS)


V = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.1], 1), (3, [0.0, 1.0], 1), (4, [1.0, 0.0], 2),
     (5, [1.0, 0.0], None), (6, None, 1), (7, [0.0, 0.0], 1), (8, [float("nan"), 1.0], 1), (9, [1.0, None], 1),
     (10, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (3, [0.0, 1.0], 1)]


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\", "\\\\</s>", "<\\/s>", "[", "<</s>", "[[INST]INST]", "", None, "a\nb"]
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(nasty)]
    rows += [(None, 0, None, "x"), (2, None, "assistant", "first"), (2, None, "assistant", "first"), (3, 0, "[INST]", "r")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    got = {r["conv_id"]: r for r in chat.format_chats(df).withColumn(
        "back", chat.read_back(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("segments"))).collect()}
    assert [t["text"] for t in got[1]["back"]] == [t or "" for t in nasty]
    assert got[1]["loss"] == "".join(t or "" for t in nasty[1::2])
    assert got[1]["complete"] and not got[2]["complete"] and got[2]["first_violation"] == 0
    assert got[None]["back"][0]["role"] == "" and got[3]["back"][0]["role"] == "[INST]"
    assert chat.format_chats(df.limit(0)).count() == 0


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("min_docs", [2, 3])
def test_lines_against_brute_force(spark, keep_first, min_docs):
    rng = np.random.default_rng(min_docs)
    pool = ["hot", " HOT\t", "cold", "", "Ä", "ä", *map(str, range(12))]
    texts = [(i, "\n".join(rng.choice(pool, size=rng.integers(1, 9)))) for i in range(60)]
    texts += [(60, None), (61, ""), (None, "hot\nonly")]
    df = frame(spark, [(i, t, "s", "en") for i, t in texts])
    found, first = {}, {}
    for i, t in sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0)):
        for n, line in enumerate((t or "").encode().split(b"\n")):
            found.setdefault(lines.line_key(line), set()).add(i)
            first.setdefault(lines.line_key(line), (i, n))
    gone = {k for k, ids in found.items() if k and len(ids) >= min_docs}
    want = {i: "\n".join(x for n, x in enumerate((t or "").split("\n"))
                         if lines.line_key(x.encode()) not in gone
                         or keep_first and first[lines.line_key(x.encode())] == (i, n)) for i, t in texts}
    kept = lines.apply_bitmaps(df, lines.keep_bitmaps(df, min_docs=min_docs, keep_first=keep_first))
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == want
    assert kept.count() == len(texts)


def test_perfect_hash_and_merges():
    keys = [bytes([b]) for b in range(256)] + [b"ab", b"abc", b"bc", b"aa", b"aaaa"]
    table = bpe.PerfectHash(keys)
    assert sorted(table.find(keys).tolist()) == list(range(len(keys)))
    assert table.find([b"zz", b""]).tolist() == [-1, -1]
    ranks = {k: i for i, k in enumerate(keys)}

    def plain(piece):
        parts = [bytes([b]) for b in piece]
        while True:
            near = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not near:
                return [ranks[p] for p in parts]
            _, i = min(near)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    rng = np.random.default_rng(0)
    for _ in range(300):
        piece = bytes(rng.choice(list(b"abc"), size=rng.integers(1, 12)).tolist())
        assert bpe.merge_bytes(piece, ranks) == plain(piece)


def test_bpe_cases(spark):
    v = bpe.Vocabulary({bytes([b]): b for b in range(256)}, r" ?\w+|\s+|[^\s\w]+")
    df = frame(spark, ROWS)
    got = bpe.decode(bpe.encode(df, v), v).collect()
    assert len(got) == len(ROWS)
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in got)
    odd = spark.createDataFrame([(None,), ([65, None, 999, -1],)], "ids array<int>")
    assert [bytes(r["decoded"]).decode() for r in bpe.decode(odd, v).collect()] == ["", "A���"]
    assert bpe.encode(df.limit(0), v).count() == 0
    once = bpe.round_trip(df, v)
    assert once.columns == [*(c for c in df.columns if c != "ids"), "ids", "decoded"]
    assert once.collect() == bpe.decode(bpe.encode(df, v), v).collect()
    assert bpe.round_trip(df.limit(0), v).count() == 0


def test_licenses(spark):
    rows = [(1, "CC BY cc by", "a", "en"), (2, None, "a", "en"), (2, None, "a", "en"), (None, "by", "a", "en"),
            (3, "All rights, reserved. Released under the MIT license", "a", "en"),
            (4, "Permission is hereby granted free of charge to every person obtaining a copy of this software "
                "and the associated documentation files", "a", "en")]
    got = licenses.scan_licenses(frame(spark, rows)).collect()
    by = {(r["doc_id"], r["n_words"]): r for r in got}
    assert len(got) == len(rows)
    assert (by[1, 4]["n_base"], by[1, 4]["first_word"], by[1, 4]["last_word"]) == (2, 0, 2)
    assert by[2, 0]["labels"] == "" and by[2, 0]["score"] == 0 and by[2, 0]["first_word"] is None
    assert by[3, 8]["base_labels"] == "reserved" and by[3, 8]["labels"] == "mit,reserved"
    assert by[4, 21]["base_labels"] == "" and by[4, 21]["labels"] == "mit" and 0.8 <= by[4, 21]["score"] < 1
    assert licenses.scan_licenses(frame(spark, rows).limit(0)).count() == 0


def test_urls(spark):
    rules = [urls.Rule("block", "net/"), urls.Rule("allow", "example.net/en/")]
    good, bad = "http://good.org/a", "http://x.bad.org/b"
    pages = [(i, good) for i in range(20)] + [(i, bad) for i in range(20, 40)]
    pages += [(40, None), (41, "no scheme"), (42, "http://A.Example.NET/en/x?q"), (43, "http://example.net/de/"),
              (44, "http://example.net"), (45, "http://notexample.org/://x"), (39, bad)]
    df = spark.createDataFrame([(*p, "h", "r") for p in pages], "page_id long, url string, host string, rate string")
    known = spark.createDataFrame([(i, int(i >= 20)) for i in range(40)] + [(0, 0), (None, 1), (1, None), (999, 1)],
                                  "page_id long, bad int")
    got = {r["page_id"]: r for r in urls.filter_urls(df, known, rules).collect()}
    assert got[0]["verdict"] == "allow" and got[20]["verdict"] == "block"
    assert (got[40]["host"], got[40]["path"], got[41]["host"]) == ("", "", "")
    assert (got[42]["host"], got[42]["rule"], got[42]["verdict"]) == ("a.example.net", "example.net/en/", "allow")
    assert got[43]["rule"] == "net/" and got[44]["rule"] is None and got[45]["host"] == "notexample.org"
    assert urls.filter_urls(df, known, rules).count() == len(pages)
    none = urls.filter_urls(df, known.limit(0), rules).collect()
    assert {r["verdict"] for r in none if r["rule"] is None} == {"allow"}
    assert urls.filter_urls(df.limit(0), known, rules).count() == 0


def test_vector_cases(spark):
    got = [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in pivots.near_duplicates(vectors(spark, V)).collect()]
    assert len(got) == len(V)
    by = {g[0]: g[1:] for g in got}
    assert by[0] == (2, 0, True) and by[1] == by[2] == (2, 0, False)
    for alone in (3, 4, 5, 6, 7, 8, 9, 10):
        assert by[alone] == (0, alone, True)
    assert by[None] == (0, None, True)
    assert pivots.near_duplicates(vectors(spark, V).limit(0)).count() == 0


@pytest.mark.parametrize("block_rows", [16, 1024])
def test_vector_links_against_brute_force(spark, block_rows):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 16))
    x = np.vstack([base, base[:25] + 0.08 * rng.normal(size=(25, 16)), base[3] + 0.05 * rng.normal(size=(60, 16)), base[:5]])
    x = x.astype(np.float32)
    label = np.arange(len(x)) % 2
    rows = [(i, v.tolist(), int(n)) for i, (v, n) in enumerate(zip(x, label))]
    got = {r["vec_id"]: r for r in pivots.near_duplicates(
        vectors(spark, rows), params=pivots.PivotParams(block_rows=block_rows)).collect()}
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1)[:, None]
    a = (u @ u.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(a, False)
    low = np.arange(len(x))
    for _ in range(len(x)):
        low = np.minimum(low, np.where(a, low[None, :], len(x)).min(axis=1))
    assert [got[i]["n_links"] for i in range(len(x))] == a.sum(axis=1).tolist()
    assert [got[i]["component_id"] for i in range(len(x))] == low.tolist()


def test_nearest_cases(spark):
    df = vectors(spark, V)
    got = ann.nearest(df, df.where("vec_id in (0, 6, 7, 10)"), k=3).orderBy("query_id", "rank").collect()
    # equal vectors tie: the smaller id first; other lengths and unusable vectors never meet
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 1), (0, 2, 4), (0, 3, 5)]
    assert got[0]["score"] == got[1]["score"] == 1.0
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


def test_nearest_blocks_of_any_size_agree(spark):
    """Queries in one block, in several and searched a few at a time get the same answers."""
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rng.normal(size=(300, 8)).tolist())],
                               "vec_id long, embedding array<double>")
    asked = df.where("vec_id % 10 = 0")
    got = [ann.nearest(df, asked, k=3, params=ann.GraphParams(shard_rows=100, query_rows=rows, query_values=values))
           .orderBy("query_id", "rank").collect() for rows, values in ((512, 1 << 21), (7, 1 << 21), (7, 1))]
    assert len(got[0]) == 90 and got[0] == got[1] == got[2]


def test_nearest_among_tight_copies(spark):
    rng = np.random.default_rng(5)
    seed = rng.normal(size=16)
    tight = [seed * 2.0 ** (i % 7) * (1 + 1e-5 * rng.normal(size=16)) for i in range(30)]
    x = np.array([*rng.normal(size=(150, 16)), *tight])
    got = {}
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    for r in ann.nearest(df, df.where("vec_id between 170 and 179"), k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    for i in range(170, 180):
        sims = ann.cosines(x, x[i])
        assert got[i] == [j for j in sorted(range(len(x)), key=lambda j: (-sims[j], j)) if j != i][:5]


def test_mix_cases(spark):
    df = frame(spark, ROWS)
    rows = mixing.mix_plan(df).collect()
    assert len(rows) == len(ROWS)
    assert all(len(r["draws"]) <= 3 for r in rows)
    assert {r["size"] for r in rows if r["doc_id"] in (3, 4)} == {0}
    mix = mixing.Mix(blocks=64, shards=4)
    made = mixing.mix_rows(df, mix)
    assert made.count() == sum(len(r["draws"]) for r in mixing.mix_plan(df, mix).collect())
    assert made.drop("_shard", "_epoch").columns == df.columns
    assert mixing.mix_rows(df.limit(0)).count() == mixing.mix_plan(df.limit(0)).count() == 0


def test_splitting_tree():
    quotas = np.array([100, 7, 0, 33])
    out = mixing.split_quotas(quotas, 5, seed=3)
    assert (out.sum(axis=0) == quotas).all() and out.sum(axis=1).max() - out.sum(axis=1).min() <= 1
    assert (out == mixing.split_quotas(quotas, 5, seed=3)).all()


def test_language_cases(spark):
    rows = ROWS + [(10 + i, t, "s", x) for i, (t, x) in enumerate(
        [("the house and the garden of the town", "en"), ("der Garten und das Haus in der Stadt", "de"),
         ("le jardin et la maison de la ville", "fr"), ("y la casa con el jardín de los niños", "xx")] * 3)]
    df = frame(spark, rows)
    model = langid.train(df)
    got = langid.predict(df, model).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert by[3] == by[4] == by[5] == ("und", 0.0)
    assert [by[i][0] for i in (10, 11, 12, 13)] == ["en", "de", "fr", "xx"]
    many = [(i, f"word{i % 120} letters of their own {i}", "s", f"x-tag{i % 120}") for i in range(400)]
    model = langid.train(frame(spark, many))
    assert sum(map(len, model.members)) == langid.MOST_LABELS
    none = langid.predict(df, langid.train(df.withColumn("lang", F.lit(None).cast("string")))).collect()
    assert {r["lang_pred"] for r in none} == {"und"}
    assert langid.predict(df.limit(0), model).count() == 0


def test_language_sample_reaches_the_driver_compressed():
    import pyarrow as pa

    texts = ["the quick brown fox jumps over the lazy dog " * 20, "x", "el perro corre por la calle " * 30]
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "en", "es"], "text": texts})
    out = pa.Table.from_batches(langid._sampled([batch], True))
    for name, made in (("x", texts), ("own", [langid.letters(t) for t in texts])):
        rows = out[name].to_pylist()
        assert max(map(len, rows)) < langid.DIM  # a quarter of the plain numbers
        assert (langid.unpacked(rows) == np.stack([langid.features(t) for t in made]).astype(np.float32)).all()


def test_minhash_cases(spark):
    near = SAME.replace("ten", "ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen")
    long = " ".join(f"w{i}" for i in range(60))
    rows = ROWS + [(20, long, "s", "en"), (21, long + " end", "s", "en"), (22, near, "s", "en"), (23, "Hi!", "s", "en"),
                   (24, "hi", "s", "en")]
    got = minhash.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: (r["class_id"], r["kept"]) for r in got}
    assert by[1] == (1, True) and by[2] == (1, False) and by[3] == (3, True) and by[4] == (4, True)
    assert by[20] == (20, True) and by[21] == (20, False) and by[22] == (22, True)
    assert by[23] == (23, True) and by[24] == (23, False) and by[None] == (None, True)
    assert minhash.near_duplicates(frame(spark, rows).limit(0)).count() == 0


def test_tile_equals_pairs():
    rng = np.random.default_rng(0)
    p, idf = minhash.MinHashParams(), (1 + rng.random(1 << minhash.BUCKET_BITS)).astype(np.float32)
    known = minhash._WordHash()
    base = rng.integers(0, 50, size=120)
    texts = []
    for _ in range(40):
        t = base.copy()
        at = rng.integers(0, len(t), size=rng.integers(0, 6))
        t[at] = rng.integers(50, 99, size=len(at))
        texts.append(" ".join(f"w{i}" for i in t))
    parts = [minhash.counted_shingles(minhash.word_hashes(t, known), idf, 5) for t in texts]
    sums = np.array([(c * w).sum() for _, c, w in parts])
    shared = minhash._shares(parts, np.arange(40), np.arange(40))
    for i in range(40):
        for j in range(i):
            a, b = (minhash.weighted_shingles(minhash.word_hashes(texts[n], known), idf, p.shingle) for n in (i, j))
            assert abs(shared[i, j] / (sums[i] + sums[j] - shared[i, j]) - minhash.weighted_jaccard(a, b)) < 1e-5


def test_reputation_blocks_planted_hosts(spark):
    """Hosts far worse than the rest go, at a low and a high base rate; noise stays."""
    for base in (0.05, 0.4):
        rng = np.random.default_rng(int(base * 100))
        rate = {f"h{i}.site{i % 7}.com": base for i in range(60)} | {"bad.site1.com": 0.95, "worse.evil.org": 0.9}
        pages = [(n, f"http://{h}/{n}") for n, h in enumerate(h for h in rate for _ in range(60))]
        known = [(n, int(rng.random() < rate[u.split("/")[2]])) for n, u in pages if rng.random() < 0.7]
        df = spark.createDataFrame(pages, "page_id long, url string")
        got = urls.filter_urls(df, spark.createDataFrame(known, "page_id long, bad int"), []).collect()
        assert {r["host"] for r in got if r["verdict"] == "block"} == {"bad.site1.com", "worse.evil.org"}


def test_keep_bitmaps_of_null_texts(spark):
    df = frame(spark, [(i, None, "s", "en") for i in range(3)] + [(3, "a\n\nb", "s", "en")])
    for least in (0, 1):
        kept = lines.apply_bitmaps(df, lines.keep_bitmaps(df, min_docs=3, min_chars=least))
        got = {r["doc_id"]: (r["text"], r["_n_lines"], r["_n_dropped"]) for r in kept.collect()}
        # the empty line of the null texts, found in four documents, counts if empty keys do
        assert got == ({0: ("", 1, 1), 1: ("", 1, 1), 2: ("", 1, 1), 3: ("a\nb", 3, 1)} if not least else
                       {0: ("", 1, 0), 1: ("", 1, 0), 2: ("", 1, 0), 3: ("a\n\nb", 3, 0)})
