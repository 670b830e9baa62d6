"""Spelling variant grouping with asymmetric q-chunks.

Two words are near if one inserted, deleted or replaced code point makes one the
other.  Let s be the shorter of them (either, if as long) with L code points and
q = L // 2.  s contributes two disjoint chunks of q code points, its first and
its last; the other word t contributes its positional grams of q code points
for every length s may have (its own and one less).  The edit leaves one chunk
whole, so it is a gram of t at the chunk's place or one further.  The join is on
(L, gram, place), the candidates are verified by edit distance.

A gram with many words would pair them all.  Grams held by more than ``HOT``
words are therefore not joined; their words go a second, exact way: with the
first chunk kept at its place (or the last chunk kept at the end), the edit lies
in the rest of the word, and words that share chunk and rest but for one code point
meet on (chunk, place, rest without it).  Such a group holds at most one word per
letter and place, and every pair of it is near.  The other places of a hot gram need
nothing: an insertion before the first chunk leaves the last one at the end.
So each word pairs with at most ``HOT`` candidates a gram and otherwise only
with words that are near.

Defined results: null texts have no words; an empty table, or one without
frequent words, gives an empty table; repeated rows count as often as they are
there; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

LETTERS = "A-Za-z\\u00C0-\\u00FF"
AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HOT = 64  # words of a gram beyond which they are grouped by the rest of the word


def runs_of_letters(docs: DataFrame, text_col: str = "text", least: int = 1) -> DataFrame:
    """(columns of docs but the text, ``run``): each maximal run of letters of at
    least ``least`` code points, A-Z lower-cased, as often as it occurs."""
    found = F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    rest = [c for c in docs.columns if c not in (text_col, "run")]
    return docs.select(*rest, F.explode(found).alias("run")).withColumn(
        "run", F.translate("run", AZ, AZ.lower()))


def frequent_words(words: DataFrame, word: Column, min_length: int = 6, min_count: int = 5) -> DataFrame:
    """(word, n) of the words of enough code points that occur often enough."""
    return (words.select(word.alias("word")).where(F.length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def _chunks(words: DataFrame) -> DataFrame:
    """s: its first and last q code points, at their place and one further."""
    return words.select(F.col("word").alias("s"), F.col("size").alias("of"), F.explode(F.expr("""array(
        struct(true as first, 0 as shift), struct(true as first, 1 as shift),
        struct(false as first, 0 as shift), struct(false as first, 1 as shift))""")).alias("k")).select(
        "s", "of", "k.first", "k.shift",
        F.expr("if(k.first, k.shift, of - of div 2 + k.shift)").cast("int").alias("place"),
        F.expr("if(k.first, substring(s, 1, of div 2), substring(s, of - of div 2 + 1, of))").alias("gram"))


def _grams(words: DataFrame) -> DataFrame:
    """t: the positional grams for an s as long as t or one shorter.  Those further
    than one from a chunk's place would join nothing and are not made."""
    of = words.select("word", "size", F.explode(F.array(F.col("size"), F.col("size") - 1)).alias("of"))
    places = F.expr("""filter(array_distinct(transform(array(0, 1, of - of div 2, of - of div 2 + 1), p -> cast(p as int))),
        p -> p <= size - of div 2)""")
    return (of.where("of >= 2").select("word", "size", "of", F.explode(places).alias("place"))
            .select(F.col("word").alias("t"), F.col("size").alias("t_size"), "of", "place",
                    F.expr("substring(word, place + 1, of div 2)").alias("gram")))


def _less(rest: str) -> Column:
    """Hash of the rest without code point i (the pair is verified in the end)."""
    return F.expr(f"xxhash64(concat(substring({rest}, 1, i - 1), substring({rest}, i + 1, length({rest}))))").alias("less")


def _hot_links(chunks: DataFrame, grams: DataFrame, hot: DataFrame) -> DataFrame:
    """Near pairs that share, in a hot gram, the first chunk at its place or the last
    one at the end of both words."""
    key = ["of", "gram", "place"]
    same = [*key, "first"]
    s = chunks.join(hot, key).where("not first or shift = 0").withColumn(
        "rest", F.expr("if(first, substring(s, of div 2 + 1, of), substring(s, 1, of - of div 2))"))
    t = grams.join(hot, key).select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("first")).where(
        "place = if(first, 0, t_size - of div 2)").withColumn(
        "rest", F.expr("if(first, substring(t, of div 2 + 1, t_size), substring(t, 1, place))"))
    # one code point more in t: left out, it leaves s; of equal neighbours the first
    more = t.where("t_size = of + 1").select("*", F.explode(F.expr("""filter(sequence(1, length(rest)),
        i -> i = 1 or substring(rest, i, 1) != substring(rest, i - 1, 1))""")).alias("i"))
    inserted = s.where("first or shift = 1").withColumn("less", F.xxhash64("rest")).join(
        more.select("t", *same, _less("rest")), [*same, "less"]).select("s", "t")
    # another code point at the same place
    place = F.explode(F.expr("sequence(1, length(rest))")).alias("i")
    a = s.where("shift = 0").select("*", place).select("s", *same, "i", _less("rest"))
    b = t.where("t_size = of").select("*", place).select("t", *same, "i", _less("rest"))
    replaced = a.join(b, [*same, "i", "less"]).where("s < t").select("s", "t")
    return inserted.unionByName(replaced)


def near_pairs(words: DataFrame, hot: int = HOT) -> DataFrame:
    """Distinct pairs (s, t) of near words of the distinct column ``word``; s is the
    shorter or, of two as long, the smaller in code-point order.

    Words need two code points at least (shorter ones have no chunks)."""
    sized = words.select("word", F.length("word").alias("size")).where("size >= 2")
    chunks, grams = _chunks(sized), _grams(sized)
    key = ["of", "gram", "place"]
    many = cut(grams.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select(*key), "hot-grams")
    met = chunks.join(many, key, "left_anti").join(grams.join(many, key, "left_anti"), key)
    met = met.where("t_size > of or s < t").select("s", "t").unionByName(_hot_links(chunks, grams, many))
    return met.where(F.levenshtein("s", "t", 1) == 1).distinct()


def group_variants(words: DataFrame, factor: int = 5) -> DataFrame:
    """(word, n) and its ``form``, ``root``, ``n_near`` and ``form_n``.

    A word's form is its near word of largest n (ties: the smallest in code-point
    order) if that n is at least ``factor`` times the word's own; ``root`` follows
    forms to the last.  n grows by the factor with every step, so chains are short
    and end."""
    words = cut(words.select("word", "n"), "words")
    pairs = cut(near_pairs(words), "near-words")
    both = pairs.select(F.col("s").alias("word"), F.col("t").alias("other")).unionByName(
        pairs.select(F.col("t").alias("word"), F.col("s").alias("other")))
    known = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = both.join(known, "other").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("other_n"), F.col("other"))).alias("b"))
    large = -F.col("b.col1") >= F.col("n") * factor
    told = cut(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(large, F.col("b.other")).alias("form"), F.when(large, -F.col("b.col1")).alias("form_n")), "forms")
    return told.join(_roots(told.where("form is not null").select("word", "form")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): every round joins the table with itself, which doubles the
    steps followed."""
    at = forms.withColumnRenamed("form", "root")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = cut(at.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        at = step.drop("moved")
        if step.where("moved").isEmpty():
            return at
