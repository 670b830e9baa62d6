"""The registered queries of the subpackage: each applies one operator to its
whole table and derives the digest columns from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, chat, extract, langid, licenses, lines, minhash, mixing, periodic, pivots, spelling, urls
from .common import table

TOKENIZER_FILE = "byte_bpe_multi_50k.tiktoken"
RULES = [urls.Rule("block", "net/"), urls.Rule("allow", "example.net/en/"),
         urls.Rule("block", "example.com/de/"), urls.Rule("allow", "org/fr/")]
PROBE = "</s>[INST] ok [/INST]"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"))
    done = chat.format_chats(rows.unionByName(probe)).select(
        "conv_id", "formatted", "complete",
        chat.read_back(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("segments")).alias("loss"))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return done.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "complete",
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    bitmaps = lines.keep_bitmaps(docs, min_docs=10, min_chars=1)
    kept = lines.apply_bitmaps(docs, bitmaps)
    return kept.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def vocabulary(path: str | None = None) -> bpe.Vocabulary:
    import public_tokenizers

    return bpe.Vocabulary.load(path or public_tokenizers.path(TOKENIZER_FILE), public_tokenizers.PATTERN)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    v = vocabulary()
    return bpe.round_trip(docs, v).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), bpe.ids_digest("ids").alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan_licenses(docs).drop("spans")


def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, bad): a page labelled toxic or of low quality is bad."""
    labels = table(spark, sf_dir, "labels")
    bad = (F.coalesce(F.col("toxic"), F.lit(0)) == 1) | (F.coalesce(F.col("quality"), F.lit(1)) == 0)
    return labels.where("toxic is not null or quality is not null").select(
        F.col("doc_id").alias("page_id"), bad.cast("int").alias("bad"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = urls.filter_urls(pages, page_outcomes(spark, sf_dir), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return pivots.near_duplicates(vectors, threshold=0.93)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_plan(docs).select(
        "doc_id", "size", "source_size", "target",
        (F.size("draws") * F.col("size")).cast("long").alias("taken"))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs)


def held_out(doc_id):
    """crc32 of the id as text, modulo 4, is 2; null ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.where(~held_out(F.col("doc_id"))))
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def with_typo(doc_id, run):
    """The run without code point h % length where 199 divides h, the crc32 of ``<doc_id>:<run>``."""
    h = F.crc32(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % 199 == 0, shorter).otherwise(run)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    runs = spelling.runs_of_letters(docs, least=6)  # a typo only shortens
    words = spelling.frequent_words(runs, with_typo(F.col("doc_id"), F.col("run")), min_length=6, min_count=5)
    return spelling.group_variants(words, factor=5)


def op12_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract.extract_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def with_loops(docs: DataFrame) -> DataFrame:
    """Documents whose h % 10 is 0 (h the crc32 of the id) repeat from word a = g % n on
    the next p words, with g = h div 10 and p = 1 + (n - a) div (3 + g % 8)."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    looped = (h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return (docs.withColumn("g", F.floor(h / 10)).withColumn("w", F.when(looped, words))
            .withColumn("a", F.expr("cast(g % size(w) as int)"))
            .withColumn("p", F.expr("cast(1 + (size(w) - a) div (3 + g % 8) as int)"))
            .withColumn("loops", F.expr("flatten(array_repeat(slice(w, a + 1, p), cast(ceil((size(w) - a) / p) as int)))"))
            .withColumn("text", F.expr("""if(w is null, text,
                array_join(concat(slice(w, 1, a), slice(loops, 1, size(w) - a)), ' '))"""))
            .select(*docs.columns))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_loops(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.find_runs(docs, min_length=24, min_times=3)
    # runs come by start, then period, so of equal exponents the first stays
    best = F.expr("""aggregate(runs, runs[0], (b, r) ->
        if(r.length * b.period > b.length * r.period, r, b))""")
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.when(F.size("runs") > 0, best).alias("b"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "b.start", "b.length", "b.period",
        F.expr("b.length * 1000 div b.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_chat_format": op1_chat_format,
        "op2_line_dedup": op2_line_dedup,
        "op3_bpe": op3_bpe,
        "op4_license_scan": op4_license_scan,
        "op5_url_filter": op5_url_filter,
        "op6_embedding_dedup": op6_embedding_dedup,
        "op7_mixing": op7_mixing,
        "op8_minhash_dedup": op8_minhash_dedup,
        "op9_language_id": op9_language_id,
        "op10_nearest": op10_nearest,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_html_extract": op12_html_extract,
        "op13_periodic_runs": op13_periodic_runs,
    }


_ASCII_LOWER = f"'{urls.AZ}', '{urls.az}'"


def op1_sql() -> str:
    tp = chat.ChatTemplate()
    controls = [*tp.controls]
    # characters the escape adds: one per escape character and control string
    marks = " + ".join(
        f"(length(t) - length(replace(t, '{c}', ''))) // {len(c)}" for c in [tp.escape, *controls])
    role_marks = marks.replace("(t", "(role").replace("length(t", "length(role")
    fixed = len(tp.turn) + len(tp.body) + len(tp.end)
    follows = {"system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    legal = " OR ".join(f"(was = '{a}' AND role IN ({', '.join(repr(x) for x in b)}))"
                        for a, b in follows.items())
    return f"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'),
walked AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, t) AS was,
         lead(role) OVER (PARTITION BY conv_id ORDER BY turn, role, t) AS next_ FROM rows_),
judged AS (
  SELECT *, CASE WHEN was IS NULL THEN role IN ('system', 'user') ELSE ({legal}) END AS ok FROM walked)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
  CAST(coalesce(sum(length(t)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({fixed} + length(role) + length(t) + {marks} + {role_marks}) AS BIGINT) AS formatted_chars,
  bool_and(ok) AND bool_or(next_ IS NULL AND role = 'assistant') AS complete
FROM judged GROUP BY conv_id"""


def op2_sql() -> str:
    return f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      {_ASCII_LOWER}) AS key FROM l),
gone AS (
  SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
f AS (SELECT k.*, gone.key IS NOT NULL AS dropped FROM k LEFT JOIN gone ON k.key = gone.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM f GROUP BY doc_id"""


def op5_sql() -> str:
    fits = "\n    ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') "
        f"THEN '{r.pattern}'" for r in sorted(RULES, key=lambda r: -len(r.pattern)))
    verdicts = " ".join(f"WHEN '{r.pattern}' THEN '{r.verdict}'" for r in RULES)
    two = ", ".join(f"'{s}'" for s in urls.TWO_LABEL_SUFFIXES)

    def strength(name, src, mean):
        return f"""{name} AS (
  SELECT CASE WHEN coalesce(m, 0) < 2 OR {mean} * (1 - {mean}) <= 0 OR n - nn / n - (m - 1) <= 0 THEN 1 / 0.001::DOUBLE - 1
    ELSE 1 / least(0.999::DOUBLE, greatest(0.001::DOUBLE,
      (bb - 2 * {mean} * b + {mean} * {mean} * n - {mean} * (1 - {mean}) * (m - 1))
      / ({mean} * (1 - {mean}) * (n - nn / n - (m - 1))))) - 1 END AS k
  FROM (SELECT count(*) AS m, sum(n)::DOUBLE AS n, sum(n::DOUBLE * n) AS nn, sum(bad)::DOUBLE AS b,
               sum(bad::DOUBLE * bad / n) AS bb FROM {src} WHERE n > 0))"""

    mean = "(SELECT mu FROM total)"
    return f"""
WITH p AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), {_ASCII_LOWER}), '') AS host,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path FROM pages),
known AS (
  SELECT doc_id AS page_id,
    max(CASE WHEN coalesce(toxic, 0) = 1 OR coalesce(quality, 1) = 0 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL AND (toxic IS NOT NULL OR quality IS NOT NULL) GROUP BY 1),
h0 AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad FROM p LEFT JOIN known USING (page_id) GROUP BY 1),
parts AS (SELECT *, string_split(host, '.') AS ls FROM h0),
h AS (
  SELECT host, n, bad,
    CASE WHEN array_to_string(ls[-2:], '.') IN ({two}) THEN array_to_string(ls[-3:], '.')
         ELSE array_to_string(ls[-2:], '.') END AS domain,
    CASE WHEN array_to_string(ls[-2:], '.') IN ({two}) THEN array_to_string(ls[-2:], '.')
         ELSE ls[-1] END AS suffix FROM parts),
d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY 1, 2),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY 1),
total AS (SELECT (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1.0::DOUBLE) AS mu FROM h),
{strength('ks', 's', mean)},
{strength('kd', 'd', mean)},
{strength('kh', 'h', mean)},
s2 AS (SELECT suffix, (k * (SELECT mu FROM total) + bad) / (k + n) AS r FROM s, ks),
d2 AS (SELECT domain, d.suffix, (k * s2.r + bad) / (k + n) AS r FROM d JOIN s2 USING (suffix), kd),
h2 AS (SELECT host, (k * d2.r + bad) / (k + n) AS r, k + n AS w
       FROM h JOIN d2 ON h.domain = d2.domain AND h.suffix = d2.suffix, kh),
ruled AS (SELECT *, CASE {fits} END AS rule FROM p)
SELECT page_id, host, path, rule,
  coalesce(CASE rule {verdicts} END,
    CASE WHEN r - 1.645 * sqrt(r * (1 - r) / (w + 1)) > 1.5 * {mean} THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled JOIN h2 USING (host)"""


def op12_sql() -> str:
    """The given tables' pages hold their text in one ``article`` element; this
    states the text of such pages (of a page cut short, up to the cut)."""
    return r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)(</article>|$)', 1, 's') AS t FROM pages),
b AS (SELECT page_id, url, regexp_replace(t, '<[^>]*$', '') AS t FROM a),
c AS (SELECT page_id, url, regexp_replace(t, '</?(p|h1|br)( [^>]*)?>', ' ', 'g') AS t FROM b),
d AS (SELECT page_id, url, regexp_replace(t, '<[^>]*>', '', 'g') AS t FROM c),
e AS (SELECT page_id, url, replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"') AS t FROM d),
f AS (SELECT page_id, url, trim(regexp_replace(regexp_replace(t, '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text FROM e)
SELECT page_id, url, text, length(text) AS n_chars FROM f"""


def llm_oracle() -> dict[str, str]:
    return {"op1_chat_format": op1_sql(), "op2_line_dedup": op2_sql(), "op5_url_filter": op5_sql(),
            "op12_html_extract": op12_sql()}
