"""The corpus pipeline: five operators in turn over all documents.

1. language_id: documents without letters (``und``), that no language family's
   machine accepts, or whose letters are far from those of every learned language
   (an unlearned language, gibberish) go; ``lang`` becomes the predicted language.
2. line_dedup: lines found in ten documents or more go; ``n_chars`` follows.
3. near_dedup: of each group of near copies the smallest doc_id stays.
4. mixing: sources are drawn to their target weights; a document drawn
   twice is there twice.
5. bpe: ids of every text and whether they decode to it.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of
documents.  Rows with the same id count as one document in stage 3 and stay or
go together.  ``ORACLE_SQL`` is None: stages 1, 3, 4 and 5 have no SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitemerge.llm import bpe, langid, lines, minhash, mixing
from sitemerge.llm.common import cut, small_batches, table
from sitemerge.llm.queries import vocabulary

LEAST_SCORE = 0.5  # below it, the best family's machine says no
LEAST_FIT = -8.0  # spreads below a language's median text; see langid

ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.train(docs, fits=True)
    told = langid.predict(docs, model, out=("_lang", "_score", "_fit"))
    kept = told.where((F.col("_lang") != langid.UND) & (F.col("_score") >= LEAST_SCORE)
                      & (F.col("_fit") >= LEAST_FIT))
    return kept.withColumn("lang", F.col("_lang")).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = lines.apply_bitmaps(docs, lines.keep_bitmaps(docs, min_docs=10, min_chars=1))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    copies = minhash.near_duplicates(docs).where(~F.col("kept")).select(
        F.col("doc_id").alias("_copy")).distinct()
    return docs.join(copies, F.col("doc_id") == F.col("_copy"), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_rows(docs).select(*docs.columns)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    v = vocabulary()
    small_batches(spark)  # this stage's result is run by the caller
    done = bpe.round_trip(docs, v)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return done.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       (F.col("decoded") == text).alias("round_trip"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("bpe", bpe_encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written as Parquet."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
