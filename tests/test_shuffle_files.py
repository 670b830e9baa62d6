"""A query's shuffle files are removed when it ends, unless the session says otherwise."""

from pyspark.sql import functions as F

from sitemerge.session import drop_shuffles


def test_shuffle_files_go_with_the_query(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.unset(key)
    try:
        drop_shuffles(spark)
        assert spark.conf.get(key) == "true"
        df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        assert len(df.collect()) == len(df.collect()) == df.count() == 7
        spark.conf.set(key, "false")
        drop_shuffles(spark)
        assert spark.conf.get(key) == "false"  # a session's own choice stays
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)
