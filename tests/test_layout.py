"""Keyed tables: joins on the key leave the stored side where it is."""

from pyspark.sql import functions as F

from tessera.layout import bucket_count, write_keyed


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_on_the_key_shuffles_the_other_side_only(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(5000).select((F.col("id") % 97).alias("k"), F.col("id").alias("x"))
        t = write_keyed(big, "k", bucket_count(spark), "test")
        other = spark.range(97).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y")).groupBy("k").agg(F.max("y").alias("y"))
        j = t.read().join(other, "k")
        assert _plan(j).count("Exchange hashpartitioning") == 1
        assert j.count() == 5000 and j.where("y <> 2 * k").count() == 0
        t.drop()
        assert not spark.catalog.tableExists(t.name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_buckets_follow_the_size(spark):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert bucket_count(spark, 0) == parts
    assert bucket_count(spark, 100 << 30, 1 << 30) == 100
