from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lockscope.operators import audit, shape, skew


@pytest.fixture
def plain_plan(spark):
    """Neither broadcasts nor merged partitions: each task takes what its keys bring."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "40"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def largest_share(df):
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(counts) / sum(counts)


def test_heavy_groups(spark):
    df = spark.range(100000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, "warm").when(F.col("id") % 7 != 2, F.col("id").cast("string")).alias("g"))
    assert {r.g for r in skew.heavy_groups(df, "g").collect()} == {"hot", "warm"}
    assert skew.heavy_groups(df.limit(0), "g").collect() == [] and skew.heavy_groups(df.filter("g is null"), "g").collect() == []


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("heavy", [False, True])
def test_split_join_is_the_join(spark, how, heavy):
    left = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 5 == 0, "hot").when(F.col("id") % 5 == 1, None).when(F.col("id") % 5 == 2, "").otherwise(F.col("id").cast("string")).alias("k"))
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("3", 5), ("", 9), (None, 8), ("unused", 7)], "k string, v int")
    known = skew.heavy_groups(left, "k") if heavy else None
    got = skew.split_join(left, right, "k", how, known, pieces=7)
    want = left.join(right.filter("k <> ''"), "k", how).select("id", "k", "v")
    assert got.columns == ["id", "k", "v"]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_heavy_key_is_dealt_out(spark, plain_plan):
    left = spark.range(20000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    right = spark.createDataFrame([("hot", 1)], "k string, v int").union(spark.range(20000).select(F.col("id").cast("string"), F.lit(2)))
    assert largest_share(left.join(right, "k")) > 0.4
    assert largest_share(skew.split_join(left, right, "k", "inner", skew.heavy_groups(left, "k"))) < 0.1


def test_cache_coverage_with_half_the_keys_missing(spark, plain_plan):
    key = F.col("id")
    artifacts = spark.range(40000).select(
        key.alias("artifact_id"), F.when(key % 2 == 0, key.cast("string")).alias("integrity"), F.lit("").alias("source_url"), F.when(key % 4 > 1, F.concat(F.lit("https://x.example/"), key)).otherwise("").alias("source")
    )
    index = spark.range(0, 40000, 3).select(key.cast("string").alias("integrity"), F.concat(F.lit("url:https:/x.example/"), key).alias("key"))
    covered = audit.cache_coverage(artifacts, index)
    # rows without a key stay in the tasks that read them
    assert largest_share(covered) < 0.05
    got = covered.agg(F.count_if("by_integrity"), F.count_if("by_url"), F.count_if("covered")).first()
    ids = range(0, 40000, 3)
    assert tuple(got) == (sum(i % 2 == 0 for i in ids), sum(i % 4 > 1 for i in ids), sum(i % 2 == 0 or i % 4 > 1 for i in ids))


def test_only_heavy_groups_are_cut(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("_group"), (F.col("id") % 977).alias("v"))
    cut = shape._bucketed(df, F.col("v"))
    assert cut.filter("_group <> 'hot' and _bucket <> 0").count() == 0
    of_hot = cut.filter("_group = 'hot'")
    assert of_hot.select("_bucket").distinct().count() > 100
    edges = of_hot.groupBy("_bucket").agg(F.min("v").alias("low"), F.max("v").alias("high")).orderBy("_bucket").collect()
    assert all(a.high < b.low for a, b in zip(edges, edges[1:]))
    assert shape._bucketed(df.filter("_group <> 'hot'"), F.col("v")).select("_bucket").distinct().count() == 1
