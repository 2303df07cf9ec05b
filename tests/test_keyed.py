"""Joins of hot keys: the same rows as a plain join, and no task with most of them."""

import pytest
from pyspark.sql import functions as F

from corpusgauge.operators import keyed
from corpusgauge.operators.components import connected_components


def hot_facts(spark, n=20_000):
    """A third of the rows have key 0; some keys are missing on the other side or null."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 101 == 0, None).otherwise(F.col("id") % 500)
    return spark.range(n).select(key.alias("key"), F.col("id").alias("fact"))


def sides(spark):
    facts = hot_facts(spark)
    wide = spark.range(450).select(F.col("id").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("wide"))
    return facts, wide


@pytest.mark.parametrize("rows_per_copy", [1, 100, 10**9])
def test_spread_join_equals_a_join(spark, rows_per_copy):
    facts, wide = sides(spark)
    got = keyed.spread_join(facts, wide, "key", "fact", rows_per_copy)
    want = facts.join(wide, "key")
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    narrow = keyed.spread_join(facts, wide, "key", "fact", rows_per_copy, narrow=facts.select("key"))
    assert narrow.count() == want.count()
    assert keyed.spread_join(facts.filter("false"), wide, "key", "fact", rows_per_copy).count() == 0


def test_a_hot_key_is_dealt_over_tasks(spark):
    facts, wide = sides(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        largest = {}
        for name, joined in (("plain", facts.join(wide, "key")), ("spread", keyed.spread_join(facts, wide, "key", "fact", 100))):
            tasks = joined.groupBy(F.spark_partition_id()).count().collect()
            largest[name] = max(row["count"] for row in tasks)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert largest["plain"] > 6_600
    assert largest["spread"] < largest["plain"] / 1.5


def test_a_star_whose_spokes_cannot_be_broadcast(spark, monkeypatch):
    """The hub is broadcast as a heavy key, all other nodes are shuffled by their own ids."""
    monkeypatch.setattr(keyed.lookup_join, "__defaults__", (200, 16))
    star = spark.range(1, 20_001).select(F.lit(0).cast("bigint").alias("a"), F.col("id").alias("b"))
    chain = spark.range(30_000, 30_020).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = connected_components(star.unionByName(chain)).groupBy("component").count().collect()
    assert {row.component: row["count"] for row in got} == {0: 20_001, 30_000: 21}
