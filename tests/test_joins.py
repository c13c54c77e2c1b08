import pytest
from pyspark.sql import functions as F

from paperloom.operators.joins import first_hit, key_load, probe_keys, spread_join


@pytest.fixture
def skewed(spark):
    """30,000 rows: a third with one key, a third without, a third with keys of their own."""
    return spark.range(30000).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id"))).alias("key"),
    )


@pytest.fixture
def lookup(spark):
    found = spark.range(0, 30000, 2).select(F.concat(F.lit("k"), F.col("id")).alias("key"), F.col("id").alias("value"))
    return found.unionByName(spark.sql("select 'hot' as key, -1L as value"))


def test_key_load_sees_what_outweighs_a_task(skewed, split_all):
    load = key_load(skewed, "key")
    assert load.rows == 30000 and load.heavy == {"key": ["hot"]} and load.blank == {"key": True}


def test_small_frames_are_not_split(skewed):
    load = key_load(skewed, "key")
    assert load.heavy == {"key": []} and load.blank == {"key": False}


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_split_join_gives_the_plain_result(skewed, lookup, split_all, how):
    plain = skewed.join(lookup, "key", how)
    split = spread_join(skewed, lookup, ["key"], how, "n")
    assert split.columns == plain.columns
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()


def test_heavy_and_blank_keys_are_spread_over_tasks(spark, skewed, lookup, split_all):
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def largest(df):
            return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        assert largest(skewed.join(lookup, "key", "left")) >= 10000
        assert largest(spread_join(skewed, lookup, ["key"], "left", "n")) < 6500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
        spark.conf.set("spark.sql.adaptive.enabled", aqe)


def test_first_hit_takes_the_first_rung(spark, split_all):
    rows = spark.createDataFrame([(1, "a", "p"), (2, "x", "p"), (3, None, "p"), (4, "x", "y"), (5, None, None)], "n int, doi string, pii string")
    index = spark.createDataFrame([("doi", "a", 10), ("pii", "p", 20), ("doi", "y", 30), ("pii", "a", 40)], "kind string, key string, value int")
    rungs = [("doi", "doi", F.col("doi")), ("pii", "pii", F.col("pii"))]
    got = first_hit(probe_keys(rows, "n", rungs), index).collect()
    assert sorted(map(tuple, got)) == [(1, "doi", 10), (2, "pii", 20), (3, "pii", 20)]


def test_more_hot_keys_than_a_few_hundred(spark, monkeypatch):
    """600 keys that each outweigh a task of 1,000: all are found and split, none is left whole."""
    from paperloom.operators import joins

    monkeypatch.setattr(joins, "HEAVY_ROWS", 2)
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1000")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(60_000).repartition(8).select(
            F.col("id").alias("n"), F.concat(F.lit("k"), F.pmod("id", F.lit(600))).alias("key"))
        load = key_load(rows, "key")
        assert len(load.heavy["key"]) == 600
        right = spark.range(600).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("value"))
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        joined = spread_join(rows, right, ["key"], "inner", "n", load)
        assert joined.count() == 60_000 and joined.where("value != cast(substr(key, 2) as long)").isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
