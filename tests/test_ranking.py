import random
from statistics import median

import pandas as pd
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from cartwheel.operators.joins import lookup_join
from cartwheel.operators.ranking import exact_median, value_bin, with_ranks


@pytest.fixture(scope="module")
def data():
    """Skewed groups, a value that a third of all rows share, negatives, a NULL group."""
    rng = random.Random(11)
    out = []
    for i in range(6000):
        group = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", None])
        value = 5000 if rng.random() < 0.34 else rng.choice([rng.randrange(-50, 50), rng.randrange(10 ** 6), -rng.randrange(10 ** 9)])
        out.append((i, group, value))
    return out


def test_ranks(spark, data):
    df = spark.createDataFrame(data, "id INT, g STRING, v BIGINT").withColumn("w", -F.col("v"))
    got = with_ranks(df, ["g"], {"v": "rank_v", "w": "rank_w"}, total="n").toPandas().sort_values("id").reset_index(drop=True)
    pdf = pd.DataFrame(data, columns=["id", "g", "v"])
    groups = pdf.groupby("g", dropna=False)["v"]
    assert (got.rank_v == groups.rank(method="min", ascending=False)).all()
    assert (got.rank_w == groups.rank(method="min", ascending=True)).all()
    assert (got.n == groups.transform("size")).all()


def test_medians(spark, data):
    df = spark.createDataFrame(data, "id INT, g STRING, v BIGINT")
    got = {r.g: r.m for r in exact_median(df, ["g"], "v", "m").collect()}
    assert got == {g: median([v for _, h, v in data if h == g]) for g in ("hot", "a", "b", None)}


def test_bins_keep_the_order(spark):
    values = sorted({s * (10 ** e + d) for s in (-1, 1) for e in range(13) for d in (-1, 0, 1, 5)})
    bins = [r.b for r in spark.createDataFrame([(v,) for v in values], "v BIGINT").select("v", value_bin(F.col("v")).alias("b"))
            .orderBy("v").collect()]
    assert bins == sorted(bins)


def test_small_lookup_is_broadcast_and_a_large_one_is_not(spark):
    left = spark.range(1000).withColumnRenamed("id", "k")
    right = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    assert "BroadcastHashJoin" in plan_of(lookup_join(left, right, ["k"]))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = lookup_join(left, right, ["k"], max_rows=10)
        assert "BroadcastHashJoin" not in plan_of(large) and large.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_hot_key_of_a_shuffled_join_is_split(spark):
    """A third of the rows have one key: the shuffled join reads that partition in several tasks."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k"), F.md5(F.col("id").cast("string")).alias("p"))
        right = spark.range(5000).select(F.col("id").alias("k"), F.lit("x").alias("name"))
        joined = lookup_join(left, right, ["k"], "inner", max_rows=10).groupBy("name").agg(F.count("*").alias("n"))
        assert joined.collect()[0].n == 200_000
        assert "skew=true" in plan_of(joined)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
