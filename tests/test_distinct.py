from conftest import plan_of, rows
from pyspark.sql import functions as F

from cartwheel.operators.distinct import distinct_counts


def both_ways(spark, data):
    on = F.col("k") == 1
    counts = {"a": ("a", None), "a_on": ("a", on), "b": ("b", None), "b_on": ("b", on)}
    df = spark.createDataFrame(data, "g STRING, a INT, b STRING, k INT")
    plain = df.groupBy("g").agg(F.countDistinct("a"), F.countDistinct(F.when(F.col("k") == 1, F.col("a"))),
                                F.countDistinct("b"), F.countDistinct(F.when(F.col("k") == 1, F.col("b"))))
    return distinct_counts(df, ["g"], counts), rows(plain)


def test_equal_to_the_built_in_counts(spark):
    data = [(["x", "y", None][i % 3], i % 7 if i % 5 else None, f"b{i % 4}" if i % 6 else None, [0, 1, None][i % 11 % 3]) for i in range(300)]
    got, want = both_ways(spark, [*data, ("only nulls", None, None, None)])
    assert rows(got) == want and ("only nulls", 0, 0, 0, 0) in want


def test_no_rows(spark):
    got, want = both_ways(spark, [])
    assert rows(got) == want == []


def test_rows_are_hashed_and_never_expanded(spark):
    got, _ = both_ways(spark, [(f"g{i % 3}", i, str(i), 1) for i in range(100)])
    got.collect()
    plan = plan_of(got).split("Initial Plan")[0]
    assert "Expand" not in plan and "SortAggregate" not in plan and plan.count("Scan ExistingRDD") == 2
