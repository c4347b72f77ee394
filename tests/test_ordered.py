"""Ordered groups: both routes must agree with a plain window, also with ties, NULL keys and mixed key sizes."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from airsight.operators import ordered, quantiles


@pytest.fixture
def rows(spark):
    # key 'hot' holds most rows, tied order values everywhere, one NULL key
    return spark.range(600).select(
        F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 < 9, "mild").otherwise(F.lit(None)).alias("k"),
        (F.col("id") % 13).alias("o"), "id", ((F.col("id") * 37) % 101).cast("double").alias("v"),
    )


def _same(a, b):
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.select(a.columns).collect()), key=repr)


def test_row_numbers(spark, rows, small_groups):
    w = Window.partitionBy("k")
    plain = rows.withColumn("rn", F.row_number().over(w.orderBy("o", "id")).cast("bigint")).withColumn("n", F.count("*").over(w))
    _same(plain, ordered.row_numbers(rows, ["k"], ["o", "id"], "rn", "n"))


def test_row_numbers_without_key_descending(spark, rows, small_groups):
    plain = rows.withColumn("rn", F.row_number().over(Window.orderBy(F.desc("v"), "id")).cast("bigint"))
    _same(plain, ordered.row_numbers(rows, [], [F.desc("v"), "id"]))


def test_running(spark, rows, small_groups):
    w = Window.partitionBy("k").orderBy("o", "id").rowsBetween(Window.unboundedPreceding, 0)
    plain = rows.select("*", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("hi"), F.min("v").over(w).alias("lo"))
    _same(plain, ordered.running(rows, ["k"], ["o", "id"], {"s": ("sum", "v"), "hi": ("max", "v"), "lo": ("min", "v")}))


@pytest.mark.parametrize("before,after", [(3, 2), (60, 0), (70, 80)])
def test_sliding(spark, rows, small_groups, before, after):
    def build(w):
        return {"s": F.sum("v").over(w.rowsBetween(-before, after)), "lag": F.lag("v", min(before, 5)).over(w)}

    plain = rows.select("*", *[c.alias(n) for n, c in build(Window.partitionBy("k").orderBy("o", "id")).items()])
    _same(plain, ordered.sliding(rows, ["k"], ["o", "id"], before, after, build))


@pytest.mark.parametrize("probs", [[0.5], [0.0, 0.25, 0.5, 0.75, 1.0], [0.1, 0.999]])
def test_exact_quantiles(spark, small_groups, probs):
    # a third of the rows share one value; NULL and NaN do not count
    df = spark.range(3001).select(
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(((F.col("id") * 7919) % 1009).cast("double")).alias("a.b"),
        F.when(F.col("id") % 5 == 0, float("nan")).when(F.col("id") % 5 > 1, F.col("id").cast("double")).alias("gaps"),
        F.lit(None).cast("double").alias("empty"),
    )
    got = quantiles.exact_quantiles(df, ["a.b", "gaps", "empty"], probs)
    spark.conf.set("airsight.maxGroupRows", "100000000")
    try:
        assert quantiles.exact_quantiles(df, ["a.b", "gaps", "empty"], probs) == got  # equal doubles on either route
    finally:
        spark.conf.set("airsight.maxGroupRows", "50")
    pdf = df.toPandas()
    for c in ("a.b", "gaps"):
        assert got[c] == pytest.approx(list(pdf[c].quantile(probs)))
    assert got["empty"] == [None] * len(probs)


def test_rank_thresholds_with_ties(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 4 == 0, "b").otherwise("a").alias("k"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 50).alias("o"), "id"
    )
    got = {r["k"]: r for r in quantiles.rank_thresholds(df, ["k"], "o", "id", {"cut": F.col("n") * 0 + 700, "none": F.col("n") * 0}).collect()}
    pdf = df.toPandas()
    for k, group in pdf.groupby("k"):
        row = group.sort_values(["o", "id"]).iloc[699]
        assert (got[k]["cut"]["o"], got[k]["cut"]["t"]) == (row["o"], row["id"])
        assert got[k]["none"] is None and got[k]["n"] == len(group)
