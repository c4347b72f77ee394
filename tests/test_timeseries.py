"""Series operators against pandas, on short, gappy and large series."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from airsight.operators import cleaning, splits, timeseries

KEYS, ORDER = ["s"], ["ts", "id"]


@pytest.fixture(params=["one task per series", "split series"])
def route(request, spark):
    if request.param == "split series":
        spark.conf.set("airsight.maxGroupRows", "60")
    yield
    spark.conf.unset("airsight.maxGroupRows")


@pytest.fixture
def frame():
    rng = np.random.default_rng(1)
    parts = []
    for name, n in {"long": 420, "short": 20, "one": 1}.items():
        v = rng.normal(50, 10, n).round(2)
        v[rng.random(n) < 0.1] = np.nan
        v[30:45] = np.nan
        # tied timestamps: the id decides
        parts.append(pd.DataFrame({"s": name, "ts": np.arange(n) // 2, "id": np.arange(n), "v": v}))
    return pd.concat(parts)


@pytest.fixture
def df(spark, frame):
    return cleaning.nan_to_null(spark.createDataFrame(frame)).repartition(5)


def check(got, frame, column, expected):
    mine = got.select("s", "id", column).toPandas().set_index(["s", "id"])[column]
    theirs = pd.Series(np.concatenate([expected(g) for _, g in frame.groupby("s", sort=False)]), index=pd.MultiIndex.from_frame(frame[["s", "id"]]))
    pd.testing.assert_series_equal(mine.astype(float).sort_index(), theirs.astype(float).sort_index(), check_names=False)


def test_lags_and_rolling(df, frame, route):
    lags = timeseries.lag_features(df, KEYS, ORDER, "v")
    for n in (1, 7, 24):
        check(lags, frame, f"v_lag_{n}", lambda g, n=n: g.v.shift(n))
    rolled = timeseries.rolling_features(df, KEYS, ORDER, "v")
    for n in (24, 168):
        for stat in ("mean", "max", "min"):
            check(rolled, frame, f"v_roll_{stat}_{n}", lambda g, n=n, stat=stat: getattr(g.v.rolling(n, min_periods=1), stat)())
    past = timeseries.rolling_features(df, KEYS, ORDER, "v", [24], include_current=False)
    check(past, frame, "v_roll_mean_24", lambda g: g.v.shift(1).rolling(24, min_periods=1).mean())


@pytest.mark.parametrize("zone", ["UTC", "Etc/UTC", "Europe/Berlin"])
def test_instants_in_any_time_zone(spark, zone, route):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.range(150).select(
            F.lit("x").alias("s"), F.timestamp_seconds(F.col("id") * 3600).alias("ts"), F.timestamp_seconds(F.col("id") * 7).alias("seen"), "id",
            F.col("id").cast("double").alias("v"),
        )
        rolled = timeseries.rolling_features(df, ["s"], ["ts", "id"], "v", [24])
        assert rolled.dtypes[:5] == df.dtypes
        got = rolled.select("id", F.unix_seconds("ts"), F.unix_seconds("seen"), "v_roll_min_24").collect()
        assert sorted(map(tuple, got)) == [(i, i * 3600, i * 7, float(max(0, i - 23))) for i in range(150)]
        table = timeseries.feature_table(df, ["s"], "ts", ["id"], "v").filter("id = 100").select("hour", F.hour("ts")).first()
        assert table[0] == table[1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_centered_average(df, frame, route):
    filled = df.fillna(50.0, ["v"])
    full = frame.fillna({"v": 50.0})
    check(timeseries.centered_moving_average(filled, KEYS, ORDER, "v", 168), full, "moving_avg", lambda g: g.v.rolling(168, center=True).mean())
    check(timeseries.centered_moving_average(filled, KEYS, ORDER, "v", 7), full, "moving_avg", lambda g: g.v.rolling(7, center=True).mean())


def test_sequences_and_split(df, frame, route):
    split = timeseries.time_split(df.fillna(0.0, ["v"]), KEYS, "ts", "id", validation_fraction=0.1)
    sizes = {(r["s"], r["part"]): r["count"] for r in split.groupBy("s", "part").count().collect()}
    assert sizes == {
        ("long", "train"): 303, ("long", "validation"): 33, ("long", "test"): 84, ("short", "train"): 15, ("short", "validation"): 1,
        ("short", "test"): 4, ("one", "test"): 1,
    }
    last = split.filter("s = 'long' and part <> 'test'").agg(F.max("id")).first()[0]
    assert last == 335
    seq = timeseries.lookback_sequences(split, KEYS, ORDER, ["v", "id"])
    rows = seq.collect()
    assert len(rows) == 420 - 24 and sum(r["part"] == "test" for r in rows) == 84
    assert all([x["id"] for x in r["sequence"]] == list(range(r["id"] - 24, r["id"])) for r in rows)


def test_feature_table_drops_incomplete_rows(spark, route):
    df = spark.range(200).select(
        F.lit("x").alias("s"), F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("ts"), "id", F.col("id").cast("double").alias("v")
    )
    table = timeseries.feature_table(df, ["s"], "ts", ["id"], "v")
    assert table.count() == 176 and table.columns[-3:] == ["hour", "day_of_week", "month"]
    first = table.orderBy("id").first()
    assert (first["id"], first["v_lag_24"], first["v_roll_mean_24"], first["day_of_week"]) == (24, 0.0, 12.5, 4)  # 2 January 1970, a Friday


@pytest.mark.parametrize("limit", ["2000000", "100"])
def test_splits(spark, limit):
    spark.conf.set("airsight.maxGroupRows", limit)
    df = spark.range(1003).select("id", F.when(F.col("id") % 10 == 0, "rare").when(F.col("id") % 3 == 0, "mid").otherwise("often").alias("c"))
    parts = splits.stratified_split(df, "c", "id")
    n = {r["c"]: r["count"] for r in df.groupBy("c").count().collect()}
    test = {r["c"]: r["count"] for r in parts.filter("part = 'test'").groupBy("c").count().collect()}
    assert sum(test.values()) == 201 and all(abs(test[c] - n[c] * 0.2) < 1 for c in n) and parts.count() == 1003
    folds = splits.stratified_folds(df, "c", "id")
    sizes = {(r["c"], r["fold"]): r["count"] for r in folds.groupBy("c", "fold").count().collect()}
    for c in n:
        assert max(sizes[c, f] for f in range(5)) - min(sizes[c, f] for f in range(5)) <= 1
    again = splits.stratified_split(df.repartition(7), "c", "id")
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, again.select(parts.columns).collect()))
    spark.conf.unset("airsight.maxGroupRows")


def test_split_is_the_same_on_both_routes(spark):
    df = spark.range(700).select("id", (F.col("id") % 3).alias("c"))
    out = []
    for limit in ("1000000", "50"):
        spark.conf.set("airsight.maxGroupRows", limit)
        both = splits.stratified_folds(splits.stratified_split(df, "c", "id"), "c", "id")
        out.append(sorted(tuple(r) for r in both.select("id", "c", "part", "fold").collect()))
    spark.conf.unset("airsight.maxGroupRows")
    assert out[0] == out[1]


def test_cleaning(spark):
    df = spark.createDataFrame(
        [(-200.0, 1.0, None, 1), (3.0, float("nan"), None, 2), (5.0, 2.0, None, 3), (9.0, None, None, 4)], "`a.b` double, c double, e double, Unnamed0 int"
    )
    kept = cleaning.drop_all_null_columns(df)
    assert kept.columns == ["a.b", "c"]
    clean = cleaning.sentinel_to_null(cleaning.nan_to_null(kept))
    assert cleaning.fit_medians(clean) == {"a.b": 5.0, "c": 1.5}
    assert [tuple(r) for r in cleaning.impute_medians(clean).collect()] == [(5.0, 1.0), (3.0, 1.5), (5.0, 2.0), (9.0, 1.5)]
    assert cleaning.select_target(clean, ["c", "a.b"]) == "a.b" and cleaning.select_target(clean, ["zz"]) == "a.b"
    with pytest.raises(ValueError, match="missing columns"):
        cleaning.require_columns(df, ["x"])
    scaler = cleaning.fit_standard(clean, ["a.b"])
    assert scaler.scale["a.b"] == pytest.approx(np.std([3, 5, 9]))
    back = scaler.inverse(scaler.transform(clean))
    assert [r[0] for r in back.collect()] == pytest.approx([None, 3.0, 5.0, 9.0])
    constant = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    for fit in (cleaning.fit_standard, cleaning.fit_min_max):
        assert [r[0] for r in fit(constant, ["x"]).transform(constant).collect()] == [0.0, 0.0]
    labels = spark.createDataFrame([("b",), ("a",), ("b",)], "y string")
    names = cleaning.fit_labels(labels, "y")
    coded = cleaning.encode_labels(labels, "y", names, "i")
    assert [r["i"] for r in coded.collect()] == [1, 0, 1]
    assert [r["z"] for r in cleaning.decode_labels(coded, "i", names, "z").collect()] == ["b", "a", "b"]
    with pytest.raises(Exception, match="unseen label"):
        cleaning.encode_labels(labels, "y", names.filter("label = 'a'"), "i").collect()


def test_twenty_thousand_labels(spark):
    many = spark.range(40_000).select(F.concat(F.lit("l"), F.lpad((F.col("id") % 20_000).cast("string"), 5, "0")).alias("y"))
    coded = cleaning.encode_labels(many, "y", cleaning.fit_labels(many, "y"), "i")
    assert coded.filter(F.col("i") != F.substring("y", 2, 5).cast("int")).count() == 0 and coded.count() == 40_000


def test_both_routes_label_the_same_rows(spark):
    """NULL series, labels, times and ids, ties and repeated rows."""
    x = F.col("id")
    df = spark.range(700).select(
        F.when(x % 4 == 0, None).otherwise(x % 3).alias("s"), F.when(x % 5 == 0, None).otherwise((x * 37) % 60).alias("t"),
        F.when(x % 9 == 0, None).otherwise(x % 200).alias("id"),
    )
    df = df.union(df.filter("id % 7 = 0"))

    def labelled() -> list:
        split = timeseries.time_split(df, ["s"], "t", "id", validation_fraction=0.1)
        parts = splits.stratified_split(df, "s", "id", order=F.col("t"), out="side")
        folds = splits.stratified_folds(df, "s", "id", order=F.col("t"))
        return [sorted((tuple(r) for r in d.collect()), key=repr) for d in (split, parts, folds)]

    small = labelled()
    spark.conf.set("airsight.maxGroupRows", "50")
    try:
        large = labelled()
    finally:
        spark.conf.unset("airsight.maxGroupRows")
    assert small == large and all(len(rows) == df.count() for rows in small)


def test_timestamps(spark):
    df = spark.createDataFrame([("10/3/2004", "18:00:00"), ("31/4/2004", "1:00:00"), ("1/13/2004", "1:00:00"), (None, None)], "d string, t string")
    assert [str(r["DateTime"]) for r in cleaning.parse_timestamps(df, "d", "t").collect()] == ["2004-03-10 18:00:00"]
    assert cleaning.rejected_timestamps(df, "d", "t").first()[0] == 3
