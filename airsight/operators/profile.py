"""Table profiles: each is one aggregation whose partial results are a few numbers per task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airsight.operators.cleaning import col, numeric_columns
from airsight.operators.quantiles import exact_quantiles, number


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Count and share per class, largest first."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    share = F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 4)  # one row per class
    return counts.withColumn("percent", share).orderBy(F.desc("n"), label)


def _missing(df: DataFrame, name: str) -> Column:
    present = number(name) if name in numeric_columns(df) else col(name)
    return F.count(F.when(present.isNull(), 1))


def dataset_summary(df: DataFrame) -> DataFrame:
    """Rows, columns, missing cells and their percentage."""
    missing = sum((_missing(df, c) for c in df.columns), F.lit(0).cast("bigint"))
    stats = df.agg(F.count(F.lit(1)).alias("n_rows"), missing.alias("missing_total"))
    cells = F.col("n_rows") * len(df.columns)
    return stats.select(
        "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns"), "missing_total",
        F.round(F.try_divide(F.col("missing_total") * 100.0, cells), 2).alias("missing_pct"),
    )


def missing_by_column(df: DataFrame) -> DataFrame:
    """Columns with at least one missing value and how many."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), _missing(df, c).alias("missing")) for c in df.columns])
    return df.agg(pairs.alias("p")).select(F.inline("p")).filter("missing > 0")


def dataset_audit(tables: dict[str, DataFrame | None], errors: dict[str, str] | None = None) -> DataFrame:
    """One row per data set: available, row count, column count, column list, error."""
    rows = None
    spark = next(df.sparkSession for df in tables.values() if df is not None)
    for name, df in tables.items():
        if df is None:
            row = spark.range(1).select(
                F.lit(name).alias("dataset"), F.lit(False).alias("available"), F.lit(None).cast("bigint").alias("n_rows"),
                F.lit(None).cast("bigint").alias("n_columns"), F.lit(None).cast("string").alias("columns"),
                F.lit((errors or {}).get(name, "not found")).alias("error"),
            )
        else:
            row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("dataset"), F.lit(True).alias("available"), "n_rows",
                F.lit(len(df.columns)).cast("bigint").alias("n_columns"), F.lit(",".join(df.columns)).alias("columns"),
                F.lit(None).cast("string").alias("error"),
            )
        rows = row if rows is None else rows.unionByName(row)
    return rows


_MOMENTS = "x int, y int, n double, sx double, sy double, sxx double, syy double, sxy double"


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair over rows where both are present, in long form (x, y, r).

    Each task turns its rows into pairwise moments by matrix products and emits them once, so
    columns x columns rows per task are all that is shuffled. Values are shifted by the column minimum,
    which keeps the moments accurate and a constant column at exactly zero variance (r is NULL).
    """
    found = df.agg(*[F.min(number(c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    shift = np.array([found[f"m{i}"] or 0.0 for i in range(len(cols))])
    k = len(cols)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, k, k))
        for batch in batches:
            raw = np.column_stack([c.to_numpy(zero_copy_only=False).astype("float64") for c in batch.columns])
            seen = ~np.isnan(raw)
            v, m = np.where(seen, raw - shift, 0.0), seen.astype("float64")
            sx, sxx = v.T @ m, (v * v).T @ m
            total += np.stack([m.T @ m, sx, sx.T, sxx, sxx.T, v.T @ v])
        x, y = np.divmod(np.arange(k * k), k)
        columns = [pa.array(x, pa.int32()), pa.array(y, pa.int32()), *[pa.array(t.ravel()) for t in total]]
        yield pa.RecordBatch.from_arrays(columns, names=["x", "y", "n", "sx", "sy", "sxx", "syy", "sxy"])

    sums = (
        df.select(*[number(c).alias(f"c{i}") for i, c in enumerate(cols)])
        .mapInArrow(moments, _MOMENTS)
        .groupBy("x", "y")
        .agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    )
    n = F.nullif(F.col("n"), F.lit(0.0))

    def spread(square: str, plain: str) -> Column:
        var = F.col(square) - F.col(plain) * F.col(plain) / n
        return F.when(var > F.col(square) * 1e-14, var)  # below that only rounding is left

    r = (F.col("sxy") - F.col("sx") * F.col("sy") / n) / F.sqrt(spread("sxx", "sx") * spread("syy", "sy"))
    names = F.array(*[F.lit(c) for c in cols])
    return sums.select(F.get(names, F.col("x")).alias("x"), F.get(names, F.col("y")).alias("y"), r.alias("r"))


def box_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Minimum, quartiles and maximum per column."""
    found = exact_quantiles(df, cols, [0.0, 0.25, 0.5, 0.75, 1.0])
    names = ["min", "q1", "median", "q3", "max"]
    rows = F.array(*[
        F.struct(F.lit(c).alias("feature"), *[F.lit(v).cast("double").alias(n) for n, v in zip(names, q, strict=True)])
        for c, q in found.items()
    ])
    return df.sparkSession.range(1).select(F.inline(rows))


def residual_histogram(df: DataFrame, actual: str, predicted: str, bins: int = 60) -> DataFrame:
    """Equal-width bins of actual - predicted over [min, max]; the last bin is closed, empty bins are kept."""
    residuals = df.select((number(actual) - number(predicted)).alias("r")).filter("r is not null")
    limits = residuals.agg(F.min("r").alias("lo"), F.max("r").alias("hi")).first()
    lo, hi = limits["lo"], limits["hi"]
    if lo is None:
        return residuals.sparkSession.range(0).select(
            F.col("id").alias("bin"), F.lit(0.0).alias("bin_low"), F.lit(0.0).alias("bin_high"), F.col("id").alias("n")
        )
    if lo == hi:  # a single value: a unit-wide range centred on it
        lo, hi = lo - 0.5, hi + 0.5
    at = F.least(F.floor((F.col("r") - F.lit(lo)) / F.lit(hi - lo) * bins), F.lit(bins - 1))
    counts = residuals.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = residuals.sparkSession.range(bins).withColumnRenamed("id", "bin")
    edge = lambda b: F.lit(lo) + b * F.lit(hi - lo) / bins
    return F.broadcast(grid).join(counts, "bin", "left").select(  # at most ``bins`` rows on each side
        "bin", edge(F.col("bin")).alias("bin_low"), edge(F.col("bin") + 1).alias("bin_high"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def axis_range(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Shared axis limits of actual and predicted values."""
    a, p = number(actual), number(predicted)
    return df.agg(F.least(F.min(a), F.min(p)).alias("axis_min"), F.greatest(F.max(a), F.max(p)).alias("axis_max"))


def first_points(
    df: DataFrame, series: Sequence[str], order: Sequence[str], actual: str, predicted: str, limit: int = 500
) -> DataFrame:
    """The first points of each series for a line chart (the chart shows just these), with residuals."""
    w = Window.partitionBy(*series).orderBy(*order)
    return (
        df.withColumn("rn", F.row_number().over(w).cast("bigint"))
        .filter(F.col("rn") <= limit)
        .withColumn("residual", number(actual) - number(predicted))
    )


def cv_summary(scores: DataFrame, score: str, by: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation of fold scores, four decimals."""
    return scores.groupBy(*by).agg(
        F.round(F.avg(score), 4).alias("cv_mean"), F.round(F.stddev_pop(score), 4).alias("cv_std")
    )


def top_importances(importances: DataFrame, name: str, value: str, limit: int = 10) -> DataFrame:
    return importances.orderBy(F.desc(value), name).limit(limit)


def corpus_status(documents: DataFrame, chunks: DataFrame, category: str = "category") -> DataFrame:
    """Documents, categories and chunks of a corpus."""
    docs = documents.agg(
        F.count(F.lit(1)).alias("documents"), F.countDistinct(category).alias("categories")
    ).withColumn("one", F.lit(1))
    parts = chunks.agg(F.count(F.lit(1)).alias("chunks")).withColumn("one", F.lit(1))
    return docs.join(parts, "one").select(
        "documents", "categories", "chunks", (F.col("chunks") > 0).alias("ready")
    )
