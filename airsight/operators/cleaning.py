"""Cleaning: projections, missing values, imputation, timestamps, target choice, encoding and scaling.

Fitted parameters (medians, means) are a handful of numbers per column: they are computed by one Spark
aggregation and applied as literals, so applying them never joins or shuffles. Labels may be many, so they are a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airsight import config as cfg
from airsight.functions.risk import class_name
from airsight.operators.ordered import row_numbers
from airsight.operators.quantiles import exact_quantiles, number
from airsight.session import sized, stage


def col(name: str) -> Column:
    """A column by its literal name, dots and parentheses included."""
    return F.col(f"`{name}`")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Fail before any job runs if a column is absent."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}; found: {df.columns}")
    return df


def project_complete(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Only the required columns, only rows where all are present."""
    return drop_incomplete(require_columns(df, required).select(*[col(c) for c in required]))


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows where all of ``cols`` (default: every column) are present."""
    present = F.lit(True)
    for c in cols or df.columns:
        present = present & col(c).isNotNull()
    return df.filter(present)


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(col(c)), col(c)) for c in floats})


def sentinel_to_null(df: DataFrame, cols: Sequence[str] | None = None, sentinel: float = cfg.SENTINEL) -> DataFrame:
    chosen = numeric_columns(df) if cols is None else cols
    return df.withColumns({c: F.nullif(col(c), F.lit(sentinel)) for c in chosen})


def drop_all_null_columns(df: DataFrame, unnamed_prefix: str = "Unnamed") -> DataFrame:
    """Drop unnamed columns, then columns without a single value; one pass over the data."""
    named = df.select(*[col(c) for c in df.columns if not c.startswith(unnamed_prefix)])
    counts = named.agg(*[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(named.columns)]).first()
    return named.select(*[col(c) for i, c in enumerate(named.columns) if counts[f"n{i}"]])


def fit_medians(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, float]:
    """Exact median per column; columns without values are left out."""
    chosen = numeric_columns(df) if cols is None else list(cols)
    found = exact_quantiles(df, chosen, [0.5])
    return {c: q[0] for c, q in found.items() if q[0] is not None}


def fill_missing(df: DataFrame, values: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(number(c), F.lit(float(v))) for c, v in values.items()})


def impute_medians(df: DataFrame, cols: Sequence[str] | None = None, fit_on: DataFrame | None = None) -> DataFrame:
    """Median imputation; by default fitted on the whole table, or on ``fit_on`` (e.g. the training part)."""
    return fill_missing(df, fit_medians(df if fit_on is None else fit_on, cols))


def decode_classes(df: DataFrame, code: str, label: str) -> DataFrame:
    """Add the class name and drop rows whose code has none."""
    return df.withColumn(label, class_name(F.col(code))).filter(F.col(label).isNotNull())


def parse_timestamps(
    df: DataFrame, date: str, time: str, fmt: str = "d/M/yyyy H:mm:ss", out: str = "DateTime"
) -> DataFrame:
    """Parse ``date time`` with an explicit format; rows that do not parse are dropped."""
    joined = F.concat_ws(" ", col(date), col(time))
    parsed = F.try_to_timestamp(joined, F.lit(fmt)).cast("timestamp_ntz")
    return df.withColumn(out, parsed).filter(F.col(out).isNotNull())


def rejected_timestamps(df: DataFrame, date: str, time: str, fmt: str = "d/M/yyyy H:mm:ss") -> DataFrame:
    joined = F.concat_ws(" ", col(date), col(time))
    return df.agg(F.count(F.when(F.try_to_timestamp(joined, F.lit(fmt)).isNull(), 1)).alias("rejected"))


def with_default_features(df: DataFrame, features: Sequence[str], default: float = 0.0) -> DataFrame:
    """Features in fitted order; absent ones become the default."""
    others = [col(c) for c in df.columns if c not in features]
    return df.select(*others, *[col(c) if c in df.columns else F.lit(default).alias(c) for c in features])


def target_coverage(df: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """Share of present values per candidate target."""
    present = [c for c in candidates if c in df.columns]
    pairs = F.array(*[
        F.struct(F.lit(i).alias("preference"), F.lit(c).alias("target"), F.avg(number(c).isNotNull().cast("double")).alias("coverage"))
        for i, c in enumerate(present, start=1)
    ])
    return df.agg(pairs.alias("p")).select(F.inline("p"))


def select_target(
    df: DataFrame, candidates: Sequence[str] = tuple(cfg.SENSOR_TARGETS), minimum: float = cfg.TARGET_COVERAGE
) -> str:
    """First candidate with enough values, else the first numeric column."""
    present = [c for c in candidates if c in df.columns]
    if present:
        shares = {r["target"]: r["coverage"] for r in target_coverage(df, present).collect()}  # one row per candidate
        for c in present:
            if (shares[c] or 0.0) >= minimum:
                return c
    numeric = numeric_columns(df)
    if not numeric:
        raise ValueError("no numeric column can serve as target")
    return numeric[0]


@dataclass(frozen=True)
class Scaler:
    """Column-wise (x - shift) / scale; a zero scale maps the column to 0."""

    shift: dict[str, float]
    scale: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            c: F.when(number(c).isNotNull(), (number(c) - F.lit(self.shift[c])) / F.lit(self.scale[c] or 1.0))
            for c in self.shift
        })

    def inverse(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: number(c) * F.lit(self.scale[c] or 1.0) + F.lit(self.shift[c]) for c in self.shift})


def _fit_scaler(df: DataFrame, cols: Sequence[str], shift, scale) -> Scaler:
    stats = df.agg(
        *[shift(number(c)).alias(f"a{i}") for i, c in enumerate(cols)],
        *[scale(number(c)).alias(f"b{i}") for i, c in enumerate(cols)],
    ).first()
    seen = [(i, c) for i, c in enumerate(cols) if stats[f"a{i}"] is not None]
    return Scaler({c: stats[f"a{i}"] for i, c in seen}, {c: stats[f"b{i}"] for i, c in seen})


def fit_standard(df: DataFrame, cols: Sequence[str]) -> Scaler:
    """Mean and population standard deviation."""
    return _fit_scaler(df, cols, F.avg, F.stddev_pop)


def fit_min_max(df: DataFrame, cols: Sequence[str]) -> Scaler:
    """Minimum and range of the fitted table; unseen values are not clipped."""
    return _fit_scaler(df, cols, F.min, lambda c: F.max(c) - F.min(c))


def fit_labels(df: DataFrame, label: str) -> DataFrame:
    """Distinct labels with their 0-based position in alphabetical order: columns ``label`` and ``index``, one row per label."""
    distinct = df.select(F.col(label).cast("string").alias("label")).filter("label is not null").distinct()
    numbered = row_numbers(distinct, [], ["label"], "_rn")
    return stage(numbered.select("label", (F.col("_rn") - 1).alias("index")), "labels")


def encode_labels(df: DataFrame, label: str, labels: DataFrame, out: str) -> DataFrame:
    """Position of the label in ``labels``; a label that it lacks stops the job."""
    known = sized(labels.select(F.col("label").alias("_label"), F.col("index").alias("_index")))
    unknown = F.raise_error(F.concat(F.lit("unseen label: "), F.coalesce(F.col(label).cast("string"), F.lit("NULL"))))
    joined = df.join(known, F.col(label).cast("string") == F.col("_label"), "left")
    return joined.withColumn(out, F.coalesce(F.col("_index"), unknown.cast("bigint"))).drop("_label", "_index")


def decode_labels(df: DataFrame, index: str, labels: DataFrame, out: str) -> DataFrame:
    """Label at each position; a position outside the table gives NULL."""
    known = sized(labels.select(F.col("label").alias(out), F.col("index").alias("_index")))
    return df.join(known, F.col(index).cast("bigint") == F.col("_index"), "left").drop("_index")
