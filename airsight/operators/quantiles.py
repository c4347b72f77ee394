"""Exact quantiles and exact rank thresholds without sorting whole tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airsight.operators.ordered import join_on_keys, row_numbers, running
from airsight.session import lookup, max_group_rows, stage

#: percentile_approx returns a value whose rank is off by at most rows / _ACCURACY.
_ACCURACY = 10_000


def number(name: str) -> Column:
    """A numeric column with NaN read as missing."""
    c = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(c), c)


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles per column; missing values are skipped.

    Small tables use the built-in exact ``percentile``. It keeps every distinct value of a column in one
    buffer, so large tables first bracket each quantile with mergeable sketches and then count
    only the values inside the bracket.
    """
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(number(c)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    if counts["_n"] <= max_group_rows(df.sparkSession):
        wanted = F.array(*[F.lit(float(p)) for p in probs])
        row = df.agg(*[F.percentile(number(c), wanted).alias(f"q{i}") for i, c in enumerate(cols)]).first()
        return {c: list(row[f"q{i}"]) if row[f"q{i}"] is not None else [None] * len(probs) for i, c in enumerate(cols)}

    present = [(i, c) for i, c in enumerate(cols) if counts[f"n{i}"]]
    slack = 2.0 / _ACCURACY
    edges = [e for p in probs for e in (max(0.0, p - slack), min(1.0, p + slack))]
    sketch = df.agg(*[F.percentile_approx(number(c), edges, _ACCURACY).alias(f"e{i}") for i, c in present]).first()
    targets = []  # (target id, column, low, high, lower rank, fraction)
    for i, c in present:
        for j, p in enumerate(probs):
            rank = (counts[f"n{i}"] - 1) * p
            low, high = sketch[f"e{i}"][2 * j], sketch[f"e{i}"][2 * j + 1]
            targets.append((f"{i}_{j}", c, low, high, math.floor(rank), rank - math.floor(rank)))
    below = df.agg(*[F.count(F.when(number(c) < low, 1)).alias(f"b{t}") for t, c, low, *_ in targets]).first()

    inside = F.array_compact(F.array(*[
        F.when(number(c).between(low, high), F.struct(F.lit(t).alias("t"), number(c).alias("v")))
        for t, c, low, high, *_ in targets
    ]))
    values = df.select(F.explode(inside).alias("x")).groupBy("x.t", "x.v").agg(F.count(F.lit(1)).alias("n"))
    ranked = running(values, ["t"], ["v"], {"upto": ("sum", "n")})
    lower, upper = F.lit(None).cast("bigint"), F.lit(None).cast("bigint")
    for t, _, _, _, rank, frac in targets:
        lower = F.when(F.col("t") == t, F.lit(rank - below[f"b{t}"])).otherwise(lower)
        upper = F.when(F.col("t") == t, F.lit(rank + (1 if frac else 0) - below[f"b{t}"])).otherwise(upper)
    picked = {
        r["t"]: r
        for r in ranked.groupBy("t").agg(
            F.min(F.when(F.col("upto") > lower, F.col("v"))).alias("lo"),
            F.min(F.when(F.col("upto") > upper, F.col("v"))).alias("hi"),
        ).collect()  # one row per requested quantile
    }
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in cols}
    for t, c, _, _, rank, frac in targets:
        lo, hi = picked[t]["lo"], picked[t]["hi"]
        # the same terms in the same order as the built-in percentile, so both routes give equal doubles
        out[c][int(t.split("_")[1])] = lo if lo == hi else (rank + 1 - (rank + frac)) * lo + frac * hi
    return out


def rank_thresholds(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tie: str,
    ranks: dict[str, Column],
    size: str = "n",
    facts: DataFrame | None = None,
) -> DataFrame:
    """Per key: its row count and the (order, tie) pair found at each requested 1-based rank.

    ``ranks`` maps a name to an expression over the row count column ``size`` and the per-key table ``facts``;
    rank 0 gives NULL. NULL keys are a key, NULL order values and ties come first, as in an ascending sort.
    The pair is returned as struct column ``name``, so "row is among the first r" is a plain comparison.
    Only rows between two sketch values around the rank are ever ranked. The result is ready to be joined back.
    """
    pair = F.struct(F.col(order).alias("o"), F.col(tie).alias("t"))
    slim = df.select(*keys, order, tie)
    names = list(ranks)
    sizes = slim.groupBy(*keys).agg(F.count(F.lit(1)).alias(size), F.count(F.when(F.col(order).isNull(), 1)).alias("_nulls"))
    if facts is not None:
        sizes = join_on_keys(sizes, facts, list(keys))
    asked = sizes.select(*keys, size, "_nulls", *[ranks[n].cast("bigint").alias(f"_r_{n}") for n in names])
    # a sketch over evenly spaced probabilities brackets any rank without knowing it in advance
    steps = 1000
    grid = [i / steps for i in range(steps + 1)]
    sketch = slim.groupBy(*keys).agg(F.percentile_approx(F.col(order), grid, _ACCURACY).alias("_grid"))
    info = join_on_keys(asked, sketch, list(keys))
    for n in names:  # NULL order values come first, the sketch has the others
        share = F.greatest(F.col(f"_r_{n}") - F.col("_nulls"), F.lit(0)) / F.greatest(F.col(size) - F.col("_nulls"), F.lit(1)) * steps
        info = info.withColumn(
            f"_lo_{n}", F.element_at("_grid", F.greatest(F.floor(share) - 1, F.lit(0)).cast("int") + 1)
        ).withColumn(
            f"_hi_{n}", F.element_at("_grid", F.least(F.ceil(share) + 1, F.lit(steps)).cast("int") + 1)
        )
    info = lookup(info.drop("_grid"), "rank-info")
    tagged = join_on_keys(slim, info, list(keys))

    def among_nulls(n: str) -> Column:
        return F.col(f"_r_{n}") <= F.col("_nulls")

    below = tagged.groupBy(*keys).agg(*[
        F.count(F.when(~among_nulls(n) & (F.col(order).isNull() | (F.col(order) < F.col(f"_lo_{n}"))), 1)).alias(f"_b_{n}") for n in names
    ])
    near = tagged.select(
        *keys, order, tie,
        F.explode(F.array_compact(F.array(*[
            F.when(
                F.when(among_nulls(n), F.col(order).isNull()).otherwise(F.col(order).between(F.col(f"_lo_{n}"), F.col(f"_hi_{n}"))), F.lit(n)
            ) for n in names
        ]))).alias("_which"),
    )
    ranked = row_numbers(stage(near, "rank-near"), [*keys, "_which"], [order, tie], "_rn")
    wanted = join_on_keys(info, below, list(keys)).select(
        *keys,
        F.explode(F.array(*[
            F.struct(F.lit(n).alias("_which"), (F.col(f"_r_{n}") - F.col(f"_b_{n}")).alias("_at")) for n in names
        ])).alias("w"),
    ).select(*keys, "w.*")
    hits = join_on_keys(ranked, wanted, [*keys, "_which"]).filter(F.col("_rn") == F.col("_at"))
    found = hits.groupBy(*keys).agg(*[F.max(F.when(F.col("_which") == n, pair)).alias(n) for n in names])
    return lookup(join_on_keys(info.select(*keys, size), found, list(keys), "left"), "rank-found")
