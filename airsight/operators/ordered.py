"""Ordered computations over groups of any size.

``Window.partitionBy(key)`` puts a whole key into one task. That is the right plan while
every key fits, and the functions here use it then. When some key is larger than
``airsight.maxGroupRows`` its rows take a second route: the rows are range-partitioned by
(key, order), so one key spreads over many partitions, and only per-partition
totals (one row per key and partition) travel between them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airsight.session import lookup, max_group_rows, stage

ColumnLike = Column | str

_COMBINE = {
    "sum": (F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))),
    "max": (F.max, F.greatest),
    "min": (F.min, F.least),
}


def large_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """Keys holding more rows than one task should take, or None if there are none."""
    limit = max_group_rows(df.sparkSession)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > limit)
    if sizes.isEmpty():
        return None
    # at most (all rows / limit) keys
    return stage(sizes.select(*keys, "_rows"), "large-groups")


def groups_fit(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether every key fits a task. Steps that keep or drop rows stay within it, so a chain of steps may count its keys
    once and pass the answer on as ``fits``."""
    return large_groups(df, keys) is None


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    match = F.lit(True)
    for k in keys:
        match = match & left[k].eqNullSafe(right[k])
    return match


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a per-key table, NULL keys included; the result has the left columns, then the right ones besides the keys."""
    renamed = right.select(*[F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & F.col(f"`{k}`").eqNullSafe(F.col(f"_key{i}"))
    return left.join(renamed, match, how).drop(*[f"_key{i}" for i in range(len(keys))])


def _split(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> tuple[DataFrame | None, DataFrame]:
    """Rows of ordinary keys and rows of large keys."""
    if not keys:
        return None, df
    match = _same_key(df, hot, keys)
    return df.join(hot, match, "left_anti"), df.join(hot, match, "left_semi")


def _blocks(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnLike]) -> DataFrame:
    """Globally ordered rows with their block (partition) and position inside it."""
    placed = (
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    staged = stage(placed, "blocks")
    return (
        staged.withColumn("_block", F.shiftright("_at", 33))
        .withColumn("_pos", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_at")
    )


def _carry(per_block: DataFrame, keys: Sequence[str], exprs: dict[str, Column]) -> DataFrame:
    """Combine per-block totals of the blocks before each block (one row per key and block)."""
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return per_block.select("*", *[e.over(before).alias(name) for name, e in exprs.items()])


def _join_blocks(blocks: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach the carried totals: one row per key and block, so few even for very long keys."""
    renamed = lookup(
        carry.select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
            F.col("_block").alias("_b"),
            *[c for c in carry.columns if c not in keys and c != "_block"],
        ),
        "carry",
    )
    match = F.col("_block") == F.col("_b")
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return blocks.join(renamed, match, "left").drop("_b", *[f"_k{i}" for i in range(len(keys))])


def row_numbers(
    df: DataFrame, keys: Sequence[str], order: Sequence[ColumnLike], name: str = "rn", total: str | None = None
) -> DataFrame:
    """1-based position of each row in its key, and optionally the size of the key."""
    hot = large_groups(df, keys)
    w = Window.partitionBy(*keys)

    def direct(d: DataFrame) -> DataFrame:
        out = d.withColumn(name, F.row_number().over(w.orderBy(*order)).cast("bigint"))
        return out.withColumn(total, F.count(F.lit(1)).over(w)) if total else out

    if hot is None:
        return direct(df)
    cold_rows, hot_rows = _split(df, hot, keys)
    numbered = _number_large(hot_rows, keys, order, name, total)
    return numbered if cold_rows is None else numbered.unionByName(direct(cold_rows))


def _number_large(
    rows: DataFrame, keys: Sequence[str], order: Sequence[ColumnLike], name: str, total: str | None = None
) -> DataFrame:
    blocks = _blocks(rows, keys, order)
    per_block = blocks.groupBy(*keys, "_block").agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    carry = _carry(per_block, keys, {"_before": F.sum("_n")})
    if total:
        carry = carry.withColumn("_total", F.sum("_n").over(Window.partitionBy(*keys)))
    position = F.col("_pos") - F.col("_first") + F.coalesce("_before", F.lit(0)) + 1
    numbered = _join_blocks(blocks, carry, keys)
    return numbered.select(
        *[F.col(f"`{c}`") for c in rows.columns],
        position.alias(name),
        *([F.col("_total").alias(total)] if total else []),
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[ColumnLike],
    aggs: dict[str, tuple[str, str]],
    fits: bool = False,
) -> DataFrame:
    """Running totals from the first row of the key to the current row.

    ``aggs`` maps an output column to (``sum`` | ``max`` | ``min``, input column). ``order`` must be unique in a key.
    ``fits`` tells that no key can exceed the task limit, which saves counting them.
    """
    hot = None if fits else large_groups(df, keys)

    def direct(d: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return d.select("*", *[_COMBINE[fn][0](c).over(w).alias(out) for out, (fn, c) in aggs.items()])

    if hot is None:
        return direct(df)
    cold_rows, hot_rows = _split(df, hot, keys)
    blocks = _blocks(hot_rows, keys, order).drop("_pos")
    per_block = blocks.groupBy(*keys, "_block").agg(
        *[_COMBINE[fn][0](c).alias(f"_t_{out}") for out, (fn, c) in aggs.items()]
    )
    carry = _carry(per_block, keys, {f"_c_{out}": _COMBINE[fn][0](f"_t_{out}") for out, (fn, _) in aggs.items()})
    carry = carry.drop(*[f"_t_{out}" for out in aggs])
    local = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = _join_blocks(blocks, carry, keys)
    done = joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[_COMBINE[fn][1](F.col(f"_c_{out}"), _COMBINE[fn][0](c).over(local)).alias(out) for out, (fn, c) in aggs.items()],
    )
    return done if cold_rows is None else done.unionByName(direct(cold_rows))


def sliding(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[ColumnLike],
    before: int,
    after: int,
    build: Callable[[WindowSpec], dict[str, Column]],
    fits: bool = False,
) -> DataFrame:
    """Window expressions that look at most ``before`` rows back and ``after`` rows ahead.

    ``build`` receives the ordered window and returns the new columns. A large key is cut into
    chunks of consecutive rows; each chunk also receives the few neighbouring rows its frames can reach.
    """

    def direct(d: DataFrame) -> DataFrame:
        new = build(Window.partitionBy(*keys).orderBy(*order))
        return d.select("*", *[c.alias(n) for n, c in new.items()])

    hot = None if fits else large_groups(df, keys)
    if hot is None:
        return direct(df)
    cold_rows, hot_rows = _split(df, hot, keys)
    spread = _chunks(hot_rows, keys, order, before, after)
    new = build(Window.partitionBy(*keys, "_chunk").orderBy("_rn"))
    done = (
        spread.select("*", *[c.alias(n) for n, c in new.items()])
        .filter(F.col("_home") == F.col("_chunk"))
        .drop("_home", "_chunk", "_rn")
    )
    return done if cold_rows is None else done.unionByName(direct(cold_rows))


def _chunks(
    rows: DataFrame, keys: Sequence[str], order: Sequence[ColumnLike], before: int, after: int
) -> DataFrame:
    """Rows with their position ``_rn`` and own chunk ``_home``, repeated in each ``_chunk`` whose frames reach them."""
    size = max(max_group_rows(rows.sparkSession), before, after, 1)
    numbered = _number_large(rows, keys, order, "_rn")
    chunk = F.floor((F.col("_rn") - 1) / size)
    inside = (F.col("_rn") - 1) % size
    copies = F.array_compact(
        F.array(chunk, F.when(inside >= size - before, chunk + 1), F.when(inside < after, chunk - 1))
    )
    return numbered.withColumn("_home", chunk).withColumn("_chunk", F.explode(copies))


def sliding_arrow(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    before: int,
    after: int,
    compute: Callable[[pa.Table], dict[str, pa.Array]],
    names: Sequence[str],
    fits: bool = False,
) -> DataFrame:
    """Like ``sliding`` for wide frames: ``compute`` gets one ordered group and returns the new double columns ``names``.

    A window function visits every row of a moving frame again for each row; incremental kernels over an
    Arrow table do not, which is an order of magnitude faster for frames of a hundred rows and more.
    """

    def apply_to(d: DataFrame, group: Sequence[str], by: Sequence[str]) -> DataFrame:
        instants = [c for c, kind in d.dtypes if kind == "timestamp"]
        sort_keys = [(c, "ascending") for c in by]

        def per_group(table: pa.Table) -> pa.Table:
            ordered = table.take(pc.sort_indices(table, sort_keys=sort_keys, null_placement="at_start"))
            for name, values in compute(ordered).items():
                ordered = ordered.append_column(name, values)
            for c in instants:  # they come in the time zone of the session and have to go back in UTC, the same instants
                ordered = ordered.set_column(ordered.column_names.index(c), c, ordered[c].cast(pa.timestamp("us", "UTC")))
            return ordered

        new = [T.StructField(n, T.DoubleType()) for n in names]
        return d.groupBy(*group).applyInArrow(per_group, T.StructType([*d.schema.fields, *new]))

    hot = None if fits else large_groups(df, keys)
    if hot is None:
        return apply_to(df, keys, order)
    cold_rows, hot_rows = _split(df, hot, keys)
    spread = _chunks(hot_rows, keys, order, before, after)
    done = apply_to(spread, [*keys, "_chunk"], ["_rn"]).filter("_home = _chunk").drop("_home", "_chunk", "_rn")
    return done if cold_rows is None else done.unionByName(apply_to(cold_rows, keys, order))
