"""Running aggregates that survive a hot key.

A plain window puts every row of a key into one task. Here the rows of a key are cut into
blocks along the order (``block`` must not decrease with the order columns). A window runs
inside each (key, block); block totals, one small row per (key, block), are accumulated along
the key and added back by an equi-join, so a key with a third of all rows still spreads over
as many tasks as it has blocks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusframe.session import materialize


def _totals(kind: str, value: Column, order: Column) -> Column:
    if kind == "sum":
        return F.sum(value)
    if kind == "max":
        return F.max(value)
    if kind == "min":
        return F.min(value)
    if kind == "last":
        return F.max_by(value, F.when(value.isNotNull(), order))
    raise ValueError(kind)


def _over(kind: str, value: Column, window) -> Column:
    if kind == "sum":
        return F.sum(value).over(window)
    if kind == "max":
        return F.max(value).over(window)
    if kind == "min":
        return F.min(value).over(window)
    return F.last(value, ignorenulls=True).over(window)


def _combine(kind: str, carry: Column, inner: Column) -> Column:
    if kind == "sum":
        return F.coalesce(carry, F.lit(0)) + F.coalesce(inner, F.lit(0))
    if kind == "max":
        return F.greatest(carry, inner)
    if kind == "min":
        return F.least(carry, inner)
    return F.coalesce(inner, carry)


def evaluated_once(df: DataFrame, *columns: str) -> DataFrame:
    """Rows behind one exchange by ``columns`` that all users of the result share.

    A metrics node keeps the optimizer from pruning or filtering the branches of a plan differently below
    it, so they all start at the same exchange and what is under it runs once.
    """
    return df.repartition(*columns).observe(f"shared-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    block: Column,
    aggs: dict[str, tuple[str, Column]],
    exclusive: bool = False,
    reverse: bool = False,
) -> DataFrame:
    """Append running ``sum`` / ``max`` / ``min`` / ``last`` columns.

    Keys and order columns must be free of nulls and the order total within a key.
    ``exclusive`` leaves the current row out; ``reverse`` runs from the end.
    """
    rest = [c for c in df.columns if c not in keys and c not in order and c not in aggs]
    src = df.select(
        *keys, *order, block.alias("_blk"), *[value.alias(f"_v_{n}") for n, (_, value) in aggs.items()],
        *([F.struct(*[F.col(c) for c in rest]).alias("_rest")] if rest else []),
    )
    src = evaluated_once(src, *keys, "_blk")
    vals = {name: (kind, F.col(f"_v_{name}")) for name, (kind, _) in aggs.items()}

    def direction(c: str) -> Column:
        return F.col(c).desc() if reverse else F.col(c).asc()

    inner_w = (
        Window.partitionBy(*keys, "_blk")
        .orderBy(*[direction(c) for c in order])
        .rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    )
    inner = src.select("*", *[_over(k, v, inner_w).alias(f"_i_{n}") for n, (k, v) in vals.items()])

    order_key = F.struct(*[F.col(c) for c in order])
    if reverse and any(k == "last" for k, _ in vals.values()):
        raise ValueError("last runs forward only")
    totals = src.groupBy(*keys, "_blk").agg(*[_totals(k, v, order_key).alias(f"_t_{n}") for n, (k, v) in vals.items()])
    block_order = F.col("_blk").desc() if reverse else F.col("_blk").asc()
    outer_w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    outer_w = outer_w.orderBy(block_order).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        *keys, "_blk", *[_over(k, F.col(f"_t_{n}"), outer_w).alias(f"_c_{n}") for n, (k, _) in vals.items()]
    )
    out = inner.join(carry, [*keys, "_blk"], "left")
    return out.select(
        *[F.col(f"_rest.`{c}`").alias(c) if c in rest else F.col(c) for c in df.columns if c not in aggs],
        *[_combine(k, F.col(f"_c_{n}"), F.col(f"_i_{n}")).alias(n) for n, (k, _) in vals.items()],
    )


def left_lookup(rows: DataFrame, table: DataFrame, keys: list[str], spread: list[str], blanks: bool = False) -> DataFrame:
    """Left join by keys in which rows without a key do not all meet in one task.

    A null key (with ``blanks`` also an empty text) matches nothing, so such rows are spread by the values of ``spread``.
    The zero that marks the others is computed from the keys: a constant would be taken out of the keys of the join.
    """
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull() | ((F.col(k) == "") if blanks else F.lit(False))
    none = F.pmod(F.xxhash64(*keys), F.lit(1).cast("bigint"))
    salted = rows.withColumn("_apart", F.when(missing, F.xxhash64(*spread)).otherwise(none))
    return salted.join(table.withColumn("_apart", none), [*keys, "_apart"], "left").drop("_apart")


def with_rank(ordered: DataFrame, name: str = "rank") -> DataFrame:
    """Place of each row, from 1, in a globally sorted table.

    Partitions of a sort follow each other, so a place is the rows of the partitions before plus the
    place inside; the sorted rows are written once, as both parts must see the same partitions.
    """
    rows = materialize(ordered.withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftright("_m", 33)
    sizes = rows.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    inside = F.col("_m") - F.shiftleft(part, 33) + 1
    return rows.withColumn("_p", part).join(before, "_p").withColumn(name, inside + F.col("_b")).drop("_m", "_p", "_b")


def position_block(column: str, shift: int = 16) -> Column:
    """Block of an integer position: 2**shift neighbouring positions."""
    return F.shiftright(F.col(column), shift)


def magnitude_block(column: str, steps: int = 16) -> Column:
    """Block of a number (non-decreasing in the value, NaN last).

    ``steps`` blocks per doubling below 1/64 and above 1, blocks of 1/4096 between, where p-values crowd; zero has
    a block of its own and negative numbers mirror the positive ones.
    """
    x = F.abs(F.col(column))
    size = F.when(x < 1 / 64, F.floor(F.log2(x) * steps)).when(x <= 1, F.floor(x * 4096)).otherwise(4096 + F.floor(F.log2(x) * steps)).cast("bigint")
    far = F.lit(10_000_000).cast("bigint")
    return F.when(F.isnan(column), far * 2).when(F.col(column) == 0, -far).when(F.col(column) < 0, -2 * far - size).otherwise(size)
