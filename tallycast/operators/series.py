"""Ordered work inside a series, cut into time blocks.

A window over a whole series puts all its rows into one task. Here every window runs inside (series, time block);
what crosses a block boundary travels through a table with one row per block, which is small.
Series keys and the ordering column must not be NULL, and the ordering must be unique within a series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def month_block(order: str = "datetime") -> Column:
    return F.date_trunc("month", F.col(order))


def _inside(keys: list[str], order: str):
    return Window.partitionBy(*keys, "_block").orderBy(order)


def _inside_backwards(keys: list[str], order: str):
    """What follows a row is read from the end: a frame that grows costs one step per row, one that shrinks many."""
    return Window.partitionBy(*keys, "_block").orderBy(F.desc(order))


def _blocks(keys: list[str]):
    ordered = Window.partitionBy(*keys).orderBy("_block")
    backwards = Window.partitionBy(*keys).orderBy(F.desc("_block"))
    return (
        ordered.rowsBetween(Window.unboundedPreceding, -1),
        backwards.rowsBetween(Window.unboundedPreceding, -1),
        ordered,
    )


def with_position(df: DataFrame, keys: list[str], order: str, block: Column) -> DataFrame:
    """Row number within the series (``_pos``, from 1)."""
    local = df.withColumn("_block", block).withColumn("_pos", F.row_number().over(_inside(keys, order)).cast("long"))
    sizes = local.groupBy(*keys, "_block").agg(F.max("_pos").alias("_rows"))
    earlier, _, _ = _blocks(keys)
    offsets = sizes.select(*keys, "_block", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_skip"))
    return (
        local.join(offsets, [*keys, "_block"])
        .withColumn("_pos", F.col("_pos") + F.col("_skip"))
        .drop("_block", "_skip")
    )


def with_neighbours(df: DataFrame, keys: list[str], order: str, value: str, block: Column) -> DataFrame:
    """Adds ``_pos``, and the nearest known value at or before (``_prev``) and at or after (``_next``) each row.

    Both are structs (pos, value), NULL when there is none. The result stays partitioned by the keys and ``_block``, so
    a later window over these and something finer needs no shuffle.
    """
    inside = _inside(keys, order)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col("_pos").alias("pos"), F.col(value).alias("value")))
    local = (
        df.withColumn("_block", block)
        .withColumn("_pos", F.row_number().over(inside).cast("long"))
        .withColumn("_known", known)
    )
    local = local.withColumns(
        {
            "_prev": F.last("_known", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)),
            "_next": F.last("_known", ignorenulls=True).over(
                _inside_backwards(keys, order).rowsBetween(Window.unboundedPreceding, 0)
            ),
        }
    )
    summary = local.groupBy(*keys, "_block").agg(
        F.max("_pos").alias("_rows"), F.min("_known").alias("_first"), F.max("_known").alias("_last")
    )
    earlier, later, _ = _blocks(keys)
    summary = summary.withColumn("_skip", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))

    def shifted(name: str, offset: Column) -> Column:
        known = F.col(name).isNotNull()
        return F.when(known, F.struct((F.col(f"{name}.pos") + offset).alias("pos"), F.col(f"{name}.value")))

    summary = summary.select(
        *keys,
        "_block",
        "_skip",
        shifted("_first", F.col("_skip")).alias("_first"),
        shifted("_last", F.col("_skip")).alias("_last"),
    )
    summary = summary.select(
        *keys,
        "_block",
        "_skip",
        F.last("_last", ignorenulls=True).over(earlier).alias("_carry_prev"),
        F.last("_first", ignorenulls=True).over(later).alias("_carry_next"),
    )
    joined = local.join(summary, [*keys, "_block"])
    return joined.select(
        *df.columns,
        "_block",
        (F.col("_pos") + F.col("_skip")).alias("_pos"),
        F.coalesce(shifted("_prev", F.col("_skip")), F.col("_carry_prev")).alias("_prev"),
        F.coalesce(shifted("_next", F.col("_skip")), F.col("_carry_next")).alias("_next"),
    )


def with_previous(df: DataFrame, keys: list[str], order: str, value: str, block: Column) -> DataFrame:
    """Adds the previous row's value (``_prev``) and whether the row opens its series (``_opens``)."""
    inside = _inside(keys, order)
    local = df.withColumn("_block", block).withColumns(
        {"_prev": F.lag(value).over(inside), "_head": F.row_number().over(inside) == 1}
    )
    summary = local.groupBy(*keys, "_block").agg(F.max(F.struct(F.col(order), F.col(value).alias("v"))).alias("_end"))
    _, _, ordered = _blocks(keys)
    summary = summary.select(*keys, "_block", F.lag("_end").over(ordered).alias("_carry"))
    return local.join(summary, [*keys, "_block"]).select(
        *df.columns,
        F.when(F.col("_head"), F.col("_carry.v")).otherwise(F.col("_prev")).alias("_prev"),
        (F.col("_head") & F.col("_carry").isNull()).alias("_opens"),
    )


def linear_value(value: str) -> Column:
    """The value itself, or the line between its known neighbours; beyond the last one it is held."""
    before, after = F.col("_prev"), F.col("_next")
    slope = F.try_divide(after["value"] - before["value"], (after["pos"] - before["pos"]).cast("double"))
    return (
        F.when(F.col(value).isNotNull(), F.col(value))
        .when(before.isNull(), after["value"])
        .when(after.isNull(), before["value"])
        .otherwise(before["value"] + slope * (F.col("_pos") - before["pos"]))
    )


def next_value(value: str) -> Column:
    return F.coalesce(F.col(value), F.col("_next.value"))


def interpolate_linear(
    df: DataFrame, keys: list[str], order: str, value: str, block: Column | None = None
) -> DataFrame:
    """Fill gaps linearly by row position; the ends hold the nearest known value."""
    rows = with_neighbours(df, keys, order, value, month_block(order) if block is None else block)
    return rows.withColumn(value, linear_value(value)).select(*df.columns)


def fill_from_next(df: DataFrame, keys: list[str], order: str, value: str, block: Column | None = None) -> DataFrame:
    """Fill each gap with the next known value; a gap at the end stays."""
    rows = with_neighbours(df, keys, order, value, month_block(order) if block is None else block)
    return rows.withColumn(value, next_value(value)).select(*df.columns)
