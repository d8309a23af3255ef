"""Order statistics that stay spread out when one group holds most of the rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycast.session import cut_lineage

#: Bits of a member's number within its sorted run, and values of a run that are looked at to cut groups into ranges.
RUN_BITS, RUN_SAMPLES = 16, 256


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be NULL, keeping the left key columns."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on: Column = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def _value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    known = df.where(F.col(value).isNotNull())
    return known.groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))


def value_ranks(df: DataFrame, keys: list[str], value: str, quantiles: Mapping[str, float] | None = None) -> DataFrame:
    """Exact ranks: ``_v``, its multiplicity ``_n``, the rows ``_before`` it and the group size ``_m``.

    Equal values are counted before anything is shuffled by group. All groups together are then cut into ranges of
    (group, value), of about equal size whatever the groups' sizes: a small group lies in one range, a large one
    spreads over many, and each task ranks one range. Ranges are stored, since another run of the sort may cut them
    elsewhere. With ``quantiles`` only the ranges that hold a wanted position are ranked.
    """
    counts = _value_counts(df, keys, value)
    ranges = counts.repartitionByRange(*keys, "_v").withColumn("_block", F.spark_partition_id())
    blocked = cut_lineage(ranges, "value-ranges")
    group = Window.partitionBy(*keys)
    running = Window.unboundedPreceding, Window.currentRow
    # a row for each range that a group touches
    totals = blocked.groupBy(*keys, "_block").agg(F.sum("_n").alias("_bn"))
    totals = totals.withColumns(
        {
            "_m": F.sum("_bn").over(group),
            "_skip": F.sum("_bn").over(group.orderBy("_block").rowsBetween(*running)) - F.col("_bn"),
        }
    )
    if quantiles:
        wanted = F.lit(False)
        for q in quantiles.values():
            position = (F.col("_m") - 1) * F.lit(q)
            wanted = wanted | (
                (F.floor(position) < F.col("_skip") + F.col("_bn")) & (F.ceil(position) >= F.col("_skip"))
            )
        totals = totals.where(wanted)
    inside = Window.partitionBy(*keys, "_block").orderBy("_v").rowsBetween(*running)
    return (
        null_safe_join(blocked, totals, [*keys, "_block"])
        .withColumn("_before", F.col("_skip") + F.sum("_n").over(inside) - F.col("_n"))
        .select(*keys, "_v", "_n", "_before", "_m")
    )


def member_run(number: Column, bits: int = RUN_BITS) -> Column:
    """The run of a group's member: ``2 ** bits`` consecutive numbers. A name that is no number has a run of its own;
    members without a name are in the first."""
    return F.shiftright(F.coalesce(number.try_cast("bigint"), F.xxhash64(number)), bits)


def run_ranks(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Exact ranks as in :func:`value_ranks`, from sorted runs (``keys``, ``_run``, ``_x``).

    Evenly spaced values of all runs of a group are sorted, and every ``RUN_SAMPLES``-th of them ends a range of the
    group. By their order such ranges hold about as many members as a run, in whatever way values are spread over the
    runs. Runs are cut at these values, and each range ranks what all runs have in it; a group's ranges are summed up
    from one row each. Nothing is sampled by chance, so a task that runs again cuts the same.
    """
    size = F.size("_x")
    every = F.greatest(F.floor(size / RUN_SAMPLES), F.lit(1)).cast("int")
    spaced = F.transform(F.sequence(every - 1, size - 1, every), lambda i: F.get("_x", i))
    cuts = runs.groupBy(*keys).agg(F.sort_array(F.flatten(F.collect_list(spaced))).alias("_s"))
    ends = F.array_distinct(F.filter("_s", lambda v, i: i % RUN_SAMPLES == RUN_SAMPLES - 1))
    cut = null_safe_join(runs.select(*keys, "_run", "_x"), cuts.select(*keys, ends.alias("_ends")), keys)
    # within a run: its members and the ends of the ranges, a member before an end it equals
    members = cut.select(*keys, "_run", F.explode("_x").alias("_v"), F.lit(0).alias("_end"))
    marks = cut.select(*keys, "_run", F.explode("_ends").alias("_v"), F.lit(1).alias("_end"))
    running = Window.unboundedPreceding, Window.currentRow
    along = Window.partitionBy(*keys, "_run").orderBy("_v", "_end").rowsBetween(*running)
    placed = members.unionByName(marks).withColumn("_range", F.sum("_end").over(along)).where(F.col("_end") == 0)
    counts = placed.groupBy(*keys, "_range", "_v").agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*keys)
    totals = counts.groupBy(*keys, "_range").agg(F.sum("_n").alias("_rn"))
    totals = totals.withColumns(
        {
            "_m": F.sum("_rn").over(group),
            "_skip": F.sum("_rn").over(group.orderBy("_range").rowsBetween(*running)) - F.col("_rn"),
        }
    )
    inside = Window.partitionBy(*keys, "_range").orderBy("_v").rowsBetween(*running)
    return (
        null_safe_join(counts, totals, [*keys, "_range"])
        .withColumn("_before", F.col("_skip") + F.sum("_n").over(inside) - F.col("_n"))
        .select(*keys, "_v", "_n", "_before", "_m")
    )


def quantile_parts(quantiles: Mapping[str, float]) -> dict[str, Column]:
    """Aggregates over ranked rows of a group: its size and the two values around each quantile's position."""
    size = F.col("_m") - 1

    def at(position: Column) -> Column:
        here = (F.col("_before") <= position) & (position < F.col("_before") + F.col("_n"))
        return F.max(F.when(here, F.col("_v")))

    parts = {"_size": F.max("_m")}
    for name, q in quantiles.items():
        parts[f"_lo_{name}"] = at(F.floor(size * F.lit(q)))
        parts[f"_hi_{name}"] = at(F.ceil(size * F.lit(q)))
    return parts


def quantile_values(quantiles: Mapping[str, float]) -> dict[str, Column]:
    """Interpolated quantiles from the result of :func:`quantile_parts`."""
    out = {}
    for name, q in quantiles.items():
        position = (F.col("_size") - 1) * F.lit(q)
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out[name] = low + (high - low) * (position - F.floor(position))
    return out


def quantile_from_ranks(ranks: DataFrame, keys: list[str], quantiles: Mapping[str, float]) -> DataFrame:
    """Interpolated quantiles from (partial) ranks that contain the needed positions."""
    rows = ranks.groupBy(*keys).agg(*[c.alias(n) for n, c in quantile_parts(quantiles).items()])
    return rows.select(*keys, *[c.alias(n) for n, c in quantile_values(quantiles).items()])


def exact_quantiles(df: DataFrame, keys: list[str], value: str, quantiles: Mapping[str, float]) -> DataFrame:
    """Exact interpolated quantiles per group, for groups of any size.

    The built-in exact percentile keeps every distinct value of a group in one task's memory.
    """
    return quantile_from_ranks(value_ranks(df, keys, value, quantiles), keys, quantiles)


def keep_extreme(df: DataFrame, keys: list[str], order: list[Column], *, largest: bool = True) -> DataFrame:
    """One row per key: the one with the largest (or smallest) ordering, remaining ties broken by the row itself.

    An aggregate, not a window: rows are reduced before the shuffle and a busy key needs no sort.
    """
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *[F.col(c) for c in rest])
    best = F.max(packed) if largest else F.min(packed)
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(
        *df.columns
    )
