"""What the operators of this package share: stored rows, ordered positions, prefix sums."""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycast.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Hash buckets per group of a prefix sum, as a power of two. A group with a third of 10^11 rows then has
#: 8 million rows in a bucket, of which only key and amount are sorted.
BUCKET_BITS = 12

#: Rows of an Arrow batch that Python works on at once. A batch has 10,000, and as Python objects they take several
#: times their bytes.
ROWS_AT_ONCE = 500


def in_slices(batches, rows: int = ROWS_AT_ONCE):
    """The batches in slices that share their memory; what Arrow holds besides is given back in between."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
        pa.default_memory_pool().release_unused()


def stored_rows(docs: DataFrame, purpose: str, **extra: Column) -> DataFrame:
    """``docs`` written to the shared folder as ``row_id``, ``row`` (all columns of docs) and the ``extra`` columns.

    The number identifies a row even where ids are null or repeated. As it is stored, a task that runs again
    elsewhere cannot change it, and as the input columns are nested no name can clash.
    """
    named = [c.alias(k) for k, c in extra.items()]
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.struct("*").alias("row"), *named)
    return cut_lineage(rows, purpose)


def discard(df: DataFrame) -> None:
    """Delete the files of a stored table that no later step reads."""
    files = df.inputFiles()
    if files:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def hash_bucket(key: str, bits: int = BUCKET_BITS) -> Column:
    """The leading bits of a 64-bit hash: rows of one bucket are ordered among themselves by the hash itself."""
    return F.shiftrightunsigned(F.col(key), 64 - bits)


def prefix_starts(rows: DataFrame, group: list[str], bucket: str, amount: str) -> DataFrame:
    """For each (group, bucket) the sum of ``amount`` over the group's earlier buckets, as ``start``.

    Amounts are summed on the map side first; a window then has at most one row for each bucket of a group.
    """
    sums = rows.groupBy(*group, bucket).agg(F.sum(amount).alias("in_bucket"))
    ahead = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*group, bucket, F.coalesce(F.sum("in_bucket").over(ahead), F.lit(0)).cast("long").alias("start"))


def running_before(amount: str, group: list[str], bucket: str, order: list) -> Column:
    """The sum of ``amount`` over the rows ahead in the same bucket."""
    ahead = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(amount).over(ahead), F.lit(0)).cast("long")


def numbered(rows: DataFrame, order: str | list[str], purpose: str, amount: Column | None = None) -> DataFrame:
    """``rows`` with ``position``: how many rows come before by ``order``, without bringing all rows into one task.

    With ``amount`` the sum of that over the rows before. Rows are sorted by range; each range sums up its own and adds
    the sums of the ranges ahead. The ranges are stored, since another run of the same sort may cut them elsewhere.
    """
    order = [order] if isinstance(order, str) else order
    rows = rows.withColumn("amount_here", F.lit(1) if amount is None else amount)
    ranges = cut_lineage(rows.repartitionByRange(*order).withColumn("range_id", F.spark_partition_id()), purpose)
    sizes = ranges.groupBy("range_id").agg(F.sum("amount_here").alias("in_range"))
    ahead = Window.orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("range_id", F.coalesce(F.sum("in_range").over(ahead), F.lit(0)).alias("range_start"))
    within = Window.partitionBy("range_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranges.withColumn("in_order", F.coalesce(F.sum("amount_here").over(within), F.lit(0)))
        .join(starts, "range_id")
        .withColumn("position", (F.col("range_start") + F.col("in_order")).cast("long"))
        .drop("range_id", "in_order", "range_start", "amount_here")
    )
