"""Reading and writing the tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.schema import BUNDLE_PARTITIONS, FORECAST_PARTITIONS, SITES, SUBMISSION_COLUMNS, TARGETS, present

MISSING = "NA"


def read_csv(spark: SparkSession, paths: list[str], schema) -> DataFrame:
    """CSV files with a header, plain or gzipped; columns are matched to the schema by position."""
    return spark.read.schema(schema).option("header", True).option("nullValue", MISSING).csv(paths)


def write_csv(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """CSV with a header, NA for missing values and times a reader without time zone understands."""
    writer = df.write.mode("overwrite").option("header", True).option("nullValue", MISSING)
    writer.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").option("compression", compression).csv(path)


def scan_targets(spark: SparkSession, paths: list[str], project: str, cutoff: Column) -> DataFrame:
    """Published observations of a project after a cutoff, from any number of files."""
    reader = spark.read.schema(TARGETS).option("header", True).option("nullValue", MISSING)
    rows = reader.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(paths)
    return rows.where(
        (F.col("project_id") == project) & (F.col("datetime") > cutoff) & F.col("observation").isNotNull()
    )


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, [path], SITES)


def submission_lines(reader, paths) -> DataFrame:
    """The lines of submitted files, from a batch or a streaming reader, with where each came from."""
    meta = {"path": "file_path", "file": "file_name", "start": "file_block_start"}
    return reader.text(paths).select("value", *[F.col(f"_metadata.{v}").alias(k) for k, v in meta.items()])


def rows_by_header(lines: DataFrame) -> DataFrame:
    """Lines of submitted files as text rows: each file by the names in its own first line.

    Files may have their columns in any order, leave some out or have others besides, however many. ``columns`` lists
    what the row's file has; a column it lacks is NULL in all its rows. Values do not contain line breaks. Blank and NA
    are missing.
    """
    numbered = lines.withColumn("_order", F.monotonically_increasing_id())
    first = F.min(F.struct("start", "_order", "value"))["value"].alias("_header")
    headers = numbered.groupBy("path").agg(first)
    # no file has more columns than its first line has commas, and one more
    widest = headers.agg(F.max(F.size(F.split("_header", ",")))).first()[0] or 1
    fields = ", ".join(f"c{k} string" for k in range(widest))
    parsed = lambda c: F.array(F.from_csv(c, F.lit(fields), {"maxColumns": str(max(widest, 20480))}))
    split = lambda c: F.transform(parsed(c), lambda s: F.array(*[s[f"c{k}"] for k in range(widest)]))[0]
    names = F.transform(split(F.regexp_replace("_header", "^\ufeff", "")), lambda n: F.trim(n))
    headers = headers.withColumn("columns", names)
    rows = lines.join(headers, "path").where((F.col("value") != F.col("_header")) & (F.trim("value") != ""))
    rows = rows.withColumn("_values", split(F.col("value")))

    def value(name: str) -> Column:
        at = F.array_position("columns", name)
        found = F.when(at > 0, F.try_element_at("_values", F.greatest(at, F.lit(1)).cast("int")))
        return F.when(~F.trim(found).isin("", MISSING), found).alias(name)

    present_names = F.filter("columns", lambda n: n.isNotNull())
    return rows.select("path", "file", present_names.alias("columns"), *[value(c) for c in SUBMISSION_COLUMNS])


def read_submissions(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Submitted files as text rows with the name and the columns of the file each came from."""
    return rows_by_header(submission_lines(spark.read, paths))


def read_events(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Sensor event records; ``file_format='avro'`` needs the Avro package on the session's class path."""
    return spark.read.format(file_format).load(path)


def write_partitioned(df: DataFrame, path: str, columns: list[str]) -> None:
    """Hive-partitioned parquet with few files per partition.

    Only partitions present in ``df`` are replaced, so running a batch again gives the same result. Rows are brought
    together by partition as far as tasks stay of even size: a partition that holds most of the rows has many writers.
    """
    keys = present(columns, df)
    even = df.hint("rebalance", *keys)
    even.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_forecasts(df: DataFrame, path: str, **kwargs) -> None:
    write_partitioned(df, path, FORECAST_PARTITIONS, **kwargs)


def write_bundle(df: DataFrame, path: str, **kwargs) -> None:
    write_partitioned(df, path, BUNDLE_PARTITIONS, **kwargs)


#: Touched partitions up to which their names prune the scan of a merge; beyond, the join alone does.
PRUNED_BY_NAME = 10_000


def _files(spark: SparkSession, path: str):
    """The path as its store knows it, and the store."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _beside(folder: str, what: str) -> str:
    return f"{folder.rstrip('/')}.{what}"


def _write_note(spark: SparkSession, path: str, note: str) -> None:
    """A small file that is there whole or not at all."""
    place, files = _files(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.draft")
    out = files.create(draft, True)
    out.write(bytearray(note.encode()))
    out.close()
    files.mkdirs(place.getParent())
    if not files.rename(draft, place):
        raise OSError(f"cannot write {path}")


def _swap(spark: SparkSession, folder: str) -> None:
    """Move what the journal names from the staged folder into the dataset, and note the delivery as done.

    A partition that is no longer staged has been moved before, so the swap can be broken off and repeated anywhere.
    """
    journal, files = _files(spark, _beside(folder, "journal"))
    stream = files.open(journal)
    note = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    stream.close()
    for name in note["partitions"]:
        staged, _ = _files(spark, f"{_beside(folder, 'staged')}/{name}")
        if files.exists(staged):
            place, _ = _files(spark, f"{folder}/{name}")
            files.delete(place, True)
            files.mkdirs(place.getParent())
            if not files.rename(staged, place):
                raise OSError(f"cannot move {staged}")
    if note["delivery"] is not None:
        _write_note(spark, f"{_beside(folder, 'deliveries')}/{note['delivery']}", "")
    files.delete(journal, False)
    files.delete(_files(spark, _beside(folder, "staged"))[0], True)


def recover(spark: SparkSession, folder: str) -> None:
    """Finish a merge that broke off after its content was staged. Readers call it as well as the next merge does."""
    if folder_exists(spark, _beside(folder, "journal")):
        _swap(spark, folder)


def merge_partitions(new: DataFrame, folder: str, columns: list[str], merge, delivery: str | None = None) -> None:
    """Merge a delivery into a stored dataset; only partitions it touches are read and replaced.

    ``merge(new, old)`` gives the new content of those partitions. It is staged in a folder beside. A journal then
    names the staged partitions, and they are moved into place one by one. A run that breaks off before the journal has
    changed nothing; one that breaks off later is finished by :func:`recover`. A ``delivery`` with a name is merged once,
    however often it comes. A dataset has one writer at a time.
    """
    spark = new.sparkSession
    recover(spark, folder)
    if delivery is not None and folder_exists(spark, f"{_beside(folder, 'deliveries')}/{delivery}"):
        return
    old = new.limit(0)
    if folder_exists(spark, folder):
        touched = new.select(*columns).distinct()
        old = spark.read.schema(new.schema).parquet(folder)
        names = touched.limit(PRUNED_BY_NAME + 1).collect()
        if len(names) <= PRUNED_BY_NAME:
            # so few are sent to the stored rows: these are neither shuffled nor sorted by a handful of keys
            touched = F.broadcast(spark.createDataFrame(names, touched.schema))
            for c in columns:
                values = {r[c] for r in names}
                if None not in values:
                    old = old.where(F.col(c).isin(*values))
        on = [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in columns]
        old = old.join(touched.withColumnsRenamed({c: f"_t_{c}" for c in columns}), on, "left_semi").select(*new.columns)
    stage = _beside(folder, "staged")
    place, files = _files(spark, stage)
    files.delete(place, True)  # of a run that broke off before its journal
    write_partitioned(merge(new, old), stage, columns)
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(stage + "/*=*" * len(columns)))
    # partition names of one delivery, which the driver lists for the write as well
    depth = len(columns)
    partitions = ["/".join(f.getPath().toString().split("/")[-depth:]) for f in found or []]
    _write_note(spark, _beside(folder, "journal"), json.dumps({"partitions": sorted(partitions), "delivery": delivery}))
    _swap(spark, folder)


def begin(spark: SparkSession, folder: str) -> bool:
    """Note beside a folder that work on it has begun; whether an earlier run had, and did not come to its :func:`end`."""
    again = folder_exists(spark, _beside(folder, "unfinished"))
    if not again:
        _write_note(spark, _beside(folder, "unfinished"), "")
    return again


def end(spark: SparkSession, folder: str) -> None:
    note, files = _files(spark, _beside(folder, "unfinished"))
    files.delete(note, False)


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether a store that Spark reads has the path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """The size of a file, or of all files below a folder, as its store tells it."""
    place, files = _files(spark, path)
    return files.getContentSummary(place).getLength()


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """The files below a folder of a store, as ``path``; their content is not read. Partition values are unescaped."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return files.load(path).select(F.url_decode(F.regexp_replace("path", "[+]", "%2B")).alias("path"))


def read_dataset(spark: SparkSession, path: str, schema) -> DataFrame:
    """A partitioned dataset with a declared schema: no file is opened to find out its columns."""
    return spark.read.schema(schema).parquet(path)
