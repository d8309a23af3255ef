"""Benchmark decontamination by winnowing.

Of every window of consecutive k-gram hashes the least is kept as a fingerprint. Two texts that share a run of
``WINDOW_WORDS`` words share all k-grams of it, so both keep the same least one, and no such run can be missed. The
fingerprints of documents and items are joined, and each hit is extended to the windows around it, which are compared
by their words. Items shorter than a window count as a whole; each such length has k-grams of its own.

A bitmap of fixed size keeps out of the join what no item has, so documents send little more than their hits. However
many items or documents share a passage, joins are many-to-one: a passage is one window, and the items it occurs in
are a set that windows and documents refer to.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycast.llm.words import Words, hash_words, in_byte_slices, mix
from tallycast.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words of a window, and of the k-grams fingerprints are taken from. Every window has WINDOW_WORDS - GRAM_WORDS + 1.
WINDOW_WORDS, GRAM_WORDS = 10, 5
#: Bits of the bitmap of fingerprints, as a power of two: 4 MB, whatever the number of items.
FILTER_BITS = 25
_PER_BUCKET = 32_768  # bits of one bitmap of Spark's bitmap functions

_PASS = "row_key long, doc_id long, n_words long, at long, n int, print long, words array<string>"
_PASS_ARROW = pa.schema(
    [("row_key", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("at", pa.int64()), ("n", pa.int32()), ("print", pa.int64()), ("words", pa.list_(pa.string()))]
)


def _grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all k-grams, and for each word how many words of its text follow, itself included."""
    left = np.repeat(words.first[1:], words.counts) - np.arange(len(words.hashes))
    n = max(len(words.hashes) - k + 1, 0)
    total = np.full(n, k, np.uint64)
    for j in range(k):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + words.hashes[j : j + n])
    return total, left


def fingerprints(words: Words, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the k-grams that are the least of a window of ``window`` words, the last of equal ones."""
    grams, left = _grams(words, k)
    starts = np.flatnonzero(left >= window)
    if not len(starts):
        return starts, grams[:0]
    at = starts + window - k
    least = grams[at]
    for j in range(window - k - 1, -1, -1):
        other = grams[starts + j]
        lower = other < least
        least = np.where(lower, other, least)
        at = np.where(lower, starts + j, at)
    at = np.unique(at)
    return at, grams[at]


def _all_fingerprints(words: Words, short: list[int]):
    """(window, k, positions, hashes) for whole windows and each short length."""
    yield WINDOW_WORDS, GRAM_WORDS, *fingerprints(words, WINDOW_WORDS, GRAM_WORDS)
    for n in short:
        yield n, n, *fingerprints(words, n, n)


def _item_rows(batches):
    """Windows (``words``) and fingerprints (``print``) of items, with ``n``, the length of the window."""
    for part in in_byte_slices(batches, 1):
        ids = part.column(0).to_pylist()
        words = hash_words(part.column(1))
        out: list[tuple] = []
        counts = words.counts
        for k, item in enumerate(ids):
            a, n = int(words.first[k]), int(counts[k])
            if n:
                own = words.between(a, a + n)
                size = min(n, WINDOW_WORDS)
                out += [(item, size, None, " ".join(own[j : j + size])) for j in range(n - size + 1)]
        short = sorted({int(n) for n in counts if 0 < n < WINDOW_WORDS})
        for n, _, at, prints in _all_fingerprints(words, short):
            own = np.searchsorted(words.first, at, "right") - 1
            fit = counts[own] == n if n < WINDOW_WORDS else np.ones(len(at), bool)
            out += [(ids[k], n, p, None) for k, p in zip(own[fit].tolist(), prints[fit].view(np.int64).tolist())]
        if out:
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["item", "n", "print", "window"])


def _document_rows(short: list[int], bitmap):
    """A base row for each text, and one for each of its fingerprints that the bitmap has, with the words around it."""

    def run(batches):
        bits = bitmap.value
        row = TaskContext.get().partitionId() << 40
        for part in in_byte_slices(batches, 1):
            ids, words = part.column(0).to_pylist(), hash_words(part.column(1))
            out = [(row + k, i, n, None, None, None, None) for k, (i, n) in enumerate(zip(ids, words.counts.tolist()))]
            for n, k, at, prints in _all_fingerprints(words, short):
                place = (prints & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
                likely = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                at, prints = at[likely], prints[likely]
                own = np.searchsorted(words.first, at, "right") - 1
                low = np.maximum(words.first[own], at - (n - k))
                high = np.minimum(words.first[own + 1], at + n)
                begin = low - words.first[own]
                for d, a, b, s, p in zip(own.tolist(), low.tolist(), high.tolist(), begin.tolist(), prints.view(np.int64).tolist()):
                    out.append((row + d, None, None, s, n, p, words.between(a, b)))
                    if len(out) > 20_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _PASS_ARROW.types)], schema=_PASS_ARROW)
                        out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _PASS_ARROW.types)], schema=_PASS_ARROW)
            row += part.num_rows

    return run


def _bitmap(prints: DataFrame) -> np.ndarray:
    """The low bits of all fingerprints as one bitmap of ``2 ** FILTER_BITS`` bits, merged by Spark."""
    low = prints.select(F.col("print").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)).alias("low"))
    parts = low.groupBy(F.shiftright("low", 15).cast("int").alias("bucket")).agg(F.bitmap_construct_agg(F.col("low") % _PER_BUCKET).alias("bits"))
    whole = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for r in parts.collect():  # at most 2 ** FILTER_BITS / _PER_BUCKET rows of 4 KB
        at = r["bucket"] * (_PER_BUCKET // 8)
        whole[at : at + len(r["bits"])] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return whole


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """What each row of ``docs`` shares with the items of ``benchmark``.

    Returns a row for each document (``doc_id``, ``n_words``, ``spans``: word ranges ``start`` to ``end``, end
    exclusive, that windows of items cover, merged; ``item_set``, null where there are none) and the item sets
    (``item_set``, ``items``: ids as strings, in order).

    Null and wordless texts have no words and no hits, on either side. Rows of the same item id are one item; an item
    without an id marks words but is not listed. Documents may have null or repeated ids; each row has a result.
    Texts of any length are read whole. Other columns are not looked at. Without items nothing is hit, without
    documents there are no rows. Document ids are whole numbers.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"), F.col(f"`{item_text}`").alias("text"))
    items = cut_lineage(items.mapInArrow(_item_rows, "item string, n int, print long, window string"), "bench-items")
    prints = cut_lineage(items.filter("print IS NOT NULL").select("n", "print").distinct(), "bench-prints")
    short = sorted(r["n"] for r in prints.select("n").distinct().collect() if r["n"] < WINDOW_WORDS)
    bitmap = spark.sparkContext.broadcast(_bitmap(prints))

    # windows by their words; those that occur in the same items refer to one set
    within = items.filter("window IS NOT NULL").select("n", "window", "item").distinct()
    sets = within.groupBy("n", "window").agg(
        F.concat_ws(":", F.count("item"), F.bit_xor(F.xxhash64(F.lit(1), "item")), F.bit_xor(F.xxhash64(F.lit(2), "item"))).alias("set")
    )
    windows = cut_lineage(sets, "bench-windows")
    members = within.join(windows, ["n", "window"]).filter("item IS NOT NULL").select("set", "item").distinct()
    members = cut_lineage(members, "bench-sets")

    # one pass over the texts; as its rows are stored, a row's number cannot change
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    read = cut_lineage(texts.mapInArrow(_document_rows(short, bitmap), _PASS), "bench-documents")
    base = read.filter("n IS NULL").select("row_key", "doc_id", "n_words")
    near = read.filter("n IS NOT NULL").select("row_key", "at", "n", "print", "words")
    near = near.join(prints, ["n", "print"], "left_semi")
    around = F.expr("inline(transform(sequence(0, size(words) - n), i -> struct(at + i as start, array_join(slice(words, i + 1, n), ' ') as window)))")
    extended = near.select("row_key", "n", "words", "at", around).select("row_key", "n", "start", "window").distinct()
    hits = extended.join(windows, ["n", "window"]).select("row_key", "start", (F.col("start") + F.col("n")).alias("end"), "set")
    hits = cut_lineage(hits, "bench-hits")

    # overlapping windows of a document become one span
    ahead = Window.partitionBy("row_key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    parted = hits.select("row_key", "start", "end").distinct().withColumn("opens", F.col("start") > F.coalesce(F.max("end").over(ahead), F.lit(-1)))
    span = F.count_if("opens").over(Window.partitionBy("row_key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0))
    spans = parted.withColumn("span", span).groupBy("row_key", "span").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    spans = spans.groupBy("row_key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))

    # documents with the same sets share one list of items
    told = hits.groupBy("row_key").agg(F.array_sort(F.collect_set("set")).alias("sets")).withColumn("item_set", F.sha2(F.array_join("sets", " "), 256))
    told = cut_lineage(told.join(spans, "row_key"), "bench-told")
    lists = told.select("item_set", "sets").dropDuplicates(["item_set"]).select("item_set", F.explode("sets").alias("set"))
    lists = lists.join(members, "set").select("item_set", "item").distinct()
    lists = lists.groupBy("item_set").agg(F.sort_array(F.collect_list("item")).alias("items"))
    found = base.join(told.drop("sets"), "row_key", "left")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return found.select("row_key", "doc_id", "n_words", F.coalesce("spans", none).alias("spans"), "item_set"), lists


def words_hit(spans: Column) -> Column:
    """How many words the spans cover."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def with_items(found: DataFrame, lists: DataFrame, *about: Column) -> DataFrame:
    """``found`` with columns ``about`` the items of each row's set; they are null where there is no set or no id."""
    # no two rows without a set share a key
    key = F.coalesce("item_set", F.concat(F.lit("none "), F.col("row_key").cast("string")))
    return found.withColumn("item_set", key).join(lists.select("item_set", *about), "item_set", "left").drop("item_set")
