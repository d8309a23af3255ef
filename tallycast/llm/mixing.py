"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact cuts, epochs.

DataFrame functions only. Every source is laid out in hash order and read from its start until its budget is spent;
a budget above the source's size starts the source anew. Budgets are met to the word: the document at the cut gives
its first words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.llm.common import hash_bucket, numbered, prefix_starts, running_before
from tallycast.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: A source is repeated at most so often.
MAX_EPOCHS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    """Sorts like the source by code point with null last, and is never null."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def source_targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``totals`` (source_key, source_size) with ``target``: shares by weight, none above ``max_epochs`` sizes.

    What a full source cannot take goes to the others by weight. The common share per unit of weight rises until no
    further source is full; each round is one aggregate, whatever the number of sources.
    """
    sources = numbered(totals, "source_key", "mix-sources")
    turn = F.col("position") % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    sources = sources.withColumn("weight", weight).withColumn("most", F.col("source_size") * float(max_epochs))
    sources = cut_lineage(sources.drop("position"), "mix-weights")
    total, weighed = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    share = float(total or 0) / float(weighed or 1)
    while True:
        full = F.col("most") <= F.lit(share) * F.col("weight")
        taken, left = sources.agg(F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))).first()
        new = (float(total or 0) - (taken or 0.0)) / left if left else share
        if new <= share:
            break
        share = new
    return sources.select("source_key", "source_size", F.least("most", F.lit(share) * F.col("weight")).alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    carry: bool = False,
) -> DataFrame:
    """How many words the mix takes of each document.

    Returns ``doc_id``, ``size`` (words, 0 for null), ``source_size``, ``target`` (of the source) and ``taken``; with
    ``carry`` also ``row``, all columns of ``docs``. A null source is a source of its own, sorted last. Documents with
    the same id lie next to each other in the order, by size and text hash; equal rows share no row of the result.
    Empty texts take part with size 0. An empty table gives an empty mix.
    """
    text, source = F.col(f"`{text_col}`"), F.col(f"`{source_col}`")
    base = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        word_count(text).alias("size"),
        _source_key(source).alias("source_key"),
        F.xxhash64(F.lit(6), F.col(f"`{id_col}`")).alias("key"),
        F.xxhash64(text).alias("tie"),
        *([F.struct("*").alias("row")] if carry else []),
    ).withColumn("bucket", hash_bucket("key"))
    base = cut_lineage(base, "mix-rows")
    group = ["source_key"]
    totals = base.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    targets = cut_lineage(source_targets(totals, weights, max_epochs), "mix-targets")
    starts = cut_lineage(prefix_starts(base, group, "bucket", "size").join(targets, "source_key"), "mix-starts")
    ahead = running_before("size", group, "bucket", ["key", "doc_id", "size", "tie"])
    placed = base.withColumn("ahead", ahead).join(starts, ["source_key", "bucket"])
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    left = budget - epochs * F.col("source_size") - F.col("start") - F.col("ahead")
    last = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left))
    return placed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (epochs * F.col("size") + last).cast("long").alias("taken"),
        *(["row"] if carry else []),
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix has them: whole documents, repeated once for each epoch that takes them.

    The document at a source's cut comes in when at least half of it lies before the cut, since texts stay whole.
    Documents without words are in once.
    """
    taken = mix(docs, carry=True, **options)
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(F.lit(1)).cast("int")
    copies = taken.withColumn("times", times).filter("times > 0")
    return copies.select("row", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("copy")).select("row.*")
