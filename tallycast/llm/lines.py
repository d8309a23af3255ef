"""Repeated line runs by a distributed suffix array.

Texts are sequences of line ids. Only lines that occur more than once have an id; any other line ends every match. The
suffixes that start at such lines are sorted by prefix doubling: ranks by the first h lines and the ranks h lines on
give ranks by the first 2 h lines, until every suffix stands alone. A suffix that has its own rank, or whose next h
lines leave the shared ones, takes no further part. Neighbours' longest common prefixes follow from the round that
parted them and a descent over the ranks of the rounds before. Intervals of suffixes with a common prefix are the
repeated runs; every occurrence but the first is a later copy, and its lines are deleted.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycast.llm.common import discard, numbered, stored_rows
from tallycast.llm.mixing import word_count
from tallycast.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A run counts from so many lines on, and shorter ones if they have so many words.
RUN_LINES, RUN_WORDS = 3, 50
#: Suffixes in a block when interval starts are carried on.
BLOCK = 1 << 20


def shared_lines(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The stored rows, and their lines that occur more than once: ``row_id``, ``doc_id``, ``pos``, ``rank``, ``words``.

    ``rank`` is the number of shared lines with a smaller id. A line's id is a 128-bit hash of it.
    """
    rows = stored_rows(docs, "line-rows")
    text = F.col(f"row.`{text_col}`")
    each = rows.select("row_id", F.col(f"row.`{id_col}`").alias("doc_id"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    each = each.select("row_id", "doc_id", "pos", F.xxhash64("line").alias("x"), F.xxhash64(F.lit(4), "line").alias("y"), word_count(F.col("line")).alias("words"))
    each = cut_lineage(each, "line-ids")
    shared = each.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = cut_lineage(numbered(shared, ["x", "y"], "line-order", F.col("n")).select("x", "y", F.col("position").alias("rank")), "line-ranks")
    found = cut_lineage(each.join(shared, ["x", "y"]).drop("x", "y"), "line-shared")
    discard(each)
    return rows, found


def _parted(batches):
    """Where in a sorted range each row's group by rank, and by rank and next, starts; -1 if before its first row."""
    batches = list(batches)
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    rank = np.asarray(table.column("rank").combine_chunks())
    after = table.column("after").combine_chunks()
    ended = np.asarray(after.is_null())
    after = np.asarray(after.fill_null(-1))
    index = np.arange(len(rank))
    new = np.r_[False, rank[1:] != rank[:-1]]
    parts = ended | new | np.r_[False, (after[1:] != after[:-1])] | np.r_[False, ended[:-1]]
    group_start = np.maximum.accumulate(np.where(new, index, -1))
    part_start = np.maximum.accumulate(np.where(parts, index, -1))
    then = pa.array(np.r_[parts[1:], False], mask=index == len(rank) - 1)
    made = [pa.array(index), pa.array(group_start), pa.array(part_start), then, pa.array(np.full(len(rank), TaskContext.get().partitionId()))]
    names = ["row_id", "pos", "rank", "after"]
    table = pa.table([*(table.column(c) for c in names), *made], [*names, "idx", "group_start", "part_start", "then_parts", "range_id"])
    yield from table.to_batches(max_chunksize=65536)


def _carried(ranges: DataFrame) -> DataFrame:
    """For each range where it starts and which groups go on into it; a row per range, on the driver."""
    ends = ranges.groupBy("range_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(F.struct("rank", "after"), "idx").alias("first"),
        F.max_by(F.struct("rank", "after", "group_start", "part_start"), "idx").alias("last"),
    )
    out, base, before = [], 0, None
    for r in sorted(ends.collect(), key=lambda r: r["range_id"]):
        first, last = r["first"], r["last"]
        goes_on = before is not None and before[0] == first["rank"]
        group = before[2] if goes_on else base
        part = before[3] if goes_on and first["after"] is not None and before[1] == first["after"] else base
        if out:
            out[-1][4] = part == base
        out.append([r["range_id"], base, group, part, True])
        before = (
            last["rank"],
            last["after"],
            base + last["group_start"] if last["group_start"] >= 0 else group,
            base + last["part_start"] if last["part_start"] >= 0 else part,
        )
        base += r["n"]
    kinds = "range_id long, base long, group_from long, part_from long, next_parts boolean"
    return F.broadcast(ranges.sparkSession.createDataFrame([tuple(x) for x in out], kinds))


def suffix_array(shared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The suffixes in order (``row_id``, ``pos``, ``rank`` from 0) and, by rank, the lines a suffix shares with the one before.

    ``shared`` has ``row_id``, ``pos`` and the first ``rank`` of its line.
    """
    start = shared.select("row_id", "pos", "rank")
    alone = start.groupBy("rank").agg(F.count(F.lit(1)).alias("n")).select("rank", (F.col("n") > 1).alias("open"))
    opened = cut_lineage(start.join(cut_lineage(alone, "suffix-sizes"), "rank").select("row_id", "pos", "rank", "open"), "suffix-1")
    closed = opened.filter("NOT open")
    bounds = opened.select(F.col("rank"), F.lit(0).cast("long").alias("level")).distinct()
    opened = opened.filter("open")
    levels, h = {}, 1
    while not opened.isEmpty():
        ranks = closed.select("row_id", "pos", "rank").unionByName(opened.select("row_id", "pos", "rank"))
        levels[h] = opened.select("row_id", "pos", "rank")  # a rank of one's own equals no other
        ahead = ranks.select("row_id", (F.col("pos") - h).cast("int").alias("pos"), F.col("rank").alias("after"))
        pairs = opened.select("row_id", "pos", "rank").join(ahead, ["row_id", "pos"], "left")
        order = ["rank", F.col("after").asc_nulls_first(), "row_id", "pos"]
        kinds = "row_id long, pos int, rank long, after long, idx long, group_start long, part_start long, then_parts boolean, range_id long"
        ranges = pairs.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_parted, kinds)
        ranges = cut_lineage(ranges, f"suffix-ranges-{h}")
        own = F.col("base") + F.col("idx")
        part = F.when(F.col("part_start") >= 0, F.col("base") + F.col("part_start")).otherwise(F.col("part_from"))
        group = F.when(F.col("group_start") >= 0, F.col("base") + F.col("group_start")).otherwise(F.col("group_from"))
        parted = ranges.join(_carried(ranges), "range_id").withColumn("own", own).withColumn("part", part).withColumn("group", group)
        single = (F.col("own") == F.col("part")) & F.coalesce("then_parts", "next_parts")
        is_bound = (F.col("own") == F.col("part")) & (F.col("part") > F.col("group"))
        parted = parted.select("row_id", "pos", (F.col("rank") + F.col("part") - F.col("group")).alias("rank"), (~single).alias("open"), is_bound.alias("is_bound"))
        parted = cut_lineage(parted, f"suffix-{2 * h}")
        discard(ranges)
        bounds = bounds.unionByName(parted.filter("is_bound").select("rank", F.lit(h).cast("long").alias("level")))
        closed = closed.unionByName(parted.filter("NOT open").drop("is_bound"))
        opened = parted.filter("open").drop("is_bound")
        h *= 2
    order = closed.select("row_id", "pos", "rank")
    known = bounds.filter("level < 2").select("rank", F.col("level").alias("lcp"))
    deep = bounds.filter("level >= 2").join(order.select("rank", F.col("row_id").alias("row_a"), F.col("pos").alias("pos_a")), "rank")
    before = order.select((F.col("rank") + 1).alias("rank"), F.col("row_id").alias("row_b"), F.col("pos").alias("pos_b"))
    deep = cut_lineage(deep.join(before, "rank").withColumn("lcp", F.col("level")), "suffix-pairs")
    for g in sorted(levels, reverse=True):
        side = lambda s, g=g: levels[g].select(F.col("row_id").alias(f"row_{s}"), F.col("pos").alias(f"at_{s}"), F.col("rank").alias(f"rank_{s}"))
        asked = deep.withColumn("at_a", (F.col("pos_a") + F.col("lcp")).cast("int")).withColumn("at_b", (F.col("pos_b") + F.col("lcp")).cast("int"))
        found = asked.join(side("a"), ["row_a", "at_a"], "left").join(side("b"), ["row_b", "at_b"], "left")
        same = (F.col("level") > g) & F.coalesce(F.col("rank_a") == F.col("rank_b"), F.lit(False))
        deep = found.withColumn("lcp", F.col("lcp") + F.when(same, g).otherwise(0)).select("rank", "level", "row_a", "pos_a", "row_b", "pos_b", "lcp")
    return order, cut_lineage(known.unionByName(deep.select("rank", "lcp")), "suffix-lcp")


def _interval(lcps: DataFrame, depth: int) -> DataFrame:
    """For each rank the first rank of its interval of suffixes that share ``depth`` lines."""
    opens = F.when(F.col("lcp") < depth, F.col("rank"))
    blocks = lcps.select("rank", opens.alias("opens"), F.floor(F.col("rank") / BLOCK).alias("block"))
    last = blocks.groupBy("block").agg(F.max("opens").alias("last"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = last.select("block", F.max("last").over(before).alias("carried"))
    # fine blocks first, so that no task runs over more than a few thousand ranks
    fine = F.floor(F.col("rank") / 4096)
    within = Window.partitionBy("fine").orderBy("rank")
    ends = blocks.groupBy(fine.alias("fine"), "block").agg(F.max("opens").alias("last"))
    ahead = Window.partitionBy("block").orderBy("fine").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("fine", "block", F.max("last").over(ahead).alias("nearer")).join(last, "block").select("fine", F.coalesce("nearer", "carried").alias("carried"))
    run = blocks.withColumn("fine", fine).withColumn("here", F.max("opens").over(within))
    return run.join(ends, "fine").select("rank", F.coalesce("here", "carried").alias("interval"))


def later_copies(shared: DataFrame, run_lines: int = RUN_LINES, run_words: int = RUN_WORDS) -> tuple[DataFrame, DataFrame]:
    """Lines in later copies of repeated runs (``row_id``, ``pos``), and the longest repeated run at each suffix.

    A run counts if it has ``run_lines`` lines, or fewer with ``run_words`` words in all. Of the occurrences of a run the
    one in the smallest document id (null ids last), then row, then line is the first. A run longer than ``run_lines``
    is the union of its windows of that length, so windows decide for all lengths.
    """
    order, lcps = suffix_array(shared)
    array = cut_lineage(order.join(lcps, "rank"), "suffix-array")
    following = lcps.select((F.col("rank") - 1).alias("rank"), F.col("lcp").alias("next_lcp"))
    array = array.join(following, "rank", "left").withColumn("longest", F.greatest("lcp", F.coalesce("next_lcp", F.lit(0))))
    ahead = Window.partitionBy("row_id").orderBy("pos")
    total: Column = F.lit(0)
    sums = []
    for k in range(run_lines):
        total = total + F.coalesce(F.lead("words", k).over(ahead), F.lit(0))
        sums.append(total)
    words = shared.select("row_id", "doc_id", "pos", F.array(*sums).alias("sums"))
    found = cut_lineage(array.join(words, ["row_id", "pos"]), "suffix-words")
    gone = None
    for depth in range(1, run_lines + 1):
        enough = (F.col("longest") >= depth) & ((F.lit(depth) >= run_lines) | (F.element_at("sums", depth) >= run_words))
        runs = found.filter(enough).join(_interval(lcps, depth), "rank")
        runs = cut_lineage(runs.select("interval", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id", "pos").alias("at")), f"runs-{depth}")
        first = cut_lineage(runs.groupBy("interval").agg(F.min("at").alias("first")), f"runs-first-{depth}")
        later = runs.join(first, "interval").filter("at <> first")
        later = later.select("at.row_id", F.explode(F.sequence(F.col("at.pos"), F.col("at.pos") + (depth - 1))).alias("pos"))
        later = cut_lineage(later.distinct(), f"runs-later-{depth}")
        discard(runs)
        gone = later if gone is None else gone.unionByName(later)
    return cut_lineage(gone.distinct(), "lines-gone"), found.select("row_id", "pos", "longest")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """All columns of ``docs`` as ``row``, the text without later copies as ``left_text``, and what was found.

    ``n_lines``; ``deleted``: the numbers of the deleted lines in order; ``longest_run``: lines of the longest run of the
    document that occurs elsewhere too. A null text has no lines and stays null; an empty one has one empty line. Rows
    that repeat an id are documents of their own, the later one a copy. An empty table gives no rows.
    """
    rows, shared = shared_lines(docs, id_col, text_col)
    gone, longest = later_copies(shared, **options)
    per_row = gone.groupBy("row_id").agg(F.sort_array(F.collect_list("pos")).alias("deleted"))  # at most a text's lines
    longest = longest.groupBy("row_id").agg(F.max("longest").alias("longest_run"))
    told = cut_lineage(longest.join(per_row, "row_id", "left"), "lines-told")
    # by key at every size, as a large corpus needs it
    out = rows.join(told.hint("merge"), "row_id", "left")
    text = F.col(f"row.`{text_col}`")
    lines = F.split(text, "\n")
    out = out.withColumn("text", text).withColumn("deleted", F.coalesce("deleted", F.array().cast("array<int>")))
    kept = F.expr("array_join(filter(split(text, '\n'), (line, i) -> NOT array_contains(deleted, i)), '\n')")
    return out.select(
        "row",
        F.when(F.size("deleted") > 0, kept).otherwise(F.col("text")).alias("left_text"),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        "deleted",
        F.coalesce("longest_run", F.lit(0)).cast("long").alias("longest_run"),
    )
