"""Exact duplicates by distributed most-significant-digit radix partitioning.

A group of texts is split by its next bytes, again and again, until a part has one text or its texts have ended.
Texts that end in the same part had equal bytes throughout, so equality needs no digest. A digit is a run of bytes;
digits grow so that long texts need few rounds, up to a width that bounds what a row carries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.llm.common import stored_rows
from tallycast.session import cut_lineage

SPACE = r"[\x20\x09-\x0D]+"
FIRST_BYTES = 256
GROWTH = 8
WIDEST_BYTES = 1 << 20


def normal_text(text: Column) -> Column:
    """Every run of white space becomes one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _split(active: DataFrame, stage: int) -> tuple[DataFrame, DataFrame]:
    """One round: the parts with several rows, and the rows of ``active`` that are alone in theirs."""
    key = ["part", "digit", "ended"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id"))
    parts = active.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), first.alias("first")).filter("n > 1")
    # stored, so that Spark knows its size, and can split a part that holds a large share of the rows
    parts = cut_lineage(parts, f"radix-parts-{stage}")
    return parts, active.join(parts.select(*key), key, "left_anti")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Groups of equal normalised texts: the stored rows and, for each of them, a verdict.

    A verdict has ``row_id``, ``doc_id``, ``keep_id`` (smallest id of the group), ``group_size``, ``kept`` and
    ``text_sha256``. Null texts equal empty ones. Null ids come after all others; among rows that share the smallest id
    only one is kept. An empty table gives no verdicts.
    """
    body = F.encode(normal_text(F.col(f"`{text_col}`")), "UTF-8")
    rows = stored_rows(
        docs,
        "radix-rows",
        doc_id=F.col(f"`{id_col}`"),
        digit=F.substring(body, 1, FIRST_BYTES),
        ended=F.length(body) <= FIRST_BYTES,
        text_sha256=F.sha2(body, 256),
    )
    about = ["row_id", "doc_id", "text_sha256"]
    head = rows.select(*about, F.lit(0).cast("long").alias("part"), "digit", "ended")
    parts, alone = _split(head, 0)
    done = [_verdicts(alone.select(*about))]
    rest = F.encode(normal_text(F.col(f"row.`{text_col}`")), "UTF-8")
    active = rows.select(*about, F.lit(0).cast("long").alias("part"), "digit", "ended", rest.alias("body"))
    offset, width, stage = FIRST_BYTES, FIRST_BYTES, 0
    while True:
        stage += 1
        # by key at every size, as a large corpus needs it: its parts are too many to send to every task
        joined = active.join(parts.hint("merge"), ["part", "digit", "ended"])
        finished = joined.filter("ended").select(*about, "n", "first")
        done.append(_verdicts(cut_lineage(finished, f"radix-ended-{stage}")))
        width = min(width * GROWTH, WIDEST_BYTES)
        begin = 1 + (offset if stage == 1 else 0)
        offset = 0  # the body loses the bytes that are done with
        remaining = F.expr(f"substring(body, {begin})")
        active = joined.filter("NOT ended").select(*about, F.col("first.row_id").alias("part"), remaining.alias("body"))
        digit, ended = F.substring("body", 1, width), F.length("body") <= width
        active = active.select(*about, "part", digit.alias("digit"), ended.alias("ended"), F.expr(f"substring(body, {width + 1})").alias("body"))
        active = cut_lineage(active, f"radix-active-{stage}")
        if active.isEmpty():
            break
        parts, alone = _split(active.drop("body"), stage)
        done.append(_verdicts(alone.select(*about)))
    verdicts = done[0]
    for more in done[1:]:
        verdicts = verdicts.unionByName(more)
    return rows, verdicts


def _verdicts(rows: DataFrame) -> DataFrame:
    """Verdicts of rows that are alone (without ``first``) or in a group whose ``first`` row stays."""
    if "first" not in rows.columns:
        rows = rows.select("*", F.lit(1).cast("long").alias("n"), F.struct("doc_id", "row_id").alias("first"))
    return rows.select(
        "row_id",
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        F.col("n").cast("long").alias("group_size"),
        (F.col("row_id") == F.col("first.row_id")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose normalised text an earlier id has."""
    rows, verdicts = exact_groups(docs, id_col, text_col)
    dropped = cut_lineage(verdicts.filter("NOT kept").select("row_id"), "radix-dropped")
    return rows.join(dropped, "row_id", "left_anti").select("row.*")
