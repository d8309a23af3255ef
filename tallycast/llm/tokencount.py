"""Token counts without token ids.

A vocabulary whose pieces never go on across a space or hold a line break can be applied to one pre-token at a time:
a run of spaces with the word after it, or a line break with the word after it. Pieces are counted once per distinct
pre-token. A document's count is the sum over its pre-token frequencies. The most frequent pre-tokens, a list of
bounded size, are looked up where the text is read; the rest go through a join.
"""

from __future__ import annotations

import re
import sys
from collections import Counter

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.llm.common import in_slices
from tallycast.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Pre-tokens in the list that goes to every task, and the longest of them in characters: 16 MB at most.
FREQUENT, FREQUENT_CHARS = 262_144, 16
#: Distinct pre-tokens a task holds before it passes its counts on.
HELD = 200_000
#: Frequencies are told apart by powers of 2 ** (1 / 8) when the list is chosen.
STEPS = 8
_SPACES = re.compile(" +[^ ]*")
_MARK = "▁"  # stands for a space inside the vocabulary


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text; the one space that precedes all but those after a line break is left out."""
    out: list[str] = []
    for k, line in enumerate(text.replace(_MARK, " ").split("\n")):
        if "  " in line or not k and line.startswith(" "):
            head = line[: line.find(" ")] if k else ""
            rest = line[len(head) :] if k else " " + line
            words = ["\n" + head] * (k > 0) + [p[1:] for p in _SPACES.findall(rest)]
        else:
            words = line.split(" ")
            if k:
                words[0] = "\n" + words[0]
        out += words
    return out


class PieceCounter:
    """Counts the pieces of pre-tokens by the library itself."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_proto=model)

    def check(self) -> None:
        """Refuse a vocabulary whose pieces can reach over the ends of a pre-token."""
        p = self.processor
        for i in range(p.get_piece_size()):
            piece = p.id_to_piece(i)
            if "\n" in piece or re.search(f"[^{_MARK}]{_MARK}", piece):
                raise ValueError(f"piece {piece!r} spans pre-tokens")
        if p.encode("  a") == p.encode(" a") or p.encode("a", out_type=str)[0][0] != _MARK:
            raise ValueError("the model changes white space")

    def count(self, keys: list[str]) -> list[int]:
        # a line break before keeps the pre-token from the text's start; it and the start are two pieces
        whole = [k if k.startswith("\n") else f"\n {k}" for k in keys]
        return [len(ids) - (1 if k.startswith("\n") else 2) for k, ids in zip(keys, self.processor.encode(whole, num_threads=1))]


def _distinct(batches):
    """(piece, freq) of a task's texts, held in bounded memory."""
    seen: Counter = Counter()
    for batch in in_slices(batches):
        for text in batch.column(0).to_pylist():
            if text:
                seen.update(pre_tokens(text))
            if len(seen) > HELD:
                yield pa.RecordBatch.from_pydict({"piece": list(seen), "freq": list(seen.values())})
                seen.clear()
    if seen:
        yield pa.RecordBatch.from_pydict({"piece": list(seen), "freq": list(seen.values())})


def _counts(model: bytes):
    def run(batches):
        counter = PieceCounter(model)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counter.count(keys), pa.int64())], ["piece", "freq", "n"])

    return run


def _per_document(frequent):
    """A base row for each document with what the list covers, and a row for each other pre-token of it.

    Base rows carry a piece that no text can have, different in each, so that the join spreads them.
    """
    schema = pa.schema([("row_key", pa.int64()), ("piece", pa.string()), ("freq", pa.int64()), ("known", pa.int64()), ("n_bytes", pa.int64()), ("doc_id", pa.int64())])

    def run(batches):
        known_pieces = frequent.value
        row = TaskContext.get().partitionId() << 40
        for batch in in_slices(batches):
            texts, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: list[tuple] = []
            for text, doc_id in zip(texts, ids):
                text = text or ""
                total = 0
                if text:
                    for piece, freq in Counter(pre_tokens(text)).items():
                        n = known_pieces.get(piece)
                        if n is None:
                            out.append((row, piece, freq, None, None, None))
                        else:
                            total += n * freq
                out.append((row, f"\x00 {row}", None, total, len(text.encode("utf-8")), doc_id))
                row += 1
                if len(out) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    return run


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8) and ``n_tokens`` of each row.

    ``model_path`` is a sentencepiece BPE model. Null counts as empty, and an empty text has no tokens. Every row has
    its own result, whether its id is null or repeated. An empty table gives no rows. Ids are whole numbers.
    """
    spark = docs.sparkSession
    with open(model_path, "rb") as f:
        model = f.read()
    PieceCounter(model).check()
    texts = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{id_col}`").cast("long").alias("doc_id"))
    distinct = texts.select("text").mapInArrow(_distinct, "piece string, freq long")
    distinct = distinct.groupBy("piece").agg(F.sum("freq").alias("freq"))
    pieces = cut_lineage(distinct.mapInArrow(_counts(model), "piece string, freq long, n long"), "pre-tokens")

    step = F.floor(F.log2("freq") * STEPS).cast("int")
    short = pieces.filter(F.length("piece") <= FREQUENT_CHARS).withColumn("step", step)
    room, least = FREQUENT, 64 * STEPS
    for r in sorted(short.groupBy("step").count().collect(), reverse=True):  # at most 64 * STEPS rows
        room -= r["count"]
        if room < 0:
            break
        least = r["step"]
    listed = short.filter(F.col("step") >= least)
    frequent = spark.sparkContext.broadcast({r["piece"]: r["n"] for r in listed.select("piece", "n").collect()})
    others = pieces.filter((F.length("piece") > FREQUENT_CHARS) | (step < least)).select("piece", "n")

    kinds = "row_key long, piece string, freq long, known long, n_bytes long, doc_id long"
    rows = texts.mapInArrow(_per_document(frequent), kinds)
    counted = rows.join(others, "piece", "left")
    return (
        counted.groupBy("row_key")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_bytes").alias("n_bytes"),
            F.sum(F.coalesce("known", F.col("freq") * F.col("n"))).alias("n_tokens"),
        )
        .drop("row_key")
    )
