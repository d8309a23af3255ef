"""Byte-level BPE by a rank queue with a hierarchical bitmap.

A pre-token starts as a linked list of bytes. Every pair that the vocabulary can merge waits in the bucket of its
rank. A bitmap over the ranks, words of 256 bits under one word that says which are not empty, names the lowest rank
with something waiting by two find-first-set steps. Entries whose pair is gone by the time they come up are skipped.
A pre-token of n bytes costs O(n log n), so very long ones are no danger. Pre-tokens that a task has not met yet share
one queue: they lie side by side, nothing merges across their borders, and each rank comes up once for all of them.
"""

from __future__ import annotations

import base64
import heapq
import re
import sys
from array import array
from collections.abc import Callable
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallycast.llm.common import in_slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Pre-tokens remembered by a task in each of two generations, and the longest that is.
REMEMBERED, REMEMBERED_CHARS = 250_000, 48
#: Matches held at once, and characters of pre-tokens merged at once (a longer pre-token is merged alone).
MATCHES_AT_ONCE, BYTES_AT_ONCE = 1 << 17, 1 << 15
_BITS = [1 << k for k in range(256)]


class RankQueue:
    """Positions waiting by rank; ``pop`` gives the leftmost of the lowest rank.

    ``Codec.merge`` has the same steps written out, as they are its inner loop, and takes a bucket at a time.
    """

    def __init__(self, ranks: int):
        self.words = [0] * (ranks + 255 >> 8)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        waiting = self.buckets.get(rank)
        if waiting is not None:
            heapq.heappush(waiting, position)
            return
        self.buckets[rank] = [position]
        self.words[rank >> 8] |= _BITS[rank & 255]
        self.top |= 1 << (rank >> 8)

    def pop(self) -> tuple[int, int] | None:
        if not self.top:
            return None
        k = (self.top & -self.top).bit_length() - 1
        word = self.words[k]
        bit = word & -word
        rank = (k << 8) + bit.bit_length() - 1
        waiting = self.buckets[rank]
        position = heapq.heappop(waiting)
        if not waiting:
            del self.buckets[rank]
            self.words[k] = word ^ bit
            if word == bit:
                self.top ^= 1 << k
        return rank, position


class Codec:
    """Encodes and decodes with one vocabulary of merge ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            self.pieces[rank] = piece
        self.queue = RankQueue(max(ranks.values()) + 1)
        # white space as Unicode has it, which is what \s means to the library these ids must agree with
        self.pattern = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}"))
        ascii_pattern = pattern.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9").replace(r"[^\s", r"[^\t-\r ")
        ascii_pattern = re.sub(r" \?(A-Za-z|0-9)\+", r" ?[\1]+", ascii_pattern)
        self.ascii_pattern = re.compile(ascii_pattern.replace(r"\s", r"[\t-\r ]"), re.ASCII)
        self.bytes_ids = [ranks.get(bytes([k]), -1) for k in range(256)]
        self.memo: dict[str, bytes] = {}  # ids as 32-bit integers
        self.older: dict[str, bytes] = {}

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each pre-token as 32-bit integers; one queue holds the pairs of all of them.

        A bucket that comes up is worked through from left to right. Should a merge make a pair of a lower rank, the
        rest of the bucket waits for that one.
        """
        get, bits = self.ranks.get, _BITS
        words, buckets, top = self.queue.words, self.queue.buckets, 0
        data = b"".join(pieces)
        n = len(data)
        token = list(map(self.bytes_ids.__getitem__, data))  # the id of the token that starts at a position
        ends = list(range(1, n + 1))  # where that token ends
        before = list(range(-1, n))
        waiting = [-1] * (n + 1)  # the rank of the pair that starts at a position
        outer = bytearray(n + 1)  # where a pre-token starts: nothing merges across
        outer[n] = 1
        at = 0
        for piece in pieces:
            outer[at] = 1
            at += len(piece)
        for i in range(n - 1):
            if outer[i + 1]:
                continue
            rank = get(data[i : i + 2])
            if rank is not None:
                waiting[i] = rank
                there = buckets.get(rank)
                if there is None:
                    buckets[rank] = [i]
                    words[rank >> 8] |= bits[rank & 255]
                    top |= 1 << (rank >> 8)
                else:
                    there.append(i)
        while top:
            k = (top & -top).bit_length() - 1
            word = words[k]
            bit = word & -word
            rank = (k << 8) + bit.bit_length() - 1
            words[k] = word ^ bit
            if word == bit:
                top ^= 1 << k
            there = buckets.pop(rank)
            if len(there) > 1:
                there.sort()
            for done, i in enumerate(there, 1):
                if waiting[i] != rank:
                    continue
                gone = ends[i]
                end = ends[i] = ends[gone]
                token[i] = rank
                waiting[gone] = waiting[i] = -1
                before[end] = i
                lowest = rank
                if not outer[i]:
                    a = before[i]
                    new = get(data[a:end])
                    if new is None:
                        waiting[a] = -1
                    elif waiting[a] != new:
                        waiting[a] = new
                        if new < lowest:
                            lowest = new
                        bucket = buckets.get(new)
                        if bucket is None:
                            buckets[new] = [a]
                            words[new >> 8] |= bits[new & 255]
                            top |= 1 << (new >> 8)
                        else:
                            bucket.append(a)
                if not outer[end]:
                    new = get(data[i : ends[end]])
                    if new is not None:
                        waiting[i] = new
                        if new < lowest:
                            lowest = new
                        bucket = buckets.get(new)
                        if bucket is None:
                            buckets[new] = [i]
                            words[new >> 8] |= bits[new & 255]
                            top |= 1 << (new >> 8)
                        else:
                            bucket.append(i)
                if lowest < rank and done < len(there):
                    buckets[rank] = there[done:]
                    words[rank >> 8] |= bits[rank & 255]
                    top |= 1 << (rank >> 8)
                    break
        out, i = [], 0
        for piece in pieces:
            stop, ids = i + len(piece), array("i")
            while i < stop:
                ids.append(token[i])
                i = ends[i]
            out.append(ids.tobytes())
        return out

    def _learn(self, chunks: list[list[str]]) -> list[str]:
        """Puts every match of ``chunks`` into the memory; returns those that are too long to stay there."""
        if len(self.memo) > REMEMBERED:
            # what has not been met since the last change of generations is forgotten
            self.older, self.memo = self.memo, {}
        memo, older, whole = self.memo, self.older, self.ranks.get
        unmet, size, long = [], 0, []
        for piece in set(chain.from_iterable(chunks)).difference(memo):
            if len(piece) > REMEMBERED_CHARS:
                long.append(piece)
            if (ids := older.get(piece)) is not None:
                memo[piece] = ids
            elif (rank := whole(piece.encode("utf-8"))) is not None:
                memo[piece] = array("i", (rank,)).tobytes()
            else:
                unmet.append(piece)
                size += len(piece)
                if size > BYTES_AT_ONCE:
                    memo.update(zip(unmet, self.merge([p.encode("utf-8") for p in unmet])))
                    unmet, size = [], 0
        memo.update(zip(unmet, self.merge([p.encode("utf-8") for p in unmet])))
        return long

    def packed(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        matches = 0

        def flush():
            long = self._learn([chunk for _, chunk in held])
            ids = self.memo.__getitem__
            for k, chunk in held:
                out[k].append(b"".join(map(ids, chunk)))
            for piece in long:
                del self.memo[piece]
            held.clear()

        for k, text in enumerate(texts):
            if not text:
                continue
            pattern = self.ascii_pattern if text.isascii() else self.pattern
            found = (m.group() for m in pattern.finditer(text)) if len(text) > MATCHES_AT_ONCE else iter(pattern.findall(text))
            while chunk := list(islice(found, MATCHES_AT_ONCE)):
                held.append((k, chunk))
                matches += len(chunk)
                if matches > MATCHES_AT_ONCE:
                    flush()
                    matches = 0
        flush()
        return [b"".join(parts) for parts in out]

    def encode(self, text: str | None) -> list[int]:
        return array("i", self.packed([text])[0]).tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


def read_ranks(path: str) -> bytes:
    """The vocabulary file as it is; it travels to the executors with the task."""
    with open(path, "rb") as f:
        return f.read()


def _codec(vocabulary: bytes, pattern: str) -> Codec:
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
    return Codec(ranks, pattern)


def _apply(df: DataFrame, column: str, keep: list[str], made: dict[str, T.DataType], convert: Callable) -> DataFrame:
    """The columns ``keep`` of ``df`` and what ``convert()`` makes of the values of ``column``, one Python pass for all."""

    def run(batches):
        work = convert()
        for batch in in_slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), *work(batch.column(1))], names=["row", *[f"made_{k}" for k in range(len(made))]])

    given = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{column}`").alias("given"))
    fields = [T.StructField(f"made_{k}", kind) for k, kind in enumerate(made.values())]
    out = given.mapInArrow(run, T.StructType([given.schema["row"], *fields]))
    return out.select("row.*", *[F.col(f"made_{k}").alias(name) for k, name in enumerate(made)])


def _ids_array(packed: list[bytes]) -> pa.Array:
    """Lists of 32-bit integers from their bytes."""
    ends = np.cumsum([0, *map(len, packed)]) // 4
    if ends[-1] >= 1 << 31:
        raise ValueError("a slice of rows has more than 2^31 tokens")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), np.int32)))


_IDS, _BYTES, _FLAG = T.ArrayType(T.IntegerType()), T.BinaryType(), T.BooleanType()


def encode(
    df: DataFrame,
    vocabulary: str,
    pattern: str,
    text_col: str = "text",
    out: str = "ids",
    keep: list[str] | None = None,
    decoded: str | None = None,
    checked: str | None = None,
) -> DataFrame:
    """The columns ``keep`` (all unless named) with the token ids of ``text_col`` in ``out`` (array of int).

    ``vocabulary`` is a file of base64 tokens and ranks, ``pattern`` splits a text into pre-tokens. Special tokens are
    ordinary text. Null and empty texts have no ids. Other columns, null or repeated, pass as they are; one that is named
    like a result is replaced by it. ``decoded`` names a column for the bytes that the ids stand for, ``checked`` one
    that says whether these are the text's; both are decoded in the same pass.
    """
    data = read_ranks(vocabulary)
    made = {out: _IDS} | ({decoded: _BYTES} if decoded else {}) | ({checked: _FLAG} if checked else {})

    def convert():
        codec = _codec(data, pattern)

        def work(given):
            texts = given.to_pylist()
            packed = codec.packed(texts)
            arrays = [_ids_array(packed)]
            if len(made) > 1:
                back = [codec.decode(array("i", ids)) for ids in packed]
                arrays += [pa.array(back, pa.binary())] if decoded else []
                arrays += [pa.array([b == (t or "").encode("utf-8") for b, t in zip(back, texts)], pa.bool_())] if checked else []
            return arrays

        return work

    return _apply(df, text_col, [c for c in (keep or df.columns) if c not in made], made, convert)


def decode(df: DataFrame, vocabulary: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes that ``ids_col`` stands for in ``out``; null or no ids give no bytes."""
    data = read_ranks(vocabulary)

    def convert():
        codec = _codec(data, "")
        return lambda given: [pa.array([codec.decode(ids or ()) for ids in given.to_pylist()], pa.binary())]

    return _apply(df, ids_col, [c for c in df.columns if c != out], {out: _BYTES}, convert)
