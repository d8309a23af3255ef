"""Words of whole texts as 64-bit hashes, a column of texts at a time.

A word is a run of ASCII letters, digits and characters beyond ASCII; A-Z are lower-cased. In UTF-8 every byte shows
whether it belongs to a word, so texts are handled as bytes by numpy. Words of up to eight bytes are told apart
exactly, as their hash is a one-to-one function of their bytes; longer ones by 64 bits.
"""

from __future__ import annotations

import hashlib
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of text that are worked on at once. A longer text is cut between two words.
BYTES_AT_ONCE = 2 << 20
#: Words beyond this length are hashed one by one.
LONG_WORD = 1024


def _lowered() -> np.ndarray:
    """For each byte the lower-cased byte if it belongs to a word, else 0."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[:48] = table[58:65] = table[91:97] = table[123:128] = 0
    return table


_TABLE = _lowered()
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit numbers."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of several texts, one after the other."""

    data: np.ndarray  # lower-cased bytes, 0 outside words
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # for each text its first word, and one more
    sizes: np.ndarray  # bytes of each text

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def between(self, a: int, b: int) -> list[str]:
        """Words a to b - 1, all of one text."""
        run = self.data[self.starts[a] : self.ends[b - 1]].tobytes()
        return [w.decode("utf-8") for w in run.split(b"\0") if w]


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``data`` has eight spare bytes at its end."""
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    lengths = ends - starts
    hashes = mix(eight[starts] & _MASKS[np.minimum(lengths, 8)])
    longer, at = np.flatnonzero((lengths > 8) & (lengths <= LONG_WORD)), 8
    while len(longer):
        more = eight[starts[longer] + at] & _MASKS[np.minimum(lengths[longer] - at, 8)]
        hashes[longer] = mix(hashes[longer] * np.uint64(0xD6E8FEB86659FD93) ^ mix(more))
        at += 8
        longer = longer[lengths[longer] > at]
    for k in np.flatnonzero(lengths > LONG_WORD):
        digest = hashlib.blake2b(data[starts[k] : ends[k]], digest_size=8).digest()
        hashes[k] = np.uint64(int.from_bytes(digest, "little"))
    return hashes


def hash_words(texts: pa.Array) -> Words:
    """The words of an Arrow column of strings; null has none."""
    wide = pa.types.is_large_string(texts.type)
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    begin, end = int(offsets[0]), int(offsets[-1])
    offsets = offsets.astype(np.int64) - begin
    size = end - begin
    data = np.zeros(size + 8, np.uint8)
    if size:
        np.take(_TABLE, np.frombuffer(body, np.uint8)[begin:end], out=data[:size])
    found: list[tuple[np.ndarray, ...]] = []
    at = 0
    while at < size:
        stop = min(size, at + BYTES_AT_ONCE)
        while stop < size and data[stop]:  # on to the end of a word
            ahead = np.flatnonzero(data[stop : stop + BYTES_AT_ONCE] == 0)
            stop = stop + int(ahead[0]) if len(ahead) else min(size, stop + BYTES_AT_ONCE)
        inside = np.zeros(stop - at + 2, bool)
        inside[1:-1] = data[at:stop] != 0
        # a text's first byte starts a word even where the text before ends in one
        cut = offsets[np.searchsorted(offsets, at, "right") : np.searchsorted(offsets, stop, "left")] - at
        cut = cut[inside[cut + 1] & inside[cut]]
        starts = np.flatnonzero(inside[1:] & ~inside[:-1])
        ends = np.flatnonzero(inside[:-1] & ~inside[1:])
        if len(cut):
            cut = np.unique(cut)
            starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
        starts, ends = starts + at, ends + at
        found.append((starts, ends, _word_hashes(data, starts, ends)))
        at = stop
    if found:
        starts, ends, hashes = (np.concatenate(c) if len(c) > 1 else c[0] for c in zip(*found))
    else:
        starts = ends = np.zeros(0, np.int64)
        hashes = np.zeros(0, np.uint64)
    first = np.searchsorted(starts, offsets, "left")
    return Words(data, starts, ends, hashes, first, np.diff(offsets))


def in_byte_slices(batches, column: int = 0, most: int = BYTES_AT_ONCE):
    """The batches in slices whose texts have about ``most`` bytes, or one text that is longer."""
    for batch in batches:
        texts = batch.column(column)
        sizes = pc.fill_null(pc.binary_length(texts), 0)
        reach = np.cumsum(sizes.to_numpy(zero_copy_only=False))
        at, done = 0, 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(reach, done + most, "right")))
            yield batch.slice(at, stop - at)
            at, done = stop, int(reach[stop - 1])
        del batch, texts
        pa.default_memory_pool().release_unused()
