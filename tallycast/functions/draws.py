"""Random draws as pure functions of their keys and a counter.

``rand()`` depends on how rows fall into partitions, and a lost executor would redraw. Here the digest of (seed, keys,
counter) is read as an integer, so a draw is the same wherever and however often its row is computed, and any engine
with that digest and whole numbers computes the same one. Keys are written as text, so they should be strings or whole
numbers.
"""

from __future__ import annotations

import functools
import hashlib
import math
import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# used inside tasks as well, where the package need not be installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Hexadecimal digits of a draw: 52 bits, all of which a double holds.
DIGITS = 13
STEPS = float(16**DIGITS)

# Rational approximation of the inverse normal (Acklam), highest power first, and where its tail begins.
CENTRE_TOP = [-39.69683028665376, 220.9460984245205, -275.9285104469687, 138.3577518672690, -30.66479806614716, 2.506628277459239]
CENTRE_BOTTOM = [-54.47609879822406, 161.5858368580409, -155.6989798598866, 66.80131188771972, -13.28068155288572, 1.0]
TAIL_TOP = [-0.007784894002430293, -0.3223964580411365, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783]
TAIL_BOTTOM = [0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416, 1.0]
TAIL = 0.02425


def key(seed: int, *keys: Column | str) -> Column:
    """What the draws of ``keys`` have in common, as text: worked out once where many draws follow."""
    columns = [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    return F.concat_ws("|", F.lit(str(seed)), *columns)


def _read(text: Column) -> Column:
    digest = F.md5(text.cast("binary"))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long")


def _between(number: Column) -> Column:
    return (number.cast("double") + F.lit(0.5)) / F.lit(STEPS)


def whole(seed: int, *keys: Column | str) -> Column:
    """A whole number from 0 to 2 ** 52 - 1."""
    return _read(key(seed, *keys))


def uniform(seed: int, *keys: Column | str) -> Column:
    """A number in (0, 1)."""
    return _between(whole(seed, *keys))


def uniform_of(known: Column, counter: Column) -> Column:
    """:func:`uniform` of the keys in ``known`` (from :func:`key`) and a last one, which is not NULL."""
    return _between(_read(F.concat(known, F.lit("|"), counter.cast("string"))))


def index(seed: int, size: Column, *keys: Column | str) -> Column:
    """An integer in 1..size."""
    return (F.floor(uniform(seed, *keys) * size) + 1).cast("long")


def index_of(known: Column, size: Column, counter: Column) -> Column:
    """:func:`index` of the keys in ``known`` and a last one."""
    return (F.floor(uniform_of(known, counter) * size) + 1).cast("long")


def _ratio(top: list[float], bottom: list[float], x: Column) -> Column:
    def horner(coefficients: list[float]) -> Column:
        total = F.lit(coefficients[0])
        for c in coefficients[1:]:
            total = total * x + F.lit(c)
        return total

    return horner(top) / horner(bottom)


def inverse_normal(p: Column) -> Column:
    """The normal quantile of ``p``; largest relative error about 1e-9.

    ``p`` is bound by a lambda, so it is worked out once however often it is named here.
    """

    def quantile(u: Column) -> Column:
        middle = u - F.lit(0.5)
        tail = F.sqrt(F.lit(-2.0) * F.ln(F.least(u, 1 - u)))
        far = _ratio(TAIL_TOP, TAIL_BOTTOM, tail)
        near = middle * _ratio(CENTRE_TOP, CENTRE_BOTTOM, middle * middle)
        return F.when(u < TAIL, far).when(u > 1 - TAIL, -far).otherwise(near)

    return F.transform(F.array(p), quantile)[0]


def normal(seed: int, *keys: Column | str) -> Column:
    """A standard normal number."""
    return inverse_normal(uniform(seed, *keys))


def normal_of(known: Column, counter: Column) -> Column:
    """:func:`normal` of the keys in ``known`` and a last one."""
    return inverse_normal(uniform_of(known, counter))


# --- the same draws, many at a time ---------------------------------------------------------------------------------

_SHIFTS = [7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4
_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_WORD = 0xFFFFFFFF
_START = [0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476]
#: Bytes of a text that one block of the digest holds, and texts digested at a time, so that they stay in a core's cache.
BLOCK, AT_A_TIME = 55, 1 << 14


class Counters:
    """The ends of many keys' texts, such as ``|1|1``, ``|1|2``, ready to be digested after any beginning."""

    def __init__(self, ends: list[str]):
        self.texts = [e.encode() for e in ends]
        self.size, self.longest = len(ends), max(map(len, self.texts), default=0)
        self._words: dict[tuple[int, int], list[np.ndarray]] = {}

    def words(self, offset: int, start: int) -> list[np.ndarray]:
        """The texts from ``start`` on after ``offset`` empty bytes, closed by a bit, as words; and their lengths in bits."""
        if (offset, start) not in self._words:
            texts = self.texts[start : start + AT_A_TIME]
            width = (offset + self.longest + 1 + 3) // 4 * 4
            closed = b"".join((b"\0" * offset + t + b"\x80").ljust(width, b"\0") for t in texts)
            table = np.frombuffer(closed, "<u4").reshape(len(texts), -1).astype(np.uint32)
            bits = np.array([len(t) * 8 for t in texts], np.uint32)
            self._words[offset, start] = [*(np.ascontiguousarray(table[:, k]) for k in range(table.shape[1])), bits]
        return self._words[offset, start]


def _mixed(i: int, b, c, d):
    """The round's function of three of the four parts, which are whole numbers or arrays."""
    if i < 16:
        return d ^ (b & (c ^ d))
    if i < 32:
        return c ^ (d & (b ^ c))
    if i < 48:
        return b ^ c ^ d
    return c ^ (b | (d ^ (np.uint32(_WORD) if isinstance(d, np.ndarray) else _WORD)))


def _digested(words: list) -> tuple[np.ndarray, np.ndarray]:
    """The first two words of the digests of blocks, whose 16 words are whole numbers or arrays.

    Parts are whole numbers up to the first word that is an array, and arrays that are written over from the time all are.
    """
    n = max(len(w) for w in words if isinstance(w, np.ndarray))
    a, b, c, d = _START
    full = None
    for i in range(64):
        word, k, s = words[(i, 5 * i + 1, 3 * i + 5, 7 * i)[i // 16] % 16], _SINES[i], _SHIFTS[i]
        varies = isinstance(word, np.ndarray)
        added = np.uint32(k if varies else (k + word) & _WORD)
        if full is None and all(isinstance(x, np.ndarray) for x in (a, b, c, d)):
            full, a = np.empty(n, np.uint32), a.copy()
        if full is None:
            parts = [_mixed(i, b, c, d), a, word]
            known = sum(x for x in parts if not isinstance(x, np.ndarray)) + k & _WORD
            arrays = [x for x in parts if isinstance(x, np.ndarray)]
            if arrays:
                total = sum(arrays[1:], arrays[0] + np.uint32(known))
                total = (total << np.uint32(s)) | (total >> np.uint32(32 - s))
                total += b if isinstance(b, np.ndarray) else np.uint32(b)
            else:
                total = ((known << s | known >> 32 - s) + b) & _WORD
        else:
            if i < 16:
                np.bitwise_xor(c, d, out=full)
                full &= b
                full ^= d
            elif i < 32:
                np.bitwise_xor(b, c, out=full)
                full &= d
                full ^= c
            elif i < 48:
                np.bitwise_xor(b, c, out=full)
                full ^= d
            else:
                np.invert(d, out=full)
                full |= b
                full ^= c
            # the oldest part is not needed again
            total = a
            total += full
            total += added
            if varies:
                total += word
            np.right_shift(total, np.uint32(32 - s), out=full)
            total <<= np.uint32(s)
            total |= full
            total += b
        a, d, c, b = d, c, b, total
    return a + np.uint32(_START[0]), b + np.uint32(_START[1])


def wholes(beginning: str, counters: Counters, n: int | None = None) -> np.ndarray:
    """:func:`whole` of the keys whose text is ``beginning`` and each of the (first ``n``) ends."""
    text, n = beginning.encode(), counters.size if n is None else n
    out = np.empty(n, np.int64)
    if len(text) + counters.longest > BLOCK:
        for k, end in enumerate(counters.texts[:n]):
            out[k] = int(hashlib.md5(text + end).hexdigest()[:DIGITS], 16)
        return out
    first, offset = divmod(len(text), 4)
    known = [int.from_bytes(text[k : k + 4], "little") for k in range(0, len(text), 4)] + [0] * 16
    for start in range(0, n, AT_A_TIME):
        *ends, bits = [w[: n - start] for w in counters.words(offset, start)]
        block: list = known[:16]
        for k, word in enumerate(ends):
            block[first + k] = word | np.uint32(known[first + k]) if known[first + k] else word
        block[14] = bits + np.uint32(8 * len(text))
        a, b = _digested(block)
        out[start : start + len(bits)] = a.byteswap().astype(np.int64) << 20 | (b.byteswap() >> np.uint32(12))
    return out


def uniforms(beginning: str, counters: Counters, n: int | None = None) -> np.ndarray:
    """:func:`uniform`, likewise."""
    u = wholes(beginning, counters, n).astype(np.float64)
    u += 0.5
    u /= STEPS
    return u


def indices(beginning: str, counters: Counters, size: int | np.ndarray, n: int | None = None) -> np.ndarray:
    """:func:`index`, likewise, but counted from 0."""
    return np.floor(uniforms(beginning, counters, n) * size).astype(np.int64)


def normals(beginning: str, counters: Counters, n: int | None = None) -> np.ndarray:
    """:func:`normal`, likewise."""

    def horner(coefficients: list[float], x: np.ndarray) -> np.ndarray:
        total = np.full_like(x, coefficients[0])
        for c in coefficients[1:]:
            total *= x
            total += c
        return total

    u = uniforms(beginning, counters, n)
    middle = u - 0.5
    square = middle * middle
    z = middle * (horner(CENTRE_TOP, square) / horner(CENTRE_BOTTOM, square))
    for far, sign in ((u < TAIL, 1.0), (u > 1 - TAIL, -1.0)):
        p = u[far] if sign > 0 else 1 - u[far]
        tail = np.sqrt(-2.0 * np.log(p))
        z[far] = sign * (horner(TAIL_TOP, tail) / horner(TAIL_BOTTOM, tail))
    return z


def text_of(seed: int, *keys: str | None) -> str:
    """The text of :func:`key`; keys that are NULL are left out."""
    return "|".join([str(seed), *[k for k in keys if k is not None]])


@functools.cache
def counted(outer: int, inner: int, swapped: bool = True) -> Counters:
    """Ends of two counters from 1, the first slowest; ``swapped`` names the second one first."""
    pairs = ((o, i) for o in range(1, outer + 1) for i in range(1, inner + 1))
    return Counters([f"|{i}|{o}" if swapped else f"|{o}|{i}" for o, i in pairs])
