"""Random draws keyed by content: hash of seed, business key and tag, so that nothing depends on partitions or order."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SEED = 20260629
#: Fixed by MD5: rotations and sines.
_ROTATE = [r for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for r in four * 4]
_SINE = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
#: Bytes of a message that fit into one block, and messages at a time: their words stay in a core's cache.
_FIT, _AT_ONCE = 55, 8192


def uniform(key: Column, tag: str, seed: int = SEED) -> Column:
    """In [0, 1), from 52 bits of md5(seed|key|tag)."""
    text = F.concat(F.lit(f"{seed}|"), key.cast("string"), F.lit(f"|{tag}"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def _md5_draws(blocks: np.ndarray) -> np.ndarray:
    """The draws of padded blocks (n x 64 bytes): MD5 of all of them at once, a step after the other."""
    words = np.ascontiguousarray(blocks.view("<u4").T)
    a0, b0, c0, d0 = (np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476))
    a, b, c, d = (np.full(len(blocks), x) for x in (a0, b0, c0, d0))
    f, g = np.empty_like(a), np.empty_like(a)
    used = words.any(axis=1)
    for i in range(64):
        if i < 16:
            at = i
            np.bitwise_xor(c, d, out=f)
            np.bitwise_and(f, b, out=f)
            np.bitwise_xor(f, d, out=f)
        elif i < 32:
            at = (5 * i + 1) % 16
            np.bitwise_xor(b, c, out=f)
            np.bitwise_and(f, d, out=f)
            np.bitwise_xor(f, c, out=f)
        elif i < 48:
            at = (3 * i + 5) % 16
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
        else:
            at = 7 * i % 16
            np.invert(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
        np.add(a, f, out=a)
        np.add(a, _SINE[i], out=a)
        if used[at]:
            np.add(a, words[at], out=a)
        np.left_shift(a, np.uint32(_ROTATE[i]), out=g)
        np.right_shift(a, np.uint32(32 - _ROTATE[i]), out=a)
        np.bitwise_or(a, g, out=a)
        np.add(a, b, out=a)
        a, b, c, d = d, a, b, c
    high, low = (a + a0).byteswap().astype(np.int64), (b + b0).byteswap().astype(np.int64)
    return ((high << 20) | (low >> 12)) / 2.0**52


def drawn(prefixes: np.ndarray, lengths: np.ndarray, numbers: np.ndarray, tags: tuple[str, ...], of: np.ndarray) -> list[np.ndarray]:
    """For each tag the draws from md5(prefix + number + "|" + tag), as `uniform` makes them; `of` tells the prefix of each number. Prefixes are rows of 64 bytes or more, zero beyond their lengths."""
    out = [np.empty(len(numbers)) for _ in tags]
    for low in range(0, len(numbers), _AT_ONCE):
        part = slice(low, low + _AT_ONCE)
        at, n = lengths[of[part]], numbers[part]
        row = np.arange(len(n)) * 64
        left = np.where(n < 0, ~n.view(np.uint64) + np.uint64(1), n.view(np.uint64))
        digits = np.ones(len(n), np.int64)
        for k in range(1, len(str(left.max()))):
            digits += left >= np.uint64(10**k)
        end = at + digits + (n < 0)
        if end.max() + 1 + max(len(t.encode()) for t in tags) > _FIT:
            heads = [prefixes[p, :size].tobytes() + b"%d|" % i for p, size, i in zip(of[part].tolist(), at.tolist(), n.tolist())]
            for o, t in zip(out, tags):
                o[part] = [int(hashlib.md5(h + t.encode()).hexdigest()[:13], 16) / 2.0**52 for h in heads]
            continue
        rows = prefixes[of[part], :64]
        flat = rows.reshape(-1)
        flat[(row + at)[n < 0]] = ord("-")
        for k in range(int(digits.max())):
            has = slice(None) if k < digits.min() else digits > k
            left, digit = np.divmod(left, np.uint64(10))
            flat[(row + end - 1 - k)[has]] = digit[has].astype(np.uint8) + ord("0")
        for o, t in zip(out, tags):
            block = rows.copy()
            flat = block.reshape(-1)
            tail = b"|" + t.encode() + b"\x80"
            for k, byte in enumerate(tail):
                flat[row + end + k] = byte
            bits = (end + len(tail) - 1) * 8
            block[:, 56], block[:, 57] = bits & 255, bits >> 8
            o[part] = _md5_draws(block)
    return out


def drawn_numbers(keys: np.ndarray, tags: tuple[str, ...], seed: int = SEED) -> list[np.ndarray]:
    """Draws by whole numbers; those that stand beside their equals are drawn once."""
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    head = np.frombuffer(f"{seed}|".encode().ljust(64, b"\0"), np.uint8)
    one = keys[first]
    found = drawn(head[None], np.array([len(f"{seed}|")]), one, tags, np.zeros(len(one), np.int64))
    return found if len(one) == len(keys) else [x[np.cumsum(first) - 1] for x in found]


def batched(key: Column, tag: str, seed: int = SEED) -> Column:
    """`uniform` by a key of whole numbers, for draws that every row needs: made on whole batches, which takes a fifth of the time that the JVM takes for one after the other."""
    @F.arrow_udf("double")
    def draw(keys: pa.Array) -> pa.Array:
        return pa.array(drawn_numbers(np.asarray(keys.fill_null(0)), (tag,), seed)[0], mask=np.asarray(keys.is_null()))

    return draw(key.cast("long"))


def choice(u: Column, n: int | Column) -> Column:
    return F.floor(u * n).cast("int")


def integer(u: Column, low: int | Column, high: int | Column) -> Column:
    low = low if isinstance(low, Column) else F.lit(low)
    return (low + F.floor(u * (F.lit(high) - low + 1 if not isinstance(high, Column) else high - low + 1))).cast("int")


def pick(u: Column, values: list) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), choice(u, len(values)) + 1)


def weighted(u: Column, values: list[tuple[str, int]]) -> Column:
    """By cumulative weights in hundredths."""
    total, out = 0, None
    for value, weight in values:
        total += weight
        out = (F.when if out is None else out.when)(u < F.lit(total / 100), F.lit(value))
    return out


def triangular(u: Column, low: int, high: int, mode: int) -> Column:
    if low == high:
        return F.lit(float(low))
    c = (mode - low) / (high - low)
    span = float(high - low)
    return F.when(u <= F.lit(c), F.lit(float(low)) + F.lit(span) * F.sqrt(u * F.lit(c))).otherwise(F.lit(float(high)) - F.lit(span) * F.sqrt((F.lit(1.0) - u) * F.lit(1 - c)))


def words_drawn(u: Column, low: int, high: int, mode: int) -> Column:
    """Triangular, rounded half to even, held in bounds."""
    return F.greatest(F.lit(low), F.least(F.lit(high), F.bround(triangular(u, low, high, mode)).cast("int")))


def sql_uniform(key: str, tag: str, seed: int = SEED) -> str:
    """The same draw for DuckDB."""
    return f"(('0x' || substr(md5('{seed}|' || ({key})::VARCHAR || '|{tag}'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


def numpy_words_drawn(u: np.ndarray, low: int, high: int, mode: int) -> np.ndarray:
    """`words_drawn` of batches, by the same steps."""
    if low == high:
        return np.full(len(u), low)
    c, span = (mode - low) / (high - low), float(high - low)
    n = np.where(u <= c, low + span * np.sqrt(u * c), high - span * np.sqrt((1.0 - u) * (1 - c)))
    return np.clip(np.rint(n).astype(np.int64), low, high)
