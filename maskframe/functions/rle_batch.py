"""Run-length text in Arrow batches: the rules of :mod:`maskframe.functions.rle` for many rows in one NumPy call.

A batch is read from its byte buffer: digits, token borders and values come from array operations, so a row costs its bytes
and no expression per token. Rows that are not plain (other characters than digits and blanks, tokens of more than 12
digits, runs out of order or overlapping) are few and handled one by one with the same rules.

Runs travel between steps as one binary value a row: little-endian pairs (step from the start before, length), 32 bits each
(64 on canvases that need it). Neighbouring columns of a mask repeat those pairs, so they compress well in a shuffle.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

MAX_DIGITS = 12  # longer tokens take the slow path: sums of plain rows stay far below 2**63
_BLANK = re.compile(r"[ \t\n\x0b\f\r]+")
_DIGITS = re.compile(r"[0-9]+\Z")
RUN_LIST = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
WIDE = 1 << 31  # from here on runs are packed in 64 bits
_OWN_BYTES = np.array([0] + [(1 << 64) - (1 << 8 * (8 - k)) for k in range(1, 9)], np.uint64)  # the last k bytes of a little-endian word


def _ship() -> None:
    from maskframe.session import ship_package

    spark = SparkSession.getActiveSession()
    if spark is not None:
        ship_package(spark)


def _plain(texts: pa.Array) -> pa.Array:
    """A batch as an array of text without nulls (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return texts.cast(pa.large_string()).fill_null("")


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(counts, values, plain)``: the number of tokens of every row and the values of all tokens in order; rows that are not
    plain count none."""
    n = len(texts)
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    lo, hi = int(off[0]), int(off[-1])
    if hi == lo:
        return np.zeros(n, np.int64), np.zeros(0, np.int64), np.ones(n, bool)
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[lo:hi]
    off = off - lo
    digit = (raw - np.uint8(48)) <= 9
    first, last = digit.copy(), digit.copy()
    first[1:] = digit[1:] > digit[:-1]
    last[:-1] = digit[:-1] > digit[1:]
    full = off[1:] > off[:-1]  # rows end tokens even without a blank between
    heads, tails = off[:-1][full], off[1:][full] - 1
    first[heads] = digit[heads]
    last[tails] = digit[tails]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    size = end - start
    at = np.searchsorted(start, off)
    plain = np.ones(n, bool)
    if not (digit | (raw == 32)).all():
        ok = digit | (raw == 32) | (raw == 9) | (raw == 10) | (raw == 13)
        plain[np.searchsorted(off, np.flatnonzero(~ok), side="right") - 1] = False
    if int(size.max(initial=0)) > MAX_DIGITS:
        plain[np.searchsorted(off, start[size > MAX_DIGITS], side="right") - 1] = False
    counts = np.diff(at)
    if not plain.all():
        keep = np.repeat(plain, counts)
        end, size = end[keep], size[keep]
        counts = np.where(plain, counts, 0)
    eights = np.ndarray((len(raw) + 1,), "<u8", np.concatenate([np.zeros(8, np.uint8), raw]), strides=(1,))  # the 8 bytes before every place
    values = _last_digits(eights, end, size)
    more = np.flatnonzero(size > 8)
    if len(more):
        values[more] += 100_000_000 * _last_digits(eights, end[more] - 8, size[more] - 8)
    return counts, values, plain


def _last_digits(eights: np.ndarray, end: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The value of the last 8 digits, or all if fewer, of the tokens that end before ``end``: neighbouring digits are added up as
    pairs, fours and eights within one 64-bit word."""
    x = eights[end]
    x &= np.uint64(0x0F0F0F0F0F0F0F0F)
    x &= _OWN_BYTES[np.minimum(size, 8)]
    for base, shift, mask in ((10, 8, 0x00FF00FF00FF00FF), (100, 16, 0x0000FFFF0000FFFF), (10_000, 32, 0x00000000FFFFFFFF)):
        x = (x * np.uint64(base) + (x >> np.uint64(shift))) & np.uint64(mask)
    return x.astype(np.int64)


def pairs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(counts, s, l, plain)``: the (start, length) pairs of every plain row; an odd last start is dropped."""
    counts, values, plain = tokens(texts)
    ends = np.cumsum(counts)
    odd = counts % 2 == 1
    if odd.any():
        use = np.ones(len(values), bool)
        use[ends[odd] - 1] = False
        values = values[use]
    return counts // 2, values[0::2], values[1::2], plain


def _slow_pairs(text: str) -> list[tuple[int, int]] | None:
    """The pairs of one row, None if a used token is not a non-negative 64-bit integer."""
    toks = [t for t in _BLANK.split(text) if t]
    used = toks[: len(toks) // 2 * 2]
    if not all(_DIGITS.match(t) and int(t) < 1 << 63 for t in used):
        return None
    return [(int(s), int(n)) for s, n in zip(used[0::2], used[1::2])]


def _slow_runs(found: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """Painted runs of one row's pairs: clipped with slice bounds, sorted, overlapping ones merged (touching ones are not)."""
    bound = lambda x: min(max(x + n if x < 0 else x, 0), n)
    out: list[tuple[int, int]] = []
    for a, b in sorted((a, b) for a, b in ((bound(s - 1), bound(s - 1 + k)) for s, k in found) if b > a):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def decode(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(counts, a, b, valid)``: the painted half-open runs of every row on a canvas of ``n`` pixels, as
    :func:`maskframe.functions.rle.checked_mask_runs` gives them (null and invalid rows: none)."""
    texts = _plain(texts)
    counts, s, length, plain = pairs(texts)
    a, b = s - 1, s - 1 + length
    a, b = (np.clip(np.where(x < 0, x + n, x), 0, n) for x in (a, b))
    row = np.repeat(np.arange(len(counts)), counts)
    keep = b > a
    if not keep.all():
        row, a, b = row[keep], a[keep], b[keep]
    valid = np.ones(len(counts), bool)
    bad = np.flatnonzero((row[1:] == row[:-1]) & (a[1:] < b[:-1]))
    odd = np.union1d(np.flatnonzero(~plain), row[bad])
    if len(odd):
        own = {}
        for i in odd.tolist():
            found = _slow_pairs(texts[i].as_py())
            valid[i] = found is not None
            own[i] = _slow_runs(found or [], n)
        rest = ~np.isin(row, odd)
        more = np.array([(i, x, y) for i, r in own.items() for x, y in r], np.int64).reshape(-1, 3)
        row, a, b = (np.concatenate([x[rest], more[:, k]]) for k, x in enumerate((row, a, b)))
        order = np.argsort(row, kind="stable")
        row, a, b = row[order], a[order], b[order]
    return np.bincount(row, minlength=len(counts)), a, b, valid


def pack(counts: np.ndarray, a: np.ndarray, b: np.ndarray, wide: bool = False) -> pa.Array:
    """Sorted runs of several rows -> one binary value a row."""
    ends = np.cumsum(counts)
    step = a.copy()
    step[1:] -= a[:-1]
    heads = (ends - counts)[counts > 0]
    step[heads] = a[heads]
    data = np.empty((len(a), 2), "<i8" if wide else "<i4")
    data[:, 0], data[:, 1] = step, b - a
    off = np.concatenate([[0], ends]).astype(np.int64) * (16 if wide else 8)
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(off), pa.py_buffer(data.tobytes())])


def unpack(packed: pa.Array, wide: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, a, b)`` of packed runs; null: none."""
    packed = packed.cast(pa.large_binary()).fill_null(b"")
    n = len(packed)
    off = np.frombuffer(packed.buffers()[1], np.int64)[packed.offset:packed.offset + n + 1]
    lo, hi = int(off[0]), int(off[-1])
    if hi == lo:
        none = np.zeros(0, np.int64)
        return none, none, none
    data = np.frombuffer(packed.buffers()[2], np.uint8)[lo:hi].view("<i8" if wide else "<i4").reshape(-1, 2)
    at = (off - lo) // (16 if wide else 8)
    counts = np.diff(at)
    total = np.cumsum(data[:, 0], dtype=np.int64)
    before = np.concatenate([[0], total])[at[:-1]]
    a = total - np.repeat(before, counts)
    return np.repeat(np.arange(n), counts), a, a + data[:, 1]


# ------------------------------------------------------------------------------------------------ as column expressions
def area_valid(encoded: Column) -> Column:
    """``struct<area bigint, valid boolean>`` of plain rows (null texts too), null for all others."""
    def fn(texts: pa.Array) -> pa.Array:
        counts, _, length, plain = pairs(_plain(texts))
        total = np.concatenate([[0], np.cumsum(length)])
        ends = np.cumsum(counts)
        area = pa.array(total[ends] - total[ends - counts], pa.int64())
        return pa.StructArray.from_arrays([area, pa.array(plain)], ["area", "valid"], mask=pa.array(~plain))

    _ship()
    return F.arrow_udf(fn, "area bigint, valid boolean")(encoded)


def mask_runs(encoded: Column, height: int, width: int) -> Column:
    """:func:`maskframe.functions.rle.checked_mask_runs` in Arrow batches."""
    n = int(height) * int(width)

    def fn(texts: pa.Array) -> pa.Array:
        counts, a, b, _ = decode(texts, n)
        off = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(off), pa.StructArray.from_arrays([pa.array(a), pa.array(b)], ["a", "b"]))

    _ship()
    return F.arrow_udf(fn, "array<struct<a:bigint,b:bigint>>")(encoded)


def packed_runs(encoded: Column, height: int, width: int) -> Column:
    """The painted runs as one packed binary value; null if the text is not valid, empty if it is null."""
    n = int(height) * int(width)

    def fn(texts: pa.Array) -> pa.Array:
        counts, a, b, valid = decode(texts, n)
        out = pack(counts, a, b, n >= WIDE).cast(pa.binary())
        return out if valid.all() else pa.array([x if v else None for x, v in zip(out.to_pylist(), valid.tolist())], pa.binary())

    _ship()
    return F.arrow_udf(fn, "binary")(encoded)
