"""Run-length text as native column expressions.

The text form is ``"start len start len ..."`` with a 1-based start on the column-major flat index of an H x W
canvas: flat pixel ``p = start - 1`` sits at ``col = p div H``, ``row = p mod H``.

Rules kept from the reference (SURVEY 1.1):
* null and a single token are an empty mask with area 0; an empty string has no tokens, also area 0;
* an odd token count drops the last start (pairs are zipped), and area sums the odd-position tokens;
* runs are painted with slice semantics on the flat array, so a run past the end is clipped and a start of 0 only
  paints the last pixel when its length exceeds the canvas -- but ``area`` counts the text in full;
* a row whose used tokens are not all digits is invalid (the reference raises); callers quarantine it.

Everything here is a JVM expression (split / transform / filter / aggregate / array_sort): no Python UDF. Operators parse plain
texts in Arrow batches (:mod:`maskframe.functions.rle_batch`, same rules) and use these for the rest.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = r"^[0-9]+$"
_RUN_TYPE = "array<struct<a:bigint,b:bigint>>"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, body) -> Column:
    """Bind an expensive value once and use it several times in ``body``: ``transform(array(v), x -> body(x))[0]``.

    Catalyst does not share a common sub-expression between the arguments of higher-order functions, so a value
    referenced k times would otherwise be computed k times per row."""
    return F.transform(F.array(value), body).getItem(0)


def rle_tokens(encoded) -> Column:
    """Whitespace tokens, like Python's ``str.split()``; null -> null, blank -> empty array."""
    def body(t):
        return F.when(t.isNull(), F.lit(None).cast("array<string>")).when(
            t == "", F.array().cast("array<string>")
        ).otherwise(F.split(t, r"\s+"))

    return let(F.regexp_replace(_c(encoded), r"^\s+|\s+$", ""), body)


def rle_pair_count(encoded) -> Column:
    """Number of (start, len) pairs the decoder uses; 0 for null / one token."""
    return F.coalesce(F.floor(F.size(rle_tokens(encoded)) / 2), F.lit(0)).cast("int")


def rle_valid(encoded) -> Column:
    """True when every token the decoder or the area sum reads is a non-negative integer literal.

    Fast path: text made only of digits and whitespace with no token over 18 digits. Otherwise the used tokens
    (an odd last start is not used) are checked one by one."""
    def precise(toks):
        n = F.floor(F.size(toks) / 2).cast("int")
        used = F.slice(toks, 1, F.greatest(n * 2, F.lit(1)))
        return F.when(n == 0, F.lit(True)).otherwise(
            F.forall(used, lambda x: x.rlike(DIGITS) & x.try_cast("bigint").isNotNull())
        )

    def body(e):
        fast = (F.translate(e, "0123456789 \t\n\r", "") == "") & ~e.rlike("[0-9]{19}")
        return F.when(e.isNull(), F.lit(True)).when(fast, F.lit(True)).otherwise(let(rle_tokens(e), precise))

    return let(_c(encoded), body)


def rle_area(encoded) -> Column:
    """SURVEY P4: sum of the length tokens as bigint; 0 for null, blank or one token."""
    toks = F.coalesce(rle_tokens(encoded), F.array().cast("array<string>"))
    lens = F.filter(toks, lambda x, i: i % 2 == 1)
    return F.aggregate(lens, F.lit(0).cast("bigint"), lambda acc, x: acc + F.coalesce(x.try_cast("bigint"), F.lit(0)))


def rle_pairs(encoded) -> Column:
    """SURVEY P3: text -> ``array<struct<s:bigint,l:bigint>>`` of the raw (start, len) pairs.

    Tokens are split by position parity and zipped (an odd last start has no partner and is dropped). No lambda
    reads the outer token array, so each row costs O(tokens)."""
    def body(toks):
        starts = F.filter(toks, lambda x, i: i % 2 == 0)
        lens = F.filter(toks, lambda x, i: i % 2 == 1)
        z = F.zip_with(starts, lens, lambda s, l: F.struct(s.alias("st"), l.alias("lt")))
        z = F.filter(z, lambda x: x["lt"].isNotNull() & x["st"].isNotNull())
        return F.transform(
            z, lambda x: F.struct(x["st"].try_cast("bigint").alias("s"), x["lt"].try_cast("bigint").alias("l"))
        )

    return let(rle_tokens(encoded), body)


def _slice_bound(x: Column, n: Column) -> Column:
    """Python slice bound normalisation on a flat array of length n."""
    y = F.when(x < 0, x + n).otherwise(x)
    return F.least(F.greatest(y, F.lit(0).cast("bigint")), n)


def painted_intervals(encoded, height, width) -> Column:
    """Pairs -> painted half-open flat intervals ``struct<a,b>`` (0-based), clipped with slice semantics, empties
    removed. Order and overlaps as in the text."""
    n = (F.lit(height) * F.lit(width)).cast("bigint") if not isinstance(height, Column) else (height * width).cast("bigint")
    iv = F.transform(
        rle_pairs(encoded),
        lambda p: F.struct(
            _slice_bound(p["s"] - 1, n).alias("a"),
            _slice_bound(p["s"] - 1 + p["l"], n).alias("b"),
        ),
    )
    return F.filter(iv, lambda x: F.coalesce(x["b"] > x["a"], F.lit(False)))


def union_intervals(intervals) -> Column:
    """Sorted, disjoint union of an array of half-open intervals ``struct<a,b>`` (all non-empty).

    Clean rows (increasing and pairwise disjoint -- the normal encoder output) pass through unsorted; others are
    sorted first, and rows with overlap are merged in O(n log n) without a running state: starts and ends are sorted separately and interleaved
    (ends first on ties); the coverage after the k-th event is ``2i+1-k`` for the i-th start and ``k-2j-1`` for the
    j-th end, so a segment begins where a start lifts coverage to 1 and ends where an end drops it to 0.
    """

    def merged(iv):
        starts = F.array_sort(F.transform(iv, lambda x: x["a"]))
        ends = F.array_sort(F.transform(iv, lambda x: x["b"]))
        ev = F.array_sort(
            F.concat(
                F.transform(ends, lambda x, j: F.struct(x.alias("pos"), F.lit(0).alias("typ"), j.alias("r"))),
                F.transform(starts, lambda x, i: F.struct(x.alias("pos"), F.lit(1).alias("typ"), i.alias("r"))),
            )
        )
        cov = F.transform(
            ev,
            lambda e, k: F.struct(
                e["pos"].alias("pos"),
                e["typ"].alias("typ"),
                F.when(e["typ"] == 1, e["r"] * 2 + 1 - k).otherwise(k - e["r"] * 2 - 1).alias("c"),
            ),
        )
        begins = F.transform(F.filter(cov, lambda x: (x["typ"] == 1) & (x["c"] == 1)), lambda x: x["pos"])
        finishes = F.transform(F.filter(cov, lambda x: (x["typ"] == 0) & (x["c"] == 0)), lambda x: x["pos"])
        return F.zip_with(begins, finishes, lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def adjacent_overlap(arr):
        m = F.size(arr)
        nxt = F.slice(arr, 2, F.greatest(m - 1, F.lit(1)))
        return (m > 1) & F.exists(
            F.zip_with(nxt, arr, lambda x, y: F.coalesce(x["a"] < y["b"], F.lit(False))), lambda t: t
        )

    def on_sorted(srt):
        return F.when(~adjacent_overlap(srt), srt).otherwise(merged(srt))

    # an array whose runs are increasing and disjoint is already canonical: no sort (the common case)
    return let(_c(intervals), lambda iv: F.when(~adjacent_overlap(iv), iv).otherwise(let(F.array_sort(iv), on_sorted)))


def mask_runs(encoded, height=768, width=768) -> Column:
    """Text -> canonical painted runs of one instance: sorted, disjoint, clipped (what ``rle_to_mask`` paints)."""
    return union_intervals(painted_intervals(encoded, height, width))


def checked_mask_runs(encoded, height=768, width=768) -> Column:
    """:func:`mask_runs` for valid rows, an empty array for null or invalid ones -- validity is folded into the
    same projection so a derived text column is evaluated once (a separate filter would be pushed below the
    projection and re-evaluate the text for every reference)."""
    empty = F.array().cast(_RUN_TYPE)
    return let(
        _c(encoded),
        lambda e: F.when(e.isNull(), empty).when(rle_valid(e), mask_runs(e, height, width)).otherwise(empty),
    )


def drop_overfilled(encoded, max_mean: float, height=768, width=768) -> Column:
    """M6 guard: the text of a mask that covers more than ``max_mean`` of its canvas becomes ``''`` (canonical text, so
    its length tokens add up to the set pixels)."""
    e = _c(encoded)
    return F.when(rle_area(e) > F.lit(float(max_mean) * height * width), F.lit("")).otherwise(e)


def encode_runs(runs) -> Column:
    """SURVEY M6 text side: ``array<struct<a,b>>`` (0-based half-open, any order, maximal or not) -> RLE text.

    Callers pass maximal runs; they are sorted here and printed 1-based. An empty array gives ``''`` (the encoder's
    guard for an all-zero mask)."""
    srt = F.array_sort(_c(runs))
    toks = F.flatten(
        F.transform(srt, lambda x: F.array((x["a"] + 1).cast("string"), (x["b"] - x["a"]).cast("string")))
    )
    return F.concat_ws(" ", toks)
