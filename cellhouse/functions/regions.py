"""Region (row-range shard) arithmetic.

A sorted list of start keys cuts the unsigned-byte row space into half-open
ranges; the region of a row is the index of the last start <= row, or -1
when the row sorts below the first start.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import TREE_REGION_LIMIT


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_bytes(k) -> bytes:
    if isinstance(k, (bytes, bytearray)):
        return bytes(k)
    if isinstance(k, str):
        return k.encode("utf-8")
    raise TypeError(f"region key must be bytes or str, not {type(k).__name__}")


def sort_starts(starts) -> list[bytes]:
    """O2: unsigned lexicographic sort of start keys; the caller's list is
    left untouched (Python ``bytes`` order is unsigned byte order)."""
    return sorted(as_bytes(s) for s in starts)


def table_starts(split_keys) -> list[bytes]:
    """Region starts of a table with the given split keys: ``b''`` first."""
    keys = sorted({as_bytes(s) for s in split_keys if as_bytes(s) != b""})
    return [b""] + keys


def region_of(row: bytes, starts: list[bytes]) -> int:
    """Plain-Python region index, for drivers-side bisects and tests."""
    return bisect.bisect_right(starts, row) - 1


def _tree(row: Column, starts: list[bytes], lo: int, hi: int) -> Column:
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi + 1) // 2
    return F.when(row < F.lit(bytearray(starts[mid])), _tree(row, starts, lo, mid - 1)).otherwise(
        _tree(row, starts, mid, hi)
    )


def region_index(row, starts, presorted: bool = False) -> Column:
    """F8: region of ``row`` (BINARY) as INT; null row -> null.

    Up to ``TREE_REGION_LIMIT`` starts this is a balanced tree of binary
    comparisons (ceil(log2 n) compares per row, whole-stage codegen).  Larger
    start lists use a binary search over one array literal.
    """
    s = list(starts) if presorted else sort_starts(starts)
    r = _c(row)
    if not s:
        return F.when(r.isNotNull(), F.lit(-1))
    if len(s) > TREE_REGION_LIMIT:
        return F.when(r.isNotNull(), _search(r, s)).cast("int")
    tree = _tree(r, s, 0, len(s) - 1)
    if s[0] != b"":
        tree = F.when(r < F.lit(bytearray(s[0])), F.lit(-1)).otherwise(tree)
    return F.when(r.isNotNull(), tree).cast("int")


def _search(row: Column, starts: list[bytes]) -> Column:
    """Number of starts <= row, less one: a binary search over one array
    literal, ceil(log2(n + 1)) steps, all in the JVM."""
    n = len(starts)
    keys = F.array(*[F.lit(bytearray(s)) for s in starts])
    steps = F.sequence(F.lit(1), F.lit(n.bit_length()))
    begin = F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi"))

    def half(at: Column, _) -> Column:
        mid = F.shiftright(at["lo"] + at["hi"], 1)
        below = F.element_at(keys, F.least(mid + 1, F.lit(n))) <= row
        go = at["lo"] < at["hi"]
        return F.struct(F.when(go & below, mid + 1).otherwise(at["lo"]).alias("lo"),
                        F.when(go & ~below, mid).otherwise(at["hi"]).alias("hi"))

    return F.aggregate(steps, begin, half, lambda at: at["lo"] - 1)


def region_bounds(starts: list[bytes]):
    """``(index, start, stop)`` triples; stop is None for the last region."""
    return [(i, s, starts[i + 1] if i + 1 < len(starts) else None) for i, s in enumerate(starts)]


def regions_for_range(starts: list[bytes], start_row: bytes | None, stop_row: bytes | None):
    """Inclusive region index range touched by ``[start_row, stop_row)``."""
    lo = 0 if start_row is None else max(region_of(start_row, starts), 0)
    if stop_row is None:
        hi = len(starts) - 1
    else:
        # the region holding the last key < stop_row
        hi = bisect.bisect_left(starts, stop_row) - 1
        hi = max(hi, 0)
    return lo, hi
