"""Window-frame helpers over integer micro instants."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import Window
from pyspark.sql import functions as F


def floor_div(c: Column, divisor: int) -> Column:
    """Exact floor division of a long column by a positive constant."""
    d = F.lit(int(divisor))
    # an integral quotient: a double would round beyond 2^53
    return F.call_function("div", c - F.pmod(c, d), d)


def upto(w: WindowSpec, e: Column, hi: int) -> Column:
    """G(e, hi): sum of ``e`` over all rows with order value <= current + hi
    (a growing frame; differences of two growing frames give any half-open
    range in O(n) per partition, unlike a sliding RANGE frame)."""
    return F.coalesce(F.sum(e).over(w.rangeBetween(Window.unboundedPreceding, hi)), F.lit(0))
