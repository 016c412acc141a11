"""As-of backward join with a validity check.

For each left row (key, t): take the right row of the same key with the
greatest start <= t (ties on start: greatest end, then greatest value), and
return its value only if t <= its end; otherwise ``default``. An older,
still-open interval is never used as a fall-back. Rows of keys without any
right row get ``default``.

Runs on the bucketed window engine (``operators.timewin``): right rows are
unioned into the left stream on (key, time bucket) and a carry-in row brings
the latest interval of earlier buckets, so there is no inequality join and
no per-key task, whatever the key skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.operators.timewin import WindowSpecs, windowed


def asof_backward(left: DataFrame, right: DataFrame, *, keys: list[str], left_u: str,
                  right_start: str, right_end: str, value: str, out: str = "asof_value",
                  default: str | None = None, keep: list[str] = (),
                  bucket_us: int | None = None) -> DataFrame:
    """Every ``left`` row (keys, ``left_u``, ``keep``) plus ``out``; a row
    without key or instant matches nothing and gets ``default``. Instants are
    epoch-micro longs; the right key columns must carry the left names."""
    r = right.select(*[F.col(k) for k in keys], F.col(right_start).alias("_start"),
                     F.col(right_end).alias("_end"), F.col(value).alias("_value"))
    specs = WindowSpecs(states=r, state_name=out, state_default=default)
    found = windowed(left, keys, left_u, specs, keep=list(keep), bucket_us=bucket_us)
    whole = F.col(left_u).isNotNull()
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    rest = left.where(~whole).withColumn(out, F.lit(default).cast(found.schema[out].dataType))
    return found.unionByName(rest.withColumn(left_u, F.col(left_u).cast("long")).select(*found.columns))
