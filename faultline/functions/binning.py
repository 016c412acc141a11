"""Right-closed range bins.

Fixed values (alarm-count bins for error slicing, in natural order):
  (-0.5, 5] -> '0-5', (5, 10] -> '6-10', (10, 20] -> '11-20', (20, inf] -> '21+'
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
ALARM_BIN_EDGES = [-0.5, 5, 10, 20, float("inf")]
ALARM_BIN_LABELS = ["0-5", "6-10", "11-20", "21+"]
# -----------------------------------------------------------------------------


def right_closed_bin(c: Column, edges=ALARM_BIN_EDGES, labels=ALARM_BIN_LABELS) -> Column:
    """Label of the bin (edges[i], edges[i+1]] holding ``c``; null outside."""
    out = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c > F.lit(lo)) & (c <= F.lit(hi)) if hi != float("inf") else (c > F.lit(lo))
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out
