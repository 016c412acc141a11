"""Forward-chaining validation: expanding training sets, later test windows,
and a purge between them.

Fold k trains on rows before the k-th cut and tests on [cut k, cut k + 1). A
label looks ahead by its horizon, so rows less than a horizon before the cut
have labels from the test window: they are purged from that fold. Each row is
replicated to the folds it takes part in, in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.operators.grouped import report_by_group


def expanding_folds(df: DataFrame, cuts: list[int], horizon_us: int, u: str = "ts_us") -> DataFrame:
    """``df`` with fold (from 1) and role (train, purged, test), a row for each
    fold it belongs to. ``cuts``: ascending instants; the last one ends the last
    fold's test window. Rows without an instant are in no fold."""
    if sorted(set(cuts)) != list(cuts) or len(cuts) < 2:
        raise ValueError("cuts must ascend, and be two at least")
    t, folds = F.col(u), []
    for k, (start, end) in enumerate(zip(cuts, cuts[1:]), 1):
        role = (F.when(t < F.lit(start - horizon_us + 1), "train").when(t < F.lit(start), "purged")
                 .when(t < F.lit(end), "test"))
        folds.append(F.struct(F.lit(k).alias("fold"), role.alias("role")))
    return df.select("*", F.inline(F.array(*folds))).where(F.col("role").isNotNull())


def fold_counts(folds: DataFrame, label: str) -> DataFrame:
    """One row per fold: rows and positives by role, and the positive weight
    (negatives per positive in training; 1.0 without positives)."""
    pos = F.coalesce(F.col(label) == 1, F.lit(False))

    def rows(role, keep=F.lit(True)):
        return F.count_if((F.col("role") == role) & keep)

    g = folds.groupBy("fold").agg(
        rows("train").alias("train_rows"), rows("train", pos).alias("train_positives"), rows("purged").alias("purged_rows"),
        rows("test").alias("test_rows"), rows("test", pos).alias("test_positives"))
    n = F.col("train_positives")
    return g.withColumn("scale_pos_weight", F.when(n > 0, (F.col("train_rows") - n).cast("double") / n.cast("double"))
                        .otherwise(F.lit(1.0)))


def fold_metrics(folds: DataFrame, label: str, score: str, pred: str, groups: list[str] = ()) -> DataFrame:
    """The report of every fold's test rows (and group), all in one job."""
    test = folds.where(F.col("role") == "test")
    return report_by_group(test.withColumn("y", F.col(label).cast("int")), ["fold", *groups], "y", score, pred)
