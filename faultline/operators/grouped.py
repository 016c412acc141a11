"""Exact ranking metrics and confusion counts per group, all groups in one job.

The scored rows are in long form: group columns (a model, a label, a fold, a
feature ...), y, a score and, where given, a prediction. They are reduced to one
row per (group, score) by a partial aggregate, range-partitioned on (group,
score), and summed at two levels: totals of each (partition, group), prefixed
along a group's partitions, and a running sum per partition and group. A group
with most of the rows spreads over many partitions; no window holds a group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.operators.metrics import PART_ROWS, _is, with_rates
from faultline.session import ensure_checkpoint_dir


def grouped_scores(df: DataFrame, groups: list[str], y: str = "y", score: str = "y_prob",
                   pred: str | None = None, threshold: float = 0.5) -> DataFrame:
    """(groups, s, p, pos, neg): rows per group, score and prediction (``pred``,
    else score >= threshold). Rows without a score or truth do not count."""
    s = F.col(score).cast("double")
    p = F.col(pred).cast("int") if pred else (s >= F.lit(float(threshold))).cast("int")
    return (df.where(F.col(score).isNotNull() & F.col(y).isNotNull())
              .groupBy(*groups, s.alias("s"), p.alias("p"))
              .agg(F.count_if(_is(y, 1)).alias("pos"), F.count_if(~_is(y, 1)).alias("neg")))


def same(groups: list[str]):
    """Join condition l = r on the groups, null being one."""
    return reduce(lambda a, b: a & b, [F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}")) for g in groups])


def grouped_cumulative(st: DataFrame, groups: list[str], part_rows: int = PART_ROWS) -> DataFrame:
    """(groups, s, pos, neg, cum_pos, cum_neg): totals of the group over scores >= s."""
    ensure_checkpoint_dir(st.sparkSession)
    st = st.groupBy(*groups, "s").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).checkpoint()
    n = max(1, -(-st.count() // part_rows))
    part = (st.repartitionByRange(n, *groups, F.col("s").desc())
              .withColumn("_b", F.spark_partition_id()).checkpoint())
    totals = part.groupBy("_b", *groups).agg(F.sum("pos").alias("_bp"), F.sum("neg").alias("_bn"))
    # one row for each partition that a group reaches
    before = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    off = totals.select("_b", *groups, F.coalesce(F.sum("_bp").over(before), F.lit(0)).alias("_op"),
                        F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_on"))
    inside = (Window.partitionBy("_b", *groups).orderBy(F.col("s").desc())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = part.select("*", F.sum("pos").over(inside).alias("_p"), F.sum("neg").over(inside).alias("_n"))
    joined = rows.alias("l").join(off.alias("r"), (F.col("l._b") == F.col("r._b")) & same(groups))
    return joined.select(*[F.col(f"l.{c}") for c in [*groups, "s", "pos", "neg"]],
                         (F.col("_op") + F.col("_p")).alias("cum_pos"), (F.col("_on") + F.col("_n")).alias("cum_neg"))


def report_by_group(df: DataFrame, groups: list[str], y: str = "y", score: str = "y_prob",
                    pred: str | None = None, threshold: float = 0.5, part_rows: int = PART_ROWS) -> DataFrame:
    """One row per group: tp, fp, fn, tn, precision, recall, f1, n_pos, n_neg,
    auc_roc, auc_pr (step-wise average precision; both 0.0 when a group has one
    class only). The rows are read once."""
    ensure_checkpoint_dir(df.sparkSession)
    st = grouped_scores(df, groups, y, score, pred, threshold).checkpoint()

    def total(keep, column):
        return F.sum(F.when(keep, F.col(column)).otherwise(0)).cast("long")

    hit = _is("p", 1)
    counts = st.groupBy(*groups).agg(total(hit, "pos").alias("tp"), total(hit, "neg").alias("fp"),
                                     total(~hit, "pos").alias("fn"), total(~hit, "neg").alias("tn"))
    pos, neg, cum_pos, cum_neg = (F.col(c).cast("double") for c in ("pos", "neg", "cum_pos", "cum_neg"))
    sums = grouped_cumulative(st, groups, part_rows).groupBy(*groups).agg(
        F.sum("pos").cast("long").alias("n_pos"), F.sum("neg").cast("long").alias("n_neg"),
        F.sum(neg * (cum_pos - pos + pos * F.lit(0.5))).alias("_auc"),
        F.sum(F.when(F.col("pos") > 0, pos * (cum_pos / (cum_pos + cum_neg)))).alias("_ap"))
    both = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    rank = sums.select(
        *groups, "n_pos", "n_neg",
        F.when(both, F.round(F.col("_auc") / (F.col("n_pos").cast("double") * F.col("n_neg").cast("double")), 6))
         .otherwise(F.lit(0.0)).alias("auc_roc"),
        F.when(both, F.round(F.col("_ap") / F.col("n_pos").cast("double"), 6)).otherwise(F.lit(0.0)).alias("auc_pr"))
    # one row of each kind per group; grouping, unlike a join, takes null as a group
    names = [c for c in [*counts.columns, *rank.columns] if c not in groups]
    one = counts.unionByName(rank, allowMissingColumns=True).groupBy(*groups).agg(*[F.max(c).alias(c) for c in names])
    return with_rates(one).select(*groups, "tp", "fp", "fn", "tn", "precision", "recall", "f1", "n_pos", "n_neg",
                                  "auc_roc", "auc_pr")


def long_form(df: DataFrame, name: str, variants: dict[str, dict], keep: list[str]) -> DataFrame:
    """Every row once per variant: ``name`` is the variant's, its columns are
    given by expressions; one pass over the rows."""
    rows = F.array(*[F.struct(F.lit(v).alias(name), *[c.alias(k) for k, c in columns.items()])
                     for v, columns in variants.items()])
    return df.select(*keep, F.inline(rows))
