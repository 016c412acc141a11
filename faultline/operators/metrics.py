"""Classification metrics as Spark aggregations.

* confusion counts, precision / recall / F1 (zero denominators -> 0.0) in one
  pass; a threshold sweep evaluates every threshold in that same pass;
* exact ROC-AUC and average precision (step-wise, as in common ML toolkits)
  from a per-distinct-score table and a two-level prefix sum over range
  partitions whose number follows the number of distinct scores. No
  unpartitioned window over rows ever runs;
* false-negative slices and recall by month for error analysis.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.binning import ALARM_BIN_LABELS, right_closed_bin
from faultline.functions.timecols import micros_to_ntz

# --- fixed values -----------------------------------------------------------
THRESHOLDS = [0.3, 0.5, 0.7]
REPORT_THRESHOLD = 0.7
TIPO_KEYS = [("caminhao", 1), ("escavadeira", 0)]
# -----------------------------------------------------------------------------

PART_ROWS = 1_000_000   # distinct scores per range partition


def _is(c: str | Column, v: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("int") == F.lit(v), F.lit(False))


def confusion_exprs(y: str | Column, yhat: str | Column, suffix: str = "") -> list[Column]:
    return [F.count_if(_is(y, 1) & _is(yhat, 1)).alias("tp" + suffix),
            F.count_if(_is(y, 0) & _is(yhat, 1)).alias("fp" + suffix),
            F.count_if(_is(y, 1) & _is(yhat, 0)).alias("fn" + suffix),
            F.count_if(_is(y, 0) & _is(yhat, 0)).alias("tn" + suffix)]


def confusion_counts(df: DataFrame, y: str = "y", yhat: str = "y_pred") -> DataFrame:
    """One row: tp, fp, fn, tn."""
    return df.agg(*confusion_exprs(y, yhat))


def safe_div(n: Column, d: Column) -> Column:
    return F.coalesce(F.try_divide(n.cast("double"), d.cast("double")), F.lit(0.0))


def with_rates(df: DataFrame) -> DataFrame:
    """Add precision, recall and f1 to a frame with tp, fp, fn columns."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return (df.withColumn("precision", safe_div(tp, tp + fp))
              .withColumn("recall", safe_div(tp, tp + fn))
              .withColumn("f1", safe_div(F.lit(2) * tp, F.lit(2) * tp + fp + fn)))


def predict(score: str | Column, threshold: float) -> Column:
    s = F.col(score) if isinstance(score, str) else score
    return (s >= F.lit(float(threshold))).cast("int")


def threshold_sweep(df: DataFrame, y: str = "y", score: str = "y_prob",
                    thresholds=THRESHOLDS) -> DataFrame:
    """One row per threshold (tp, fp, fn, tn, precision, recall, f1) from a
    single aggregation pass."""
    exprs = []
    for i, t in enumerate(thresholds):
        exprs += confusion_exprs(y, predict(score, t), suffix=f"_{i}")
    wide = df.agg(*exprs)
    rows = F.array(*[F.struct(F.lit(float(t)).alias("threshold"),
                              *[F.col(f"{m}_{i}").alias(m) for m in ("tp", "fp", "fn", "tn")])
                     for i, t in enumerate(thresholds)])
    return with_rates(wide.select(F.inline(rows)))


# --- ranking metrics -----------------------------------------------------------

def score_table(df: DataFrame, y: str = "y", score: str = "y_prob", pred: str | None = None) -> DataFrame:
    """Per distinct score (and prediction, when given): pos, neg. Partial
    aggregation combines a score shared by many rows map-side."""
    keys = [F.col(score).cast("double").alias("s")]
    if pred is not None:
        keys.append(F.col(pred).cast("int").alias("p"))
    return (df.where(F.col(score).isNotNull() & F.col(y).isNotNull())
              .groupBy(*keys)
              .agg(F.count_if(_is(y, 1)).alias("pos"), F.count_if(~_is(y, 1)).alias("neg")))


def cumulative_by_score(st: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Add ``cum_pos`` / ``cum_neg``: totals over scores >= s.

    Two-level prefix sum: the per-score table is range-partitioned on the score
    (one partition per ``part_rows`` distinct scores, so the parallelism grows
    with the table), partition totals are prefixed over one row a partition,
    and a window per partition does the rest. The partitioned table is
    checkpointed, so both levels see the same partitions."""
    from faultline.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(st.sparkSession)
    n = max(1, -(-st.count() // part_rows))
    part = st.repartitionByRange(n, F.col("s").desc()).withColumn("_b", F.spark_partition_id()).checkpoint()
    tot = part.groupBy("_b").agg(F.sum("pos").alias("_bp"), F.sum("neg").alias("_bn"))
    # one row per partition of part_rows scores
    wt = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select("_b", F.coalesce(F.sum("_bp").over(wt), F.lit(0)).alias("_op"),
                     F.coalesce(F.sum("_bn").over(wt), F.lit(0)).alias("_on"))
    wb = (Window.partitionBy("_b").orderBy(F.col("s").desc())
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return part.join(F.broadcast(off), "_b").select(
        "s", "pos", "neg", (F.col("_op") + F.sum("pos").over(wb)).alias("cum_pos"),
        (F.col("_on") + F.sum("neg").over(wb)).alias("cum_neg"))


def ranking_metrics(df: DataFrame, y: str = "y", score: str = "y_prob",
                    part_rows: int = PART_ROWS) -> DataFrame:
    """One row: n_pos, n_neg, auc_roc, auc_pr (average precision). Both AUCs
    are 0.0 when only one class is present."""
    return ranking_from_scores(materialized_scores(df, y, score), part_rows)


def confusion_from_scores(st: DataFrame, threshold: float | None = None) -> DataFrame:
    """tp, fp, fn, tn from a per-score table (no row pass): prediction is
    ``s >= threshold``, or the stored prediction ``p`` when no threshold."""
    hi = (F.col("s") >= F.lit(float(threshold))) if threshold is not None else _is("p", 1)
    z = F.lit(0).cast("long")
    return st.agg(F.coalesce(F.sum(F.when(hi, F.col("pos"))), z).cast("long").alias("tp"),
                  F.coalesce(F.sum(F.when(hi, F.col("neg"))), z).cast("long").alias("fp"),
                  F.coalesce(F.sum(F.when(~hi, F.col("pos"))), z).cast("long").alias("fn"),
                  F.coalesce(F.sum(F.when(~hi, F.col("neg"))), z).cast("long").alias("tn"))


def ranking_from_scores(st: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    if "p" in st.columns:
        st = st.groupBy("s").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    cum = cumulative_by_score(st, part_rows)
    parts = cum.agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
        F.sum(F.col("neg").cast("double") * ((F.col("cum_pos") - F.col("pos")).cast("double")
                                             + F.col("pos").cast("double") * F.lit(0.5))).alias("_auc_num"),
        F.sum(F.when(F.col("pos") > 0, F.col("pos").cast("double")
                     * (F.col("cum_pos").cast("double") / (F.col("cum_pos") + F.col("cum_neg")).cast("double"))))
         .alias("_ap_num"))
    both = (F.coalesce(F.col("n_pos"), F.lit(0)) > 0) & (F.coalesce(F.col("n_neg"), F.lit(0)) > 0)
    return parts.select(
        F.coalesce(F.col("n_pos"), F.lit(0)).cast("long").alias("n_pos"),
        F.coalesce(F.col("n_neg"), F.lit(0)).cast("long").alias("n_neg"),
        F.when(both, F.round(F.col("_auc_num") / (F.col("n_pos").cast("double") * F.col("n_neg").cast("double")), 6))
         .otherwise(F.lit(0.0)).alias("auc_roc"),
        F.when(both, F.round(F.col("_ap_num") / F.col("n_pos").cast("double"), 6))
         .otherwise(F.lit(0.0)).alias("auc_pr"))


def materialized_scores(df: DataFrame, y: str = "y", score: str = "y_prob",
                        pred: str | None = None) -> DataFrame:
    """The per-score table, checkpointed (reliable storage), so the rows are
    read once however many metrics derive from it."""
    from faultline.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return score_table(df, y, score, pred).checkpoint()


def classification_report(df: DataFrame, y: str = "y", score: str = "y_prob",
                          threshold: float | None = 0.5, pred: str | None = None,
                          part_rows: int = PART_ROWS) -> DataFrame:
    """One row: confusion counts, precision, recall, f1 (prediction = score >=
    threshold, or the ``pred`` column) and the two ranking metrics, all from
    one pass over the rows."""
    st = materialized_scores(df, y, score, pred)
    cm = with_rates(confusion_from_scores(st, None if pred else threshold))
    if threshold is not None and not pred:
        cm = cm.withColumn("threshold", F.lit(float(threshold)))
    return one_row_merge(cm, ranking_from_scores(st, part_rows))


def one_row_merge(a: DataFrame, b: DataFrame) -> DataFrame:
    """Combine two one-row frames side by side (union + max per column)."""
    cols_a, cols_b = a.columns, b.columns
    u = a.unionByName(b, allowMissingColumns=True)
    return u.agg(*[F.max(c).alias(c) for c in cols_a + [c for c in cols_b if c not in cols_a]])


# --- error analysis ------------------------------------------------------------------

def fn_slices(df: DataFrame, y: str = "y", yhat: str = "y_pred", tipo: str = "tipo_caminhao",
              state: str = "current_state", count4h: str = "alarm_count_4h") -> DataFrame:
    """False negatives by equipment type (both keys always), operating state
    (observed states) and alarm-count bin (all four bins always), plus the
    total. Long form: dimension, key, fn.

    One pass over the rows: ``rollup(state)`` yields one row per state and the
    grand total; the long form is exploded from those few rows."""
    fn = df.where(_is(y, 1) & _is(yhat, 0))
    binc = right_closed_bin(F.col(count4h))
    g = fn.withColumn("_state", F.col(state).cast("string")).rollup("_state").agg(
        F.grouping("_state").alias("_total"),
        F.count(F.lit(1)).cast("long").alias("_n"),
        *[F.count_if(_is(tipo, v)).cast("long").alias(f"_t_{k}") for k, v in TIPO_KEYS],
        *[F.count_if(F.coalesce(binc == F.lit(lab), F.lit(False))).cast("long").alias(f"_b{i}")
          for i, lab in enumerate(ALARM_BIN_LABELS)])

    def entry(dim, key, col):
        return F.struct(F.lit(dim).alias("dimension"), key.alias("key"), col.alias("fn"))

    fixed = [entry("total", F.lit("all"), F.col("_n"))]
    fixed += [entry("tipo_caminhao", F.lit(k), F.col(f"_t_{k}")) for k, _ in TIPO_KEYS]
    fixed += [entry("alarm_count_4h_bin", F.lit(lab), F.col(f"_b{i}")) for i, lab in enumerate(ALARM_BIN_LABELS)]
    per_state = F.array(entry("current_state", F.col("_state"), F.col("_n")))
    empty = F.array_remove(per_state, per_state.getItem(0))
    items = (F.when(F.col("_total") == 1, F.array(*fixed))
              .when(F.col("_state").isNotNull(), per_state).otherwise(empty))
    out = g.select(F.inline(items))
    # the fixed dimensions are reported even without any false negative
    zeros = df.sparkSession.createDataFrame(
        [("total", "all", 0)] + [("tipo_caminhao", k, 0) for k, _ in TIPO_KEYS]
        + [("alarm_count_4h_bin", lab, 0) for lab in ALARM_BIN_LABELS],
        "dimension string, key string, fn bigint")
    return (out.unionByName(zeros).groupBy("dimension", "key")
               .agg(F.sum("fn").cast("long").alias("fn")))


def month_of(u: str | Column) -> Column:
    """'yyyy-MM' of an epoch-micro instant (UTC wall clock)."""
    c = F.col(u) if isinstance(u, str) else u
    return F.date_format(micros_to_ntz(c), "yyyy-MM")


def recall_by_month(df: DataFrame, u: str = "ts_us", y: str = "y", yhat: str = "y_pred") -> DataFrame:
    """month, recall, tp, fn, positives; months without positives keep recall 0.0."""
    g = df.groupBy(month_of(u).alias("month")).agg(
        F.count_if(_is(y, 1) & _is(yhat, 1)).alias("tp"),
        F.count_if(_is(y, 1) & _is(yhat, 0)).alias("fn"))
    return g.select("month", safe_div(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
                    "tp", "fn", (F.col("tp") + F.col("fn")).alias("positives"))
