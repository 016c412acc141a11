"""Model evaluation runs: train per horizon, threshold sweeps, baselines,
model comparison, error analysis and permutation importance.

Every metric aggregates a scored DataFrame (columns y, y_prob[, y_pred]);
models are scored once per test set and the metric jobs read that output.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.operators import metrics as M
from faultline.operators import ml
from faultline.operators.grouped import long_form, report_by_group
from faultline.operators.split import hash_fraction
from faultline.plans.features import FEATURE_COLS


def scored_test(model, test: DataFrame, label: str, keep: list[str] = ()) -> DataFrame:
    cols = list(dict.fromkeys(list(keep) + FEATURE_COLS + [label]))
    s = ml.score(model, test.select(*cols))
    return s.withColumn("y", F.col(label).cast("int"))


def model_metrics(spark: SparkSession, name: str, label: str, scored: DataFrame, train_rows: int,
                  scale_pos: float, threshold: float = 0.5) -> DataFrame:
    """One row: model, label, threshold, tp..tn, precision, recall, f1,
    auc_roc, auc_pr, train_rows, test_rows, scale_pos_weight."""
    rep = M.classification_report(scored, "y", "y_prob", threshold)
    return rep.select(F.lit(name).alias("model"), F.lit(label).alias("label"), "threshold",
                      "tp", "fp", "fn", "tn", "precision", "recall", "f1", "auc_roc", "auc_pr",
                      F.lit(int(train_rows)).cast("long").alias("train_rows"),
                      (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("test_rows"),
                      F.lit(float(scale_pos)).alias("scale_pos_weight"))


def train_and_score(train: DataFrame, test: DataFrame, label: str, family: str = "gbt",
                    n_trees: int = ml.N_TREES, keep: list[str] = ()):
    """Fit on the train split and score the test split (scored frame is
    checkpointed by the caller when reused)."""
    model, bal = ml.train_balanced(train, FEATURE_COLS, label, family=family, n_trees=n_trees)
    return model, scored_test(model, test, label, keep), int(bal["n_neg"] + bal["n_pos"]), \
        float(bal["scale_pos_weight"])


def mark_best_horizon(rows: DataFrame, order_col: str = "_order") -> DataFrame:
    """Add ``is_best``: the row with the highest F1; ties go to the smaller
    ``order_col`` (the shorter horizon). One small aggregate."""
    best = rows.agg(F.max_by("label", F.struct(F.col("f1"), -F.col(order_col))).alias("_b")).first()["_b"]
    return rows.withColumn("is_best", F.col("label") == F.lit(best)).drop(order_col)


def comparison(rows: DataFrame, baseline_names: list[str]) -> DataFrame:
    """Model-comparison table: every row plus base rate, AP lift over the
    base rate, best baseline F1, F1 lift over it and the winner flag."""
    base = rows.where(F.col("model").isin(baseline_names)).agg(F.max("f1").alias("best_baseline_f1")).first()
    bb = float(base["best_baseline_f1"] or 0.0)
    base_rate = F.col("tp") + F.col("fn")
    out = (rows.withColumn("base_rate", M.safe_div(base_rate, F.col("test_rows")))
               .withColumn("ap_lift", M.safe_div(F.col("auc_pr"), F.col("base_rate")))
               .withColumn("best_baseline_f1", F.lit(bb))
               .withColumn("f1_lift", M.safe_div(F.col("f1"), F.lit(bb))))
    # a tie on both goes to the first name
    winner = out.orderBy(F.col("f1").desc(), F.col("auc_pr").desc(), "model").first()["model"]
    return out.withColumn("is_winner", F.col("model") == F.lit(winner)) \
              .withColumn("winner_beats_baseline", F.lit(winner not in baseline_names))


def baseline_rows(spark: SparkSession, train: DataFrame, test: DataFrame, label: str,
                  key: list[str], threshold: float = 0.5) -> DataFrame:
    """Metric rows of the majority, stratified and heuristic baselines: the test
    rows are read once, in long form, and reported by model in one job."""
    n = ml.label_counts(train, label)
    n_train = n["n_pos"] + n["n_neg"]
    maj, has_pos = int(n["n_pos"] > n["n_neg"]), n["n_pos"] > 0
    rate = n["n_pos"] / max(1, n_train)
    t = test.withColumn("y", F.col(label).cast("int"))
    scores = {"dummy_most_frequent": F.lit(float(maj) if has_pos else 0.0),
              "dummy_stratified": (hash_fraction(key) < F.lit(float(rate))).cast("double"),
              "heuristic_critical_1h": F.col("critical_alarm_count_1h").cast("double")}
    rows = long_form(t, "model", {m: {"y_prob": c} for m, c in scores.items()}, ["y"])
    rep = report_by_group(rows, ["model"], threshold=threshold)
    return rep.select("model", F.lit(label).alias("label"), F.lit(float(threshold)).alias("threshold"),
                      "tp", "fp", "fn", "tn", "precision", "recall", "f1", "auc_roc", "auc_pr",
                      F.lit(int(n_train)).cast("long").alias("train_rows"),
                      (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("test_rows"),
                      F.lit(1.0).alias("scale_pos_weight"))


def in_parallel(spark: SparkSession, jobs: dict, threads: int) -> dict:
    """{name: job()}: jobs submitted from pooled threads, each in a scheduler pool
    of its own name, so that one job's tasks fill the cores another leaves idle
    (pools share fairly under ``spark.scheduler.mode=FAIR``). The first failure is
    raised once all have ended."""
    sc = spark.sparkContext

    def run(name, job):
        sc.setLocalProperty("spark.scheduler.pool", f"faultline-{name}")
        try:
            return job()
        finally:
            sc.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max(1, threads)) as pool:
        got = {name: pool.submit(inheritable_thread_target(spark)(run), name, job) for name, job in jobs.items()}
    return {name: f.result() for name, f in got.items()}


def train_horizons(train: DataFrame, test: DataFrame, labels: list[str], family: str = "gbt",
                   n_trees: int = ml.N_TREES, keep: list[str] = (), threads: int | None = None) -> dict:
    """{label: (model, scored test set, train rows, positive weight)}. The
    horizons are fitted at the same time over one stored matrix (``threads``: 1
    for one after another); each scored set is checkpointed, so metrics never
    run a model again."""
    from faultline.session import ensure_checkpoint_dir
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    matrix = train.select(*FEATURE_COLS, *labels).checkpoint()

    def job(label):
        model, sc, n_train, spw = train_and_score(matrix, test, label, family, n_trees, keep)
        return model, sc.checkpoint(), n_train, spw

    jobs = {label: (lambda label=label: job(label)) for label in labels}
    return in_parallel(spark, jobs, len(labels) if threads is None else threads)


def error_analysis(scored: DataFrame, threshold: float = M.REPORT_THRESHOLD) -> dict:
    """Confusion matrix, false-negative slices and recall by month at
    ``threshold`` over a scored test set (three small aggregation jobs); the
    result is a JSON-ready dict."""
    s = scored.withColumn("y_pred", M.predict("y_prob", threshold))
    cm = M.confusion_counts(s).first().asDict()
    slices = M.fn_slices(s).collect()
    months = M.recall_by_month(s).collect()
    n_pos = cm["tp"] + cm["fn"]
    return {
        "threshold": threshold,
        "n_test": sum(cm.values()),
        "n_positives": n_pos,
        "confusion_matrix": cm,
        "recall": cm["tp"] / n_pos if n_pos else 0.0,
        "precision": cm["tp"] / (cm["tp"] + cm["fp"]) if (cm["tp"] + cm["fp"]) else 0.0,
        "false_negative_distribution": {
            d: {r["key"]: r["fn"] for r in slices if r["dimension"] == d}
            for d in ("total", "tipo_caminhao", "current_state", "alarm_count_4h_bin")},
        "recall_by_month": {r["month"]: {"recall": r["recall"], "tp": r["tp"], "fn": r["fn"],
                                         "positives": r["positives"]} for r in months},
    }
