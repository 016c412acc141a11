"""End-to-end stages with file boundaries, as a user runs them in batch:

clean  -> cleaned telemetry (parquet by source month) + quality reports
rules  -> rule-flag extract (CSV) + signal comparison (JSON)
features -> feature matrix (parquet, sorted by time within files)
model  -> Spark ML pipeline per horizon (saved) + metrics (JSON)
errors -> error analysis of a saved model on the pushed-down test read (JSON)

Paths are shared storage (the cluster's file system); nothing is written to a
machine-local folder.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.operators import metrics as M
from faultline.operators import quality as Q
from faultline.operators import rules as R
from faultline.operators import split as S
from faultline.plans import evaluation as EV
from faultline.plans.features import FEATURE_COLS, LABEL_COLS, build_features, with_micros
from faultline.sources import sinks


def stage_clean(raw: DataFrame, intervals: DataFrame, out_dir: str) -> None:
    """The counters are observed while the clean table is written."""
    counts = Q.clean_and_count(raw, lambda clean: sinks.write_parquet(
        clean, f"{out_dir}/cleaned_telemetry", partition_by=["_source_month"], sort_within=["TAG", "timestamp"]))
    sinks.write_json(counts, f"{out_dir}/cleaning_counts")
    sinks.write_json(Q.report_lists(with_micros(raw), intervals), f"{out_dir}/quality_lists")
    sinks.write_parquet(intervals, f"{out_dir}/cleaned_intervals")
    sinks.write_text_report(Q.full_quality_report(with_micros(raw), intervals), f"{out_dir}/quality_report")
    sinks.write_json(Q.inverted_intervals(intervals), f"{out_dir}/interval_report")


def stage_rules(spark: SparkSession, clean: DataFrame, rules: DataFrame, out_dir: str) -> DataFrame:
    """The flags are computed once, as the CSV extract; the comparison reads
    that extract back and is itself read back from its JSON."""
    flags = R.apply_rules(clean.select("TAG", "Alarme", "ts_us", "timestamp", "Is_Dont_Go"), rules)
    flags = flags.select("TAG", "Alarme", "timestamp", "Is_Dont_Go", "Is_Dont_Go_derived")
    path = f"{out_dir}/business_rules_validation"
    sinks.write_csv(flags, path)
    cmp = R.compare_signals(sinks.read_csv(spark, path, flags.schema))
    sinks.write_json(cmp, f"{out_dir}/signal_comparison")
    return spark.read.schema(cmp.schema).json(f"{out_dir}/signal_comparison")


def stage_features(clean: DataFrame, intervals: DataFrame, out_dir: str, **kw) -> str:
    """Feature matrix partitioned by event month and sorted by time inside
    the files: a later time-range read prunes whole months and skips row
    groups by their min/max statistics."""
    feats = build_features(clean, intervals, **kw).withColumn("event_month", M.month_of("ts_us"))
    path = f"{out_dir}/features"
    sinks.write_parquet(feats, path, partition_by=["event_month"], sort_within=["ts_us"])
    return path


def stage_model(spark: SparkSession, features_path: str, out_dir: str, train_end: str, test_start: str,
                family: str = "gbt", n_trees: int = 100, labels=LABEL_COLS, threads: int | None = None) -> DataFrame:
    """Per horizon a model, its scored test set, a sweep and a metrics row. The
    horizons are trained at the same time (``threads``: 1 for one by one)."""
    from faultline.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    feats = spark.read.parquet(features_path)
    # the cut points, or the ordered 80/20 fall-back when nothing is after them
    # (ties on the instant go by a hash of the whole row, so the cut is the same on every run)
    feats = feats.withColumn("_row", F.xxhash64(*feats.columns))
    train, test = S.split_or_fallback(feats, "ts_us", "_row", train_end, test_start)
    fitted = EV.train_horizons(train, test, labels, family, n_trees, keep=["ts_us", "current_state"], threads=threads)
    rows = None
    for i, lab in enumerate(labels):
        model, sc, n_train, spw = fitted[lab]
        model.write().overwrite().save(f"{out_dir}/model_{family}_{lab}")
        sinks.write_parquet(sc, f"{out_dir}/scored_{family}_{lab}")
        r = EV.model_metrics(spark, family, lab, sc, n_train, spw).withColumn("_order", F.lit(i))
        sweep = M.threshold_sweep(sc).select(F.lit(lab).alias("label"), "*")
        sinks.write_json(sweep, f"{out_dir}/threshold_sweep_{family}_{lab}")
        rows = r if rows is None else rows.unionByName(r)
    rows = EV.mark_best_horizon(rows)
    sinks.write_json(rows, f"{out_dir}/metrics_{family}")
    return rows


def stage_scored_errors(spark: SparkSession, scored_path: str, threshold: float = M.REPORT_THRESHOLD) -> dict:
    """The error analysis of a scored test set that ``stage_model`` stored: no
    model is loaded and nothing is scored again."""
    return EV.error_analysis(spark.read.parquet(scored_path), threshold)


def stage_errors(spark: SparkSession, features_path: str, model_path: str, test_start_us: int,
                 label: str = "label_4h", threshold: float = M.REPORT_THRESHOLD) -> dict:
    """Load the saved model, read only the needed columns of the test rows
    (filter pushed to the scan), score once and aggregate."""
    model = PipelineModel.load(model_path)
    cols = list(dict.fromkeys(FEATURE_COLS + ["ts_us", label, "current_state"]))
    test = sinks.read_scored_test(spark, features_path, cols, "ts_us", test_start_us)
    scored = EV.scored_test(model, test, label, keep=["ts_us", "current_state"])
    return EV.error_analysis(scored, threshold)
