"""End-to-end stages on sf0.001 through files, and the streaming ingest."""

import os

from pyspark.sql import functions as F

from faultline.operators.split import wall_micros
from faultline.plans import stages
from faultline.sources import adapters as A
from faultline.sources.schema import MONTHS
from tests_support import SF_SMALL


def test_batch_stages(spark, tmp_out):
    raw = A.telemetry(spark, SF_SMALL)
    iv = A.intervals(spark, SF_SMALL)
    stages.stage_clean(raw, iv, tmp_out)
    clean = spark.read.parquet(f"{tmp_out}/cleaned_telemetry")
    assert clean.count() == raw.count()
    cmp = stages.stage_rules(spark, clean, A.rules(spark), tmp_out).first()
    assert cmp["true_positives"] + cmp["false_negatives"] == raw.where("Is_Dont_Go = 1").count()
    path = stages.stage_features(clean, spark.read.parquet(f"{tmp_out}/cleaned_intervals"), tmp_out)
    feats = spark.read.parquet(path)
    assert feats.count() == raw.count()
    rows = stages.stage_model(spark, path, tmp_out, "2024-01-20 23:59:59", "2024-01-21 00:00:00",
                              family="rf", n_trees=5, labels=["label_4h"]).collect()
    assert len(rows) == 1 and 0.0 <= rows[0]["f1"] <= 1.0
    test_start = spark.range(1).select(wall_micros("2024-01-21 00:00:00")).first()[0]
    rep = stages.stage_errors(spark, path, f"{tmp_out}/model_rf_label_4h", test_start)
    cm = rep["confusion_matrix"]
    assert cm["tp"] + cm["fn"] == rep["n_positives"]
    assert sum(cm.values()) == rep["n_test"]
    assert sum(rep["false_negative_distribution"]["alarm_count_4h_bin"].values()) == cm["fn"]


def test_streaming_ingest(spark, tmp_out):
    from faultline.streaming.ingest import start_clean_stream
    src = os.path.join(tmp_out, "in")
    t = A.telemetry(spark, SF_SMALL).drop("ts_us").withColumnRenamed("timestamp", "Data_Evento")
    for m in MONTHS[:2]:
        t.where(F.col("_source_month") == m).drop("_source_month").coalesce(1) \
            .write.parquet(os.path.join(src, f"telemetry_{m}.parquet"))
    schema = spark.read.parquet(os.path.join(src, "telemetry_jan.parquet")).schema
    import glob
    flat = os.path.join(tmp_out, "flat")
    os.makedirs(flat)
    for m in MONTHS[:2]:
        for f in glob.glob(os.path.join(src, f"telemetry_{m}.parquet", "*.parquet")):
            os.link(f, os.path.join(flat, f"telemetry_{m}.parquet"))
    q = start_clean_stream(spark, flat, schema, os.path.join(tmp_out, "out"), os.path.join(tmp_out, "ck"),
                           report_dir=os.path.join(tmp_out, "rep"), once=True)
    q.awaitTermination(120)
    out = spark.read.parquet(os.path.join(tmp_out, "out"))
    exp = t.where(F.col("_source_month").isin(MONTHS[:2])).count()
    assert out.count() == exp
    assert dict(out.dtypes)["Valor"] == "double"
    assert {r["_source_month"] for r in out.select("_source_month").distinct().collect()} == set(MONTHS[:2])


def test_replayed_batch_leaves_each_row_once(spark, tmp_out):
    from faultline.streaming.ingest import write_batch
    t = A.telemetry(spark, SF_SMALL).drop("ts_us")
    out, rep = os.path.join(tmp_out, "out"), os.path.join(tmp_out, "rep")
    for batch_id in (0, 1, 1):
        write_batch(t.where(F.col("_source_month") == MONTHS[batch_id]), batch_id, out, rep)
    want = t.where(F.col("_source_month").isin(MONTHS[:2])).count()
    assert spark.read.parquet(out).count() == want
    assert spark.read.json(rep).agg(F.sum("n_rows")).first()[0] == want


def test_files_are_sorted_by_time_within_months(spark, tmp_out):
    """Rows stand in time order in every file, and row-group bounds follow."""
    import glob

    import pyarrow.parquet as pq
    path = stages.stage_features(A.telemetry(spark, SF_SMALL), A.intervals(spark, SF_SMALL), tmp_out)
    files = glob.glob(os.path.join(path, "event_month=*", "*.parquet"))
    assert files
    for f in files:
        ts = pq.read_table(f, columns=["ts_us"])["ts_us"].to_pylist()
        assert ts == sorted(ts)
        m = pq.ParquetFile(f).metadata
        at = [i for i in range(m.num_columns) if m.row_group(0).column(i).path_in_schema == "ts_us"][0]
        bounds = [(m.row_group(g).column(at).statistics.min, m.row_group(g).column(at).statistics.max)
                  for g in range(m.num_row_groups)]
        assert bounds[0][0] == ts[0] and bounds[-1][1] == ts[-1]
        assert all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:]))


def test_cli_clean_rules_features(spark, tmp_out):
    from faultline.cli import main
    data = os.path.join(tmp_out, "data")
    t = A.telemetry(spark, SF_SMALL).drop("ts_us").withColumnRenamed("timestamp", "Data_Evento")
    for m in MONTHS:
        t.where(F.col("_source_month") == m).drop("_source_month") \
            .write.parquet(os.path.join(data, f"telemetry_{m}.parquet"))
    A.intervals(spark, SF_SMALL).select("Tag", "Inicio", "Fim", "Classe").write.parquet(os.path.join(tmp_out, "iv"))
    A.rules(spark).write.option("header", True).csv(os.path.join(tmp_out, "rules"))
    out = os.path.join(tmp_out, "out")
    assert main(["clean", "--data", data, "--intervals", os.path.join(tmp_out, "iv"), "--out", out]) == 0
    assert main(["rules", "--out", out, "--rules", os.path.join(tmp_out, "rules")]) == 0
    assert main(["features", "--out", out, "--bucket-hours", "6"]) == 0
    feats = spark.read.parquet(os.path.join(out, "features"))
    ref = build_features_for_check(spark)
    cols = ["alarm_count_4h", "label_4h", "current_state", "time_since_last_critical"]
    assert sorted(tuple(r) for r in feats.select("TAG", "ts_us", *cols).collect()) == \
        sorted(tuple(r) for r in ref.select("TAG", "ts_us", *cols).collect())


def build_features_for_check(spark):
    from faultline.plans.features import build_features
    return build_features(A.telemetry(spark, SF_SMALL), A.intervals(spark, SF_SMALL))


def test_model_stage_falls_back_to_ordered_split(spark, tmp_out):
    raw = A.telemetry(spark, SF_SMALL)
    path = stages.stage_features(raw, A.intervals(spark, SF_SMALL), tmp_out)
    # the source system's 2025 cut points leave no test rows on 2024 data
    rows = stages.stage_model(spark, path, tmp_out, "2025-04-30 23:59:59", "2025-05-01 00:00:00",
                              family="rf", n_trees=3, labels=["label_4h"]).collect()
    n = raw.count()
    assert rows[0]["train_rows"] == int(n * 0.8) and rows[0]["test_rows"] == n - int(n * 0.8)
    assert rows[0]["is_best"]


def test_horizons_in_parallel_and_errors_from_the_stored_scores(spark, tmp_out):
    """Fitted at the same time or one by one: the same models; the error analysis needs no model."""
    from pyspark.ml import PipelineModel
    path = stages.stage_features(A.telemetry(spark, SF_SMALL), A.intervals(spark, SF_SMALL), tmp_out)
    cut = ("2024-01-20 23:59:59", "2024-01-21 00:00:00")
    got = {}
    for name, threads in (("together", None), ("in_turn", 1)):
        rows = stages.stage_model(spark, path, f"{tmp_out}/{name}", *cut, family="rf", n_trees=4, threads=threads)
        got[name] = sorted(map(tuple, rows.collect()))
    assert got["together"] == got["in_turn"] and len(got["together"]) == 3
    for label in ("label_1h", "label_2h", "label_4h"):
        a, b = (PipelineModel.load(f"{tmp_out}/{n}/model_rf_{label}").stages[-1].toDebugString.split("\n", 1)[1]
                for n in got)
        assert a == b
    start = spark.range(1).select(wall_micros(cut[1])).first()[0]
    assert stages.stage_scored_errors(spark, f"{tmp_out}/together/scored_rf_label_4h", .3) == stages.stage_errors(
        spark, path, f"{tmp_out}/together/model_rf_label_4h", start, threshold=.3)
