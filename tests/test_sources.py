"""Scans, schema checks, sinks and pushed-down reads (items 1-14)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from faultline.sources import adapters as A
from faultline.sources import sinks
from faultline.sources.schema import MONTHS, SchemaError
from faultline.sources.telemetry import load_intervals, load_rules, load_telemetry
from tests_support import SF_SMALL


def _write_months(spark, out, drop=None, skip=None):
    t = A.telemetry(spark, SF_SMALL).drop("ts_us").withColumnRenamed("timestamp", "Data_Evento")
    for m in MONTHS:
        if m == skip:
            continue
        part = t.where(F.col("_source_month") == m).drop("_source_month")
        if drop and m == "mar":
            part = part.drop(drop)
        part.write.mode("overwrite").parquet(os.path.join(out, f"telemetry_{m}.parquet"))


def test_load_six_months(spark, tmp_out):
    _write_months(spark, tmp_out)
    df = load_telemetry(spark, tmp_out)
    assert "timestamp" in df.columns and "Data_Evento" not in df.columns
    got = {r["_source_month"]: r["n"] for r in df.groupBy("_source_month").agg(F.count("*").alias("n")).collect()}
    ref = {r["_source_month"]: r["n"] for r in A.telemetry(spark, SF_SMALL).groupBy("_source_month")
           .agg(F.count("*").alias("n")).collect()}
    assert got == ref and set(got) == set(MONTHS)


def test_missing_file(spark, tmp_out):
    _write_months(spark, tmp_out, skip="may")
    with pytest.raises(FileNotFoundError):
        load_telemetry(spark, tmp_out)


def test_missing_column(spark, tmp_out):
    _write_months(spark, tmp_out, drop="Tipo")
    with pytest.raises(SchemaError):
        load_telemetry(spark, tmp_out)


def test_wrong_type(spark, tmp_out):
    _write_months(spark, tmp_out)
    bad = os.path.join(tmp_out, "bad")
    os.makedirs(bad)
    for m in MONTHS:
        df = spark.read.parquet(os.path.join(tmp_out, f"telemetry_{m}.parquet"))
        if m == "jun":
            df = df.withColumn("Is_Dont_Go", F.col("Is_Dont_Go").cast("string"))
        df.write.parquet(os.path.join(bad, f"telemetry_{m}.parquet"))
    with pytest.raises(SchemaError):
        load_telemetry(spark, bad)


def test_intervals_and_rules(spark, tmp_out):
    iv = A.intervals(spark, SF_SMALL).select(F.col("Tag").alias("TAG"), F.col("Inicio").cast("string").alias("Inicio"),
                                             F.col("Fim").cast("string").alias("Fim"), "Classe")
    iv.write.parquet(os.path.join(tmp_out, "iv.parquet"))
    got = load_intervals(spark, os.path.join(tmp_out, "iv.parquet"))
    assert "Tag" in got.columns and dict(got.dtypes)["Inicio"].startswith("timestamp")
    A.rules(spark).write.option("header", True).csv(os.path.join(tmp_out, "rules.csv"))
    r = load_rules(spark, os.path.join(tmp_out, "rules.csv"))
    assert r.count() == 7 and dict(r.dtypes)["QTD"] == "int"


def test_sinks_roundtrip_accents(spark, tmp_out):
    df = spark.createDataFrame([("Não Crítico", "jan", 1), ("Manutenção", "feb", 2)], "s string, _source_month string, x int")
    sinks.write_parquet(df, os.path.join(tmp_out, "p"), partition_by=["_source_month"], sort_within=["x"])
    back = spark.read.parquet(os.path.join(tmp_out, "p"))
    assert sorted(r["s"] for r in back.collect()) == ["Manutenção", "Não Crítico"]
    sinks.write_csv(df, os.path.join(tmp_out, "c"))
    sinks.write_json(df, os.path.join(tmp_out, "j"))
    lines = [json.loads(x) for f in os.listdir(os.path.join(tmp_out, "j")) if f.endswith(".json")
             for x in open(os.path.join(tmp_out, "j", f), encoding="utf-8")]
    assert {d["s"] for d in lines} == {"Não Crítico", "Manutenção"}
    rep = spark.createDataFrame([("a\nb",)], "summary string")
    sinks.write_text_report(rep, os.path.join(tmp_out, "t"))


def test_pushed_filter_and_pruned_columns(spark, tmp_out):
    df = spark.createDataFrame([(i, i * 10, float(i)) for i in range(100)], "ts_us long, a long, b double")
    df.write.parquet(os.path.join(tmp_out, "f.parquet"))
    r = sinks.read_scored_test(spark, os.path.join(tmp_out, "f.parquet"), ["ts_us", "a"], "ts_us", 50)
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts_us), GreaterThanOrEqual(ts_us,50)]" in plan
    assert "ReadSchema: struct<ts_us:bigint,a:bigint>" in plan
    assert r.count() == 50


def test_month_partition_pruning(spark, tmp_out):
    day = 86_400_000_000
    jan = 1_735_689_600_000_000
    rows = [(jan + i * day, i, "2025-01" if i < 31 else "2025-02") for i in range(50)]
    df = spark.createDataFrame(rows, "ts_us long, a long, event_month string")
    sinks.write_parquet(df, os.path.join(tmp_out, "m"), partition_by=["event_month"], sort_within=["ts_us"])
    r = sinks.read_scored_test(spark, os.path.join(tmp_out, "m"), ["ts_us", "a"], "ts_us", jan + 40 * day)
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in plan and "2025-02" in plan
    assert r.count() == 10
