"""Appended months against the full build; shifts, gaps and observed counters."""

import random

import pytest
from pyspark.sql import functions as F

from faultline.operators import quality as Q
from faultline.operators import shifts
from faultline.plans import incremental
from faultline.plans.features import build_features
from faultline.sources import adapters as A
from tests_support import SF_SMALL

HOUR = 3_600_000_000
RAW = "TAG string, ts_us bigint, event_id bigint, Id_Criticidade int, Is_Dont_Go int, Tipo string"
IV = "Tag string, inicio_us bigint, fim_us bigint, Classe string"


def random_events(seed, hours, n):
    r = random.Random(seed)
    rows = [(r.choice(["A", "B", "C", None]), r.randrange(hours * 4) * HOUR // 4, k, r.randrange(1, 5), int(r.random() < .15),
             r.choice(["Caminhao", "Escavadeira", None])) for k in range(n)]
    iv = [(r.choice("ABC"), r.randrange(hours) * HOUR + k, 0, f"S{k}") for k in range(40)]
    return rows, [(t, a, a + r.randrange(-1, 30) * HOUR, c) for t, a, _, c in iv]


def appended(spark, path, rows, iv, cuts):
    edges = [-1, *cuts, 1 << 60]
    for k, (lo, hi) in enumerate(zip(edges, edges[1:]), 1):
        incremental.append_month(spark, path, k,
                                 spark.createDataFrame([x for x in rows if lo <= x[1] < hi], RAW),
                                 spark.createDataFrame([x for x in iv if lo <= x[1] < hi], IV))
    return incremental.read_features(spark, path, len(cuts) + 1)


@pytest.mark.parametrize("seed,cuts", [(1, [20, 40]), (2, [1, 2, 3, 50])])
def test_appending_equals_the_full_build(spark, tmp_out, seed, cuts):
    """Months shorter than the windows, empty months, silent equipment."""
    rows, iv = random_events(seed, 60, 260)
    rows.append(("D", 0, 9_999, 1, 0, "Caminhao"))          # one early event only
    full = build_features(spark.createDataFrame(rows, RAW), spark.createDataFrame(iv, IV), keep=["event_id"])
    got = appended(spark, tmp_out, rows, iv, [c * HOUR for c in cuts])
    assert sorted(map(tuple, got.select(*full.columns).collect())) == sorted(map(tuple, full.collect()))


def test_equal_instants_at_the_seam_and_late_rows(spark, tmp_out):
    first = [("A", 0, 1, 1, 0, "Caminhao"), ("A", 10 * HOUR, 2, 2, 0, None), ("A", 10 * HOUR, 3, 2, 0, None)]
    second = [("A", 10 * HOUR, 4, 1, 1, None), ("A", 14 * HOUR, 5, 2, 1, None)]
    none = spark.createDataFrame([], IV)
    incremental.append_month(spark, tmp_out, 1, spark.createDataFrame(first, RAW), none)
    incremental.append_month(spark, tmp_out, 2, spark.createDataFrame(second, RAW), none)
    incremental.append_month(spark, tmp_out, 2, spark.createDataFrame(second, RAW), none)    # run again after a failure
    full = build_features(spark.createDataFrame(first + second, RAW), none, keep=["event_id"])
    got = incremental.read_features(spark, tmp_out, 2)
    assert sorted(map(tuple, got.select(*full.columns).collect())) == sorted(map(tuple, full.collect()))
    with pytest.raises(ValueError):
        incremental.append_month(spark, tmp_out, 3, spark.createDataFrame([("A", HOUR, 9, 1, 0, None)], RAW), none)


def test_a_month_touches_only_itself_and_the_seam(spark, tmp_out):
    rows, iv = random_events(3, 400, 900)
    appended(spark, tmp_out, rows, iv, [100 * HOUR, 390 * HOUR])
    tail = spark.read.parquet(f"{tmp_out}/state/batch=2/tail")
    seam = spark.read.parquet(f"{tmp_out}/state/batch=2/seam").first()["seam"]
    assert tail.agg(F.min("ts_us")).first()[0] > seam - 2 * incremental.REACH
    assert spark.read.parquet(f"{tmp_out}/state/batch=2/carry").count() <= 3
    out = spark.read.parquet(f"{tmp_out}/features/batch=3")
    assert out.agg(F.min("ts_us")).first()[0] >= seam - incremental.REACH


def test_shifts_cross_midnight(spark):
    at = {"2024-03-01 05:59:59": ("2024-02-29", "night"), "2024-03-01 06:00:00": ("2024-03-01", "morning"),
          "2024-03-01 13:59:59": ("2024-03-01", "morning"), "2024-03-01 14:00:00": ("2024-03-01", "afternoon"),
          "2024-03-01 21:59:59": ("2024-03-01", "afternoon"), "2024-03-01 22:00:00": ("2024-03-01", "night"),
          "2024-01-01 00:00:00": ("2023-12-31", "night"), "1969-12-31 23:00:00": ("1969-12-31", "night")}
    df = spark.createDataFrame([(t,) for t in at], "t string").withColumn("ts_us", F.unix_micros(F.to_timestamp("t")))
    day, shift = shifts.shift_of()
    assert {r["t"]: (r["d"], r["s"]) for r in df.select("t", day.alias("d"), shift.alias("s")).collect()} == at


def test_alarms_by_shift_counts_every_listed_alarm(spark):
    rows = [("A", "x", 7 * HOUR), ("A", "x", 8 * HOUR), ("A", "y", 8 * HOUR), ("A", "z", 15 * HOUR), ("B", "y", None)]
    got = shifts.alarms_by_shift(spark.createDataFrame(rows, "TAG string, Alarme string, ts_us bigint"), ["x", "y"])
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, [
        ("A", "1970-01-01", "morning", 2, 1), ("A", "1970-01-01", "afternoon", 0, 0), ("B", None, None, 0, 1)]))


@pytest.mark.parametrize("silent", [1, 5, 48])
def test_tag_gaps_equal_brute_force(spark, silent):
    r = random.Random(silent)
    rows = [(t, r.randrange(0, 900) * HOUR + r.randrange(HOUR)) for t in "AAAB" for _ in range(25)] + [("C", 5), (None, 7), ("D", None)]
    got = {x["TAG"]: x for x in Q.tag_gaps(spark.createDataFrame(rows, "TAG string, ts_us bigint"), silent_hours=silent).collect()}
    assert set(got) == {"A", "B", "C"}
    for tag, x in got.items():
        hours = sorted({u // HOUR for t, u in rows if t == tag and u is not None})
        gaps = [(a, b) for a, b in zip(hours, hours[1:]) if b - a > silent]
        assert (x["n_sessions"], x["n_gaps"]) == (len(gaps) + 1, len(gaps))
        assert x["longest_gap_hours"] == max((b - a - 1 for a, b in gaps), default=0)
        assert len(x["gap_days"]) == len({(a + 1) // 24 for a, _ in gaps}) and list(x["gap_days"]) == sorted(x["gap_days"])


def test_report_lists(spark):
    raw = spark.createDataFrame([("A", 0), ("A", 24 * 40 * HOUR), ("B", 5), ("C", 7)], "TAG string, ts_us bigint")
    iv = spark.createDataFrame([("A",)], "Tag string")
    r = Q.report_lists(raw, iv).first()
    assert (r["tag_mismatches"], r["gap_months"], r["n_rows"]) == (["B", "C"], ["1970-01"], 4)


def test_counters_come_from_the_write(spark, tmp_out):
    A.telemetry(spark, SF_SMALL).write.parquet(f"{tmp_out}/raw")
    raw = spark.read.parquet(f"{tmp_out}/raw")
    plans = []

    def write(clean):
        plans.append(clean._jdf.queryExecution().executedPlan().toString())
        clean.write.parquet(f"{tmp_out}/clean")
    got = Q.clean_and_count(raw, write).first()
    assert got == Q.quality_counts(raw).first()
    assert len(plans) == 1 and plans[0].count("FileScan") == 1 and "CollectMetrics" in plans[0]
    assert spark.read.parquet(f"{tmp_out}/clean").count() == raw.count()


def test_months_are_stored_apart_in_one_pass(spark, tmp_out):
    raw = spark.createDataFrame([("A", 5), ("B", 15), (None, 25), ("C", None), ("D", 21)], "TAG string, u bigint")
    month = sum(((F.col("u") >= lo).cast("int") for lo in (10, 20)), F.lit(1))
    got = incremental.by_month(raw, month, f"{tmp_out}/in")
    assert sorted(map(repr, map(tuple, got.select("_month", "TAG", "u").collect()))) == sorted(map(repr, [
        (1, "A", 5), (2, "B", 15), (3, None, 25), (3, "D", 21)]))
    assert len(got.where("_month = 2").inputFiles()) >= 1 and "PartitionFilters: [isnotnull(_month" in \
        got.where("_month = 2")._jdf.queryExecution().executedPlan().toString()
    none = incremental.by_month(raw.limit(0), month, f"{tmp_out}/none")
    assert none.where("_month = 1").count() == 0 and none.columns == got.columns


def test_the_appended_months_read_the_events_once(spark, monkeypatch):
    from faultline.plans import catalog, catalog_more
    read = []

    def append(session, path, k, tele, intervals):
        read.extend(f for df in (tele, intervals) for f in df.inputFiles())
        return plain(session, path, k, tele, intervals)
    plain = incremental.append_month
    monkeypatch.setattr(incremental, "append_month", append)
    got = catalog_more.features_by_month_append(spark, SF_SMALL)
    assert read and not any(f.endswith("events.parquet") or "/events.parquet/" in f for f in read)
    full = catalog.feature_matrix(spark, SF_SMALL)
    assert sorted(map(tuple, got.select(*full.columns).collect())) == sorted(map(tuple, full.collect()))
