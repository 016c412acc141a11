"""Rule de-duplication and per-row rule windows (S11-S13, E5, E11)."""

import pytest
from pyspark.sql import functions as F

from faultline.operators.rules import apply_rules, compare_signals, dedupe_rules, rule_rejects
from faultline.sources.schema import RULES_SCHEMA
from helpers import MIN, T0


def _tele(spark, rows):
    df = spark.createDataFrame(rows, "event_id long, TAG string, Alarme string, m double, Is_Dont_Go int")
    return df.withColumn("ts_us", (F.lit(T0) + (F.col("m") * MIN).cast("long"))).drop("m")


def _rules(spark, rows):
    return spark.createDataFrame(rows, RULES_SCHEMA)


def test_dedupe_keeps_most_restrictive(spark):
    r = dedupe_rules(_rules(spark, [("AL01", 3, 60), ("AL01", 3, 30), ("AL01", 5, 10), ("AL02", 1, 5)]))
    got = {x["EVENTO"]: (x["QTD"], x["TEMPO"]) for x in r.collect()}
    assert got == {"AL01": (3, 30), "AL02": (1, 5)}


@pytest.mark.parametrize("bucket_min", [7, 30, 24 * 60])
def test_e5_rule_windows(spark, bucket_min):
    rows = []
    groups = {"A": [0, 10, 20], "B": [0, 10], "C": [0, 40, 80], "D": [0, 15, 30]}
    i = 0
    for tag, ms in groups.items():
        for m in ms:
            rows.append((i, tag, "AL01", float(m), 0))
            i += 1
    rows.append((i, "A", "UNRULED", 5.0, 1))
    rows.append((i + 1, None, "AL01", 20.0, 0))
    out = apply_rules(_tele(spark, rows), _rules(spark, [("AL01", 3, 30)]), bucket_us=bucket_min * MIN)
    got = {r["event_id"]: r["Is_Dont_Go_derived"] for r in out.collect()}
    assert len(got) == len(rows)
    assert [got[k] for k in range(0, 3)] == [0, 0, 1]
    assert [got[k] for k in range(3, 5)] == [0, 0]
    assert [got[k] for k in range(5, 8)] == [0, 0, 0]
    assert [got[k] for k in range(8, 11)] == [0, 0, 0]
    assert got[11] == 0 and got[12] == 0


def test_peer_inclusive_ties(spark):
    rows = [(0, "A", "AL01", 0.0, 0), (1, "A", "AL01", 15.0, 0), (2, "A", "AL01", 15.0, 0),
            (3, "A", "AL01", 15.0, 0), (4, "A", "AL01", 30.0, 0)]
    out = apply_rules(_tele(spark, rows), _rules(spark, [("AL01", 3, 15)]))
    got = {r["event_id"]: r["Is_Dont_Go_derived"] for r in out.collect()}
    assert [got[k] for k in range(5)] == [0, 1, 1, 1, 0]


def test_no_lookahead(spark):
    rows = [(0, "A", "AL01", 0.0, 0), (1, "A", "AL01", 1.0, 0), (2, "A", "AL01", 2.0, 0)]
    out = apply_rules(_tele(spark, rows), _rules(spark, [("AL01", 2, 60)]))
    got = {r["event_id"]: r["Is_Dont_Go_derived"] for r in out.collect()}
    assert got == {0: 0, 1: 1, 2: 1}


def test_compare_signals(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (0, 0)], "Is_Dont_Go int, Is_Dont_Go_derived int")
    r = compare_signals(df).first()
    assert (r["true_positives"], r["false_positives"], r["false_negatives"], r["true_negatives"]) == (1, 1, 1, 2)
    assert r["precision"] == 0.5 and r["recall"] == 0.5
    none = spark.createDataFrame([(0, 0)], "Is_Dont_Go int, Is_Dont_Go_derived int")
    r = compare_signals(none).first()
    assert r["precision"] == 0.0 and r["recall"] == 0.0


def test_rules_match_brute_force_on_adapter(spark):
    """Sweep line vs a direct per-row count on sf0.001."""
    from faultline.sources import adapters as A
    from tests_support import SF_SMALL
    t = A.telemetry(spark, SF_SMALL).select("event_id", "TAG", "Alarme", "ts_us", "Is_Dont_Go")
    rules = A.rules(spark)
    got = {r["event_id"]: r["Is_Dont_Go_derived"]
           for r in apply_rules(t, rules, bucket_us=60 * MIN).collect()}
    dd = {r["EVENTO"]: (r["QTD"], r["TEMPO"]) for r in dedupe_rules(rules).collect()}
    rows = t.collect()
    for r in rows:
        if r["Alarme"] not in dd:
            assert got[r["event_id"]] == 0
            continue
        q, w = dd[r["Alarme"]]
        n = sum(1 for o in rows if o["TAG"] == r["TAG"] and o["Alarme"] == r["Alarme"]
                and r["ts_us"] - w * MIN < o["ts_us"] <= r["ts_us"])
        assert got[r["event_id"]] == int(n >= q)


def test_rules_stable_under_repartition(spark):
    from faultline.sources import adapters as A
    from tests_support import SF_SMALL
    t = A.telemetry(spark, SF_SMALL).select("event_id", "TAG", "Alarme", "ts_us", "Is_Dont_Go")
    ref = sorted(tuple(r) for r in apply_rules(t, A.rules(spark)).collect())
    for n in (1, 13):
        assert sorted(tuple(r) for r in apply_rules(t.repartition(n), A.rules(spark)).collect()) == ref


def test_row_ties(spark):
    rows = [(0, "A", "AL01", 0.0, 0), (1, "A", "AL01", 15.0, 0), (2, "A", "AL01", 15.0, 0),
            (3, "A", "AL01", 15.0, 0), (4, "A", "AL01", 30.0, 0)]
    rules = _rules(spark, [("AL01", 2, 15)])
    rng = {r["event_id"]: r["Is_Dont_Go_derived"] for r in apply_rules(_tele(spark, rows), rules).collect()}
    row = {r["event_id"]: r["Is_Dont_Go_derived"]
           for r in apply_rules(_tele(spark, rows), rules, ties="row", tiebreak="event_id").collect()}
    assert [rng[k] for k in range(5)] == [0, 1, 1, 1, 0]
    assert [row[k] for k in range(5)] == [0, 0, 1, 1, 0]


def test_missing_or_non_positive_lengths_are_rejected(spark):
    rules = _rules(spark, [("AL01", 1, None), ("AL01", 1, 30), ("AL02", None, 5), ("AL03", 1, 0), ("AL04", 1, -5),
                           (None, 1, 5), ("AL01", 2, 10)])
    assert [tuple(r) for r in dedupe_rules(rules).collect()] == [("AL01", 1, 30)]
    assert tuple(rule_rejects(rules).first()) == (7, 5, 1)


def test_forty_lengths_leave_no_null_flag(spark):
    rows = [(i, "A", f"AL{i % 40:02d}", float(i), 0) for i in range(200)]
    rules = _rules(spark, [(f"AL{k:02d}", 1, 5 + k) for k in range(40)])
    got = [r["Is_Dont_Go_derived"] for r in apply_rules(_tele(spark, rows), rules).collect()]
    assert got == [1] * 200


def test_length_far_beyond_the_bucket_makes_no_copies(spark):
    """A 30-day rule over one-minute buckets."""
    rows = [(0, "A", "AL01", 0.0, 0), (1, "A", "AL01", 29 * 1440.0, 0), (2, "A", "AL01", 31 * 1440.0, 0)]
    out = apply_rules(_tele(spark, rows), _rules(spark, [("AL01", 2, 30 * 1440)]), bucket_us=MIN)
    assert {r["event_id"]: r["Is_Dont_Go_derived"] for r in out.collect()} == {0: 0, 1: 1, 2: 1}


def test_crowded_instant_is_one_row_of_the_sweep(spark):
    rows = [(i, "A", "AL01", 5.0, 0) for i in range(500)]
    out = apply_rules(_tele(spark, rows), _rules(spark, [("AL01", 500, 1)]))
    assert [r["Is_Dont_Go_derived"] for r in out.collect()] == [1] * 500
