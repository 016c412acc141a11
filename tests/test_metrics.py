"""Metrics (S22-S25, E7, E8)."""

import random

import pytest

from faultline.operators import metrics as M


def _e7(spark):
    return spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1), (0.6, 0), (0.5, 1), (0.5, 0)], "y_prob double, y int")


@pytest.mark.parametrize("part_rows", [1, 2, 4, 256])
def test_e7_ranking(spark, part_rows):
    r = M.ranking_metrics(_e7(spark), part_rows=part_rows).first()
    assert r["auc_pr"] == pytest.approx(0.722222, abs=1e-6)
    assert r["auc_roc"] == pytest.approx(0.611111, abs=1e-6)


def test_e7_threshold(spark):
    df = _e7(spark).withColumn("y_pred", M.predict("y_prob", 0.7))
    r = M.with_rates(M.confusion_counts(df)).first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (2, 1, 1, 2)
    assert r["precision"] == pytest.approx(2 / 3) and r["recall"] == pytest.approx(2 / 3)
    assert r["f1"] == pytest.approx(2 / 3)


def test_one_class(spark):
    df = spark.createDataFrame([(0.9, 0), (0.1, 0)], "y_prob double, y int")
    r = M.ranking_metrics(df).first()
    assert r["auc_roc"] == 0.0 and r["auc_pr"] == 0.0
    s = M.threshold_sweep(df).collect()
    assert all(x["precision"] == 0.0 and x["recall"] == 0.0 and x["f1"] == 0.0 for x in s)


def _brute(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap, prev_r = 0.0, 0.0
    for t in sorted({s for s, _ in pairs}, reverse=True):
        sel = [y for s, y in pairs if s >= t]
        tp = sum(sel)
        r = tp / len(pos)
        ap += (r - prev_r) * (tp / len(sel))
        prev_r = r
    return auc, ap


@pytest.mark.parametrize("seed", [1, 2])
def test_ranking_vs_brute_force(spark, seed):
    rnd = random.Random(seed)
    pairs = [(round(rnd.random(), 2), int(rnd.random() < 0.3)) for _ in range(400)]
    auc, ap = _brute(pairs)
    r = M.ranking_metrics(spark.createDataFrame(pairs, "y_prob double, y int"), part_rows=8).first()
    assert r["auc_roc"] == pytest.approx(auc, abs=1e-6)
    assert r["auc_pr"] == pytest.approx(ap, abs=1e-6)


def test_sweep_matches_single_thresholds(spark):
    df = _e7(spark)
    sweep = {r["threshold"]: r for r in M.threshold_sweep(df).collect()}
    for t in M.THRESHOLDS:
        one = M.with_rates(M.confusion_counts(df.withColumn("y_pred", M.predict("y_prob", t)))).first()
        assert (sweep[t]["tp"], sweep[t]["fp"], sweep[t]["fn"], sweep[t]["tn"]) == \
            (one["tp"], one["fp"], one["fn"], one["tn"])


def test_e8_bins_and_slices(spark):
    counts = [0, 5, 6, 10, 11, 20, 21]
    rows = [(1, 0, c, 1 if i % 2 else 0, "Operando" if i < 3 else "Parado") for i, c in enumerate(counts)]
    df = spark.createDataFrame(rows, "y int, y_pred int, alarm_count_4h int, tipo_caminhao int, current_state string")
    s = {(r["dimension"], r["key"]): r["fn"] for r in M.fn_slices(df).collect()}
    assert s[("alarm_count_4h_bin", "0-5")] == 2 and s[("alarm_count_4h_bin", "6-10")] == 2
    assert s[("alarm_count_4h_bin", "11-20")] == 2 and s[("alarm_count_4h_bin", "21+")] == 1
    assert s[("total", "all")] == 7
    assert s[("tipo_caminhao", "caminhao")] + s[("tipo_caminhao", "escavadeira")] == 7
    assert s[("current_state", "Operando")] == 3 and s[("current_state", "Parado")] == 4
    empty = df.where("y = 0")
    s2 = {(r["dimension"], r["key"]): r["fn"] for r in M.fn_slices(empty).collect()}
    assert s2[("alarm_count_4h_bin", "21+")] == 0 and s2[("tipo_caminhao", "caminhao")] == 0


def test_s25_month_without_positives(spark):
    day = 86_400_000_000
    jan, feb = 1_735_689_600_000_000, 1_735_689_600_000_000 + 40 * day
    df = spark.createDataFrame([(jan, 1, 1), (jan, 1, 0), (feb, 0, 0)], "ts_us long, y int, y_pred int")
    got = {r["month"]: (r["recall"], r["tp"], r["fn"], r["positives"]) for r in M.recall_by_month(df).collect()}
    assert got == {"2025-01": (0.5, 1, 1, 2), "2025-02": (0.0, 0, 0, 0)}


def test_ranking_stable_under_repartition(spark):
    from faultline.sources import adapters as A
    from tests_support import SF_SMALL
    s = A.scored(spark, SF_SMALL)
    ref = M.ranking_metrics(s).first()
    for n in (1, 11):
        r = M.ranking_metrics(s.repartition(n), part_rows=5).first()
        assert (r["auc_roc"], r["auc_pr"], r["n_pos"]) == (ref["auc_roc"], ref["auc_pr"], ref["n_pos"])
