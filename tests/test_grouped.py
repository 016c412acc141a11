"""Reports by group, forward chaining, baselines and importances in one job."""

import random

import pytest
from pyspark.sql import functions as F

from faultline.operators import metrics as M
from faultline.operators import ml, validation
from faultline.operators.grouped import grouped_cumulative, grouped_scores, long_form, report_by_group

SCHEMA = "g string, h int, y int, y_prob double"


def random_rows(seed, n, groups):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        g = "hot" if r.random() < .4 else r.choice(groups)
        y = None if r.random() < .03 else int(r.random() < {"none": 0, "all": 1}.get(g, .3))
        out.append((g, r.randrange(2), y, None if r.random() < .03 else r.randrange(25) / 20))
    return out


def brute(rows, threshold):
    """Pairwise ROC-AUC and step-wise average precision of (y, score) rows."""
    rows = [(y, s) for y, s in rows if y is not None and s is not None]
    pos, neg = [s for y, s in rows if y == 1], [s for y, s in rows if y != 1]
    tp, fp = sum(s >= threshold for s in pos), sum(s >= threshold for s in neg)
    auc = ap = 0.0
    if pos and neg:
        auc = sum((p > n) + .5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
        for s in set(pos):
            above_p, above_n = sum(p >= s for p in pos), sum(n >= s for n in neg)
            ap += pos.count(s) * above_p / (above_p + above_n)
        ap /= len(pos)
    return tp, fp, len(pos) - tp, len(neg) - fp, round(auc, 6), round(ap, 6)


@pytest.mark.parametrize("part_rows", [3, 7, 1_000_000])
def test_report_equals_brute_force_for_any_partitioning(spark, part_rows):
    rows = random_rows(1, 900, ["a", "b", "none", "all", None, ""])
    got = report_by_group(spark.createDataFrame(rows, SCHEMA).repartition(5), ["g", "h"], part_rows=part_rows).collect()
    keys = {(g, h) for g, h, y, s in rows if y is not None and s is not None}
    assert {(r["g"], r["h"]) for r in got} == keys and len(got) == len(keys)
    for r in got:
        want = brute([(y, s) for g, h, y, s in rows if (g, h) == (r["g"], r["h"])], .5)
        assert (r["tp"], r["fp"], r["fn"], r["tn"], r["auc_roc"], r["auc_pr"]) == pytest.approx(want, abs=1e-6)
        assert r["n_pos"] == r["tp"] + r["fn"] and r["n_neg"] == r["fp"] + r["tn"]


def test_one_group_equals_the_plain_report(spark):
    df = spark.createDataFrame(random_rows(2, 500, ["a"]), SCHEMA)
    one = M.classification_report(df, "y", "y_prob", .5).first().asDict()
    got = report_by_group(df.withColumn("all", F.lit(1)), ["all"]).first().asDict()
    assert all(got[k] == one[k] for k in ("tp", "fp", "fn", "tn", "precision", "recall", "f1", "auc_roc", "auc_pr"))


def test_given_predictions_and_empty_input(spark):
    df = spark.createDataFrame([("a", 1, 1, .1), ("a", 0, 0, .9)], "g string, p int, y int, y_prob double")
    r = report_by_group(df, ["g"], pred="p").first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"], r["auc_roc"]) == (1, 0, 0, 1, 0.0)
    assert report_by_group(df.limit(0), ["g"]).collect() == []


def test_a_hot_group_spreads_over_partitions(spark):
    df = spark.range(400).select(F.lit("hot").alias("g"), (F.col("id") % 3 == 0).cast("int").alias("y"),
                                 (F.col("id") / 400).alias("y_prob"))
    cum = grouped_cumulative(grouped_scores(df, ["g"]), ["g"], part_rows=50)
    plan = cum._jdf.queryExecution().executedPlan().toString()
    # windows run per partition and group, never per group over the scores
    assert "hashpartitioning(_b" in plan and "SinglePartition" not in plan
    assert cum.agg(F.max("cum_pos") + F.max("cum_neg")).first()[0] == 400


def test_long_form_reads_the_rows_once(spark, tmp_out):
    spark.range(10).withColumn("y", F.lit(1)).write.parquet(f"{tmp_out}/t")
    rows = long_form(spark.read.parquet(f"{tmp_out}/t"), "v", {k: {"y_prob": F.lit(k / 3)} for k in range(3)}, ["id", "y"])
    assert rows.count() == 30
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_folds_purge_labels_that_look_into_the_test_window(spark):
    """Brute force over instants at and around the cuts; no training label sees a test event."""
    cuts, horizon = [100, 200, 250], 30
    rows = [(u, int(u % 7 == 0)) for u in [*range(0, 300, 3), 69, 70, 71, 99, 100, 169, 170, 199, 200, 249, 250, None]
            if u is not None] + [(None, 1)]
    folds = validation.expanding_folds(spark.createDataFrame(rows, "ts_us bigint, y int"), cuts, horizon)
    got = sorted((r["fold"], r["ts_us"], r["role"]) for r in folds.collect())
    want = []
    for k, (a, b) in enumerate(zip(cuts, cuts[1:]), 1):
        for u, _ in rows:
            if u is not None and u < b:
                # the label covers (u, u + horizon]
                want.append((k, u, "test" if u >= a else "train" if u + horizon < a + 1 else "purged"))
    assert got == sorted(want)
    assert all(u + horizon <= cuts[k - 1] for k, u, role in got if role == "train")
    c = {r["fold"]: r for r in validation.fold_counts(folds, "y").collect()}
    for k in (1, 2):
        mine = [(u, role) for f, u, role in got if f == k]
        assert c[k]["train_rows"] == sum(r == "train" for _, r in mine)
        assert c[k]["purged_rows"] == sum(r == "purged" for _, r in mine)
        assert c[k]["test_positives"] == sum(r == "test" and u % 7 == 0 for u, r in mine)
    with pytest.raises(ValueError):
        validation.expanding_folds(folds, [2, 1], 1)


def test_permutation_importance_in_one_pass(spark):
    """A score that is one feature: only shuffling that feature loses it."""
    df = spark.range(600).select(F.col("id").alias("event_id"), (F.col("id") % 2).cast("int").alias("y"),
                                 (F.col("id") % 2).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"))
    calls = []

    def scored(d):
        calls.append(1)
        return d.withColumn("y_prob", F.col("a"))
    got = {r["feature"]: r for r in ml.permutation_importance(scored, df, ["a", "b"], "y", "event_id").collect()}
    assert len(calls) == 1
    assert got["a"]["base_auc"] == 1.0 and got["a"]["drop"] > .3
    assert got["b"]["drop"] == 0.0
