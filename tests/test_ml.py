"""Model training, scoring and baselines (items 52, 78-86)."""

import pytest
from pyspark.sql import functions as F

from faultline.operators import metrics as M
from faultline.operators import ml
from faultline.plans import evaluation as EV
from faultline.plans.features import FEATURE_COLS, build_features
from faultline.sources import adapters as A
from tests_support import SF_SMALL


@pytest.fixture(scope="module")
def split(spark):
    from faultline.operators.split import temporal_split
    f = build_features(A.telemetry(spark, SF_SMALL), A.intervals(spark, SF_SMALL), keep=["event_id"]).cache()
    yield temporal_split(f, "ts_us", "2024-01-20 23:59:59", "2024-01-21 00:00:00")
    f.unpersist()


def test_class_balance(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    r = ml.class_balance(df, "y").first()
    assert (r["n_neg"], r["n_pos"], r["scale_pos_weight"]) == (3, 1, 3.0)
    r = ml.class_balance(df.where("y = 0"), "y").first()
    assert r["scale_pos_weight"] == 1.0


@pytest.mark.parametrize("family", ["gbt", "rf"])
def test_training_is_deterministic(spark, split, family):
    train, test = split
    a = ml.score(ml.train(train, FEATURE_COLS, "label_4h", family=family, n_trees=5), test)
    b = ml.score(ml.train(train, FEATURE_COLS, "label_4h", family=family, n_trees=5), test)
    pa = sorted((r["event_id"], r["y_prob"]) for r in a.select("event_id", "y_prob").collect())
    pb = sorted((r["event_id"], r["y_prob"]) for r in b.select("event_id", "y_prob").collect())
    assert pa == pb
    assert all(0.0 <= p <= 1.0 for _, p in pa)


def test_model_metrics_contract(spark, split):
    train, test = split
    model, sc, n_train, spw = EV.train_and_score(train, test, "label_4h", "gbt", n_trees=3)
    r = EV.model_metrics(spark, "gbt", "label_4h", sc, n_train, spw).first()
    for k in ("precision", "recall", "f1", "auc_roc", "auc_pr"):
        assert 0.0 <= r[k] <= 1.0
    assert r["train_rows"] == train.count() and r["test_rows"] == test.count()
    sweep = M.threshold_sweep(sc).collect()
    assert [x["threshold"] for x in sweep] == [0.3, 0.5, 0.7]
    imp = ml.feature_importances(spark, model, FEATURE_COLS).collect()
    assert len(imp) == len(FEATURE_COLS)


def test_baselines(spark, split):
    train, test = split
    rows = {r["model"]: r for r in EV.baseline_rows(spark, train, test, "label_4h", ["event_id"]).collect()}
    assert set(rows) == {"dummy_most_frequent", "dummy_stratified", "heuristic_critical_1h"}
    maj = rows["dummy_most_frequent"]
    assert maj["tp"] == 0 and maj["fp"] == 0 and maj["f1"] == 0.0 and maj["auc_roc"] == 0.5
    again = {r["model"]: r for r in EV.baseline_rows(spark, train, test.repartition(5), "label_4h",
                                                        ["event_id"]).collect()}
    assert again["dummy_stratified"]["tp"] == rows["dummy_stratified"]["tp"]
    h = rows["heuristic_critical_1h"]
    exp = test.where((F.col("critical_alarm_count_1h") > 0) & (F.col("label_4h") == 1)).count()
    assert h["tp"] == exp
    comp = EV.comparison(EV.baseline_rows(spark, train, test, "label_4h", ["event_id"]),
                         ["dummy_most_frequent", "dummy_stratified", "heuristic_critical_1h"]).collect()
    assert sum(r["is_winner"] for r in comp) == 1


def test_error_analysis_invariants(spark):
    rows = [(i, i % 3 == 0, (i * 37 % 100) / 100.0, i % 25, "Operando" if i % 2 else "Parado", i % 2)
            for i in range(300)]
    df = spark.createDataFrame(rows, "ts_us long, yb boolean, y_prob double, alarm_count_4h int, "
                                     "current_state string, tipo_caminhao int")
    df = df.withColumn("y", F.col("yb").cast("int")).withColumn("ts_us", F.col("ts_us") * F.lit(86_400_000_000 * 3))
    rep = EV.error_analysis(df, 0.7)
    cm = rep["confusion_matrix"]
    assert cm["tp"] + cm["fn"] == rep["n_positives"] == 100
    assert sum(cm.values()) == 300
    fnd = rep["false_negative_distribution"]
    assert sum(fnd["tipo_caminhao"].values()) == cm["fn"] == sum(fnd["alarm_count_4h_bin"].values())
    assert sum(fnd["current_state"].values()) == cm["fn"]
    assert sum(v["tp"] for v in rep["recall_by_month"].values()) == cm["tp"]


def _graded(spark, n=3000):
    rows = [(i % 7, float(i % 5) - 2, (i * i) % 11, int((i % 7) * 3 + (i * i) % 11 + (i * 13 % 17) > 26)) for i in range(n)]
    return spark.createDataFrame(rows, "a int, b double, c long, y int")


def test_boosting_on_binned_rows_equals_boosting_on_rows(spark):
    df = _graded(spark)
    cols = ["a", "b", "c"]
    plain, b1 = ml.train_balanced(df, cols, "y", n_trees=8, depth=4)
    binned, b2 = ml.train_balanced(df, cols, "y", n_trees=8, depth=4, bin_rows=0)
    assert b1 == b2
    seen = df.select(*cols).distinct().unionByName(spark.createDataFrame([(99, -50., -3)], "a int, b double, c long"))
    want, got = ({r[:3]: r["y_prob"] for r in ml.score(m, seen).collect()} for m in (plain, binned))
    assert want.keys() == got.keys() and all(abs(want[k] - got[k]) < 1e-9 for k in want)
    assert ml.score(binned, seen).columns == [*cols, "y_prob"]
    a, b = (m.stages[-1].featureImportances.toArray() for m in (plain, binned))
    assert max(abs(a - b)) < 1e-9


def test_binned_rows_follow_the_variety_of_rows_not_their_count(spark):
    sizes = set()
    for n in (6545, 19635):     # the pattern recurs after 6,545 rows
        df = _graded(spark, n).withColumn("_w", F.when(F.col("y") == 1, 3.0).otherwise(1.0))
        df = df.withColumn("c", F.when(F.col("c") == 9, None).otherwise(F.col("c")))
        g = ml.grouped_bins(df, ml.binner(df, ["a", "b", "c"], "y", 3.0), "y")
        assert g.agg(F.sum("_w")).first()[0] == df.agg(F.sum("_w")).first()[0]
        sizes.add(g.count())
    assert len(sizes) == 1 and sizes.pop() < 800


def test_forest_on_added_up_rows_is_near_the_forest_on_rows(spark):
    df = _graded(spark)
    cols = ["a", "b", "c"]
    plain, b1 = ml.train_balanced(df, cols, "y", "rf", n_trees=40, depth=4)
    forests = [ml.train_balanced(df, cols, "y", "rf", n_trees=40, depth=4, forest_rows=0) for _ in range(2)]
    assert all(b == b1 for _, b in forests)
    seen = df.select(*cols).distinct().unionByName(spark.createDataFrame([(99, -50., -3)], "a int, b double, c long"))
    want, got, again = ({r[:3]: r["y_prob"] for r in ml.score(m, seen).collect()} for m in (plain, *[f for f, _ in forests]))
    assert got == again and want.keys() == got.keys()
    assert max(abs(want[k] - got[k]) for k in want) < 0.15
    assert sum(abs(want[k] - got[k]) for k in want) / len(want) < 0.04
    assert ml.score(forests[0][0], seen).columns == [*cols, "y_prob"]
    last = forests[0][0].stages[-1]
    assert last.getNumTrees == 40 and len({t.toDebugString.split("\n", 1)[1] for t in last.trees}) > 20
    a, b = (m.stages[-1].featureImportances.toArray() for m in (plain, forests[0][0]))
    assert max(abs(a - b)) < 0.1


def test_each_tree_draws_as_many_rows_as_there_are(spark):
    g = spark.createDataFrame([(float(k), k % 2, 1 + 400 * (k % 5)) for k in range(500)], "k double, y int, _n long")
    names = [f"_t{t}" for t in range(20)]
    rows = ml.tree_draws(g.coalesce(1), ["k", "y"], 20, 1).select("_n", *names).collect()
    total = sum(r["_n"] for r in rows)
    assert all(abs(sum(r[c] for r in rows) - total) < 5 * total ** 0.5 for c in names)
    # a group's draws vary as the sum of its rows' draws: variance n
    spread = [(r[c] - r["_n"]) ** 2 / r["_n"] for r in rows for c in names]
    assert 0.9 < sum(spread) / len(spread) < 1.1
    assert len({tuple(r[c] for r in rows) for c in names}) == 20


def test_a_tree_that_draws_one_class_knows_both(spark):
    df = spark.createDataFrame([(float(k % 9), int(k == 7)) for k in range(300)], "x double, y int")
    model, _ = ml.train_balanced(df, ["x"], "y", "rf", n_trees=12, depth=3, forest_rows=0)
    assert all(0.0 <= r["y_prob"] <= 1.0 for r in ml.score(model, df).collect())


def test_bins_take_equal_shares_of_the_weight(spark):
    assert ml.thresholds({}) == [] and ml.thresholds({3.0: 1.0}) == []
    assert ml.thresholds({0.0: 5.0, 2.0: 1.0, 3.0: 9.0}) == [1.0, 2.5]
    assert ml.thresholds({float(v): 1.0 for v in range(64)}) == [v - 0.5 for v in range(2, 64, 2)]
    # rare positives weigh as much as all others, so half the bins lie among them
    df = spark.range(40_000).select((F.col("id") % 40 == 0).cast("int").alias("y"), F.when(
        F.col("id") % 40 == 0, 1e6 + F.col("id")).otherwise(F.col("id")).cast("double").alias("x"))
    cuts = ml.binner(df, ["x"], "y", 39.0).getSplitsArray()[0]
    assert len(cuts) <= ml.MAX_BINS + 2 and 14 <= sum(1e6 < c < 2e6 for c in cuts) <= 17
