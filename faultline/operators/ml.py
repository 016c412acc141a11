"""Model training, scoring and baselines with Spark ML.

Fixed values (training settings, in natural order): 100 trees, depth 6,
learning rate 0.1, seed 42, positive-class weight n_neg / n_pos on the train
split (1.0 without positives). The boosted-tree family maps to
``GBTClassifier``; the second family (leaf-wise boosting in the source
system, which Spark ML lacks) maps to ``RandomForestClassifier`` with 100
trees of depth 6 on the same weights.

Boosting passes over its rows some six times a tree, one tree after another, and
sees of a feature only the bin it falls into. So beyond ``BIN_ROWS`` rows they are
binned first and added up: one weighted row per distinct (bins, label), whose
number follows the variety of the rows rather than their count. A weighted row
stands for its rows exactly (same sums, same residuals, no bagging).

The forest draws its rows: each row counts a Poisson(1) number of times in a tree.
Spark holds all rows in memory with one draw a tree, and every level passes all rows
down all trees. So beyond ``FOREST_ROWS`` rows it is fitted on the added-up rows too:
n equal rows count Poisson(n) times in a tree, which is what n draws of Poisson(1)
add up to. Its trees are fitted one by one on their own draws, some at a time.
"""

from __future__ import annotations

import math
import sys
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.operators.split import SEED, hash_fraction

# --- fixed values -----------------------------------------------------------
N_TREES = 100
MAX_DEPTH = 6
LEARNING_RATE = 0.1
MAX_BINS = 32           # of a feature, Spark's own number
BIN_ROWS = 10_000       # up to here Spark's trees choose bins from every row, beyond from a sample
RANKS = 1024            # quantiles of each class that bins are chosen from
PART_GROUPS = 25_000    # distinct binned rows per partition
FOREST_ROWS = 1_000_000  # up to here the forest is fitted on the rows: fewer, larger jobs
FOREST_THREADS = 8      # trees fitted at a time
# -----------------------------------------------------------------------------


def class_balance(train: DataFrame, label: str) -> DataFrame:
    """One row: n_neg, n_pos, scale_pos_weight (1.0 when no positives)."""
    g = train.agg(F.count_if(F.coalesce(F.col(label) == 0, F.lit(False))).alias("n_neg"),
                  F.count_if(F.coalesce(F.col(label) == 1, F.lit(False))).alias("n_pos"))
    return g.withColumn("scale_pos_weight",
                        F.when(F.col("n_pos") > 0, F.col("n_neg").cast("double") / F.col("n_pos").cast("double"))
                         .otherwise(F.lit(1.0)))


def _pipeline(features: list[str], label: str, family: str, n_trees: int, depth: int,
              step: float, seed: int, max_bins: int = MAX_BINS) -> Pipeline:
    asm = VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="keep")
    if family == "gbt":
        clf = GBTClassifier(featuresCol="_features", labelCol=label, weightCol="_w", maxIter=n_trees,
                            maxDepth=depth, stepSize=step, seed=seed, maxBins=max_bins)
    elif family == "rf":
        clf = RandomForestClassifier(featuresCol="_features", labelCol=label, weightCol="_w",
                                     numTrees=n_trees, maxDepth=depth, seed=seed)
    else:
        raise ValueError(family)
    return Pipeline(stages=[asm, clf])


def thresholds(weights: dict[float, float], max_bins: int = MAX_BINS) -> list[float]:
    """Cuts between the distinct values of one feature, given their weights: all
    of them if they make ``max_bins`` bins at most, else those nearest to equal
    shares of the weight (the rule of Spark's trees)."""
    values = sorted(weights)
    middles = [(a + b) / 2.0 for a, b in zip(values, values[1:])]
    if len(middles) < max_bins:
        return middles
    stride = sum(weights.values()) / max_bins
    out, target, upto = [], stride, weights[values[0]]
    for value, middle in zip(values[1:], middles):
        before, upto = upto, upto + weights[value]
        if abs(before - target) < abs(upto - target):
            out.append(middle)
            target += stride
    return out[:max_bins - 1]


def binner(data: DataFrame, features: list[str], label: str, weight: float) -> Bucketizer:
    """Bins of every feature, from quantiles of all rows of each class (one row of
    quantiles a class reaches the driver), the classes weighing as in training.
    The bucket below the first cut is left empty, so codes start at 1 (Spark's trees
    guess the weight of code 0); nulls stay null, NaN has a bucket of its own."""
    ranks = [i / RANKS for i in range(RANKS + 1)]
    classes = data.groupBy(label).agg(F.count(F.lit(1)).alias("n"), *[
        F.percentile_approx(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")), ranks, RANKS * 10)
         .alias(f"q{i}") for i, c in enumerate(features)]).collect()
    cuts = []
    for i in range(len(features)):
        found: dict[float, float] = {}
        for r in classes:
            share = r["n"] * (weight if r[label] == 1 else 1.0) / (RANKS + 1)
            for v in r[f"q{i}"] or []:
                if math.isfinite(v):
                    found[v] = found.get(v, 0.0) + share
        cuts.append([-math.inf, -sys.float_info.max, *sorted(set(thresholds(found))), math.inf])
    return Bucketizer(splitsArray=cuts, inputCols=features, outputCols=[f"_b_{c}" for c in features],
                      handleInvalid="keep")


def grouped_bins(data: DataFrame, bins: Bucketizer, label: str) -> DataFrame:
    """(bins, label, _w, _n): the rows of ``data`` added up by bins and label, with
    their number, stored in the order of the bins."""
    from faultline.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(data.sparkSession)
    keys = [*bins.getOutputCols(), label]
    # zero is added to leave out the codes' metadata: they are ordered, not categories
    coded = bins.transform(data).select(*[(F.col(c) + F.lit(0.0)).alias(c) for c in keys], "_w")
    groups = coded.groupBy(*keys).agg(F.sum("_w").alias("_w"), F.count(F.lit(1)).alias("_n")).checkpoint()
    parts = max(1, -(-groups.count() // PART_GROUPS))
    return groups.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).checkpoint()


def tree_draws(groups: DataFrame, keys: list[str], n_trees: int, seed: int) -> DataFrame:
    """``groups`` with columns _t0, _t1, ...: how often a group's ``_n`` rows count in
    each tree, Poisson(_n). A batch is seeded by its own keys, so reruns agree."""
    def draw(n: pd.Series, key: pd.Series) -> pd.DataFrame:
        rng = np.random.default_rng(key.to_numpy().view(np.uint64))
        got = rng.poisson(n.to_numpy()[:, None], (len(n), n_trees))
        return pd.DataFrame(got, columns=names)

    names = [f"_t{t}" for t in range(n_trees)]
    udf = F.pandas_udf(draw, ", ".join(f"{c} bigint" for c in names))
    return groups.withColumn("_draws", udf("_n", F.xxhash64(F.lit(seed), *keys))).select("*", "_draws.*").drop("_draws")


def forest_of_groups(groups: DataFrame, codes: list[str], label: str, n_trees: int, depth: int, seed: int) -> PipelineModel:
    """The assembler and a forest whose trees are fitted on the groups' draws."""
    from faultline.llm.common import stored
    spark = groups.sparkSession
    asm = VectorAssembler(inputCols=codes, outputCol="_features", handleInvalid="keep")
    # a file holds each tree's draws as a column of its own, so a tree reads no others
    drawn = asm.transform(stored(tree_draws(groups, [*codes, label], n_trees, seed), "forest-draws"))
    # two classes, also where a tree draws rows of one
    y = F.col(label).alias(label, metadata={"ml_attr": {"type": "nominal", "num_vals": 2}})

    def tree(t: int):
        rows = drawn.where(F.col(f"_t{t}") > 0).select(
            "_features", y, (F.col("_w") / F.col("_n") * F.col(f"_t{t}")).alias("_w"))
        clf = RandomForestClassifier(featuresCol="_features", labelCol=label, weightCol="_w", numTrees=1,
                                     bootstrap=False, featureSubsetStrategy="sqrt", maxDepth=depth,
                                     seed=seed + t, maxBins=MAX_BINS + 4)
        return clf.fit(rows)._java_obj.trees()[0]

    with ThreadPoolExecutor(FOREST_THREADS) as pool:
        trees = list(pool.map(inheritable_thread_target(spark)(tree), range(n_trees)))
    # Python has no call that makes one forest of fitted trees
    sc = spark.sparkContext
    classes = sc._jvm.org.apache.spark.ml.classification
    held = sc._gateway.new_array(classes.DecisionTreeClassificationModel, n_trees)
    for t, x in enumerate(trees):
        held[t] = x
    made = classes.RandomForestClassificationModel(f"forest_{seed}", held, len(codes), 2)
    model = RandomForestClassificationModel(made.set(made.getParam("numTrees"), n_trees))
    return PipelineModel([asm, model.setFeaturesCol("_features")])


def train(train_df: DataFrame, features: list[str], label: str, family: str = "gbt",
          n_trees: int = N_TREES, depth: int = MAX_DEPTH, step: float = LEARNING_RATE,
          seed: int = SEED) -> PipelineModel:
    return train_balanced(train_df, features, label, family, n_trees, depth, step, seed)[0]


def train_balanced(train_df: DataFrame, features: list[str], label: str, family: str = "gbt",
                   n_trees: int = N_TREES, depth: int = MAX_DEPTH, step: float = LEARNING_RATE,
                   seed: int = SEED, bin_rows: int = BIN_ROWS,
                   forest_rows: int = FOREST_ROWS) -> tuple[PipelineModel, dict]:
    """The fitted model and the class balance it was weighted by (one count).
    Boosted trees of more than ``bin_rows`` rows, and forests of more than
    ``forest_rows``, are fitted on binned rows."""
    data = train_df.select(*features, F.col(label).cast("double").alias(label))
    balance = class_balance(data, label).first().asDict()
    w = float(balance["scale_pos_weight"])
    data = data.withColumn("_w", F.when(F.col(label) == 1, F.lit(w)).otherwise(F.lit(1.0)))
    if family == "gbt" and balance["n_neg"] + balance["n_pos"] > bin_rows:
        bins = binner(data, features, label, w)
        fitted = _pipeline(bins.getOutputCols(), label, family, n_trees, depth, step, seed, MAX_BINS + 4).fit(
            grouped_bins(data, bins, label))
        return PipelineModel([bins, *fitted.stages]).copy(), balance
    if family == "rf" and balance["n_pos"] and balance["n_neg"] + balance["n_pos"] > forest_rows:
        bins = binner(data, features, label, w)
        fitted = forest_of_groups(grouped_bins(data, bins, label), bins.getOutputCols(), label, n_trees, depth, seed)
        return PipelineModel([bins, *fitted.stages]).copy(), balance
    # the copy leaves the training summary behind: a summary holds the session,
    # which cannot be sent to executors once the session has observed metrics
    return _pipeline(features, label, family, n_trees, depth, step, seed).fit(data).copy(), balance


def _code_columns(model: PipelineModel) -> list[str]:
    return [c for s in model.stages if isinstance(s, Bucketizer) for c in s.getOutputCols()]


def score(model: PipelineModel, df: DataFrame, out: str = "y_prob") -> DataFrame:
    """Add P(class 1) as ``out``; drops the ML helper columns."""
    s = model.transform(df)
    return (s.withColumn(out, vector_to_array(F.col("probability")).getItem(1))
             .drop("_features", "rawPrediction", "probability", "prediction", *_code_columns(model)))


def feature_importances(spark: SparkSession, model: PipelineModel, features: list[str]) -> DataFrame:
    """Tree-model importances (bounded by the number of features)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)],
                                 "feature string, importance double")


# --- baselines -------------------------------------------------------------------

def label_counts(train: DataFrame, label: str) -> dict:
    """{n_pos, n_neg} of a 0/1 label, from one aggregate."""
    return train.agg(F.count_if(F.coalesce(F.col(label) == 1, F.lit(False))).alias("n_pos"),
                     F.count_if(F.coalesce(F.col(label) == 0, F.lit(False))).alias("n_neg")).first().asDict()


def majority_class(train: DataFrame, label: str) -> int:
    """Most frequent label on train (ties -> 0, the smaller class value)."""
    r = train.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    return 1 if r["p"] > r["n"] else 0


def dummy_majority(test: DataFrame, majority: int, has_positive_class: bool) -> DataFrame:
    """Constant prediction; score 1.0/0.0 for the majority, 0 when class 1
    was never seen on train."""
    s = float(majority) if has_positive_class else 0.0
    return test.withColumn("y_pred", F.lit(majority)).withColumn("y_prob", F.lit(s))


def dummy_stratified(test: DataFrame, positive_rate: float, key: list[str], seed: int = SEED) -> DataFrame:
    """Seeded random prediction at the train positive rate; the score is the
    prediction (0/1), as a stratified dummy classifier reports it."""
    pred = (hash_fraction(key, seed) < F.lit(float(positive_rate))).cast("int")
    return test.withColumn("y_pred", pred).withColumn("y_prob", pred.cast("double"))


def heuristic(test: DataFrame, feature: str = "critical_alarm_count_1h") -> DataFrame:
    """Positive iff at least one critical alarm in the last hour; the score is
    that count."""
    return (test.withColumn("y_pred", (F.col(feature) > 0).cast("int"))
                .withColumn("y_prob", F.col(feature).cast("double")))


def permutation_importance(scored_fn, test: DataFrame, features: list[str], label: str,
                           key: str, group_rows: int = 10_000, seed: int = SEED) -> DataFrame:
    """(feature, base_auc, permuted_auc, drop): how much the ROC-AUC falls when
    one feature is shuffled over the whole test set.

    The shuffle is a cyclic shift inside random groups of about
    ``group_rows`` rows (a window per group: every row takes the value of the
    next row in seeded-hash order), so each group is one bounded task. All
    shifted columns come from one window, stored once; then every row stands
    once per feature, with that feature shifted, and once as it is, is scored by
    ``scored_fn(df) -> df with y_prob`` in one pass, and all are reported by
    feature in one job."""
    from pyspark.sql import Window

    from faultline.operators.grouped import long_form, report_by_group
    from faultline.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(test.sparkSession)
    groups = max(1, test.count() // group_rows)
    g = F.pmod(F.xxhash64(F.lit(seed + 1), F.col(key)), F.lit(groups))
    h = F.xxhash64(F.lit(seed), F.col(key))
    w = Window.partitionBy("_g").orderBy("_h", key)
    wall = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shifted = test.withColumn("_g", g).withColumn("_h", h).withColumns(
        {f"_p_{f}": F.coalesce(F.lead(f).over(w), F.first(f).over(wall)) for f in features}).drop("_g", "_h").checkpoint()
    as_is = {f: F.col(f) for f in features}
    variants = {"": as_is, **{f: {**as_is, f: F.col(f"_p_{f}")} for f in features}}
    rows = long_form(shifted, "feature", variants, [F.col(label).alias("y")])
    auc = report_by_group(scored_fn(rows).select("feature", "y", "y_prob"), ["feature"]).select("feature", "auc_roc").checkpoint()
    # one row per feature and one of the rows as they are
    base = auc.where("feature = ''").first()["auc_roc"]
    return auc.where("feature <> ''").select("feature", F.lit(float(base)).alias("base_auc"), F.col("auc_roc").alias("permuted_auc"),
                                             (F.lit(float(base)) - F.col("auc_roc")).alias("drop"))
