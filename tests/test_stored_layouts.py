"""Bucketed tables, profiles that merge, oversampling by neighbours."""

import random

import numpy as np
import pytest
from helpers import MIN, T0
from pyspark.sql import functions as F

from faultline.operators import eda, oversample, profiles
from faultline.operators.rules import apply_rules, compare_signals, flag_confusion
from faultline.plans import catalog as C
from faultline.plans.catalog_more import _stored_line
from faultline.plans.features import FEATURE_COLS
from faultline.sources import bucketed
from tests_support import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- bucketed storage ---

def test_states_read_the_layout_without_an_exchange(spark):
    line = _stored_line(spark, SF_SMALL)
    assert "Exchange" not in plan(bucketed.states_of(line, ["TAG"], "ts_us"))
    per_day = line.where(f"kind = {bucketed.EVENT}").groupBy("TAG", bucketed.BUCKET).count()
    assert "Exchange" not in plan(per_day) and "Bucketed: true" in plan(per_day)


def test_stored_tables_join_where_they_lie(spark, tmp_out):
    df = spark.range(300).select((F.col("id") % 7).alias("k"), (F.col("id") * 3_600_000_000).alias("u"), "id")
    a = spark.table(bucketed.write_bucketed(df, f"{tmp_out}/a", ["k"], "u", 4))
    b = spark.table(bucketed.write_bucketed(df.withColumn("v", F.col("id") * 2), f"{tmp_out}/b", ["k"], "u", 4))
    met = a.join(b.hint("merge"), ["k", bucketed.BUCKET, "id"])
    assert met.count() == 300
    setting = "spark.sql.requireAllClusterKeysForCoPartition"
    spark.conf.set(setting, "false")
    try:
        met = a.join(b.hint("merge"), ["k", bucketed.BUCKET, "id"])
        assert "Exchange" not in plan(met) and met.count() == 300
    finally:
        spark.conf.unset(setting)
    again = bucketed.register_bucketed(spark, f"{tmp_out}/a", "u bigint, id bigint, k bigint, _bk bigint", ["k"], "u", 4)
    assert spark.table(again).count() == 300
    assert "Exchange" not in plan(spark.table(again).groupBy("k", bucketed.BUCKET).count())


def test_a_hot_key_spreads_over_buckets(spark, tmp_out):
    df = spark.range(2000).select(F.lit("hot").alias("k"), (F.col("id") * 3_600_000_000).alias("u"))
    t = spark.table(bucketed.write_bucketed(df, f"{tmp_out}/t", ["k"], "u", 8))
    per_file = [r["count"] for r in t.groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) == 8 and max(per_file) < 600


def test_rows_without_a_key_are_refused_or_dropped(spark, tmp_out):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", None)], "k string, u long")
    with pytest.raises(ValueError):
        bucketed.write_bucketed(df, f"{tmp_out}/x", ["k"], "u", 2)
    assert spark.table(bucketed.write_bucketed(df, f"{tmp_out}/y", ["k"], "u", 2, drop_invalid=True)).count() == 1
    assert spark.table(bucketed.write_bucketed(df.limit(0), f"{tmp_out}/z", ["k"], "u", 2)).count() == 0


def test_states_of_a_timeline_against_brute_force(spark, tmp_out):
    r = random.Random(3)
    ev = [(r.choice("ab"), r.randrange(400), i) for i in range(150)]
    iv = [(r.choice("ac"), s, r.choice([None, s + r.randrange(-5, 60)]), f"s{i}")
          for i, s in enumerate(r.randrange(-50, 400) for _ in range(30))]
    line = bucketed.timeline(spark.createDataFrame(ev, "k string, u long, id long"),
                             spark.createDataFrame(iv, "k string, _start long, _end long, _value string"),
                             ["k"], "u", width_us=40)
    t = spark.table(bucketed.write_bucketed(line, f"{tmp_out}/t", ["k"], "u", 3, width_us=40))
    got = {x["id"]: x["current_state"] for x in bucketed.states_of(t, ["k"], "u", default="?").collect()}
    for k, u, i in ev:
        started = [(s, e is not None, e, v) for kk, s, e, v in iv if kk == k and s <= u]
        last = max(started, key=lambda x: (x[0], x[1], x[2] or 0, x[3]), default=None)
        assert got[i] == (last[3] if last and last[2] is not None and u <= last[2] else "?"), (k, u)


# --- profiles ---

def test_merged_profiles_equal_direct_ones(spark):
    df = spark.range(30_000).select((F.col("id") % 6).alias("m"), (F.col("id") * 7 % 9001).alias("a"),
                                    F.pow(F.rand(1), 3).alias("x"))
    parts = profiles.part_profiles(df, "m", ["a"], [], ["x"])
    direct = profiles.part_profiles(df.withColumn("m", F.lit(0)), "m", ["a"], [], ["x"])
    one = profiles.distinct_estimates(profiles.merged(parts)).first()
    assert one["n_rows"] == 30_000 and one["distinct_a"] == profiles.distinct_estimates(direct).first()["distinct_a"]
    assert abs(one["distinct_a"] - 9001) <= profiles.distinct_error() * 9001
    xs = sorted(r["x"] for r in df.select("x").collect())
    for r in profiles.quantile_estimates(profiles.merged(parts), "x", [.1, .5, .99]).collect():
        assert abs(np.searchsorted(xs, r["value"]) / len(xs) - r["rank"]) < .02
    assert profiles.merged(profiles.part_profiles(df.limit(0), "m", ["a"]), ["m"]).count() == 0


@pytest.mark.parametrize("tracked", [8, 64, 4096])
def test_exact_top_whatever_the_sketch_keeps(spark, tracked):
    """With few slots the bound fails and all values are counted."""
    df = spark.range(5000).select(
        (F.col("id") % 4).alias("m"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).when(F.col("id") % 3 == 0, F.lit("often"))
         .otherwise(F.concat(F.lit("v"), (F.col("id") * F.col("id") % 997 % 300).cast("string"))).alias("c"))
    whole = profiles.merged(profiles.part_profiles(df, "m", top=["c"], tracked=tracked), tracked=tracked)
    got = [tuple(r) for r in profiles.exact_top(df, whole, "c", 10, tracked).collect()]
    assert got == [tuple(r) for r in eda.frequency(df, "c", 10).collect()]


# --- oversampling ---

def brute_neighbours(pts, k):
    x = {r["point"]: np.array(r["x"]) for r in pts.collect()}
    return {p: [q for _, q in sorted((float(((x[p] - x[q]) ** 2).sum()), q) for q in x if q != p)[:k]] for p in x}


def recall(spark, pts, dim, k, **how):
    want = brute_neighbours(pts, k)
    got = {}
    for r in oversample.neighbours(pts, dim, k, **how).collect():
        got.setdefault(r["point"], []).append(r["neighbour"])
    assert all(len(got.get(p, [])) == len(w) == len(set(got[p])) for p, w in want.items() if w)
    return sum(len(set(w) & set(got[p])) for p, w in want.items() if w) / sum(map(len, want.values()))


def test_neighbours_of_the_training_set(spark):
    train = C._train_set(spark, SF_SMALL).where("label_4h = 1")
    pts = oversample.points(train, FEATURE_COLS).checkpoint()
    assert pts.count() > 20 and recall(spark, pts, len(FEATURE_COLS), 5) >= .9


def test_neighbours_with_salted_buckets_and_far_points(spark):
    rows = [(float(x), float(y)) for x, y in np.random.default_rng(1).normal(size=(600, 2))] + [(900., 0.), (-2e6, 3.)]
    pts = oversample.points(spark.createDataFrame(rows, "a double, b double"), ["a", "b"]).checkpoint()
    assert recall(spark, pts, 2, 4) >= .9
    # salted buckets still give every point its number of neighbours
    recall(spark, pts, 2, 4, bucket_rows=50)


def test_synthetic_rows_lie_between_neighbours_and_agree(spark):
    r = random.Random(5)
    rows = [(i, int(r.random() < .2), r.gauss(0, 1), r.randrange(3), 7) for i in range(400)]
    rows += [(1000 + i, 1, 2.5, 1, 7) for i in range(40)] + [(2000, 1, None, 1, 7), (2001, None, 0., 0, 7)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b int, c int")
    pos, neg = sum(x[1] == 1 for x in rows), sum(x[1] == 0 for x in rows)
    new = oversample.synthetic_rows(df, ["a", "b", "c"], "y", "id").collect()
    assert len(new) == neg - pos
    parents = {x[0]: x[2:] for x in rows if x[1] == 1 and x[2] is not None}
    vectors = {tuple(map(float, v)) for v in parents.values()}
    made = {}
    for s in new:
        made[s["id"]] = made.get(s["id"], 0) + 1
        assert tuple(s["_own"]) == tuple(map(float, parents[s["id"]])) and tuple(s["_near"]) in vectors
        for i, c in enumerate("abc"):
            lo, hi = sorted((s["_own"][i], s["_near"][i]))
            assert lo - 1e-9 <= s[c] <= hi + 1e-9
    counts = [made.get(i, 0) for i in parents]
    assert max(counts) - min(counts) <= 1
    again = oversample.synthetic_rows(df.repartition(7), ["a", "b", "c"], "y", "id").collect()
    assert sorted(map(tuple, (x[:5] for x in new))) == sorted(map(tuple, (x[:5] for x in again)))
    whole = oversample.balanced(df, ["a", "b", "c"], "y", "id")
    assert whole.where("y = 1").count() == whole.where("y = 0").count() and whole.where("copy is null").count() == len(rows)


def test_nothing_to_draw_from(spark):
    schema = "id long, y int, a double"
    assert oversample.synthetic_rows(spark.createDataFrame([(1, 0, 1.), (2, 0, 2.)], schema), ["a"], "y", "id").count() == 0
    one = oversample.synthetic_rows(spark.createDataFrame([(1, 1, 4.), (2, 0, 2.), (3, 0, 2.), (4, 0, 1.)], schema),
                                    ["a"], "y", "id").collect()
    assert [x["a"] for x in one] == [4., 4.]
    assert oversample.synthetic_rows(spark.createDataFrame([], schema), ["a"], "y", "id").count() == 0


def test_nearest_by_distance_then_key_leaves_out_equal_keys():
    r = np.random.default_rng(3)
    x = r.integers(0, 3, size=(150, 2)).astype(float)       # many ties
    keys = np.array([f"{v:03d}" for v in r.permutation(150)]).astype("S")
    keys[7] = keys[90]
    asks = r.random(150) < .6
    for k in (1, 5, 200):
        place, near, d2 = oversample.nearest(x, keys, asks, k)
        want = []
        for i in np.flatnonzero(asks):
            found = sorted((((x[i] - x[j]) ** 2).sum(), keys[j], j) for j in range(150) if keys[j] != keys[i])[:k]
            want += [(keys[i], i, keys[j], d) for d, _, j in found]
        got = [(keys[i], i, keys[j], d) for i, j, d in zip(place, near, d2)]
        assert sorted(got) == sorted(want)
    assert all(len(a) == 0 for a in oversample.nearest(x, keys, np.zeros(150, bool), 3))
    assert [len(a) for a in oversample.nearest(x[:1], keys[:1], np.ones(1, bool), 3)] == [0, 0, 0]


def test_the_training_set_is_built_once_for_oversampling(spark, monkeypatch):
    from faultline.plans import catalog_more
    plans = []

    def draw(df, *a, **kw):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return plain(df, *a, **kw)
    plain = oversample.synthetic_rows
    monkeypatch.setattr(oversample, "synthetic_rows", draw)
    catalog_more.oversampled_train_counts(spark, SF_SMALL).collect()
    assert plans and "Window" not in plans[0]


# --- signals compared without flags per row ---

def test_flag_confusion_equals_the_flags_compared(spark):
    r = random.Random(9)
    rows = [(r.choice(["a", "b", None]), r.choice(["x", "y", "z", None]), r.choice([None, r.randrange(90)]),
             r.choice([0, 1, 1, None])) for _ in range(700)]
    df = spark.createDataFrame(rows, "TAG string, Alarme string, m long, Is_Dont_Go int").withColumn(
        "ts_us", F.col("m") * MIN + T0)
    rules = spark.createDataFrame([("x", 3, 5), ("x", 2, 9), ("y", 9, 30), ("q", 1, 1)], "EVENTO string, QTD int, TEMPO int")
    want = compare_signals(apply_rules(df, rules)).first().asDict()
    assert flag_confusion(df, rules).first().asDict() == want
    assert flag_confusion(df, rules, bucket_us=7 * MIN).first().asDict() == want
    assert flag_confusion(df.limit(0), rules).first()["true_positives"] == 0
    assert "Join" not in plan(flag_confusion(df, rules)).replace("BroadcastHashJoin", "")
