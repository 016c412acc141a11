"""Dense keys: the sweep without halo copies equals the bucketed windows, for
bucket widths far below the longest window and with crowded instants."""

import random

import pytest
from pyspark.sql import functions as F

from faultline.operators.asof import asof_backward
from faultline.operators.timewin import WindowSpecs, windowed
from faultline.operators.timewin_sweep import windowed_sweep
from helpers import MIN, T0


def _data(spark, seed):
    rnd = random.Random(seed)
    rows, marks = [], [rnd.randrange(3000) for _ in range(4)]
    for i in range(300):
        m = rnd.choice([rnd.uniform(0, 3000), float(rnd.choice(marks)), float(rnd.randrange(0, 3000, 15))])
        rows.append((i, rnd.choice(["A", "A", "A", "B", None]), T0 + int(m * MIN), rnd.randrange(4), rnd.randrange(2)))
    ev = spark.createDataFrame(rows, "event_id long, TAG string, ts_us long, crit int, flag int")
    iv = [(rnd.choice(["A", "B", "C"]), T0 + rnd.randrange(3000) * MIN) for _ in range(40)]
    iv = spark.createDataFrame([(t, s, s + rnd.randrange(-30, 400) * MIN, f"s{k % 3}") for k, (t, s) in enumerate(iv)],
                               "TAG string, _start long, _end long, _value string")
    return ev, iv


def _specs(iv):
    crit, flag = F.col("crit") == 1, F.col("flag") == 1
    return WindowSpecs(lookback={"n15": (None, 15 * MIN), "n240": (None, 240 * MIN), "c60": (crit, 60 * MIN)},
                       forward={"f60": (flag, 60 * MIN), "f240": (flag, 240 * MIN)},
                       since={"since": (crit, 240.0)}, first={"first": F.col("crit")},
                       states=iv, state_name="state", state_default="none")


@pytest.mark.parametrize("seed,bucket", [(1, 1), (2, 7 * MIN), (3, 5 * 1440 * MIN)])
def test_sweep_equals_buckets(spark, seed, bucket):
    ev, iv = _data(spark, seed)
    want = windowed(ev, ["TAG"], "ts_us", _specs(iv), keep=["event_id"], tiebreak=["event_id"])
    got = windowed_sweep(ev.repartition(3), ["TAG"], "ts_us", _specs(iv), keep=["event_id"], tiebreak=["event_id"],
                         bucket_us=bucket)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_width_comes_from_the_data(spark):
    ev, iv = _data(spark, 4)
    want = sorted(map(tuple, windowed(ev, ["TAG"], "ts_us", _specs(iv), keep=["event_id"], tiebreak=["event_id"]).collect()))
    for target in (3, 10_000):
        got = windowed(ev, ["TAG"], "ts_us", _specs(iv), keep=["event_id"], tiebreak=["event_id"], bucket_us=None,
                       target_rows=target)
        assert sorted(map(tuple, got.collect())) == want


def test_crowded_day_is_spread_over_many_buckets(spark):
    """No (key, bucket) of the plan's own width holds more than a few times the target."""
    from faultline.functions.frames import floor_div
    from faultline.operators.timewin import suggest_bucket_us
    from faultline.sources import adapters as A
    from tests_support import SF_SMALL
    t = A.telemetry_crowded(spark, SF_SMALL)
    width = suggest_bucket_us(t, ["TAG"], "ts_us", 1, 50)
    inst = t.select("TAG", "ts_us").distinct().groupBy("TAG", floor_div(F.col("ts_us"), width)).count()
    assert inst.agg(F.max("count")).first()[0] <= 150
    assert t.groupBy("TAG", "ts_us").count().agg(F.max("count")).first()[0] > 50


def test_asof_keeps_rows_without_key(spark):
    left = spark.createDataFrame([(1, "A", 10), (2, None, 10), (3, "A", None)], "id int, k string, u long")
    right = spark.createDataFrame([("A", 5, 20, "x")], "k string, s long, e long, v string")
    got = asof_backward(left, right, keys=["k"], left_u="u", right_start="s", right_end="e", value="v", out="o",
                        default="none", keep=["id"])
    assert sorted((r["id"], r["o"]) for r in got.collect()) == [(1, "x"), (2, "none"), (3, "none")]
