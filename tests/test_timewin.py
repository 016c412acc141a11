"""Edge cases of the bucketed time windows (S1-S8) and invariants."""

import pytest
from pyspark.sql import functions as F

from faultline.operators.timewin import WindowSpecs, windowed
from faultline.plans.features import build_features
from helpers import MIN, T0, events


def _lookback(spark, ties, bucket_us=24 * 60 * MIN):
    ev = events(spark, [("A", 0.0, 2, 0, "Caminhao", 1), ("A", 15.0, 2, 0, "Caminhao", 2),
                        ("A", 15.0, 2, 0, "Caminhao", 3), ("A", 15.0, 2, 0, "Caminhao", 4),
                        ("A", 30.0, 2, 0, "Caminhao", 5)])
    out = windowed(ev, ["TAG"], "ts_us", WindowSpecs(lookback={"c": (None, 15 * MIN)}),
                   keep=["event_id"], tiebreak=["event_id"], ties=ties, bucket_us=bucket_us)
    return [r["c"] for r in out.orderBy("event_id").collect()]


def test_e1_window_edge_and_peer_ties(spark):
    assert _lookback(spark, "range") == [1, 3, 3, 3, 1]


def test_e1_row_ties(spark):
    assert _lookback(spark, "row") == [1, 1, 2, 3, 1]


@pytest.mark.parametrize("bucket_min", [15, 16, 60, 7 * 24 * 60])
def test_e1_independent_of_bucket(spark, bucket_min):
    assert _lookback(spark, "range", bucket_min * MIN) == [1, 3, 3, 3, 1]
    assert _lookback(spark, "row", bucket_min * MIN) == [1, 1, 2, 3, 1]


def test_e2_label_edges(spark):
    ev = events(spark, [("A", 0.0, 2, 0, "x", 1), ("A", 60.0, 2, 1, "x", 2), ("A", 60.0, 2, 0, "x", 3),
                        ("A", 61.0, 2, 0, "x", 4), ("A", 121.0, 2, 1, "x", 5)])
    for bucket in (30 * MIN, 24 * 60 * MIN):
        f = build_features(ev, None, keep=["event_id"], bucket_us=bucket).orderBy("event_id").collect()
        assert [r["label_1h"] for r in f] == [1, 0, 0, 1, 0]
        assert [r["label_2h"] for r in f] == [1, 1, 1, 1, 0]


def test_s4_tag_without_dont_go(spark):
    ev = events(spark, [("A", 0.0, 2, 0, "x", 1), ("A", 10.0, 2, 0, "x", 2)])
    f = build_features(ev, None).collect()
    assert all(r["label_4h"] == 0 for r in f)


@pytest.mark.parametrize("bucket_min", [60, 240, 24 * 60])
def test_e3_time_since_critical_carry(spark, bucket_min):
    ev = events(spark, [("A", 0.0, 2, 0, "x", 1), ("A", 10.0, 1, 0, "x", 2),
                        ("A", 25.0, 2, 0, "x", 3), ("A", 600.0, 2, 0, "x", 4)])
    f = build_features(ev, None, keep=["event_id"], bucket_us=bucket_min * MIN).orderBy("event_id").collect()
    assert [r["time_since_last_critical"] for r in f] == [240.0, 0.0, 15.0, 590.0]


def test_s6_tipo_from_first_row(spark):
    ev = events(spark, [("A", 5.0, 2, 0, "Escavadeira", 2), ("A", 0.0, 2, 0, "Caminhao", 1),
                        ("A", 3000.0, 2, 0, "Escavadeira", 3), ("B", 0.0, 2, 0, None, 4)])
    f = build_features(ev, None, keep=["event_id"], bucket_us=60 * MIN).orderBy("event_id").collect()
    assert [r["tipo_caminhao"] for r in f] == [1, 1, 1, 0]


def _intervals(spark, rows):
    df = spark.createDataFrame(rows, "Tag string, s double, e double, Classe string")
    return df.select("Tag", (F.lit(T0) + (F.col("s") * MIN).cast("long")).alias("inicio_us"),
                     (F.lit(T0) + (F.col("e") * MIN).cast("long")).alias("fim_us"), "Classe")


@pytest.mark.parametrize("bucket_min", [20, 45, 24 * 60])
def test_e4_asof_with_validity(spark, bucket_min):
    iv = _intervals(spark, [("A", 0.0, 60.0, "Operando"), ("A", 30.0, 40.0, "Parado"),
                            ("A", 100.0, 90.0, "Manutenção")])
    ts = [-5.0, 0.0, 30.0, 40.0, 41.0, 60.0, 100.0]
    ev = events(spark, [("A", t, 2, 0, "x", i) for i, t in enumerate(ts)] + [("B", 0.0, 2, 0, "x", 99)])
    f = build_features(ev, iv, keep=["event_id"], bucket_us=bucket_min * MIN).orderBy("event_id").collect()
    assert [r["current_state"] for r in f] == ["Desconhecido", "Operando", "Parado", "Parado", "Desconhecido",
                                               "Desconhecido", "Desconhecido", "Desconhecido"]


def test_e4_interval_key_spelled_upper(spark):
    iv = _intervals(spark, [("A", 0.0, 60.0, "Operando")]).withColumnRenamed("Tag", "TAG")
    ev = events(spark, [("A", 10.0, 2, 0, "x", 1)])
    assert build_features(ev, iv).first()["current_state"] == "Operando"


def test_e11_null_tag_absent(spark):
    ev = events(spark, [("A", 0.0, 2, 0, "x", 1), (None, 0.0, 2, 0, "x", 2)])
    assert build_features(ev, None, keep=["event_id"]).count() == 1


def test_halo_equals_plain_on_dense_data(spark):
    """Results do not depend on the bucket size (plain = one bucket per key)
    or on the input partitioning."""
    from faultline.sources import adapters as A
    from tests_support import SF_SMALL
    t = A.telemetry_dense(spark, SF_SMALL)
    iv = A.intervals(spark, SF_SMALL)
    cols = ["event_id", "alarm_count_15m", "alarm_count_4h", "critical_alarm_count_1h",
            "time_since_last_critical", "tipo_caminhao", "current_state", "label_1h", "label_4h"]
    ref = sorted(tuple(r) for r in build_features(t, iv, keep=["event_id"], bucket_us=10 ** 15)
                 .select(*cols).collect())
    for b, parts in ((4 * 60 * MIN, 1), (6 * 60 * MIN, 3), (24 * 60 * MIN, 16)):
        got = sorted(tuple(r) for r in build_features(t.repartition(parts), iv, keep=["event_id"], bucket_us=b)
                     .select(*cols).collect())
        assert got == ref


def test_monotone_counts_and_labels(spark):
    from faultline.sources import adapters as A
    from tests_support import SF_SMALL
    f = build_features(A.telemetry(spark, SF_SMALL), A.intervals(spark, SF_SMALL))
    bad = f.where((F.col("alarm_count_15m") > F.col("alarm_count_30m")) |
                  (F.col("alarm_count_30m") > F.col("alarm_count_1h")) |
                  (F.col("alarm_count_1h") > F.col("alarm_count_2h")) |
                  (F.col("alarm_count_2h") > F.col("alarm_count_4h")) |
                  (F.col("alarm_count_15m") < 1) |
                  (F.col("label_1h") > F.col("label_2h")) | (F.col("label_2h") > F.col("label_4h")))
    assert bad.count() == 0
    assert f.count() == A.telemetry(spark, SF_SMALL).count()


def test_suggest_bucket(spark):
    from faultline.operators.timewin import suggest_bucket_us
    from faultline.sources import adapters as A
    from tests_support import SF_SMALL
    t = A.telemetry_dense(spark, SF_SMALL)
    b = suggest_bucket_us(t, ["TAG"], "ts_us", 4 * 60 * MIN, target_rows=1)
    assert b == 4 * 60 * MIN  # dense key: clamped at the frame span
    b2 = suggest_bucket_us(t, ["TAG"], "ts_us", 4 * 60 * MIN, target_rows=10 ** 9)
    assert b2 == 30 * 24 * 60 * MIN


def test_asof_operator(spark):
    from faultline.operators.asof import asof_backward
    iv = _intervals(spark, [("A", 0.0, 60.0, "Operando"), ("A", 30.0, 40.0, "Parado"),
                            ("A", 100.0, 90.0, "Manutenção")]).withColumnRenamed("Tag", "TAG")
    ts = [-5.0, 0.0, 30.0, 40.0, 41.0, 60.0, 100.0]
    ev = events(spark, [("A", t, 2, 0, "x", i) for i, t in enumerate(ts)] + [("B", 0.0, 2, 0, "x", 99)])
    out = asof_backward(ev, iv, keys=["TAG"], left_u="ts_us", right_start="inicio_us", right_end="fim_us",
                        value="Classe", out="state", keep=["event_id"], bucket_us=25 * MIN)
    got = [r["state"] for r in out.orderBy("event_id").collect()]
    assert got == [None, "Operando", "Parado", "Parado", None, None, None, None]


def test_hot_key_is_split_across_tasks(spark):
    """A TAG holding about a third of the rows is spread over its time
    buckets: the largest window group is a small part of the key."""
    from faultline.functions.frames import floor_div
    from faultline.operators.timewin import DEFAULT_BUCKET_US
    from faultline.sources import adapters as A
    from tests_support import SF_CHECK
    t = A.telemetry_hot(spark, SF_CHECK)
    total = t.count()
    hot = t.where(F.col("TAG") == "EQHOT").count()
    assert hot > total / 4
    groups = (t.groupBy("TAG", floor_div(F.col("ts_us"), DEFAULT_BUCKET_US).alias("bk")).count()
               .agg(F.max("count").alias("m")).first()["m"])
    assert groups < hot / 20
