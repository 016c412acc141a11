"""EDA aggregates, split bounds and sampling (S19, S26, E9, E10)."""

from pyspark.sql import functions as F

from faultline.operators import eda, split as S

DAY = 86_400_000_000


def test_e9_calendar_fill(spark):
    df = spark.createDataFrame([(1 * DAY + 5, 1), (3 * DAY, 1)], "ts_us long, flag int")
    got = [(r["day_us"] // DAY, r["total"]) for r in eda.daily_sum(df, "ts_us", "flag").orderBy("day_us").collect()]
    assert got == [(1, 1), (2, 0), (3, 1)]


def test_e10_split_bounds(spark):
    base = S.wall_micros("2025-04-30 23:59:59")
    df = spark.range(1).select(base.alias("a")).select(
        F.col("a").alias("ts_us"), F.lit(0).alias("id")).union(
        spark.range(1).select((base + F.lit(500_000)).alias("ts_us"), F.lit(1).alias("id"))).union(
        spark.range(1).select((base + F.lit(1_000_000)).alias("ts_us"), F.lit(2).alias("id")))
    train, test = S.temporal_split(df)
    assert [r["id"] for r in train.collect()] == [0]
    assert [r["id"] for r in test.collect()] == [2]
    c = S.split_counts(df.withColumn("y", F.lit(1)), "y").first()
    assert (c["train_rows"], c["test_rows"], c["neither_rows"]) == (1, 1, 1)


def test_global_row_number_exact(spark):
    import random
    rnd = random.Random(3)
    rows = [(rnd.randrange(50), i) for i in range(500)]
    df = spark.createDataFrame(rows, "u long, tb long")
    got = {r["tb"]: r["row_number"] for r in S.global_row_number(df, "u", "tb", n_parts=7).collect()}
    expect = {tb: i + 1 for i, (u, tb) in enumerate(sorted(rows))}
    assert got == expect
    # one instant holding most rows is still split across partitions
    hot = spark.createDataFrame([(5 if i % 4 else i, i) for i in range(400)], "u long, tb long")
    rn = S.global_row_number(hot, "u", "tb", n_parts=8)
    got = sorted((r["u"], r["tb"], r["row_number"]) for r in rn.collect())
    assert [x[2] for x in sorted(got, key=lambda x: (x[0], x[1]))] == list(range(1, 401))


def test_sequential_split_fallback(spark):
    df = spark.createDataFrame([(i * 1000, i) for i in range(10)], "ts_us long, event_id long")
    train, test = S.split_or_fallback(df)
    assert sorted(r["event_id"] for r in train.collect()) == list(range(8))
    assert sorted(r["event_id"] for r in test.collect()) == [8, 9]


def test_seeded_sample_deterministic(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = sorted(r["k"] for r in S.fixed_size_sample(df, 50, ["k"]).collect())
    b = sorted(r["k"] for r in S.fixed_size_sample(df.repartition(7), 50, ["k"]).collect())
    assert a == b and len(a) == 50
    c = S.seeded_sample(df, 0.1, ["k"]).count()
    assert c == S.seeded_sample(df.repartition(3), 0.1, ["k"]).count() and 100 < c < 300


def test_frequency_and_correlation(spark):
    df = spark.createDataFrame([("a", 1, 1, 0), ("a", 2, 1, 1), ("b", 3, 1, 1), (None, 4, 1, 0)],
                               "k string, x int, const int, y int")
    f = eda.frequency(df, "k").collect()
    assert [(r["k"], r["count"]) for r in f] == [("a", 2), ("b", 1)]
    c = {r["feature"]: r["corr"] for r in eda.label_correlation(df, ["x", "const"], "y").collect()}
    assert c["const"] is None and c["x"] is not None


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in [0, 0, 3, 30]], "c int")
    h = {r["bin"]: r["count"] for r in eda.histogram(df, ["c"], bins=30).collect()}
    assert h == {0: 2, 3: 1, 29: 1}


def test_calendar_fill_per_group(spark):
    df = spark.createDataFrame([("A", 1 * DAY, 1), ("A", 4 * DAY, 2), ("B", 2 * DAY, 0)], "TAG string, ts_us long, flag int")
    got = sorted((r["TAG"], r["day_us"] // DAY, r["total"]) for r in eda.daily_sum(df, "ts_us", "flag", by=["TAG"]).collect())
    assert got == [("A", 1, 1), ("A", 2, 0), ("A", 3, 0), ("A", 4, 2), ("B", 2, 0)]


def test_daily_series_of_a_null_group_keeps_its_totals(spark):
    df = spark.createDataFrame([(None, 0, 1), (None, 2 * DAY, 1), ("a", 0, 0)], "TAG string, ts_us long, flag int")
    got = {(r["TAG"], r["day_us"] // DAY): r["total"] for r in eda.daily_sum(df, "ts_us", "flag", by=["TAG"]).collect()}
    assert got == {(None, 0): 1, (None, 1): 0, (None, 2): 1, ("a", 0): 0}


def test_sample_has_its_size_at_any_partitioning(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    for n in (1, 500, 20_000, 30_000):
        assert S.fixed_size_sample(df.repartition(5), n, ["k"]).count() == min(n, 20_000)


def test_tiny_fractions_are_not_rounded_up(spark):
    df = spark.range(200_000).withColumnRenamed("id", "k")
    assert S.seeded_sample(df, 1e-9, ["k"]).count() == 0
    assert 80 < S.seeded_sample(df, 5e-4, ["k"]).count() < 125


def test_correlation_is_sorted(spark):
    df = spark.createDataFrame([(i, -i, i * i % 7, i) for i in range(20)], "a int, b int, c int, y int")
    got = [r["corr"] for r in eda.label_correlation(df, ["a", "b", "c"], "y").collect()]
    assert got == sorted(got) and got[0] == -1.0 and got[-1] == 1.0
