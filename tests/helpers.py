"""Small builders for hand-made fixtures (times in minutes)."""

from __future__ import annotations

from pyspark.sql import functions as F

MIN = 60_000_000
T0 = 1_735_689_600_000_000  # 2025-01-01 00:00 UTC in micros


def events(spark, rows, cols="TAG string, m double, Id_Criticidade int, Is_Dont_Go int, Tipo string, event_id long"):
    """rows of (TAG, minute, crit, dont_go, Tipo, id) -> DataFrame with ts_us."""
    df = spark.createDataFrame(rows, cols)
    return df.withColumn("ts_us", (F.lit(T0) + (F.col("m") * MIN).cast("long"))).drop("m")


def col_by(df, key, col):
    return [r[col] for r in df.orderBy(key).collect()]
