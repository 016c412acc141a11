"""Bucketed storage: tables laid out by (key, time bucket) once, so that windows,
aggregates and joins on these columns read them without an exchange.

A table bucketed by its key alone would put a hot equipment's rows into one
bucket, thus one task. So the time bucket of ``width_us`` microseconds is part of
the layout: a hot key spreads over its days. What a row needs from before its
bucket is stored in it, as a carry row (``write_timeline``).

Tables are external: their files lie in the folder given, so any session that
registers the same layout reads them. One file per bucket, sorted by key, bucket
and time. A join on more columns than the layout's (an event's id, say) reads it
without an exchange if the session sets
``spark.sql.requireAllClusterKeysForCoPartition`` to false; with Spark's default it
shuffles both sides. Windows and aggregates need no setting. Rows without key or instant are not part of a layout and are refused
unless ``drop_invalid``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.functions.frames import floor_div
from faultline.functions.timecols import US_PER_DAY

BUCKET = "_bk"
EVENT, INTERVAL, CARRY = 1, 0, -1       # rows of a timeline, in their order at one instant


def with_bucket(df: DataFrame, u: str, width_us: int = US_PER_DAY) -> DataFrame:
    return df.withColumn(BUCKET, floor_div(F.col(u).cast("long"), int(width_us)))


def write_bucketed(df: DataFrame, path: str, keys: list[str], u: str, n_buckets: int | None = None,
                   width_us: int = US_PER_DAY, drop_invalid: bool = False) -> str:
    """Store ``df`` by (keys, time bucket); the name of the session's table."""
    spark = df.sparkSession
    n = int(n_buckets or spark.conf.get("spark.sql.shuffle.partitions"))
    valid = F.lit(True)
    for c in [*keys, u]:
        valid = valid & F.col(c).isNotNull()
    if drop_invalid:
        df = df.where(valid)
    elif not df.where(~valid).isEmpty():
        raise ValueError(f"rows without {', '.join([*keys, u])} have no bucket")
    laid = with_bucket(df, u, width_us).repartition(n, *keys, BUCKET)
    name = f"faultline_{uuid.uuid4().hex}"
    (laid.write.format("parquet").mode("errorifexists").bucketBy(n, *keys, BUCKET)
         .sortBy(*keys, BUCKET, u).option("path", path).saveAsTable(name))
    return name


def register_bucketed(spark: SparkSession, path: str, schema: str, keys: list[str], u: str, n_buckets: int) -> str:
    """A table over files that another session wrote with ``write_bucketed``."""
    name = f"faultline_{uuid.uuid4().hex}"
    by = ", ".join([*keys, BUCKET])
    spark.sql(f"create table {name} ({schema}) using parquet clustered by ({by}) sorted by ({by}, {u}) "
              f"into {int(n_buckets)} buckets location '{path}'")
    return name


def timeline(events: DataFrame, intervals: DataFrame, keys: list[str], u: str,
             width_us: int = US_PER_DAY) -> DataFrame:
    """Events and interval starts on one line: the event columns, ``kind`` and
    ``state`` (start, end, value). ``intervals`` has the keys, ``_start``,
    ``_end`` and ``_value``. Each (key, bucket) with events gets one carry row,
    the latest interval that starts before the bucket, if there is one; it comes
    from one row per (key, bucket)."""
    state = F.struct(F.col("_start").cast("long").alias("start"), F.col("_end").cast("long").alias("end"),
                     F.col("_value").alias("value"))
    opened = intervals.where(F.col("_start").isNotNull())
    for k in keys:
        opened = opened.where(F.col(k).isNotNull())
    opened = opened.select(*keys, F.col("_start").cast("long").alias(u), state.alias("state"),
                           F.lit(INTERVAL).alias("kind"))
    rows = events.withColumn("kind", F.lit(EVENT))
    per = (with_bucket(opened, u, width_us).groupBy(*keys, BUCKET).agg(F.max("state").alias("state"))
           .withColumn("_has", F.lit(False))
           .unionByName(with_bucket(rows, u, width_us).groupBy(*keys, BUCKET).agg(F.lit(True).alias("_has")),
                        allowMissingColumns=True))
    before = (Window.partitionBy(*keys).orderBy(BUCKET, F.col("_has").desc())
              .rowsBetween(Window.unboundedPreceding, -1))
    carry = (per.withColumn("state", F.max("state").over(before)).where(F.col("_has") & F.col("state").isNotNull())
             # at the bucket's first instant, before all its rows
             .select(*keys, (F.col(BUCKET) * F.lit(int(width_us))).alias(u), "state", F.lit(CARRY).alias("kind")))
    return (rows.unionByName(opened, allowMissingColumns=True).unionByName(carry, allowMissingColumns=True))


def states_of(line: DataFrame, keys: list[str], u: str, out: str = "current_state",
              default: str | None = None) -> DataFrame:
    """The events of a stored timeline with the state at their instant: that of
    the latest interval, if it has not ended. Reads the layout as it is."""
    upto = (Window.partitionBy(*keys, BUCKET).orderBy(u)
            .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    last = line.withColumn("_last", F.max("state").over(upto)).where(F.col("kind") == EVENT)
    value = F.when(F.col(u) <= F.col("_last.end"), F.col("_last.value"))
    return last.withColumn(out, F.coalesce(value, F.lit(default)) if default is not None else value).drop(
        "_last", "state", "kind")
