"""Features by appended months.

A new month touches itself and the seam only. Under one path:

  features/batch=k  the rows put out, by _open: false are those that no later
                  event can change, true those within a horizon of the seam, whose
                  labels may still change (the next batch puts these out again)
  state/batch=k   what the next month needs:
    seam          the last instant
    tail          raw rows within two horizons of the seam: the open rows' look-back
    carry         per TAG, from rows before the tail: its first row and its last
                  critical instant
    intervals     per TAG the last interval begun a horizon before the seam, and
                  all later ones

``append_month`` feeds the carry as two rows per TAG to the ordinary feature
plan: they lie before every window of the rows that are put out, and only the
unbounded look-backs (first type, minutes since the last critical alarm) see
them. Each batch writes folders of its own, so one that fails is run again
without touching what stands.

A batch is read some six times (its span, the density, features, state): where all
months come from one table, ``by_month`` stores them apart first, in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.functions.timecols import epoch_micros
from faultline.plans.evaluation import in_parallel
from faultline.plans.features import CRITICAL_LEVEL, LABEL_HORIZONS, LOOKBACK_WINDOWS, build_features, with_micros
from faultline.sources.schema import interval_key

REACH = max([*LABEL_HORIZONS.values(), *LOOKBACK_WINDOWS.values()])
RAW = ["TAG", "ts_us", "event_id", "Id_Criticidade", "Is_Dont_Go", "Tipo"]
LAST_ID = (1 << 63) - 1


def _intervals(intervals: DataFrame) -> DataFrame:
    iv = intervals
    for out, col in (("inicio_us", "Inicio"), ("fim_us", "Fim")):
        if out not in iv.columns:
            iv = iv.withColumn(out, epoch_micros(iv, col))
    return iv.select(F.col(interval_key(iv)).alias("Tag"), "inicio_us", "fim_us", "Classe")


def _carry_rows(carry: DataFrame) -> DataFrame:
    """Two raw rows per TAG that stand for everything before the tail."""
    first = carry.select("TAG", F.col("first.ts_us").alias("ts_us"), F.col("first.event_id").alias("event_id"),
                         F.lit(0).alias("Id_Criticidade"), F.lit(0).alias("Is_Dont_Go"), F.col("first.Tipo").alias("Tipo"))
    last = carry.where("critical_us is not null").select(
        "TAG", F.col("critical_us").alias("ts_us"), F.lit(LAST_ID).alias("event_id"),
        F.lit(CRITICAL_LEVEL).alias("Id_Criticidade"), F.lit(0).alias("Is_Dont_Go"), F.lit(None).cast("string").alias("Tipo"))
    return first.unionByName(last)


def append_month(spark: SparkSession, path: str, batch: int, tele: DataFrame, intervals: DataFrame, **kw) -> None:
    """Add a month's rows and intervals (both later than all before; equal
    instants at the seam are allowed) as batch 1, 2, ... ``event_id`` breaks
    ties and must be there. Rows without TAG or instant have no features."""
    raw = with_micros(tele).select(*[F.col(c) for c in RAW]).where("TAG is not null and ts_us is not null")
    raw = raw.select("TAG", "ts_us", F.col("event_id").cast("long").alias("event_id"),
                     F.col("Id_Criticidade").cast("int").alias("Id_Criticidade"),
                     F.col("Is_Dont_Go").cast("int").alias("Is_Dont_Go"), "Tipo")
    iv = _intervals(intervals)
    here, last = f"{path}/state/batch={batch}", f"{path}/state/batch={batch - 1}"
    span = raw.agg(F.min("ts_us").alias("lo"), F.max("ts_us").alias("hi")).first()
    seam = spark.read.parquet(f"{last}/seam").first()["seam"] if batch > 1 else None
    if seam is not None and span["lo"] is not None and span["lo"] < seam:
        raise ValueError(f"batch {batch} has rows before the last instant of batch {batch - 1}")
    new_seam = max((x for x in (seam, span["hi"]) if x is not None), default=None)
    rows, carry = raw, None
    if batch > 1:
        carry = spark.read.parquet(f"{last}/carry")
        rows = raw.unionByName(spark.read.parquet(f"{last}/tail"))
        iv = iv.unionByName(spark.read.parquet(f"{last}/intervals"))
    if new_seam is None:        # nothing yet
        new_seam = -(1 << 62)
    spark.createDataFrame([(new_seam,)], "seam bigint").write.mode("overwrite").parquet(f"{here}/seam")

    feed = rows.withColumn("_carry", F.lit(False))
    if carry is not None:
        feed = feed.unionByName(_carry_rows(carry).withColumn("_carry", F.lit(True)))
    feats = build_features(feed, iv, keep=["event_id", "_carry"], **kw).where(~F.col("_carry")).drop("_carry")
    if seam is not None:
        feats = feats.where(F.col("ts_us") >= seam - REACH)
    # a label looks ahead by REACH at most, and an event at the seam may still come
    feats = feats.withColumn("_open", F.col("ts_us") >= new_seam - REACH)

    start = new_seam - 2 * REACH
    old = rows.where(F.col("ts_us") <= start).groupBy("TAG").agg(
        F.min(F.struct("ts_us", "event_id", "Tipo")).alias("first"),
        F.max(F.when(F.col("Id_Criticidade") == CRITICAL_LEVEL, F.col("ts_us"))).alias("critical_us"))
    if carry is not None:
        old = old.unionByName(carry).groupBy("TAG").agg(F.min("first").alias("first"), F.max("critical_us").alias("critical_us"))
    begun = F.max(F.when(F.col("inicio_us") <= new_seam - REACH, F.col("inicio_us"))).over(Window.partitionBy("Tag"))
    # intervals of one TAG: few, and pruned by every batch
    kept = iv.withColumn("_begun", begun).where(
        (F.col("inicio_us") > new_seam - REACH) | (F.col("inicio_us") == F.col("_begun"))).drop("_begun")
    tail = rows.where(F.col("ts_us") > start)
    # none reads what another writes
    in_parallel(spark, {
        "features": lambda: feats.write.mode("overwrite").partitionBy("_open").parquet(f"{path}/features/batch={batch}"),
        **{name: (lambda name=name, df=df: df.write.mode("overwrite").parquet(f"{here}/{name}"))
           for name, df in {"tail": tail, "carry": old, "intervals": kept}.items()}}, 4)


def by_month(df: DataFrame, month: Column, path: str) -> DataFrame:
    """``df`` stored under ``path`` by ``month`` (column ``_month``), in one pass, so
    that a month is read without the others. Rows without a month are left out."""
    rows = df.withColumn("_month", month).where("_month is not null")
    rows.write.partitionBy("_month").parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def read_features(spark: SparkSession, path: str, batch: int) -> DataFrame:
    """All feature rows after batches 1 to ``batch``: what is final, and the
    last batch's open rows."""
    schema = spark.read.parquet(f"{path}/features/batch={batch}").schema
    out = None
    for k in range(1, batch + 1):
        part = spark.read.schema(schema).parquet(f"{path}/features/batch={k}")
        part = (part if k == batch else part.where(~F.col("_open"))).drop("_open")
        out = part if out is None else out.unionByName(part)
    return out
