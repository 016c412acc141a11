"""Exploratory aggregates: frequencies, rates, calendar-filled daily series,
profiles, correlation with the label and histograms (the data behind the
figures; no drawing)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.frames import floor_div
from faultline.functions.timecols import US_PER_DAY


def frequency(df: DataFrame, col: str, top: int | None = None) -> DataFrame:
    """value_counts: non-null values with counts, descending (ties by value);
    ``top`` keeps the first n (a top-k, planned as TakeOrderedAndProject)."""
    f = (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
           .orderBy(F.col("count").desc(), F.col(col)))
    return f.limit(top) if top else f


def rate_by(df: DataFrame, by: str, flag: str, scale: float = 100.0) -> DataFrame:
    """Mean of a 0/1 flag per group, times ``scale`` (percent by default)."""
    return df.groupBy(by).agg((F.avg(F.col(flag).cast("double")) * F.lit(scale)).alias("rate"),
                              F.count(F.lit(1)).alias("n"))


def daily_sum(df: DataFrame, u: str, flag: str, by: list[str] = ()) -> DataFrame:
    """Sum of ``flag`` per UTC day (per ``by`` group) from the group's first
    to its last observed day; days without rows are present with 0. The
    calendar has one row per group and day of its span (bounded by the time
    span, not by the row count)."""
    by = list(by)
    per_day = (df.where(F.col(u).isNotNull())
                 .groupBy(*by, floor_div(F.col(u), US_PER_DAY).alias("day"))
                 .agg(F.sum(F.col(flag).cast("long")).alias("total")))
    span = per_day.groupBy(*by).agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    cal = span.select(*by, F.explode(F.sequence("lo", "hi")).alias("day"))
    found = per_day.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("day").alias("_day"), "total")
    on = F.col("day") == F.col("_day")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_by_{c}"))  # a null group is a group
    return (cal.join(found, on, "left")
               .select(*by, (F.col("day") * F.lit(US_PER_DAY)).alias("day_us"),
                       F.coalesce(F.col("total"), F.lit(0)).cast("long").alias("total")))


def distinct_profile(df: DataFrame, cols: list[str], exact: bool = True) -> DataFrame:
    """Row count and distinct count of each column (approximate on demand)."""
    fn = F.count_distinct if exact else F.approx_count_distinct
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *[fn(F.col(c)).alias(f"distinct_{c}") for c in cols])


def null_profile(df: DataFrame, numeric_only: bool = True) -> DataFrame:
    """Nulls per (numeric) column, long form: column, nulls."""
    from pyspark.sql import types as T
    cols = [f.name for f in df.schema.fields
            if not numeric_only or isinstance(f.dataType, T.NumericType)]
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"),
                                                   F.col(c).cast("long").alias("nulls")) for c in cols])))


def means(df: DataFrame, cols: list[str], scale: float = 1.0) -> DataFrame:
    return df.agg(*[(F.avg(F.col(c).cast("double")) * F.lit(scale)).alias(f"{c}_rate") for c in cols])


def time_span(df: DataFrame, u: str) -> DataFrame:
    return df.agg(F.min(u).alias("min_us"), F.max(u).alias("max_us"))


def label_correlation(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Pearson correlation of each feature with ``label`` (null when either
    side has zero variance), long form sorted ascending."""
    aggs = []
    for c in features:
        x, y = F.col(c).cast("double"), F.col(label).cast("double")
        aggs += [F.covar_pop(x, y).alias(f"{c}__cov"), F.stddev_pop(x).alias(f"{c}__sx")]
    aggs.append(F.stddev_pop(F.col(label).cast("double")).alias("__sy"))
    wide = df.agg(*aggs)
    rows = []
    for c in features:
        ok = (F.col(f"{c}__sx") > 0) & (F.col("__sy") > 0)
        rows.append(F.struct(F.lit(c).alias("feature"),
                             F.when(ok, F.round(F.col(f"{c}__cov") / (F.col(f"{c}__sx") * F.col("__sy")), 6))
                              .alias("corr")))
    return wide.select(F.inline(F.array(*rows))).orderBy("corr", "feature")


def histogram(df: DataFrame, cols: list[str], bins: int = 30) -> DataFrame:
    """Equal-width histogram per column between its min and max: column,
    bin (0..bins-1, the max falls in the last bin), lo, hi, count. Empty bins
    are omitted. The rows are counted per distinct (column, value); bounds, one
    row per column, and bins both come from that exchange."""
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols])
    values = (df.select(F.inline(each)).where(F.col("x").isNotNull())
              .groupBy("column", "x").agg(F.count(F.lit(1)).alias("n")))
    bounds = values.groupBy("column").agg(F.min("x").alias("_lo"), F.max("x").alias("_hi"))
    # as many rows as columns are given
    v = values.join(F.broadcast(bounds), "column").withColumn(
        "_w", F.when(F.col("_hi") > F.col("_lo"), (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))).otherwise(F.lit(1.0)))
    b = F.least(F.floor((F.col("x") - F.col("_lo")) / F.col("_w")), F.lit(bins - 1)).cast("int")
    h = v.groupBy("column", b.alias("bin"), "_lo", "_w").agg(F.sum("n").alias("count"))
    return h.select("column", "bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("lo"),
                    (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("hi"), "count")
