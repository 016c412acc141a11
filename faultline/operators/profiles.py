"""Profiles that merge: per part (a month, a batch) one row of sketches is kept,
and any parts' rows merge to the profile of their union without the rows.

* Distinct counts: HyperLogLog sketches of 2^``LG_K`` registers; the relative
  standard error is about 1.04 / sqrt(2^LG_K).
* Quantiles: KLL sketches; the rank error is about 1.7 % at the default size.
* Frequent values: item sketches of at most ``TRACKED`` values. A value that
  stands more than ``top_error`` times is always among the candidates, so the
  exact top k follows from counting the candidates alone, in one pass that
  broadcasts at most ``TRACKED`` values a part. Where the k-th count is not above
  that bound, all values are counted.

Nulls count in n_rows only. A part without rows has no row.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.operators import eda

LG_K = 14
TRACKED = 4096


def part_profiles(df: DataFrame, part: str, distinct: list[str] = (), top: list[str] = (),
                  quantile: list[str] = (), lg_k: int = LG_K, tracked: int = TRACKED) -> DataFrame:
    """One row per part: n_rows and the sketches, all from one pass."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(f"distinct_{c}") for c in distinct]
    aggs += [F.expr(f"approx_top_k_accumulate(`{c}`, {int(tracked)})").alias(f"top_{c}") for c in top]
    aggs += [F.kll_sketch_agg_double(F.col(c).cast("double")).alias(f"quantile_{c}") for c in quantile]
    return df.groupBy(part).agg(*aggs)


def merged(profiles: DataFrame, by: list[str] = (), tracked: int = TRACKED) -> DataFrame:
    """The parts' rows merged, per ``by`` or as a whole: a profile again."""
    aggs = [F.sum("n_rows").alias("n_rows")]
    for c in profiles.columns:
        if c.startswith("distinct_"):
            aggs.append(F.hll_union_agg(c).alias(c))
        elif c.startswith("top_"):
            aggs.append(F.expr(f"approx_top_k_combine(`{c}`, {int(tracked)})").alias(c))
        elif c.startswith("quantile_"):
            aggs.append(F.kll_merge_agg_double(c).alias(c))
    return profiles.groupBy(*by).agg(*aggs)


def distinct_estimates(profile: DataFrame) -> DataFrame:
    """distinct_<column> estimates beside the other columns that are no sketches."""
    names = [c for c in profile.columns if c.startswith("distinct_")]
    rest = [c for c in profile.columns if not c.startswith(("distinct_", "top_", "quantile_"))]
    return profile.select(*rest, *[F.hll_sketch_estimate(c).alias(c) for c in names])


def quantile_estimates(profile: DataFrame, column: str, ranks: list[float]) -> DataFrame:
    """(rank, value) of ``column`` per profile row."""
    at = F.array(*[F.struct(F.lit(float(r)).alias("rank"),
                            F.kll_sketch_get_quantile_double(f"quantile_{column}", F.lit(float(r))).alias("value"))
                   for r in ranks])
    return profile.select(F.inline(at))


def distinct_error(lg_k: int = LG_K, sigmas: float = 3.0) -> float:
    """Bound of the relative error at ``sigmas`` standard errors."""
    return sigmas * 1.04 / math.sqrt(1 << lg_k)


def top_error(n_rows: int, tracked: int = TRACKED) -> int:
    """A value that stands more often than this is among a merged sketch's
    candidates: an item sketch of M slots misses at most 3.5 / M of the rows."""
    slots = 1 << math.ceil(math.log2(tracked / 0.75))
    return math.ceil(n_rows * 3.5 / slots)


def exact_top(df: DataFrame, profile: DataFrame, column: str, k: int, tracked: int = TRACKED) -> DataFrame:
    """(column, count): the exact ``k`` most frequent values (ties by value) of
    ``df``, whose merged profile is given."""
    listed = profile.select(F.expr(f"approx_top_k_estimate(`top_{column}`, {int(tracked)})").alias("_t"),
                            "n_rows").select("n_rows", F.explode("_t").alias("_e"))
    listed = listed.select("n_rows", F.col("_e.item").alias("_item")).where(F.col("_item").isNotNull())
    n = profile.agg(F.sum("n_rows")).first()[0] or 0
    # at most ``tracked`` values: the sketch holds no more
    wanted = F.broadcast(listed.select("_item").distinct())
    found = eda.frequency(df.join(wanted, F.col(column) == F.col("_item"), "left_semi"), column, k).collect()
    if len(found) == k and found[-1]["count"] > top_error(n, tracked):
        return df.sparkSession.createDataFrame([(r[column], r["count"]) for r in found],
                                               df.select(column).withColumn("count", F.lit(0).cast("long")).schema)
    return eda.frequency(df, column, k)
