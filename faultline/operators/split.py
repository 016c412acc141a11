"""Temporal split, ordered 80/20 fall-back and seeded sampling.

Fixed values: train ends at 2025-04-30 23:59:59, test starts at 2025-05-01
00:00:00 (inclusive bounds; rows between the two fall in neither); fall-back
train share 0.8; seed 42. Cut points are parameters for other data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
TRAIN_END = "2025-04-30 23:59:59"
TEST_START = "2025-05-01 00:00:00"
FALLBACK_TRAIN_SHARE = 0.8
SEED = 42
# -----------------------------------------------------------------------------

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def wall_micros(ts_text: str) -> Column:
    """Epoch micros of a wall-clock literal (UTC, session-zone free)."""
    return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, TIMESTAMP_NTZ'{ts_text}')")


def split_flags(u: str = "ts_us", train_end: str = TRAIN_END, test_start: str = TEST_START):
    c = F.col(u)
    return c <= wall_micros(train_end), c >= wall_micros(test_start)


def temporal_split(df: DataFrame, u: str = "ts_us", train_end: str = TRAIN_END,
                   test_start: str = TEST_START) -> tuple[DataFrame, DataFrame]:
    tr, te = split_flags(u, train_end, test_start)
    return df.where(tr), df.where(te)


def split_counts(df: DataFrame, label: str, u: str = "ts_us", train_end: str = TRAIN_END,
                 test_start: str = TEST_START) -> DataFrame:
    """One row: train / test / neither rows and positives (single pass)."""
    tr, te = split_flags(u, train_end, test_start)
    pos = F.coalesce(F.col(label) == 1, F.lit(False))
    return df.agg(F.count_if(tr).alias("train_rows"), F.count_if(te).alias("test_rows"),
                  F.count_if(~tr & ~te).alias("neither_rows"),
                  F.count_if(tr & pos).alias("train_positives"),
                  F.count_if(te & pos).alias("test_positives"))


def global_row_number(df: DataFrame, u: str, tiebreak: str, n_parts: int | None = None) -> DataFrame:
    """Exact 1-based row number by (u, tiebreak), balanced even when one
    instant holds a large share of the rows.

    The rows are range-partitioned on the full order (sampled bounds split
    ties on ``u`` by the tiebreak), sorted within partitions and tagged with
    ``monotonically_increasing_id`` (partition index in the high bits,
    position in the low 33 bits). The tagged rows are checkpointed so the tags
    never change on recomputation; per-partition counts are prefixed over a
    table of at most ``n_parts`` rows and broadcast back. No window, one
    shuffle."""
    from faultline.session import ensure_checkpoint_dir
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(n, F.col(u), F.col(tiebreak))
                .sortWithinPartitions(u, tiebreak)
                .withColumn("_mid", F.monotonically_increasing_id())
                .checkpoint())
    low = F.lit((1 << 33) - 1)
    t = tagged.withColumn("_pid", F.shiftright(F.col("_mid"), 33)) \
              .withColumn("_pos", F.col("_mid").bitwiseAND(low))
    counts = t.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # bounded: one row per range partition
    wt = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    off = counts.select("_pid", F.coalesce(F.sum("_n").over(wt), F.lit(0)).alias("_off"))
    return (t.join(F.broadcast(off), "_pid")
             .withColumn("row_number", F.col("_off") + F.col("_pos") + F.lit(1))
             .drop("_pid", "_pos", "_off", "_mid"))


def sequential_split(df: DataFrame, u: str, tiebreak: str,
                     train_share: float = FALLBACK_TRAIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """First int(share * n) rows by (u, tiebreak) are train, the rest test.
    Ordered by time, not by storage order (documented difference)."""
    n = df.count()
    cut = int(n * train_share)
    rn = global_row_number(df, u, tiebreak)
    return rn.where(F.col("row_number") <= cut).drop("row_number"), \
        rn.where(F.col("row_number") > cut).drop("row_number")


def split_or_fallback(df: DataFrame, u: str = "ts_us", tiebreak: str = "event_id",
                      train_end: str = TRAIN_END, test_start: str = TEST_START):
    """Temporal split; when the test side is empty, the ordered 80/20 split."""
    train, test = temporal_split(df, u, train_end, test_start)
    if test.limit(1).count() == 0:
        return sequential_split(df, u, tiebreak)
    return train, test


def hash_fraction(cols: list[str], seed: int = SEED) -> Column:
    """A uniform value in [0, 1), in steps of 2^-52, from the MD5 digest of the
    seed and ``cols``: the same on every run, partitioning and engine."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def seeded_sample(df: DataFrame, fraction: float, key: list[str], seed: int = SEED) -> DataFrame:
    """Deterministic Bernoulli sample keyed by ``key`` (partition-independent)."""
    return df.where(hash_fraction(key, seed) < F.lit(float(fraction)))


def fixed_size_sample(df: DataFrame, n: int, key: list[str], seed: int = SEED,
                      n_rows: int | None = None) -> DataFrame:
    """``min(n, rows)`` rows: the n smallest seeded hashes, ties by key.

    A plain top-k would send up to n rows from every task to one; so rows above
    a hash threshold are dropped first. The threshold lets n + 10 sqrt(n) + 100
    rows through on average, so about that many rows meet in the merge, at any
    number of tasks (that fewer than n pass is a ten-sigma event). ``n_rows``:
    the row count, where the caller knows it; else it is counted."""
    total = df.count() if n_rows is None else n_rows
    h = hash_fraction(key, seed)
    if total > n:
        df = df.where(h < F.lit((n + 10 * math.sqrt(n) + 100) / total))
    return df.withColumn("_h", h).orderBy("_h", *key).limit(n).drop("_h")
