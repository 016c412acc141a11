"""Sinks: parquet (partitioned by source month), CSV extract, JSON metrics
documents and text reports. All are DataFrame writers, so the work stays on
the executors; paths are shared storage on a cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  sort_within: list[str] | None = None, mode: str = "overwrite") -> None:
    """Parquet. ``sort_within`` orders the rows of each file: the partition
    columns stand first in the sort, as the writer would otherwise sort by them
    alone and lose the order. Sorted files keep row-group min/max tight, so
    later time filters prune row groups."""
    if sort_within:
        df = df.sortWithinPartitions(*(partition_by or []), *sort_within)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# microseconds; the writer's own pattern would cut instants to milliseconds
_CSV = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**_CSV).csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """What ``write_csv`` wrote, instants in full."""
    return spark.read.schema(schema).options(**_CSV).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Metric rows as JSON lines (one document per row)."""
    df.write.mode(mode).json(path)


def write_text_report(df: DataFrame, path: str, col: str = "summary", mode: str = "overwrite") -> None:
    """A one-row report's text column as a text file."""
    df.select(F.col(col).cast("string").alias("value")).coalesce(1).write.mode(mode).text(path)


def read_scored_test(spark: SparkSession, path: str, columns: list[str], ts_col: str, test_start_us: int,
                     month_col: str = "event_month"):
    """Column-pruned, predicate-pushed read of a stored scored/feature table
    (only the listed columns; ``ts_col >= test_start_us`` reaches the scan).
    When the table is partitioned by ``month_col`` ('yyyy-MM'), the implied
    month bound prunes partitions too."""
    df = spark.read.parquet(path)
    cond = F.col(ts_col) >= F.lit(test_start_us)
    if month_col in df.columns:
        from faultline.functions.timecols import micros_to_ntz
        first_month = F.date_format(micros_to_ntz(F.lit(int(test_start_us))), "yyyy-MM")
        cond = cond & (F.col(month_col) >= first_month)
    return df.where(cond).select(*columns)
