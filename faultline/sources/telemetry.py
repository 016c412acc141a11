"""Scans of the monthly telemetry files, the interval table and the rule
table, with the existence and schema checks done before any data is read."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.sources.schema import (INTERVAL_SCHEMA, MONTHS, RULES_SCHEMA, SchemaError,
                                      check_schema, interval_key)


def _read(spark: SparkSession, path: str) -> DataFrame:
    """The file's frame (footers only); FileNotFoundError when there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Missing file: {path}") from e
        raise


def union_months(frames: dict[str, DataFrame], check_types: bool = True) -> DataFrame:
    """Check every monthly frame's schema (metadata only), tag rows with
    ``_source_month`` and union them by name (optional columns may be absent
    in some months). ``Data_Evento`` becomes ``timestamp``."""
    out = None
    for month, df in frames.items():
        check_schema(df, f"telemetry_{month}", check_types=check_types)
        df = df.withColumn("_source_month", F.lit(month))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise SchemaError("no telemetry inputs")
    return out.withColumnRenamed("Data_Evento", "timestamp")


def load_telemetry(spark: SparkSession, data_dir: str, months=MONTHS,
                   pattern: str = "telemetry_{month}.parquet", check_types: bool = True) -> DataFrame:
    """Read ``telemetry_<month>.parquet`` for each month. Raises
    FileNotFoundError for a missing file and SchemaError for missing columns,
    before any row is read (footers only)."""
    frames = {}
    for m in months:
        path = f"{data_dir.rstrip('/')}/{pattern.format(month=m)}"
        frames[m] = _read(spark, path)
    return union_months(frames, check_types=check_types)


def load_intervals(spark: SparkSession, path: str) -> DataFrame:
    """State intervals; Inicio/Fim parsed to timestamps when stored as text;
    the key column is normalised to ``Tag``."""
    df = spark.read.parquet(path)
    key = interval_key(df)
    if key != "Tag":
        df = df.withColumnRenamed(key, "Tag")
    for c in ("Inicio", "Fim"):
        if dict(df.dtypes).get(c) == "string":
            df = df.withColumn(c, F.try_to_timestamp(F.col(c)).cast("timestamp_ntz"))
    return df


def load_rules(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Rule table (EVENTO, QTD, TEMPO) exported from the rules workbook."""
    reader = spark.read.schema(RULES_SCHEMA)
    if fmt == "csv":
        return reader.option("header", True).csv(path)
    return reader.format(fmt).load(path)


__all__ = ["load_telemetry", "load_intervals", "load_rules", "union_months", "INTERVAL_SCHEMA"]
