"""Incremental ingest: monthly telemetry files arriving in a folder are
checked and cleaned. The file source's checkpoint gives each file to one batch;
``foreachBatch`` may run a batch again after a failure, so every batch writes
its own ``batch_id=N`` folder and overwrites it: a replay leaves each row once.

The cleaning is the same projection as the batch stage
(``operators.quality.clean_telemetry``). No stateful operator is needed:
cleaning is row-local. The checkpoint location must be shared storage on a
cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from faultline.operators.quality import clean_telemetry, quality_counts
from faultline.sources.schema import check_schema


def telemetry_stream(spark: SparkSession, in_dir: str, schema, max_files_per_trigger: int = 1) -> DataFrame:
    """Rows of every new parquet file in ``in_dir``; the source month comes
    from the file name (``telemetry_<month>.parquet``)."""
    s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
         .parquet(in_dir))
    check_schema(s, in_dir)
    month = F.regexp_extract(F.col("_metadata.file_name"), r"telemetry_([a-z]+)", 1)
    return s.withColumn("_source_month", month).withColumnRenamed("Data_Evento", "timestamp")


def write_batch(batch: DataFrame, batch_id: int, out_dir: str, report_dir: str | None = None) -> None:
    """Write one batch; the same batch written twice leaves the same files."""
    batch.persist()  # read once for both outputs
    try:
        clean_telemetry(batch).write.mode("overwrite").partitionBy("_source_month") \
            .parquet(f"{out_dir}/batch_id={batch_id}")
        if report_dir:
            quality_counts(batch).write.mode("overwrite").json(f"{report_dir}/batch_id={batch_id}")
    finally:
        batch.unpersist()


def start_clean_stream(spark: SparkSession, in_dir: str, schema, out_dir: str, checkpoint: str,
                       report_dir: str | None = None, once: bool = False) -> StreamingQuery:
    """Clean every new file into ``out_dir`` (partitioned by batch and source
    month). With ``report_dir`` the per-batch counters go there too."""
    cleaned_src = telemetry_stream(spark, in_dir, schema)
    w = cleaned_src.writeStream.foreachBatch(
        lambda batch, batch_id: write_batch(batch, batch_id, out_dir, report_dir)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="30 seconds")
    return w.start()
