"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.session import ensure_checkpoint_dir

# ASCII white space of the word rule [^\x20\x09-\x0D]+; bytes.split() splits on
# exactly these six bytes.
SPACE_CODES = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20)
SLICE_ROWS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the checkpoint folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/faultline-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and a
    lost executor costs no recomputation of what stands before."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns the operator needs, so that no other column of the
    input can clash with what it computes."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut to a few rows each, which bounds what Python holds."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def slices_by_bytes(batches: Iterator[pa.RecordBatch], column: int,
                    most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut where the text column's bytes reach ``most`` (one longer
    text stands alone): what Python holds does not grow with the texts' length."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for at, n in enumerate(size):
            if at > start and held + n > most:
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += n
        if len(size) > start:
            yield batch.slice(start)


ARROW = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
         "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()),
         "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a flat ``name type, name type`` string."""
    return pa.schema([pa.field(name, ARROW[kind])
                      for name, kind in (x.split() for x in ddl.split(", "))])


def map_rows(df: DataFrame, row: Callable, ddl: str, columns: list[str],
             make: Callable | None = None) -> DataFrame:
    """``row(state, *values) -> tuple`` for every row, in Arrow batches.

    ``make()`` builds a state once per task. Output columns follow ``ddl``.
    """
    arrow = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = make() if make else None
        for part in slices(batches):
            got = [row(state, *values) for values in zip(*(c.to_pylist() for c in part.columns))]
            cols = list(zip(*got)) if got else [[] for _ in arrow]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(cols, arrow)], schema=arrow)

    return df.select(*columns).mapInArrow(run, ddl)
