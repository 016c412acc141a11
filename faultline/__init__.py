"""faultline: equipment-alarm analytics on Spark DataFrames.

Layout
------
sources/    scans, adapters over the driver tables, sinks
functions/  column-expression helpers (time units, cleaning, binning)
operators/  DataFrame -> DataFrame operators (time windows, as-of, rules,
            quality, metrics, split, EDA, ML)
plans/      compositions of operators (feature matrix, evaluation runs) and
            the query catalogue used by ``__spark_entry__``
streaming/  Structured Streaming variant of the ingest/clean stage
"""

__version__ = "0.1.0"
