"""Cleaning expressions for raw telemetry columns.

Fixed values that must equal the source system's conventions (kept together,
in natural order):
  * corrupted-encoding pattern for Criticidade: N.{1,2}o Cr.{1,2}tico
    (unanchored; it also matches the already-correct spelling)
  * its repaired spelling: Não Crítico
  * the literal that stands for a missing value: NULL
  * the decimal separator to replace: ',' -> '.'
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
CRITICIDADE_PATTERN = r"N.{1,2}o Cr.{1,2}tico"
CRITICIDADE_REPAIRED = "Não Crítico"
NULL_LITERAL = "NULL"
# -----------------------------------------------------------------------------

# A plain decimal number after the comma->dot swap; anything else (e.g.
# "1.234.56", "abc", "nan", "1.5d") is a reject, never an exception.
_NUMERIC = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def repair_criticidade(c: Column) -> Column:
    return F.regexp_replace(c, CRITICIDADE_PATTERN, CRITICIDADE_REPAIRED)


def criticidade_changed(c: Column) -> Column:
    """True only for non-null values the repair really changes."""
    return F.coalesce(repair_criticidade(c) != c, F.lit(False))


def null_literal(c: Column) -> Column:
    """The string "NULL" becomes a real null."""
    return F.when(c.cast("string") == F.lit(NULL_LITERAL), F.lit(None).cast("string")) \
        .otherwise(c.cast("string"))


def is_null_literal(c: Column) -> Column:
    return F.coalesce(c.cast("string") == F.lit(NULL_LITERAL), F.lit(False))


def has_decimal_comma(c: Column) -> Column:
    return F.coalesce(c.cast("string").contains(","), F.lit(False))


def _dotted(c: Column) -> Column:
    return F.replace(null_literal(c), F.lit(","), F.lit("."))


def parse_decimal(c: Column) -> Column:
    """Locale decimal string -> double; unparsable -> null (never raises)."""
    d = _dotted(c)
    return F.when(d.rlike(_NUMERIC), d.try_cast("double"))


def decimal_rejected(c: Column) -> Column:
    """Non-null, non-"NULL" input that does not parse as a number."""
    d = _dotted(c)
    return F.coalesce(d.isNotNull() & ~d.rlike(_NUMERIC), F.lit(False))
