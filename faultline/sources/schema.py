"""Telemetry / interval / rule schemas and the schema checks run at scan time.

Fixed values (column names of the source files, in natural order):
  required telemetry columns: TAG, Alarme, Id_Criticidade, Criticidade, Valor,
  Classe, Is_Dont_Go, Tipo, Data_Evento
  optional telemetry columns: Localidade, Tag_Frota, Inicio_Turno, Fim_Turno,
  Nome_Operador_Anon, Matricula_Operador_Hash
  monthly file stems: jan, feb, mar, abr, may, jun
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
MONTHS = ["jan", "feb", "mar", "abr", "may", "jun"]
REQUIRED_COLUMNS = ["TAG", "Alarme", "Id_Criticidade", "Criticidade", "Valor",
                    "Classe", "Is_Dont_Go", "Tipo", "Data_Evento"]
OPTIONAL_COLUMNS = ["Localidade", "Tag_Frota", "Inicio_Turno", "Fim_Turno",
                    "Nome_Operador_Anon", "Matricula_Operador_Hash"]
STATES = ["Operando", "Parado", "Hibernando", "Manutenção"]
UNKNOWN_STATE = "Desconhecido"
TRUCK = "Caminhao"
# -----------------------------------------------------------------------------

# Expected logical types of the required columns (Valor arrives as text).
REQUIRED_TYPES = {
    "TAG": (T.StringType,),
    "Alarme": (T.StringType,),
    "Id_Criticidade": (T.IntegerType, T.LongType, T.ShortType, T.ByteType),
    "Criticidade": (T.StringType,),
    "Valor": (T.StringType, T.DoubleType, T.FloatType, T.DecimalType),
    "Classe": (T.StringType,),
    "Is_Dont_Go": (T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.BooleanType),
    "Tipo": (T.StringType,),
    "Data_Evento": (T.TimestampType, T.TimestampNTZType, T.StringType, T.DateType),
}

RULES_SCHEMA = T.StructType([
    T.StructField("EVENTO", T.StringType()),
    T.StructField("QTD", T.IntegerType()),
    T.StructField("TEMPO", T.IntegerType()),
])

INTERVAL_SCHEMA = T.StructType([
    T.StructField("Tag", T.StringType()),
    T.StructField("Inicio", T.TimestampNTZType()),
    T.StructField("Fim", T.TimestampNTZType()),
    T.StructField("Classe", T.StringType()),
])


class SchemaError(Exception):
    """A telemetry file lacks required columns or has the wrong types."""


def missing_columns(df: DataFrame, required=REQUIRED_COLUMNS) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def wrong_types(df: DataFrame, expected=REQUIRED_TYPES) -> list[str]:
    out = []
    for name, allowed in expected.items():
        if name in df.columns and not isinstance(df.schema[name].dataType, allowed):
            out.append(f"{name}:{df.schema[name].dataType.simpleString()}")
    return out


def check_schema(df: DataFrame, label: str, check_types: bool = True) -> None:
    miss = missing_columns(df)
    if miss:
        raise SchemaError(f"{label} missing columns: {sorted(miss)}")
    if check_types:
        bad = wrong_types(df)
        if bad:
            raise SchemaError(f"{label} has unexpected types: {bad}")


def time_column(df: DataFrame) -> str:
    """The event instant is ``Inicio`` in some exports, ``timestamp`` in the
    cleaned table (``Data_Evento`` before the rename)."""
    for c in ("Inicio", "timestamp", "Data_Evento"):
        if c in df.columns:
            return c
    raise SchemaError("no time column (Inicio / timestamp / Data_Evento)")


def interval_key(df: DataFrame) -> str:
    """The interval table names its key ``Tag`` or ``TAG``."""
    for c in df.columns:
        if c in ("Tag", "TAG"):
            return c
    raise SchemaError("interval table has no Tag/TAG column")
