"""Adapter views that present the driver's ``events`` table as alarm
telemetry, state intervals, alarm rules and a scored table.

The expressions are deterministic functions of ``events`` columns so every
view grows with the data; the same text is used by the DuckDB oracle
(``faultline.plans.oracle``).

Fixed values (the synthetic mapping, in natural order):
  TAG = 'EQ' + 4-digit floor(user_id / 5)  (skew view: 'EQHOT' when user_id % 3 = 0)
  Id_Criticidade: error 1, purchase 2, signup 3, other 4
  Criticidade: purchase with event_id % 97 = 0 -> 'N??o Crítico',
               purchase with event_id % 89 = 0 -> 'Não Cr??tico',
               error 'Crítico', purchase 'Não Crítico', signup 'Informacional',
               other 'Outros'
  Valor: event_id % 20 = 0 -> 'NULL'; event_id % 3 = 0 -> decimal comma;
         else value with 2 decimals
  Classe: event_id % 4 <> 0 -> 'NULL'; % 8 = 0 -> 'Activate'; else 'Inactive'
  Is_Dont_Go: error with value >= 60
  Tipo: floor(user_id / 5) even -> 'Caminhao', odd -> 'Escavadeira'
  months: ts < 01-06 jan, < 01-11 feb, < 01-16 mar, < 01-21 abr, < 01-26 may, else jun
  intervals from signup events: Inicio = ts; Fim = ts - 1h when event_id % 50 = 0,
  else ts + floor(value) * 10 min; Classe by floor(event_id / 7) % 4:
  Operando, Parado, Hibernando, Manutenção
  rules (EVENTO, QTD, TEMPO): (error,3,720) (error,2,240) (error,2,480)
  (click,3,360) (view,4,720) (purchase,2,120) (ghost,1,10)
  scored: y = Is_Dont_Go, y_prob = 0.3 if Id_Criticidade = 1 else 0, plus (event_id % 50) / 100
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions.timecols import epoch_micros, micros_to_ntz
from faultline.sources.schema import RULES_SCHEMA

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# --- fixed values -----------------------------------------------------------
RULE_ROWS = [("error", 3, 720), ("error", 2, 240), ("error", 2, 480), ("click", 3, 360),
             ("view", 4, 720), ("purchase", 2, 120), ("ghost", 1, 10)]
# -----------------------------------------------------------------------------

_TELEMETRY_EXPRS = {
    "TAG": "concat('EQ', lpad(cast(cast(floor(user_id/5) as bigint) as string),4,'0'))",
    "Alarme": "event_type",
    "Id_Criticidade": "cast(case event_type when 'error' then 1 when 'purchase' then 2 "
                      "when 'signup' then 3 else 4 end as int)",
    "Criticidade": "case when event_type='purchase' and event_id%97=0 then 'N??o Crítico' "
                   "when event_type='purchase' and event_id%89=0 then 'Não Cr??tico' "
                   "when event_type='error' then 'Crítico' when event_type='purchase' then 'Não Crítico' "
                   "when event_type='signup' then 'Informacional' else 'Outros' end",
    "Valor": "case when event_id%20=0 then 'NULL' "
             "when event_id%3=0 then replace(cast(cast(value as decimal(10,2)) as string),'.',',') "
             "else cast(cast(value as decimal(10,2)) as string) end",
    "Classe": "case when event_id%4<>0 then 'NULL' when event_id%8=0 then 'Activate' else 'Inactive' end",
    "Is_Dont_Go": "cast(case when event_type='error' and value>=60 then 1 else 0 end as int)",
    "Tipo": "case when cast(floor(user_id/5) as bigint)%2=0 then 'Caminhao' else 'Escavadeira' end",
}

_MONTH_EXPR = ("case when ts<timestamp_ntz'2024-01-06' then 'jan' when ts<timestamp_ntz'2024-01-11' then 'feb' "
               "when ts<timestamp_ntz'2024-01-16' then 'mar' when ts<timestamp_ntz'2024-01-21' then 'abr' "
               "when ts<timestamp_ntz'2024-01-26' then 'may' else 'jun' end")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def telemetry(spark: SparkSession, sf_dir: str, tag_expr: str | None = None) -> DataFrame:
    """Raw (uncleaned) alarm telemetry, one row per event, with ``ts_us``
    epoch micros next to the display ``timestamp``."""
    ev = read_table(spark, sf_dir, "events")
    exprs = dict(_TELEMETRY_EXPRS)
    if tag_expr is not None:
        exprs["TAG"] = tag_expr
    cols = [F.col("event_id")] + [F.expr(v).alias(k) for k, v in exprs.items()]
    cols += [F.col("ts").alias("timestamp"), epoch_micros(ev, "ts").alias("ts_us"),
             F.expr(_MONTH_EXPR).alias("_source_month")]
    return ev.select(*cols)


def telemetry_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten TAGs only: many rows per key, for skew and halo checks."""
    return telemetry(spark, sf_dir, tag_expr="concat('EQ', cast(user_id % 10 as string))")


def telemetry_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One equipment ('EQHOT', every user_id divisible by 3) holds about a
    third of all events; the rest keep their TAGs. The skew case."""
    return telemetry(spark, sf_dir, tag_expr="case when user_id % 3 = 0 then 'EQHOT' else " +
                     _TELEMETRY_EXPRS["TAG"] + " end")


CROWDED_US = 1_705_320_000_000_000   # 2024-01-15 12:00:00


def telemetry_crowded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """'EQHOT' as in ``telemetry_hot``; a quarter of its events (event_id
    divisible by 4) share one instant, the others fall on that one day."""
    t = telemetry_hot(spark, sf_dir)
    day = CROWDED_US - 12 * 3_600_000_000
    hot = F.col("TAG") == "EQHOT"
    u = (F.when(hot & (F.col("event_id") % 4 == 0), F.lit(CROWDED_US))
         .when(hot, F.lit(day) + F.pmod(F.col("ts_us"), F.lit(86_400_000_000))).otherwise(F.col("ts_us")))
    return t.withColumn("ts_us", u).withColumn("timestamp", micros_to_ntz(F.col("ts_us")))


def telemetry_many_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty alarms ('AL' + user_id % 40) instead of the event types."""
    t = telemetry(spark, sf_dir).drop("Alarme")
    ev = read_table(spark, sf_dir, "events").select("event_id", F.concat(
        F.lit("AL"), (F.col("user_id") % 40).cast("string")).alias("Alarme"))
    return t.join(ev, "event_id")


def rules_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules derived from the events, one per (user_id % 40, user_id % 7): QTD
    1 + user_id % 4, TEMPO (1 + user_id % 40) * (1 + user_id % 7) * 11 minutes,
    missing where user_id % 7 = 3. Doubles and missing lengths included."""
    k, m = F.col("user_id") % 40, F.col("user_id") % 7
    return (read_table(spark, sf_dir, "events").select(
        F.concat(F.lit("AL"), k.cast("string")).alias("EVENTO"),
        (1 + F.col("user_id") % 4).cast("int").alias("QTD"),
        F.when(m != 3, (1 + k) * (1 + m) * 11).cast("int").alias("TEMPO")).distinct())


def telemetry_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps truncated to the hour, so equal (TAG, instant) groups exist."""
    t = telemetry(spark, sf_dir)
    hour = F.lit(3_600_000_000)
    return (t.withColumn("ts_us", t.ts_us - F.pmod(t.ts_us, hour))
             .withColumn("timestamp", micros_to_ntz(F.col("ts_us"))))


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operating-state intervals (Tag, Inicio, Fim, Classe) derived from
    signup events; 2% of them are inverted (Fim before Inicio)."""
    ev = read_table(spark, sf_dir, "events").where(F.col("event_type") == "signup")
    u = epoch_micros(ev, "ts")
    m = F.expr("case when event_id%50=0 then -3600000000L else cast(floor(value) as bigint)*600000000L end")
    classe = F.expr("case cast(floor(event_id/7) as bigint)%4 when 0 then 'Operando' when 1 then 'Parado' "
                    "when 2 then 'Hibernando' else 'Manutenção' end")
    return ev.select(F.expr(_TELEMETRY_EXPRS["TAG"]).alias("Tag"),
                     u.alias("inicio_us"),
                     (u + m).alias("fim_us"),
                     classe.alias("Classe"),
                     F.col("event_id").alias("interval_id")) \
        .withColumn("Inicio", micros_to_ntz(F.col("inicio_us"))) \
        .withColumn("Fim", micros_to_ntz(F.col("fim_us")))


def rules(spark: SparkSession) -> DataFrame:
    """The alarm-rule table (EVENTO, QTD, TEMPO minutes), duplicates included."""
    return spark.createDataFrame(RULE_ROWS, RULES_SCHEMA)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deterministic score next to the true flag, for metric operators."""
    t = telemetry(spark, sf_dir)
    return t.select("event_id", "TAG", "timestamp", "ts_us", "Tipo",
                    F.col("Is_Dont_Go").alias("y"),
                    (F.when(F.col("Id_Criticidade") == 1, F.lit(0.3)).otherwise(F.lit(0.0))
                     + (F.col("event_id") % 50).cast("double") / F.lit(100.0)).alias("y_prob"))
