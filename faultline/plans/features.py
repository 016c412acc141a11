"""The per-event feature matrix: rolling alarm counts, critical count, time
since the last critical alarm, equipment type, as-of operating state and
forward-looking Don't Go labels, all from one bucketed window pass.

Fixed values (feature definitions, in natural order):
  look-back windows: alarm_count_15m 15 min, alarm_count_30m 30 min,
  alarm_count_1h 1 h, alarm_count_2h 2 h, alarm_count_4h 4 h
  critical_alarm_count_1h: Id_Criticidade = 1 within 1 h
  time_since_last_critical: minutes; 240.0 when no earlier critical alarm
  tipo_caminhao: 1 iff the TAG's first row has Tipo = 'Caminhao'
  current_state: interval state, 'Desconhecido' when none applies
  labels: label_1h 1 h, label_2h 2 h, label_4h 4 h ahead
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.timecols import US_PER_HOUR, US_PER_MINUTE, epoch_micros
from faultline.operators.timewin import TARGET_ROWS, WindowSpecs, windowed
from faultline.sources.schema import TRUCK, UNKNOWN_STATE, interval_key, time_column

# --- fixed values -----------------------------------------------------------
LOOKBACK_WINDOWS = {
    "alarm_count_15m": 15 * US_PER_MINUTE,
    "alarm_count_30m": 30 * US_PER_MINUTE,
    "alarm_count_1h": 1 * US_PER_HOUR,
    "alarm_count_2h": 2 * US_PER_HOUR,
    "alarm_count_4h": 4 * US_PER_HOUR,
}
CRITICAL_WINDOW = ("critical_alarm_count_1h", 1 * US_PER_HOUR)
CRITICAL_LEVEL = 1
DEFAULT_MINUTES_SINCE = 240.0
LABEL_HORIZONS = {
    "label_1h": 1 * US_PER_HOUR,
    "label_2h": 2 * US_PER_HOUR,
    "label_4h": 4 * US_PER_HOUR,
}
# -----------------------------------------------------------------------------

FEATURE_COLS = list(LOOKBACK_WINDOWS) + [CRITICAL_WINDOW[0], "time_since_last_critical",
                                          "tipo_caminhao"]
LABEL_COLS = list(LABEL_HORIZONS)
OUTPUT_COLS = ["TAG", "ts_us"] + FEATURE_COLS + ["current_state"] + LABEL_COLS


def with_micros(df: DataFrame, ts_col: str | None = None, out: str = "ts_us") -> DataFrame:
    if out in df.columns:
        return df
    return df.withColumn(out, epoch_micros(df, ts_col or time_column(df)))


def interval_frame(intervals: DataFrame) -> DataFrame:
    """Normalise an interval table to TAG, _start, _end, _value (micros)."""
    key = interval_key(intervals)
    iv = intervals
    if "inicio_us" not in iv.columns:
        iv = iv.withColumn("inicio_us", epoch_micros(iv, "Inicio"))
    if "fim_us" not in iv.columns:
        iv = iv.withColumn("fim_us", epoch_micros(iv, "Fim"))
    return iv.select(F.col(key).alias("TAG"), F.col("inicio_us").alias("_start"),
                     F.col("fim_us").alias("_end"), F.col("Classe").alias("_value"))


def build_features(tele: DataFrame, intervals: DataFrame | None = None, *,
                   keep: list[str] = (), tiebreak: list[str] = (),
                   bucket_us: int | None = None, ties: str = "range", target_rows: int = TARGET_ROWS,
                   include: set[str] | None = None) -> DataFrame:
    """Feature matrix, one row per telemetry row with a TAG and a timestamp.

    ``include`` restricts the computed columns (all by default), so single
    feature queries reuse the same plan shape.
    """
    t = with_micros(tele)
    want = (lambda n: include is None or n in include)
    crit = F.col("Id_Criticidade") == F.lit(CRITICAL_LEVEL)
    specs = WindowSpecs(
        lookback={n: (None, s) for n, s in LOOKBACK_WINDOWS.items() if want(n)},
        forward={n: (F.col("Is_Dont_Go") == 1, h) for n, h in LABEL_HORIZONS.items() if want(n)},
    )
    if want(CRITICAL_WINDOW[0]):
        specs.lookback[CRITICAL_WINDOW[0]] = (crit, CRITICAL_WINDOW[1])
    if want("time_since_last_critical"):
        specs.since["time_since_last_critical"] = (crit, DEFAULT_MINUTES_SINCE)
    if want("tipo_caminhao"):
        specs.first["tipo_caminhao"] = F.coalesce((F.col("Tipo") == F.lit(TRUCK)).cast("int"), F.lit(0))
    if intervals is not None and want("current_state"):
        specs.states = interval_frame(intervals)
        specs.state_name = "current_state"
        specs.state_default = UNKNOWN_STATE
    tb = list(tiebreak) or [c for c in ("event_id",) if c in t.columns]
    out = windowed(t, ["TAG"], "ts_us", specs, keep=list(keep), tiebreak=tb,
                   bucket_us=bucket_us, ties=ties, target_rows=target_rows)
    order = ["TAG", "ts_us"] + [c for c in keep if c not in ("TAG", "ts_us")] + \
        [c for c in FEATURE_COLS + ["current_state"] + LABEL_COLS if c in out.columns]
    return out.select(*order)
