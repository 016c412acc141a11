"""The query catalogue: name -> (spark callable(spark, sf_dir), oracle SQL or
None). Every query reads the driver's tables through the adapters, so its
work grows with the data."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions.binning import right_closed_bin
from faultline.functions.timecols import epoch_micros, micros_to_ntz
from faultline.operators import eda, ml
from faultline.operators import metrics as M
from faultline.operators import quality as Q
from faultline.operators import rules as R
from faultline.operators import split as S
from faultline.plans import evaluation as EV
from faultline.plans import oracle as O
from faultline.plans import stages
from faultline.session import ensure_checkpoint_dir
from faultline.plans.features import FEATURE_COLS, LABEL_COLS, LOOKBACK_WINDOWS, build_features
from faultline.sources import adapters as A
from faultline.sources import sinks
from faultline.sources.telemetry import load_intervals, load_rules, load_telemetry, union_months

LOOKBACK_COLS = list(LOOKBACK_WINDOWS)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- feature matrix -----------------------------------------------------------

def _features(spark, sf_dir, include=None):
    return build_features(A.telemetry(spark, sf_dir), A.intervals(spark, sf_dir),
                          keep=["event_id"], include=include)


@register("feature_matrix", O.with_ctes(O.TELEMETRY_CTE, O.INTERVALS_CTE, O.FEATURES_CTE,
                                        body="select * from features"))
def feature_matrix(spark, sf_dir):
    return _features(spark, sf_dir)


# --- shared inputs -----------------------------------------------------------------


ADAPTER_TRAIN_END = "2024-01-20 23:59:59"
ADAPTER_TEST_START = "2024-01-21 00:00:00"


def _tele(spark, sf_dir):
    return A.telemetry(spark, sf_dir)


def _clean(spark, sf_dir):
    return Q.clean_telemetry(_tele(spark, sf_dir))


def _scored_features(spark, sf_dir):
    f = _features(spark, sf_dir)
    return (f.withColumn("y", F.col("label_4h"))
             .withColumn("y_prob", F.when(F.col("critical_alarm_count_1h") > 0, F.lit(0.3)).otherwise(F.lit(0.0))
                         + (F.col("event_id") % 50).cast("double") / F.lit(100.0)))


def _test_split(df):
    return S.temporal_split(df, "ts_us", ADAPTER_TRAIN_END, ADAPTER_TEST_START)


# --- scans -----------------------------------------------------------------------------

_MONTH_SPANS = [("jan", None, "2024-01-06"), ("feb", "2024-01-06", "2024-01-11"),
                ("mar", "2024-01-11", "2024-01-16"), ("abr", "2024-01-16", "2024-01-21"),
                ("may", "2024-01-21", "2024-01-26"), ("jun", "2024-01-26", None)]


def _monthly_slices(spark, sf_dir):
    """The events table read as six monthly inputs (each a pushed-down range
    scan), raw telemetry columns with ``Data_Evento``."""
    out = {}
    for m, lo, hi in _MONTH_SPANS:
        t = _tele(spark, sf_dir)
        if lo:
            t = t.where(F.col("timestamp") >= F.lit(lo).cast("timestamp_ntz"))
        if hi:
            t = t.where(F.col("timestamp") < F.lit(hi).cast("timestamp_ntz"))
        out[m] = t.drop("_source_month", "ts_us").withColumnRenamed("timestamp", "Data_Evento")
    return out


@register("scan_union_months", O.with_ctes(O.TELEMETRY_CTE, body="""
select _source_month, count(*) as n_rows, count(distinct TAG) as n_tags from telemetry group by 1"""))
def scan_union_months(spark, sf_dir):
    t = union_months(_monthly_slices(spark, sf_dir))
    return t.groupBy("_source_month").agg(F.count(F.lit(1)).alias("n_rows"),
                                         F.count_distinct("TAG").alias("n_tags"))


@register("clean_telemetry", O.with_ctes(O.TELEMETRY_CTE, O.CLEAN_CTE, body="""
select event_id, Criticidade, Classe, Valor from clean"""))
def clean_telemetry(spark, sf_dir):
    return _clean(spark, sf_dir).select("event_id", "Criticidade", "Classe", "Valor")


_QC_SQL = r"""count(*) as n_rows,
  count(*) filter (where regexp_replace(Criticidade, 'N.{1,2}o Cr.{1,2}tico', 'Não Crítico', 'g') <> Criticidade) as criticidade_fixed,
  count(*) filter (where Classe = 'NULL') as null_string_fixed,
  count(*) filter (where Valor = 'NULL') as valor_null_fixed,
  count(*) filter (where contains(Valor, ',')) as decimal_fixed"""


@register("quality_counts", O.with_ctes(O.TELEMETRY_CTE, body=r"""
select """ + _QC_SQL + r""",
  count(*) filter (where replace(case when Valor = 'NULL' then null else Valor end, ',', '.') is not null
     and not regexp_matches(replace(case when Valor = 'NULL' then null else Valor end, ',', '.'),
                            '^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$')) as valor_rejected
from telemetry"""))
def quality_counts(spark, sf_dir):
    return Q.quality_counts(_tele(spark, sf_dir))


@register("quality_counts_by_month", O.with_ctes(O.TELEMETRY_CTE, body="select _source_month, " + _QC_SQL
                                                 + " from telemetry group by 1"))
def quality_counts_by_month(spark, sf_dir):
    return Q.quality_counts_by_month(_tele(spark, sf_dir))


@register("post_clean_checks", O.with_ctes(O.TELEMETRY_CTE, O.CLEAN_CTE, body="""
select count(*) as n_rows, count(*) filter (where contains(Criticidade, '?')) as criticidade_marker,
  count(*) filter (where Classe = 'NULL') as classe_null_literal,
  count(*) filter (where cast(Valor as varchar) = 'NULL') as valor_null_literal,
  true as valor_is_double
from clean"""))
def post_clean_checks(spark, sf_dir):
    return Q.post_clean_checks(_clean(spark, sf_dir))


@register("inverted_intervals", O.with_ctes(O.INTERVALS_CTE, body="""
select count(*) as n_intervals, count(*) filter (where inicio_us > fim_us) as inicio_after_fim from intervals"""))
def inverted_intervals(spark, sf_dir):
    return Q.inverted_intervals(A.intervals(spark, sf_dir))


@register("tag_mismatch", O.with_ctes(O.TELEMETRY_CTE, O.INTERVALS_CTE, body="""
select distinct TAG from telemetry where TAG is not null
  and TAG not in (select Tag from intervals where Tag is not null)"""))
def tag_mismatch(spark, sf_dir):
    return Q.tag_mismatch(_tele(spark, sf_dir), A.intervals(spark, sf_dir))


@register("tag_mismatch_inverted", O.with_ctes(O.TELEMETRY_CTE, O.INTERVALS_CTE, body="""
select distinct TAG from telemetry where TAG is not null
  and TAG not in (select Tag from intervals where Tag is not null and inicio_us > fim_us)"""))
def tag_mismatch_inverted(spark, sf_dir):
    """TAGs that appear in no inverted interval (a non-empty mismatch list)."""
    return Q.tag_mismatch(_tele(spark, sf_dir), A.intervals(spark, sf_dir).where("inicio_us > fim_us"))


@register("full_quality_report", O.with_ctes(O.TELEMETRY_CTE, O.INTERVALS_CTE, "parts AS (select " + _QC_SQL + r""",
  count(*) filter (where replace(case when Valor = 'NULL' then null else Valor end, ',', '.') is not null
     and not regexp_matches(replace(case when Valor = 'NULL' then null else Valor end, ',', '.'),
                            '^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$')) as valor_rejected,
  (select count(distinct TAG) from telemetry where TAG not in (select Tag from intervals where Tag is not null))
    as tag_mismatches,
  (select cast(count(*) - (select count(*) from (select distinct * from telemetry)) as bigint) from telemetry)
    as duplicate_rows,
  (select count(*) from (select h, lead(h) over (order by h) as nxt
     from (select distinct cast(floor(ts_us / 3600000000) as bigint) as h from telemetry)) where nxt - h > 1)
    as timestamp_gaps,
  (select count(*) from intervals where inicio_us > fim_us) as inverted_intervals
  from telemetry)""", body="""
select *, concat_ws(chr(10),
    'Telemetry rows: ' || cast(n_rows as varchar),
    '  Criticidade encoding fixed: ' || cast(criticidade_fixed as varchar),
    '  NULL string -> null (Classe): ' || cast(null_string_fixed as varchar),
    '  NULL string -> null (Valor): ' || cast(valor_null_fixed as varchar),
    '  Decimal separator fixed: ' || cast(decimal_fixed as varchar),
    '  TAGs without intervals: ' || cast(tag_mismatches as varchar),
    '  Duplicate rows: ' || cast(duplicate_rows as varchar),
    '  Gaps in the time line: ' || cast(timestamp_gaps as varchar),
    '  Inverted intervals: ' || cast(inverted_intervals as varchar)) as summary
from parts"""))
def full_quality_report(spark, sf_dir):
    """Cleaning counters and validators in one row."""
    return Q.full_quality_report(_tele(spark, sf_dir), A.intervals(spark, sf_dir))


_DUP_COLS = ["TAG", "Alarme", "Id_Criticidade", "Criticidade", "Valor", "Classe", "Is_Dont_Go", "Tipo"]


@register("duplicate_rows", O.with_ctes(O.TELEMETRY_CTE, body=f"""
select cast(coalesce(sum(n - 1), 0) as bigint) as duplicate_rows, count(*) as distinct_rows
from (select count(*) as n from telemetry group by {", ".join(_DUP_COLS)}, ts_us)"""))
def duplicate_rows(spark, sf_dir):
    return Q.duplicate_rows(_tele(spark, sf_dir), _DUP_COLS + ["ts_us"])


@register("alarm_profile_duplicates", O.with_ctes(O.TELEMETRY_CTE, body="""
select cast(coalesce(sum(n - 1), 0) as bigint) as duplicate_rows, count(*) as distinct_rows
from (select count(*) as n from telemetry group by TAG, Alarme, Criticidade, Classe, Tipo)"""))
def alarm_profile_duplicates(spark, sf_dir):
    """Duplicate count on a coarse projection (many duplicates, hot groups)."""
    return Q.duplicate_rows(_tele(spark, sf_dir), ["TAG", "Alarme", "Criticidade", "Classe", "Tipo"])


@register("timestamp_gaps", O.with_ctes(O.TELEMETRY_CTE, body="""
select _source_month, (h + 1) * 3600000000 as gap_start_us, nxt * 3600000000 as gap_end_us,
  cast(nxt - h - 1 as bigint) as missing_units
from (select _source_month, h, lead(h) over (order by h) as nxt
      from (select max(_source_month) as _source_month, cast(floor(ts_us / 3600000000) as bigint) as h
            from telemetry group by 2))
where nxt - h > 1"""))
def timestamp_gaps(spark, sf_dir):
    return Q.timestamp_gaps(_tele(spark, sf_dir))


@register("timestamp_gaps_minutes", O.with_ctes(O.TELEMETRY_CTE, body="""
select _source_month, (h + 1) * 60000000 as gap_start_us, nxt * 60000000 as gap_end_us,
  cast(nxt - h - 1 as bigint) as missing_units
from (select _source_month, h, lead(h) over (order by h) as nxt
      from (select max(_source_month) as _source_month, cast(floor(ts_us / 60000000) as bigint) as h
            from telemetry group by 2))
where nxt - h > 1"""))
def timestamp_gaps_minutes(spark, sf_dir):
    """Gaps at minute grain, where there are some, across months too."""
    return Q.timestamp_gaps(_tele(spark, sf_dir), unit_us=60_000_000)


# --- time-window features ---------------------------------------------------------------

def _feature_subset(cols):
    def q(spark, sf_dir):
        return _features(spark, sf_dir, include=set(cols)).select("event_id", "TAG", "ts_us", *cols)
    return q


def _feature_sql(cols):
    return O.with_ctes(O.TELEMETRY_CTE, O.INTERVALS_CTE, O.FEATURES_CTE,
                       body=f"select event_id, TAG, ts_us, {', '.join(cols)} from features")


for _name, _cols in {
    "rolling_counts": ["alarm_count_15m", "alarm_count_30m", "alarm_count_1h", "alarm_count_2h",
                       "alarm_count_4h"],
    "critical_1h": ["critical_alarm_count_1h"],
    "time_since_critical": ["time_since_last_critical"],
    "forward_labels": ["label_1h", "label_2h", "label_4h"],
    "tipo_first_row": ["tipo_caminhao"],
    "current_state": ["current_state"],
}.items():
    register(_name, _feature_sql(_cols))(_feature_subset(_cols))


def _features_on(view_fn, view_sql_cte):
    def q(spark, sf_dir):
        return build_features(view_fn(spark, sf_dir), A.intervals(spark, sf_dir), keep=["event_id"])
    sql = O.with_ctes(O.TELEMETRY_CTE, view_sql_cte, O.INTERVALS_CTE,
                      O.FEATURES_CTE.replace("from telemetry where TAG is not null",
                                             "from telemetry_v where TAG is not null"),
                      body="select * from features")
    return q, sql


_TIES_CTE = """telemetry_v AS (
  select * replace (ts_us - ts_us % 3600000000 as ts_us) from telemetry)"""
_DENSE_CTE = """telemetry_v AS (
  select * replace (concat('EQ', cast(e.user_id % 10 as varchar)) as TAG)
  from telemetry t join events e using (event_id))"""

_q, _s = _features_on(A.telemetry_ties, _TIES_CTE)
register("feature_matrix_ties", _s)(_q)


def _dense_features(spark, sf_dir):
    return build_features(A.telemetry_dense(spark, sf_dir), A.intervals(spark, sf_dir), keep=["event_id"])


register("feature_matrix_dense", _features_on(A.telemetry_dense, _DENSE_CTE)[1])(_dense_features)

_HOT_CTE = """telemetry_v AS (
  select * replace (case when e.user_id % 3 = 0 then 'EQHOT' else t.TAG end as TAG)
  from telemetry t join events e using (event_id))"""


def _hot_features(spark, sf_dir):
    """Feature matrix when one TAG holds a third of the events."""
    return build_features(A.telemetry_hot(spark, sf_dir), A.intervals(spark, sf_dir), keep=["event_id"])


register("feature_matrix_hot", _features_on(A.telemetry_hot, _HOT_CTE)[1])(_hot_features)

_CROWDED_CTE = f"""telemetry_v AS (
  select t.* replace (case when e.user_id % 3 = 0 then 'EQHOT' else t.TAG end as TAG,
    case when e.user_id % 3 = 0 and event_id % 4 = 0 then {A.CROWDED_US}
         when e.user_id % 3 = 0 then {A.CROWDED_US - 12 * 3_600_000_000} + t.ts_us % 86400000000
         else t.ts_us end as ts_us)
  from telemetry t join events e using (event_id))"""


def _crowded_features(spark, sf_dir):
    """One TAG holds a third of the events on one day, a quarter of them at one
    instant; 500 rows per bucket make the sweep of dense keys take over."""
    return build_features(A.telemetry_crowded(spark, sf_dir), A.intervals(spark, sf_dir), keep=["event_id"],
                          target_rows=500)


register("feature_matrix_crowded", _features_on(A.telemetry_crowded, _CROWDED_CTE)[1])(_crowded_features)


# --- rules ---------------------------------------------------------------------------------

_RULE_CTES = [O.TELEMETRY_CTE, O.RULES_CTE, """r AS (
  select EVENTO, QTD, TEMPO from (
    select *, row_number() over (partition by EVENTO order by QTD, TEMPO) as rn from rules) where rn = 1)""",
    """flags AS (
  select t.event_id, t.TAG, t.Alarme, t.ts_us, t.Is_Dont_Go,
    case when r.EVENTO is null or t.TAG is null then 0
         when (select count(*) from telemetry t2 where t2.TAG = t.TAG and t2.Alarme = t.Alarme
                 and t2.ts_us > t.ts_us - cast(r.TEMPO as bigint) * 60000000 and t2.ts_us <= t.ts_us) >= r.QTD
         then 1 else 0 end as Is_Dont_Go_derived
  from telemetry t left join r on t.Alarme = r.EVENTO)"""]


def _rule_flags(spark, sf_dir):
    t = _tele(spark, sf_dir).select("event_id", "TAG", "Alarme", "ts_us", "Is_Dont_Go")
    return R.apply_rules(t, A.rules(spark))


@register("rule_flags", O.with_ctes(*_RULE_CTES, body="select * from flags"))
def rule_flags(spark, sf_dir):
    return _rule_flags(spark, sf_dir)


@register("signal_compare", O.with_ctes(*_RULE_CTES, body="""
select tp as true_positives, fp as false_positives, fn as false_negatives, tn as true_negatives,
  coalesce(cast(tp as double) / nullif(cast(tp + fp as double), 0), 0.0) as precision,
  coalesce(cast(tp as double) / nullif(cast(tp + fn as double), 0), 0.0) as recall
from (select """ + O.confusion_sql("Is_Dont_Go", "Is_Dont_Go_derived") + " from flags)"))
def signal_compare(spark, sf_dir):
    t = _tele(spark, sf_dir).select("TAG", "Alarme", "ts_us", "Is_Dont_Go")
    return R.flag_confusion(t, A.rules(spark))


@register("rule_flags_by_alarm", O.with_ctes(*_RULE_CTES, body="""
select Alarme, count(*) as n_rows, cast(sum(Is_Dont_Go_derived) as bigint) as derived,
  cast(sum(Is_Dont_Go) as bigint) as registered from flags group by Alarme"""))
def rule_flags_by_alarm(spark, sf_dir):
    return _rule_flags(spark, sf_dir).groupBy("Alarme").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("Is_Dont_Go_derived").cast("long")).alias("derived"),
        F.sum(F.col("Is_Dont_Go").cast("long")).alias("registered"))


_MANY_CTES = [O.TELEMETRY_CTE, """telemetry_m AS (
  select t.* replace (concat('AL', cast(e.user_id % 40 as varchar)) as Alarme)
  from telemetry t join events e using (event_id))""", """rules AS (
  select distinct concat('AL', cast(user_id % 40 as varchar)) as EVENTO, cast(1 + user_id % 4 as integer) as QTD,
    cast(case when user_id % 7 <> 3 then (1 + user_id % 40) * (1 + user_id % 7) * 11 end as integer) as TEMPO
  from events)""", """r AS (
  select EVENTO, QTD, TEMPO from (
    select *, row_number() over (partition by EVENTO order by QTD, TEMPO) as rn from rules where TEMPO > 0)
  where rn = 1)""", """flags AS (
  select t.event_id, t.TAG, t.Alarme, t.ts_us, t.Is_Dont_Go,
    case when r.EVENTO is null or t.TAG is null then 0
         when (select count(*) from telemetry_m t2 where t2.TAG = t.TAG and t2.Alarme = t.Alarme
                 and t2.ts_us > t.ts_us - cast(r.TEMPO as bigint) * 60000000 and t2.ts_us <= t.ts_us) >= r.QTD
         then 1 else 0 end as Is_Dont_Go_derived
  from telemetry_m t left join r on t.Alarme = r.EVENTO)"""]


@register("rule_flags_many", O.with_ctes(*_MANY_CTES, body="select * from flags"))
def rule_flags_many(spark, sf_dir):
    """Forty alarms and as many window lengths; the rules, with doubles and
    missing lengths, are derived from the events."""
    t = A.telemetry_many_alarms(spark, sf_dir).select("event_id", "TAG", "Alarme", "ts_us", "Is_Dont_Go")
    return R.apply_rules(t, A.rules_many(spark, sf_dir))


# --- metrics on the deterministic score ------------------------------------------------------

def _scored(spark, sf_dir):
    return A.scored(spark, sf_dir)


@register("confusion", O.with_ctes(O.TELEMETRY_CTE, O.SCORED_CTE, body="select "
                                   + O.confusion_sql("y", "cast(y_prob >= 0.5 as integer)") + " from scored"))
def confusion(spark, sf_dir):
    return M.confusion_counts(_scored(spark, sf_dir).withColumn("y_pred", M.predict("y_prob", 0.5)))


@register("prf", O.with_ctes(O.TELEMETRY_CTE, O.SCORED_CTE, body="select *, " + O.RATES + " from (select "
                             + O.confusion_sql("y", "cast(y_prob >= 0.5 as integer)") + " from scored)"))
def prf(spark, sf_dir):
    return M.with_rates(M.confusion_counts(_scored(spark, sf_dir).withColumn("y_pred", M.predict("y_prob", 0.5))))


@register("threshold_sweep", O.with_ctes(O.TELEMETRY_CTE, O.SCORED_CTE, body="""
select threshold, tp, fp, fn, tn, """ + O.RATES + """ from (
  select th.threshold, """ + O.confusion_sql("s.y", "cast(s.y_prob >= th.threshold as integer)") + """
  from scored s, (select cast(x as double) as threshold from (values (0.3), (0.5), (0.7)) v(x)) th
  group by th.threshold)"""))
def threshold_sweep(spark, sf_dir):
    return M.threshold_sweep(_scored(spark, sf_dir))


def _ranking_sql(src_ctes, src, cols, y="y", score="y_prob"):
    body = O.ranking_sql(src, y, score)
    sql = O.with_ctes(*src_ctes, body.split("\nselect cast(n_pos")[0],
                      body="select cast(n_pos" + body.split("\nselect cast(n_pos")[1])
    return f"select {', '.join(cols)} from ({sql})"


_SCORED_SRC = [O.TELEMETRY_CTE, O.SCORED_CTE]


@register("roc_auc", _ranking_sql(_SCORED_SRC, "scored", ["n_pos", "n_neg", "auc_roc"]))
def roc_auc(spark, sf_dir):
    return M.ranking_metrics(_scored(spark, sf_dir)).select("n_pos", "n_neg", "auc_roc")


@register("average_precision", _ranking_sql(_SCORED_SRC, "scored", ["n_pos", "n_neg", "auc_pr"]))
def average_precision(spark, sf_dir):
    return M.ranking_metrics(_scored(spark, sf_dir)).select("n_pos", "n_neg", "auc_pr")


@register("score_curve", O.with_ctes(O.TELEMETRY_CTE, O.SCORED_CTE, body="""
select s, pos, neg,
  cast(sum(pos) over (order by s desc rows between unbounded preceding and current row) as bigint) as cum_pos,
  cast(sum(neg) over (order by s desc rows between unbounded preceding and current row) as bigint) as cum_neg
from (select cast(y_prob as double) as s, count(*) filter (where y = 1) as pos,
             count(*) filter (where y <> 1) as neg
      from scored where y_prob is not null and y is not null group by 1)"""))
def score_curve(spark, sf_dir):
    """ROC / PR curve points: cumulative positives and negatives at every
    distinct score, highest first."""
    return M.cumulative_by_score(M.materialized_scores(_scored(spark, sf_dir)))


_UNIQUE_CTE = """unique_scored AS (
  select Is_Dont_Go as y, cast((event_id * 7919) % 1000003 as double) / cast(1000003 as double) as y_prob
  from telemetry)"""


@register("ranking_unique_scores", _ranking_sql([O.TELEMETRY_CTE, _UNIQUE_CTE], "unique_scored",
                                                ["n_pos", "n_neg", "auc_roc", "auc_pr"]))
def ranking_unique_scores(spark, sf_dir):
    """Ranking metrics of a near-unique score over many range partitions."""
    t = _tele(spark, sf_dir).select(F.col("Is_Dont_Go").alias("y"), (
        ((F.col("event_id") * 7919) % 1000003).cast("double") / F.lit(1000003.0)).alias("y_prob"))
    return M.ranking_metrics(t, part_rows=500)


# --- error analysis on scored features (test split, threshold 0.7) ----------------------------

_SF_SRC = [O.TELEMETRY_CTE, O.INTERVALS_CTE, O.FEATURES_CTE, O.SCORED_FEATURES_CTE,
           f"""test_set AS (select *, cast(y_prob >= 0.7 as integer) as y_pred from scored_features
               where ts_us >= {O.ADAPTER_TEST_START_US})""",
           f"""train_set AS (select * from scored_features where ts_us <= {O.ADAPTER_TRAIN_END_US})"""]


def _test_set(spark, sf_dir):
    _, test = _test_split(_scored_features(spark, sf_dir))
    return test.withColumn("y_pred", M.predict("y_prob", M.REPORT_THRESHOLD))


def _train_set(spark, sf_dir):
    train, _ = _test_split(_scored_features(spark, sf_dir))
    return train


@register("error_confusion", O.with_ctes(*_SF_SRC, body="select " + O.confusion_sql("y", "y_pred")
                                         + ", count(*) as n_test from test_set"))
def error_confusion(spark, sf_dir):
    t = _test_set(spark, sf_dir)
    return t.agg(*M.confusion_exprs("y", "y_pred"), F.count(F.lit(1)).alias("n_test"))


@register("fn_slices", O.with_ctes(*_SF_SRC, """fnr AS (select * from test_set where y = 1 and y_pred = 0)""",
                                   body="""
select 'total' as dimension, 'all' as key, cast(count(*) as bigint) as fn from fnr
union all select 'tipo_caminhao', 'caminhao', cast(count(*) filter (where tipo_caminhao = 1) as bigint) from fnr
union all select 'tipo_caminhao', 'escavadeira', cast(count(*) filter (where tipo_caminhao = 0) as bigint) from fnr
union all select 'alarm_count_4h_bin', '0-5', cast(count(*) filter (where alarm_count_4h > -0.5 and alarm_count_4h <= 5) as bigint) from fnr
union all select 'alarm_count_4h_bin', '6-10', cast(count(*) filter (where alarm_count_4h > 5 and alarm_count_4h <= 10) as bigint) from fnr
union all select 'alarm_count_4h_bin', '11-20', cast(count(*) filter (where alarm_count_4h > 10 and alarm_count_4h <= 20) as bigint) from fnr
union all select 'alarm_count_4h_bin', '21+', cast(count(*) filter (where alarm_count_4h > 20) as bigint) from fnr
union all select 'current_state', current_state, cast(count(*) as bigint) from fnr
  where current_state is not null group by current_state"""))
def fn_slices(spark, sf_dir):
    return M.fn_slices(_test_set(spark, sf_dir))


@register("recall_by_month", O.with_ctes(*_SF_SRC, body="""
select month, coalesce(cast(tp as double) / nullif(cast(tp + fn as double), 0), 0.0) as recall, tp, fn,
  tp + fn as positives
from (select strftime(make_timestamp(ts_us), '%Y-%m') as month,
        count(*) filter (where y = 1 and y_pred = 1) as tp, count(*) filter (where y = 1 and y_pred = 0) as fn
      from test_set group by 1)"""))
def recall_by_month(spark, sf_dir):
    return M.recall_by_month(_test_set(spark, sf_dir))


@register("recall_by_day", O.with_ctes(*_SF_SRC, body="""
select day, coalesce(cast(tp as double) / nullif(cast(tp + fn as double), 0), 0.0) as recall, tp, fn,
  tp + fn as positives
from (select strftime(make_timestamp(ts_us), '%Y-%m-%d') as day,
        count(*) filter (where y = 1 and y_pred = 1) as tp, count(*) filter (where y = 1 and y_pred = 0) as fn
      from test_set group by 1)"""))
def recall_by_day(spark, sf_dir):
    """Drift check at day grain (the adapter data spans one month)."""
    t = _test_set(spark, sf_dir)
    g = t.groupBy(F.date_format(micros_to_ntz(F.col("ts_us")), "yyyy-MM-dd").alias("day")).agg(
        F.count_if((F.col("y") == 1) & (F.col("y_pred") == 1)).alias("tp"),
        F.count_if((F.col("y") == 1) & (F.col("y_pred") == 0)).alias("fn"))
    return g.select("day", M.safe_div(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"), "tp", "fn",
                    (F.col("tp") + F.col("fn")).alias("positives"))


@register("impact_estimate", O.with_ctes(*_SF_SRC, body="""
select tp, tp + fn as positives, coalesce(cast(tp as double) / nullif(cast(tp + fn as double), 0), 0.0) as recall,
  cast(tp * 4 as bigint) as anticipated_hours
from (select """ + O.confusion_sql("y", "y_pred") + " from test_set)"))
def impact_estimate(spark, sf_dir):
    """Don't Go events anticipated on the test split and the hours of
    warning they represent (4 h horizon)."""
    c = M.confusion_counts(_test_set(spark, sf_dir))
    return c.select("tp", (F.col("tp") + F.col("fn")).alias("positives"),
                    M.safe_div(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
                    (F.col("tp") * F.lit(4)).cast("long").alias("anticipated_hours"))


# --- split and baselines -----------------------------------------------------------------------------

@register("temporal_split_counts", O.with_ctes(O.TELEMETRY_CTE, O.INTERVALS_CTE, O.FEATURES_CTE, body=f"""
select count(*) filter (where ts_us <= {O.ADAPTER_TRAIN_END_US}) as train_rows,
  count(*) filter (where ts_us >= {O.ADAPTER_TEST_START_US}) as test_rows,
  count(*) filter (where not (ts_us <= {O.ADAPTER_TRAIN_END_US}) and not (ts_us >= {O.ADAPTER_TEST_START_US})) as neither_rows,
  count(*) filter (where ts_us <= {O.ADAPTER_TRAIN_END_US} and label_4h = 1) as train_positives,
  count(*) filter (where ts_us >= {O.ADAPTER_TEST_START_US} and label_4h = 1) as test_positives
from features"""))
def temporal_split_counts(spark, sf_dir):
    return S.split_counts(_features(spark, sf_dir), "label_4h", "ts_us", ADAPTER_TRAIN_END, ADAPTER_TEST_START)


@register("class_balance", O.with_ctes(*_SF_SRC, body="""
select n_neg, n_pos, case when n_pos > 0 then cast(n_neg as double) / cast(n_pos as double) else 1.0 end
  as scale_pos_weight
from (select count(*) filter (where label_4h = 0) as n_neg, count(*) filter (where label_4h = 1) as n_pos
      from train_set)"""))
def class_balance(spark, sf_dir):
    return ml.class_balance(_train_set(spark, sf_dir), "label_4h")


def _report_sql(src_cte_name: str, pred: str, score: str) -> str:
    conf = O.with_ctes(*_SF_SRC, f"""src AS (select y, {pred} as y_pred, {score} as y_prob from {src_cte_name})""",
                       f"""cm AS (select {O.confusion_sql('y', 'y_pred')} from src)""",
                       O.ranking_sql("src").split("\nselect cast(n_pos")[0],
                       """rk AS (select cast(n_pos as bigint) as n_pos, cast(n_neg as bigint) as n_neg,
  case when n_pos > 0 and n_neg > 0 then round(auc_num / (cast(n_pos as double) * cast(n_neg as double)), 6) else 0.0 end as auc_roc,
  case when n_pos > 0 and n_neg > 0 then round(ap_num / cast(n_pos as double), 6) else 0.0 end as auc_pr from agg)""",
                       body=f"select cm.*, {O.RATES}, rk.* from cm, rk")
    return conf


@register("heuristic_metrics", _report_sql("test_set", "cast(critical_alarm_count_1h > 0 as integer)",
                                           "cast(critical_alarm_count_1h as double)"))
def heuristic_metrics(spark, sf_dir):
    return _report(ml.heuristic(_test_set(spark, sf_dir).drop("y_pred", "y_prob")))


def _report(scored_df):
    return M.classification_report(scored_df, "y", "y_prob", threshold=None, pred="y_pred")


@register("dummy_majority_metrics", _report_sql(
    "test_set", "(select case when count(*) filter (where y = 1) > count(*) filter (where y = 0) then 1 else 0 end from train_set)",
    "cast((select case when count(*) filter (where y = 1) > count(*) filter (where y = 0) then 1 else 0 end from train_set) as double)"))
def dummy_majority_metrics(spark, sf_dir):
    n = ml.label_counts(_train_set(spark, sf_dir), "y")
    return _report(ml.dummy_majority(_test_set(spark, sf_dir).drop("y_pred", "y_prob"), int(n["n_pos"] > n["n_neg"]),
                                     n["n_pos"] > 0))


_DRAW = ("cast(cast(('0x' || substr(md5(concat('42|', cast(event_id as varchar))), 1, 13)) as bigint) as double)"
         " / cast(4503599627370496 as double)")
_STRATIFIED = f"cast({_DRAW} < (select avg(cast(y as double)) from train_set) as integer)"


@register("dummy_stratified_metrics", _report_sql("test_set", _STRATIFIED, f"cast({_STRATIFIED} as double)"))
def dummy_stratified_metrics(spark, sf_dir):
    n = ml.label_counts(_train_set(spark, sf_dir), "y")
    rate = n["n_pos"] / max(1, n["n_pos"] + n["n_neg"])
    return _report(ml.dummy_stratified(_test_set(spark, sf_dir).drop("y_pred", "y_prob"), rate, ["event_id"]))


_BASELINES = {
    "dummy_most_frequent": (
        "(select cast(count(*) filter (where y = 1) > count(*) filter (where y = 0) as integer) from train_set)",
        "cast((select cast(count(*) filter (where y = 1) > count(*) filter (where y = 0) as integer) from train_set)"
        " as double)"),
    "dummy_stratified": (_STRATIFIED, f"cast({_STRATIFIED} as double)"),
    "heuristic_critical_1h": ("cast(critical_alarm_count_1h > 0 as integer)",
                              "cast(critical_alarm_count_1h as double)"),
}
_SCORE_MODEL = ("cast(y_prob >= 0.5 as integer)", "y_prob")


def _metric_ctes(name: str, source: str, pred: str, score: str, y: str = "y") -> list[str]:
    """CTEs ``<name>_row``: counts, rates and ranking metrics of one prediction."""
    return [f"{name}_src AS (select {y} as y, {pred} as y_pred, {score} as y_prob from {source})",
            f"{name}_st AS (select y_prob as s, count(*) filter (where y = 1) as pos, "
            f"count(*) filter (where y <> 1) as neg from {name}_src group by 1)",
            f"""{name}_cum AS (select s, pos, neg,
  sum(pos) over (order by s desc rows between unbounded preceding and current row) as cp,
  sum(neg) over (order by s desc rows between unbounded preceding and current row) as cn from {name}_st)""",
            f"""{name}_rank AS (select coalesce(sum(pos), 0) as n_pos, coalesce(sum(neg), 0) as n_neg,
  sum(cast(neg as double) * (cast(cp - pos as double) + cast(pos as double) * 0.5)) as auc_num,
  sum(case when pos > 0 then cast(pos as double) * (cast(cp as double) / cast(cp + cn as double)) end) as ap_num
  from {name}_cum)""",
            f"""{name}_row AS (select c.*, {O.RATES},
  case when n_pos > 0 and n_neg > 0 then round(auc_num / (cast(n_pos as double) * cast(n_neg as double)), 6) else 0.0 end as auc_roc,
  case when n_pos > 0 and n_neg > 0 then round(ap_num / cast(n_pos as double), 6) else 0.0 end as auc_pr
  from (select {O.confusion_sql('y', 'y_pred')} from {name}_src) c, {name}_rank)"""]


def _comparison_sql() -> str:
    ctes, rows = list(_SF_SRC), []
    for name, (pred, score) in {**_BASELINES, "score": _SCORE_MODEL}.items():
        ctes += _metric_ctes(name, "test_set", pred, score)
        rows.append(f"select '{name}' as model, * from {name}_row")
    ctes.append("r AS (" + " union all ".join(rows) + ")")
    ctes.append("b AS (select max(f1) as best from r where model <> 'score')")
    ctes.append("w AS (select model as winner from r order by f1 desc, auc_pr desc, model limit 1)")
    return O.with_ctes(*ctes, body="""
select model, tp, fp, fn, tn, precision, recall, f1, auc_roc, auc_pr,
  coalesce(cast(tp + fn as double) / nullif(cast(tp + fp + fn + tn as double), 0), 0.0) as base_rate,
  coalesce(auc_pr / nullif(cast(tp + fn as double) / cast(tp + fp + fn + tn as double), 0), 0.0) as ap_lift,
  b.best as best_baseline_f1, coalesce(f1 / nullif(b.best, 0), 0.0) as f1_lift,
  model = w.winner as is_winner, w.winner = 'score' as winner_beats_baseline
from r, b, w""")


@register("baseline_comparison", _comparison_sql())
def baseline_comparison(spark, sf_dir):
    """All baselines next to a deterministic score: lifts, best baseline, winner."""
    train, test = _test_split(_scored_features(spark, sf_dir))
    test = test.withColumn("y_score", F.col("y_prob"))
    rows = EV.baseline_rows(spark, train, test.drop("y_prob"), "label_4h", ["event_id"])
    rows = rows.unionByName(EV.model_metrics(spark, "score", "label_4h", test.select("y", "y_prob"), 0, 1.0))
    return EV.comparison(rows, list(_BASELINES)).select(
        "model", "tp", "fp", "fn", "tn", "precision", "recall", "f1", "auc_roc", "auc_pr", "base_rate", "ap_lift",
        "best_baseline_f1", "f1_lift", "is_winner", "winner_beats_baseline")


def _horizon_sql() -> str:
    ctes, rows = list(_SF_SRC), []
    for i, label in enumerate(LABEL_COLS):
        ctes += _metric_ctes(label, "test_set", *_SCORE_MODEL, y=label)
        rows.append(f"select '{label}' as label, {i} as k, * from {label}_row")
    ctes.append("r AS (" + " union all ".join(rows) + ")")
    return O.with_ctes(*ctes, body="""
select label, tp, fp, fn, tn, precision, recall, f1, auc_roc, auc_pr,
  label = (select label from r order by f1 desc, k limit 1) as is_best from r""")


@register("horizon_pick_scores", _horizon_sql())
def horizon_pick_scores(spark, sf_dir):
    """The best horizon by F1 of a deterministic score (ties: the shorter one)."""
    _, test = _test_split(_scored_features(spark, sf_dir))
    rows = None
    for i, label in enumerate(LABEL_COLS):
        t = test.select(F.col(label).cast("int").alias("y"), "y_prob")
        r = EV.model_metrics(spark, "score", label, t, 0, 1.0).withColumn("_order", F.lit(i))
        rows = r if rows is None else rows.unionByName(r)
    return EV.mark_best_horizon(rows).select("label", "tp", "fp", "fn", "tn", "precision", "recall", "f1", "auc_roc",
                                             "auc_pr", "is_best")


# --- through files: what a user's run stores and reads again ----------------------------------------

def _run_dir(spark, name: str) -> str:
    """A new folder under the session's checkpoint storage."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/faultline-{name}-{uuid.uuid4().hex}"


@register("stored_months_cleaned", O.with_ctes(O.TELEMETRY_CTE, O.CLEAN_CTE, body="""
select event_id, TAG, Alarme, Criticidade, Classe, Valor, _source_month, ts_us from clean"""))
def stored_months_cleaned(spark, sf_dir):
    """Six monthly files are written, checked and loaded by the scan, cleaned,
    stored by source month and read again."""
    path = _run_dir(spark, "months")
    for month, df in _monthly_slices(spark, sf_dir).items():
        df.write.parquet(f"{path}/in/telemetry_{month}.parquet")
    raw = load_telemetry(spark, f"{path}/in")
    sinks.write_parquet(Q.clean_telemetry(raw), f"{path}/clean", partition_by=["_source_month"],
                        sort_within=["TAG", "timestamp"])
    c = spark.read.parquet(f"{path}/clean")
    return c.select("event_id", "TAG", "Alarme", "Criticidade", "Classe", "Valor", "_source_month",
                    epoch_micros(c, "timestamp").alias("ts_us"))


@register("stored_features_test_read", O.with_ctes(
    O.TELEMETRY_CTE, O.INTERVALS_CTE, O.FEATURES_CTE, body=f"""
select TAG, ts_us, alarm_count_4h, current_state, label_4h from features
where ts_us >= {O.ADAPTER_TEST_START_US}"""))
def stored_features_test_read(spark, sf_dir):
    """The feature table is stored by event month; the test rows are read back
    with the time filter pushed to the files and only the needed columns."""
    path = stages.stage_features(_tele(spark, sf_dir), A.intervals(spark, sf_dir), _run_dir(spark, "features"))
    start = spark.range(1).select(S.wall_micros(ADAPTER_TEST_START)).first()[0]
    return sinks.read_scored_test(spark, path, ["TAG", "ts_us", "alarm_count_4h", "current_state", "label_4h"],
                                  "ts_us", start)


@register("stored_intervals_text", O.with_ctes(O.INTERVALS_CTE, body="""
select Tag, inicio_us, fim_us, Classe from intervals"""))
def stored_intervals_text(spark, sf_dir):
    """Intervals stored with text instants under the other key name, then loaded
    (key renamed, instants parsed)."""
    path = _run_dir(spark, "intervals")
    iv = A.intervals(spark, sf_dir)
    iv.select(F.col("Tag").alias("TAG"), F.col("Inicio").cast("string").alias("Inicio"),
              F.col("Fim").cast("string").alias("Fim"), "Classe").write.parquet(path)
    got = load_intervals(spark, path)
    return got.select("Tag", epoch_micros(got, "Inicio").alias("inicio_us"), epoch_micros(got, "Fim").alias("fim_us"),
                      "Classe")


@register("stored_rule_flags_csv", O.with_ctes(*_RULE_CTES, body="""
select TAG, Alarme, ts_us, Is_Dont_Go, Is_Dont_Go_derived from flags"""))
def stored_rule_flags_csv(spark, sf_dir):
    """The rule table is stored as CSV and loaded; the flags are stored as the
    CSV extract and read again."""
    path = _run_dir(spark, "rules")
    sinks.write_csv(A.rules(spark), f"{path}/rules")
    t = _tele(spark, sf_dir)
    stages.stage_rules(spark, t, load_rules(spark, f"{path}/rules"), path)
    got = sinks.read_csv(spark, f"{path}/business_rules_validation",
                         "TAG string, Alarme string, timestamp timestamp_ntz, Is_Dont_Go int, Is_Dont_Go_derived int")
    return got.select("TAG", "Alarme", epoch_micros(got, "timestamp").alias("ts_us"), "Is_Dont_Go",
                      "Is_Dont_Go_derived")


@register("stored_signal_json", O.with_ctes(*_RULE_CTES, body="""
select tp as true_positives, fp as false_positives, fn as false_negatives, tn as true_negatives,
  coalesce(cast(tp as double) / nullif(cast(tp + fp as double), 0), 0.0) as precision,
  coalesce(cast(tp as double) / nullif(cast(tp + fn as double), 0), 0.0) as recall
from (select """ + O.confusion_sql("Is_Dont_Go", "Is_Dont_Go_derived") + " from flags)"))
def stored_signal_json(spark, sf_dir):
    """The signal comparison as the rules stage stores it (JSON), read again."""
    return stages.stage_rules(spark, _tele(spark, sf_dir), A.rules(spark), _run_dir(spark, "signal"))


# --- exploratory aggregates ------------------------------------------------------------------------

@register("alarm_frequency_top20", O.with_ctes(O.TELEMETRY_CTE, body="""
select Alarme, count(*) as count from telemetry where Alarme is not null group by Alarme
order by count desc, Alarme limit 20"""))
def alarm_frequency_top20(spark, sf_dir):
    return eda.frequency(_tele(spark, sf_dir), "Alarme", top=20)


@register("criticidade_frequency", O.with_ctes(O.TELEMETRY_CTE, O.CLEAN_CTE, body="""
select Criticidade, count(*) as count from clean where Criticidade is not null group by Criticidade"""))
def criticidade_frequency(spark, sf_dir):
    return eda.frequency(_clean(spark, sf_dir), "Criticidade")


@register("state_frequency", O.with_ctes(O.INTERVALS_CTE, body="""
select Classe, count(*) as count from intervals where Classe is not null group by Classe"""))
def state_frequency(spark, sf_dir):
    return eda.frequency(A.intervals(spark, sf_dir), "Classe")


@register("dontgo_rate_by_tipo", O.with_ctes(O.TELEMETRY_CTE, body="""
select Tipo, avg(cast(Is_Dont_Go as double)) * 100.0 as rate, count(*) as n from telemetry group by Tipo"""))
def dontgo_rate_by_tipo(spark, sf_dir):
    return eda.rate_by(_tele(spark, sf_dir), "Tipo", "Is_Dont_Go")


@register("daily_dontgo", O.with_ctes(O.TELEMETRY_CTE, body="""
select d.day * 86400000000 as day_us, cast(coalesce(p.total, 0) as bigint) as total
from (select range as day from range((select min(cast(floor(ts_us / 86400000000) as bigint)) from telemetry),
                                     (select max(cast(floor(ts_us / 86400000000) as bigint)) from telemetry) + 1)) d
left join (select cast(floor(ts_us / 86400000000) as bigint) as day, sum(Is_Dont_Go) as total
           from telemetry group by 1) p on d.day = p.day"""))
def daily_dontgo(spark, sf_dir):
    return eda.daily_sum(_tele(spark, sf_dir), "ts_us", "Is_Dont_Go")


@register("daily_dontgo_by_tag", O.with_ctes(O.TELEMETRY_CTE, body="""
select s.TAG, d.day * 86400000000 as day_us, cast(coalesce(p.total, 0) as bigint) as total
from (select TAG, min(cast(floor(ts_us / 86400000000) as bigint)) as lo,
             max(cast(floor(ts_us / 86400000000) as bigint)) as hi
      from telemetry where ts_us is not null group by TAG) s,
     lateral (select unnest(generate_series(s.lo, s.hi)) as day) d
left join (select TAG, cast(floor(ts_us / 86400000000) as bigint) as day, sum(Is_Dont_Go) as total
           from telemetry where ts_us is not null group by 1, 2) p on p.TAG = s.TAG and p.day = d.day"""))
def daily_dontgo_by_tag(spark, sf_dir):
    """Daily Don't Go series of every equipment over its own span; days
    without events are zero-filled."""
    return eda.daily_sum(_tele(spark, sf_dir), "ts_us", "Is_Dont_Go", by=["TAG"])


@register("distinct_profile", O.with_ctes(O.TELEMETRY_CTE, body="""
select count(*) as n_rows, count(distinct _source_month) as distinct__source_month,
  count(distinct TAG) as distinct_TAG, count(distinct Alarme) as distinct_Alarme from telemetry"""))
def distinct_profile(spark, sf_dir):
    return eda.distinct_profile(_tele(spark, sf_dir), ["_source_month", "TAG", "Alarme"])


@register("label_rates", O.with_ctes(O.TELEMETRY_CTE, O.INTERVALS_CTE, O.FEATURES_CTE, body="""
select avg(cast(label_1h as double)) * 100.0 as label_1h_rate, avg(cast(label_2h as double)) * 100.0 as label_2h_rate,
  avg(cast(label_4h as double)) * 100.0 as label_4h_rate from features"""))
def label_rates(spark, sf_dir):
    return eda.means(_features(spark, sf_dir, include=set(LABEL_COLS)), LABEL_COLS, scale=100.0)


@register("dontgo_rate", O.with_ctes(O.TELEMETRY_CTE, body="""
select avg(cast(Is_Dont_Go as double)) * 100.0 as Is_Dont_Go_rate from telemetry"""))
def dontgo_rate(spark, sf_dir):
    return eda.means(_tele(spark, sf_dir), ["Is_Dont_Go"], scale=100.0)


_NUMERIC_FEATURES = ["ts_us", "event_id"] + FEATURE_COLS + LABEL_COLS


@register("null_profile", O.with_ctes(O.TELEMETRY_CTE, O.INTERVALS_CTE, O.FEATURES_CTE, body=" union all ".join(
    f"select '{c}' as \"column\", cast(count(*) filter (where {c} is null) as bigint) as nulls from features"
    for c in _NUMERIC_FEATURES)))
def null_profile(spark, sf_dir):
    f = _features(spark, sf_dir).select("TAG", *_NUMERIC_FEATURES, "current_state")
    return eda.null_profile(f)


@register("time_span", O.with_ctes(O.TELEMETRY_CTE, body="select min(ts_us) as min_us, max(ts_us) as max_us from telemetry"))
def time_span(spark, sf_dir):
    return eda.time_span(_tele(spark, sf_dir), "ts_us")


@register("label_correlation", O.with_ctes(O.TELEMETRY_CTE, O.INTERVALS_CTE, O.FEATURES_CTE, body=" union all ".join(
    f"""select '{c}' as feature, case when stddev_pop(cast({c} as double)) > 0 and stddev_pop(cast(label_1h as double)) > 0
      then round(covar_pop(cast({c} as double), cast(label_1h as double)) /
                 (stddev_pop(cast({c} as double)) * stddev_pop(cast(label_1h as double))), 6) end as corr from features"""
    for c in FEATURE_COLS)))
def label_correlation(spark, sf_dir):
    return eda.label_correlation(_features(spark, sf_dir), FEATURE_COLS, "label_1h")


_COUNT_COLS = ["alarm_count_15m", "alarm_count_30m", "alarm_count_1h", "alarm_count_2h", "alarm_count_4h"]


def _hist_sql(c: str) -> str:
    return f"""select '{c}' as "column", cast(b as bigint) as bin, lo + cast(b as double) * w as lo, lo + cast(b + 1 as double) * w as hi,
  count(*) as count from (
    select least(floor((cast({c} as double) - r.lo) / r.w), 29) as b, r.lo, r.w from features,
      (select min(cast({c} as double)) as lo,
              case when max(cast({c} as double)) > min(cast({c} as double))
                   then (max(cast({c} as double)) - min(cast({c} as double))) / cast(30 as double) else 1.0 end as w
       from features) r where {c} is not null)
  group by b, lo, w"""


@register("feature_histogram", O.with_ctes(O.TELEMETRY_CTE, O.INTERVALS_CTE, O.FEATURES_CTE,
                                           body=" union all ".join(_hist_sql(c) for c in _COUNT_COLS)))
def feature_histogram(spark, sf_dir):
    return eda.histogram(_features(spark, sf_dir, include=set(_COUNT_COLS)), _COUNT_COLS, bins=30) \
        .withColumn("bin", F.col("bin").cast("bigint"))


@register("alarm_bins", O.with_ctes(O.TELEMETRY_CTE, O.INTERVALS_CTE, O.FEATURES_CTE, body="""
select case when alarm_count_4h > -0.5 and alarm_count_4h <= 5 then '0-5'
            when alarm_count_4h > 5 and alarm_count_4h <= 10 then '6-10'
            when alarm_count_4h > 10 and alarm_count_4h <= 20 then '11-20'
            when alarm_count_4h > 20 then '21+' end as bin, count(*) as count
from features group by 1"""))
def alarm_bins(spark, sf_dir):
    f = _features(spark, sf_dir, include={"alarm_count_4h"})
    return f.groupBy(right_closed_bin(F.col("alarm_count_4h")).alias("bin")).agg(F.count(F.lit(1)).alias("count"))


@register("rule_flag_totals", O.with_ctes(*_RULE_CTES, body="""
select count(*) as n_rows, cast(sum(Is_Dont_Go_derived) as bigint) as derived, cast(sum(Is_Dont_Go) as bigint) as registered
from flags"""))
def rule_flag_totals(spark, sf_dir):
    """Rules evaluated on every row; totals over the output (sampling, when
    wanted, applies to the output, never before the window)."""
    f = _rule_flags(spark, sf_dir)
    return f.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("Is_Dont_Go_derived").cast("long")).alias("derived"),
                 F.sum(F.col("Is_Dont_Go").cast("long")).alias("registered"))


# --- models (rows-only checks: Spark ML results have no SQL oracle) -------------------------------


_MODEL_CACHE: dict = {}


_FEATURE_TABLES: dict = {}


def _state(spark, sf_dir) -> tuple:
    """What the caches are keyed by: session, folder and the state of the event
    files, so changed files give new models."""
    m = A.read_table(spark, sf_dir, "events").select("_metadata.file_path", "_metadata.file_modification_time",
                                                     "_metadata.file_size").distinct()
    files = m.orderBy("file_path").collect()  # one row per file
    return (spark.sparkContext.applicationId, sf_dir, tuple(map(tuple, files)))


def _splits(spark, sf_dir):
    """Train / test splits of the feature table, written once to the
    checkpoint folder so the trainings and scorings that follow read it
    instead of re-running the window plan."""
    ensure_checkpoint_dir(spark)
    key = _state(spark, sf_dir)
    if key not in _FEATURE_TABLES:
        _FEATURE_TABLES[key] = _features(spark, sf_dir).checkpoint()
    return _test_split(_FEATURE_TABLES[key])


def _fitted(spark, sf_dir, label="label_4h", family="gbt"):
    """Train once per (scale, label, family) in this process; the scored test
    set is checkpointed to the session's checkpoint folder so metric jobs do
    not re-run the model or the feature plan."""
    ensure_checkpoint_dir(spark)
    key = (_state(spark, sf_dir), label, family)
    if key not in _MODEL_CACHE:
        train, test = _splits(spark, sf_dir)
        model, sc, n_train, spw = EV.train_and_score(train, test, label, family, keep=["event_id", "ts_us",
                                                                                       "current_state"])
        _MODEL_CACHE[key] = (model, sc.checkpoint(), n_train, spw)
    return _MODEL_CACHE[key]


@register("gbt_metrics")
def gbt_metrics(spark, sf_dir):
    _, sc, n_train, spw = _fitted(spark, sf_dir, "label_4h", "gbt")
    return EV.model_metrics(spark, "gbt", "label_4h", sc, n_train, spw)


@register("rf_metrics")
def rf_metrics(spark, sf_dir):
    _, sc, n_train, spw = _fitted(spark, sf_dir, "label_4h", "rf")
    return EV.model_metrics(spark, "rf", "label_4h", sc, n_train, spw)


@register("gbt_threshold_sweep")
def gbt_threshold_sweep(spark, sf_dir):
    _, sc, _, _ = _fitted(spark, sf_dir, "label_4h", "gbt")
    return M.threshold_sweep(sc, "y", "y_prob")


@register("horizon_pick")
def horizon_pick(spark, sf_dir):
    rows = None
    for i, lab in enumerate(LABEL_COLS):
        _, sc, n_train, spw = _fitted(spark, sf_dir, lab, "gbt")
        r = EV.model_metrics(spark, "gbt", lab, sc, n_train, spw).withColumn("_order", F.lit(i))
        rows = r if rows is None else rows.unionByName(r)
    return EV.mark_best_horizon(rows)


@register("model_comparison")
def model_comparison(spark, sf_dir):
    train, test = _splits(spark, sf_dir)
    base = EV.baseline_rows(spark, train, test, "label_4h", ["event_id"])
    rows = base
    # both at the same time: the boosted trees follow each other in small jobs and leave cores idle
    fitted = EV.in_parallel(spark, {fam: (lambda fam=fam: _fitted(spark, sf_dir, "label_4h", fam))
                                    for fam in ("gbt", "rf")}, 2)
    for fam, (_, sc, n_train, spw) in fitted.items():
        rows = rows.unionByName(EV.model_metrics(spark, fam, "label_4h", sc, n_train, spw))
    return EV.comparison(rows, ["dummy_most_frequent", "dummy_stratified", "heuristic_critical_1h"])


@register("gbt_error_analysis")
def gbt_error_analysis(spark, sf_dir):
    _, sc, _, _ = _fitted(spark, sf_dir, "label_4h", "gbt")
    s = sc.withColumn("y_pred", M.predict("y_prob", M.REPORT_THRESHOLD))
    return M.fn_slices(s)


@register("feature_importance")
def feature_importance(spark, sf_dir):
    model, _, _, _ = _fitted(spark, sf_dir, "label_4h", "gbt")
    return ml.feature_importances(spark, model, FEATURE_COLS)


@register("permutation_importance")
def permutation_importance(spark, sf_dir):
    model, _, _, _ = _fitted(spark, sf_dir, "label_4h", "gbt")
    _, test = _splits(spark, sf_dir)
    test = test.select("event_id", *FEATURE_COLS, F.col("label_4h").cast("int").alias("y")).checkpoint()
    return ml.permutation_importance(lambda d: ml.score(model, d), test, FEATURE_COLS, "y", "event_id")


# --- diagnostics, previews, sampling, ordered split ------------------------------------------------

@register("raw_diagnostics", O.with_ctes(O.TELEMETRY_CTE, body="""
select count(*) filter (where regexp_matches(Criticidade, 'N.{1,2}o Cr.{1,2}tico')) as criticidade_pattern_rows,
  count(*) filter (where Classe = 'NULL') as classe_null_rows,
  count(*) filter (where Classe = 'NULL' and _source_month = 'jan') as classe_null_first_month,
  count(*) filter (where contains(Valor, ',')) as valor_comma_rows
from telemetry"""))
def raw_diagnostics(spark, sf_dir):
    return Q.raw_diagnostics(_tele(spark, sf_dir))


@register("clean_preview", O.with_ctes(O.TELEMETRY_CTE, O.CLEAN_CTE, body="""
select event_id, TAG, Alarme, Criticidade, Valor, Classe, ts_us from clean
order by TAG, ts_us, event_id limit 5"""))
def clean_preview(spark, sf_dir):
    """head(5) of the cleaned table with an explicit order (a top-k)."""
    return (_clean(spark, sf_dir).select("event_id", "TAG", "Alarme", "Criticidade", "Valor", "Classe", "ts_us")
            .orderBy("TAG", "ts_us", "event_id").limit(5))


_SAMPLE_ROWS = 2_000


@register("rule_flags_sample", O.with_ctes(*_RULE_CTES, body=f"""
select * from flags order by {_DRAW}, event_id limit {_SAMPLE_ROWS}"""))
def rule_flags_sample(spark, sf_dir):
    """2,000 rows of the rule output drawn by a seeded hash (rules run on
    every row first, so the sample does not thin the window counts)."""
    return S.fixed_size_sample(_rule_flags(spark, sf_dir), _SAMPLE_ROWS, ["event_id"],
                               n_rows=_tele(spark, sf_dir).count())


@register("sequential_split_counts", O.with_ctes(O.TELEMETRY_CTE, body="""
select count(*) filter (where rn <= cut) as train_rows, count(*) filter (where rn > cut) as test_rows,
  max(ts_us) filter (where rn <= cut) as train_max_us, min(ts_us) filter (where rn > cut) as test_min_us
from (select ts_us, row_number() over (order by ts_us, event_id) as rn,
             cast(floor(count(*) over () * 0.8) as bigint) as cut from telemetry where ts_us is not null)"""))
def sequential_split_counts(spark, sf_dir):
    """The ordered 80/20 split (the fall-back when a cut leaves no test rows)."""
    t = _tele(spark, sf_dir).where(F.col("ts_us").isNotNull()).select("event_id", "ts_us")
    cut = int(t.count() * S.FALLBACK_TRAIN_SHARE)
    rn = S.global_row_number(t, "ts_us", "event_id")
    tr = F.col("row_number") <= F.lit(cut)
    return rn.agg(F.count_if(tr).alias("train_rows"), F.count_if(~tr).alias("test_rows"),
                  F.max(F.when(tr, F.col("ts_us"))).alias("train_max_us"),
                  F.min(F.when(~tr, F.col("ts_us"))).alias("test_min_us"))


def _row_ties_sql() -> str:
    lb = {"alarm_count_15m": 15, "alarm_count_30m": 30, "alarm_count_1h": 60, "alarm_count_2h": 120,
          "alarm_count_4h": 240}
    rows_frame = "over (partition by TAG order by ts_us, event_id rows between unbounded preceding and current row)"
    cols = []
    for name, mins in lb.items():
        cols.append(f"cast(count(*) {rows_frame} - coalesce(count(*) over (partition by TAG order by ts_us "
                    f"range between unbounded preceding and {mins * 60_000_000} preceding), 0) as integer) as {name}")
    crit = "case when Id_Criticidade=1 then 1 else 0 end"
    cols.append(f"cast(sum({crit}) {rows_frame} - coalesce(sum({crit}) over (partition by TAG order by ts_us "
                f"range between unbounded preceding and 3600000000 preceding), 0) as integer) as critical_alarm_count_1h")
    cols.append("coalesce(cast(ts_us - max(case when Id_Criticidade=1 then ts_us end) " + rows_frame +
                " as double) / cast(60000000 as double), cast(240.0 as double)) as time_since_last_critical")
    return O.with_ctes(O.TELEMETRY_CTE, _TIES_CTE, body=f"""
select event_id, TAG, ts_us, {', '.join(cols)} from telemetry_v where TAG is not null""")


@register("feature_matrix_row_ties", _row_ties_sql())
def feature_matrix_row_ties(spark, sf_dir):
    """Look-back features on hour-truncated instants with ``ties="row"``:
    tied rows count 1, 2, 3 in (instant, event_id) order."""
    cols = list(LOOKBACK_COLS) + ["critical_alarm_count_1h", "time_since_last_critical"]
    f = build_features(A.telemetry_ties(spark, sf_dir), None, keep=["event_id"], ties="row",
                       include=set(cols))
    return f.select("event_id", "TAG", "ts_us", *cols)


@register("quality_report", O.with_ctes(O.TELEMETRY_CTE, body="""
select *, concat_ws(chr(10),
    'Telemetry rows: ' || cast(n_rows as varchar),
    '  Criticidade encoding fixed: ' || cast(criticidade_fixed as varchar),
    '  NULL string -> null (Classe): ' || cast(null_string_fixed as varchar),
    '  NULL string -> null (Valor): ' || cast(valor_null_fixed as varchar),
    '  Decimal separator fixed: ' || cast(decimal_fixed as varchar)) as summary
from (select """ + _QC_SQL + r""",
  count(*) filter (where replace(case when Valor = 'NULL' then null else Valor end, ',', '.') is not null
     and not regexp_matches(replace(case when Valor = 'NULL' then null else Valor end, ',', '.'),
                            '^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$')) as valor_rejected
from telemetry)"""))
def quality_report(spark, sf_dir):
    """The one-row cleaning report with its text summary (what the text sink writes)."""
    return Q.quality_report(_tele(spark, sf_dir))


_RULE_CTES_HOT = [O.TELEMETRY_CTE, _HOT_CTE.replace("telemetry_v AS", "telemetry_h AS")] + \
    [c.replace("from telemetry t2", "from telemetry_h t2").replace("from telemetry t left", "from telemetry_h t left")
     for c in _RULE_CTES[1:]]


@register("rule_flags_hot", O.with_ctes(*_RULE_CTES_HOT, body="select * from flags"))
def rule_flags_hot(spark, sf_dir):
    """Rule windows when one TAG holds a third of the events."""
    t = A.telemetry_hot(spark, sf_dir).select("event_id", "TAG", "Alarme", "ts_us", "Is_Dont_Go")
    return R.apply_rules(t, A.rules(spark))
