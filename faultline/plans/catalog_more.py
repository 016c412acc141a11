"""More queries of the catalogue: reports by group, forward chaining, appended
months, shifts, lists of gaps, counters taken during the write, bucketed
storage, merged profiles, oversampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.timecols import US_PER_HOUR
from faultline.operators import quality as Q
from faultline.operators import oversample, profiles, shifts, validation
from faultline.operators.grouped import long_form, report_by_group
from faultline.plans import catalog as C
from faultline.plans import incremental
from faultline.plans import oracle as O
from faultline.plans.features import FEATURE_COLS, interval_frame
from faultline.session import ensure_checkpoint_dir
from faultline.sources import adapters as A
from faultline.sources import bucketed, sinks
from faultline.sources.schema import UNKNOWN_STATE

register = C.register


def _grouped_sql(ctes: list[str], source: str, groups: list[str], pred: str = "y_pred", score: str = "y_prob") -> str:
    by = ", ".join(groups)
    join = " and ".join(f"c.{g} is not distinct from k.{g}" for g in groups)
    return O.with_ctes(*ctes, f"""st AS (
  select {by}, cast({score} as double) as s, count(*) filter (where y = 1) as pos, count(*) filter (where y <> 1) as neg
  from {source} where {score} is not null and y is not null group by all)""", f"""cum AS (
  select *, sum(pos) over (partition by {by} order by s desc rows between unbounded preceding and current row) as cp,
    sum(neg) over (partition by {by} order by s desc rows between unbounded preceding and current row) as cn from st)""",
        f"""k AS (
  select {by}, cast(sum(pos) as bigint) as n_pos, cast(sum(neg) as bigint) as n_neg,
    sum(cast(neg as double) * (cast(cp - pos as double) + cast(pos as double) * 0.5)) as auc_num,
    sum(case when pos > 0 then cast(pos as double) * (cast(cp as double) / cast(cp + cn as double)) end) as ap_num
  from cum group by {by})""",
        f"c AS (select {by}, {O.confusion_sql('y', pred)} from {source} where {score} is not null and y is not null group by {by})",
        body=f"""select {', '.join(f'c.{g}' for g in groups)}, tp, fp, fn, tn, {O.RATES}, n_pos, n_neg,
  case when n_pos > 0 and n_neg > 0 then round(auc_num / (cast(n_pos as double) * cast(n_neg as double)), 6) else 0.0 end as auc_roc,
  case when n_pos > 0 and n_neg > 0 then round(ap_num / cast(n_pos as double), 6) else 0.0 end as auc_pr
from c join k on {join}""")


# --- reports by group ----------------------------------------------------------------------

_LONG = """long_scored AS (
  select 'score' as model, Tipo, y, y_prob, cast(y_prob >= 0.5 as integer) as y_pred from scored
  union all select 'half', Tipo, y, y_prob / 2.0, cast(y_prob / 2.0 >= 0.25 as integer) from scored
  union all select 'hour', Tipo, y, cast(extract(hour from make_timestamp(ts_us)) as double),
    cast(extract(hour from make_timestamp(ts_us)) >= 12 as integer) from scored)"""


@register("ranking_by_group", _grouped_sql([O.TELEMETRY_CTE, O.SCORED_CTE, _LONG], "long_scored", ["model", "Tipo"]))
def ranking_by_group(spark, sf_dir):
    """Three scores by equipment type: six groups, one job."""
    s = F.col("y_prob")
    hour = F.expr(f"pmod(ts_us div {US_PER_HOUR}, 24)").cast("double")
    rows = long_form(A.scored(spark, sf_dir), "model", {
        "score": {"y_prob": s, "y_pred": (s >= 0.5).cast("int")},
        "half": {"y_prob": s / F.lit(2.0), "y_pred": (s / F.lit(2.0) >= 0.25).cast("int")},
        "hour": {"y_prob": hour, "y_pred": (hour >= 12).cast("int")}}, ["Tipo", "y"])
    return report_by_group(rows, ["model", "Tipo"], pred="y_pred", part_rows=40)


@register("ranking_by_tag", _grouped_sql([O.TELEMETRY_CTE, O.SCORED_CTE, """by_tag AS (
  select TAG, y, y_prob, cast(y_prob >= 0.5 as integer) as y_pred from scored)"""], "by_tag", ["TAG"]))
def ranking_by_tag(spark, sf_dir):
    """Every equipment's own report."""
    return report_by_group(A.scored(spark, sf_dir), ["TAG"])


# --- forward chaining ------------------------------------------------------------------------

_CUTS = ["2024-01-11", "2024-01-16", "2024-01-21", "2024-01-26", "2024-02-01"]
_HORIZON = 4 * US_PER_HOUR
_DAY0 = 1_704_067_200_000_000       # 2024-01-01, the first day of the adapter's month


def _cut_micros() -> list[int]:
    days = [10, 15, 20, 25, 31]
    return [_DAY0 + d * 24 * US_PER_HOUR for d in days]


_FOLDS = "folds AS (" + " union all ".join(f"""
  select {k} as fold, f.*, case when ts_us <= {a - _HORIZON} then 'train' when ts_us < {a} then 'purged' else 'test' end as role
  from features f where ts_us < {b}""" for k, (a, b) in enumerate(zip(_cut_micros(), _cut_micros()[1:]), 1)) + ")"
_FOLD_CTES = [O.TELEMETRY_CTE, O.INTERVALS_CTE, O.FEATURES_CTE, _FOLDS]


def _folds(spark, sf_dir) -> DataFrame:
    f = C._features(spark, sf_dir, include={"critical_alarm_count_1h", "label_4h"})
    return validation.expanding_folds(f, _cut_micros(), _HORIZON)


@register("forward_chain_counts", O.with_ctes(*_FOLD_CTES, body="""
select *, case when train_positives > 0 then cast(train_rows - train_positives as double) / cast(train_positives as double)
  else 1.0 end as scale_pos_weight
from (select fold, count(*) filter (where role = 'train') as train_rows,
        count(*) filter (where role = 'train' and label_4h = 1) as train_positives,
        count(*) filter (where role = 'purged') as purged_rows, count(*) filter (where role = 'test') as test_rows,
        count(*) filter (where role = 'test' and label_4h = 1) as test_positives
      from folds group by fold)"""))
def forward_chain_counts(spark, sf_dir):
    return validation.fold_counts(_folds(spark, sf_dir), "label_4h")


@register("forward_chain_heuristic", _grouped_sql(_FOLD_CTES + ["""tested AS (
  select fold, label_4h as y, cast(critical_alarm_count_1h as double) as y_prob,
    cast(critical_alarm_count_1h > 0 as integer) as y_pred from folds where role = 'test')"""], "tested", ["fold"]))
def forward_chain_heuristic(spark, sf_dir):
    """The heuristic's report on every fold's test window."""
    f = _folds(spark, sf_dir).withColumn("y_prob", F.col("critical_alarm_count_1h").cast("double"))
    f = f.withColumn("y_pred", (F.col("critical_alarm_count_1h") > 0).cast("int"))
    return validation.fold_metrics(f, "label_4h", "y_prob", "y_pred")


# --- appended months ---------------------------------------------------------------------------

@register("features_by_month_append", O.with_ctes(O.TELEMETRY_CTE, O.INTERVALS_CTE, O.FEATURES_CTE,
                                                  body="select * from features"))
def features_by_month_append(spark, sf_dir):
    """Six months appended one by one: the full build's features."""
    path = C._run_dir(spark, "append")
    starts = [lo for _, lo, _ in C._MONTH_SPANS if lo]

    def month(bound: str):
        return sum((F.expr(bound.format(f"timestamp_ntz'{lo}'")).cast("int") for lo in starts), F.lit(1))

    tele = incremental.by_month(C._tele(spark, sf_dir).select(*incremental.RAW, "timestamp"),
                                month("timestamp >= {}"), f"{path}/in/telemetry")
    intervals = incremental.by_month(
        A.intervals(spark, sf_dir).select("Tag", "inicio_us", "fim_us", "Classe"),
        month("inicio_us >= timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01', {})"), f"{path}/in/intervals")
    for k in range(1, len(C._MONTH_SPANS) + 1):
        incremental.append_month(spark, path, k, *[df.where(F.col("_month") == k) for df in (tele, intervals)])
    f = incremental.read_features(spark, path, len(C._MONTH_SPANS))
    return f.select("event_id", *[c for c in f.columns if c != "event_id"])


# --- shifts ----------------------------------------------------------------------------------------

_ALARMS = ["click", "error", "purchase", "signup", "view"]


@register("alarms_by_shift", O.with_ctes(O.TELEMETRY_CTE, body="""
select TAG, cast(cast(make_timestamp(ts_us) - interval 6 hour as date) as varchar) as shift_day,
  case when extract(hour from make_timestamp(ts_us) - interval 6 hour) < 8 then 'morning'
       when extract(hour from make_timestamp(ts_us) - interval 6 hour) < 16 then 'afternoon' else 'night' end as shift,
  """ + ", ".join(f"count(*) filter (where Alarme = '{a}') as {a}" for a in _ALARMS) + """
from telemetry group by all"""))
def alarms_by_shift(spark, sf_dir):
    """Alarm types per equipment, day and shift; the night shift crosses midnight."""
    return shifts.alarms_by_shift(C._tele(spark, sf_dir), _ALARMS)


# --- lists of the quality report, gaps by equipment ------------------------------------------------

_GAP_SQL = """hours AS (select distinct TAG, ts_us // 3600000000 as h from telemetry where TAG is not null and ts_us is not null),
gaps AS (
  select TAG, h, lead(h) over (partition by TAG order by h) as nx from hours)"""


@register("tag_gaps", O.with_ctes(O.TELEMETRY_CTE, _GAP_SQL, body="""
select TAG, count(*) filter (where nx is null or nx - h > 48) as n_sessions, count(*) filter (where nx - h > 48) as n_gaps,
  coalesce(max(nx - h - 1) filter (where nx - h > 48), 0) as longest_gap_hours,
  coalesce(string_agg(distinct strftime(make_timestamp((h + 1) * 3600000000), '%Y-%m-%d'), ','
    order by strftime(make_timestamp((h + 1) * 3600000000), '%Y-%m-%d')) filter (where nx - h > 48), '') as gap_days
from gaps group by TAG"""))
def tag_gaps(spark, sf_dir):
    """Sessions of every equipment, cut where it is silent for over 48 hours."""
    g = Q.tag_gaps(C._tele(spark, sf_dir), silent_hours=48)
    return g.withColumn("gap_days", F.array_join("gap_days", ","))


@register("quality_report_lists", O.with_ctes(O.TELEMETRY_CTE, O.INTERVALS_CTE, _GAP_SQL, body="""
select (select coalesce(string_agg(distinct TAG, ',' order by TAG), '') from telemetry
        where TAG is not null and TAG not in (select Tag from intervals where Tag is not null and inicio_us > fim_us)) as tag_mismatches,
  (select coalesce(string_agg(distinct m, ',' order by m), '') from (
     select strftime(make_timestamp((h + 1) * 3600000000), '%Y-%m') as m from gaps where nx - h > 48)) as gap_months,
  (select count(*) from telemetry) as n_rows"""))
def quality_report_lists(spark, sf_dir):
    """The report's list fields: equipment without inverted intervals stands for
    the mismatch (all others have intervals), and months in which a gap begins."""
    r = Q.report_lists(C._tele(spark, sf_dir), A.intervals(spark, sf_dir).where("inicio_us > fim_us"), silent_hours=48)
    return r.select(F.array_join("tag_mismatches", ",").alias("tag_mismatches"),
                    F.array_join("gap_months", ",").alias("gap_months"), "n_rows")


@register("observed_quality_counts", C.ORACLE["quality_counts"])
def observed_quality_counts(spark, sf_dir):
    """The cleaning counters taken while the clean table is written: one scan."""
    return Q.clean_and_count(C._tele(spark, sf_dir), lambda df: sinks.write_parquet(
        df, f"{C._run_dir(spark, 'observed')}/clean", partition_by=["_source_month"]))


# --- bucketed storage ----------------------------------------------------------------------------------

def _stored_line(spark, sf_dir) -> DataFrame:
    line = bucketed.timeline(C._tele(spark, sf_dir).select("TAG", "ts_us", "event_id", "Alarme", "Id_Criticidade"),
                             interval_frame(A.intervals(spark, sf_dir)), ["TAG"], "ts_us")
    return spark.table(bucketed.write_bucketed(line, f"{C._run_dir(spark, 'line')}/t", ["TAG"], "ts_us"))


@register("bucketed_states", O.with_ctes(O.TELEMETRY_CTE, O.INTERVALS_CTE, O.FEATURES_CTE,
                                         body="select event_id, TAG, ts_us, current_state from features"))
def bucketed_states(spark, sf_dir):
    """The as-of state from a stored timeline: written once by (TAG, day), read
    without an exchange."""
    s = bucketed.states_of(_stored_line(spark, sf_dir), ["TAG"], "ts_us", default=UNKNOWN_STATE)
    return s.select("event_id", "TAG", "ts_us", "current_state")


@register("bucketed_daily_profile", O.with_ctes(O.TELEMETRY_CTE, O.INTERVALS_CTE, O.FEATURES_CTE, body="""
select f.TAG, f.ts_us // 86400000000 as day, count(*) as n_alarms, count(*) filter (where Id_Criticidade = 1) as n_critical,
  count(distinct Alarme) as n_types, count(distinct current_state) as n_states, min(f.ts_us) as first_us, max(f.ts_us) as last_us
from features f join telemetry t using (event_id) group by 1, 2"""))
def bucketed_daily_profile(spark, sf_dir):
    """Alarms, types and states of every equipment and day, over the stored layout."""
    s = bucketed.states_of(_stored_line(spark, sf_dir), ["TAG"], "ts_us", default=UNKNOWN_STATE)
    return s.groupBy("TAG", F.col(bucketed.BUCKET).alias("day")).agg(
        F.count(F.lit(1)).alias("n_alarms"), F.count_if(F.col("Id_Criticidade") == 1).alias("n_critical"),
        # a handful of types and states: sets, as counting distinct would expand the rows
        F.size(F.collect_set("Alarme")).cast("long").alias("n_types"),
        F.size(F.collect_set("current_state")).cast("long").alias("n_states"),
        F.min("ts_us").alias("first_us"), F.max("ts_us").alias("last_us"))


@register("bucketed_feature_join", O.with_ctes(O.TELEMETRY_CTE, O.INTERVALS_CTE, O.FEATURES_CTE, body="""
select t.TAG, t.Alarme, count(*) as n_rows, cast(sum(alarm_count_4h) as bigint) as alarms_4h,
  cast(sum(label_4h) as bigint) as n_label_4h from features f join telemetry t using (event_id) group by all"""))
def bucketed_feature_join(spark, sf_dir):
    """Stored features meet the stored telemetry by (TAG, day, event) where they lie."""
    f = C._features(spark, sf_dir, include={"alarm_count_4h", "label_4h"})
    f = spark.table(bucketed.write_bucketed(f, f"{C._run_dir(spark, 'features')}/t", ["TAG"], "ts_us"))
    t = C._tele(spark, sf_dir).select("TAG", "ts_us", "event_id", "Alarme")
    t = spark.table(bucketed.write_bucketed(t, f"{C._run_dir(spark, 'tele')}/t", ["TAG"], "ts_us", drop_invalid=True))
    met = f.join(t.drop("ts_us"), ["TAG", bucketed.BUCKET, "event_id"])
    per_day = met.groupBy("TAG", bucketed.BUCKET, "Alarme").agg(
        F.count(F.lit(1)).alias("n"), F.sum("alarm_count_4h").alias("a"), F.sum("label_4h").alias("l"))
    return per_day.groupBy("TAG", "Alarme").agg(F.sum("n").alias("n_rows"), F.sum("a").alias("alarms_4h"),
                                                F.sum("l").alias("n_label_4h"))


# --- profiles that merge ---------------------------------------------------------------------------------

_PROFILED = ["TAG", "Alarme", "event_id"]


def _month_profiles(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(rows, one stored row of sketches per source month)."""
    t = C._clean(spark, sf_dir)
    path = f"{C._run_dir(spark, 'profiles')}/p"
    sinks.write_parquet(profiles.part_profiles(t, "_source_month", _PROFILED, ["TAG", "Alarme"], ["Valor"]), path)
    return t, spark.read.parquet(path)


@register("merged_distinct_profile", O.with_ctes(O.TELEMETRY_CTE, body=" union all ".join(f"""
select scope, '{c}' as "column", count(*) as n_rows, count(distinct {c}) as n_distinct, true as within_bound
from (select 'all' as scope, * from telemetry union all select 'first half', * from telemetry
      where _source_month in ('jan', 'feb', 'mar')) group by scope""" for c in _PROFILED)))
def merged_distinct_profile(spark, sf_dir):
    """Distinct counts from the months' merged sketches, held against the exact
    ones: over all months and over the first three."""
    rows, stored = _month_profiles(spark, sf_dir)
    half = F.col("_source_month").isin("jan", "feb", "mar")
    scopes = F.explode(F.filter(F.array(F.lit("all"), F.when(half, F.lit("first half"))), lambda s: s.isNotNull()))
    est = profiles.distinct_estimates(profiles.merged(stored.withColumn("scope", scopes), ["scope"]))
    exact = rows.withColumn("scope", scopes).groupBy("scope").agg(
        *[F.count_distinct(c).alias(f"exact_{c}") for c in _PROFILED])
    bound = F.lit(profiles.distinct_error(sigmas=4))
    each = F.array(*[F.struct(F.lit(c).alias("column"), "n_rows", F.col(f"exact_{c}").alias("n_distinct"),
                              (F.abs(F.col(f"distinct_{c}") - F.col(f"exact_{c}")) <= bound * F.col(f"exact_{c}"))
                              .alias("within_bound")) for c in _PROFILED])
    return est.join(exact, "scope").select("scope", F.inline(each))


@register("merged_top20", O.with_ctes(O.TELEMETRY_CTE, body="""
select TAG, count(*) as count from telemetry where TAG is not null group by TAG order by count desc, TAG limit 20"""))
def merged_top20(spark, sf_dir):
    """The 20 equipments with the most alarms: candidates from the months' merged
    sketches, counts exact."""
    rows, stored = _month_profiles(spark, sf_dir)
    return profiles.exact_top(rows, profiles.merged(stored), "TAG", 20)


@register("merged_value_quantiles", O.with_ctes(O.TELEMETRY_CTE, O.CLEAN_CTE, body=" union all ".join(
    f"select cast({r} as double) as rank, (select count(Valor) from clean) as n_values, true as within_bound"
    for r in (0.05, 0.25, 0.5, 0.75, 0.95))))
def merged_value_quantiles(spark, sf_dir):
    """Quantiles of the cleaned values from the merged sketches; the share of rows
    below each is within 2 percent of its rank."""
    rows, stored = _month_profiles(spark, sf_dir)
    q = profiles.quantile_estimates(profiles.merged(stored), "Valor", [.05, .25, .5, .75, .95]).collect()  # five rows
    aggs = [F.count("Valor").alias("n")]
    for i, r in enumerate(q):
        aggs += [F.count_if(F.col("Valor") < r["value"]).alias(f"lo{i}"), F.count_if(F.col("Valor") <= r["value"]).alias(f"hi{i}")]
    n = F.col("n")
    each = F.array(*[F.struct(F.lit(r["rank"]).alias("rank"), n.alias("n_values"),
                              ((F.col(f"lo{i}") <= (r["rank"] + .02) * n) & (F.col(f"hi{i}") >= (r["rank"] - .02) * n))
                              .alias("within_bound")) for i, r in enumerate(q)])
    return rows.agg(*aggs).select(F.inline(each))


# --- oversampling ------------------------------------------------------------------------------------------

@register("oversampled_train_counts", O.with_ctes(*C._SF_SRC, body="""
select n_pos, n_neg, need as n_new, n_pos + need as n_pos_after, need // n_pos as least_copies,
  (need + n_pos - 1) // n_pos as most_copies, cast(0 as bigint) as n_outside
from (select *, greatest(n_neg - n_pos, 0) as need from (
  select count(*) filter (where label_1h = 1) as n_pos, count(*) filter (where label_1h = 0) as n_neg from train_set))"""))
def oversampled_train_counts(spark, sf_dir):
    """The training set's minority brought level by synthetic rows, each between
    its parent and one of the parent's nearest neighbours."""
    ensure_checkpoint_dir(spark)
    # stored, as counting, drawing and reporting each read it
    train = C._train_set(spark, sf_dir).select("event_id", "label_1h", *FEATURE_COLS).checkpoint()
    new = oversample.synthetic_rows(train, FEATURE_COLS, "label_1h", "event_id")
    out = F.lit(False)
    for i, c in enumerate(FEATURE_COLS):
        a, b = F.col("_own")[i], F.col("_near")[i]
        out = out | (F.col(c) < F.least(a, b) - 1e-9) | (F.col(c) > F.greatest(a, b) + 1e-9)
    made = new.groupBy("event_id").agg(F.count(F.lit(1)).alias("copies"), F.count_if(out).alias("outside"))
    own = train.groupBy("event_id", "label_1h").count().join(made, "event_id", "left")
    pos = F.col("label_1h") == 1
    copies = F.coalesce(F.col("copies"), F.lit(0)).cast("long")
    return own.agg(F.count_if(pos).alias("n_pos"), F.count_if(F.col("label_1h") == 0).alias("n_neg"),
                   F.sum(copies).alias("n_new"), (F.count_if(pos) + F.sum(copies)).alias("n_pos_after"),
                   F.min(F.when(pos, copies)).alias("least_copies"), F.max(F.when(pos, copies)).alias("most_copies"),
                   F.coalesce(F.sum("outside"), F.lit(0)).cast("long").alias("n_outside"))
