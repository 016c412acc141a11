"""DuckDB SQL for the correctness oracle.

Each query repeats the adapter views of ``faultline.sources.adapters`` as
leading CTEs (the checker registers only the base tables). Instants are
bigint epoch microseconds; look-back frames are ``RANGE BETWEEN d-1
PRECEDING AND CURRENT ROW`` on them, look-ahead frames ``RANGE BETWEEN 1
FOLLOWING AND h FOLLOWING``. The SQL is written independently of the Spark
plans (plain full-key windows, ASOF joins, correlated counts).
"""

from __future__ import annotations

TAG_SQL = "concat('EQ', lpad(cast(cast(floor(user_id/5) as bigint) as varchar),4,'0'))"

TELEMETRY_CTE = f"""telemetry AS (
  select event_id,
    {TAG_SQL} as TAG,
    event_type as Alarme,
    cast(case event_type when 'error' then 1 when 'purchase' then 2 when 'signup' then 3 else 4 end as integer) as Id_Criticidade,
    case when event_type='purchase' and event_id%97=0 then 'N??o Crítico'
         when event_type='purchase' and event_id%89=0 then 'Não Cr??tico'
         when event_type='error' then 'Crítico' when event_type='purchase' then 'Não Crítico'
         when event_type='signup' then 'Informacional' else 'Outros' end as Criticidade,
    case when event_id%20=0 then 'NULL'
         when event_id%3=0 then replace(cast(cast(value as decimal(10,2)) as varchar),'.',',')
         else cast(cast(value as decimal(10,2)) as varchar) end as Valor,
    case when event_id%4<>0 then 'NULL' when event_id%8=0 then 'Activate' else 'Inactive' end as Classe,
    cast(case when event_type='error' and value>=60 then 1 else 0 end as integer) as Is_Dont_Go,
    case when cast(floor(user_id/5) as bigint)%2=0 then 'Caminhao' else 'Escavadeira' end as Tipo,
    ts as timestamp,
    epoch_us(ts) as ts_us,
    case when ts<timestamp '2024-01-06' then 'jan' when ts<timestamp '2024-01-11' then 'feb'
         when ts<timestamp '2024-01-16' then 'mar' when ts<timestamp '2024-01-21' then 'abr'
         when ts<timestamp '2024-01-26' then 'may' else 'jun' end as _source_month
  from events)"""

INTERVALS_CTE = f"""intervals AS (
  select {TAG_SQL} as Tag,
    epoch_us(ts) as inicio_us,
    epoch_us(ts) + (case when event_id%50=0 then -3600000000 else cast(floor(value) as bigint)*600000000 end) as fim_us,
    case cast(floor(event_id/7) as bigint)%4 when 0 then 'Operando' when 1 then 'Parado'
         when 2 then 'Hibernando' else 'Manutenção' end as Classe,
    event_id as interval_id
  from events where event_type='signup')"""

RULES_CTE = """rules AS (
  select * from (values ('error',3,720), ('error',2,240), ('error',2,480), ('click',3,360),
                        ('view',4,720), ('purchase',2,120), ('ghost',1,10)) r(EVENTO, QTD, TEMPO))"""

SCORED_CTE = """scored AS (
  select event_id, TAG, ts_us, Tipo, Is_Dont_Go as y,
    (case when Id_Criticidade=1 then cast(0.3 as double) else cast(0 as double) end)
      + cast(event_id % 50 as double) / cast(100 as double) as y_prob
  from telemetry)"""


def _lb(span_us: int, expr: str = "1") -> str:
    return (f"cast(sum({expr}) over (partition by TAG order by ts_us "
            f"range between {span_us - 1} preceding and current row) as integer)")


def _fw(span_us: int, flag: str = "Is_Dont_Go") -> str:
    return (f"case when coalesce(sum({flag}) over (partition by TAG order by ts_us "
            f"range between 1 following and {span_us} following), 0) > 0 then 1 else 0 end")


FEATURES_CTE = f"""feat_base AS (
  select event_id, TAG, ts_us,
    {_lb(15 * 60_000_000)} as alarm_count_15m,
    {_lb(30 * 60_000_000)} as alarm_count_30m,
    {_lb(60 * 60_000_000)} as alarm_count_1h,
    {_lb(120 * 60_000_000)} as alarm_count_2h,
    {_lb(240 * 60_000_000)} as alarm_count_4h,
    {_lb(60 * 60_000_000, "case when Id_Criticidade=1 then 1 else 0 end")} as critical_alarm_count_1h,
    coalesce(cast(ts_us - max(case when Id_Criticidade=1 then ts_us end) over (partition by TAG order by ts_us
             range between unbounded preceding and current row) as double) / cast(60000000 as double),
             cast(240.0 as double)) as time_since_last_critical,
    case when first_value(Tipo) over (partition by TAG order by ts_us, event_id
             rows between unbounded preceding and unbounded following) = 'Caminhao' then 1 else 0 end as tipo_caminhao,
    {_fw(60 * 60_000_000)} as label_1h,
    {_fw(120 * 60_000_000)} as label_2h,
    {_fw(240 * 60_000_000)} as label_4h
  from telemetry where TAG is not null),
features AS (
  select f.*, case when f.ts_us <= i.fim_us then i.Classe else 'Desconhecido' end as current_state
  from feat_base f asof left join intervals i on f.TAG = i.Tag and f.ts_us >= i.inicio_us)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


CLEAN_CTE = r"""clean AS (
  select event_id, TAG, Alarme, Id_Criticidade,
    regexp_replace(Criticidade, 'N.{1,2}o Cr.{1,2}tico', 'Não Crítico', 'g') as Criticidade,
    case when Classe = 'NULL' then null else Classe end as Classe,
    case when regexp_matches(replace(case when Valor = 'NULL' then null else Valor end, ',', '.'),
                             '^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$')
         then try_cast(replace(case when Valor = 'NULL' then null else Valor end, ',', '.') as double) end as Valor,
    Is_Dont_Go, Tipo, timestamp, ts_us, _source_month
  from telemetry)"""

# adapter split: the events span January 2024
ADAPTER_TRAIN_END_US = "epoch_us(timestamp '2024-01-20 23:59:59')"
ADAPTER_TEST_START_US = "epoch_us(timestamp '2024-01-21 00:00:00')"

SCORED_FEATURES_CTE = """scored_features AS (
  select *, label_4h as y,
    (case when critical_alarm_count_1h > 0 then cast(0.3 as double) else cast(0 as double) end)
      + cast(event_id % 50 as double) / cast(100 as double) as y_prob
  from features)"""


def confusion_sql(y: str, pred: str) -> str:
    return (f"count(*) filter (where {y} = 1 and {pred} = 1) as tp, "
            f"count(*) filter (where {y} = 0 and {pred} = 1) as fp, "
            f"count(*) filter (where {y} = 1 and {pred} = 0) as fn, "
            f"count(*) filter (where {y} = 0 and {pred} = 0) as tn")


RATES = ("coalesce(cast(tp as double) / nullif(cast(tp + fp as double), 0), 0.0) as precision, "
         "coalesce(cast(tp as double) / nullif(cast(tp + fn as double), 0), 0.0) as recall, "
         "coalesce(cast(2 * tp as double) / nullif(cast(2 * tp + fp + fn as double), 0), 0.0) as f1")


def ranking_sql(src: str, y: str = "y", score: str = "y_prob") -> str:
    """n_pos, n_neg, auc_roc, auc_pr over a source relation (body only)."""
    return f"""st as (
  select cast({score} as double) as s, count(*) filter (where {y} = 1) as pos,
         count(*) filter (where {y} <> 1) as neg
  from {src} where {score} is not null and {y} is not null group by 1),
cum as (
  select s, pos, neg,
    sum(pos) over (order by s desc rows between unbounded preceding and current row) as cum_pos,
    sum(neg) over (order by s desc rows between unbounded preceding and current row) as cum_neg
  from st),
agg as (
  select coalesce(sum(pos), 0) as n_pos, coalesce(sum(neg), 0) as n_neg,
    sum(cast(neg as double) * (cast(cum_pos - pos as double) + cast(pos as double) * 0.5)) as auc_num,
    sum(case when pos > 0 then cast(pos as double) * (cast(cum_pos as double) / cast(cum_pos + cum_neg as double)) end) as ap_num
  from cum)
select cast(n_pos as bigint) as n_pos, cast(n_neg as bigint) as n_neg,
  case when n_pos > 0 and n_neg > 0 then round(auc_num / (cast(n_pos as double) * cast(n_neg as double)), 6) else 0.0 end as auc_roc,
  case when n_pos > 0 and n_neg > 0 then round(ap_num / cast(n_pos as double), 6) else 0.0 end as auc_pr
from agg"""
