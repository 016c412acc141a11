"""Cleaning, quality counters and validators.

All counters come from one aggregation pass (``count_if`` over before/after
expressions); cleaning is a pure projection and never drops rows or touches
``Is_Dont_Go``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.cleaning import (criticidade_changed, decimal_rejected, has_decimal_comma,
                                          is_null_literal, null_literal, parse_decimal,
                                          repair_criticidade)
from faultline.functions.timecols import US_PER_HOUR, epoch_micros
from faultline.functions.frames import floor_div


def clean_telemetry(df: DataFrame) -> DataFrame:
    """Repair Criticidade encoding, turn "NULL" literals into nulls and parse
    Valor (decimal comma) into a double. Unparsable Valor -> null."""
    return (df.withColumn("Criticidade", repair_criticidade(F.col("Criticidade")))
              .withColumn("Classe", null_literal(F.col("Classe")))
              .withColumn("Valor", parse_decimal(F.col("Valor"))))


def quality_counts(raw: DataFrame) -> DataFrame:
    """One-row report of what ``clean_telemetry`` fixes, from the raw table."""
    return raw.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(criticidade_changed(F.col("Criticidade"))).alias("criticidade_fixed"),
        F.count_if(is_null_literal(F.col("Classe"))).alias("null_string_fixed"),
        F.count_if(is_null_literal(F.col("Valor"))).alias("valor_null_fixed"),
        F.count_if(has_decimal_comma(F.col("Valor"))).alias("decimal_fixed"),
        F.count_if(decimal_rejected(F.col("Valor"))).alias("valor_rejected"),
    )


def raw_diagnostics(raw: DataFrame, month_col: str = "_source_month", first_month: str = "jan") -> DataFrame:
    """Pre-cleaning diagnostic masks: rows whose Criticidade matches the
    corruption pattern, Classe "NULL" overall and in the first month, Valor
    with a decimal comma (null-safe: a null never matches)."""
    from faultline.functions.cleaning import CRITICIDADE_PATTERN
    crit = F.coalesce(F.col("Criticidade").rlike(CRITICIDADE_PATTERN), F.lit(False))
    classe_null = is_null_literal(F.col("Classe"))
    return raw.agg(F.count_if(crit).alias("criticidade_pattern_rows"),
                   F.count_if(classe_null).alias("classe_null_rows"),
                   F.count_if(classe_null & (F.col(month_col) == F.lit(first_month))).alias("classe_null_first_month"),
                   F.count_if(has_decimal_comma(F.col("Valor"))).alias("valor_comma_rows"))


def quality_counts_by_month(raw: DataFrame, month_col: str = "_source_month") -> DataFrame:
    """The same counters per source month."""
    return raw.groupBy(month_col).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(criticidade_changed(F.col("Criticidade"))).alias("criticidade_fixed"),
        F.count_if(is_null_literal(F.col("Classe"))).alias("null_string_fixed"),
        F.count_if(is_null_literal(F.col("Valor"))).alias("valor_null_fixed"),
        F.count_if(has_decimal_comma(F.col("Valor"))).alias("decimal_fixed"),
    )


def post_clean_checks(clean: DataFrame) -> DataFrame:
    """Counts that must all be zero after cleaning, plus the row count:
    corruption marker '?' in Criticidade, "NULL" left in Classe or Valor,
    and whether Valor is a double."""
    valor_is_double = clean.schema["Valor"].dataType.typeName() == "double"
    return clean.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.coalesce(F.col("Criticidade").contains("?"), F.lit(False))).alias("criticidade_marker"),
        F.count_if(is_null_literal(F.col("Classe"))).alias("classe_null_literal"),
        F.count_if(is_null_literal(F.col("Valor"))).alias("valor_null_literal"),
        F.lit(valor_is_double).alias("valor_is_double"),
    )


def assert_clean(clean: DataFrame, expected_rows: int | None = None) -> None:
    """Raise AssertionError if the post-clean checks fail (one Spark job)."""
    r = post_clean_checks(clean).first()
    assert r["criticidade_marker"] == 0, "corruption marker left in Criticidade"
    assert r["classe_null_literal"] == 0, "NULL literal left in Classe"
    assert r["valor_null_literal"] == 0, "NULL literal left in Valor"
    assert r["valor_is_double"], "Valor is not double"
    if expected_rows is not None:
        assert r["n_rows"] == expected_rows, "cleaning changed the row count"


def inverted_intervals(intervals: DataFrame) -> DataFrame:
    """Intervals whose start is after their end."""
    s = F.col("inicio_us") if "inicio_us" in intervals.columns else epoch_micros(intervals, "Inicio")
    e = F.col("fim_us") if "fim_us" in intervals.columns else epoch_micros(intervals, "Fim")
    return intervals.agg(F.count(F.lit(1)).alias("n_intervals"),
                         F.count_if(F.coalesce(s > e, F.lit(False))).alias("inicio_after_fim"))


def tag_mismatch(tele: DataFrame, intervals: DataFrame, tele_key: str = "TAG",
                 interval_key: str = "Tag") -> DataFrame:
    """Telemetry TAGs that never appear in the interval table (one row each)."""
    t = tele.select(F.col(tele_key).alias("TAG")).where(F.col("TAG").isNotNull()).distinct()
    i = intervals.select(F.col(interval_key).alias("TAG")).where(F.col("TAG").isNotNull()).distinct()
    return t.join(i, "TAG", "left_anti")


def duplicate_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows beyond the first copy of each distinct row. Only a 128-bit digest
    of the row is shuffled, and hot duplicates are combined before that."""
    cols = cols or df.columns
    # every value with its length (a null has none), so no two rows spell alike
    spelled = F.concat(*[F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"),
                                             F.col(c).cast("string")), F.lit("-")) for c in cols])
    g = df.groupBy(F.unhex(F.md5(spelled)).alias("_row")).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"),
                 F.count(F.lit(1)).alias("distinct_rows"))


def timestamp_gaps(df: DataFrame, u: str = "ts_us", month_col: str = "_source_month",
                   unit_us: int = US_PER_HOUR) -> DataFrame:
    """Runs of empty time units (hours by default) between observed ones, over
    the whole time line, so a gap across a month boundary is one gap: month (of
    the last unit before it), gap_start_us, gap_end_us (exclusive), missing.

    The data is first reduced to distinct units by a partial aggregate; the
    ordered step runs on one row per unit of the time span (8,766 a year)."""
    units = (df.where(F.col(u).isNotNull()).groupBy(floor_div(F.col(u), unit_us).alias("_h"))
             .agg(F.max(month_col).alias(month_col)))
    nxt = F.lead("_h").over(Window.orderBy("_h"))
    return (units.select(month_col, "_h", nxt.alias("_next"))
                 .where(F.col("_next") - F.col("_h") > 1)
                 .select(month_col,
                         ((F.col("_h") + 1) * F.lit(unit_us)).alias("gap_start_us"),
                         (F.col("_next") * F.lit(unit_us)).alias("gap_end_us"),
                         (F.col("_next") - F.col("_h") - 1).cast("long").alias("missing_units")))


def quality_report(raw: DataFrame) -> DataFrame:
    """One-row cleaning report with a text summary column (the interval
    validation is its own one-row report, ``inverted_intervals``)."""
    rep = quality_counts(raw)
    summary = F.concat_ws("\n",
                          F.concat(F.lit("Telemetry rows: "), F.col("n_rows").cast("string")),
                          F.concat(F.lit("  Criticidade encoding fixed: "), F.col("criticidade_fixed").cast("string")),
                          F.concat(F.lit("  NULL string -> null (Classe): "), F.col("null_string_fixed").cast("string")),
                          F.concat(F.lit("  NULL string -> null (Valor): "), F.col("valor_null_fixed").cast("string")),
                          F.concat(F.lit("  Decimal separator fixed: "), F.col("decimal_fixed").cast("string")))
    return rep.withColumn("summary", summary)


def full_quality_report(raw: DataFrame, intervals: DataFrame, u: str = "ts_us",
                        month_col: str = "_source_month") -> DataFrame:
    """One row: the cleaning counters, TAGs without intervals, duplicate rows,
    gaps in the time line, inverted intervals and a text summary."""
    parts = [quality_counts(raw).select("n_rows", "criticidade_fixed", "null_string_fixed", "valor_null_fixed",
                                        "decimal_fixed", "valor_rejected"),
             tag_mismatch(raw, intervals).agg(F.count(F.lit(1)).alias("tag_mismatches")),
             duplicate_rows(raw).select("duplicate_rows"),
             timestamp_gaps(raw, u, month_col).agg(F.count(F.lit(1)).alias("timestamp_gaps")),
             inverted_intervals(intervals).select(F.col("inicio_after_fim").alias("inverted_intervals"))]
    names = [c for p in parts for c in p.columns]
    one = parts[0]
    for p in parts[1:]:
        one = one.unionByName(p, allowMissingColumns=True)
    one = one.agg(*[F.max(c).alias(c) for c in names])  # one row per part, each column in one of them
    lines = [("Telemetry rows: ", "n_rows"), ("  Criticidade encoding fixed: ", "criticidade_fixed"),
             ("  NULL string -> null (Classe): ", "null_string_fixed"),
             ("  NULL string -> null (Valor): ", "valor_null_fixed"), ("  Decimal separator fixed: ", "decimal_fixed"),
             ("  TAGs without intervals: ", "tag_mismatches"), ("  Duplicate rows: ", "duplicate_rows"),
             ("  Gaps in the time line: ", "timestamp_gaps"), ("  Inverted intervals: ", "inverted_intervals")]
    return one.withColumn("summary", F.concat_ws("\n", *[F.concat(F.lit(t), F.col(c).cast("string"))
                                                         for t, c in lines]))


def tag_gaps(df: DataFrame, key: str = "TAG", u: str = "ts_us", silent_hours: int = 48) -> DataFrame:
    """Per equipment: its sessions (hours with events, cut where ``silent_hours``
    or more pass without any), the gaps between them, the longest one's empty
    hours, and the days on which gaps begin, ascending, as a list.

    Rows are first reduced to distinct (key, hour), so an equipment has at most
    8,784 rows a year however many events; session windows merge these."""
    from faultline.functions.timecols import micros_to_ntz
    hours = (df.where(F.col(key).isNotNull() & F.col(u).isNotNull())
             .select(key, floor_div(F.col(u), US_PER_HOUR).alias("_h")).distinct()
             .withColumn("_t", micros_to_ntz(F.col("_h") * F.lit(US_PER_HOUR)).cast("timestamp")))
    # an hour that begins ``silent_hours`` + 1 after another has that many empty ones between
    sessions = (hours.groupBy(key, F.session_window("_t", f"{silent_hours} hours 1 second"))
                .agg(F.min("_h").alias("_from"), F.max("_h").alias("_to")).select(key, "_from", "_to"))
    nxt = F.lead("_from").over(Window.partitionBy(key).orderBy("_from"))
    gaps = sessions.withColumn("_next", nxt)
    begin = F.date_format(micros_to_ntz((F.col("_to") + 1) * F.lit(US_PER_HOUR)), "yyyy-MM-dd")
    has = F.col("_next").isNotNull()
    return gaps.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_sessions"), F.count_if(has).alias("n_gaps"),
        F.coalesce(F.max(F.when(has, F.col("_next") - F.col("_to") - 1)), F.lit(0)).cast("long").alias("longest_gap_hours"),
        F.array_sort(F.collect_set(F.when(has, begin))).alias("gap_days"))


def report_lists(raw: DataFrame, intervals: DataFrame, u: str = "ts_us", silent_hours: int = 48) -> DataFrame:
    """One row: the TAGs that no interval names and the months (yyyy-MM) in
    which some equipment falls silent, as sorted lists, and the row count. Both
    lists are as long as the fleet or the calendar, not the table."""
    tags = tag_mismatch(raw, intervals).agg(F.array_sort(F.collect_set("TAG")).alias("tag_mismatches"))
    months = (tag_gaps(raw, u=u, silent_hours=silent_hours)
              .select(F.explode("gap_days").alias("_d")).select(F.substring("_d", 1, 7).alias("_m")).distinct()
              .agg(F.array_sort(F.collect_set("_m")).alias("gap_months")))
    rows = raw.agg(F.count(F.lit(1)).alias("n_rows"))
    one = tags.unionByName(months, allowMissingColumns=True).unionByName(rows, allowMissingColumns=True)
    return one.agg(*[F.max(c).alias(c) for c in ("tag_mismatches", "gap_months", "n_rows")])


def clean_and_count(raw: DataFrame, write) -> DataFrame:
    """Clean ``raw``, hand it to ``write`` (a sink) and give the counters of
    ``quality_counts``, observed while the sink runs: the raw files are read once."""
    from pyspark.sql import Observation
    seen = Observation("quality_counts")
    names = ["criticidade_fixed", "null_string_fixed", "valor_null_fixed", "decimal_fixed", "valor_rejected"]
    flags = [criticidade_changed(F.col("Criticidade")), is_null_literal(F.col("Classe")), is_null_literal(F.col("Valor")),
             has_decimal_comma(F.col("Valor")), decimal_rejected(F.col("Valor"))]
    marked = raw.observe(seen, F.count(F.lit(1)).alias("n_rows"), *[F.count_if(f).alias(n) for n, f in zip(names, flags)])
    write(clean_telemetry(marked))
    got = seen.get
    return raw.sparkSession.createDataFrame([tuple(got[n] for n in ("n_rows", *names))],
                                            "n_rows bigint, " + ", ".join(f"{n} bigint" for n in names))
