"""Alarm rules: de-duplication, per-row rule windows (sweep line) and the
comparison of the derived flag with the registered one.

A rule (EVENTO, QTD, TEMPO) flags an event of alarm EVENTO when at least QTD
events of that alarm and TAG fall in (t - TEMPO min, t]. Window lengths differ
per alarm, and Spark frame bounds are constants, so the count comes from a
sweep line: n events at an instant t emit +n at t and -n at t + TEMPO, and the
running sum at t is the number of events in (t - w, t]. One method serves any
rule table.

Scale. The sweep runs over distinct (TAG, Alarme, instant), a partial
aggregate, so a crowded instant is one row. Each emitted row goes to the time
bucket it falls in, and a carry row brings the sum of all earlier buckets, from
a per-(TAG, Alarme, bucket) aggregate: no row is copied to a neighbouring
bucket, so a bucket may be as narrow as a dense pair needs, whatever the rule's
length. Rows meet the flagged instants in a join, which Spark broadcasts when
they are few and splits by size when they are skewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.frames import floor_div
from faultline.functions.timecols import US_PER_DAY, US_PER_MINUTE
from faultline.operators.joins import join_small

TARGET_ROWS = 1_000_000     # sweep rows per (TAG, Alarme, bucket)


def _parsed(rules: DataFrame) -> DataFrame:
    return rules.select(F.col("EVENTO").cast("string").alias("EVENTO"),
                        F.expr("try_cast(QTD as int)").alias("QTD"),
                        F.expr("try_cast(TEMPO as int)").alias("TEMPO"))


def _usable() -> Column:
    return F.col("EVENTO").isNotNull() & F.col("QTD").isNotNull() & (F.coalesce(F.col("TEMPO"), F.lit(0)) > 0)


def dedupe_rules(rules: DataFrame) -> DataFrame:
    """Most restrictive rule per alarm: lowest QTD, then lowest TEMPO. Rules
    without alarm, count or a positive length are rejected first, so a missing
    length never stands before a given one."""
    return (_parsed(rules).where(_usable()).groupBy("EVENTO")
            .agg(F.min(F.struct("QTD", "TEMPO")).alias("r")).select("EVENTO", "r.QTD", "r.TEMPO"))


def rule_rejects(rules: DataFrame) -> DataFrame:
    """One row: rules given, rules rejected (no alarm, no count, no positive
    length) and rules dropped as less restrictive doubles."""
    r = _parsed(rules)
    return r.agg(F.count(F.lit(1)).alias("n_rules"), F.count_if(~_usable()).alias("rejected"),
                 (F.count_if(_usable()) - F.count_distinct(F.when(_usable(), F.col("EVENTO")))).alias("doubles"))


def bucket_width(tele: DataFrame, keys: list[str], u: str, target_rows: int = TARGET_ROWS) -> int:
    """A bucket width that gives the densest key about ``target_rows`` rows a
    bucket: one aggregation over (key, day); one number reaches the driver."""
    per_day = (tele.where(F.col(u).isNotNull()).groupBy(*keys, floor_div(F.col(u), US_PER_DAY).alias("_d"))
               .agg(F.count(F.lit(1)).alias("_n")))
    peak = per_day.agg(F.max("_n")).first()[0] or 1
    return max(1, min(30 * US_PER_DAY, US_PER_DAY * target_rows // peak))


def _swept(rows: DataFrame, keys: list[str], bucket_us: int) -> DataFrame:
    """``rows`` (keys, _t, _d, ...) with their bucket, plus one carry row per
    bucket: the sum of ``_d`` over all earlier buckets of the key, placed just
    before the bucket."""
    b = rows.withColumn("_bk", floor_div(F.col("_t"), bucket_us))
    w = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    carry = (b.groupBy(*keys, "_bk").agg(F.sum("_d").cast("long").alias("_total"))
             .select(*keys, "_bk", F.coalesce(F.sum("_total").over(w), F.lit(0)).cast("long").alias("_d"))
             .withColumn("_t", F.col("_bk") * F.lit(int(bucket_us)) - F.lit(1)))
    return b.unionByName(carry, allowMissingColumns=True)


def _flagged(at: DataFrame, rules: DataFrame, width: int, max_rules: int, ties: str = "range",
             carried: list[str] = ()) -> DataFrame:
    """The instants ``at`` (TAG, Alarme, _t, _n, ``carried``) at which their rule's
    count is reached, by the sweep line."""
    r = dedupe_rules(rules).select(F.col("EVENTO").alias("_ev"), F.col("QTD").alias("_qty"),
                                   (F.col("TEMPO").cast("long") * F.lit(US_PER_MINUTE)).alias("_w"))
    ruled = join_small(at, r, F.col("Alarme") == F.col("_ev"), "inner", max_rows=max_rules).drop("_ev")
    keys = ["TAG", "Alarme"]
    both = ruled.withColumn("_arrive", F.explode(F.array(F.lit(True), F.lit(False))))
    sweep = both.select(*keys, F.when(F.col("_arrive"), F.col("_t")).otherwise(F.col("_t") + F.col("_w")).alias("_t"),
                        F.when(F.col("_arrive"), F.col("_n")).otherwise(-F.col("_n")).alias("_d"),
                        "_qty", "_arrive", *[c for c in ("_tb",) if ties == "row"], *carried)
    sweep = _swept(sweep, keys, width)
    part = Window.partitionBy(*keys, "_bk")
    if ties == "row":
        # expiries (-1) stand before arrivals (+1) of the same instant
        running = F.sum("_d").over(part.orderBy("_t", "_d", "_tb").rowsBetween(Window.unboundedPreceding, 0))
    else:
        running = F.sum("_d").over(part.orderBy("_t").rangeBetween(Window.unboundedPreceding, 0))
    return (sweep.withColumn("_run", running)
            .where(F.coalesce(F.col("_arrive"), F.lit(False)) & (F.col("_run") >= F.col("_qty"))))


def apply_rules(tele: DataFrame, rules: DataFrame, *, u: str = "ts_us",
                flag: str = "Is_Dont_Go_derived", bucket_us: int | None = None,
                max_rules: int = 100_000, ties: str = "range",
                tiebreak: str | None = None) -> DataFrame:
    """Every input row plus ``flag`` (0/1, never null). Rows without TAG,
    alarm, instant or usable rule get 0. The rule table is broadcast only after
    its row count is checked against ``max_rules``.

    ``bucket_us``: width of the time buckets; by default from the density of
    the densest TAG (``bucket_width``). The result does not depend on it.

    ``ties``: "range" counts every event at the same instant (order-free);
    "row" counts tied events in (instant, ``tiebreak``) order, 1, 2, 3."""
    if ties not in ("range", "row"):
        raise ValueError("ties must be 'range' or 'row'")
    if ties == "row" and tiebreak is None:
        raise ValueError("ties='row' needs a tiebreak column")
    width = int(bucket_us or bucket_width(tele, ["TAG"], u))
    t = tele.where(F.col("TAG").isNotNull() & F.col(u).isNotNull())
    at = t.select("TAG", "Alarme", F.col(u).cast("long").alias("_t"), *([F.col(tiebreak).alias("_tb")] if ties == "row" else []))
    if ties == "range":
        at = at.groupBy("TAG", "Alarme", "_t").agg(F.count(F.lit(1)).alias("_n"))
    else:
        at = at.withColumn("_n", F.lit(1).cast("long"))
    flagged = _flagged(at, rules, width, max_rules, ties)
    on = (F.col("TAG") == F.col("_k1")) & (F.col("Alarme") == F.col("_k2")) & (F.col(u).cast("long") == F.col("_k3"))
    named = [F.col("TAG").alias("_k1"), F.col("Alarme").alias("_k2"), F.col("_t").alias("_k3")]
    if ties == "row":
        named.append(F.col("_tb").alias("_k4"))
        on = on & F.col(tiebreak).eqNullSafe(F.col("_k4"))
    found = flagged.select(*named, F.lit(1).alias("_hit"))
    if ties == "row":
        found = found.distinct()  # equal (instant, tiebreak) rows are one position
    return (tele.join(found, on, "left")
            .select(*tele.columns, F.coalesce(F.col("_hit"), F.lit(0)).cast("int").alias(flag)))


def compare_signals(df: DataFrame, actual: str = "Is_Dont_Go",
                    derived: str = "Is_Dont_Go_derived") -> DataFrame:
    """tp, fp, fn, tn, precision, recall of the derived flag (one pass)."""
    from faultline.operators.metrics import confusion_counts, with_rates
    return with_rates(confusion_counts(df, actual, derived)).select(
        F.col("tp").alias("true_positives"), F.col("fp").alias("false_positives"),
        F.col("fn").alias("false_negatives"), F.col("tn").alias("true_negatives"),
        "precision", "recall")


def flag_confusion(tele: DataFrame, rules: DataFrame, *, u: str = "ts_us", actual: str = "Is_Dont_Go",
                   bucket_us: int | None = None, max_rules: int = 100_000) -> DataFrame:
    """``compare_signals`` of the derived flag without deriving it for every row:
    the sweep's instants carry their counts of actual 1 and 0, so flagged
    instants give the hits, and one total gives the rest. Rows are not joined."""
    from faultline.operators.metrics import _is, with_rates
    width = int(bucket_us or bucket_width(tele, ["TAG"], u))
    at = (tele.where(F.col("TAG").isNotNull() & F.col(u).isNotNull())
          .groupBy("TAG", "Alarme", F.col(u).cast("long").alias("_t"))
          .agg(F.count(F.lit(1)).alias("_n"), F.count_if(_is(actual, 1)).alias("_yes"),
               F.count_if(_is(actual, 0)).alias("_no")))
    zero = F.lit(0).cast("long")
    hits = _flagged(at, rules, width, max_rules, carried=["_yes", "_no"]).agg(
        F.sum("_yes").alias("tp"), F.sum("_no").alias("fp"), zero.alias("pos"), zero.alias("neg"))
    all_rows = tele.agg(zero.alias("tp"), zero.alias("fp"), F.count_if(_is(actual, 1)).alias("pos"),
                        F.count_if(_is(actual, 0)).alias("neg"))
    one = hits.unionByName(all_rows).agg(*[F.sum(F.coalesce(F.col(c), zero)).alias(c) for c in ("tp", "fp", "pos", "neg")])
    return with_rates(one.withColumns({"fn": F.col("pos") - F.col("tp"), "tn": F.col("neg") - F.col("fp")})).select(
        F.col("tp").alias("true_positives"), F.col("fp").alias("false_positives"),
        F.col("fn").alias("false_negatives"), F.col("tn").alias("true_negatives"), "precision", "recall")
