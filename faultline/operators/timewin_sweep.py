"""Time windows of dense keys: the same results as ``timewin.windowed`` without
halo copies, so a time bucket may be narrower than the longest window.

Rows are first reduced to distinct (key, instant), a partial aggregate: a
crowded instant is one row. Each instant then emits, for every window length,
what enters or leaves a window and when: a look-back count over (t - d, t]
gains n at u and loses n at u + d; a look-ahead flag over (t, t + h] gains n at
u - h and loses n at u. Every emitted row belongs to the bucket of its own
time; a carry row per (key, bucket) brings the sums, the last flagged instant
and the latest interval of all earlier buckets. One window per (key, bucket)
gives every instant its values, and the rows meet them in a join on (key,
instant), which Spark splits by size where an instant is crowded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.frames import floor_div
from faultline.functions.timecols import elapsed_minutes


def _flag(c: Column | None) -> Column:
    return F.lit(1) if c is None else F.coalesce(c.cast("boolean"), F.lit(False)).cast("int")


def instants(base: DataFrame, keys: list[str], u: str, specs) -> DataFrame:
    """(keys, _u, one count per look-back / look-ahead, one flag per ``since``)."""
    aggs = [F.sum(_flag(c)).cast("long").alias(f"n_{n}") for n, (c, _) in
            [*specs.lookback.items(), *specs.forward.items()]]
    aggs += [F.max(_flag(c)).alias(f"s_{n}") for n, (c, _) in specs.since.items()]
    return base.groupBy(*keys, F.col(u).cast("long").alias("_u")).agg(F.count(F.lit(1)).alias("_rows"), *aggs)


def emitted(inst: DataFrame, keys: list[str], specs) -> DataFrame:
    """The arrival row of each instant and its expiry and advance rows."""
    names = [*specs.lookback, *specs.forward]
    zero = F.lit(0).cast("long")

    def row(shift: int, delta: dict[str, Column], arrival: bool) -> Column:
        return F.struct((F.col("_u") + F.lit(shift)).alias("t"), F.lit(arrival).alias("arrival"),
                        *[delta.get(n, zero).alias(f"d_{n}") for n in names],
                        *[F.when(F.col(f"s_{n}") == 1, F.col("_u")).alias(f"last_{n}") if arrival
                          else F.lit(None).cast("long").alias(f"last_{n}") for n in specs.since])

    here = {n: F.col(f"n_{n}") for n in specs.lookback} | {n: -F.col(f"n_{n}") for n in specs.forward}
    rows = [row(0, here, True)]
    for span in sorted({s for _, s in specs.lookback.values()}):
        rows.append(row(int(span), {n: -F.col(f"n_{n}") for n, (_, s) in specs.lookback.items() if s == span}, False))
    for span in sorted({s for _, s in specs.forward.values()}):
        own = [n for n, (_, s) in specs.forward.items() if s == span]
        moved = row(-int(span), {n: F.col(f"n_{n}") for n in own}, False)
        some = sum((F.col(f"n_{n}") for n in own), zero) > 0
        rows.append(F.when(some, moved))
    return (inst.select(*keys, F.explode(F.array(*rows)).alias("_r")).where(F.col("_r").isNotNull())
            .select(*keys, "_r.*"))


def windowed_sweep(ev: DataFrame, keys: list[str], u: str, specs, *, keep: list[str] = (),
                   tiebreak: list[str] = (), bucket_us: int) -> DataFrame:
    """``timewin.windowed`` for range ties with buckets of any width."""
    keys, keep = list(keys), [c for c in keep if c not in keys and c != u]
    valid = F.lit(True)
    for k in [*keys, u]:
        valid = valid & F.col(k).isNotNull()
    base = ev.where(valid)
    names = [*specs.lookback, *specs.forward]
    rows = emitted(instants(base, keys, u, specs), keys, specs)
    if specs.states is not None:
        state = F.struct(F.col("_start").cast("long").alias("start"), F.col("_end").cast("long").alias("end"),
                         F.col("_value").alias("value"))
        has = F.col("_start").isNotNull()
        for k in keys:
            has = has & F.col(k).isNotNull()
        opened = specs.states.where(has).select(*keys, F.col("_start").cast("long").alias("t"),
                                                F.lit(False).alias("arrival"), state.alias("state"))
        rows = rows.unionByName(opened, allowMissingColumns=True)
    rows = rows.withColumn("_bk", floor_div(F.col("t"), int(bucket_us)))
    sums = [f"d_{n}" for n in names]
    tops = [f"last_{n}" for n in specs.since] + (["state"] if specs.states is not None else [])
    per = rows.groupBy(*keys, "_bk").agg(*[F.sum(c).cast("long").alias(c) for c in sums],
                                         *[F.max(c).alias(c) for c in tops])
    w = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    carry = per.select(*keys, "_bk", (F.col("_bk") * F.lit(int(bucket_us)) - F.lit(1)).alias("t"),
                       F.lit(False).alias("arrival"), *[F.sum(c).over(w).alias(c) for c in sums],
                       *[F.max(c).over(w).alias(c) for c in tops])
    upto = (Window.partitionBy(*keys, "_bk").orderBy("t")
            .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    run = rows.unionByName(carry).select(
        *keys, "t", "arrival", *[F.coalesce(F.sum(c).over(upto), F.lit(0)).alias(c) for c in sums],
        *[F.max(c).over(upto).alias(c) for c in tops]).where("arrival")
    out = [F.col(f"d_{n}").cast("int").alias(n) for n in specs.lookback]
    out += [(F.col(f"d_{n}") > 0).cast("int").alias(n) for n in specs.forward]
    out += [F.coalesce(elapsed_minutes(F.col("t"), F.col(f"last_{n}")), F.lit(float(default))).alias(n)
            for n, (_, default) in specs.since.items()]
    if specs.states is not None:
        value = F.when(F.col("t") <= F.col("state.end"), F.col("state.value"))
        out.append((F.coalesce(value, F.lit(specs.state_default)) if specs.state_default is not None else value)
                   .alias(specs.state_name))
    values = run.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("t").alias("_t"), *out)
    on = F.col(u).cast("long") == F.col("_t")
    for i, k in enumerate(keys):
        on = on & (F.col(k) == F.col(f"_k{i}"))
    have = base
    if specs.first:
        order = F.struct(F.col(u), *[F.col(c) for c in tiebreak])
        per_key = base.groupBy(*[F.col(k).alias(f"_f{i}") for i, k in enumerate(keys)]).agg(
            *[F.min_by(c, order).alias(f"_first_{n}") for n, c in specs.first.items()])
        key_on = F.lit(True)
        for i, k in enumerate(keys):
            key_on = key_on & (F.col(k) == F.col(f"_f{i}"))
        have = base.join(per_key, key_on)
    final = ([F.col(k) for k in keys] + [F.col(u).cast("long").alias(u)] + [F.col(c) for c in keep]
             + [F.col(n) for n in [*specs.lookback, *specs.forward, *specs.since]]
             + [F.col(f"_first_{n}").alias(n) for n in specs.first]
             + ([F.col(specs.state_name)] if specs.states is not None else []))
    return have.select(*[F.col(c) for c in dict.fromkeys([*keys, u, *keep])],
                       *[F.col(f"_first_{n}") for n in specs.first]).join(values, on).select(*final)
