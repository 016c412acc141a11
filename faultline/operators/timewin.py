"""Half-open time-range windows per key, for skewed keys.

Spark's ``Window.partitionBy(key)`` puts every row of a key into one task, so
one hot key (a third of the data, say) would make one task do a third of the
work. Here every key is split into time buckets of ``bucket_us`` and the
window runs per (key, bucket):

* bounded frames (look-back counts over (t-d, t], look-ahead flags over
  (t, t+h]) see their neighbours through *halo* copies: each row is copied into
  the adjacent buckets whose frames can reach it, and only the copy in its
  home bucket produces output;
* unbounded look-backs (time since the last flagged row, as-of interval
  state, the key's first value) get a *carry-in* row per bucket: a tiny
  per-(key, bucket) aggregate, rolled over the buckets of the key, and placed
  in front of the bucket's rows.

Halo copies need buckets at least as wide as the longest frame. Where a key is
so dense that such a bucket would still be too large for a task, or an instant
holds very many rows, ``timewin_sweep`` takes over: it reduces rows to distinct
instants and needs no copies, so its buckets may be as narrow as wanted. With
``bucket_us=None`` the width follows from the densest key's rows per day.

The result is one exchange on (key, bucket), one sort, one window operator.
All frames are growing frames (unbounded preceding .. offset) so each is O(n)
per partition; ranges come from differences of two of them.

Tie semantics: by default rows with the same instant are peers (RANGE
frames, order-free and reproducible). ``ties="row"`` counts tied rows in
(instant, tiebreak) order instead: 1, 2, 3 for three equal instants.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions.frames import floor_div, upto
from faultline.functions.timecols import US_PER_DAY, elapsed_minutes
from faultline.operators.timewin_sweep import windowed_sweep

DEFAULT_BUCKET_US = US_PER_DAY
TARGET_ROWS = 2_000_000

_EVENT, _INTERVAL, _CARRY = 0, 1, 2


@dataclass
class WindowSpecs:
    """What to compute for every event row.

    lookback:  name -> (indicator column or None for "every row", span_us):
               number of rows of the key with instant in (t - span, t]
    forward:   name -> (indicator column, span_us): 1 iff a flagged row of the
               key exists in (t, t + span]
    since:     name -> (indicator column, default): minutes since the last
               flagged row at or before t, ``default`` if there is none
    first:     name -> column: the value on the key's first row
    states:    interval DataFrame with columns key..., ``_start``, ``_end``,
               ``_value`` -> name ``state_name``: value of the interval with
               the greatest start <= t, if t <= its end; else ``state_default``
    """
    lookback: dict = field(default_factory=dict)
    forward: dict = field(default_factory=dict)
    since: dict = field(default_factory=dict)
    first: dict = field(default_factory=dict)
    states: DataFrame | None = None
    state_name: str = "state"
    state_default: str | None = None


def windowed(ev: DataFrame, keys: list[str], u: str, specs: WindowSpecs, *,
             keep: list[str] = (), tiebreak: list[str] = (),
             bucket_us: int | None = DEFAULT_BUCKET_US, ties: str = "range",
             target_rows: int = TARGET_ROWS) -> DataFrame:
    """Compute ``specs`` for every row of ``ev`` with non-null keys and instant.

    ``u`` is a long column of epoch microseconds. Output: keys, ``u``, ``keep``
    columns and one column per spec entry. ``bucket_us=None``: the width comes
    from the data, about ``target_rows`` rows per (key, bucket) of the densest
    key; below the longest frame, the sweep without halo copies takes over
    (range ties; row ties keep the frame's width). Results are the same.
    """
    if ties not in ("range", "row"):
        raise ValueError("ties must be 'range' or 'row'")
    keys = list(keys)
    if bucket_us is None:
        longest = max([s for _, s in [*specs.lookback.values(), *specs.forward.values()]], default=1)
        width = suggest_bucket_us(ev, keys, u, 1, target_rows)
        if width < longest and ties == "range":
            return windowed_sweep(ev, keys, u, specs, keep=keep, tiebreak=tiebreak, bucket_us=width)
        bucket_us = max(width, longest)
    B = int(bucket_us)
    keep = [c for c in keep if c not in keys and c != u]
    tiebreak = list(tiebreak)
    passthrough = list(dict.fromkeys(keep + [c for c in tiebreak if c not in keys and c != u]))

    valid = F.lit(True)
    for k in keys + [u]:
        valid = valid & F.col(k).isNotNull()
    base = ev.where(valid)

    ind_cols, names, seen = [], {}, {}

    def ind(c: Column | None) -> str:
        """One 0/1 column per distinct indicator expression, so equal growing
        frames (e.g. G(1, 0) shared by all look-back counts) run once."""
        expr = F.lit(1) if c is None else F.coalesce(c.cast("boolean"), F.lit(False)).cast("int")
        text = str(expr)
        if text not in seen:
            seen[text] = f"_i{len(ind_cols)}"
            ind_cols.append(expr.alias(seen[text]))
        return seen[text]

    for n, (c, span) in specs.lookback.items():
        names[n] = (ind(c), int(span))
    for n, (c, span) in specs.forward.items():
        names[n] = (ind(c), int(span))
    since_cols = {}
    for i, (n, (c, _default)) in enumerate(specs.since.items()):
        since_cols[n] = f"_s{i}"
    first_cols = {n: f"_f{i}" for i, n in enumerate(specs.first)}

    back = max([s for _, s in specs.lookback.values()], default=0)
    fwd = max([s for _, s in specs.forward.values()], default=0)

    uc = F.col(u).cast("long")
    ev_sel = [F.col(k) for k in keys] + [uc.alias("_u")] + [F.col(c) for c in passthrough] + ind_cols
    for n, (c, _d) in specs.since.items():
        ev_sel.append(F.when(F.coalesce(c.cast("boolean"), F.lit(False)), uc).alias(since_cols[n]))
    first_ord = _order_key(base, uc, tiebreak) if specs.first else None
    for n, c in specs.first.items():
        ev_sel.append(c.alias(first_cols[n]))
    if first_ord is not None:
        ev_sel.append(first_ord.alias("_ford"))
    rows = base.select(*ev_sel)

    # --- halo copies: every bucket whose bounded frames can reach the row ----
    lo = floor_div(F.col("_u") - F.lit(fwd), B)
    hi = floor_div(F.col("_u") + F.lit(back), B)
    home = floor_div(F.col("_u"), B)
    stream = (rows.withColumn("_home_bk", home)
                  .withColumn("_bk", F.explode(F.sequence(lo, hi)))
                  .withColumn("_home", F.col("_bk") == F.col("_home_bk"))
                  .drop("_home_bk")
                  .withColumn("_kind", F.lit(_EVENT)))
    # first-row values only reach the output through the carry rows
    for c in first_cols.values():
        stream = stream.withColumn(c, F.lit(None).cast(rows.schema[c].dataType))
    if first_ord is not None:
        stream = stream.drop("_ford")

    st_type = None
    need_carry = bool(specs.since or specs.first or specs.states is not None)
    if specs.states is not None:
        iv = specs.states
        ivalid = F.lit(True)
        for k in keys + ["_start"]:
            ivalid = ivalid & F.col(k).isNotNull()
        iv = iv.where(ivalid).select(*[F.col(k) for k in keys],
                                     F.col("_start").cast("long").alias("_u"),
                                     F.struct(F.col("_start").cast("long").alias("start"),
                                              F.col("_end").cast("long").alias("end"),
                                              F.col("_value").alias("value")).alias("_st"))
        st_type = iv.schema["_st"].dataType
        stream = stream.withColumn("_st", F.lit(None).cast(st_type))
        iv_rows = iv.withColumn("_bk", floor_div(F.col("_u"), B)).withColumn("_kind", F.lit(_INTERVAL)) \
                    .withColumn("_home", F.lit(False))
        stream = stream.unionByName(iv_rows, allowMissingColumns=True)

    if need_carry:
        carry = _carry_rows(rows, keys, B, since_cols, first_cols,
                            iv if specs.states is not None else None, st_type)
        stream = stream.unionByName(carry, allowMissingColumns=True)

    # zero-fill indicators on interval / carry rows
    for icol in seen.values():
        stream = stream.withColumn(icol, F.coalesce(F.col(icol), F.lit(0)))

    w = Window.partitionBy(*[F.col(k) for k in keys], F.col("_bk")).orderBy(F.col("_u"))
    wr = (Window.partitionBy(*[F.col(k) for k in keys], F.col("_bk"))
          .orderBy(F.col("_u"), F.col("_kind"), *[F.col(c) for c in tiebreak])
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))

    out = [F.col(k) for k in keys] + [F.col("_u").alias(u)] + [F.col(c) for c in keep]
    for n, (c, span) in specs.lookback.items():
        icol = names[n][0]
        if ties == "row":
            cur = F.coalesce(F.sum(icol).over(wr), F.lit(0))
        else:
            cur = upto(w, F.col(icol), 0)
        out.append((cur - upto(w, F.col(icol), -span)).cast("int").alias(n))
    for n, (c, span) in specs.forward.items():
        icol = names[n][0]
        out.append(((upto(w, F.col(icol), span) - upto(w, F.col(icol), 0)) > 0).cast("int").alias(n))
    for n, (c, default) in specs.since.items():
        frame = wr if ties == "row" else w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
        last = F.max(since_cols[n]).over(frame)
        out.append(F.coalesce(elapsed_minutes(F.col("_u"), last), F.lit(float(default))).alias(n))
    for n in specs.first:
        out.append(F.max(first_cols[n]).over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))
                   .alias(n))
    if specs.states is not None:
        st = F.col("_st_last")
        val = F.when(F.col("_u") <= st.getField("end"), st.getField("value"))
        if specs.state_default is not None:
            val = F.coalesce(val, F.lit(specs.state_default))
        out.append(val.alias(specs.state_name))

    if specs.states is not None:
        stream = stream.withColumn(
            "_st_last", F.max("_st").over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    return (stream.select(*out, F.col("_kind"), F.col("_home"))
                  .where((F.col("_kind") == _EVENT) & F.col("_home"))
                  .drop("_kind", "_home"))


def _order_key(df: DataFrame, uc: Column, tiebreak: list[str]) -> Column:
    """Total order (instant, tiebreak) as one fixed-width value, so that the
    first-row aggregate stays a hash aggregate. With one integral tiebreak
    the pair is packed into decimal(38,0): (u + 2^60) * 2^64 + (tb + 2^63),
    exact for |u| < 2^60 micros; otherwise a struct (sort-based aggregate)."""
    if not tiebreak:
        return uc
    integral = all(isinstance(df.schema[c].dataType, (T.LongType, T.IntegerType, T.ShortType))
                   for c in tiebreak)
    if len(tiebreak) == 1 and integral:
        d = lambda x: F.lit(str(x)).cast("decimal(38,0)")
        return ((uc.cast("decimal(38,0)") + d(2 ** 60)) * d(2 ** 64)
                + (F.col(tiebreak[0]).cast("decimal(38,0)") + d(2 ** 63)))
    return F.struct(uc, *[F.col(c) for c in tiebreak])


def _carry_rows(rows: DataFrame, keys: list[str], B: int, since_cols: dict, first_cols: dict,
                iv: DataFrame | None, st_type) -> DataFrame:
    """One row per (key, bucket holding events) that summarises everything
    before the bucket (last flagged instants, latest interval) and the key's
    first row. Built from partial aggregates, so its size is the number of
    (key, bucket) pairs, never the number of rows. Event rows only feed
    fixed-width aggregation buffers (hash aggregate); the interval side
    aggregates a struct, which is sort-based but runs on the interval table."""
    aggs = [F.max(c).alias(c) for c in since_cols.values()]
    aggs += [F.min_by(c, "_ford").alias(c) for c in first_cols.values()]
    if first_cols:
        aggs.append(F.min("_ford").alias("_ford"))
    aggs += [F.lit(True).alias("_has_ev")]
    b = rows.groupBy(*keys, floor_div(F.col("_u"), B).alias("_bk")).agg(*aggs)
    if iv is not None:
        # latest interval of every (key, bucket), next to the event buckets
        iv_b = (iv.groupBy(*keys, floor_div(F.col("_u"), B).alias("_bk")).agg(F.max("_st").alias("_st"))
                  .withColumn("_has_ev", F.lit(False)))
        b = b.unionByName(iv_b, allowMissingColumns=True)
    # one window over the (key, bucket) table: an event bucket sorts before
    # the same bucket's intervals, so "prior" holds earlier buckets only
    prior = (Window.partitionBy(*keys).orderBy("_bk", F.col("_has_ev").desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    whole = Window.partitionBy(*keys)
    sel = [F.col(k) for k in keys] + [F.col("_bk"), F.col("_has_ev")]
    sel += [F.max(c).over(prior).alias(c) for c in since_cols.values()]
    sel += [F.min_by(c, "_ford").over(whole).alias(c) for c in first_cols.values()]
    if iv is not None:
        sel.append(F.max("_st").over(prior).alias("_st"))
    c = b.select(*sel).where(F.col("_has_ev")).drop("_has_ev")
    # placed just before the bucket's first home instant
    return (c.withColumn("_u", F.col("_bk") * F.lit(B) - F.lit(1))
             .withColumn("_kind", F.lit(_CARRY)).withColumn("_home", F.lit(False)))


def suggest_bucket_us(ev: DataFrame, keys: list[str], u: str, horizon_us: int,
                      target_rows: int = TARGET_ROWS, day_us: int = US_PER_DAY) -> int:
    """A bucket width from the hottest key's density: about ``target_rows`` rows
    per (key, bucket) task, never below ``horizon_us``, never above 30 days.

    One aggregation job over (key, day) counts; only one number reaches the
    driver."""
    per_day = ev.where(F.col(u).isNotNull()).groupBy(*keys, floor_div(F.col(u), day_us).alias("_d")) \
        .agg(F.count(F.lit(1)).alias("_n"))
    peak = per_day.agg(F.max("_n").alias("m")).first()["m"] or 1
    width = int(day_us * target_rows / peak)
    return int(min(max(width, int(horizon_us)), 30 * day_us))
