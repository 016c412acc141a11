"""Places of rows within ordered groups, without a window over a group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faultline.llm.common import stored


def places(df: DataFrame, group: str, order: list[str], name: str,
           more: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``df`` with pos (from 0, by ``order``, nulls first) and n (rows) within
    each value of ``group``, null being one; stored.

    Range partitions on (group, order) cut large groups, and a running number
    cuts equal rows. A row's place is its place in its partition plus its
    group's rows in the partitions before, from a table of one row per
    (partition, group). ``more`` may add columns to that table (_part, group,
    n), which every row of the group gets."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [group, *order, "_seq"]
    tagged = stored(df.withColumn("_seq", F.monotonically_increasing_id())
                    .repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_seq")
                    .withColumn("_tag", F.monotonically_increasing_id()), f"{name}-sorted")
    tagged = tagged.withColumn("_part", F.shiftright("_tag", 33))
    spans = stored(tagged.groupBy("_part", group).agg(F.min("_tag").alias("_first"), F.count(F.lit(1)).alias("_rows")),
                   f"{name}-spans")
    # a group has at most one span in each partition
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = (spans.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
             .withColumn("n", F.sum("_rows").over(Window.partitionBy(group))))
    if more:
        spans = more(spans)
    added = [c for c in spans.columns if c not in ("_part", group, "_first", "_rows", "_before")]
    rows = tagged.alias("l").join(spans.alias("r"), (F.col("l._part") == F.col("r._part"))
                                  & F.col(f"l.{group}").eqNullSafe(F.col(f"r.{group}")))
    pos = F.col("_before") + F.col("_tag") - F.col("_first")
    return stored(rows.select(*[F.col(f"l.{c}") for c in df.columns], pos.alias("pos"),
                              *[F.col(f"r.{c}") for c in added]), name)


def numbers(values: DataFrame, column: str, name: str, number: str) -> DataFrame:
    """(column, number): the places from 0 of the distinct ``values``, null
    first; strings bytewise."""
    spark = values.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = stored(values.select(column).distinct().repartitionByRange(parts, column).sortWithinPartitions(column)
               .withColumn("_tag", F.monotonically_increasing_id()), name)
    s = s.withColumn("_p", F.shiftright("_tag", 33))
    # one row per range partition
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    first = (s.groupBy("_p").agg(F.count(F.lit(1)).alias("_rows"), F.min("_tag").alias("_first"))
             .withColumn("_before", F.coalesce(F.sum("_rows").over(w), F.lit(0))))
    return s.join(first, "_p").select(column, (F.col("_before") + F.col("_tag") - F.col("_first")).alias(number))


def running(df: DataFrame, group: str, order: str, block: int, totals: dict[str, Callable[[Column], Column]],
            combine: Callable[[Column, Column], Column], falling: bool = False) -> DataFrame:
    """``df`` with, in place of each column of ``totals`` (column: aggregate),
    its running total along ``order`` within ``group`` (from the end where
    ``falling``). Windows run over ``block`` places of a group and, once, over
    the blocks' totals, so a long group is cut."""
    df = df.withColumn("_block", F.expr(f"{order} div {block}"))
    way = F.desc if falling else F.asc
    before = Window.partitionBy(group).orderBy(way("_block")).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(group, "_block").orderBy(way(order)).rowsBetween(Window.unboundedPreceding, 0)
    blocks = df.groupBy(group, "_block").agg(*[f(F.col(c)).alias(c) for c, f in totals.items()])
    blocks = blocks.select(group, "_block", *[F.coalesce(f(F.col(c)).over(before), F.lit(0)).alias(f"_{c}")
                                              for c, f in totals.items()])
    rows = df.select("*", *[f(F.col(c)).over(upto).alias(f"_own_{c}") for c, f in totals.items()])
    rows = rows.join(blocks, [group, "_block"])
    return rows.select(*[combine(F.col(f"_{c}"), F.col(f"_own_{c}")).alias(c) if c in totals else F.col(c)
                         for c in df.columns if c != "_block"])
