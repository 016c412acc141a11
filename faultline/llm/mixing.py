"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words; a document of the source is taken
``rate`` = target / source size times on average. The whole part of the rate
is certain; the fractional parts are rounded dependently, so that the words a
source takes meet its target instead of scattering around it. The pivotal step
takes two documents with fractional probabilities and moves expected words from
one to the other, in a random direction weighed so that no probability changes
on average, until one probability is 0 or 1. The expected words of the pair do
not change, so a chain of such steps leaves one fractional document.

The chain is a reduction tree: the documents of a source are dealt into chunks
of about ``CHUNK`` by a hash, each chunk is reduced to one residual document,
and the residuals of ``CHUNK`` chunks are combined at the next level, so a
source that holds most of the rows is spread over all tasks and no task gets
more than a few hundred documents. The last residual of a source is decided by
one draw: a source misses its target by less than one document.

All draws are hashes of the seed and the documents' keys: reruns agree.

Defined cases: a null or empty text has size 0 and is taken as its rate says,
which adds no words; a source without words has target 0; a null source is a
source, the last one; rows that repeat a document share one key, are rounded
as one unit and split its copies evenly; very long texts count with all their words; an empty table gives
an empty result; other columns are kept by ``mixed`` and not read by the report.
Everything is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
CHUNK = 64
UNIT = "struct<size:bigint,p:double,doc_id:bigint,rows:bigint,whole:bigint>"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """(source, source_size, target, rate) from rows (source, size).

    Sources in code-point order, null last, weigh ``weights`` in turn and share
    ``share`` times all words. A target stops at ``most`` times its source's
    words; what is cut goes to the others by weight until none is above, i.e.
    target = min(most * size, level * weight) with the level at which the
    targets add up. The windows are over one row per source."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    by = (by.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)),
                                               (turn + 1).cast("int")))
          .withColumn("cap", most * F.col("source_size")))
    full = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = ((share * F.sum("source_size").over(everything)
              - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(everything)
                - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # the first source, by cap per weight, that the level does not fill sets the
    # level; the quotient only falls after it
    by = by.withColumn("own", level)
    by = by.withColumn("level", F.max(F.when(F.col("own") * F.col("weight") <= F.col("cap"),
                                             F.col("own"))).over(everything))
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return by.select("source", "source_size", target.alias("target"),
                     F.when(F.col("source_size") > 0, target / F.col("source_size"))
                     .otherwise(0.0).alias("rate"))


def draw(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the keys only."""
    return F.xxhash64(F.lit(seed), *keys).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def pivotal(units: Column, seed: int) -> Column:
    """Reduce an array of fractional units (UNIT) to
    struct(left: the one that is still fractional, done: array of (unit, extra))."""
    done_type = f"array<struct<unit:{UNIT},extra:bigint>>"

    def moved(unit: Column, p: Column) -> Column:
        return F.struct(unit["size"].alias("size"), p.alias("p"), unit["doc_id"].alias("doc_id"),
                        unit["rows"].alias("rows"), unit["whole"].alias("whole"))

    def settled(unit: Column, extra: int) -> Column:
        return F.struct(unit.alias("unit"), F.lit(extra).cast("bigint").alias("extra"))

    def step(acc: Column, b: Column) -> Column:
        a = acc["left"]
        in_a, free_a = a["p"] * a["size"], (1 - a["p"]) * a["size"]
        in_b, free_b = b["p"] * b["size"], (1 - b["p"]) * b["size"]
        return let(F.struct(F.least(free_a, in_b).alias("up"), F.least(in_a, free_b).alias("down")),
                   lambda m: decide(acc, a, b, m))

    def decide(acc: Column, a: Column, b: Column, m: Column) -> Column:
        # words move to a with probability down / (up + down), else to b
        free_a, in_a = (1 - a["p"]) * a["size"], a["p"] * a["size"]
        to_a = (draw(seed, a["doc_id"], a["size"], b["doc_id"], b["size"]) * (m["up"] + m["down"])
                < m["down"])
        keep = lambda left, out: F.struct(left.alias("left"),
                                          F.concat(acc["done"], F.array(out)).alias("done"))
        return (F.when(to_a & (m["up"] >= free_a),
                       keep(moved(b, b["p"] - m["up"] / b["size"]), settled(a, 1)))
                .when(to_a, keep(moved(a, a["p"] + m["up"] / a["size"]), settled(b, 0)))
                .when(m["down"] >= in_a,
                      keep(moved(b, b["p"] + m["down"] / b["size"]), settled(a, 0)))
                .otherwise(keep(moved(a, a["p"] - m["down"] / a["size"]), settled(b, 1))))

    start = F.struct(units[0].alias("left"), F.array().cast(done_type).alias("done"))
    return F.aggregate(F.slice(units, 2, F.greatest(F.size(units) - 1, F.lit(0))), start, step)


def mix(sizes: DataFrame, targets: DataFrame, seed: int = 11, chunk: int = CHUNK) -> DataFrame:
    """(source, doc_id, size, rows, taken_copies, source_size, target): one row
    per distinct (source, doc_id, size) of ``sizes``; ``taken_copies`` are the
    copies that its ``rows`` rows take together."""
    spark = sizes.sparkSession
    t = targets.select(F.col("source").alias("_s"), "source_size", "target", "rate")
    units = (sizes.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("rows"))
             .join(t, F.col("source").eqNullSafe(F.col("_s")))
             .withColumn("mean", F.col("rows") * F.col("rate"))
             .withColumn("whole", F.floor("mean").cast("bigint"))
             .withColumn("p", F.col("mean") - F.col("whole")))
    units = stored(units.select("source", "doc_id", "size", "rows", "whole", "p"), "mix-units")
    loose = (F.col("p") > 0) & (F.col("size") > 0)
    counts = units.where(loose).groupBy("source").agg(
        F.ceil(F.count(F.lit(1)) / chunk).cast("bigint").alias("chunks"))
    most = counts.agg(F.max("chunks")).first()[0] or 0
    c = counts.select(F.col("source").alias("_s"), "chunks")
    unit = F.struct("size", "p", "doc_id", "rows", "whole").cast(UNIT)
    todo = (units.where(loose).join(c, F.col("source").eqNullSafe(F.col("_s")))
            .select("source", F.pmod(F.xxhash64("doc_id", "size"), F.col("chunks")).alias("chunk"),
                    unit.alias("unit")))
    # a unit without words needs no partner: its own draw decides
    free = (units.where(~loose)
            .select("source", "doc_id", "size", "rows",
                    (F.col("whole") + (draw(seed, F.col("doc_id"), F.col("source")) < F.col("p"))
                     .cast("bigint")).alias("taken_copies")))
    settled, level = [free], 0
    while most > 0:
        # larger documents first: what stays fractional to the end tends to be small
        order = F.sort_array(F.collect_list("unit"), asc=False)
        got = stored(todo.groupBy("source", "chunk")
                     .agg(pivotal(order, seed + level).alias("got")), f"mix-level{level}")
        settled.append(got.select("source", F.explode("got.done").alias("d"))
                       .select("source", F.col("d.unit.doc_id"), F.col("d.unit.size"), F.col("d.unit.rows"),
                               (F.col("d.unit.whole") + F.col("d.extra")).alias("taken_copies")))
        todo = got.select("source", F.floor(F.col("chunk") / chunk).cast("bigint").alias("chunk"),
                          F.col("got.left").alias("unit"))
        if most == 1:
            extra = (draw(seed - 1, F.col("unit.doc_id"), F.col("unit.size")) < F.col("unit.p")).cast("bigint")
            settled.append(todo.select("source", F.col("unit.doc_id"), F.col("unit.size"), F.col("unit.rows"),
                                       (F.col("unit.whole") + extra).alias("taken_copies")))
        most = 0 if most == 1 else -(-most // chunk)
        level += 1
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return (out.join(t, F.col("source").eqNullSafe(F.col("_s")))
            .select("source", "doc_id", "size", "rows", "taken_copies", "source_size", "target"))


def sized(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
          text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).alias("source"),
                       n_words(F.col(text_col).cast("string")).alias("size"))


def mix_report(docs: DataFrame, seed: int = 11) -> DataFrame:
    """One row per document: size, source size, target, copies and words taken."""
    sizes = stored(sized(docs), "mix-sizes")
    got = mix(sizes, source_targets(sizes), seed)
    row = got.withColumn("k", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows"))))
    copies = F.floor(F.col("taken_copies") / F.col("rows")) + (
        F.col("k") <= F.col("taken_copies") % F.col("rows")).cast("bigint")
    return row.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"),
                      (copies * F.col("size")).cast("bigint").alias("taken"),
                      copies.cast("bigint").alias("copies"))


def mixed(docs: DataFrame, seed: int = 11) -> DataFrame:
    """The documents as the mix takes them: a row stands as often as it is
    taken, not at all for none. All columns stay."""
    sizes = stored(sized(docs), "mix-sizes")
    got = mix(sizes, source_targets(sizes), seed).select(
        *(F.col(c).alias(f"_fl_{c}") for c in ("source", "doc_id", "size", "rows", "taken_copies")))
    key = [F.col("doc_id").cast("bigint").eqNullSafe(F.col("_fl_doc_id")),
           F.col("source").eqNullSafe(F.col("_fl_source")),
           n_words(F.col("text").cast("string")) == F.col("_fl_size")]
    both = docs.join(got, key[0] & key[1] & key[2])
    single = both.where("_fl_rows = 1").withColumn("_fl_n", F.col("_fl_taken_copies"))
    # rows that repeat a key split its copies evenly
    w = Window.partitionBy("_fl_doc_id", "_fl_source", "_fl_size").orderBy(F.xxhash64("text"))
    shared = (both.where("_fl_rows > 1").withColumn("_fl_k", F.row_number().over(w))
              .withColumn("_fl_n", F.floor(F.col("_fl_taken_copies") / F.col("_fl_rows"))
                          + (F.col("_fl_k") <= F.col("_fl_taken_copies") % F.col("_fl_rows")).cast("bigint"))
              .drop("_fl_k"))
    return (single.unionByName(shared).where("_fl_n > 0")
            .withColumn("_fl_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_fl_n").cast("bigint"))))
            .select(*docs.columns))
