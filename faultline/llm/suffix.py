"""Suffix-array dedup: bytes of 200-byte strings that start in two places.

1. Every 200-byte window is given an anchor by its content (``anchors``). The
   windows of an anchor share its core, 136 bytes; two equal windows have equal
   cores. Cores are counted over all texts; anchors of single cores leave.
2. The context of an anchor is the bytes of all its windows. Contexts that occur
   twice or more are repeated as a whole.
3. What remains are contexts that occur once but whose core also stands in other
   contexts: the ends of repeated passages. The distinct contexts of a core meet
   in one task, which builds one suffix array over many cores' contexts, each
   core written as one symbol, and finds windows with an equal neighbour.
4. Repeated windows become spans per distinct text, and the texts are cut.

The suffix array is built by grouping suffixes by their longest Lyndon prefix.
Groups of integers are processed in descending order; a member's previous
smaller suffix moves to a group above its own (``lyndon_groups``). Then one sweep
emits each group's order: a suffix in final place puts the suffix one to the
left, and along its previous-smaller pointers those before, in the next place of
their groups. Nothing is renamed, and no prefix is built or sorted.

A core with more than ``MOST_CONTEXTS`` distinct contexts (a passage in very many
documents) would be an unbounded group; its single contexts are cut to windows
instead, which are counted by 128-bit hash in a plain aggregation, exactly.

Defined cases: null and empty texts have no bytes; texts under 200 bytes lose
none; very long texts are read whole; copies and repeated rows repeat each other's strings and lose all their
bytes from 200 on; an empty table gives an empty result; other columns are not
read by the report and kept by the filter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.anchors import CORE, LEAD, LENGTH, Powers, windows_by_anchor
from faultline.llm.common import arrow_schema, slices, stored

EQUAL = LENGTH - CORE + 1       # symbols of a window when its core is one symbol
MOST_CONTEXTS = 4096
BATCH_CONTEXTS = 128           # contexts under one suffix array
MOST_BROADCAST = 4_000_000      # rows of at most 16 bytes


def lyndon_groups(codes: list[int]) -> tuple[list[int], list[tuple[int, int]], list[int]]:
    """(group of each suffix, (group, size) from the greatest down, previous
    smaller suffix of each). Groups begin as the symbols and are processed from the
    greatest down. A member's previous smaller suffix is the nearest to its left
    that is in no group processed so far. Such a suffix's Lyndon prefix swallows
    the member's, so it moves to a group just above its own, higher the more
    members it swallows. Every processed suffix moves one at most, so the groups
    take linear time, but for the nearest-to-the-left search, a path-compressed
    chain."""
    n = len(codes)
    number = {c: g for g, c in enumerate(sorted(set(codes)))}
    group = [number[c] for c in codes]
    members: list[list[int]] = [[] for _ in number]
    for p, g in enumerate(group):
        members[g].append(p)
    below = list(range(-1, len(number) - 1))
    above = list(range(1, len(number) + 1))
    before, jump = [-1] * n, list(range(-1, n - 1))
    done = bytearray(n)
    layout = []
    g = len(number) - 1
    while g >= 0:
        own = [p for p in members[g] if group[p] == g]   # others moved on
        members[g] = []
        for p in own:
            done[p] = 1
        swallowed: dict[int, int] = {}
        for p in own:
            j = p - 1
            while j >= 0 and done[j]:
                j = jump[j]
            q = p
            while q > j and jump[q] != j:
                jump[q], q = j, jump[q]
            before[p] = j
            if j >= 0:
                swallowed[j] = swallowed.get(j, 0) + 1
        by_count: list[list[int]] = [[] for _ in range(max(swallowed.values(), default=0) + 1)]
        for p, k in swallowed.items():
            by_count[k].append(p)
        for k in range(len(by_count) - 1, 0, -1):
            fresh: dict[int, int] = {}
            for p in by_count[k]:
                old = group[p]
                new = fresh.get(old)
                if new is None:
                    new = fresh[old] = len(members)
                    members.append([])
                    below.append(old)
                    above.append(above[old])
                    below[above[old]] = new     # a lower group always has one above
                    above[old] = new
                members[new].append(p)
                group[p] = new
        layout.append((g, len(own)))
        g = below[g]
    return group, layout, before


def suffix_array(text: str) -> list[int]:
    """Order of all suffixes. The last symbol must be the smallest, once."""
    n = len(text)
    group, layout, before = lyndon_groups(list(map(ord, text)))
    place, end = [0] * (max(g for g, _ in layout) + 1), n
    for g, size in layout:
        end -= size
        place[g] = end
    order = [-1] * n
    put = bytearray(n)
    order[0] = n - 1
    put[n - 1] = 1
    for i in range(n):
        s = order[i] - 1
        while s >= 0 and not put[s]:
            at = place[group[s]]
            place[group[s]] = at + 1
            order[at] = s
            put[s] = 1
            s = before[s]
    return order


def joined_text(contexts: list[tuple[int, bytes, bytes]]) -> tuple[str, list[int]]:
    """(text, start of each context) for (core number, bytes before the core,
    bytes after it). Separators are the smallest symbols and fall from left to
    right, so no two are equal, no match runs over one, and no Lyndon word does."""
    m = len(contexts)
    parts, starts, at = [], [], 0
    for k, (core, left, right) in enumerate(contexts):
        part = np.concatenate([np.frombuffer(left, np.uint8).astype(np.uint32) + m, [m + 256 + core],
                               np.frombuffer(right, np.uint8).astype(np.uint32) + m, [m - 1 - k]])
        parts.append(part)
        starts.append(at)
        at += len(part)
    flat = np.concatenate(parts).astype("<u4")
    return flat.tobytes().decode("utf-32-le", "surrogatepass"), starts


def repeated_windows(contexts: list[tuple[int, bytes, bytes]]) -> list[list[int]]:
    """For each context, the windows (from its first) that stand elsewhere too."""
    text, starts = joined_text(contexts)
    owner = np.zeros(len(text), np.int64)
    inner = np.full(len(text), -1, np.int64)
    for k, (at, (_, left, right)) in enumerate(zip(starts, contexts)):
        n = len(left) + 1 + len(right) - EQUAL + 1
        owner[at:at + n] = k
        inner[at:at + n] = np.arange(n)
    owner_of, inner_of = owner.tolist(), inner.tolist()
    found: list[list[int]] = [[] for _ in contexts]
    last, last_at, told = "", -1, True
    for p in suffix_array(text):
        if inner_of[p] < 0:
            continue
        window = text[p:p + EQUAL]
        if window == last:
            if not told:
                found[owner_of[last_at]].append(inner_of[last_at])
                told = True
            found[owner_of[p]].append(inner_of[p])
        else:
            last, last_at, told = window, p, False
    return found


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, k1, k2): a 128-bit key of the text stands for its copies."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), F.col("text")).alias("k2"))


def anchor_rows(texts: DataFrame) -> DataFrame:
    ddl = "k1 bigint, k2 bigint, anchor int, first int, last int, core bigint, context bigint"
    arrow = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for part in slices(batches, 256):
            k1, k2 = (np.asarray(part.column(i)) for i in range(2))
            got = [windows_by_anchor(t.encode(), powers) for t in part.column(2).to_pylist()]
            size = [len(x[0]) for x in got]
            anchor, first, last, core, context = (np.concatenate(x) for x in zip(*got))
            cols = [np.repeat(k1, size), np.repeat(k2, size), anchor, first, last,
                    core.view(np.int64), context.view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(
                [c.astype(np.int32) if f.type == pa.int32() else c for c, f in zip(cols, arrow)], arrow)],
                schema=arrow)

    long = texts.where(F.octet_length("text") >= LENGTH)
    return long.select("k1", "k2", "text").mapInArrow(run, ddl)


def checked(df: DataFrame, rows: int, most: int = MOST_BROADCAST) -> DataFrame:
    """Broadcast only what is known to be small."""
    return F.broadcast(df) if rows <= most else df


def context_bytes(texts: DataFrame, wanted: DataFrame, n_wanted: int) -> DataFrame:
    """(core, single, k1, k2, first, left, right): the bytes of the wanted contexts
    around their cores. Each text is read once, from one of its copies."""
    per_text = wanted.groupBy("k1", "k2").agg(
        F.collect_list(F.struct("core", "single", "anchor", "first", "last")).alias("cut"))
    one = (texts.select("k1", "k2", "doc_id").join(checked(per_text.select("k1", "k2"), n_wanted), ["k1", "k2"], "left_semi")
           .groupBy("k1", "k2").agg(F.min("doc_id").alias("_id")))
    per_text = stored(per_text.join(one, ["k1", "k2"]), "repeat-wanted")
    ddl = "core bigint, single boolean, k1 bigint, k2 bigint, first int, left binary, right binary"
    arrow = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 256):
            rows = []
            for k1, k2, text, cut in zip(*(c.to_pylist() for c in part.columns)):
                data = text.encode()
                rows += [(x["core"], x["single"], k1, k2, x["first"], data[x["first"]:x["anchor"] - LEAD],
                          data[x["anchor"] - LEAD + CORE:x["last"] + LENGTH]) for x in cut]
            cols = list(zip(*rows)) if rows else [[] for _ in arrow]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, arrow)], schema=arrow)

    t = texts.join(checked(per_text, n_wanted), (texts["k1"] == per_text["k1"]) & (texts["k2"] == per_text["k2"])
                   & texts["doc_id"].eqNullSafe(per_text["_id"]))
    return t.select(texts["k1"], texts["k2"], "text", "cut").mapInArrow(run, ddl)


SPAN_DDL = "k1 bigint, k2 bigint, start int, stop int"


def runs(windows: list[int], first: int) -> list[tuple[int, int]]:
    """Byte spans of the windows (sorted), adjacent ones joined."""
    out: list[tuple[int, int]] = []
    for w in sorted(windows):
        a, b = first + w, first + w + LENGTH
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def spans_by_suffixes(contexts: DataFrame) -> DataFrame:
    """Spans of single contexts, from suffix arrays over whole cores."""
    arrow = arrow_schema(SPAN_DDL)

    def solve(held: list[tuple]) -> pa.RecordBatch:
        numbers: dict[int, int] = {}
        rows = []
        text = [(numbers.setdefault(core, len(numbers)), left, right) for core, _, _, _, _, left, right in held]
        for (_, single, k1, k2, first, _, _), found in zip(held, repeated_windows(text)):
            if single:
                rows += [(k1, k2, a, b) for a, b in runs(found, first)]
        cols = list(zip(*rows)) if rows else [[] for _ in arrow]
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, None] = {}
        core = None
        for part in slices(batches):
            for row in zip(*(c.to_pylist() for c in part.columns)):
                if row[0] != core and len(held) >= BATCH_CONTEXTS:
                    yield solve(list(held))
                    held = {}
                core = row[0]
                held[row] = None  # rows that repeat a document are one context
        if held:
            yield solve(list(held))

    return contexts.repartition("core").sortWithinPartitions("core").mapInArrow(run, SPAN_DDL)


def spans_by_windows(contexts: DataFrame) -> DataFrame:
    """Spans of single contexts of crowded cores: every window is counted by
    hash, with a plain aggregation that no core's size can overload."""
    ddl = "w1 bigint, w2 bigint, single boolean, k1 bigint, k2 bigint, start int, stop int"
    arrow = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 256):
            rows = []
            for core, single, k1, k2, first, left, right in zip(*(c.to_pylist() for c in part.columns)):
                data = left + core.to_bytes(8, "little", signed=True) + right
                size = EQUAL + 7
                for w in range(len(data) - size + 1):
                    h = xxhash.xxh3_128_digest(data[w:w + size] + len(left[w:]).to_bytes(2, "little"))
                    rows.append((int.from_bytes(h[:8], "little", signed=True),
                                 int.from_bytes(h[8:], "little", signed=True), single, k1, k2,
                                 first + w, first + w + LENGTH))
            cols = list(zip(*rows)) if rows else [[] for _ in arrow]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, arrow)], schema=arrow)

    windows = contexts.mapInArrow(run, ddl).dropDuplicates(["w1", "w2", "k1", "k2", "start"])
    often = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return windows.where("single").join(often, ["w1", "w2"], "left_semi").select("k1", "k2", "start", "stop")


def merged(spans: Column) -> Column:
    """Sorted spans with those that overlap or touch joined."""
    kind = "array<struct<start:int,stop:int>>"

    def step(acc: Column, s: Column) -> Column:
        joins = s["start"] <= acc["stop"]
        return F.struct(
            F.when(joins, acc["done"]).otherwise(
                F.concat(acc["done"], F.array(F.struct(acc["start"].alias("start"), acc["stop"].alias("stop"))))).alias("done"),
            F.when(joins, acc["start"]).otherwise(s["start"]).alias("start"),
            F.when(joins, F.greatest(acc["stop"], s["stop"])).otherwise(s["stop"]).alias("stop"))

    s = F.array_sort(spans)
    start = F.struct(F.array().cast(kind).alias("done"), s[0]["start"].alias("start"), s[0]["stop"].alias("stop"))
    return F.aggregate(s, start, step, lambda a: F.concat(
        a["done"], F.array(F.struct(a["start"].alias("start"), a["stop"].alias("stop")))))


def repeated_spans(texts: DataFrame, most_contexts: int = MOST_CONTEXTS) -> DataFrame:
    """(k1, k2, spans): the maximal repeated byte spans of each distinct text."""
    anchors = stored(anchor_rows(texts), "repeat-anchors")
    cores = stored(anchors.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("core"),
                   "repeat-cores")
    rows = stored(anchors.join(checked(cores, cores.count()), "core", "left_semi"), "repeat-rows")
    contexts = stored(rows.groupBy("core", "context").agg(
        (F.count(F.lit(1)) == 1).alias("single"),
        F.min(F.struct("k1", "k2", "anchor", "first", "last")).alias("at")), "repeat-contexts")
    alone = contexts.where("single").select("core", "context")
    whole = (rows.join(checked(alone, alone.count(), MOST_BROADCAST // 2), ["core", "context"], "left_anti")
             .select("k1", "k2", F.col("first").alias("start"), (F.col("last") + LENGTH).alias("stop")).distinct())
    mixed = stored(contexts.groupBy("core").agg(F.count(F.lit(1)).alias("n"), F.max("single").alias("any"))
                   .where("n > 1 and any").select("core", "n"), "repeat-mixed")
    wanted = stored(contexts.join(checked(mixed, mixed.count()), "core")
                    .select("core", "single", "at.*", (F.col("n") > most_contexts).alias("crowded")), "repeat-ends")
    cut = stored(context_bytes(texts, wanted, wanted.count()), "repeat-bytes")
    crowded = mixed.where(F.col("n") > most_contexts).select("core")
    n_crowded = crowded.count()
    ends = spans_by_suffixes(cut.join(checked(crowded, n_crowded), "core", "left_anti") if n_crowded else cut)
    if n_crowded:
        ends = ends.unionByName(spans_by_windows(cut.join(checked(crowded, n_crowded), "core", "left_semi")))
    spans = whole.unionByName(ends)
    return spans.groupBy("k1", "k2").agg(merged(F.collect_list(F.struct("start", "stop"))).alias("spans"))


def with_spans(docs: DataFrame, id_col: str, text_col: str, most_contexts: int) -> DataFrame:
    texts = keyed(docs, id_col, text_col)
    spans = stored(repeated_spans(texts, most_contexts), "repeat-spans")
    return texts.join(checked(spans, spans.count()), ["k1", "k2"], "left")


def cut_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               most_contexts: int = MOST_CONTEXTS) -> DataFrame:
    """One row per document: bytes, bytes removed, removed runs, and the digest
    of what remains."""
    ddl = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    arrow = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            cols: list[list] = [part.column(0).to_pylist(), [], [], [], []]
            for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                data, spans, at = text.encode(), spans or [], 0
                digest = hashlib.sha256()
                for s in spans:
                    digest.update(data[at:s["start"]])
                    at = s["stop"]
                digest.update(data[at:])
                cols[1].append(len(data))
                cols[2].append(sum(s["stop"] - s["start"] for s in spans))
                cols[3].append(len(spans))
                cols[4].append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow)

    return with_spans(docs, id_col, text_col, most_contexts).select("doc_id", "text", "spans").mapInArrow(run, ddl)
