"""Prefix trie of conversations, packed into double arrays per prefix shard.

Conversations are ordered by turn (null first) and rebuilt: the first h turns
of conversation c - c % 100, then c's own turns after its first h, where h is
crc32 of the decimal id mod 6. Each distinct sequence of first d turns (role,
text) is a node of depth d, whose members are the conversations that start with
it.

A turn is a cell: 128 bits of MD5 and the text's length. Equal sequences are
one row (count, smallest id, digest of their ids). The rows are range-sorted, so
a run of them is a prefix shard: it numbers its turns densely, packs BASE and
CHECK arrays, walks all its sequences through them and sums its subtrees. Only
nodes on the paths of a shard's first and last sequence can occur in other
shards. These upper nodes leave the shard as rows (path, depth, node) with what
hangs below them, are merged by node, and their subtree sums are taken along
the paths: a node counts on the smallest path through it only, and the totals
from the path's end upward meet again by node, so no level needs a round of its
own.

Conversations of more than LONG turns are upper paths as a whole: a shard sees
their first LONG turns, the rest is keyed by running XORs of position-keyed
hashes, in blocks, so one conversation with a third of all turns is cut.

Defined cases. Turns with the same number stand in the order of their cells;
equal turns repeat. A null role or text is empty; rows without a conv_id belong
to no conversation and make no node. ``%`` keeps the sign, so ids from -99 to 99
have conversation 0 as their first. Turnless conversations are members of the
root and end there. Texts are hashed inside the scan, however long, and never
shuffled. An empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import arrow_schema, stored
from faultline.llm.order import places, running

LONG = 256                      # turns of a sequence that one row carries
SHARD = 4096                    # sequences of a prefix shard
CELLS = 1 << 18                 # turns of a prefix shard, about
BLOCK = 1 << 16                 # places of a path that one window runs over
IDS = 4096                      # neighbouring ids joined into one text before they are hashed
CELL = 48                       # hex digits of a turn: MD5, then the text's code points
FREE = -1


class DoubleArray:
    """BASE and CHECK: the child of node s by code c is t = BASE[s] + c where
    CHECK[t] = s. The root is node 0."""

    def __init__(self):
        self.base, self.check, self.low = [0], [-2], 1

    def fits(self, b: int, codes: list[int]) -> bool:
        check = self.check
        return all(b + c >= len(check) or check[b + c] == FREE for c in codes)

    def place(self, node: int, codes: list[int], tries: int = 64) -> list[int]:
        """Give ``node`` children by ascending ``codes``; their nodes. The
        first free places are tried, then the arrays' end."""
        check, slot = self.check, self.low
        for _ in range(tries):
            while slot < len(check) and check[slot] != FREE:
                slot += 1
            if slot >= len(check) or self.fits(slot - codes[0], codes):
                break
            slot += 1
        else:
            slot = len(check)
        b = slot - codes[0]
        more = b + codes[-1] + 1 - len(check)
        if more > 0:
            check.extend([FREE] * more)
            self.base.extend([0] * more)
        self.base[node] = b
        for c in codes:
            check[b + c] = node
        while self.low < len(check) and check[self.low] != FREE:
            self.low += 1
        return [b + c for c in codes]


def packed(codes: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """BASE and CHECK of sorted sequences: sequence i is codes[start[i]:] up to
    length[i]."""
    array = DoubleArray()
    todo = [(0, 0, len(start), 0)]
    while todo:
        node, lo, hi, depth = todo.pop()
        while lo < hi and length[lo] == depth:      # sequences that end here stand first
            lo += 1
        if lo == hi:
            continue
        if hi - lo == 1:                            # a single tail
            for c in codes[start[lo] + depth:start[lo] + length[lo]].tolist():
                node = array.place(node, [c])[0]
            continue
        found, first = np.unique(codes[start[lo:hi] + depth], return_index=True)
        bounds = [*(first + lo).tolist(), hi]
        for k, child in enumerate(array.place(node, found.tolist())):
            todo.append((child, bounds[k], bounds[k + 1], depth + 1))
    return np.array(array.base), np.array(array.check)


SHARD_ROW = ("upper boolean, shard string, path string, key string, parent_key string, conv_id bigint, depth bigint, "
             "parent_conv_id bigint, n_convs bigint, last_len bigint, n_children bigint, n_leaves bigint, "
             "saved_tokens bigint, ends string")


def prefix_keys(seq: str) -> list[str]:
    """The keys of a sequence's nodes from the root on."""
    h = hashlib.md5()
    out = [h.hexdigest()]
    for at in range(0, len(seq), CELL):
        h.update(seq[at:at + CELL].encode())
        out.append(h.hexdigest())
    return out


def shard_rows(seqs: list[str], paths: list[str], counts: list[int], convs: list, ends: list, marked: list[bool]) -> list[tuple]:
    """One prefix shard -> rows of SHARD_ROW: its finished nodes, and per marked
    path its upper nodes with what this shard adds to them."""
    length = np.array([len(s) // CELL for s in seqs], np.int64)
    start = np.cumsum(length) - length
    cells = np.frombuffer("".join(seqs).encode(), f"S{CELL}")
    if len(cells):
        turns, codes = np.unique(cells, return_inverse=True)
        turn_len = np.array([int(t[32:], 16) for t in turns.tolist()], np.int64)
        codes = codes.astype(np.int64) + 1
    else:
        turn_len, codes = np.zeros(0, np.int64), np.zeros(0, np.int64)
    base, check = packed(codes, start, length)
    size = len(check)
    n = np.array(counts, np.int64)
    least = np.array([np.iinfo(np.int64).max if c is None else c for c in convs], np.int64)
    upper_path = np.array(marked, bool)
    upper_path[[0, -1]] = True

    # walk all sequences through the arrays, a turn at a time
    n_convs, conv = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    upper, depth, last = np.zeros(size, bool), np.zeros(size, np.int64), np.zeros(size, np.int64)
    at, walked = np.zeros(len(seqs), np.int64), []
    for d in range(int(length.max(initial=0)) + 1):
        active = np.flatnonzero(length >= d)
        if d:
            code = codes[start[active] + d - 1]
            there = base[at[active]] + code
            if not (check[there] == at[active]).all():
                raise AssertionError("CHECK does not lead back to the parent")
            at[active] = there
            last[there], depth[there] = turn_len[code - 1], d
        here = at[active]
        np.add.at(n_convs, here, n[active])
        np.minimum.at(conv, here, least[active])
        upper[here[upper_path[active]]] = True
        walked.append(np.unique(here))
    kids, final_kids = np.zeros(size, np.int64), np.zeros(size, np.int64)
    below = np.concatenate(walked[1:]) if len(walked) > 1 else np.zeros(0, np.int64)
    np.add.at(kids, check[below], 1)
    np.add.at(final_kids, check[below[~upper[below]]], 1)
    # a finished node has its own share; an upper one only what hangs below it
    leaves = np.where(~upper & (kids == 0), 1, 0)
    saved = np.where(upper, 0, (n_convs - 1) * last)
    for nodes in reversed(walked[1:]):
        done = nodes[~upper[nodes]]
        np.add.at(leaves, check[done], leaves[done])
        np.add.at(saved, check[done], saved[done])
    ended = {int(s): e for s, e in zip(at, ends) if e is not None}

    shard, rows, keys, sent = paths[0], [], {}, set()
    for i in np.flatnonzero(upper_path).tolist():
        node, parent = 0, None
        for d, key in enumerate(prefix_keys(seqs[i])):
            if d:
                node = int(base[node] + codes[start[i] + d - 1])
            keys[node] = key
            if node in sent:
                rows.append((True, shard, paths[i], key, parent, None, d, None, 0, int(last[node]), 0, 0, 0, None))
            else:
                sent.add(node)
                c = int(conv[node])
                rows.append((True, shard, paths[i], key, parent, None if c == np.iinfo(np.int64).max else c, d, None,
                             int(n_convs[node]), int(last[node]), int(final_kids[node]), int(leaves[node]),
                             int(saved[node]), ended.get(node)))
            parent = key
    for node in below[~upper[below]].tolist():
        p = int(check[node])
        rows.append((False, shard, None, None, keys.get(p), int(conv[node]), int(depth[node]),
                     None if upper[p] else int(conv[p]), int(n_convs[node]), int(last[node]), int(kids[node]),
                     int(leaves[node]), int(saved[node]), ended.get(node)))
    return rows


def shards(most: int):
    """Sorted sequences -> SHARD_ROW, a prefix shard at a time."""
    schema = arrow_schema(SHARD_ROW)

    def made(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        out = shard_rows(*map(list, zip(*rows)))
        for k in range(0, len(out), 1 << 15):
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out[k:k + (1 << 15)]), schema)],
                                             schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, cells = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (len(held) >= most or cells >= CELLS):
                    yield from made(held)
                    held, cells = [], 0
                held.append(row)
                cells += len(row[0]) // CELL
        if held:
            yield from made(held)
    return run


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth of the turn from 1, cell) of all rebuilt conversations,
    and (conv_id, length)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    print128 = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    cell = F.concat(print128, F.lower(F.lpad(F.hex(F.length(text).cast("bigint")), 16, "0")))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), cell.alias("cell"))
    turns = places(stored(turns, "trie-cells"), "conv_id", ["turn", "cell"], "trie-turns")
    convs = turns.where("pos = 0").select(
        "conv_id", "n", (F.col("conv_id") - F.col("conv_id") % 100).alias("first"),
        (F.crc32(F.col("conv_id").cast("string")) % 6).alias("h"))
    firsts = turns.where("pos = 0").select(F.col("conv_id").alias("first"), F.col("n").alias("_first_n"))
    taken = F.least("h", F.coalesce("_first_n", F.lit(0)))
    convs = stored(convs.join(firsts, "first", "left").select("conv_id", "first", "n", "h", taken.alias("taken")), "trie-convs")
    own = (turns.select("conv_id", "pos", "cell").join(convs, "conv_id").where("pos >= h")
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken") + 1).alias("depth"), "cell"))
    # at most five turns of a conversation, for the hundred that start with it
    shared = (turns.where("pos < 5").select(F.col("conv_id").alias("first"), "pos", "cell").join(convs, "first")
              .where("pos < h").select("conv_id", (F.col("pos") + 1).alias("depth"), "cell"))
    lengths = convs.select("conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    return stored(own.unionByName(shared), "trie-rebuilt"), lengths


def end_digests(members: DataFrame) -> DataFrame:
    """(sid, ends): SHA-256 of the ids of each sequence's conversations,
    ascending, comma-joined. Neighbouring ids are joined to one text first; the
    texts of a sequence then stream through one hash."""
    schema = arrow_schema("sid string, ends string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h = None, None
        for batch in batches:
            out = []
            for sid, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if sid != now:
                    if now is not None:
                        out.append((now, h.hexdigest()))
                    now, h = sid, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*out)], schema=schema)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([h.hexdigest()])], schema=schema)

    near = members.groupBy("sid", F.expr(f"conv_id div {IDS}").alias("part")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    return (near.repartition("sid").sortWithinPartitions("sid", "part").select("sid", "ids")
            .mapInArrow(run, "sid string, ends string"))


def long_paths(long: DataFrame, turns: DataFrame, most: int) -> DataFrame:
    """Upper rows of sequences with more than ``most`` turns."""
    ddl = "path string, key string, parent_key string, conv_id bigint, depth bigint, n_convs bigint, last_len bigint, ends string"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sid, seq, conv, n in zip(*(c.to_pylist() for c in batch.columns)):
                keys = prefix_keys(seq)
                last = [0] + [int(seq[k + 32:k + CELL], 16) for k in range(0, len(seq), CELL)]
                k = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, f.type) for v, f in zip(
                        ([sid] * k, keys, [None, *keys[:-1]], [conv] * k, range(k), [n] * k, last, [None] * k), schema)],
                    schema=schema)

    head = long.select("sid", "seq", "conv_id", "n_convs").mapInArrow(run, ddl)
    rest = (long.select("conv_id", "sid", "n_convs", "length", "ends", F.md5("seq").alias("head"))
            .join(turns.where(F.col("depth") > most), "conv_id"))
    own = [F.xxhash64("depth", "cell"), F.xxhash64("cell", "depth")]
    rest = rest.select("*", own[0].alias("x1"), own[1].alias("x2"), own[0].alias("own1"), own[1].alias("own2"))
    rest = running(rest, "sid", "depth", BLOCK, {"x1": F.bit_xor, "x2": F.bit_xor}, lambda a, b: a.bitwiseXOR(b))

    def key(depth, x1, x2):
        return F.concat_ws("-", "head", depth, F.hex(x1), F.hex(x2))
    parent = key(F.col("depth") - 1, F.col("x1").bitwiseXOR(F.col("own1")), F.col("x2").bitwiseXOR(F.col("own2")))
    rest = rest.select(
        F.col("sid").alias("path"), key(F.col("depth"), F.col("x1"), F.col("x2")).alias("key"),
        F.when(F.col("depth") == most + 1, F.col("head")).otherwise(parent).alias("parent_key"), "conv_id", "depth", "n_convs",
        F.conv(F.substring("cell", 33, 16), 16, 10).cast("bigint").alias("last_len"),
        F.when(F.col("depth") == F.col("length"), F.col("ends")).alias("ends"))
    return head.unionByName(rest)


def trie(conversations: DataFrame, long: int = LONG, shard: int = SHARD) -> DataFrame:
    """One row per node: conv_id (its smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    turns, lengths = rebuilt_turns(conversations)
    # at most ``long`` turns of a conversation meet in one row
    ordered = F.array_sort(F.collect_list(F.struct("depth", "cell")))
    heads = turns.where(F.col("depth") <= long).groupBy("conv_id").agg(
        F.array_join(F.transform(ordered, lambda x: x["cell"]), "").alias("seq"))
    tails = turns.where(F.col("depth") > long).groupBy("conv_id").agg(
        F.bit_xor(F.xxhash64("depth", "cell")).alias("x1"), F.bit_xor(F.xxhash64("cell", "depth")).alias("x2"))
    whole = lengths.join(heads, "conv_id", "left").join(tails, "conv_id", "left")
    seq = F.coalesce("seq", F.lit(""))
    members = stored(whole.select(
        "conv_id", "length", seq.alias("seq"),
        F.md5(F.concat_ws("-", F.col("length"), seq, F.hex("x1"), F.hex("x2"))).alias("sid")), "trie-members")
    seqs = members.groupBy("sid").agg(F.first("seq").alias("seq"), F.first("length").alias("length"),
                                      F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"))
    seqs = stored(seqs.join(end_digests(members.select("sid", "conv_id")), "sid"), "trie-sequences")

    kind = F.col("length") > long
    entries = seqs.where(~kind).select("seq", F.col("sid").alias("path"), "n_convs", "conv_id", "ends",
                                       F.lit(False).alias("marked"))
    entries = entries.unionByName(seqs.where(kind).select("seq").distinct().select(
        "seq", F.concat(F.lit("long-"), F.md5("seq")).alias("path"), F.lit(0).cast("bigint").alias("n_convs"),
        F.lit(None).cast("bigint").alias("conv_id"), F.lit(None).cast("string").alias("ends"), F.lit(True).alias("marked")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = stored(entries.repartitionByRange(parts, "seq").sortWithinPartitions("seq", "path")
                  .mapInArrow(shards(shard), SHARD_ROW), "trie-shards")

    zero = F.lit(0).cast("bigint")
    rows = made.where("upper").select("path", "key", "parent_key", "conv_id", "depth", "n_convs", "last_len", "ends",
                                      "n_children", "n_leaves", "saved_tokens")
    rows = stored(rows.unionByName(long_paths(seqs.where(kind), turns, long).select(
        "*", zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved_tokens"))), "trie-paths")
    upper = rows.groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"), F.max("last_len").alias("last_len"), F.max("ends").alias("ends"),
        F.sum("n_children").alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"),
        F.min("path").alias("owner"))
    upper = stored(upper, "trie-upper")
    kids = upper.groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("_kids"))
    upper = stored(upper.join(kids, "key", "left").withColumn("n_children", F.col("kids") + F.coalesce("_kids", zero)),
                   "trie-merged")
    # every upper node weighs on its owner's path; the sums from a path's end meet by node
    weight = upper.select(
        F.col("owner").alias("path"), "depth", F.lit(None).cast("string").alias("key"),
        (F.col("leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("n_leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * F.col("last_len")).alias("saved_tokens"))
    along = rows.select("path", "depth", "key", zero.alias("n_leaves"), zero.alias("saved_tokens")).unionByName(weight)
    along = along.groupBy("path", "depth").agg(F.max("key").alias("key"), F.sum("n_leaves").alias("n_leaves"),
                                               F.sum("saved_tokens").alias("saved_tokens"))
    along = running(along, "path", "depth", BLOCK, {"n_leaves": F.sum, "saved_tokens": F.sum}, lambda a, b: a + b, falling=True)
    sums = along.groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))

    known = upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    above = (upper.select("key", "parent_key", "conv_id", "depth", "n_convs", "n_children", "ends").join(sums, "key")
             .join(known, "parent_key", "left").select(*columns))
    finished = made.where("not upper")
    # a shard's upper parents are looked up once for all their children there
    asked = (finished.where("parent_key is not null").select("shard", "parent_key").distinct()
             .join(known.withColumnRenamed("parent_conv_id", "_found"), "parent_key"))
    below = finished.join(asked, ["shard", "parent_key"], "left").withColumn(
        "parent_conv_id", F.coalesce("_found", "parent_conv_id")).select(*columns)
    nothing = hashlib.sha256(b"").hexdigest()
    return above.unionByName(below).select(*columns[:-1], F.coalesce("ends", F.lit(nothing)).alias("ends_sha256"))
