"""Language-model scores: context-tree weighting over byte contexts.

The model predicts the bytes of the lower-cased (A-Z) UTF-8 text and one end
byte. A byte is eight binary decisions; a decision is made at a node (context,
bits of the byte so far), where the context is the last 0 to ``DEPTH`` bytes.
Every node keeps a Krichevsky-Trofimov estimate. The weighted probability of a
node's whole training sequence is

    Pw = 1/2 KT + 1/2 * product of the children's Pw   (KT alone at full depth)

and a decision's predicted probability mixes the estimates along the path of
contexts: at each depth the node's own estimate counts with the posterior
weight 1/2 KT / Pw and the deeper prediction with the rest. Training counts the
(DEPTH + 1)-grams of all training texts. Grams are partitioned and sorted by the
newest bytes of their context; all but the two oldest bytes name a subtree,
which is solved where its grams lie, in numpy. Only the subtrees' tops are
exchanged: the upper levels are DataFrames of few rows, and their share of the
prediction goes back to the subtrees, which give each gram of the corpus its log
probability. Scoring sums the grams' log probabilities.

The word scores of the contract (additive smoothing over word counts) are
computed in the same pass. A lookup table is broadcast whole if it holds at most
``MOST_ROWS`` rows (16 bytes a row). Of a larger one only the commonest rows are
broadcast, by powers of two of their training counts and ``COMMON`` rows at most;
the documents' other words or grams, rare ones, are joined with the table by
shuffles and added to what the pass has found, with the same results.

Defined cases: a null text counts as empty (one end token, one end byte); a
null id trains like an empty one; repeated rows get equal scores and count each
in training; very long texts are counted and scored whole, a slice of texts at a
time; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import arrow_schema, id_and_text, slices_by_bytes, stored

DEPTH = 3
MOST_ROWS = 10_000_000
COMMON = 4_000_000      # rows broadcast of a table that has more than MOST_ROWS
OWN = 2                 # oldest bytes of a context that a subtree spans
ROWS = 1 << 18          # grams solved at once, about; a subtree is never cut
HELD = 200_000          # distinct words or grams a task holds before it hands them on
SEED = 42               # of the 64-bit hash that stands for a word
_UPPER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))


def prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    d = id_and_text(docs, id_col, text_col)
    rest = F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0)) % 5
    return d.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", (rest == 1).alias("held_out"))


def raw(text: str | None) -> bytes:
    return (text or "").encode().translate(_UPPER)


def grams_of(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(grams, first gram of each text). A gram holds the last ``depth`` bytes,
    newest first, then the byte they predict; texts start from zero bytes and
    end with one."""
    pad = bytes(depth)
    flat = np.frombuffer(b"".join(pad + t + b"\0" for t in texts), np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    first = np.cumsum(sizes) - sizes
    own = np.ones(len(flat), bool)
    at = first + depth * np.arange(len(texts))
    for k in range(depth):
        own[at + k] = False
    kind = np.uint32 if depth <= 3 else np.uint64
    key = flat[depth:].astype(kind)
    for k in range(1, depth + 1):  # the newest byte is the highest
        key |= flat[depth - k:len(flat) - k].astype(kind) << kind(8 * (depth + 1 - k))
    return key[own[depth:]], first


# ---------------------------------------------------------------- counts

def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over training texts; the end token is the empty word."""
    ddl = "word string, n bigint"
    arrow = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def hand_on() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()).cast(pa.string()),
                                              pa.array(list(held.values()), pa.int64())], schema=arrow)
            held.clear()
            return got

        for part in slices_by_bytes(batches, 0):
            for text in part.column(0).to_pylist():
                held.update(raw(text).split())
            held[b""] += part.num_rows
            if len(held) > HELD:
                yield hand_on()
        if held:
            yield hand_on()

    train = docs.where(~F.col("held_out")).select("text")
    return train.mapInArrow(run, ddl).groupBy("word").agg(F.sum("n").alias("n"))


def gram_counts(docs: DataFrame, depth: int) -> DataFrame:
    """(gram, n): every gram of the corpus and its count in training texts."""
    ddl = "gram bigint, n bigint"
    arrow = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for part in slices_by_bytes(batches, 0):
            held_out = np.array(part.column(1).to_pylist(), bool)
            grams, first = grams_of([raw(t) for t in part.column(0).to_pylist()], depth)
            size = np.diff(np.append(first, len(grams)))
            trains = np.repeat(~held_out, size)
            new, n = np.unique(grams[trains], return_counts=True)
            other = np.setdiff1d(np.unique(grams[~trains]), new, assume_unique=True)
            every = np.concatenate([keys, new.astype(np.int64), other.astype(np.int64)])
            n = np.concatenate([counts, n, np.zeros(len(other), np.int64)])
            order = np.argsort(every, kind="stable")
            every, n = every[order], n[order]
            at = np.flatnonzero(np.diff(every, prepend=-1))
            keys, counts = every[at], np.add.reduceat(n, at) if len(at) else n[:0]
            if len(keys) > 10 * HELD:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], schema=arrow)
                keys, counts = keys[:0], counts[:0]
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], schema=arrow)

    # one exchange: grams of a subtree meet, and are summed where they are
    return (docs.select("text", "held_out").mapInArrow(run, ddl).withColumn("top", top_of("gram", depth))
            .repartition("top").groupBy("top", "gram").agg(F.sum("n").alias("n")))


def top_of(column: str, depth: int) -> Column:
    """The context bytes that name a gram's subtree: all but the OWN oldest."""
    return F.shiftrightunsigned(column, 8 * (1 + min(OWN, depth)))


# ---------------------------------------------------------------- the tree

def ln_gamma(x: Column) -> Column:
    """ln Gamma for x >= 1/2: Stirling's series at x + 8, stepped back."""
    y, steps = x + 8, F.lit(0.0)
    for k in range(8):
        steps = steps + F.ln(x + k)
    series = ((y - 0.5) * F.ln(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y)
              - 1 / (360 * F.pow(y, F.lit(3))) + 1 / (1260 * F.pow(y, F.lit(5))))
    return series - steps


def ln_kt(a: Column, b: Column) -> Column:
    """ln of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return ln_gamma(a + 0.5) + ln_gamma(b + 0.5) - math.log(math.pi) - ln_gamma(a + b + 1)


def np_ln_gamma(x: np.ndarray) -> np.ndarray:
    y, steps = x + 8, np.zeros(len(x))
    for k in range(8):
        steps += np.log(x + k)
    return ((y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3)
            + 1 / (1260 * y ** 5) - steps)


def np_ln_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np_ln_gamma(a + 0.5) + np_ln_gamma(b + 0.5) - math.log(math.pi) - np_ln_gamma(a + b + 1)


class Level:
    """The nodes of one context length and one bit place: ``key`` is the
    context, then the bits so far; counts of the next bit."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, bit: int):
        # keys: distinct (context, byte), sorted
        node = keys >> np.uint64(8 - bit)
        first = np.flatnonzero(np.diff(node, prepend=~node[:1]))
        one = (keys >> np.uint64(7 - bit)) & np.uint64(1) == 1
        self.key = node[first]
        self.a = np.add.reduceat(np.where(one, 0, n), first).astype(np.float64)
        self.b = np.add.reduceat(np.where(one, n, 0), first).astype(np.float64)
        self.kt = (self.b + 0.5) / (self.a + self.b + 1)
        self.own = np_ln_kt(self.a, self.b)

    def at(self, keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.key, keys)


def shortened(key: np.ndarray, bit: int) -> np.ndarray:
    """The key with one context byte (the oldest) less."""
    low = np.uint64((1 << bit) - 1)
    return ((key >> np.uint64(bit + 8)) << np.uint64(bit)) | (key & low)


def subtrees(grams: np.ndarray, n: np.ndarray, span: int) -> list[list[Level]]:
    """Levels of whole subtrees by context length (longest first) and bit, with
    their weighted probabilities ``ln_w``."""
    out = []
    for d in range(span + 1):
        if d:
            keys = ((keys >> np.uint64(16)) << np.uint64(8)) | (keys & np.uint64(255))
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], n[order]
            first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
            keys, n = keys[first], np.add.reduceat(n, first)
        else:
            keys = grams
        levels = [Level(keys, n, bit) for bit in range(8)]
        for bit, level in enumerate(levels):
            if d == 0:
                level.ln_w = level.own
            else:
                child = out[-1][bit]
                level.up = level.at(shortened(child.key, bit))
                below = np.bincount(level.up, child.ln_w, len(level.key))
                top = np.maximum(level.own, below)
                level.ln_w = top + np.log1p(np.exp(np.minimum(level.own, below) - top)) - math.log(2)
        out.append(levels)
    return out


def whole_tops(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[np.ndarray]]:
    """The sorted batches' columns in runs of about ``most`` rows, cut where the
    first column changes."""
    held: list[list[np.ndarray]] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        size += batch.num_rows
        if size >= most:
            columns = [np.concatenate(c) for c in zip(*held)]
            cut = int(np.searchsorted(columns[0], columns[0][-1]))
            held, size = [[c[cut:] for c in columns]], size - cut
            if cut:
                yield [c[:cut] for c in columns]
    if size:
        yield [np.concatenate(c) for c in zip(*held)]


def subtree_tops(grams: DataFrame, depth: int) -> DataFrame:
    """(context, node, a, b, ln_w) of the subtrees' first nodes."""
    span = min(OWN, depth)
    ddl = "context bigint, node bigint, a double, b double, ln_w double"
    arrow = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, gram, n in whole_tops(batches, ROWS):
            for bit, level in enumerate(subtrees(gram.view(np.uint64), n, span)[-1]):
                node = (level.key & np.uint64((1 << bit) - 1)) | np.uint64(1 << bit)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((level.key >> np.uint64(bit)).view(np.int64)), pa.array(node.view(np.int64)),
                     pa.array(level.a), pa.array(level.b), pa.array(level.ln_w)], schema=arrow)

    return grams.select("top", "gram", "n").sortWithinPartitions("top", "gram").mapInArrow(run, ddl)


def upper_shares(tops: DataFrame, levels: int) -> DataFrame:
    """(top, node, plus, times): a decision's probability of a one is plus +
    times the subtree's own prediction. ``levels`` contexts stand above."""
    key = ["context", "node"]
    level, above = tops, []
    for d in range(levels - 1, -1, -1):
        up = (level.withColumn("context", F.shiftrightunsigned("context", 8)).groupBy(*key)
              .agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("ln_w").alias("below"))
              .withColumn("own", ln_kt(F.col("a"), F.col("b"))))
        top = F.greatest("own", "below")
        ln_w = top + F.log1p(F.exp(F.least("own", "below") - top)) - math.log(2)
        level = stored(up.withColumn("ln_w", ln_w), f"ctw-level{d}")
        above.append(level)
    share = None
    for level in reversed(above):       # from the empty context on
        w = F.exp(F.col("own") - math.log(2) - F.col("ln_w"))
        kt = (F.col("b") + 0.5) / (F.col("a") + F.col("b") + 1)
        here = level.select("context", "node", (w * kt).alias("plus"), (1 - w).alias("times"))
        if share is not None:
            before = share.select(F.col("context").alias("_c"), F.col("node").alias("_n"),
                                  F.col("plus").alias("_p"), F.col("times").alias("_t"))
            here = (here.join(before, (F.shiftrightunsigned("context", 8) == F.col("_c")) & (F.col("node") == F.col("_n")))
                    .select("context", "node", (F.col("_p") + F.col("_t") * F.col("plus")).alias("plus"),
                            (F.col("_t") * F.col("times")).alias("times")))
        share = here
    nodes = tops.select(F.col("context").alias("top"), "node")
    if share is None:
        return nodes.select("top", "node", F.lit(0.0).alias("plus"), F.lit(1.0).alias("times"))
    return (nodes.join(share, (F.shiftrightunsigned("top", 8) == share["context"]) & (nodes["node"] == share["node"]))
            .select("top", nodes["node"], "plus", "times"))


def gram_scores(grams: DataFrame, depth: int) -> DataFrame:
    """(gram, log_p, n): log10 of the model's probability of each gram's byte, from
    (top, gram, n)."""
    span = min(OWN, depth)
    tops = stored(subtree_tops(grams.repartition("top"), depth), "ctw-tops")
    shares = stored(upper_shares(tops, depth - span), "ctw-shares")
    # both tables by subtree: its shares, then its grams
    none = F.lit(None)
    rows = shares.select("top", none.cast("bigint").alias("gram"), F.col("node"), "plus", "times").unionByName(
        grams.select("top", "gram", F.col("n").alias("node"), none.cast("double").alias("plus"), none.cast("double").alias("times")))
    ddl = "gram bigint, log_p double, n bigint"
    arrow = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for top, mark, gram, node, plus, times in whole_tops(batches, ROWS):
            share = mark == 0
            # first nodes of the subtrees: top, then the bits so far under a leading 1
            bits = np.zeros(int(share.sum()), np.int64)
            for k in range(1, 8):
                bits += node[share] >= 1 << k
            grams, n = gram[~share].astype(np.int64).view(np.uint64), node[~share]
            levels = subtrees(grams, n, span)
            log_p = np.zeros(len(grams))
            for bit in range(8):
                first = levels[-1][bit]
                own = np.flatnonzero(bits == bit)
                key = (top[share][own].view(np.uint64) << np.uint64(bit)) | (
                    node[share][own].view(np.uint64) & np.uint64((1 << bit) - 1))
                at = first.at(key)
                p, t = np.empty(len(first.key)), np.empty(len(first.key))
                p[at], t[at] = plus[share][own], times[share][own]
                # from the subtree's first node down: plus and times of each deeper one
                for d in range(span, 0, -1):
                    level = levels[d][bit]
                    w = np.exp(level.own - math.log(2) - level.ln_w)
                    p, t = (p + t * w * level.kt)[level.up], (t * (1 - w))[level.up]
                leaf = levels[0][bit]
                q = p + t * leaf.kt
                one = (grams >> np.uint64(7 - bit)) & np.uint64(1) == 1
                q = q[leaf.at(grams >> np.uint64(8 - bit))]
                log_p += np.log10(np.where(one, q, 1 - q))
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(log_p), pa.array(n)], schema=arrow)

    mark = F.when(F.col("gram").isNull(), 0).otherwise(1).cast("bigint")
    return (rows.select("top", mark.alias("mark"), F.coalesce("gram", F.lit(0)).alias("gram"), "node", "plus", "times")
            .repartition("top").sortWithinPartitions("top", "mark", "gram").mapInArrow(run, ddl))


# ---------------------------------------------------------------- scores

def words_of(texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(all words, an empty one after each text; where each text's words start)."""
    flat, first = [], np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        first[i] = len(flat)
        flat += t.split()
        flat.append(b"")
    return pa.array(flat, pa.binary()).dictionary_encode(), first


def hashed(words: pa.Array) -> np.ndarray:
    """The hash that Spark's xxhash64 gives a string."""
    return np.array([xxhash.xxh64_intdigest(w, SEED) for w in words.to_pylist()], np.uint64).view(np.int64)


def size_of(n: Column) -> Column:
    """The binary digits of n + 1."""
    return F.length(F.bin(n + 1))


def commonest(table: DataFrame, most_rows: int) -> tuple[DataFrame, bool]:
    """(rows to broadcast, whether they are the whole table), by the column n."""
    sizes = sorted(table.groupBy(size_of(F.col("n")).alias("size")).count().collect(), reverse=True)
    if sum(r["count"] for r in sizes) <= most_rows:
        return table, True
    held, least = 0, math.inf
    for r in sizes:
        held += r["count"]
        if held > min(COMMON, most_rows):
            break
        least = r["size"]
    return table.where(size_of(F.col("n")) >= F.lit(least)), False


def found_in(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in the sorted keys, whether each is there)."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def rest_of(text: np.ndarray, code: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(where each text's codes start and, last, end; its distinct codes; their counts)."""
    order = np.lexsort((code, text))
    text, code = text[order], code[order]
    first = np.flatnonzero(np.append(True, (np.diff(text) != 0) | (code[1:] != code[:-1]))[:len(code)])
    return (np.searchsorted(text[first], np.arange(n_texts + 1)).astype(np.int32), code[first],
            np.diff(np.append(first, len(code))))


def score_by_tables(docs: DataFrame, words: DataFrame, grams: DataFrame, total: int, distinct: int,
                    depth: int, most_rows: int) -> DataFrame:
    """Scores by what is broadcast, then those of the words and grams that are not."""
    spark = docs.sparkSession
    some_words, all_words_here = commonest(words, most_rows)
    some_grams, all_grams_here = commonest(grams, most_rows)
    w = some_words.select(F.xxhash64("word").alias("h"), F.col("n").cast("bigint")).toArrow()
    order = np.argsort(w[0].to_numpy(), kind="stable")
    keys, counts = w[0].to_numpy()[order], w[1].to_numpy()[order]
    if counts.max(initial=0) < 1 << 31:
        counts = counts.astype(np.int32)
    del w, order
    g = some_grams.select("gram", "log_p").toArrow()
    order = np.argsort(g[0].to_numpy(), kind="stable")
    shared = spark.sparkContext.broadcast((keys, counts, g[0].to_numpy()[order], g[1].to_numpy()[order]))
    del g, order
    ddl = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
           "base_score double, score double, n_bytes bigint")
    whole = all_words_here and all_grams_here
    more = "words array<string>, word_n array<bigint>, grams array<bigint>, gram_n array<bigint>"
    ddl_of_pass = ddl if whole else f"{ddl}, {more}"
    arrow = arrow_schema(ddl_of_pass)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, gram_keys, log_p = shared.value
        gram_keys = gram_keys.view(np.uint64).astype(np.uint32 if depth <= 3 else np.uint64, copy=False)
        for part in slices_by_bytes(batches, 1):
            texts = [raw(t) for t in part.column(1).to_pylist()]
            all_words, first = words_of(texts)
            n_tokens = np.diff(np.append(first, len(all_words)))
            at, here = found_in(keys, hashed(all_words.dictionary))
            c = np.where(here, counts[at], 0) if len(keys) else np.zeros(len(here), np.int64)
            each = np.asarray(all_words.indices)
            of_each = np.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))
            if not all_words_here:
                of_each[~here] = 0
            base = np.add.reduceat(of_each[each], first)
            known = np.add.reduceat((c > 0).astype(np.int64)[each], first)
            found, start = grams_of(texts, depth)
            size = np.array([len(t) + 1 for t in texts])
            # in order, each gram once: a large table is read from one end to the other
            found, place = np.unique(found, return_inverse=True)
            at, seen = found_in(gram_keys, found)
            p = (np.where(seen, log_p[at], 0) if len(log_p) else np.zeros(len(found)))[place]
            cols = [part.column(0).to_pylist(), part.column(2).to_pylist(), n_tokens, known,
                    np.full(len(texts), total), base, np.add.reduceat(p, start), size]
            cols = [pa.array(x, f.type) for x, f in zip(cols, arrow)]
            if not whole:
                which = np.arange(len(texts))
                lost = np.zeros(len(each), bool) if all_words_here else ~here[each]
                at, code, n = rest_of(np.repeat(which, n_tokens)[lost], each[lost], len(texts))
                cols += [pa.ListArray.from_arrays(at, all_words.dictionary.take(pa.array(code)).cast(pa.string())),
                         pa.ListArray.from_arrays(at, pa.array(n, pa.int64()))]
                lost = ~seen[place]  # none if the table is whole: it has every gram of the corpus
                at, code, n = rest_of(np.repeat(which, size)[lost], place[lost], len(texts))
                cols += [pa.ListArray.from_arrays(at, pa.array(found[code].astype(np.int64))),
                         pa.ListArray.from_arrays(at, pa.array(n, pa.int64()))]
            yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(cols, arrow)], schema=arrow)

    got = docs.select("doc_id", "text", "held_out").mapInArrow(run, ddl_of_pass)
    if whole:
        return got
    got = stored(got.withColumn("_row", F.monotonically_increasing_id()), "lm-scored")

    def rest(values: str, counts: str, name: str) -> DataFrame:
        return (got.select("_row", F.explode(F.arrays_zip(values, counts)).alias("_z"))
                .select("_row", F.col(f"_z.{values}").alias(name), F.col(f"_z.{counts}").alias("times")))

    known = F.coalesce("n", F.lit(0))
    parts = []
    if not all_words_here:
        parts.append(rest("words", "word_n", "word").join(words, "word", "left").select(
            "_row", F.when(known > 0, F.col("times")).otherwise(0).alias("k"),
            (F.col("times") * F.log10((known + 0.5) / (total + 0.5 * (distinct + 1)))).alias("b"), F.lit(0.0).alias("s")))
    if not all_grams_here:
        parts.append(rest("grams", "gram_n", "gram").join(grams, "gram").select(
            "_row", F.lit(0).cast("bigint").alias("k"), F.lit(0.0).alias("b"), (F.col("times") * F.col("log_p")).alias("s")))
    added = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    added = added.groupBy("_row").agg(*(F.sum(x).alias(x) for x in "kbs"))
    plus = {"n_known": "k", "base_score": "b", "score": "s"}
    kinds = [x.split() for x in ddl.split(", ")]
    return got.join(added, "_row", "left").select(*(
        (F.col(c) + F.coalesce(plus[c], F.lit(0)) if c in plus else F.col(c)).cast(kind).alias(c) for c, kind in kinds))


def score_texts(docs: DataFrame, depth: int = DEPTH, most_rows: int = MOST_ROWS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document: word counts and base score, the model's log10
    probability, its bytes and its code length in bits per byte."""
    if not 1 <= depth <= 6:
        raise ValueError("depth must be 1 to 6")
    d = prepared(docs, id_col, text_col)
    words = stored(word_counts(d), "lm-words")
    grams = stored(gram_scores(stored(gram_counts(d, depth), "lm-grams"), depth), "lm-gram-scores")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    got = score_by_tables(d, words, grams, total, distinct, depth, most_rows)
    return got.withColumn("bits_per_byte", -F.col("score") / math.log10(2) / F.col("n_bytes"))
