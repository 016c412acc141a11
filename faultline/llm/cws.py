"""Document fingerprints by consistent weighted sampling.

A text's weighted terms are its shingles of WIDTH words (ASCII lower case; the
whole sequence where there are fewer) with their counts. For each of SAMPLES
samples and each term, two Gamma(2, 1) variates r and c and a uniform b, all
functions of the term and the sample alone, give a step t = floor(ln w / r + b)
and a value ln a = ln c - r (t - b) - r. The term of least value and its step
are the sample. Two texts draw the same sample with probability equal to their
generalised Jaccard similarity: the sum of the smaller over the sum of the
larger weights of all terms. A fingerprint holds 32 bits of each sample; the
likeness of two is the share of equal samples.

``fingerprints`` only maps. ``edit_report`` also needs each document's
neighbour in ascending doc_id: texts are shuffled once, into ranges of
(doc_id, MD5 of the text) found from the keys alone, and the first document of
each range goes to the range before as well. A stream over a range then holds
two texts at a time. A text and its edited form share most (term, weight)
pairs, which are sampled once.

Defined cases. A null text is empty; a text without words has the empty
fingerprint, like another of them by 1 and any other by 0. Null ids come
first, documents that share an id follow each other by MD5 of the text, and
equal rows follow one another; a key with very many equal rows travels as one
row with its count. Very long texts: whole, their terms are sampled in blocks. The
last document's next is the first, a lone document's next is itself. An empty
table gives no row. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import arrow_schema, id_and_text, map_rows, slices_by_bytes, stored

WIDTH = 5
SAMPLES = 64
ROWS = 256                      # terms sampled at once
RANGE_BYTES = 32 << 20          # text of a range, about
REPEATS = 10_000                # equal rows from which they may travel as one
WORDS = 1 << 19                 # word hashes a task keeps
_M1, _M2, _M3 = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))


def mixed(z: np.ndarray) -> np.ndarray:
    """An avalanche of 64 bits, in place."""
    z ^= z >> np.uint64(30)
    z *= _M1
    z ^= z >> np.uint64(27)
    z *= _M2
    z ^= z >> np.uint64(31)
    return z


def uniform(bits: np.ndarray) -> np.ndarray:
    """21 bits -> (0, 1)."""
    u = bits.astype(np.float32)
    u += np.float32(.5)
    u *= np.float32(2 ** -21)
    return u


class Sampler:
    """Draws samples; keeps the hashes of words met before."""

    def __init__(self, samples: int = SAMPLES, width: int = WIDTH):
        self.samples, self.width, self.words = samples, width, {}
        self.index = np.arange(samples)
        self.salt = (mixed(np.arange(1, 2 * samples + 1, dtype=np.uint64) * _M3) | np.uint64(1)).reshape(2, samples)

    def terms(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct shingle hashes and their counts."""
        known = self.words
        if len(known) > WORDS:
            known.clear()
        hashes = []
        for w in text.encode("utf-8", "replace").lower().split():
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh64_intdigest(w)
            hashes.append(h)
        w = np.array(hashes, np.uint64)
        k = min(self.width, len(w))
        if not k:
            return w, np.zeros(0, np.int64)
        s = np.full(len(w) - k + 1, k, np.uint64)
        for j in range(k):
            s = mixed(s * _M3 + w[j:len(w) - k + 1 + j])
        return np.unique(s, return_counts=True)

    def bits(self, part: np.ndarray, word: int) -> np.ndarray:
        """64 bits for each term and sample."""
        z = part[:, None] * self.salt[word]
        z ^= z >> np.uint64(29)
        z *= _M1
        z ^= z >> np.uint64(32)
        return z

    def draw(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per sample the least value a, its term and its step.

        With x and y exponential, r = x + y is Gamma(2, 1) and b = x / r an
        independent uniform, so that a = c exp(-y - r t); the first weight's
        step is 0 and needs neither r nor b."""
        best = np.full(self.samples, np.inf, np.float32)
        term, step = np.zeros(self.samples, np.uint64), np.zeros(self.samples, np.float32)
        once = counts == 1
        for some, ones in ((terms[once], True), (terms[~once], False)):
            for at in range(0, len(some), ROWS):
                part = some[at:at + ROWS]
                z = self.bits(part, 0)
                low = np.uint64((1 << 21) - 1)
                u2 = uniform(z & low)
                a = uniform((z >> np.uint64(21)) & low)
                a *= uniform(z >> np.uint64(43))
                np.log(a, out=a)
                np.negative(a, out=a)
                a *= u2                         # c exp(-y)
                if not ones:
                    x = -np.log(uniform(self.bits(part, 1) >> np.uint64(43)))
                    r = x - np.log(u2)
                    weight = counts[~once][at:at + ROWS, None].astype(np.float32)
                    t = np.floor((np.log(weight) + x) / r)
                    a *= np.exp(-r * t)
                k = a.argmin(axis=0)
                value = a[k, self.index]
                better = (value < best) | ((value == best) & (part[k] < term))
                best[better], term[better] = value[better], part[k[better]]
                step[better] = 0 if ones else t[k, self.index][better]
        return best, term, step


def least(a: tuple, b: tuple) -> tuple:
    """Two draws joined; of equal values the smaller term's."""
    take = (b[0] < a[0]) | ((b[0] == a[0]) & (b[1] < a[1]))
    return tuple(np.where(take, y, x) for x, y in zip(a, b))


def signature(draw: tuple, empty: bool) -> np.ndarray:
    """32 bits of each sample; nothing for a text without terms."""
    if empty:
        return np.zeros(0, np.uint32)
    z = mixed(draw[1] ^ (draw[2].astype(np.int64).astype(np.uint64) * _M3))
    return (z >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return float(np.mean(a == b))


def as_text(sign: np.ndarray) -> str:
    return sign.astype(">u4").tobytes().hex()


def fingerprint_of(sampler: Sampler, text: str) -> np.ndarray:
    terms, counts = sampler.terms(text)
    return signature(sampler.draw(terms, counts), not len(terms))


def fingerprints(docs: DataFrame, samples: int = SAMPLES, width: int = WIDTH, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every document."""
    def row(sampler, doc_id, text):
        return doc_id, as_text(fingerprint_of(sampler, text or ""))
    return map_rows(id_and_text(docs, id_col, text_col), row, "doc_id bigint, fingerprint string",
                    ["doc_id", "text"], lambda: Sampler(samples, width))


class Neighbours:
    """Documents in order -> report rows. A document's samples are drawn when
    its next text is there, as it shares most with its edited form; its row
    then waits for the next one's samples."""

    def __init__(self, sampler: Sampler):
        self.sampler, self.held, self.waiting = sampler, None, None

    def push(self, doc_id, text: str, copies: int = 1) -> Iterator[tuple]:
        new = (doc_id, text, *self.sampler.terms(text), copies)
        if self.held:
            copies = self.held[4]
            if copies > 1:              # each but the last is followed by its like
                row, sign = self.drawn(self.held)
                for at in range(0, copies - 1, 100_000):
                    yield *row, 1.0, min(100_000, copies - 1 - at)
            row, sign = self.drawn(new)
            if self.waiting:
                yield *self.waiting[0], likeness(self.waiting[1], sign), 1
            self.waiting = row, sign
        self.held = new

    def close(self, doc_id, text: str) -> Iterator[tuple]:
        """The rows left, the last document being followed by ``text``."""
        yield from self.push(doc_id, text)
        if self.waiting:
            _, _, terms, counts, _ = self.held
            sign = signature(self.sampler.draw(terms, counts), not len(terms))
            yield *self.waiting[0], likeness(self.waiting[1], sign), 1
        self.held = self.waiting = None

    def drawn(self, following: tuple) -> tuple[tuple, np.ndarray]:
        """The held document's row up to near_edited, and its samples."""
        doc_id, text, terms, counts, _ = self.held
        k = len(text) // 4
        edited = text[:len(text) - k] + following[1][:k]
        e_terms, e_counts = self.sampler.terms(edited)
        _, at, e_at = np.intersect1d(terms, e_terms, assume_unique=True, return_indices=True)
        alike = counts[at] == e_counts[e_at]
        own, other = np.ones(len(terms), bool), np.ones(len(e_terms), bool)
        own[at[alike]], other[e_at[alike]] = False, False
        shared = self.sampler.draw(terms[~own], counts[~own])
        sign = signature(least(shared, self.sampler.draw(terms[own], counts[own])), not len(terms))
        e_sign = signature(least(shared, self.sampler.draw(e_terms[other], e_counts[other])), not len(e_terms))
        return (doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(), as_text(sign),
                as_text(e_sign), likeness(sign, e_sign)), sign


REPORT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, copies bigint")


def dealt(bounds: list[tuple]):
    """Rows (doc_id, print, text, copies) -> with the range they belong to. The
    first key of a range also goes to the range before it, to stand behind all."""
    schema = arrow_schema("doc_id bigint, print string, text string, copies bigint, part int, ahead boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, part, ahead = [], [], []
            for k, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                key = order_key(*key)
                p = max(bisect_right(bounds, key) - 1, 0)
                take.append(k)
                part.append(p)
                ahead.append(False)
                if bounds[p] == key:
                    take.append(k)
                    part.append((p - 1) % len(bounds))
                    ahead.append(True)
            out = batch.take(pa.array(take, pa.int32()))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(part, pa.int32()), pa.array(ahead)], schema=schema)
    return run


def order_key(doc_id, print128: str) -> tuple:
    return doc_id is not None, doc_id or 0, print128


def reported(samples: int, width: int):
    """Sorted ranges (part, ahead, doc_id, text, copies) -> REPORT."""
    schema = arrow_schema(REPORT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(samples, width)
        chain, now = Neighbours(sampler), None
        for batch in slices_by_bytes(batches, 3):
            rows: list[tuple] = []
            for part, ahead, doc_id, text, copies in zip(*(c.to_pylist() for c in batch.columns)):
                if not ahead:
                    if part != now:
                        chain, now = Neighbours(sampler), part
                    rows += chain.push(doc_id, text, copies)
                elif chain.held and part == now:        # the first of the range behind; more are its copies
                    rows += chain.close(doc_id, text)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)],
                                                 schema=schema)
    return run


def edit_report(docs: DataFrame, samples: int = SAMPLES, width: int = WIDTH, range_bytes: int = RANGE_BYTES,
                repeats: int = REPEATS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its fingerprint, that of its edited text (the last
    quarter replaced by the next document's beginning), and how alike it is to
    that text and to the next document."""
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.md5("text").alias("print"), "text", F.lit(1).cast("bigint").alias("copies"))
    keys = stored(rows.groupBy("doc_id", "print").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("text")).alias("bytes")),
                  "cws-keys")
    total, size = keys.agg(F.sum("n"), F.sum(F.col("n") * F.col("bytes"))).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(size or 0) // range_bytes))
    # at most REPEATS keys can have more equal rows than this, so they may be broadcast
    many = max(repeats, (total or 0) // REPEATS)
    heavy = keys.where(F.col("n") > many).select(F.col("doc_id").alias("_d"), F.col("print").alias("_p"))
    if heavy.limit(1).count():
        heavy = F.broadcast(heavy)
        on = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("print") == F.col("_p"))
        one = (rows.join(heavy, on).groupBy("doc_id", "print")
               .agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")))
        rows = rows.join(heavy, on, "left_anti").unionByName(one)
    firsts = (keys.repartitionByRange(parts, "doc_id", "print")
              .select(F.spark_partition_id().alias("p"), F.struct("doc_id", "print").alias("k"))
              .groupBy("p").agg(F.min("k").alias("k")).collect())        # one key per range
    bounds = sorted(order_key(*r["k"]) for r in firsts)
    if not bounds:
        return spark.createDataFrame([], REPORT).drop("copies")
    dealt_rows = rows.mapInArrow(dealt(bounds), "doc_id bigint, print string, text string, copies bigint, part int, ahead boolean")
    made = (dealt_rows.repartitionById(parts, F.col("part"))
            .sortWithinPartitions("part", "ahead", "doc_id", "print")
            .select("part", "ahead", "doc_id", "text", "copies").mapInArrow(reported(samples, width), REPORT))
    # a row stands for at most 100,000 equal ones
    return made.withColumn("copy", F.explode(F.expr("sequence(1, copies)"))).drop("copies", "copy")
