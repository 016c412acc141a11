"""Benchmark decontamination by greedy string tiling.

Benchmark items and documents are cut to lower-cased words (digits, letters,
non-ASCII). A document and an item meet if they share a seed, ``least``
consecutive words. Their common passages are then tiled greedily: windows of
the item of the current search length are put in a Karp-Rabin hash table, the
document's windows at seed places are looked up in it, hits are compared word
by word and extended, and the longest matches are marked first; marked words
are not used again. The search length goes down from the item's length to
``least``. Tiles may stand in any order, so reordered passages count. An item
is found in a document when its tiles cover at least ``cover`` of its words.

The benchmark is read in blocks of about ``BLOCK_BYTES`` of text; each block
is broadcast (its size is checked, not assumed) and one pass over the documents
meets all its items. With several blocks, each one's result is written before
the next block is read. No documents are shuffled.

Defined cases: null or empty texts, and items without words, are found nowhere;
the seed of an item of fewer than ``least`` words is the whole item, so it is
found where it stands as a whole; very long texts are tiled whole; repeated rows are each reported; equal matches are
marked from the left; an empty table on either side gives an empty report, and
the filter then keeps every document; other columns are kept by the filter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import arrow_schema, id_and_text, slices, stored
from faultline.llm.licenses import words_of

LEAST = 5
COVER = 0.5
BLOCK_BYTES = 32 << 20
_BASE = np.uint64(0x100000001B3)
_BACK = np.uint64(pow(0x100000001B3, -1, 1 << 64))    # the base's inverse


class Running:
    """Prefix sums from which the Karp-Rabin hashes of all windows of any width
    follow in one step each: S(i) sums c[j] * base^-j over j < i, and the hash of
    c[i..i+w) is (S(i + w) - S(i)) * base^(i + w - 1), modulo 2^64."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        self.power = np.full(n, _BASE)
        back = np.full(n, _BACK)
        if n:
            self.power[0] = back[0] = 1
        self.power, back = np.cumprod(self.power), np.cumprod(back)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(0x9E3779B9)) * back, out=self.sums[1:])

    def windows(self, width: int) -> np.ndarray:
        n = len(self.power) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        return (self.sums[width:] - self.sums[:n]) * self.power[width - 1:]


def rolled(codes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all ``width``-word windows."""
    return Running(codes).windows(width)


def tiles(item: np.ndarray, doc: np.ndarray, seeds: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(start in item, start in document, length), longest first. ``seeds`` are
    the document's places where some item's ``least`` words may stand."""
    m, n = len(item), len(doc)
    used_a, used_b = np.zeros(m, bool), np.zeros(n, bool)
    a, out = item.tolist(), []
    seeds = seeds[np.isin(doc[seeds], item)]
    lo = max(0, int(seeds.min(initial=n)))
    hi = min(n, int(seeds.max(initial=0)) + m + least)
    b = doc[lo:hi].tolist()
    of_item, of_doc = Running(item), Running(doc[lo:hi])
    size = m
    while size >= least and len(seeds):
        # windows without a marked word
        marked = np.concatenate(([0], np.cumsum(used_a)))
        free = np.flatnonzero(marked[size:] == marked[:m - size + 1])
        table: dict[int, list[int]] = {}
        for p, h in zip(free.tolist(), of_item.windows(size)[free].tolist()):
            table.setdefault(h, []).append(p)
        found = []
        if table:
            # running hashes of the document's windows, seed places only
            h_doc = of_doc.windows(size)
            at = seeds[seeds - lo < len(h_doc)]
            keys = np.array(list(table), np.uint64)
            for t in at[np.isin(h_doc[at - lo], keys)].tolist():
                for p in table.get(int(h_doc[t - lo]), ()):
                    k, q = 0, t - lo
                    while (p + k < m and q + k < len(b) and a[p + k] == b[q + k]
                           and not used_a[p + k] and not used_b[t + k]):
                        k += 1
                    if k >= size:
                        found.append((-k, p, t))
        hidden = False
        for k, p, t in sorted(found):
            if used_a[p:p - k].any() or used_b[t:t - k].any():
                hidden = True  # a longer tile took a part; what is left may still be long enough
                continue
            used_a[p:p - k] = used_b[t:t - k] = True
            out.append((p, t, -k))
        if not hidden or not found:
            size = max(least, size // 2) if size > least else 0
    return out


class Items:
    """One block of the benchmark: word codes of its items and their seeds."""

    def __init__(self, rows: list[tuple], least: int):
        self.codes: dict[bytes, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        seeds: dict[int, tuple[list, list]] = {}    # by seed length
        for item_id, text in rows:
            words = words_of(text)
            if not words:
                continue
            codes = np.array([self.codes.setdefault(w, len(self.codes)) for w in words], np.int64)
            keys, owner = seeds.setdefault(min(least, len(words)), ([], []))
            keys.append(np.unique(rolled(codes, min(least, len(words)))))
            owner.append(np.full(len(keys[-1]), len(self.items)))
            self.items.append((item_id, codes))
        self.seeds = {}
        for width, (keys, owner) in seeds.items():
            key, own = np.concatenate(keys), np.concatenate(owner)
            order = np.argsort(key, kind="stable")
            self.seeds[width] = key[order], own[order]

    def matches(self, text: str | None, cover: float) -> list[tuple]:
        """(item_id, tiles, words covered, words of the item) of items found."""
        words = words_of(text) if self.items else []
        if not words:
            return []
        get = self.codes.get
        doc = np.array([get(w, -1) for w in words], np.int64)
        running = Running(doc)
        by_item: dict[int, tuple[int, list[int]]] = {}
        for width, (keys, owner) in self.seeds.items():
            h = running.windows(width)
            first = np.searchsorted(keys, h)
            seeds = np.flatnonzero(keys[np.minimum(first, len(keys) - 1)] == h)
            last = np.searchsorted(keys, h[seeds], "right")
            for t, a, b in zip(seeds.tolist(), first[seeds].tolist(), last.tolist()):
                for i in owner[a:b].tolist():
                    by_item.setdefault(i, (width, []))[1].append(t)
        out = []
        for i, (width, places) in sorted(by_item.items()):
            item_id, codes = self.items[i]
            got = tiles(codes, doc, np.array(places), width)
            covered = sum(k for _, _, k in got)
            if got and covered >= cover * len(codes):
                out.append((item_id, len(got), covered, len(codes)))
        return out


def block_count(benchmark: DataFrame, block_bytes: int, text_col: str = "text") -> int:
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length(F.col(text_col).cast("string"))), F.lit(0))).first()[0]
    return max(1, -(-size // block_bytes))


def blocks(benchmark: DataFrame, n: int, id_col: str = "item_id", text_col: str = "text") -> Iterator[list[tuple]]:
    """The benchmark's rows in ``n`` blocks; each is read when it is asked for."""
    b = benchmark.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    for i in range(n):
        part = b.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i) if n > 1 else b
        yield [(r["id"], r["text"]) for r in part.orderBy("id", "text").collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, cover: float = COVER,
                 id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, n_tiles, n_covered, n_item_words, coverage): one row
    per document and item found in it."""
    ddl = "doc_id bigint, item_id bigint, n_tiles bigint, n_covered bigint, n_item_words bigint, coverage double"
    arrow = arrow_schema(ddl)
    ids = id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    out = None
    n = block_count(benchmark, block_bytes)
    for rows in blocks(benchmark, n):
        shared = docs.sparkSession.sparkContext.broadcast(rows)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items(shared.value, least)
            for part in slices(batches):
                got = [(doc_id, i, n, c, m, c / m)
                       for doc_id, text in zip(*(c.to_pylist() for c in part.columns))
                       for i, n, c, m in items.matches(text, cover)]
                cols = list(zip(*got)) if got else [[] for _ in arrow]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), f.type) for c, f in zip(cols, arrow)], schema=arrow)

        found = ids.mapInArrow(run, ddl)
        if n > 1:   # one block at a time: its report is written before the next is read
            found = stored(found, "decontam-block")
            shared.destroy()
        out = found if out is None else out.unionByName(found)
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, cover: float = COVER,
                    text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    at = docs.columns.index(text_col)
    n = block_count(benchmark, block_bytes)
    for rows in blocks(benchmark, n):
        shared = docs.sparkSession.sparkContext.broadcast(rows)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items(shared.value, least)
            for part in slices(batches):
                good = [not items.matches(t, cover) for t in part.column(at).to_pylist()]
                yield part.filter(pa.array(good, pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
        if n > 1:
            docs = stored(docs, "decontam-kept")
            shared.destroy()
    return docs
