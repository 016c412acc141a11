"""Quality rules as a short-circuit cascade.

Each rule rejects a document by one measured fact. Rules differ in cost (a
character count against hashing every word window) and in how often they
reject. The cascade times each rule and counts its rejections on a bounded
sample, orders the rules greedily by rejections per cost among the documents
that earlier rules let through, and evaluates a document's rules in that order
until one rejects it. The order changes only the time: a document is kept when
no rule rejects it, whatever the order.

Defined cases: a null or empty text has no words and is rejected by
``min_words``; very long texts are judged whole; rows with equal texts get equal verdicts; an empty table gives
an empty result; other columns are neither read nor lost.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import arrow_schema, id_and_text, map_rows, slices

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
SAMPLE_ROWS = 2000
_BLANKS = b"\t\n\x0b\x0c\r "
_CONTINUATION = bytes(range(0x80, 0xC0))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside a ``width``-word window that occurs twice or more (first
    occurrence included). Windows are compared by 64-bit hash, then exactly."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    h = codes[:n].copy()
    for k in range(1, width):
        h *= _MIX
        h += codes[k:k + n]
    s = np.sort(h)
    again = s[1:][s[1:] == s[:-1]]
    if not len(again):
        return 0
    starts = np.flatnonzero(np.isin(h, again)).tolist()
    seen = Counter(tuple(words[i:i + width]) for i in starts)
    step = np.zeros(len(words) + 1, np.int64)
    for i in starts:
        if seen[tuple(words[i:i + width])] > 1:
            step[i] += 1
            step[i + width] -= 1
    return int((np.cumsum(step[:-1]) > 0).sum())


class Facts:
    """What the rules ask of one text; each fact is measured once, on demand."""

    def __init__(self, text: str | None):
        self.data = (text or "").encode()

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.data.translate(None, _BLANKS + _CONTINUATION))

    @cached_property
    def n_symbols(self) -> int:
        return sum(self.data.count(s) for s in SYMBOLS)

    @cached_property
    def n_shouts(self) -> int:
        return self.data.count(b"!")

    @cached_property
    def n_stutters(self) -> int:
        """Words equal to the word before."""
        return sum(map(eq, self.words, self.words[1:]))

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.data.split(b"\n") if x.strip(_BLANKS)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        return repeated_words(self.words)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Facts], bool]


MIN_WORDS = Rule("min_words", lambda f: f.n_words < 20)
REPEATS = Rule("repeated_words", lambda f: 100 * f.n_repeat_words > 30 * f.n_words)
RULES = (
    MIN_WORDS,
    Rule("symbol_density", lambda f: 10 * f.n_symbols > f.n_words),
    Rule("shouting", lambda f: 5 * f.n_shouts > f.n_words),
    Rule("long_words", lambda f: f.word_chars > 25 * f.n_words),
    Rule("short_words", lambda f: 2 * f.word_chars < 3 * f.n_words),
    Rule("stutter", lambda f: 5 * f.n_stutters > f.n_words),
    Rule("dup_lines", lambda f: f.n_dup_lines >= 3 and 100 * f.n_dup_lines > 30 * len(f.lines)),
    REPEATS,
)


def greedy_order(costs: dict[str, float], verdicts: dict[int, int], names: list[str]) -> list[str]:
    """Rules by rejections per cost among what the chosen ones let through.

    ``verdicts``: number of sample documents by bit mask of rejecting rules.
    Ties, and rules that reject nothing more, go by cost, then by name.
    """
    left, order, alive = list(names), [], dict(verdicts)
    while left:
        def gain(name: str) -> tuple:
            bit = 1 << names.index(name)
            out = sum(n for mask, n in alive.items() if mask & bit)
            return (-out / max(costs[name], 1e-12), costs[name], name)
        best = min(left, key=gain)
        bit = 1 << names.index(best)
        alive = {mask: n for mask, n in alive.items() if not mask & bit}
        order.append(best)
        left.remove(best)
    return order


def plan_cascade(docs: DataFrame, rules=RULES, text_col: str = "text",
                 sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> list[Rule]:
    """Order ``rules`` from a sample of about ``sample_rows`` rows.

    Costs and verdicts are measured where the sampled rows are read; the driver
    receives one row per combination of verdicts (at most 2 ** len(rules)).
    """
    ddl = "mask bigint, docs bigint, " + ", ".join(f"c{i} double" for i in range(len(rules)))
    arrow = arrow_schema(ddl)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks, spent = Counter(), [0.0] * len(rules)
        for part in slices(batches):
            for text in part.column(0).to_pylist():
                mask = 0
                for i, rule in enumerate(rules):
                    facts = Facts(text)
                    facts.words  # shared by all rules: no rule's own cost
                    began = time.perf_counter()
                    mask |= rule.rejects(facts) << i
                    spent[i] += time.perf_counter() - began
                masks[mask] += 1
        rows = [(m, n, *(spent if k == 0 else [0.0] * len(rules)))
                for k, (m, n) in enumerate(masks.items())]
        cols = list(zip(*rows)) if rows else [[] for _ in arrow]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(cols, arrow)], schema=arrow)

    share = min(1.0, sample_rows / max(1, docs.count()))
    sample = docs.select(F.col(text_col).cast("string").alias("text")).sample(False, share, seed)
    got = (sample.mapInArrow(measure, ddl).groupBy("mask")
           .agg(F.sum("docs"), *(F.sum(f"c{i}") for i in range(len(rules)))).collect())
    names = [r.name for r in rules]
    costs = {n: sum(row[2 + i] for row in got) for i, n in enumerate(names)}
    order = greedy_order(costs, {row[0]: row[1] for row in got}, names)
    return [next(r for r in rules if r.name == n) for n in order]


def first_rejection(facts: Facts, order: list[Rule]) -> str | None:
    for rule in order:
        if rule.rejects(facts):
            return rule.name
    return None


def filter_quality(docs: DataFrame, rules=RULES, text_col: str = "text") -> DataFrame:
    """The rows that no rule rejects, with all their columns."""
    order = plan_cascade(docs, rules, text_col)
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            good = [first_rejection(Facts(t), order) is None for t in part.column(at).to_pylist()]
            yield part.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def quality_report(docs: DataFrame, rules=RULES, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """The base facts of every document and the verdict of the cascade."""
    order = plan_cascade(docs, rules, text_col)

    def row(_, doc_id, text):
        f = Facts(text)
        rejected = first_rejection(f, order)
        base = MIN_WORDS.rejects(f) or REPEATS.rejects(f)
        return (doc_id, f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words,
                base, rejected is None and not base)

    ids = id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return map_rows(ids, row, "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
                    "n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
                    ["doc_id", "text"])
