"""Secrets, found through a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived:
whatever the expression can match must hold those trigrams. Every block of
documents gets an inverted index (trigram -> the block's documents) for the
trigrams that the queries name; AND and OR over the postings leave the
candidates, and only those are verified by the expression. A rule from which
no mandatory trigram follows is run over every document.

Defined cases: a null text counts as empty; very long texts are searched whole; equal rows give equal results; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import re._constants
import re._parser
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import arrow_schema, id_and_text, slices

BLOCK_DOCS = 512


@dataclass(frozen=True)
class Rule:
    """``accept`` drops matches that fail it."""
    kind: str
    pattern: str
    ignore_case: bool = False
    accept: Callable[[re.Match], bool] = lambda m: True
    base: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


# The expressions of the base kinds, in their order, then further
# token formats.
RULES = (
    Rule("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
         True, lambda m: len(m[2]) >= 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", accept=lambda m: len(m[0]) >= 20, base=True),
    Rule("hex", r"[0-9a-f]{24,}", base=True),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

# A Boolean query: ALL (no demand), a trigram, or ("and" | "or", queries).
ALL = ("and", ())
MAX_LITERALS = 64


def both(*queries):
    left = [q for q in queries if q != ALL]
    return left[0] if len(left) == 1 else ("and", tuple(left))


def either(queries):
    return ALL if not queries or ALL in queries else ("or", tuple(queries))


def demand(literals: set[str]):
    """What holding one of the literals demands; nothing if one is short. A
    literal whose trigrams include all of another's adds nothing."""
    sets = {frozenset(w[i:i + 3] for i in range(len(w) - 2)) for w in literals}
    least = [x for x in sets if not any(y < x for y in sets)]
    return either([both(*sorted(x)) for x in sorted(least, key=sorted)])


def literals_of(op, value) -> set[str] | None:
    """All strings that one parsed item can match, if they are few."""
    if op is re._constants.LITERAL:
        return {chr(value)}
    if op is re._constants.IN and all(kind is re._constants.LITERAL for kind, _ in value):
        return {chr(c) for _, c in value}
    return None


def derive(items) -> tuple[set[str] | None, object]:
    """(all strings the items can match, if few; the query they demand).

    Neighbouring literals are joined across items, so that trigrams span them;
    where an item matches too much, the joined literals become a demand."""
    run, query, exact = {""}, ALL, True
    for op, value in items:
        words, inner = literals_of(op, value), ALL
        if op is re._constants.SUBPATTERN:
            words, inner = derive(value[-1])
        elif op is re._constants.BRANCH:
            parts = [derive(x) for x in value[1]]
            words = set().union(*(w for w, _ in parts)) if all(w is not None for w, _ in parts) else None
            inner = either([both(demand(w), q) if w is not None else q for w, q in parts])
        elif op in (re._constants.MAX_REPEAT, re._constants.MIN_REPEAT):
            least, most, sub = value
            words, inner = derive(sub)
            if words is None or (least, most) not in ((0, 1), (1, 1)):
                inner = both(inner, demand(words) if words is not None else ALL) if least else ALL
                words = None
            elif least == 0:
                words = words | {""}
        joined_up = {a + b for a in run for b in words} if words is not None else None
        if joined_up is not None and len(joined_up) <= MAX_LITERALS:
            run = joined_up
        else:
            query = both(query, demand(run), inner)
            run, exact = (words if words is not None else {""}), False
    return (run, ALL) if exact else (None, both(query, demand(run)))


def folded(query):
    if isinstance(query, str):
        return query.lower()
    return (query[0], tuple(folded(q) for q in query[1]))


def trigram_query(rule: Rule):
    """The trigrams that every match of the rule holds; ALL: scan every text."""
    words, query = derive(re._parser.parse(rule.pattern))
    query = demand(words) if words is not None else query
    return folded(query) if rule.ignore_case else query


def trigrams(query) -> set[str]:
    return {query} if isinstance(query, str) else {g for q in query[1] for g in trigrams(q)}


class Index:
    """Trigram -> documents of one block, for the named trigrams only. Rules
    that ignore case look at the lower-cased texts."""

    def __init__(self, texts: list[str], wanted: set[tuple[bool, str]]):
        self.size = len(texts)
        data = [t.encode() for t in texts]
        low = [d.lower() for d in data]  # bytes: A-Z only
        self.postings = {(fold, g): {i for i, d in enumerate(low if fold else data) if g.encode() in d}
                         for fold, g in wanted}

    def lookup(self, fold: bool, query) -> set[int]:
        if isinstance(query, str):
            return self.postings[fold, query]
        if query == ALL:
            return set(range(self.size))
        found = [self.lookup(fold, q) for q in query[1]]
        return set.union(*found) if query[0] == "or" else set.intersection(*sorted(found, key=len))


def spans_of(text: str, rule: Rule, pattern: re.Pattern) -> list[tuple[str, int, int]]:
    """Leftmost matches, one after another; those that fail are dropped."""
    return [(rule.kind, m.start(), m.end()) for m in pattern.finditer(text) if rule.accept(m)]


def joined(spans: list[tuple[str, int, int]], kinds: list[str]) -> str:
    """kind:start:end by start, then kind as listed."""
    return ",".join(f"{k}:{a}:{b}"
                    for k, a, b in sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2])))


def scan_secrets(docs: DataFrame, rules=RULES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: the number of matches of each base kind, a digest
    of the base spans, and all spans (code points, end exclusive)."""
    base = [r.kind for r in rules if r.base]
    ddl = ("doc_id bigint, " + ", ".join(f"n_{k} bigint" for k in base)
           + ", base_sha256 string, spans string, n_verified bigint")
    arrow = arrow_schema(ddl)
    kinds = [r.kind for r in rules]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans = [(r, r.compiled(), trigram_query(r)) for r in rules]
        wanted = {(r.ignore_case, g) for r, _, q in plans for g in trigrams(q)}
        for part in slices(batches, BLOCK_DOCS):
            texts = [t or "" for t in part.column(1).to_pylist()]
            index = Index(texts, wanted)
            spans, tried = [[] for _ in texts], [0] * len(texts)
            for rule, pattern, query in plans:
                for i in index.lookup(rule.ignore_case, query):
                    tried[i] += 1
                    spans[i] += spans_of(texts[i], rule, pattern)
            only = [[s for s in found if s[0] in base] for found in spans]
            cols = [part.column(0).to_pylist()]
            cols += [[sum(s[0] == k for s in found) for found in only] for k in base]
            cols += [[hashlib.sha256(joined(found, kinds).encode()).hexdigest() for found in only],
                     [joined(found, kinds) for found in spans], tried]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow)

    ids = id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return ids.mapInArrow(run, ddl)
