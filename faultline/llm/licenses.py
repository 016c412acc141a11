"""License notices, exact and fuzzy.

Texts are lower-cased (A-Z) and cut to words of digits, letters and all
non-ASCII characters; words are joined by one space. The exact ("base") places
are those where a phrase's words stand consecutively. The fuzzy search allows
up to k character errors per notice. By the pigeonhole principle, if a notice
is cut to k + 1 pieces, a match with at most k errors holds one piece exactly:
an Aho-Corasick automaton finds all pieces in one pass, each hit places a
window around the notice's possible position, and the ``regex`` library's
bounded-error matching verifies the window and reports the span and its errors.
Each window is searched by itself; of overlapping matches of a notice the one
with fewest errors stands. The words that tell a licence from its neighbours
(marked ``[...]`` in a notice) must stand exactly: errors count elsewhere only.

Defined cases: a null text counts as empty (no words, no labels, score 0);
equal rows give equal results; very long texts are searched whole, in one pass
and windows of a notice's length; an empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass

import ahocorasick
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import id_and_text, map_rows

# The exact phrases and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)


@dataclass(frozen=True)
class Notice:
    """``form``: the notice in normal form; words in ``[...]`` allow no errors."""

    form: str
    label: str
    errors: int

    @property
    def text(self) -> str:
        return self.form.replace("[", "").replace("]", "")

    def pattern(self) -> regex.Pattern:
        parts = regex.split(r"\[(.*?)\]", self.form)      # free, exact, free, exact, ...
        out = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(rf"\b{regex.escape(part)}\b")
            elif part:
                out.append(f"(?:{regex.escape(part)}){{e<={self.errors}}}")
        return regex.compile("(?b)" + "".join(out))


# Short license notices in the normal form, with allowed errors.
NOTICES = (
    Notice("under the [mit] license", "mit", 2),
    Notice("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6),
    Notice("licensed under the [apache] license version [2] 0", "apache-2", 4),
    Notice("licensed under [cc] [by] [nc] 4 0", "cc-by-nc", 1),
    Notice("creative commons attribution [noncommercial]", "cc-by-nc", 3),
    Notice("creative commons attribution [non commercial]", "cc-by-nc", 3),
    Notice("licensed under the gnu [general] public license version [3]", "gpl-3", 4),
    Notice("under the terms of the gnu [lesser] general public license", "lgpl", 4),
    Notice("redistribution and use in source and binary forms", "bsd", 4),
    Notice("subject to the terms of the [mozilla] public license", "mpl", 4),
)

_SEPARATORS = bytes(b for b in range(0x80) if not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A
                                                   or 0x61 <= b <= 0x7A))
_NORMAL = bytes.maketrans(_SEPARATORS + bytes(range(0x41, 0x5B)),
                          b" " * len(_SEPARATORS) + bytes(range(0x61, 0x7B)))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return (text or "").encode().translate(_NORMAL).split()


def pieces(notice: Notice) -> list[tuple[int, str]]:
    """(offset, piece): the notice cut to ``errors`` + 1 pieces of like length."""
    n, k = len(notice.text), notice.errors + 1
    cuts = [i * n // k for i in range(k + 1)]
    return [(a, notice.text[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """The automaton over all pieces and one bounded-error pattern a notice."""

    def __init__(self, notices=NOTICES, phrases=PHRASES):
        self.notices, self.phrases = notices, phrases
        self.automaton, seeds = ahocorasick.Automaton(), {}
        for i, notice in enumerate(notices):
            for offset, piece in pieces(notice):
                seeds.setdefault(piece, []).append((i, offset))
        for piece, uses in seeds.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()
        self.patterns = [n.pattern() for n in notices]

    def exact(self, line: str, starts: list[int]) -> list[tuple[int, str]]:
        """(first word, label) of each exact place in ``' ' + words + ' '``."""
        found = []
        for phrase, label in self.phrases:
            at = line.find(f" {phrase} ")
            while at >= 0:
                found.append((bisect_left(starts, at + 1), label))
                at = line.find(f" {phrase} ", at + 1)
        return found

    def fuzzy(self, line: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, errors) of the verified matches. A match has an
        exact piece, whose window holds it whole; every window is searched for
        its best match, and of overlapping ones the better stands."""
        windows: dict[int, set[tuple[int, int]]] = {}
        for last, (length, uses) in self.automaton.iter(line):
            first = last - length + 1
            for i, offset in uses:
                n = self.notices[i]
                windows.setdefault(i, set()).add((max(0, first - offset - n.errors),
                                                  min(len(line), first - offset + len(n.text) + n.errors)))
        found = []
        for i, spans in windows.items():
            matches = set()
            for a, b in spans:
                m = self.patterns[i].search(line, a, b)
                if m and sum(m.fuzzy_counts) <= self.notices[i].errors:
                    matches.add((sum(m.fuzzy_counts), m.start(), m.end()))
            taken: list[tuple[int, int]] = []
            for errors, a, b in sorted(matches):
                k = bisect_left(taken, (a, b))
                if (k == 0 or taken[k - 1][1] <= a) and (k == len(taken) or b <= taken[k][0]):
                    taken.insert(k, (a, b))
                    found.append((i, a, b, errors))
        return sorted(found)

    def scan(self, text: str | None) -> dict:
        words = words_of(text)
        line = " " + b" ".join(words).decode() + " " if words else ""
        fuzzy = self.fuzzy(line) if line else []
        starts: list[int] = []
        if line and (fuzzy or any(f" {p} " in line for p, _ in self.phrases)):
            at = 1
            for w in line[1:-1].split(" "):
                starts.append(at)
                at += len(w) + 1
        base = self.exact(line, starts) if starts else []
        spans, score = [], 1.0 if base else 0.0
        for i, a, b, errors in fuzzy:
            n = self.notices[i]
            first, last = max(0, bisect_right(starts, a) - 1), max(0, bisect_left(starts, b) - 1)
            spans.append((first, last, n.label, errors))
            score = max(score, 1.0 - errors / len(n.text))
        return {"n_words": len(words), "base": sorted(base), "spans": sorted(set(spans)),
                "score": score}


def scan_licenses(docs: DataFrame, notices=NOTICES, phrases=PHRASES, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: exact places, labels, fuzzy spans
    (``label:first word:last word:errors``) and the best score."""
    def row(scanner, doc_id, text):
        got = scanner.scan(text)
        base = sorted({label for _, label in got["base"]})
        labels = sorted({*base, *(s[2] for s in got["spans"])})
        at = [first for first, _ in got["base"]]
        return (doc_id, got["n_words"], len(at), min(at, default=None), max(at, default=None),
                ",".join(base), ",".join(labels), got["score"],
                ",".join(f"{label}:{a}:{b}:{e}" for a, b, label, e in got["spans"]))

    ids = id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return map_rows(ids, row, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, "
                    "last_word bigint, base_labels string, labels string, score double, "
                    "spans string", ["doc_id", "text"], lambda: Scanner(notices, phrases))
