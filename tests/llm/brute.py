"""Brute-force versions of the operators' contracts, on lists of (doc_id, text)."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def quality(rows):
    out = []
    for i, t in rows:
        t = t or ""
        w = WORD.findall(t)
        grams = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
        hit = [0] * len(w)
        for k in range(len(w) - 7):
            if grams[tuple(w[k:k + 8])] > 1:
                hit[k:k + 8] = [1] * 8
        seen, dup = set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        r = sum(hit)
        out.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, r,
                    len(w) < 20 or 100 * r > 30 * len(w)))
    return out


def tokens(rows, encode):
    """encode(text) -> ids, without the end id."""
    made = [(i, np.array(encode(t or "") + [0], "<u4")) for i, t in rows]
    made.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].astype("<u2").tobytes()))
    out, at = [], 0
    for i, ids in made:
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))


def licenses(rows):
    out = []
    for i, t in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
        at = [(k, label) for p, label in PHRASES for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        out.append((i, len(w), len(at), min((k for k, _ in at), default=None),
                    max((k for k, _ in at), default=None), ",".join(sorted({x for _, x in at}))))
    return out


def repeats(rows, length=200):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(d[p:p + length] for _, d in data for p in range(len(d) - length + 1))
    out = []
    for i, d in data:
        mark = bytearray(len(d))
        for p in range(len(d) - length + 1):
            if seen[d[p:p + length]] > 1:
                mark[p:p + length] = b"\1" * length
        keep = bytes(b for b, m in zip(d, mark) if not m)
        spans = sum(1 for k in range(len(d)) if mark[k] and (k == 0 or not mark[k - 1]))
        out.append((i, len(d), sum(mark), spans, hashlib.sha256(keep).hexdigest()))
    return out


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def only_digits(s):
    return re.sub("[^0-9]", "", s)


PII = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+",
     lambda m: 12 <= len(only_digits(m[0])) <= 19 and luhn(only_digits(m[0]))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(only_digits(m[0])) <= 15),
)
SECRETS = (
    ("assign", r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"
     r"[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
     lambda m: len(m[2]) >= 6),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
)


def spans(rows, kinds):
    """(doc_id, matches per kind..., digest of the spans)."""
    out = []
    for i, t in rows:
        found, n = [], [0] * len(kinds)
        for k, (name, pattern, good) in enumerate(kinds):
            for m in re.finditer(pattern, t or ""):
                if good(m):
                    found.append((m.start(), k, name, m.end()))
                    n[k] += 1
        text = ",".join(f"{name}:{a}:{b}" for a, _, name, b in sorted(found))
        out.append((i, *n, hashlib.sha256(text.encode()).hexdigest()))
    return out


def word_scores(rows):
    tok = [(i, [*WORD.findall((t or "").translate(LOW)), None]) for i, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    c = Counter(w for (_, ws), h in zip(tok, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, h, len(ws), sum(c[w] > 0 for w in ws), n,
             sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for (i, ws), h in zip(tok, held)]


def components(rows, width, percent):
    """(doc_id, number of shingles, smallest doc_id reached)."""
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOW))
        sets.append(frozenset(tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset())
    where = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            where[x].append(k)
    both = Counter((a, b) for ks in where.values() for n, a in enumerate(ks) for b in ks[n + 1:])
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in both.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return [(i, len(s), least.get(root(k))) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """{source: (words, target)} by resharing what is cut until none is above."""
    total = Counter()
    for source, n in sizes:
        total[source] += n
    order = sorted(s for s in total if s is not None) + [None] * (None in total)
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, left, active = {}, share * sum(total.values()), set(total)
    while active:
        whole = sum(w[s] for s in active)
        now = {s: left * w[s] / whole for s in active}
        over = [s for s in active if now[s] > most * total[s]]
        if not over:
            target.update(now)
            break
        for s in over:
            target[s] = most * total[s]
            left -= target[s]
            active.remove(s)
    return {s: (total[s], target[s]) for s in total}
