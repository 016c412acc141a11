"""Merkle manifests, conversation tries and fingerprints against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm import cws, merkle, trie
from tests.llm.conftest import edge_rows

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ---------------------------------------------------------------- merkle
def leaf(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [h(*nodes[k:k + 3]) for k in range(0, len(nodes), 3)]
        out.append(nodes)
    return out


def siblings(levels, p):
    out = []
    for nodes in levels[:-1]:
        start = p // 3 * 3
        out.append((nodes[start:p], nodes[p + 1:start + 3]))
        p //= 3
    return out


def manifest_rows(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    by_source = defaultdict(list)
    for d, *rest in rows:
        text = rest[-1]
        bare = text.replace("\n", "") if text and d is not None and zlib.crc32(str(d).encode()) % 2 == 0 else text
        by_source[rest[0]].append((d is not None, d or 0, leaf((d, *rest)), leaf((d, *rest[:-1], bare)), d))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for p, (_, _, own, tampered, d) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            proof = siblings(trees[s], p) + siblings(top, k)
            now = tampered
            for before, behind in proof:
                now = h(*before, now, *behind)
            out.append((d, own, trees[s][-1][0], top[-1][0], h(*[x for b, a in proof for x in b + a]), now,
                        now == top[-1][0]))
    return out


def document_rows(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_manifest(small, edge_docs, same):
    for df in (small[0], edge_docs):
        same([r[:7] for r in merkle.proof_report(df).collect()], manifest_rows(document_rows(df)))


def test_manifest_of_no_documents(empty_docs):
    assert merkle.proof_report(empty_docs).collect() == []


def test_lone_document(spark, same):
    rows = [(7, "a\nb", None, None, None)]
    got = merkle.proof_report(spark.createDataFrame(rows, DOC_SCHEMA)).collect()
    same([r[:7] for r in got], manifest_rows([(7, None, None, None, "a\nb")]))
    assert got[0]["leaf"] == got[0]["root"] and got[0]["proof_sha256"] == merkle.EMPTY


def hashed(spark, rows):
    return spark.createDataFrame(rows, "source string, doc_id bigint, leaf string")


def test_blocks_and_chunks_of_any_size(spark):
    """Trees of several rounds, chunks that cut runs, and proofs of any subset."""
    r = random.Random(3)
    rows = [("hot" if k % 3 == 0 else f"s{k % 11}", k, h(str(k))) for k in range(700)]
    m = merkle.manifest(hashed(spark, rows), levels=2)
    want = {}
    by_source = defaultdict(list)
    for s, d, x in rows:
        by_source[s].append((d, x))
    order = sorted(by_source)
    trees = {s: tree([x for _, x in sorted(by_source[s])]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    for k, s in enumerate(order):
        for p, (d, x) in enumerate(sorted(by_source[s])):
            want[d] = siblings(trees[s], p) + siblings(top, k)
    chosen = set(r.sample(range(700), 60))
    for keep in (None, chosen):
        wanted = m.leaves if keep is None else m.leaves.where(F.col("doc_id").isin(sorted(keep)))

        def row(values, own, proof, subroot, root):
            return values[0], [",".join(b) for b, _ in proof], [",".join(a) for _, a in proof], root
        got = merkle.prove(m, wanted, ["doc_id"], "doc_id bigint, before array<string>, behind array<string>, root string",
                           row, chunk=37).collect()
        assert {x["doc_id"] for x in got} == (keep or set(range(700)))
        for x in got:
            assert [(b.split(",") if b else [], a.split(",") if a else []) for b, a in zip(x["before"], x["behind"])] \
                == [(list(b), list(a)) for b, a in want[x["doc_id"]]]
            assert x["root"] == top[-1][0]
    assert merkle.proofs(m).count() == 700


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 26, 28, 81])
def test_multiproof_is_minimal_and_enough(n):
    r = random.Random(n)
    levels = tree([h(str(k)) for k in range(n)])
    for _ in range(20):
        known = sorted(r.sample(range(n), r.randrange(1, n + 1)))
        asked = merkle.missing(np.array(known), n)
        # nothing asked for stands on a known leaf's path, and nothing twice
        paths = {(lv, p // 3 ** lv) for p in known for lv in range(len(levels))}
        assert not set(asked) & paths and len(set(asked)) == len(asked)
        # each is needed: beside a path
        assert all(any((lv, q) in paths for q in range(p // 3 * 3, p // 3 * 3 + 3)) for lv, p in asked)
        got = merkle.derive({p: levels[0][p] for p in known}, {(lv, p): levels[lv][p] for lv, p in asked}, n)
        for p in known:
            proof = merkle.path(got, p, n)
            assert [(list(b), list(a)) for b, a in proof] == siblings(levels, p)
            assert merkle.fold(levels[0][p], proof) == levels[-1][0]
            assert merkle.fold(h("other"), proof) != levels[-1][0]


# ------------------------------------------------------------------ trie
def nodes_of(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            print128 = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, print128, len(text)))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        k = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(own.get(c - c % 100 if c >= 0 else c + -c % 100, [])[:k] + turns[k:])
    members, kids = defaultdict(list), defaultdict(set)
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
            if d:
                kids[s[:d - 1]].add(s[:d])
    sums, out = {}, []
    for s in sorted(members, key=len, reverse=True):
        below = [sums[k] for k in kids[s]]
        sums[s] = (sum(b[0] for b in below) if below else 1,
                   (len(members[s]) - 1) * (s[-1][1] if s else 0) + sum(b[1] for b in below))
    for s, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if rebuilt[c] == s)))
        out.append((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), len(kids[s]), *sums[s],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out


TURNS = "conv_id bigint, turn bigint, role string, text string"


def talk(seed, n, most, vocabulary):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        c = r.choice([c, c * 7, 100 * c, 5000 + c])
        rows += [(c, t, r.choice(["user", "assistant"]) if r.random() < .2 else "user", f"turn {r.randrange(vocabulary)}")
                 for t in range(r.randrange(1, most))]
    return rows


def edge_talk():
    rows = talk(1, 60, 7, 2)
    rows += [(c, t, "user", "hello") for c in range(300, 420) for t in range(1 + c % 3)]       # copies, prefixes
    rows += [(500, None, None, None), (500, 3, None, "x"), (500, 3, "", "x"), (500, 3, None, "x"), (500, -2, "user", None)]
    rows += [(None, 1, "user", "no id"), (None, None, None, None), (-5, 0, "user", "é\U0001F600"), (-250, 1, "u", "a")]
    rows += [(700, t, "user", f"long {t % 5}") for t in range(400)] + [(701, t, "user", f"long {t % 5}") for t in range(300)]
    return rows + [(700 + k, t, "user", f"long {t % 5}") for k in (0, 1) for t in (5, 5)] + [(800, 0, "user", "y" * 50_000)]


@pytest.mark.parametrize("long,shard", [(256, 4096), (4, 3), (2, 1), (100, 7)])
def test_trie(spark, same, long, shard):
    rows = edge_talk()
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    for c in ("cell", "pos", "n", "h", "first", "seq", "key", "path", "depth", "ends", "upper", "length"):
        df = df.withColumn(c, F.lit("input"))
    same(trie.trie(df, long, shard).collect(), nodes_of(rows))


def test_trie_of_the_smallest_scale(spark, same):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    same(trie.trie(df).collect(), nodes_of(rows))


def test_trie_blocks_of_long_paths(spark, same, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 16)
    rows = [(c, t, "u", f"{t * t % 7}" if t < 90 + c else f"{c}") for c in range(4) for t in range(60 + 40 * c)]
    same(trie.trie(spark.createDataFrame(rows, TURNS), 8, 2).collect(), nodes_of(rows))


def test_trie_of_nothing(spark):
    assert trie.trie(spark.createDataFrame([], TURNS)).collect() == []
    assert trie.trie(spark.createDataFrame([(None, 1, "a", "b")], TURNS)).collect() == []


def test_turnless_conversations(spark, same):
    rows = [(c, 0, "u", "only") for c in range(1, 30)]        # no first conversation, one turn each
    got = trie.trie(spark.createDataFrame(rows, TURNS)).collect()
    same(got, nodes_of(rows))
    assert len(got) == 2


def test_double_array_holds_exactly_the_sequences():
    r = random.Random(4)
    seqs = sorted({tuple(r.randrange(1, 40) for _ in range(r.randrange(0, 6))) for _ in range(500)})
    codes = np.array([c for s in seqs for c in s], np.int64)
    length = np.array([len(s) for s in seqs], np.int64)
    base, check = trie.packed(codes, np.cumsum(length) - length, length)
    prefixes = {s[:d] for s in seqs for d in range(len(s) + 1)}

    def find(s):
        node = 0
        for c in s:
            t = base[node] + c
            if not 0 < t < len(check) or check[t] != node:
                return None
            node = t
        return node
    found = {p: find(p) for p in prefixes}
    assert None not in found.values() and len(set(found.values())) == len(prefixes)
    assert sum(check != trie.FREE) == len(prefixes)
    for _ in range(2000):
        s = tuple(r.randrange(1, 45) for _ in range(r.randrange(1, 6)))
        assert s in prefixes or find(s) is None or len(base) <= find(s)


# ---------------------------------------------------------- fingerprints
def weighted(text, width=cws.WIDTH):
    w = [x.lower() for x in (text or "").encode().split()]
    k = min(width, len(w))
    return Counter(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if w else Counter()


def jaccard(a, b):
    a, b = weighted(a), weighted(b)
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def edit_rows(rows):
    s = cws.Sampler()
    rows = sorted(((i is not None, i or 0, hashlib.md5((t or "").encode()).hexdigest(), i, t or "") for i, t in rows))
    out = []
    for k, (*_, i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][-1]
        q = len(t) // 4
        edited = t[:len(t) - q] + nxt[:q]
        a, b, c = (cws.fingerprint_of(s, x) for x in (t, edited, nxt))
        out.append((i, len(t), h(edited), cws.as_text(a), cws.as_text(b), cws.likeness(a, b), cws.likeness(a, c)))
    return out


def test_edit_report(small, edge_docs, edges, same):
    for df, rows in (small, (edge_docs, edges)):
        same(cws.edit_report(df).collect(), edit_rows(rows))


@pytest.mark.parametrize("repeats,range_bytes", [(2, 1 << 25), (10_000, 400), (3, 100)])
def test_edit_report_in_many_ranges_with_repeated_rows(spark, same, repeats, range_bytes):
    rows = [(k, f"text of {k} " * (k % 9)) for k in range(60)] + [(5, "same row here")] * 40 + [(None, "null id")] * 30
    rows += [(5, f"shared id {k}") for k in range(4)] + [(59, None), (59, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    same(cws.edit_report(df, repeats=repeats, range_bytes=range_bytes).collect(), edit_rows(rows))


def test_edit_report_of_few_documents(spark, empty_docs, same):
    assert cws.edit_report(empty_docs).collect() == []
    for rows in ([(1, "one two three four five six seven")], [(1, None)], [(2, "b c"), (1, "a")]):
        same(cws.edit_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect(), edit_rows(rows))


def test_fingerprints_map_only(small):
    df, rows = small
    got = {r[0]: r[1] for r in cws.fingerprints(df).collect()}
    s = cws.Sampler()
    assert got == {i: cws.as_text(cws.fingerprint_of(s, t or "")) for i, t in rows}


def test_collisions_estimate_generalised_jaccard():
    """Over 4,096 samples the share of equal ones is within four deviations."""
    s = cws.Sampler(samples=4096)
    r = random.Random(9)
    for case in range(12):
        a = [f"w{r.randrange(30 if case % 2 else 3000)}" for _ in range(250)]
        if case % 3 == 0:
            a = a[:40] * 5              # weights above 1
        b = a[:r.randrange(60, 200)] + [f"v{r.randrange(30)}" for _ in range(r.randrange(150))] + a[:r.randrange(80)]
        want = jaccard(" ".join(a), " ".join(b))
        got = cws.likeness(*(cws.fingerprint_of(s, " ".join(x)) for x in (a, b)))
        assert abs(got - want) < 4 * (max(want * (1 - want), .01) / 4096) ** .5, (case, got, want)


def test_edge_rows_have_what_the_docstrings_name():
    texts = [t for _, t, *_ in edge_rows()]
    assert None in texts and "" in texts and max(len(t or "") for t in texts) > 50_000
