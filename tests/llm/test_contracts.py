"""Each operator against brute force, on the smallest scale and on edge cases."""

import math
import random

import numpy as np
import pytest

from faultline.llm import graph, licenses, lm, mixing, ngram_join, pii, quality, queries, secret_scan, suffix, tokens
from faultline.llm.common import shared_path
from tests.llm import brute

VOCABULARY = "byte_bpe_50k.json"


@pytest.fixture(scope="module", params=["small", "edges"])
def data(request, small, edge_docs, edges):
    return small if request.param == "small" else (edge_docs, edges)


def test_quality(data, same):
    df, rows = data
    got = quality.quality_report(df).collect()
    same([r[:7] for r in got], brute.quality(rows))
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_tokens(spark, data, same):
    import public_tokenizers
    from tokenizers import Tokenizer

    df, rows = data
    t = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    path = shared_path(spark, "test-tokens")
    tokens.write_tokens(df, path, public_tokenizers.path(VOCABULARY), shards=3)
    same(tokens.token_digest(spark, path).collect(),
         brute.tokens(rows, lambda s: t.encode(s, add_special_tokens=False).ids))


def test_licenses(data, same):
    df, rows = data
    same([r[:6] for r in licenses.scan_licenses(df).collect()], brute.licenses(rows))


def test_suffix(data, same):
    df, rows = data
    same(suffix.cut_report(df).collect(), brute.repeats(rows))


def test_suffix_crowded_cores(data, same):
    """Cores with more contexts than the bound take the windows' way."""
    df, rows = data
    same(suffix.cut_report(df, most_contexts=1).collect(), brute.repeats(rows))


def test_pii(data, same):
    df, rows = data
    same([r[:6] for r in pii.pii_report(df).collect()], brute.spans(rows, brute.PII))


def test_secrets(data, same):
    df, rows = data
    same([r[:5] for r in secret_scan.scan_secrets(df).collect()], brute.spans(rows, brute.SECRETS))


@pytest.mark.parametrize("width,percent,block", [(3, 90, 512), (5, 80, 2)])
def test_ngram_join(data, same, width, percent, block):
    df, rows = data
    same(ngram_join.join_report(df, width, percent, block=block).collect(), brute.components(rows, width, percent))


def test_ngram_join_of_many_near_copies(spark, same):
    """Copies with few and with many changed words: blocks meet in pairs."""
    r = random.Random(2)
    base = [f"b{k}" for k in range(90)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(r.randrange(12)):
            w[r.randrange(90)] = f"x{r.randrange(4)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for width, percent in ((3, 90), (3, 60), (5, 80)):
        same(ngram_join.join_report(df, width, percent, block=16).collect(), brute.components(rows, width, percent))


def test_ngram_join_verifies_no_chains_of_shared_passages(spark, same, monkeypatch):
    """Texts that share half their words with the next one are no candidates."""
    r = random.Random(4)
    part = [" ".join(r.choices([f"w{k}" for k in range(2000)], k=60)) for _ in range(301)]
    rows = [(i, f"{part[i]} {part[i + 1]}") for i in range(300)] + [(1000 + i, f"{part[i]} {part[i + 1]} end") for i in range(20)]
    seen, keep = [], ngram_join.components

    def components(edges, name):
        got = keep(edges, name)
        seen.extend([r["node"] for r in got.collect()] if name == "join-candidates" else [])
        return got

    monkeypatch.setattr(ngram_join, "components", components)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    same(ngram_join.join_report(df, 3, 90).collect(), brute.components(rows, 3, 90))
    assert len(seen) == 40


@pytest.mark.parametrize("percent", [100, 90, 80, 60])
def test_ngram_join_candidates_lose_no_link(spark, percent):
    """Sets of many sizes around those where bitmaps get wider, lists cut by size and to blocks."""
    r = random.Random(percent)
    rows, base = [], [f"b{k}" for k in range(700)]
    for i, n in enumerate([5, 60, 230, 250, 258, 270, 300, 480, 515, 540, 640] * 12):
        w = base[:n]
        for _ in range(r.randrange(1 + n // 20)):
            w[r.randrange(n)] = f"x{r.randrange(50)}"
        rows.append((i, " ".join(w)))
    sets = {i: set(ngram_join.shingles(t, 2).tolist()) for i, t in rows}
    linked = [(a, b) for a in sets for b in sets if a < b
              and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    classes = ngram_join.classes(df, 2, percent, ngram_join.EXTEND).cache()
    name = {x["doc_id"]: x["class"] for x in classes.collect()}
    for most in (4, 1024):
        got = dict(map(tuple, graph.components(ngram_join.candidates(classes, percent, ngram_join.EXTEND, most), "t").collect()))
        assert linked and all(got.get(name[a], name[a]) == got.get(name[b], name[b]) for a, b in linked)


def test_ngram_join_compares_alike_one_by_one_and_in_arrays(monkeypatch):
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 63, 700, np.uint64)
    sets = [np.unique(np.append(base[:n - k], r.integers(0, 1 << 63, k, np.uint64)))
            for n in [3, 200, 250, 256, 258, 280, 500, 513, 560] for k in [0, 1, n // 12, n // 6] * 3]
    size, bits = np.array([len(s) for s in sets]), [ngram_join.bitmap(s) for s in sets]
    for percent in (60, 80, 90, 100):
        groups = []
        for few in (0, len(sets)):
            monkeypatch.setattr(ngram_join, "FEW", few)
            label = list(range(len(sets)))
            for a, b in ngram_join.alike(size, bits, percent):
                label = [label[a] if x == label[b] else x for x in label]
            groups.append({frozenset(i for i, x in enumerate(label) if x == y) for y in label})
        assert groups[0] == groups[1] and 1 < len(groups[0]) < len(sets)


def test_distinct_documents(data):
    df, rows = data
    want = {i for i, _, c in brute.components(rows, 5, 80) if i == c}
    kept = ngram_join.distinct_documents(df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, want))


def test_distinct_documents_without_unique_ids(spark):
    """Documents go by similarity: neither a null nor a shared doc_id removes a clean text."""
    r = random.Random(8)
    text = {c: " ".join(r.choices([f"w{k}" for k in range(300)], k=100)) for c in "ABCDEFGH"}
    near = {c: t + " tail" for c, t in text.items()}
    rows = [(None, text["A"]), (None, text["B"]), (None, text["C"]), (None, text["A"]),
            (1, text["D"]), (1, text["E"]), (2, near["D"]), (None, near["D"]),
            (3, text["F"]), (4, near["F"]), (4, text["G"]), (4, text["G"]),
            (None, None), (None, ""), (None, ""), (5, ""), (5, " ")]
    want = [(None, text["A"]), (None, text["B"]), (None, text["C"]), (1, text["D"]), (1, text["E"]),
            (3, text["F"]), (4, text["G"]), (None, None), (None, ""), (5, ""), (5, " ")]
    one = [(6, text["H"]), (6, near["H"]), (6, text["H"].upper())]
    df = spark.createDataFrame(rows + one, "doc_id bigint, text string")
    got = [sorted(map(tuple, ngram_join.distinct_documents(df.repartition(n)).collect()), key=repr) for n in (1, 5)]
    assert [x for x in got[0] if x[0] != 6] == sorted(want, key=repr)
    # of near copies under one id exactly one stays, the same one each time
    assert sum(x[0] == 6 for x in got[0]) == 1 and got[0] == got[1]


def by_id(rows):
    return sorted(rows, key=lambda r: tuple(map(repr, r)))


@pytest.mark.parametrize("most_rows", [10_000_000, 0])
def test_lm_counts_and_base(data, most_rows):
    """Both lookup ways give the contract's counts and scores."""
    df, rows = data
    got = by_id(tuple(r)[:6] for r in lm.score_texts(df, depth=2, most_rows=most_rows).collect())
    want = by_id(brute.word_scores(rows))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)


def test_lm_joins_only_what_is_not_broadcast(data, monkeypatch):
    """Of tables that are too large the commonest rows are broadcast; only other words and grams are shuffled."""
    df, rows = data
    want = by_id(lm.score_texts(df, depth=2).collect())
    scored, keep = [], lm.stored

    def stored(out, name):
        out = keep(out, name)
        scored.extend(out.collect() if name == "lm-scored" else [])
        return out

    monkeypatch.setattr(lm, "stored", stored)
    monkeypatch.setattr(lm, "COMMON", 40)
    got = by_id(lm.score_texts(df, depth=2, most_rows=50).collect())
    assert [r[:5] for r in got] == [r[:5] for r in want] and [r[7] for r in got] == [r[7] for r in want]
    assert np.allclose([r[5:7] for r in got], [r[5:7] for r in want], rtol=1e-9)
    rest = {w for r in scored for w in r["words"]}
    every = {w for _, t in rows for w in lm.raw(t).decode().split()} | {""}
    assert len(scored) == len(rows) and rest and rest < every and any(r["grams"] for r in scored)


def sequential_ctw(texts, depth):
    """Node counts of all contexts, as plain dictionaries."""
    count = {}
    for t in texts:
        past = bytes(depth)
        for byte in t + b"\0":
            for d in range(depth + 1):
                context, node = past[:d], 1
                for k in range(7, -1, -1):
                    bit = byte >> k & 1
                    count.setdefault((context, node), [0, 0])[bit] += 1
                    node = node * 2 + bit
            past = (bytes([byte]) + past)[:depth]
    return count


def ctw_score(count, depth, text):
    def ln_kt(a, b):
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1)

    memo = {}
    children = {}
    for context, node in count:
        if context:
            children.setdefault((context[:-1], node), []).append((context, node))

    def ln_w(key):
        if key not in memo:
            own = ln_kt(*count[key])
            if len(key[0]) == depth:
                memo[key] = own
            else:
                below = sum(ln_w(c) for c in children.get(key, ()))
                top = max(own, below)
                memo[key] = math.log(.5) + top + math.log(math.exp(own - top) + math.exp(below - top))
        return memo[key]

    def p_one(past, node, d):
        a, b = count.get((past[:d], node), (0, 0))
        kt = (b + .5) / (a + b + 1)
        if d == depth or (past[:d], node) not in count:
            return kt if d == depth else .5
        w = math.exp(math.log(.5) + ln_kt(a, b) - ln_w((past[:d], node)))
        return w * kt + (1 - w) * p_one(past, node, d + 1)

    total, past = 0.0, bytes(depth)
    for byte in text + b"\0":
        node = 1
        for k in range(7, -1, -1):
            bit = byte >> k & 1
            p = p_one(past, node, 0)
            total += math.log10(p if bit else 1 - p)
            node = node * 2 + bit
        past = (bytes([byte]) + past)[:depth]
    return total


@pytest.mark.parametrize("most_rows", [10_000_000, 0])
def test_lm_model_is_context_tree_weighting(spark, most_rows):
    rows = [(i, t) for i, t in enumerate(["Abra abra cadabra", "abra", "", "cad abra!", "braid bra", "zebra é", "abra cad"])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in lm.score_texts(df, depth=2, most_rows=most_rows).collect()}
    count = sequential_ctw([lm.raw(t) for i, t in rows if not got[i]["held_out"]], 2)
    for i, t in rows:
        assert math.isclose(got[i]["score"], ctw_score(count, 2, lm.raw(t)), rel_tol=1e-9), t
        assert got[i]["n_bytes"] == len(t.encode()) + 1


def test_lm_query_mixes_contexts_of_five_bytes(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(["the abbot of the abbey", "abbey abbots", "", "an abbot", "the abbey é"])]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op7_lm_scoring(spark, str(tmp_path)).collect()}
    count = sequential_ctw([lm.raw(t) for i, t in rows if not got[i]["held_out"]], 5)
    for i, t in rows:
        assert math.isclose(got[i]["score"], ctw_score(count, 5, lm.raw(t)), rel_tol=1e-9), t


def test_lm_beats_bytes_on_held_out_text(small):
    df, _ = small
    got = [r for r in lm.score_texts(df).collect() if r["held_out"]]
    bits = -sum(r["score"] for r in got) / math.log10(2) / sum(r["n_bytes"] for r in got)
    assert bits < 3.0


def test_mixing(data):
    df, rows = data
    size = [len(brute.WORD.findall(t or "")) for _, t in rows]
    got = mixing.mix_report(df).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted((str(i), n) for (i, _), n in zip(rows, size))
    source = {(r[0], r[2]): r[1] for r in df.select("doc_id", "source", "text").collect()}
    want = brute.targets([(source[i, t], n) for (i, t), n in zip(rows, size)])
    assert sorted({(r["source_size"], round(r["target"], 6)) for r in got}) == sorted(
        {(n, round(t, 6)) for n, t in want.values()})
    by_source = {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        by_source.setdefault((r["source_size"], r["target"]), []).append(r)
    for (_, target), rs in by_source.items():
        assert abs(sum(r["taken"] for r in rs) - target) <= max(r["size"] for r in rs) + 1e-6
    again = mixing.mix_report(df.repartition(7)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_mixed_rows_follow_the_report(data):
    df, _ = data
    taken = {}
    for r in mixing.mix_report(df).collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["copies"]
    out = mixing.mixed(df)
    assert out.columns == df.columns
    rows = {}
    for r in out.select("doc_id").collect():
        rows[r[0]] = rows.get(r[0], 0) + 1
    assert rows == {k: n for k, n in taken.items() if n}


def test_mixing_is_unbiased(spark):
    """Over many seeds, every document is taken as often as its rate says."""
    from pyspark.sql import functions as F

    rows = [(i, "s0" if i < 30 else "s1", 5 + i * 7 % 40) for i in range(60)]
    sizes = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint")
    t = mixing.source_targets(sizes).cache()
    total = None
    for seed in range(100, 130):
        one = mixing.mix(sizes, t, seed, chunk=8).select("doc_id", "taken_copies", F.lit(seed).alias("s"))
        total = one if total is None else total.union(one)
    mean = {r[0]: r[1] for r in total.groupBy("doc_id").agg(F.avg("taken_copies")).collect()}
    rate = {r["source"]: r["rate"] for r in t.collect()}
    for i, s, _ in rows:
        assert abs(mean[i] - rate[s]) < 0.4
