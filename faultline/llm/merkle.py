"""Merkle manifest of a dataset, proven by octopus multiproofs.

Each row is a leaf: the SHA-256 of its fields, each ``-`` if null, else its
UTF-8 byte count, ``:`` and its value. The leaves of a source ascend by
doc_id; every FANOUT consecutive nodes (the last run: fewer, even one) become
their hash until one is left, the subroot. The subroots, by source (null
first, bytewise), become the root in the same way.

``manifest`` numbers the leaves by a range sort (no window over a source) and
builds the trees in blocks of FANOUT**LEVELS nodes: one shuffle for LEVELS
levels, and no task holds more than a block. ``prove`` takes any subset of the
leaves. A leaf partition is a chunk of CHUNK places of one source: it computes
the minimal set of coordinates that its leaves cannot derive, over its source's
tree and the tree of subroots (an octopus multiproof); these nodes are fetched
by one join; the chunk derives every shared interior once and expands each
leaf's own proof from them.

Defined cases. A null doc_id comes first, and rows that share a doc_id stand
by leaf hash, so equal rows may stand in any order and results do not change.
Null fields are ``-``, so null and empty differ. A lone leaf is its own
subroot, a lone subroot the root; without siblings ``proof_sha256`` is the
hash of nothing. Very long texts are hashed inside the scan and never
shuffled: only digests move. A source with a third of all rows is cut into
blocks and chunks like any other. An empty table has no leaf and gives no row.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import arrow_schema, stored
from faultline.llm.order import numbers, places

FANOUT = 3
LEVELS = 8                      # levels that one shuffle builds: blocks of 6,561 nodes
CHUNK = 8192                    # leaves of a partition that proves together
TOP = -1                        # the tree of subroots
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
EMPTY = hashlib.sha256(b"").hexdigest()


class Manifest(NamedTuple):
    """``leaves``: doc_id, source, leaf, tree, pos, n (leaves of the tree), and
    columns kept beside them. ``nodes``: tree, level, pos, n (nodes of the tree
    on that level), hash; leaves are level 0. Tree TOP has the subroots as
    leaves, at their tree's number."""

    leaves: DataFrame
    nodes: DataFrame
    n_trees: int


def joined_hash(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_hash(*values: Column) -> Column:
    """The hash of a row's fields, read as strings."""
    def field(c: Column) -> Column:
        s = c.cast("string")
        return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def numbered(leaves: DataFrame) -> DataFrame:
    """``leaves`` (source, doc_id, leaf, ...) with tree, pos and n, stored."""
    def with_tree(spans: DataFrame) -> DataFrame:
        trees = numbers(spans, "source", "merkle-sources", "tree").withColumnRenamed("source", "_s")
        return spans.join(trees, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    return places(leaves, "source", ["doc_id", "leaf"], "merkle-leaves", with_tree)


NODE = "tree bigint, level bigint, pos bigint, n bigint, hash string"


def build_block(fanout: int, levels: int):
    """Rows of one block (consecutive nodes of one tree and level, whole runs
    of every level above) -> the nodes of the next ``levels`` levels."""
    schema = arrow_schema(NODE)

    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by("pos")
        tree, level, n = (block.column(c)[0].as_py() for c in ("tree", "level", "n"))
        start, hashes = block.column("pos")[0].as_py(), block.column("hash").to_pylist()
        rows: list[tuple] = []
        for _ in range(levels):
            if n == 1:
                break
            hashes = [joined_hash(hashes[k:k + fanout]) for k in range(0, len(hashes), fanout)]
            start, n, level = start // fanout, -(-n // fanout), level + 1
            rows += [(tree, level, start + k, n, h) for k, h in enumerate(hashes)]
        columns = list(zip(*rows)) if rows else [()] * len(schema)
        return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)
    return run


def build(base: DataFrame, most: int, name: str, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """All nodes over ``base`` (tree, level, pos, n, hash), with it. ``most``:
    nodes of the largest tree, which gives the number of rounds."""
    width = fanout ** levels
    out = front = base
    rounds = 0
    while most > 1:
        made = stored(front.where("n > 1").withColumn("block", F.expr(f"pos div {width}"))
                      .groupBy("tree", "block").applyInArrow(build_block(fanout, levels), NODE), f"{name}-{rounds}")
        out = out.unionByName(made)
        rounds += 1
        front = made.where(F.col("level") == rounds * levels)
        most = -(-most // width)
    return out


def manifest(leaves: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> Manifest:
    """``leaves``: source, doc_id, leaf and any columns to keep beside them."""
    rows = numbered(leaves)
    most, trees = rows.agg(F.max("n"), F.max("tree")).first()
    base = rows.select("tree", F.lit(0).cast("bigint").alias("level"), "pos", "n", F.col("leaf").alias("hash"))
    nodes = build(base, most or 0, "merkle-nodes", fanout, levels)
    n_trees = 0 if trees is None else trees + 1
    tops = nodes.where("n = 1").select(F.lit(TOP).cast("bigint").alias("tree"), F.lit(0).cast("bigint").alias("level"),
                                       F.col("tree").alias("pos"), F.lit(n_trees).cast("bigint").alias("n"), "hash")
    tops = build(stored(tops, "merkle-tops"), n_trees, "merkle-top-nodes", fanout, levels)
    return Manifest(rows, nodes.unionByName(tops), n_trees)


def missing(known: np.ndarray, n: int, fanout: int = FANOUT) -> list[tuple[int, int]]:
    """Coordinates (level, pos) of the nodes which the leaves at the places
    ``known`` of a tree of n leaves need and cannot derive: per level, the
    members of the known nodes' runs that are not known themselves."""
    out, level = [], 0
    known = np.unique(known)
    while n > 1:
        runs = np.unique(known // fanout)
        members = (runs[:, None] * fanout + np.arange(fanout)).ravel()
        out += [(level, int(p)) for p in np.setdiff1d(members[members < n], known)]
        known, n, level = runs, -(-n // fanout), level + 1
    return out


def derive(leaves: dict[int, str], fetched: dict[tuple[int, int], str], n: int, fanout: int = FANOUT) -> list[dict]:
    """Per level, the hashes of all nodes on the leaves' paths and beside them."""
    levels = [dict(leaves)]
    for (level, p), h in fetched.items():
        while len(levels) <= level:
            levels.append({})
        levels[level][p] = h
    level, path = 0, sorted(leaves)
    while n > 1:
        if len(levels) <= level + 1:
            levels.append({})
        now, up = levels[level], levels[level + 1]
        path = sorted({p // fanout for p in path})
        for r in path:
            up[r] = joined_hash([now[p] for p in range(r * fanout, min(n, (r + 1) * fanout))])
        n, level = -(-n // fanout), level + 1
    return levels


def path(levels: list[dict], p: int, n: int, fanout: int = FANOUT) -> list[tuple[list[str], list[str]]]:
    """A leaf's proof: per level, the siblings before it and those behind it."""
    out, level = [], 0
    while n > 1:
        start, now = p // fanout * fanout, levels[level]
        out.append(([now[q] for q in range(start, p)], [now[q] for q in range(p + 1, min(n, start + fanout))]))
        p, n, level = p // fanout, -(-n // fanout), level + 1
    return out


def fold(leaf: str, proof: list[tuple[list[str], list[str]]]) -> str:
    """The root that a leaf and its proof lead to."""
    for before, behind in proof:
        leaf = joined_hash([*before, leaf, *behind])
    return leaf


def requests(n_trees: int, fanout: int):
    """Leaves of one chunk -> the coordinates it has to fetch."""
    schema = arrow_schema("tree bigint, chunk bigint, at bigint, level bigint, pos bigint")

    def run(part: pa.Table) -> pa.Table:
        tree, chunk, n = (part.column(c)[0].as_py() for c in ("tree", "chunk", "n"))
        rows = [(tree, chunk, tree, *c) for c in missing(part.column("pos").to_numpy(), n, fanout)]
        rows += [(tree, chunk, TOP, *c) for c in missing(np.array([tree]), n_trees, fanout)]
        columns = list(zip(*rows)) if rows else [()] * len(schema)
        return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)
    return run


def expansion(n_trees: int, fanout: int, schema: pa.Schema, kept: list[str], row):
    """Leaves of one chunk and its fetched nodes -> ``row(kept values, leaf,
    proof, subroot, root)`` per leaf."""
    def run(part: pa.Table, got: pa.Table) -> pa.Table:
        tree, n = part.column("tree")[0].as_py(), part.column("n")[0].as_py()
        fetched: dict[int, dict] = {tree: {}, TOP: {}}
        for at, level, p, h in zip(*(got.column(c).to_pylist() for c in ("at", "level", "pos", "hash"))):
            fetched[at][level, p] = h
        places, leaves = part.column("pos").to_pylist(), part.column("leaf").to_pylist()
        own = derive(dict(zip(places, leaves)), fetched[tree], n, fanout)
        subroot = own[-1][0]
        top = derive({tree: subroot}, fetched[TOP], n_trees, fanout)
        above = path(top, tree, n_trees, fanout)
        rows = [row(values, leaf, path(own, p, n, fanout) + above, subroot, top[-1][0 if n_trees > 1 else tree])
                for p, leaf, *values in zip(places, leaves, *(part.column(c).to_pylist() for c in kept))]
        return pa.table([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    return run


def prove(m: Manifest, wanted: DataFrame, kept: list[str], ddl: str, row, fanout: int = FANOUT,
          chunk: int = CHUNK) -> DataFrame:
    """Proofs of ``wanted``, any rows of ``m.leaves``: ``row`` makes a row of
    ``ddl`` from the columns ``kept``, the leaf, its proof, subroot and root."""
    wanted = wanted.select("tree", F.expr(f"pos div {chunk}").alias("chunk"), "pos", "n", "leaf",
                           *[F.col(c).alias(f"_k{i}") for i, c in enumerate(kept)])
    asked = (wanted.select("tree", "chunk", "pos", "n").groupBy("tree", "chunk")
             .applyInArrow(requests(m.n_trees, fanout), "tree bigint, chunk bigint, at bigint, level bigint, pos bigint"))
    nodes = m.nodes.select(F.col("tree").alias("at"), "level", "pos", "hash")
    got = stored(asked.join(nodes, ["at", "level", "pos"]), "merkle-fetched")
    run = expansion(m.n_trees, fanout, arrow_schema(ddl), [f"_k{i}" for i in range(len(kept))], row)
    return wanted.groupBy("tree", "chunk").cogroup(got.groupBy("tree", "chunk")).applyInArrow(run, ddl)


PROOF = "doc_id bigint, source string, leaf string, before array<string>, behind array<string>, subroot string, root string"


def proofs(m: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """One row per wanted leaf (all of them by default) with its proof: per
    level the siblings before and behind it, each level comma-joined."""
    def row(values, leaf, proof, subroot, root):
        return (*values, leaf, [",".join(b) for b, _ in proof], [",".join(b) for _, b in proof], subroot, root)
    return prove(m, m.leaves if wanted is None else wanted, ["doc_id", "source"], PROOF, row)


REPORT = ("doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean, n_siblings bigint")


def report_row(values, leaf, proof, subroot, root):
    doc_id, tampered = values
    siblings = [h for before, behind in proof for h in before + behind]
    folded = fold(tampered, proof)
    return doc_id, leaf, subroot, root, joined_hash(siblings), folded, folded == root, len(siblings)


def proof_report(docs: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """One row per document: its leaf, roots, the hash of its proof, and whether
    the proof still leads to the root from a text without its line ends, where
    crc32 of the decimal doc_id is even (from the text as it is elsewhere)."""
    values = [F.col(c) for c in fields]
    bare = [F.replace(v.cast("string"), F.lit("\n"), F.lit("")) if c == "text" else v for c, v in zip(fields, values)]
    leaf = leaf_hash(*values)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, leaf_hash(*bare)).otherwise(leaf)
    rows = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("bigint").alias("doc_id"),
                       leaf.alias("leaf"), tampered.alias("tampered"))
    m = manifest(stored(rows, "merkle-hashed"))
    return prove(m, m.leaves, ["doc_id", "tampered"], REPORT, report_row)
