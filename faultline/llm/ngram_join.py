"""N-gram Jaccard join by multiple-global-order filtering.

A document is the set of its distinct word shingles (64-bit hashes). Two
documents link when intersection >= threshold * union. Documents with equal
sets form a class; one set stands for the class.

Candidates. A set of n shingles shares at least ceil(t * n) with any set it
links to. So under any global order of all shingles, linked sets share at least
l of their first k(n) = n - ceil(t * n) + l shingles. Two orders are used:

* Order 1 is the shingles' hash. Every class hands on its first k(n) shingles
  with l(n) = e(n) + 1, e(n) = ``extend`` percent of n. A partner has at least
  ceil(t * n) shingles, so linked classes share at least e(ceil(t * n)) + 1 of
  what they hand on.
* Order 2 is rarest first (frequency among all handed-on shingles, then hash).
  Of what a class hands on, all but e(ceil(t * n)) shingles, the rarest ones,
  must hold a shared one. Shingles seen once need no index entry, so most
  classes leave here, and passages that many documents share, being frequent,
  are not in the second prefix of documents that hold other text as well.

Classes that share a shingle of the second prefix pass both filters. Most such
pairs share no more than that, and in a large corpus they chain most of its
classes, so the pairs of each shingle's classes are compared first, by parity
bitmaps: one bit for all shingles of a set that hash to it. Two sets differ in
at least as many shingles as their bitmaps in bits, which bounds their
intersection, so no linked pair is lost. Shingles with the same classes are one
list; a list of more than ``LIST`` classes is cut by size, as linked sets have
like sizes, then to blocks.

Pairs that pass form candidate components. All pairs of one component are verified
exactly inside tasks: intersections of all members are one product of their
incidence matrix with itself. A component of more than ``BLOCK`` classes is cut
to blocks and every pair of blocks is one group, so no task holds more than two
blocks. Tasks hand on a spanning forest of the links they find, never all pairs.

Defined cases: null or empty texts and texts without words have no shingles and
link with nothing; a text with fewer words than a shingle has one, its whole
sequence; of very long texts every shingle counts; repeated rows are copies of one document; an empty table gives an
empty result; other columns are not read by the join and kept by the filter.
The filter tells rows apart by doc_id and text together: rows without a doc_id,
or different texts under one, are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import arrow_schema, id_and_text, slices, stored
from faultline.llm.graph import components

EXTEND = 20             # percent of a set that order 1 hands on beyond the plain prefix
BLOCK = 512
LIST = 1024             # classes of one shingle that are compared at once, or twice as many
BITS = 256              # of a bitmap, at least; beyond that as many as the set has shingles, or up to twice
FEW = 24                # classes that are compared one by one, more of them in arrays
MOST_BROADCAST = 2_000_000   # ids of candidates, 8 bytes each
MOST_KEYS = 1_000_000        # keys of rows that are dropped, 16 bytes each
KEY = ("_fl_k1", "_fl_k2")
_UPPER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xBF58476D1CE4E5B9)


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's ``width``-word shingles."""
    words = (text or "").encode().translate(_UPPER).split()
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    h = np.full(n, min(width, len(words)), np.uint64)
    for k in range(min(width, len(words))):
        h = h * _MIX + codes[k:k + n]
    h ^= h >> np.uint64(29)
    h *= _SPREAD
    h ^= h >> np.uint64(32)
    return np.unique(h)


def prefix_length(n, percent: int):
    """p = n - ceil(percent / 100 * n) + 1, for numbers and columns alike."""
    return n - (percent * n + 99) // 100 + 1


def bitmap(s: np.ndarray) -> bytes:
    """Parities of the numbers of shingles at each bit. A bitmap of half as many
    bits is its halves' XOR."""
    bits = max(BITS, 1 << (len(s) - 1).bit_length() if len(s) else 0)
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def classes(docs: DataFrame, width: int, percent: int, extend: int) -> DataFrame:
    """(doc_id, n, print, class, prefix, bits): 128-bit print of the set, its first
    64 bits as a short class id, the first prefix under order 1, and the bitmap;
    then the bigint columns that ``docs`` has besides id and text."""
    more = [c for c in docs.columns if c not in ("doc_id", "text")]
    ddl = "doc_id bigint, n bigint, print binary, class bigint, prefix array<bigint>, bits binary" + "".join(
        f", {c} bigint" for c in more)
    arrow = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            cols: list[list] = [part.column(0).to_pylist(), [], [], [], [], []]
            for text in part.column(1).to_pylist():
                s = shingles(text, width)
                n = len(s)
                mark = xxhash.xxh3_128_digest(s.tobytes())
                k = prefix_length(n, percent) + extend * n // 100 if n else 0
                cols[1].append(n)
                cols[2].append(mark)
                cols[3].append(int.from_bytes(mark[:8], "little", signed=True))
                cols[4].append(signed(s[:min(n, k)]))
                cols[5].append(bitmap(s))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)]
                                             + part.columns[2:], schema=arrow)

    return docs.select("doc_id", "text", *more).mapInArrow(run, ddl)


def index_entries(sets: DataFrame, percent: int, extend: int) -> DataFrame:
    """(shingle, class) of the second prefix, shingles of two classes or more."""
    entries = sets.where("n > 0").select("class", "n", F.explode("prefix").alias("shingle"))
    # one exchange; a document has a shingle once, so no shingle has more than a small part of the rows
    met = (entries.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("shingle"))).where("df > 1")
           .groupBy("class", "shingle").agg(F.max("df").alias("df"), F.max("n").alias("n")))
    spare = F.expr(f"{extend} * (({percent} * n + 99) div 100) div 100")
    w = Window.partitionBy("class")
    # the shingles seen once come before all these under order 2
    return (met.withColumn("met", F.count(F.lit(1)).over(w))
            .withColumn("rank", F.row_number().over(w.orderBy("df", "shingle")))
            .where(F.col("rank") <= F.col("met") - spare)
            .select("class", "shingle"))


def groups_of(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows that are sorted by their first columns, one group at a time."""
    key, rows = None, []
    for part in slices(batches):
        for values in zip(*(c.to_pylist() for c in part.columns)):
            if values[:n_keys] != key:
                if rows:
                    yield key, rows
                key, rows = values[:n_keys], []
            rows.append(values[n_keys:])
    if rows:
        yield key, rows


def joined(m: int, pairs: Iterator[tuple[int, np.ndarray]]) -> list[tuple[int, int]]:
    """A spanning forest of 0 to m - 1 under pairs (one, others)."""
    label, out = np.arange(m), []
    for i, others in pairs:
        apart = others[label[others] != label[i]]
        while len(apart):
            j = int(apart[0])
            out.append((i, j))
            label[label == label[j]] = label[i]
            apart = apart[label[apart] != label[i]]
    return out


def alike(size: np.ndarray, bits: list[bytes], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that may be linked, by sizes and bitmaps."""
    m = len(size)

    def may(a, b, apart):
        # linked: (100 + percent) * intersection >= percent * (a + b)
        return (100 + percent) * np.minimum((a + b - apart) // 2, np.minimum(a, b)) >= percent * (a + b)

    if m <= FEW:
        n, x = size.tolist(), [int.from_bytes(b, "little") for b in bits]

        def folded(i: int, to: int) -> int:
            y, k = x[i], 8 * len(bits[i])
            while k > to:
                k //= 2
                y = (y >> k) ^ (y & ((1 << k) - 1))
            return y

        def one_by_one():
            for i in range(m):
                for j in range(i + 1, m):
                    to = 8 * min(len(bits[i]), len(bits[j]))
                    both = min((n[i] + n[j] - (folded(i, to) ^ folded(j, to)).bit_count()) // 2, n[i], n[j])
                    if (100 + percent) * both >= percent * (n[i] + n[j]):
                        yield i, np.array([j])

        return joined(m, one_by_one())
    width = np.array([len(b) for b in bits])

    def in_arrays():
        for w in np.unique(width):
            # those of this width among themselves and with wider ones, folded to it
            own = np.flatnonzero(width == w)
            wide = np.flatnonzero((width >= w) & (100 * size[own].max() >= percent * size))
            flat = np.empty((len(wide), w // 8), np.uint64)
            for v in np.unique(width[wide]):
                at = np.flatnonzero(width[wide] == v)
                y = np.frombuffer(b"".join(bits[k] for k in wide[at]), np.uint64).reshape(len(at), -1)
                while y.shape[1] > w // 8:
                    y = y[:, :y.shape[1] // 2] ^ y[:, y.shape[1] // 2:]
                flat[at] = y
            place = np.searchsorted(wide, own)
            for i, p in zip(own, place):
                near = np.flatnonzero(((width[wide] > w) | (wide > i)) & (100 * size[wide] >= percent * size[i])
                                      & (percent * size[wide] <= 100 * size[i]))
                apart = np.bitwise_count(flat[near] ^ flat[p]).sum(axis=1, dtype=np.int64)
                yield int(i), wide[near[may(size[i], size[wide[near]], apart)]]

    return joined(m, in_arrays())


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections: the product of the incidence matrix
    (members by shingles that two or more of them hold) with its transpose,
    summed over slabs of columns."""
    m = len(sets)
    who = np.repeat(np.arange(m), [len(s) for s in sets])
    _, column, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(df > 1)
    place = np.full(len(df), -1)
    place[shared] = np.arange(len(shared))
    column = place[column]
    who, column = who[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    who, column = who[order], column[order]
    total = np.zeros((m, m), np.float64)
    for at in range(0, len(shared), 4096):
        a, b = np.searchsorted(column, [at, at + 4096])
        slab = np.zeros((m, 4096), np.float32)
        slab[who[a:b], column[a:b] - at] = 1
        total += slab @ slab.T
    return total.astype(np.int64)


def links(names: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the linked pairs among the members."""
    m = len(names)
    size = np.array([len(s) for s in sets])
    both = overlaps(sets)
    linked = 100 * both >= percent * (size[:, None] + size[None, :] - both)
    parent = list(range(m))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(np.triu(linked, 1))):
        a, b = root(int(i)), root(int(j))
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((names[i], names[j]))
    return out


def candidates(sets: DataFrame, percent: int, extend: int, most: int = LIST) -> DataFrame:
    """(a, b): pairs of classes that share a shingle of the second prefix and whose
    bitmaps may be linked, enough to connect all such pairs of a list."""
    kept = stored(index_entries(sets, percent, extend), "join-index")
    # shingles with the same classes are one list
    print_of = [F.bit_xor(F.xxhash64(F.lit(k), F.col("class"))).alias(f"x{k}") for k in (1, 2)]
    lists = (kept.groupBy("shingle").agg(F.count(F.lit(1)).alias("many"), *print_of).where("many > 1")
             .groupBy("many", "x1", "x2").agg(F.min("shingle").alias("shingle")).select("shingle", "many"))
    bits = sets.where("n > 0").select("class", "n", "bits").distinct()
    rows = kept.join(lists, "shingle").join(bits, "class")
    # linked sets are of neighbouring steps of size, or of one
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent) * (1 + 1e-9)))
    many = F.col("many") > most
    dealt = stored(rows.select("shingle", "class", "n", "bits", F.explode(
        F.when(many, F.array(step, step + 1)).otherwise(F.array(F.lit(-1).cast("bigint")))).alias("step")), "join-lists")
    large = dealt.where("step >= 0").groupBy("shingle", "step").agg(F.ceil(F.count(F.lit(1)) / most).alias("blocks"))
    own = F.pmod(F.xxhash64("class"), F.col("blocks"))
    one = F.lit(0).cast("bigint")
    cut = (dealt.where("step >= 0").join(large, ["shingle", "step"]).withColumn("own", own)
           .withColumn("other", F.explode(F.sequence(one, F.col("blocks") - 1)))
           .select("shingle", "step", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                   "class", "n", "bits"))
    whole = dealt.where("step < 0").select("shingle", "step", one.alias("i"), one.alias("j"), "class", "n", "bits")
    ddl = "a bigint, b bigint"
    arrow = arrow_schema(ddl)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for _, rows in groups_of(batches, 4):
            if len(rows) > 1:
                names, n, bits = zip(*rows)
                for i, j in alike(np.array(n), bits, percent):
                    a.append(names[i])
                    b.append(names[j])
            if len(a) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=arrow)
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=arrow)

    key = ["shingle", "step", "i", "j"]
    return whole.unionByName(cut).repartition(*key).sortWithinPartitions(*key).mapInArrow(compare, ddl)


def near_edges(docs: DataFrame, sets: DataFrame, width: int, percent: int, extend: int,
               block: int = BLOCK) -> DataFrame:
    """(a, b): links between classes, enough to connect all that are linked."""
    comp = components(candidates(sets, percent, extend), "join-candidates")
    sizes = comp.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / block).cast("bigint").alias("blocks"))
    members = stored(comp.join(sizes, "label").select(F.col("node").alias("class"), "label", "blocks"), "join-members")
    # one document stands for each candidate class; only these are cut to shingles again
    stand = stored(sets.where("n > 0").join(members.select("class"), "class")
                   .groupBy("print", "class").agg(F.min("doc_id").alias("doc_id")), "join-stand")
    wanted = stand.select(F.col("doc_id").alias("_id")).distinct()
    if stand.count() <= MOST_BROADCAST:
        wanted = F.broadcast(wanted)
    ddl = "class bigint, shingles binary"
    arrow = arrow_schema(ddl)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 256):
            found = [shingles(t, width) for t in part.column(0).to_pylist()]
            marks = [xxhash.xxh3_128_digest(s.tobytes()) for s in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int.from_bytes(m[:8], "little", signed=True) for m in marks], pa.int64()),
                 pa.array([s.tobytes() for s in found], pa.binary())], schema=arrow)

    full = (docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select("text")
            .mapInArrow(cut, ddl).join(members, "class")
            .dropDuplicates(["class", "shingles"]))
    own = F.pmod(F.xxhash64("class"), F.col("blocks"))
    dealt = (full.withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
             .select("label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     "class", "shingles"))
    ddl2 = "a bigint, b bigint"
    arrow2 = arrow_schema(ddl2)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groups_of(batches, 3):
            # a document that repeats, or an equal short id, adds no new set
            unique = {(c, s): None for c, s in rows}
            got = links([c for c, _ in unique], [np.frombuffer(s, np.uint64) for _, s in unique], percent)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in got], pa.int64()) for k in (0, 1)], schema=arrow2)

    return (dealt.repartition("label", "i", "j").sortWithinPartitions("label", "i", "j")
            .mapInArrow(verify, ddl2))


def join_report(docs: DataFrame, width: int = 3, percent: int = 90, extend: int = EXTEND, block: int = BLOCK,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): the smallest doc_id that links reach."""
    d = id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    sets = stored(classes(d, width, percent, extend), "join-sets")
    comp = components(near_edges(d, sets, width, percent, extend, block), "join-links")
    comp = comp.select(F.col("node").alias("class"), "label")
    by_class = (sets.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("least"))
                .join(comp, "class", "left").withColumn("label", F.coalesce("label", "class")))
    smallest = by_class.groupBy("label").agg(F.min("least").alias("component_id"))
    to = by_class.select("class", "label").join(smallest, "label").select("class", "component_id")
    own = sets.select("doc_id", F.col("n").alias("n_shingles"), "class")
    return (own.where("n_shingles > 0").join(to, "class").select("doc_id", "n_shingles", "component_id")
            .unionByName(own.where("n_shingles = 0")
                         .select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))))


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a 128-bit key of doc_id and text; nulls are told apart."""
    seen = [F.col("doc_id").cast("bigint"), F.col("text").cast("string")]
    return docs.withColumns({k: F.xxhash64(F.lit(i), *(c.isNull() for c in seen), *seen)
                             for i, k in enumerate(KEY)})


def distinct_documents(docs: DataFrame, width: int = 5, percent: int = 80, extend: int = EXTEND,
                       block: int = BLOCK) -> DataFrame:
    """One document of each group of linked ones, that with the smallest doc_id
    (a null one is the largest; then the smallest key), with all its columns.
    Rows that repeat a doc_id with its text count as one document."""
    d = keyed(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                           *KEY)
    sets = stored(classes(d, width, percent, extend), "join-sets")
    comp = components(near_edges(d, sets, width, percent, extend, block), "join-links")
    comp = comp.select(F.col("node").alias("class"), "label")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *KEY)
    by_class = (sets.where("n > 0").groupBy("class").agg(F.min(rank).alias("least"))
                .join(comp, "class", "left").withColumn("label", F.coalesce("label", "class")))
    smallest = by_class.groupBy("label").agg(F.min("least").alias("first"))
    to = by_class.select("class", "label").join(smallest, "label").select(
        "class", *(F.col(f"first.{k}").alias(f"{k}_first") for k in KEY))
    first = F.lit(True)
    for k in KEY:
        first = first & (F.col(k) == F.col(f"{k}_first"))
    # texts without words link with nothing
    got = stored(sets.where("n > 0").select("class", *KEY).join(to, "class").select(*KEY, first.alias("first"))
                 .unionByName(sets.where("n = 0").select(*KEY, F.lit(True).alias("first"))), "join-report")
    drop = got.where("not first").select(*KEY)
    few = drop.count() <= MOST_KEYS
    drop = drop.distinct()
    kept = keyed(docs).join(F.broadcast(drop) if few else drop, list(KEY), "left_anti")
    if got.where("first").groupBy(*KEY).count().where("count > 1").limit(1).count():
        kept = kept.dropDuplicates(list(KEY))
    return kept.select(*docs.columns)
