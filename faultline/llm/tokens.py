"""Token ids as binary files: canonical length-limited Huffman coding.

1. Texts are encoded by the ``tokenizers`` library as it loads the vocabulary;
   ids are kept as packed bytes, an end id after each document. Chunks of text
   are counted over all documents first, and the commonest, up to a bound in
   bytes, are encoded once and broadcast; the others are encoded where they stand.
2. Ids are counted over all documents. The counts (one per vocabulary entry)
   give code lengths of at most ``LIMIT`` bits by package-merge; canonical
   codes follow from the lengths alone, so the file's book holds lengths only.
3. Documents are dealt to shards by ranges of (doc_id, first ids, hash of all
   ids, running number), so that not even equal rows meet in one shard, sorted,
   and coded in blocks. A block is independent: its ids are one bit string with the bit
   offset of every ``STEP``-th id as a checkpoint.
4. Decoding looks ``LIMIT`` bits up in one table (id, length). All checkpoints
   of a block advance together, one id a step.

A file set is two Parquet folders: ``book`` (id, bits) and ``blocks`` (shard,
block, doc_ids, lens, checkpoints, data), shard and block ascending with doc_id.

Defined cases: a null text is empty and holds the end id only; rows that share
a doc_id stand next to each other, in the order of their first 64 bytes of ids,
then of a hash; a null doc_id comes first; a text that holds one of the
vocabulary's added tokens gets that token's id there, as from the library; a
very long text is one block of its own; an empty table gives files without
blocks. Other columns are not read.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.llm.common import arrow_schema, id_and_text, shared_path, slices, slices_by_bytes, stored

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
LIMIT = 18
STEP = 128
BLOCK_IDS = 1 << 16
CHUNK_BYTES = 12 << 20          # text of the chunks that are encoded beforehand and broadcast
CHUNK_LENGTH = 64               # longer chunks are encoded where they stand
ENCODED = 3 << 20               # text whose distinct chunks a task encodes at a time
COUNTED = 16 << 20              # text whose chunks a task counts before it hands the counts on


# ---------------------------------------------------------------- tokens

class Chunks:
    """Ids of chunks in flat arrays: texts in the order of their hashes, so that
    many are found by one sorted search; the texts themselves are compared."""

    def __init__(self, texts: pa.Array, ids: pa.Array | list[bytes], width: int):
        marks = self.marks(texts)
        order = np.argsort(marks, kind="stable")
        self.mark = marks[order]
        self.text = texts.take(pa.array(order))
        # the packed ids are put in order as numbers: no object per chunk
        ids = pa.array(ids, pa.binary())
        _, offsets, data = ids.buffers()
        ends = np.frombuffer(offsets or bytes(4), np.int32)[ids.offset:ids.offset + len(ids) + 1].astype(np.int64)
        size, flat = np.diff(ends) // width, np.frombuffer(data or b"", np.uint8)[ends[0]:ends[-1]].view(f"<u{width}")
        self.size = size[order]
        self.start = np.cumsum(self.size) - self.size
        self.data = gathered(flat, (np.cumsum(size) - size)[order], self.size)

    @staticmethod
    def marks(texts: pa.Array) -> np.ndarray:
        """A hash of each text, eight bytes at a time, of 256 bytes at most."""
        if not len(texts):
            return np.zeros(0, np.uint64)
        _, offsets, data = texts.buffers()
        first = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        data = np.concatenate([np.frombuffer(data or b"", np.uint8), np.zeros(8, np.uint8)])
        words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))  # one from every byte
        size = np.diff(first)
        h, rows = size.astype(np.uint64), np.arange(len(size))
        for at in range(0, 256, 8):
            rows = rows[size[rows] > at]
            if not len(rows):
                break
            left = np.minimum(size[rows] - at, 8).astype(np.uint64)
            word = words[first[rows] + at] & (np.uint64(2**64 - 1) >> (np.uint64(64) - left * np.uint64(8)))
            x = (h[rows] ^ word) * np.uint64(0x9E3779B97F4A7C15)
            h[rows] = x ^ (x >> np.uint64(32))
        return h

    def find(self, texts: pa.Array) -> np.ndarray:
        """The place of each text, -1 for one that is not held."""
        if not len(self.mark) or not len(texts):
            return np.full(len(texts), -1)
        marks = self.marks(texts)
        at = np.minimum(np.searchsorted(self.mark, marks), len(self.mark) - 1)
        same = self.mark[at] == marks
        near = np.flatnonzero(same)
        same[near] = pc.equal(self.text.take(pa.array(at[near])), texts.take(pa.array(near))).to_numpy(zero_copy_only=False)
        return np.where(same, at, -1)


def gathered(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs data[start:start + size], one behind the other."""
    kind = np.int32 if len(data) + int(size.sum()) < 2**31 else np.int64
    at = np.repeat((start - (np.cumsum(size) - size)).astype(kind), size)
    at += np.arange(len(at), dtype=kind)
    return data[at]


def spaced(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(chunks between the texts' single spaces, each text's first; last one more)."""
    lists = pc.split_pattern(texts, " ")
    return lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()


def behind_spaces(chunks: pa.Array, first: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(chunks with a space in front, which ones of all these are)."""
    mask = np.ones(len(chunks), bool)
    mask[first[:-1]] = False
    return chunks.filter(pa.array(mask)), mask


class Encoder:
    """The library's ids for texts, given the ids of common chunks.

    A text is cut at single spaces between two characters that are no white
    space. Byte-level pieces never run across such a place (a space opens the
    piece that follows it), so the ids of a text are those of its chunks, each
    with its space in front. Other texts, and those that hold an added token of
    the vocabulary, go to the library whole.

    ``known`` has the ids of common chunks. Others are encoded batch by batch,
    each distinct one once, and forgotten, so memory does not grow.
    """

    BAD = b""  # a chunk that is empty or has white space at an end
    MARKS = r"[!-/:-@\[-`{-~]"  # ASCII punctuation
    PLAIN = rf"^\p{{L}}+{MARKS}*(\n\p{{L}}+{MARKS}*)*$"
    CUT = "\x01"  # stands in no plain chunk
    GAP = "\u00ff"  # the letter of byte 255, which no text holds

    def __init__(self, vocabulary: str, known: Chunks | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bare, self.letters = self.without_split()
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.known = known or Chunks(pa.array([], pa.string()), [], self.width)

    def without_split(self):
        """(the same model, split at GAP alone in place of its byte-level split,
        byte -> its letter), or (None, None) where the vocabulary is not split
        that way. A piece that is known to stay whole can then go to the model
        directly."""
        from tokenizers import Tokenizer

        spec = json.loads(self.tokenizer.to_str())
        split = spec["pre_tokenizer"] or {}
        if (spec["normalizer"] or split.get("type") != "ByteLevel" or split["add_prefix_space"]
                or not split["use_regex"] or self.tokenizer.token_to_id(self.GAP) is None):
            return None, None
        spec["pre_tokenizer"] = {"type": "Split", "pattern": {"String": self.GAP}, "behavior": "Isolated",
                                 "invert": False}
        spec["post_processor"] = None
        bare = Tokenizer.from_str(json.dumps(spec))
        # visible characters of Latin-1 stand for their bytes, the letters from
        # 256 on for the other bytes in turn
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in seen]
        return bare, {**{b: b for b in seen}, **{b: 256 + k for k, b in enumerate(rest)}}

    def pieces(self, cores: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one behind the other, how many each has) of pieces, each one split
        piece by its characters. Many go to the library as one text, with GAP's
        token between their ids."""
        gap, kind = self.bare.token_to_id(self.GAP), f"<u{self.width}"
        data, sizes = [np.zeros(0, kind)], [np.zeros(0, np.int64)]
        for at in range(0, len(cores), 4096):
            # pieces hold no CUT; byte 255 stands in no text and its letter is GAP
            text = self.CUT.join(cores[at:at + 4096]).encode().replace(self.CUT.encode(), b"\xff").decode("latin-1")
            ids = np.array(self.bare.encode_batch_fast([text.translate(self.letters)], add_special_tokens=False)[0].ids, kind)
            gaps = ids == gap
            sizes.append(np.diff(np.flatnonzero(gaps), prepend=-1, append=len(ids)) - 1)
            data.append(ids[~gaps])
        return np.concatenate(data), np.concatenate(sizes)

    def plain(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids one behind the other, how many each has) of chunks of words of
        letters, each with marks behind it or not, between single line ends. The pieces of
        all are looked up or encoded once each and put together in flat arrays."""
        lists = pc.split_pattern(pc.replace_substring_regex(pc.binary_join_element_wise(" ", chunks, ""), f"({self.MARKS}+|\n)",
                                                            rf"{self.CUT}\1{self.CUT}"), self.CUT)
        seen = lists.flatten().dictionary_encode()
        parts, known = seen.dictionary, self.known
        start, size = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        # a word with marks behind it is often common without them
        words = np.flatnonzero(pc.starts_with(parts, " ").to_numpy(zero_copy_only=False))
        at = known.find(pc.utf8_slice_codeunits(parts.take(pa.array(words)), 1))
        held = np.flatnonzero(at >= 0)
        held = held[known.size[at[held]] > 0]
        size[words[held]] = known.size[at[held]]
        need = np.flatnonzero((size == 0) & (pc.binary_length(parts).to_numpy() > 0))
        fresh, size[need] = self.pieces(parts.take(pa.array(need)).to_pylist())
        place = np.concatenate([words[held], need])
        start[place] = np.cumsum(size[place]) - size[place]
        pool = np.concatenate([gathered(known.data, known.start[at[held]], known.size[at[held]]), fresh])
        code = seen.indices.to_numpy()
        first = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        ends = np.concatenate([[0], np.cumsum(size[code])])[first]
        return gathered(pool, start[code], size[code]), np.diff(ends)

    def whole(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text, from the library."""
        kind, out = f"<u{self.width}", []
        for at in range(0, len(texts), 1024):  # the library's results are large objects
            got = self.tokenizer.encode_batch_fast(texts[at:at + 1024], add_special_tokens=False)
            out += [np.array(e.ids, kind).tobytes() for e in got]
        return out

    @staticmethod
    def apart(chunk: str) -> bool:
        return bool(chunk) and not chunk[0].isspace() and not chunk[-1].isspace()

    def learn(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk with a space in front."""
        data, size = self.learned(pa.array(chunks, pa.string()))
        packed, ends = data.tobytes(), np.cumsum(size) * self.width
        return [packed[b - n:b] for b, n in zip(ends.tolist(), (size * self.width).tolist())]

    def learned(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids one behind the other, how many each has) of chunks with a space in
        front; none for a bad chunk."""
        simple = (pc.match_substring_regex(chunks, self.PLAIN).to_numpy(zero_copy_only=False) if self.bare
                  else np.zeros(len(chunks), bool))
        quick, slow = np.flatnonzero(simple), np.flatnonzero(~simple)
        start, size = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        pool = np.zeros(0, f"<u{self.width}")
        if len(quick):
            pool, size[quick] = self.plain(chunks.take(pa.array(quick)))
        rest = self.others(chunks.take(pa.array(slow)).to_pylist())
        size[slow] = np.fromiter(map(len, rest), np.int64, len(rest)) // self.width
        place = np.concatenate([quick, slow])
        start[place] = np.cumsum(size[place]) - size[place]
        return gathered(np.concatenate([pool, np.frombuffer(b"".join(rest), pool.dtype)]), start, size), size

    def others(self, chunks: list[str]) -> list[bytes]:
        """Packed ids of chunks that are not plain, each with a space in front."""
        ids = dict.fromkeys(chunks, self.BAD)
        rest = [c for c in ids if self.apart(c)]
        ids.update(zip(rest, self.whole([" " + c for c in rest])))
        return [ids[c] for c in chunks]

    def batch(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Packed ids of each text."""
        texts = pc.fill_null(pa.array(texts, pa.string()), "")
        if not len(texts):
            return []
        flat, first = spaced(texts)
        after, mask = behind_spaces(flat, first)
        # ids of the distinct chunks: known ones, fresh ones, then the texts' heads
        seen = after.dictionary_encode()
        distinct, known = seen.dictionary, self.known
        at = known.find(distinct)
        held, missing = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        heads = flat.take(pa.array(first[:-1])).to_pylist()
        fresh, fresh_size = self.learned(distinct.take(pa.array(missing)))
        first_ids = self.whole(heads)
        first_size = np.fromiter(map(len, first_ids), np.int64, len(first_ids)) // self.width
        pool = np.concatenate([gathered(known.data, known.start[at[held]], known.size[at[held]]), fresh,
                               np.frombuffer(b"".join(first_ids), f"<u{self.width}")])
        size = np.zeros(len(distinct) + len(heads), np.int64)
        start = np.zeros(len(size), np.int64)
        place = np.concatenate([held, missing, len(distinct) + np.arange(len(heads))])
        sizes = np.concatenate([known.size[at[held]], fresh_size, first_size])
        size[place] = sizes
        start[place] = np.cumsum(sizes) - sizes
        code = np.empty(len(flat), np.int64)
        code[mask] = seen.indices.to_numpy()
        code[first[:-1]] = len(distinct) + np.arange(len(heads))
        ids = gathered(pool, start[code], size[code]).tobytes()
        ends = np.concatenate([[0], np.cumsum(size[code])])[first] * self.width
        out = [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        bad = np.flatnonzero(mask & (size[code] == 0))
        odd = set((np.searchsorted(first, bad, "right") - 1).tolist())
        many = np.diff(first) > 1
        odd.update(n for n, h in enumerate(heads) if many[n] and (not h or h[-1].isspace()))
        for a in self.added:
            odd.update(np.flatnonzero(pc.match_substring(texts, a).to_numpy(zero_copy_only=False)).tolist())
        odd = sorted(odd)
        for n, got in zip(odd, self.whole(texts.take(pa.array(odd, pa.int64())).to_pylist())):
            out[n] = got
        return out


def chunk_counts(texts: DataFrame) -> DataFrame:
    """(chunk, n): how often each chunk of at most CHUNK_LENGTH characters stands
    behind a space of the column ``text``, in the parts of COUNTED bytes that hold
    it twice or more. The counts only choose which chunks are encoded beforehand;
    one that stands once in a part gains nothing there, and most chunks do."""
    ddl = "chunk string, n bigint"
    arrow = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices_by_bytes(batches, 0, COUNTED):
            chunks, _ = behind_spaces(*spaced(pc.fill_null(part.column(0), "")))
            counts = pc.value_counts(chunks)
            short = pc.and_(pc.less_equal(pc.utf8_length(counts.field("values")), CHUNK_LENGTH),
                            pc.greater(counts.field("counts"), 1))
            yield pa.RecordBatch.from_arrays([counts.field("values").filter(short), counts.field("counts").filter(short)],
                                             schema=arrow)
        pa.default_memory_pool().release_unused()  # the worker goes on to encode

    return texts.select("text").mapInArrow(run, ddl).groupBy("chunk").agg(F.sum("n").alias("n"))


def common_chunks(docs: DataFrame, vocabulary: str, most_bytes: int = CHUNK_BYTES, text_col: str = "text") -> Chunks | None:
    """The ids of the chunks that occur most often, at most ``most_bytes`` of
    text in all, each encoded once. A chunk that stands once gains nothing."""
    counts = stored(chunk_counts(docs.select(F.col(text_col).cast("string").alias("text"))), "token-chunks")
    # bytes by steps of the count (sixteen to a doubling): a table of bounded size
    size = F.octet_length("chunk") + 8
    steps = counts.groupBy(F.floor(F.log2("n") * 16).alias("step")).agg(F.sum(size).alias("bytes")).collect()
    total, least = 0, None
    for r in sorted(steps, key=lambda r: -r["step"]):
        total += r["bytes"]
        if total > most_bytes:
            break
        least = r["step"]
    if least is None:
        return None
    chosen = counts.where(F.floor(F.log2("n") * 16) >= least).select("chunk")
    ddl = "chunk string, ids binary, width int"
    arrow = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        for part in slices(batches, 8192):
            got = encoder.learn(part.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(got, pa.binary()), pa.array([encoder.width] * len(got), pa.int32())], schema=arrow)

    # the width comes with the ids: the driver loads no vocabulary
    table = chosen.mapInArrow(run, ddl).toArrow().combine_chunks()
    return Chunks(pa.concat_arrays(table.column(0).chunks), pa.concat_arrays(table.column(1).chunks), table.column(2)[0].as_py())


IDS_DDL = "doc_id bigint, width int, ids binary"


def tokenise(docs: DataFrame, vocabulary: str, end_id: int = END_ID, most_bytes: int = CHUNK_BYTES,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, width, ids): ids packed in ``width`` bytes each (2 if the
    vocabulary allows), the end id appended."""
    arrow = arrow_schema(IDS_DDL)
    known = docs.sparkSession.sparkContext.broadcast(common_chunks(docs, vocabulary, most_bytes, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        encoder.known = known.value or encoder.known
        end = end_id.to_bytes(encoder.width, "little")
        for part in slices_by_bytes(batches, 1, ENCODED):
            ids = [x + end for x in encoder.batch(part.column(1))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([encoder.width] * len(ids), pa.int32()), pa.array(ids, pa.binary())], schema=arrow)

    ids = id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return ids.mapInArrow(run, IDS_DDL)


@lru_cache(maxsize=1)
def encoder_of(vocabulary: str) -> Encoder:
    """One encoder per Python worker. The tasks of later stages, which run in the
    same workers, let it go first."""
    return Encoder(vocabulary)


def unpacked(width: int, ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if width == 2 else "<u4").astype(np.int64)


# ---------------------------------------------------------------- codes

def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge).

    Level by level, the packages (pairs of neighbours) of the level before are
    merged with the symbols by weight; each of the first 2n - 2 entries of the
    last level adds one bit to the symbols it holds. Going back down the
    levels, only the number of packages among the entries is needed."""
    symbols = np.flatnonzero(counts)
    n = len(symbols)
    lengths = np.zeros(len(counts), np.int64)
    if n == 0:
        return lengths
    if n == 1:
        lengths[symbols] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need more than {limit} bits")
    order = symbols[np.argsort(counts[symbols], kind="stable")]
    leaves = counts[order].astype(np.float64)
    levels, merged = [], leaves
    is_leaf = np.ones(n, bool)
    levels.append(is_leaf)
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, pairs])
        kind = np.concatenate([np.ones(n, bool), np.zeros(len(pairs), bool)])
        at = np.argsort(both, kind="stable")
        merged, is_leaf = both[at], kind[at]
        levels.append(is_leaf)
    take, bits = 2 * n - 2, np.zeros(n + 1, np.int64)
    for is_leaf in reversed(levels):
        chosen = is_leaf[:take]
        k = int(chosen.sum())
        bits[0] += 1
        bits[k] -= 1
        take = 2 * (len(chosen) - k)
        if take == 0:
            break
    lengths[order] = np.cumsum(bits)[:n]
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes counted up by (length, id)."""
    codes = np.zeros(len(lengths), np.int64)
    code = last = 0
    used = np.flatnonzero(lengths)
    for s in used[np.argsort(lengths[used], kind="stable")].tolist():
        code <<= int(lengths[s]) - last
        last = int(lengths[s])
        codes[s] = code
        code += 1
    return codes


def decode_table(lengths: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """(id, length) for every string of ``limit`` bits."""
    ids, bits = np.zeros(1 << limit, np.int32), np.zeros(1 << limit, np.uint8)
    codes = canonical_codes(lengths)
    used = np.flatnonzero(lengths)
    used = used[np.argsort(codes[used] << (limit - lengths[used]), kind="stable")]
    spans = 1 << (limit - lengths[used])
    ids[: spans.sum()] = np.repeat(used, spans)
    bits[: spans.sum()] = np.repeat(lengths[used], spans)
    return ids, bits


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(bit string as bytes, bit offset of every STEP-th id)."""
    size = lengths[ids]
    ends = np.cumsum(size)
    starts = ends - size
    word, shift = starts >> 6, 64 - (starts & 63) - size
    code = codes[ids].astype(np.uint64)
    high = np.where(shift >= 0, code << np.maximum(shift, 0).astype(np.uint64),
                    code >> np.maximum(-shift, 0).astype(np.uint64))
    out = np.zeros(int(ends[-1] + 63 >> 6) + 1, np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    out[word[first]] = np.add.reduceat(high, first)
    over = np.flatnonzero(shift < 0)  # at most one id runs over the end of a word
    out[word[over] + 1] |= code[over] << (64 + shift[over]).astype(np.uint64)
    return out.astype(">u8").tobytes()[: int(ends[-1] + 7 >> 3)], starts[::STEP]


def unpack(blocks: list[tuple[bytes, np.ndarray, int]], ids: np.ndarray, bits: np.ndarray,
           limit: int = LIMIT) -> list[np.ndarray]:
    """The ids of several (data, checkpoints, number of ids): every checkpoint
    of every block is a cursor, and all cursors advance one id a step."""
    data = np.frombuffer(b"".join(d + bytes(8) for d, _, _ in blocks), np.uint8)
    base = np.cumsum([0] + [len(d) + 8 for d, _, _ in blocks])
    at = np.concatenate([c.astype(np.int64) + 8 * b for (_, c, _), b in zip(blocks, base)])
    # a 32-bit big-endian view from every byte
    wide = data.astype(np.uint32)
    window = (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]
    out = np.empty((len(at), STEP), np.int32)
    most = len(window) - 1
    for k in range(STEP):
        cell = (window[np.minimum(at >> 3, most)] >> (32 - limit - (at & 7)).astype(np.uint32)) & ((1 << limit) - 1)
        out[:, k] = ids[cell]
        at = at + bits[cell]
    got, row = [], 0
    for _, checkpoints, n in blocks:
        got.append(out[row:row + len(checkpoints)].reshape(-1)[:n])
        row += len(checkpoints)
    return got


# ---------------------------------------------------------------- files

def count_ids(ids: DataFrame) -> np.ndarray:
    """Global counts by id: each task sums its own, so the shuffle and the
    driver get at most one row per vocabulary entry and task."""
    ddl = "id bigint, n bigint"
    arrow = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder_of.cache_clear()
        total = np.zeros(1, np.int64)
        for part in slices(batches):
            for width in pc.unique(part.column(0)).to_pylist():
                own = part.column(1).filter(pc.equal(part.column(0), width))
                n = np.bincount(unpacked(width, b"".join(own.to_pylist())), minlength=len(total))
                n[: len(total)] += total
                total = n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], schema=arrow)

    rows = ids.select("width", "ids").mapInArrow(run, ddl).groupBy("id").agg(F.sum("n").alias("n"))
    return by_id(rows)


def by_id(rows: DataFrame) -> np.ndarray:
    """The values of (id, value) rows in the order of the ids, 0 where none is: one
    number per vocabulary entry."""
    table = rows.toArrow()
    ids, values = (c.to_numpy().astype(np.int64) for c in table.columns)
    out = np.zeros(int(ids.max(initial=-1)) + 1, np.int64)
    out[ids] = values
    return out


def write_tokens(docs: DataFrame, path: str, vocabulary: str, shards: int | None = None,
                 end_id: int = END_ID) -> None:
    """Encode ``docs`` into the files under ``path``."""
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = shared_path(spark, "token-ids")
    tokenise(docs, vocabulary, end_id).write.option("compression", "zstd").parquet(packed)
    ids = spark.read.schema(IDS_DDL).parquet(packed)
    lengths = code_lengths(count_ids(ids))
    used = np.flatnonzero(lengths)
    book = pa.table([pa.array(used, pa.int64()), pa.array(lengths[used], pa.int32())], names=["id", "bits"])
    spark.createDataFrame(book, "id bigint, bits int").coalesce(1).write.parquet(f"{path}/book")
    codes = canonical_codes(lengths)
    shared = spark.sparkContext.broadcast((lengths, codes))  # one entry per vocabulary id
    ddl = ("shard int, block bigint, doc_ids array<bigint>, lens array<int>, "
           "checkpoints array<bigint>, data binary")
    arrow = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder_of.cache_clear()
        lengths, codes = shared.value
        held: list[tuple] = []
        state = {"shard": TaskContext.get().partitionId(), "block": 0}  # ranges ascend with the partitions

        def block() -> pa.RecordBatch:
            ids = np.concatenate([x for _, x in held])
            data, checkpoints = pack(ids, codes, lengths)
            cols = [[state["shard"]], [state["block"]], [[d for d, _ in held]], [[len(x) for _, x in held]],
                    [checkpoints], [data]]
            state["block"] += 1
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow)

        n = 0
        for part in slices(batches):
            for doc_id, width, data in zip(*(c.to_pylist() for c in part.columns)):
                if n >= BLOCK_IDS:
                    yield block()
                    n = 0
                held.append((doc_id, unpacked(width, data)))
                n += len(held[-1][1])
        if held:
            yield block()

    order = ["doc_id", "_first", "_hash", "_seq"]
    (ids.select("*", F.substring("ids", 1, 64).alias("_first"), F.xxhash64("ids").alias("_hash"),
                F.monotonically_increasing_id().alias("_seq"))
     .repartitionByRange(shards, *order).sortWithinPartitions(*order)
     .select("doc_id", "width", "ids").mapInArrow(run, ddl)
     .write.option("compression", "none").parquet(f"{path}/blocks"))


DOCS_DDL = "shard int, block bigint, at int, doc_id bigint, ids binary"


def read_tokens(spark: SparkSession, path: str, then: Callable | None = None, ddl: str = DOCS_DDL) -> DataFrame:
    """(shard, block, at, doc_id, ids): every document of the files; ``at`` is
    its place in the block and ``ids`` are little-endian 32-bit ids. ``then`` takes
    these batches where they are decoded and gives those of ``ddl`` instead."""
    lengths = by_id(spark.read.schema("id bigint, bits int").parquet(f"{path}/book"))
    shared = spark.sparkContext.broadcast(lengths)
    arrow = arrow_schema(DOCS_DDL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder_of.cache_clear()
        ids, bits = decode_table(shared.value)
        for part in slices(batches, 16):
            shard, block, doc_ids, lens = (part.column(i).to_pylist() for i in range(4))
            points = [np.asarray(x.values) for x in part.column(4)]
            data = part.column(5).to_pylist()
            got = unpack([(d, p, sum(n)) for d, p, n in zip(data, points, lens)], ids, bits)
            cols: list[list] = [[], [], [], [], []]
            for s, b, own, sizes, flat in zip(shard, block, doc_ids, lens, got):
                flat = flat.astype("<u4")
                ends = np.cumsum(sizes).tolist()
                cols[0] += [s] * len(own)
                cols[1] += [b] * len(own)
                cols[2] += range(len(own))
                cols[3] += own
                cols[4] += [flat[e - n:e].tobytes() for e, n in zip(ends, sizes)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow)

    blocks = spark.read.schema("shard int, block bigint, doc_ids array<bigint>, lens array<int>, "
                               "checkpoints array<bigint>, data binary").parquet(f"{path}/blocks")
    return blocks.mapInArrow((lambda batches: then(run(batches))) if then else run, ddl)


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files.

    ``start`` adds three parts: ids of the shards before (one row a shard), of
    the shard's blocks before (a window per shard over one row a block), and of
    the block's documents before."""
    blocks = (spark.read.schema("shard int, block bigint, lens array<int>").parquet(f"{path}/blocks")
              .select("shard", "block", F.aggregate("lens", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n")))
    totals = blocks.groupBy("shard").agg(F.sum("n").alias("n")).orderBy("shard").collect()
    before, total = [], 0
    for r in totals:
        before.append((r["shard"], total))
        total += r["n"]
    w = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (blocks.join(F.broadcast(spark.createDataFrame(before, "shard int, shard_start bigint")), "shard")
               .select("shard", "block",
                       (F.col("shard_start") + F.coalesce(F.sum("n").over(w), F.lit(0))).alias("block_start")))
    ddl = "shard int, block bigint, doc_id bigint, inner bigint, n_tokens bigint, ids_crc32 bigint"
    arrow = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, place = 0, None
        for part in batches:
            shard, block, _, doc_id, ids = (c.to_pylist() for c in part.columns)
            inner = []
            for s, b, x in zip(shard, block, ids):
                if (s, b) != place:
                    place, at = (s, b), 0
                inner.append(at)
                at += len(x) // 4
            cols = [shard, block, doc_id, inner, [len(x) // 4 for x in ids], [zlib.crc32(x) for x in ids]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow)

    docs = read_tokens(spark, path, run, ddl)
    return docs.join(offsets, ["shard", "block"]).select(
        "doc_id", (F.col("block_start") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
