"""Operator 7, token-id files coded with a canonical length-limited Huffman code.

``write`` encodes documents in ascending doc_id order and stores a codebook and
blocks.  A block holds whole documents: their ids as one bit string, and a bit
offset for every ``STEP``-th id, from which decoding can begin.  ``read``
decodes blocks on their own, all checkpoints of a block in step, with one table
look-up an id.  Parquet is the container, so files are committed whole.

Defined results: null and empty texts are the end id alone; null doc_ids come
first; rows of equal doc_id keep some order among them; no rows, no blocks.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsgrain.llm.common import new_path, stored
from opsgrain.llm.pretokens import encoder_of, slices, tokenizer_path

MAX_BITS = 16
STEP = 256
BLOCK_IDS = 1 << 20

TOKENIZED = "part int, nth bigint, doc_id bigint, start_in_part bigint, n_tokens bigint, ids binary"
BLOCK = "first_id bigint, n_ids bigint, doc_ids array<bigint>, doc_sizes array<bigint>, bits binary, checkpoints binary"
_BLOCK = pa.schema([("first_id", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int64())),
                    ("bits", pa.binary()), ("checkpoints", pa.binary())])


# --- the code -----------------------------------------------------------------

def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code with at most ``max_bits`` bits
    (package-merge); 0 for ids that do not occur."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 1 << max_bits:
        raise ValueError("more ids than codes of that length")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.float64)
    n = len(order)
    levels = []  # of each level's sorted items: the leaf, or -1 for a package
    items, leaf = weight, np.arange(n)
    for _ in range(max_bits - 1):
        levels.append(leaf)
        even = len(items) // 2 * 2
        packages = items[0:even:2] + items[1:even:2]
        merged = np.concatenate([weight, packages])
        kind = np.concatenate([np.arange(n), np.full(len(packages), -1)])
        at = np.argsort(merged, kind="stable")
        items, leaf = merged[at], kind[at]
    levels.append(leaf)
    take, length = 2 * n - 2, np.zeros(n, np.int64)
    for leaf in reversed(levels):  # each package taken stands for two items of the level below
        chosen = leaf[:take]
        length += np.bincount(chosen[chosen >= 0], minlength=n)
        take = 2 * int((chosen < 0).sum())
    out[order] = length
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id), each the one before plus one."""
    codes = np.zeros(len(lengths), np.uint32)
    ids = np.flatnonzero(lengths)
    ids = ids[np.argsort(lengths[ids], kind="stable")]
    if len(ids):
        bits = lengths[ids].astype(np.int64)
        width = 1 << (int(bits[-1]) - bits)  # share of the longest code's range
        codes[ids] = (np.cumsum(width) - width) >> (int(bits[-1]) - bits)
    return codes


def decode_table(lengths: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """For each ``max_bits`` bits that can come: the id, and its code's length."""
    ids = np.flatnonzero(lengths)
    ids = ids[np.argsort(lengths[ids], kind="stable")]
    span = 1 << (max_bits - lengths[ids].astype(np.int64))
    symbol, size = np.zeros(1 << max_bits, np.uint32), np.ones(1 << max_bits, np.int64)
    symbol[:span.sum()], size[:span.sum()] = np.repeat(ids, span), np.repeat(lengths[ids], span)
    return symbol, size


def encode_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray, step: int = STEP) -> tuple[bytes, bytes]:
    """The bit string (big-endian 32-bit words) and the checkpoints."""
    if not len(ids):
        return b"", b""
    size = lengths[ids].astype(np.int64)
    end = np.cumsum(size)
    at = end - size
    word = at >> 5
    wide = codes[ids].astype(np.uint64) << (64 - (at & 31) - size).astype(np.uint64)
    # every word has an id that begins in it, as no code is longer than 32 bits
    first = np.flatnonzero(np.diff(word, prepend=-1))
    total = np.bitwise_or.reduceat(wide, first)
    words = np.zeros(int(word[-1]) + 2, np.uint32)
    words[:-1] = (total >> np.uint64(32)).astype(np.uint32)
    words[1:] |= (total & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return words.astype(">u4").tobytes(), at[::step].astype("<u8").tobytes()


def decode_bits(bits: bytes, checkpoints: bytes, n: int, table: tuple[np.ndarray, np.ndarray], step: int = STEP, max_bits: int = MAX_BITS) -> np.ndarray:
    """The ids of a block: one look-up a checkpoint and round."""
    symbol, size = table
    words = np.append(np.frombuffer(bits, ">u4").astype(np.uint64), np.zeros(2, np.uint64))
    pairs = words[:-1] << np.uint64(32) | words[1:]
    at = np.frombuffer(checkpoints, "<u8").astype(np.int64)
    out = np.zeros((step, len(at)), np.uint32)
    mask = (1 << max_bits) - 1
    for k in range(min(step, n)):
        lanes = len(at) if k < n - (len(at) - 1) * step else len(at) - 1
        at = at[:lanes]
        window = (pairs[at >> 5] >> (64 - max_bits - (at & 31)).astype(np.uint64)).astype(np.int64) & mask
        out[k, :lanes] = symbol[window]
        at = at + size[window]
    return out.T.reshape(-1)[:n]


# --- files --------------------------------------------------------------------

def tokenized(documents: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """Ids of each document in ascending doc_id order: partitions are ranges of
    doc_id, numbered by ``part``, and ``nth`` is the place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = encoder_of(path), TaskContext.get().partitionId()
        nth = start = 0
        for batch in batches:
            doc_ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices(texts):
                ids, ends = encoder.encode(texts[a:b], end_id)
                size = np.diff(ends, prepend=0)
                offsets = pa.py_buffer((np.append(0, ends) * 4).astype(np.int32).tobytes())
                blob = pa.Array.from_buffers(pa.binary(), b - a, [None, offsets, pa.py_buffer(ids.astype("<u4").tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(b - a, part, np.int32)), pa.array(np.arange(nth, nth + b - a)), doc_ids.slice(a, b - a),
                     pa.array(start + ends - size), pa.array(size), blob],
                    names=["part", "nth", "doc_id", "start_in_part", "n_tokens", "ids"])
                nth, start = nth + b - a, start + len(ids)

    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id").mapInArrow(run, TOKENIZED)


def _counts(ids: DataFrame) -> np.ndarray:
    """How often each id occurs, over all documents; as long as the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            col = batch.column(0)
            if len(col):
                offsets = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1]
                own = np.bincount(np.frombuffer(col.buffers()[2], "<u4", count=(offsets[-1] - offsets[0]) // 4, offset=offsets[0]))
                if len(own) > len(total):
                    own[:len(total)] += total
                    total = own
                else:
                    total[:len(own)] += own
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])

    rows = ids.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        out[r["id"]] = r["n"]
    return out


def write(documents: DataFrame, out: str, path: str | None = None, end_id: int = 0) -> None:
    """Write ``out/codebook`` and ``out/blocks``."""
    spark = documents.sparkSession
    path = path or tokenizer_path("byte_bpe_50k.json")
    docs = stored(tokenized(documents, path, end_id), "token-ids")
    lengths = code_lengths(_counts(docs))
    codes = canonical_codes(lengths)
    at = np.flatnonzero(lengths)
    spark.createDataFrame(pa.table({"id": pa.array(at), "bits": pa.array(lengths[at].astype(np.int32))})).coalesce(1).write.parquet(f"{out}/codebook")
    parts = docs.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()  # one row a partition
    before, total = {}, 0
    for r in parts:
        before[r["part"]] = total
        total += r["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int | None, np.ndarray]] = []

        def block() -> pa.RecordBatch:
            ids = np.concatenate([x[2] for x in held])
            bits, marks = encode_bits(ids, codes, lengths)
            row = {"first_id": held[0][0], "n_ids": len(ids), "doc_ids": [x[1] for x in held], "doc_sizes": [len(x[2]) for x in held], "bits": bits, "checkpoints": marks}
            held.clear()
            return pa.RecordBatch.from_pylist([row], _BLOCK)

        size = 0
        for batch in batches:
            cols = [batch.column(c) for c in ("part", "doc_id", "start_in_part", "ids")]
            for part, doc, start, ids in zip(*(c.to_pylist() for c in cols[:3]), cols[3], strict=True):
                first = before[part] + start
                if held and (size >= BLOCK_IDS or first != held[0][0] + size):  # full, or not the next document
                    yield block()
                    size = 0
                own = np.frombuffer(ids.as_buffer(), "<u4")
                held.append((first, doc, own))
                size += len(own)
        if held:
            yield block()

    docs.select("part", "doc_id", "start_in_part", "ids").mapInArrow(run, BLOCK).write.option("compression", "none").parquet(f"{out}/blocks")


def read(spark: SparkSession, out: str) -> DataFrame:
    """Every document of the files: doc_id, ``start`` (ids before it),
    ``n_tokens`` and its ``ids`` (little-endian unsigned 32-bit)."""
    book = spark.read.parquet(f"{out}/codebook").collect()  # at most the vocabulary
    lengths = np.zeros(max((r["id"] for r in book), default=-1) + 1, np.uint8)
    for r in book:
        lengths[r["id"]] = r["bits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(lengths)
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r] for c in batch.schema.names}
                ids = decode_bits(row["bits"].as_py(), row["checkpoints"].as_py(), row["n_ids"].as_py(), table)
                size = np.array(row["doc_sizes"].as_py(), np.int64)
                ends = np.cumsum(size)
                blob = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer((np.append(0, ends) * 4).astype(np.int32).tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [row["doc_ids"].values, pa.array(row["first_id"].as_py() + ends - size), pa.array(size), blob], names=["doc_id", "start", "n_tokens", "ids"])

    return spark.read.parquet(f"{out}/blocks").mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def round_trip(documents: DataFrame, path: str | None = None) -> DataFrame:
    """Write to the shared folder, read back; the checksum stands for the ids."""
    out = new_path(documents.sparkSession, "token-files")
    write(documents, out, path)
    return read(documents.sparkSession, out).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
