"""Operator 6, best-two-fit packing of token ids into sequences.

Documents are cut into pieces of at most ``capacity`` ids.  The plan is made
from the histogram of piece lengths alone (at most ``capacity`` numbers,
whatever the data): bins of one pattern are planned together.  Each piece then
finds its bin from its rank among the pieces of its length, which comes from
per-task counts, so no length, however common, meets in one task.

Defined results: null and empty texts are one piece, the end id; repeated rows
and repeated or null doc_ids are separate documents; no rows, no sequences.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsgrain.llm.common import broadcast_if_small, in_few_files, stored
from opsgrain.llm.pretokens import encoder_of, slices, tokenizer_path

CAPACITY = 2048
PIECES = "doc_id bigint, piece int, start bigint, length int, task int, nth bigint, ids binary"


def cut(documents: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """The pieces of every document: a longer one is cut into pieces of
    ``capacity`` ids, of which the first may be shorter.  ``task`` and ``nth``
    number the pieces of one length within a task; ``ids`` are little-endian
    unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = encoder_of(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            doc_ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices(texts):
                ids, ends = encoder.encode(texts[a:b], end_id)
                size = np.diff(ends, prepend=0)
                n = -(-size // capacity)
                doc = np.repeat(np.arange(b - a), n)
                piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                head = size - (n - 1) * capacity
                start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[doc], capacity)
                order = np.argsort(length, kind="stable")
                per = np.bincount(length, minlength=capacity + 1)
                nth = np.empty(len(length), np.int64)
                nth[order] = np.arange(len(length)) - (np.cumsum(per) - per)[length[order]] + seen[length[order]]
                seen += per
                offsets = pa.py_buffer((np.append(0, np.cumsum(length)) * 4).astype(np.int32).tobytes())
                blob = pa.Array.from_buffers(pa.binary(), len(length), [None, offsets, pa.py_buffer(ids.astype("<u4").tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.slice(a, b - a).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length.astype(np.int32)),
                     pa.array(np.full(len(length), task, np.int32)), pa.array(nth), blob],
                    names=["doc_id", "piece", "start", "length", "task", "nth", "ids"])

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, PIECES)


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Patterns (lengths of one bin) and how many bins follow each.

    A bin takes the longest piece left, then the longest that still fits, until
    none does.  Then its smallest piece is replaced by two unpacked ones that
    fill the expanded gap better, as long as some do.  Each pattern is repeated
    until a length runs short, so the work depends on ``capacity`` only."""
    left = np.zeros(capacity + 1, np.int64)
    for k, v in counts.items():
        left[k] = v
    out: list[tuple[list[int], int]] = []
    while True:
        lengths = np.flatnonzero(left)
        if not len(lengths):
            return out
        free = left.copy()
        bin_, gap, top = [], capacity, len(lengths) - 1
        while gap and top >= 0:
            top = min(top, int(np.searchsorted(lengths, gap, "right")) - 1)
            while top >= 0 and not free[lengths[top]]:
                top -= 1
            if top < 0:
                break
            x = int(lengths[top])
            k = min(int(free[x]), gap // x)
            bin_ += [x] * k
            free[x] -= k
            gap -= k * x
        while gap and len(bin_) > 1:
            smallest = bin_[-1]
            pair = _tightest_pair(free, gap + smallest)
            if sum(pair) <= smallest:
                break
            bin_.pop()
            free[smallest] += 1
            for x in pair:
                free[x] -= 1
            gap += smallest - sum(pair)
            bin_ = sorted([*bin_, *pair], reverse=True)
        need = np.bincount(bin_, minlength=capacity + 1)
        used = np.flatnonzero(need)
        times = int((left[used] // need[used]).min())
        left[used] -= times * need[used]
        out.append((bin_, times))


def _tightest_pair(free: np.ndarray, room: int) -> tuple[int, int]:
    """Two free lengths with the largest sum of at most ``room``; (0, 0) if none."""
    have = free[:room] > 0
    best_below = np.maximum.accumulate(np.where(have, np.arange(room), 0))
    a = np.flatnonzero(have)
    if not len(a):
        return 0, 0
    b = best_below[np.minimum(room - a, room - 1)]
    twice = (b == a) & (free[a] < 2)
    if twice.any():
        b = np.where(twice, best_below[np.maximum(a - 1, 0)], b)
    total = np.where(b > 0, a + b, 0)
    k = int(total.argmax())
    return (int(a[k]), int(b[k])) if total[k] else (0, 0)


def places(plan: list[tuple[list[int], int]], capacity: int = CAPACITY) -> np.ndarray:
    """The plan as intervals of ranks, sorted by (length, first rank): columns
    length, first rank, first sequence, pieces of that length a sequence, offset."""
    rank = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    for lengths, times in plan:
        offset = 0
        for x in sorted(set(lengths), reverse=True):
            k = lengths.count(x)
            rows.append((x, int(rank[x]), sequence, k, offset))
            rank[x] += k * times
            offset += k * x
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(documents: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = 0, payload: Column | None = None) -> DataFrame:
    """Every piece with its place: ``sequence_id`` and ``offset``.  ``payload``
    says what to return of its ids, by default ``ids`` themselves."""
    path = path or tokenizer_path("byte_bpe_50k.json")
    pieces = stored(cut(documents, path, capacity, end_id), "pieces")
    by_task = stored(in_few_files(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), pieces.count()), "piece-counts")
    total = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    where = places(plan_bins(total, capacity), capacity)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    narrow = pieces.select("doc_id", "piece", "start", "length", "task", "nth", F.col("ids") if payload is None else payload)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = where[:, 0] << 48 | where[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = where[np.searchsorted(keys, length << 48 | rank, "right") - 1] if len(where) else where
            k = rank - at[:, 1]
            kept = batch.drop_columns(["rank"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(at[:, 2] + k // at[:, 3]), pa.array(at[:, 4] + k % at[:, 3] * length)],
                names=[*kept.schema.names, "sequence_id", "offset"])

    located = narrow.join(broadcast_if_small(stored(in_few_files(offsets, by_task.count()), "piece-offsets")), ["task", "length"]).select(
        "doc_id", "piece", "start", F.col("length").cast("bigint").alias("length"), narrow[narrow.columns[-1]], (F.col("nth") + F.col("before")).alias("rank"))
    schema = T.StructType([f for f in located.schema.fields if f.name != "rank"]).add("sequence_id", "long").add("offset", "long")
    return located.mapInArrow(find, schema)
