"""Operator 1, token counts without ids.

Per block of documents, the frequencies of each distinct pre-token are one row:
the pre-token and its postings (place of the document in the block, count).  After
one exchange and a sort by pre-token, its pieces are counted once and joined to
its rows from all blocks; the products are summed per document.

Defined results: null and empty texts have no bytes and no tokens; repeated
rows and repeated or null doc_ids are counted row by row; no rows, no result.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsgrain.llm.pretokens import DOC_END, slices, splitter_of, tokenizer_path

#: A block ends beyond so many characters or documents (places are 16 bits).
BLOCK_CHARS = 32_000_000
BLOCK_DOCS = 60_000
POSTING = np.dtype([("place", "<u2"), ("n", "u1")])

FREQUENCIES = "block bigint, piece string, postings binary, docs array<struct<place:int,doc_id:bigint,n_bytes:bigint>>"
_DOC = pa.struct([("place", pa.int32()), ("doc_id", pa.int64()), ("n_bytes", pa.int64())])
_SCHEMA = pa.schema([("block", pa.int64()), ("piece", pa.string()), ("postings", pa.binary()), ("docs", pa.list_(_DOC))])


class _Block:
    """Pre-token frequencies of the documents of one block."""

    def __init__(self, number: int):
        self.number, self.chars = number, 0
        self.codes: dict[str, int] = {}
        self.docs: list[dict] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, splitter, ids: list, texts: list[str]) -> None:
        joined, bounds, codes, first = splitter.split(texts)
        pieces = [joined[a:b] for a, b in zip(bounds[first].tolist(), bounds[first + 1].tolist(), strict=True)]
        names = splitter.special_of
        pieces = [names.get(p, p) for p in pieces]
        known = self.codes
        own = np.fromiter((known.setdefault(p, len(known)) for p in pieces), np.int64, len(pieces))
        is_end = np.array([p == chr(DOC_END) for p in pieces])[codes]
        place = np.cumsum(is_end) - is_end
        pair, n = np.unique((own[codes] * len(texts) + place)[~is_end], return_counts=True)
        self.parts.append((pair // len(texts), pair % len(texts) + len(self.docs), n))
        base = len(self.docs)
        self.docs += [{"place": base + k, "doc_id": i, "n_bytes": len(t.encode())} for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
        self.chars += len(joined)

    def rows(self) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pylist([{"block": self.number, "docs": self.docs}], _SCHEMA)
        code, place, n = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        times = np.maximum(1, -(-n // 255))  # a posting counts to 255; a larger count takes several
        last = np.cumsum(times) - 1
        code, place = np.repeat(code, times), np.repeat(place, times)
        many = np.full(len(code), 255)
        many[last] = n - 255 * (times - 1)
        order = np.argsort(code, kind="stable")
        posts = np.empty(len(code), POSTING)
        posts["place"], posts["n"] = place[order], many[order]
        ends = np.cumsum(np.bincount(code, minlength=len(self.codes)))
        words = list(self.codes)
        step = 50_000
        for a in range(0, len(words), step):
            b = min(a + step, len(words))
            lo = ends[a - 1] if a else 0
            blob = pa.py_buffer(posts[lo:ends[b - 1]].tobytes())
            offsets = np.concatenate([[0], ends[a:b] - lo]) * POSTING.itemsize
            binary = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), blob])
            keep = np.diff(offsets) > 0
            text = pa.array([w if k else None for w, k in zip(words[a:b], keep.tolist(), strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(b - a, self.number)), text, binary, pa.nulls(b - a, pa.list_(_DOC))], schema=_SCHEMA
            ).filter(pa.array(keep))


def frequencies(documents: DataFrame, path: str) -> DataFrame:
    """Rows of two kinds: a block's documents, and a pre-token's postings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = splitter_of(path)
        part, made = TaskContext.get().partitionId(), 0
        block = _Block(part << 32)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices(texts):
                if block.docs and (block.chars + sum(map(len, texts[a:b])) > BLOCK_CHARS or len(block.docs) + b - a > BLOCK_DOCS):
                    yield from block.rows()
                    made += 1
                    block = _Block((part << 32) + made)
                block.add(splitter, ids[a:b], texts[a:b])
        if block.docs:
            yield from block.rows()

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, FREQUENCIES)


class _Sums:
    """Pieces per document, for the documents of many blocks at a time."""

    def __init__(self) -> None:
        self.held: dict[int, np.ndarray] = {}

    def add(self, block: np.ndarray, posts: pa.Array, pieces: np.ndarray) -> None:
        offsets = np.frombuffer(posts.buffers()[1], np.int32)[posts.offset:posts.offset + len(posts) + 1]
        flat = np.frombuffer(posts.buffers()[2], POSTING, count=(offsets[-1] - offsets[0]) // POSTING.itemsize, offset=offsets[0])
        size = np.diff(offsets) // POSTING.itemsize
        weight = np.repeat(pieces, size) * flat["n"]
        of = np.repeat(block, size)
        for b in np.unique(block).tolist():
            own = of == b
            v = np.bincount(flat["place"][own], weights=weight[own]).astype(np.int64)
            old = self.held.get(b)
            if old is None or len(old) < len(v):
                self.held[b], v = v, old
            if v is not None:
                self.held[b][:len(v)] += v

    def size(self) -> int:
        return sum(map(len, self.held.values()))

    def rows(self) -> Iterator[pa.RecordBatch]:
        """One row a block: the sums of its documents, packed."""
        for block, v in self.held.items():
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([v.astype("<i8").tobytes()], pa.binary()), pa.nulls(1, pa.list_(_DOC))], names=_SUMS)
        self.held.clear()


_SUMS = ["block", "sums", "docs"]


def _count_and_join(path: str):
    """For frequencies sorted by pre-token: rows of one pre-token stand
    together, so its pieces are counted once and joined to all its postings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, sums = splitter_of(path), _Sums()
        special = dict.fromkeys(splitter.special_of.values(), 1)
        last: tuple[str | None, int] = (None, 0)
        for batch in batches:
            docs = batch.filter(batch.column("docs").is_valid())
            if docs.num_rows:
                yield pa.RecordBatch.from_arrays([docs.column("block"), pa.nulls(docs.num_rows, pa.binary()), docs.column("docs")], names=_SUMS)
            freq = batch.filter(batch.column("piece").is_valid())
            if not freq.num_rows:
                continue
            pieces = freq.column("piece").to_pylist()
            counts = np.empty(len(pieces), np.int64)
            for k, p in enumerate(pieces):
                if p != last[0]:
                    last = p, special.get(p) or int(splitter.encode_pieces([p])[1][0])
                counts[k] = last[1]
            sums.add(freq.column("block").to_numpy(), freq.column("postings"), counts)
            if sums.size() > 4_000_000:
                yield from sums.rows()
        yield from sums.rows()

    return run


def _per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One block: its documents, and the sums from all partitions, added up as
    they come."""
    total, docs = np.zeros(BLOCK_DOCS, np.int64), None
    for batch in batches:
        for sums in batch.column("sums"):
            if sums.is_valid:
                v = np.frombuffer(sums.as_buffer(), "<i8")
                total[:len(v)] += v
        own = batch.column("docs").drop_null()
        docs = own[0].values if len(own) else docs
    place, doc_id, n_bytes = docs.flatten()
    yield pa.RecordBatch.from_arrays([doc_id, n_bytes, pa.array(total[place.to_numpy()])], names=["doc_id", "n_bytes", "n_tokens"])


def token_counts(documents: DataFrame, path: str | None = None) -> DataFrame:
    """Each row's ``doc_id``, ``n_bytes`` (UTF-8) and ``n_tokens``."""
    path = path or tokenizer_path("byte_bpe_50k.json")
    # one exchange brings each pre-token's rows together; a block's documents travel under the block's number
    freq = frequencies(documents, path).repartition(F.coalesce("piece", F.col("block").cast("string"))).sortWithinPartitions("piece")
    sums = freq.mapInArrow(_count_and_join(path), "block bigint, sums binary, docs array<struct<place:int,doc_id:bigint,n_bytes:bigint>>")
    return sums.groupBy("block").applyInArrow(_per_document, "doc_id bigint, n_bytes bigint, n_tokens bigint")
