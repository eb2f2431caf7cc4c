"""Operator 12, ranked lexical search by pair-bound MaxScore.

``build`` indexes all documents: inverted blocks of bounded size (every term of
their texts, postings with frequencies), document frequencies and totals.
``prepare`` takes a block of queries, gives their terms their impacts, and
precomputes in every index block the intersection lists of the term pairs that
stand next to each other in a query's order (rarest term first), each with its
joint maximum impact.  ``search`` runs MaxScore in every block.  What a run of
neighbouring terms can add is bounded by the cheapest cover of the run with
single terms' maxima and pairs' joint maxima, which is never above the sum of
the single maxima.  Blocks whose bound is below the query's 50th best score so
far are skipped, terms from which the rest cannot lift a new document are only
looked up for the documents that still can get in, and the documents of the
intersection lists are scored first, for an early threshold.  The bounds are
exact, so the ranking is that of an exhaustive search.

Scale: a task holds some megabytes of index blocks (a batch to its worker, a row
group) and one block of queries (at most ``QUERY_TERMS`` terms, unless one query
alone has more); a posting has three bytes, and eight more if its term occurs
``LARGE`` times or more; a task returns at most ``top`` rows a query, which are
cut again by salted, then whole windows.

Defined results: a null or empty text, and one without a term, is no document
and no query; a null doc_id comes after the others of equal score, and rows
with one doc_id are documents of their own; repeated items are ranked each; a
very long text is a block of its own; without documents or items there are no
rows.  Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsgrain.llm.common import WIDE_ROWS, small_batches, stored

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")  # over lowered UTF-8, whose other bytes are all above
BLOCK_POSTINGS = 262_144
BLOCK_DOCS = 60_000  # places fit 16 bits
LARGE = 255  # stands for every frequency from it on
QUERY_TERMS = 100_000
SALTS = 64

INDEX = "block bigint, docs bigint, length bigint, ids binary, bare binary, lengths binary, terms array<string>, held array<int>, places binary, tfs binary, large binary"
IMPACTS = "block bigint, ids binary, bare binary, terms binary, starts binary, places binary, shares binary, pairs binary, joint binary, pair_starts binary, pair_places binary"


def terms_of(text: bytes | None) -> Counter:
    """Terms of a text in UTF-8 with their occurrences (``bytes.lower`` lowers A-Z only)."""
    return Counter(TERM.findall(text.lower())) if text else Counter()


def packed_tfs(tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies in a byte each, and those of ``LARGE`` or more."""
    return np.minimum(tf, LARGE).astype(np.uint8), tf[tf >= LARGE]


def unpacked_tfs(tfs: bytes, large: bytes) -> np.ndarray:
    out = np.frombuffer(tfs, np.uint8).astype(np.int64)
    out[out == LARGE] = np.frombuffer(large, np.int64)
    return out


class Index(NamedTuple):
    blocks: DataFrame
    frequencies: DataFrame  # term, df
    docs: int
    length: int


def _row(block: int, ids: list, lengths: list, numbers: dict, term: list, tf: list, per: list) -> pa.RecordBatch:
    """One index block; ``bare`` marks documents without an id."""
    term, tf = np.array(term, np.int32), np.array(tf, np.int64)
    order = np.argsort(term, kind="stable")
    place = np.repeat(np.arange(len(per), dtype=np.uint16), per)[order]
    bare = np.array([i is None for i in ids], np.uint8)
    own = np.array([i or 0 for i in ids], np.int64)
    words = pa.array(list(numbers), pa.binary()).cast(pa.string())
    held = pa.array(np.bincount(term, minlength=len(numbers)).astype(np.int32))
    one = [pa.array([x]) for x in (block, len(ids), sum(lengths), own.tobytes(), bare.tobytes(), np.array(lengths, np.int64).tobytes())]
    lists = [pa.ListArray.from_arrays(pa.array([0, len(numbers)], pa.int32()), x) for x in (words, held)]
    tf = tf[order]
    last = [pa.array([x.tobytes()]) for x in (place, *packed_tfs(tf))]
    return pa.RecordBatch.from_arrays([*one, *lists, *last], names=[c.split()[0] for c in INDEX.split(", ")])


def build(documents: DataFrame, block_postings: int = BLOCK_POSTINGS) -> Index:
    """The index of all documents with at least one term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids, lengths, numbers, term, tf, per = [], [], {}, [], [], []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = terms_of(text.as_py())
                if not own:
                    continue
                ids.append(doc_id)
                lengths.append(own.total())
                term += [numbers.setdefault(t, len(numbers)) for t in own]
                tf += own.values()
                per.append(len(own))
                if len(term) >= block_postings or len(ids) >= BLOCK_DOCS:
                    yield _row(block, ids, lengths, numbers, term, tf, per)
                    block += 1
                    ids, lengths, numbers, term, tf, per = [], [], {}, [], [], []
        if ids:
            yield _row(block, ids, lengths, numbers, term, tf, per)

    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    with small_batches(documents.sparkSession):
        blocks = stored(texts.mapInArrow(run, INDEX), "lexical-blocks", **WIDE_ROWS)
    total = blocks.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("l")).first()
    held = blocks.select(F.explode(F.arrays_zip("terms", "held")).alias("x"))
    frequencies = held.groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.held").alias("df"))
    return Index(blocks, stored(frequencies, "lexical-frequencies"), total["n"], total["l"])


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


class Queries(NamedTuple):
    """A block of queries: numbered terms, each query's terms rarest first,
    and the numbered pairs of neighbouring terms."""

    numbers: dict[str, int]
    weights: np.ndarray
    rows: list[int]
    terms: list[np.ndarray]
    pairs: np.ndarray  # pairs x 2
    query_pairs: list[np.ndarray]  # one fewer than the query's terms

    @staticmethod
    def of(queries: list[tuple[int, list[str]]], weights: dict[str, int]) -> Queries:
        numbers = {t: i for i, t in enumerate(weights)}
        rows, terms, pairs, own_pairs = [], [], {}, []
        for row, words in queries:
            ranked = sorted(set(words), key=lambda t: (-weights[t], t))
            own = [numbers[t] for t in ranked]
            rows.append(row)
            terms.append(np.array(own, np.int64))
            own_pairs.append(np.array([pairs.setdefault(p, len(pairs)) for p in zip(own, own[1:], strict=False)], np.int64))
        return Queries(numbers, np.array(list(weights.values()), np.int64), rows, terms, np.array(list(pairs), np.int64).reshape(-1, 2), own_pairs)


def damping(lengths: np.ndarray, docs: int, length: int) -> np.ndarray:
    """What a document's length adds to the divisor of its terms' shares; the
    products are made in integers of any size."""
    return 20 * np.array([50 + 50 * n * docs // length for n in lengths.tolist()], np.int64)


def prepare(index: Index, queries: Queries) -> DataFrame:
    """Per index block: impacts of the queries' terms, and the intersection
    lists of their pairs with joint maximum impacts."""
    known = index.blocks.sparkSession.sparkContext.broadcast(queries)
    docs, total = index.docs, index.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = known.value
        for batch in batches:
            for x in range(batch.num_rows):
                column = {n: batch.column(n)[x] for n in batch.schema.names}
                damped = damping(np.frombuffer(column["lengths"].as_py(), np.int64), docs, total)
                held = np.array(column["held"].values.to_numpy(), np.int64)
                first = np.append(0, np.cumsum(held))
                place = np.frombuffer(column["places"].as_py(), np.uint16)
                tf = unpacked_tfs(column["tfs"].as_py(), column["large"].as_py())
                found = sorted((q.numbers[t], i) for i, t in enumerate(column["terms"].as_py()) if t in q.numbers)
                if not found:
                    continue
                places, parts, at = [], [], {}
                for k, (t, i) in enumerate(found):
                    a, b = first[i], first[i + 1]
                    f = tf[a:b]
                    places.append(place[a:b])
                    parts.append(1_000_000_000 * f // (1000 * f + damped[place[a:b]]))
                    at[t] = k
                numbers, joint, lists = [], [], []
                for p, (a, b) in enumerate(q.pairs.tolist()):
                    if a in at and b in at:
                        i, j = at[a], at[b]
                        both, u, v = np.intersect1d(places[i], places[j], assume_unique=True, return_indices=True)
                        if len(both):
                            numbers.append(p)
                            joint.append((parts[i][u] * q.weights[a] + parts[j][v] * q.weights[b]).max())
                            lists.append(both)

                def packed(values, kind) -> pa.Array:
                    return pa.array([np.asarray(values, kind).tobytes()])

                def edges(arrays: list) -> np.ndarray:
                    return np.append(0, np.cumsum([len(y) for y in arrays]))

                yield pa.RecordBatch.from_arrays([
                    *(pa.array([column[c].as_py()]) for c in ("block", "ids", "bare")),
                    packed([t for t, _ in found], np.int32), packed(edges(places), np.int64), packed(np.concatenate(places), np.uint16), packed(np.concatenate(parts), np.int32),
                    packed(numbers, np.int32), packed(joint, np.int64), packed(edges(lists), np.int64), packed(np.concatenate(lists) if lists else [], np.uint16),
                ], names=[c.split()[0] for c in IMPACTS.split(", ")])

    with small_batches(index.blocks.sparkSession):
        out = stored(index.blocks.mapInArrow(run, IMPACTS), "lexical-impacts", **WIDE_ROWS)
    known.destroy()
    return out


def suffix_bounds(single: list[int], joint: list[int]) -> list[int]:
    """What terms i, i+1, ... can add together, for each i: the cheapest cover
    by single maxima and by pairs of neighbours, of which ``joint[i]`` is the
    joint maximum of i and i+1 over documents that hold both."""
    out = [0] * (len(single) + 1)
    for i in range(len(single) - 1, -1, -1):
        out[i] = single[i] + out[i + 1]
        if i + 1 < len(single):
            out[i] = min(out[i], max(single[i], single[i + 1], joint[i]) + out[i + 2])
    return out


class Block:
    """Impacts and pair lists of one index block."""

    def __init__(self, row: dict, queries: Queries):
        def unpacked(name: str, kind) -> np.ndarray:
            return np.frombuffer(row[name].as_py(), kind)

        terms, start = unpacked("terms", np.int32), unpacked("starts", np.int64)
        place, share = unpacked("places", np.uint16).astype(np.int64), unpacked("shares", np.int32).astype(np.int64)
        self.ids, self.bare = unpacked("ids", np.int64), unpacked("bare", np.uint8)
        self.weights = queries.weights
        self.lists = {int(t): (place[a:b], share[a:b] * queries.weights[t]) for t, a, b in zip(terms, start, start[1:], strict=False)}
        self.largest = np.zeros(len(queries.weights), np.int64)
        for t, (_, impact) in self.lists.items():
            self.largest[t] = impact.max()
        self.joint = np.zeros(len(queries.pairs), np.int64)
        pairs, start = unpacked("pairs", np.int32), unpacked("pair_starts", np.int64)
        self.joint[pairs] = unpacked("joint", np.int64)
        both = unpacked("pair_places", np.uint16)
        self.both = {int(p): both[a:b] for p, a, b in zip(pairs, start, start[1:], strict=False)}

    def looked_up(self, terms: list[int], places: np.ndarray) -> np.ndarray:
        """The scores of some documents, by look-ups."""
        out = np.zeros(len(places), np.int64)
        for t in terms:
            if t in self.lists:
                place, impact = self.lists[t]
                at = np.minimum(np.searchsorted(place, places), len(place) - 1)
                out += np.where(place[at] == places, impact[at], 0)
        return out

    def early(self, terms: list[int], pairs: list[int], least: int, top: int) -> int:
        """A threshold from the documents of the strongest intersection lists."""
        some = np.zeros(0, np.int64)
        for p in sorted((p for p in pairs if p in self.both), key=lambda p: -self.joint[p]):
            some = np.union1d(some, self.both[p].astype(np.int64))
            if len(some) >= top:
                return max(least, int(np.partition(self.looked_up(terms, some), -top)[-top]))
        return least

    def ranked(self, terms: np.ndarray, pairs: np.ndarray, least: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of all documents with a score of at least
        ``least`` (and above 0), except such as ``top`` others here surpass."""
        single = self.largest[terms].tolist()
        bound = suffix_bounds(single, self.joint[pairs].tolist())
        if bound[0] < max(least, 1):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        own = terms.tolist()
        if least == 0:
            least = self.early(own, pairs.tolist(), least, top)
        least = max(least, 1)
        total = np.zeros(len(self.ids), np.int64)
        i = 0
        while i < len(own) and bound[i] >= least:  # essential terms
            if single[i]:
                place, impact = self.lists[own[i]]
                total[place] += impact
            i += 1
        left = np.flatnonzero(total + bound[i] >= least)
        left = left[total[left] > 0]
        score = total[left]
        for j in range(i, len(own)):
            if not len(left):
                break
            if single[j]:
                score = score + self.looked_up(own[j:j + 1], left)
                stay = score + bound[j + 1] >= least
                left, score = left[stay], score[stay]
        return left, score


def search(impacts: DataFrame, queries: Queries, top: int) -> DataFrame:
    """``(query, doc_id, score, task)``: each task's best of each query."""
    known = impacts.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = known.value
        none = np.zeros(0, np.int64)
        best = [(none, none, none) for _ in q.rows]  # scores, ids, whether the id is null
        for batch in batches:
            for x in range(batch.num_rows):
                block = Block({n: batch.column(n)[x] for n in batch.schema.names}, q)
                for k, (terms, pairs) in enumerate(zip(q.terms, q.query_pairs, strict=True)):
                    score, doc, bare = best[k]
                    least = int(score[-1]) if len(score) >= top else 0
                    place, got = block.ranked(terms, pairs, least, top)
                    if len(place):
                        score, doc, bare = np.append(score, got), np.append(doc, block.ids[place]), np.append(bare, block.bare[place])
                        order = np.lexsort((doc, bare, -score))[:top]
                        best[k] = score[order], doc[order], bare[order]
        task = TaskContext.get().partitionId()
        for row, (score, doc, bare) in zip(q.rows, best, strict=True):
            if len(score):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(score), row)), pa.array(doc, mask=bare > 0), pa.array(score), pa.array(np.full(len(score), task % SALTS, np.int32))],
                                                 names=["query", "doc_id", "score", "task"])

    with small_batches(impacts.sparkSession):
        out = stored(impacts.mapInArrow(run, "query bigint, doc_id bigint, score bigint, task int"), "lexical-found")
    known.destroy()
    return out


def lexical_search(documents: DataFrame, items: DataFrame, top: int = 50, query_terms: int = QUERY_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of each row
    of ``items(item_id, text)``.  Queries are taken in blocks of about
    ``query_terms`` terms, each a pass over the stored index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in range(batch.num_rows):
                words = pa.array(list(terms_of(batch.column(1)[x].as_py())), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0)[x:x + 1], pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)], names=["query", "terms"])

    asked = stored(items.select(F.monotonically_increasing_id().alias("query"), "item_id", F.col("text").cast("binary").alias("text")), "lexical-items")
    words = stored(asked.select("query", "text").mapInArrow(run, "query bigint, terms array<string>").where(F.size("terms") > 0), "lexical-queries")
    index = build(documents)
    terms = words.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-terms // query_terms)
    found = None
    for b in range(blocks if index.docs else 0):
        block = words.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b)
        wanted = block.select(F.explode("terms").alias("term")).distinct()
        held = {r["term"]: r["df"] for r in index.frequencies.join(F.broadcast(wanted), "term").collect()}  # bounded by the block
        asking = [(r["query"], r["terms"]) for r in block.collect()]
        queries = Queries.of(asking, {t: weight(index.docs, held.get(t, 0)) for _, own in asking for t in own})
        part = search(prepare(index, queries), queries, top)
        found = part if found is None else found.unionAll(part)
    if found is None:
        return asked.select("item_id", F.lit(None).cast("int").alias("rank"), F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("bigint").alias("score")).limit(0)
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for keys in (["query", "task"], ["query"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*best))).where(F.col("rank") <= top)
    return found.join(asked.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
