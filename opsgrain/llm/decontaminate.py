"""Operator 8, benchmark decontamination by BM25 retrieval.

Test items form an inverted index with block maxima.  Every passage (a window of
words) of every document queries it with block-max WAND and retrieves all items
above their thresholds; a retrieved item counts when ``min_overlap`` of its
5-word shingles are in the passage, and of its question and of its answer each
``min_part`` of their own shingles.  A question or answer of fewer than five
words counts by its words, so a one-word answer must be in the passage.

An item's threshold is what a passage with ``min_overlap`` of its shingles must
score at least, so retrieval loses no such passage.  Passages are twice as long
as the longest item and begin every item length, so a copied item lies whole in
one.  The index is dealt out in shards of at most ``max_items`` items, one pass
each.

Words are lower-cased and lose punctuation at both ends; words of punctuation
alone are left out.  An item's shingles are those of question and answer
together; an item of one part has no other part to verify.  A very long text is
many passages, in memory of its words.  Defined results: null and empty texts and items without
words have no hits; items of fewer than five words are one shingle; repeated
items and rows are judged one by one; a null doc_id is returned as such; without
items no document is touched.  Other columns are ignored.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
MIN_OVERLAP = 0.8
MIN_PART = 0.5
K1, B = 1.2, 0.75
BLOCK = 4
GROUP = 4

HITS = "array<struct<item_id:bigint,score:double,threshold:double,overlap:double,question_overlap:double,answer_overlap:double,first_word:int,words:int>>"
_HIT = pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("threshold", pa.float64()), ("overlap", pa.float64()),
                  ("question_overlap", pa.float64()), ("answer_overlap", pa.float64()), ("first_word", pa.int32()), ("words", pa.int32())])


def normal(word: str) -> str:
    return word.lower().strip(string.punctuation)


def words_of(text: str) -> list[str]:
    return [w for w in map(normal, text.split()) if w]


def shingles(words, size: int = SHINGLE) -> set:
    return {tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1))} if len(words) else set()


class Item(NamedTuple):
    """Term numbers of an item, and of its question and its answer."""

    item_id: int
    words: list[int]
    shingles: set
    question: set
    answer: set
    threshold: float


def part(words: list) -> set:
    """What a question or an answer is verified by: its shingles or, of few
    words, its words."""
    return shingles(words) if len(words) >= SHINGLE else {(w,) for w in words}


class _Terms(dict):
    """Numbers of words as they stand in texts: of the index, -1 for other
    words, -2 for punctuation alone.  Kept for at most ``limit`` words."""

    def __init__(self, numbers: dict[str, int], limit: int = 500_000):
        self.numbers, self.limit = numbers, limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        w = normal(word)
        n = self[word] = self.numbers.get(w, -1) if w else -2
        return n


class Index:
    """Block-max inverted index of items ``(item_id, question, answer)``."""

    def __init__(self, rows: list[tuple[int, str, str]], min_overlap: float = MIN_OVERLAP, min_part: float = MIN_PART):
        self.min_overlap, self.min_part = min_overlap, min_part
        both = [(i, words_of(q), words_of(a)) for i, q, a in rows]
        both = [x for x in both if x[1] or x[2]]
        self.numbers: dict[str, int] = {}
        lists = [[self.numbers.setdefault(w, len(self.numbers)) for w in q + a] for _, q, a in both]
        df = Counter(t for x in lists for t in set(x))
        n, mean = len(lists), sum(map(len, lists)) / max(len(lists), 1)
        order = sorted(range(n), key=lambda k: len(lists[k]))  # items of like length share blocks, which keeps block maxima tight
        both, lists = [both[k] for k in order], [lists[k] for k in order]
        self.items: list[Item] = []
        postings: list[list[tuple[int, float]]] = [[] for _ in self.numbers]
        for k, ((item_id, q, a), x) in enumerate(zip(both, lists, strict=True)):
            weight = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c * (K1 + 1) / (c + K1 * (1 - B + B * len(x) / mean)) for t, c in Counter(x).items()}
            # each shingle that is missing can cost the passage one more word, at worst the heaviest
            missing = math.floor((1 - min_overlap) * len(shingles(x)) + 1e-9)
            threshold = sum(sorted(weight.values())[:len(weight) - missing]) - 1e-9
            threshold = max(threshold, 1e-9)
            self.items.append(Item(item_id, x, shingles(x), part(x[:len(q)]), part(x[len(q):]), threshold))
            for t, w in weight.items():
                postings[t].append((k, w))
        self.longest = max((len(x.words) for x in self.items), default=0)
        self.ids = [np.array([k for k, _ in p], np.int64) for p in postings]
        self.impact = [np.array([w for _, w in p]) for p in postings]
        # impacts are compared as shares of the item's threshold, so 1 is the mark for all items
        level = np.array([x.threshold for x in self.items])
        self.share = [w / level[k] for k, w in zip(self.ids, self.impact, strict=True)]
        self.highest = np.array([s.max() for s in self.share]) if self.share else np.zeros(0)
        #: Largest share of each term in each group of ``GROUP`` items.
        self.group_max = np.zeros((len(self.share), -(-n // GROUP)), np.float32)
        for t, (k, s) in enumerate(zip(self.ids, self.share, strict=True)):
            np.maximum.at(self.group_max[t], k // GROUP, np.nextafter(s.astype(np.float32), np.float32(9)))
        self.block_max = [np.maximum.reduceat(s, np.arange(0, len(s), BLOCK)) for s in self.share]

    def retrieve(self, terms: list[int]) -> list[tuple[int, float]]:
        """Items whose score reaches their threshold, by block-max WAND."""
        found = []
        cursors = [[int(self.ids[t][0]), t, 0] for t in terms]  # item, term, place
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for k, (_, t, _) in enumerate(cursors):
                bound += self.highest[t]
                if bound >= 1 - 1e-9:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            # the maxima of the blocks that can hold the pivot item
            bound, end = 0.0, None
            for _, t, at in cursors[:pivot + 1]:
                b = (at + int(np.searchsorted(self.ids[t][at:], item))) // BLOCK
                if b < len(self.block_max[t]):
                    bound += self.block_max[t][b]
                    last = int(self.ids[t][min((b + 1) * BLOCK, len(self.ids[t])) - 1])
                    end = last if end is None else min(end, last)
            if bound < 1 - 1e-9 and end is not None:
                # no item up to the nearest end of these blocks (and before the next list) can reach the mark
                target = max(item, end) + 1
                if pivot + 1 < len(cursors):
                    target = min(target, cursors[pivot + 1][0])
                target = max(target, item + 1) if target <= item else target
                self._advance(cursors, pivot + 1, target)
            elif cursors[0][0] == item:
                score = share = 0.0
                for _, t, at in cursors[:pivot + 1]:
                    score += float(self.impact[t][at])
                    share += float(self.share[t][at])
                if share >= 1 - 1e-9:
                    found.append((item, score))
                self._advance(cursors, pivot + 1, item + 1)
            else:
                self._advance(cursors, pivot, item)
        return found

    def _advance(self, cursors: list[list[int]], n: int, target: int) -> None:
        """Move the first ``n`` cursors to their first item not before ``target``."""
        for c in cursors[:n]:
            if c[0] < target:
                c[2] += int(np.searchsorted(self.ids[c[1]][c[2]:], target))
                c[0] = int(self.ids[c[1]][c[2]]) if c[2] < len(self.ids[c[1]]) else -1
        cursors[:] = [c for c in cursors if c[0] >= 0]

    def _promising(self, term: np.ndarray, edges: np.ndarray, rows: int = 100_000) -> Iterator[int]:
        """Windows in which some group of items can reach the mark, by the
        block maxima of the window's terms.  ``edges`` bound each window's."""
        full = np.flatnonzero(np.diff(edges))
        a = 0
        while a < len(full):
            b = max(a + 1, int(np.searchsorted(edges[full], edges[full[a]] + rows)))
            lo, hi = edges[full[a]], edges[full[b - 1] + 1]
            best = np.add.reduceat(self.group_max[term[lo:hi]], edges[full[a:b]] - lo, axis=0).max(axis=1)
            yield from full[a:b][best >= 1 - 1e-4].tolist()
            a = b

    def verify(self, item: Item, passage: np.ndarray) -> tuple[float, float, float]:
        """Shares of the item's shingles, and of its question's and answer's
        own, that the passage has; 1 for a part without words."""
        own = passage.tolist()
        have = shingles(own, min(SHINGLE, len(item.words)))
        both = shingles(own) | {(w,) for w in own}
        q, a = (len(x & both) / len(x) if x else 1.0 for x in (item.question, item.answer))
        return len(item.shingles & have) / max(len(item.shingles), 1), q, a

    def hits(self, texts: list[str | None], terms: _Terms) -> list[list[dict]]:
        """Verified hits of each text, at most one (the best passage) an item."""
        out: list[list[dict]] = [[] for _ in texts]
        if not self.items:
            return out
        streams = []
        for t in texts:
            ids = np.fromiter(map(terms.__getitem__, (t or "").split()), np.int64)
            streams.append(ids[ids > -2])
        step, n_terms = self.longest, len(self.numbers)
        size = np.array([len(s) for s in streams])
        windows = np.maximum(1, -(-size // step) - 1)  # window k covers words k*step up to (k+2)*step
        first = np.cumsum(windows) - windows
        flat = np.concatenate(streams) if streams else np.zeros(0, np.int64)
        doc = np.repeat(np.arange(len(streams)), size)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        known = np.flatnonzero(flat >= 0)
        term, cell, doc = flat[known], place[known] // step, doc[known]
        early, late = cell - 1 >= 0, cell < windows[doc]
        pair = np.unique(np.concatenate([(first[doc] + cell - 1)[early] * n_terms + term[early], (first[doc] + cell)[late] * n_terms + term[late]]))
        window, term = pair // n_terms, pair % n_terms
        edges = np.searchsorted(window, np.arange(int(windows.sum()) + 1))
        for w in self._promising(term, edges):
            found = self.retrieve(term[edges[w]:edges[w + 1]].tolist())
            if not found:
                continue
            d = int(np.searchsorted(first, w, "right")) - 1
            a = (w - int(first[d])) * step
            passage = streams[d][a:a + 2 * step]
            for k, score in found:
                item = self.items[k]
                overlap, q, ans = self.verify(item, passage)
                if overlap >= self.min_overlap - 1e-9 and min(q, ans) >= self.min_part - 1e-9:
                    hit = {"item_id": item.item_id, "score": score, "threshold": item.threshold, "overlap": overlap, "question_overlap": q,
                           "answer_overlap": ans, "first_word": a, "words": len(passage)}
                    old = next((x for x in out[d] if x["item_id"] == item.item_id), None)
                    if old is None:
                        out[d].append(hit)
                    elif overlap > old["overlap"]:
                        old.update(hit)
        return out


def question_answer(benchmark: DataFrame) -> DataFrame:
    """``item_id``, ``question`` and ``answer`` of ``benchmark(item_id, text)``:
    the last sentence is the answer, what stands before it the question."""
    cut = r"(?s)^(.*[.!?]\s+)?(\S.*)$"
    text = F.trim(F.coalesce("text", F.lit("")))
    return benchmark.select(F.col("item_id").cast("bigint"), F.regexp_extract(text, cut, 1).alias("question"), F.regexp_extract(text, cut, 2).alias("answer"))


def with_hits(documents: DataFrame, items: DataFrame, min_overlap: float = MIN_OVERLAP, min_part: float = MIN_PART, max_items: int = 2_000) -> DataFrame:
    """``documents`` with ``hits``: the items that a passage of ``text`` has."""
    n = items.count()
    shards = max(1, -(-n // max_items))
    out = documents.withColumn("hits", F.lit(None).cast(HITS))
    for s in range(shards):
        part = items if shards == 1 else items.where(F.pmod(F.xxhash64("item_id", "question", "answer"), F.lit(shards)) == s)
        rows = [(r["item_id"], r["question"] or "", r["answer"] or "") for r in part.orderBy("item_id").collect()]
        out = _one_pass(out, rows, min_overlap, min_part)
    return out


def _one_pass(documents: DataFrame, rows: list, min_overlap: float, min_part: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(rows, min_overlap, min_part)
        terms = _Terms(index.numbers)
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                old = part.column("hits").to_pylist()
                new = index.hits(part.column("text").to_pylist(), terms)
                hits = pa.array([(x or []) + y for x, y in zip(old, new, strict=True)], pa.list_(_HIT))
                yield part.set_column(part.schema.get_field_index("hits"), "hits", hits)

    return documents.mapInArrow(run, documents.schema)


def contaminated(documents: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """One row per document and benchmark item that a passage of it holds."""
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return with_hits(docs, question_answer(benchmark), **how).select("doc_id", F.inline("hits"))
