"""Operator 9, toxicity by nearest labelled examples.

Texts become vectors over all terms (words and word beginnings) of the labelled
examples, with one more component for the text's length.  A term's weight is
its IDF times a weight by chi-squared, from ``FLOOR`` to 1, so this is a cosine
of label-weighted TF-IDF, not of plain TF-IDF: terms that separate the labels
weigh more, and none is left out.  Frequencies saturate at 255.

The examples form one block-max inverted index.  Similar examples stand
together, in groups that share frequent terms (as those of a language do).  A
text reads its terms' postings in all groups where they are rare.  The long lists
of a group's frequent terms are read for no example at first: each block of
``BLOCK`` examples holds every frequent term's maximum, and only the blocks that
these maxima let reach the ``k``-th best so far are looked up in those lists, for
many texts at a time.  The bounds are exact, so the ``k`` nearest are those of an
exhaustive search.  Distance-weighted votes are calibrated by isotonic regression on the
examples' own leave-one-out votes.

The labels are learnt from a hash sample of about ``max_train`` labelled rows
(all of them where there are fewer); document frequencies cover all documents.
Rows whose crc32(doc_id as text) mod 5 is 0 are never learnt from.  The index
holds three bytes an entry and is broadcast once, for calibration and scoring.
The terms of all documents are counted once and stored, as numbers of the
examples' terms, for the document frequencies and for scoring.

Defined results: null and empty texts, and texts without a term of any
example, get the toxic share of the labelled rows without terms; a null doc_id is never
held out; of several labels of one doc_id the highest holds, null labels are
ignored; without labels every score is 0.  Repeated rows are scored alike.  A
very long text is one row of its task, in memory of its words.  Other columns
pass unchanged.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import filterfalse, repeat
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsgrain.llm.common import stored

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (5, 7)
FOLDS = 5
BLOCK = 64  # examples whose frequent terms share one maximum each
GROUP = 2500  # examples a group, on average
SHARED = 256  # terms by which examples are grouped
FREQUENT = 20  # a term in more than one of so many examples of a group is frequent
DENSE_BYTES = 64 << 20  # bound of a worker's table of frequent terms
AHEAD = 16  # blocks of a text whose examples are looked up first
SHORT = 64  # postings of a list that is not worth a copy of its own
TEXTS = 500  # texts searched for at a time
FLOOR = 0.05  # weight of a term that does not separate the labels
LENGTH_WEIGHT = 0.5
EVIDENCE = 3
PART = 500  # texts whose terms are counted at a time

ADDED = ("score", "predicted", "evidence")
EVIDENCE_TYPE = "array<struct<doc_id:bigint,similarity:double,toxic:int>>"
_EVIDENCE = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def terms_of(word: str) -> list[str]:
    """A word and its beginnings, which are marked."""
    return [word] + [word[:k] + "*" for k in PREFIXES if len(word) > k]


def hashes_of(terms: list[str]) -> np.ndarray:
    """64-bit hashes of terms."""
    return pd.util.hash_array(np.array(terms, object), categorize=False).view(np.int64) if terms else np.zeros(0, np.int64)


class Terms:
    """Terms of many texts at a time, as 64-bit hashes or, with ``keys``
    (sorted hashes), as places in them, unknown ones left out.  The terms of up
    to ``limit`` words are kept."""

    def __init__(self, keys: np.ndarray | None = None, limit: int = 300_000):
        self.keys, self.limit = keys, limit
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, words: list[str]) -> None:
        terms = [terms_of(w) for w in words]
        size = np.array([len(t) for t in terms], np.int64)
        flat = hashes_of([x for t in terms for x in t])
        if self.keys is not None:
            flat, back = np.unique(flat, return_inverse=True)  # rising, which finds the keys faster
            at = np.minimum(np.searchsorted(self.keys, flat), max(len(self.keys) - 1, 0))
            known = self.keys[at] == flat if len(self.keys) else np.zeros(len(flat), bool)
            at, known = at[back], known[back]
            size = np.bincount(np.repeat(np.arange(len(words)), size)[known], minlength=len(words))
            flat = at[known]
        self.rows.update(zip(words, range(len(self.rows), len(self.rows) + len(words)), strict=True))
        self.size, self.flat = np.append(self.size, size), np.append(self.flat, flat)

    def count(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Edges of each text's terms, the terms (rising), their frequencies
        (up to 255), and the texts' numbers of words."""
        words, n, per, total = [], [], [], []
        for text in texts:
            own = Counter((text or "").lower().split())
            for x in list(filterfalse(str.isalpha, own)):
                many = own.pop(x)
                for w in WORD.findall(x):
                    own[w] = own.get(w, 0) + many
            words += own
            n += own.values()
            per.append(len(own))
            total.append(own.total())
        row = np.fromiter(map(self.rows.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(row < 0).tolist()
        if missing:
            new = list({words[i] for i in missing})
            if len(self.rows) + len(new) > self.limit:
                self._forget()
                new, missing = list(set(words)), range(len(words))
            self._learn(new)
            row[missing] = [self.rows[words[i]] for i in missing]
        size = self.size[row]
        term = self.flat[_cells((np.cumsum(self.size) - self.size)[row], size)]
        text = np.repeat(np.repeat(np.arange(len(texts)), per), size)
        many = np.repeat(np.minimum(np.array(n, np.int64), 255), size)
        if self.keys is None:
            order = np.lexsort((term, text))
            term, text, many = term[order], text[order], many[order]
        else:  # places are below 2 ** 32, so that one sort of numbers does
            cell = np.sort(text << 40 | term << 8 | many)
            text, term, many = cell >> 40, cell >> 8 & 0xFFFFFFFF, cell & 255
        first = np.ones(len(term), bool)
        first[1:] = (term[1:] != term[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(first)
        tf = np.add.reduceat(many, at) if len(at) else np.zeros(0, np.int64)
        return np.searchsorted(text[at], np.arange(len(texts) + 1)), term[at], np.minimum(tf, 255).astype(np.uint8), np.array(total, np.int64)


POSTING = np.dtype([("place", np.int32), ("value", np.float32)])
LOG = np.append(0, 1 + np.log(np.arange(1, 256)))  # weight of a frequency


def _cells(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of the ranges of ``size`` from ``first`` on."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def length_of(words: np.ndarray) -> np.ndarray:
    """Length components of texts of so many words."""
    return LENGTH_WEIGHT * (1 + np.log(np.maximum(words, 1)))


class Model(NamedTuple):
    """All that scoring needs, as it is broadcast; its size grows with the
    terms of at most about ``max_train`` examples."""

    name: str
    keys: np.ndarray  # sorted hashes of the terms, whose places number them
    weight: np.ndarray
    start: np.ndarray  # first posting of each term, and the end
    place: np.ndarray  # postings: the example
    tf: np.ndarray  # and the frequency there
    norm: np.ndarray  # of each example's vector, with the length
    words: np.ndarray  # of the examples
    ids: np.ndarray
    toxic: np.ndarray
    prior: float
    empty: float
    k: int
    edge: np.ndarray  # first block of each group, and the end

    @staticmethod
    def of(keys: np.ndarray, weight: np.ndarray, row: np.ndarray, term: np.ndarray, tf: np.ndarray, words: np.ndarray, ids: np.ndarray, toxic: np.ndarray,
           prior: float, empty: float, k: int) -> Model:
        """From the examples' entries: ``row`` is each example's first entry in
        ``term`` and ``tf``, and the end."""
        n, parts = len(ids), [(a, min(a + 1000, len(ids))) for a in range(0, len(ids), 1000)]
        weight = weight.astype(np.float32)
        held = np.bincount(term, minlength=len(keys))
        norm, heaviest = length_of(words) ** 2, np.zeros(n, np.int64)
        for a, b in parts:  # by parts, which bounds the memory
            t = term[row[a]:row[b]]
            of = np.repeat(np.arange(b - a), np.diff(row[a:b + 1]))
            value = LOG[tf[row[a]:row[b]]] * weight[t]
            norm[a:b] += np.bincount(of, weights=value * value, minlength=b - a)
            # similar examples into one block: by their heaviest term that others have, too
            value[held[t] < 2] = 0
            by = np.lexsort((t, value, of))
            heaviest[a + of[by]] = t[by]
        group = _groups(row, term, tf, weight, held, np.sqrt(norm), -(-n // GROUP))
        order = np.lexsort((ids, heaviest, group))
        edge = np.append(np.unique(np.cumsum(np.append(0, np.bincount(group)[:-1])) // BLOCK) if n else 0, -(-n // BLOCK))
        start = np.append(0, np.cumsum(held)).astype(np.int64)
        place, own, at = np.empty(len(term), np.uint16 if n <= 1 << 16 else np.int32), np.empty(len(term), np.uint8), start[:-1].copy()
        for a, b in parts:  # examples in the order of their places, so that lists rise
            size = row[order[a:b] + 1] - row[order[a:b]]
            cell = _cells(row[order[a:b]], size)
            p = np.repeat(np.arange(a, b), size)
            by = np.argsort(term[cell], kind="stable")
            t, cell = term[cell[by]], cell[by]
            run = np.arange(len(t)) - np.searchsorted(t, t)
            place[at[t] + run], own[at[t] + run] = p[by], tf[cell]
            at += np.bincount(t, minlength=len(keys))
        return Model(uuid.uuid4().hex, keys, weight, start, place, own, np.sqrt(norm)[order], words[order], ids[order], toxic[order].astype(float), prior, empty, k, edge)


def _groups(row: np.ndarray, term: np.ndarray, tf: np.ndarray, weight: np.ndarray, held: np.ndarray, norm: np.ndarray, parts: int, rounds: int = 6) -> np.ndarray:
    """A number below ``parts`` for each example: those alike in the most common
    terms get the same one.  Only the speed of a search depends on it."""
    n = len(row) - 1
    if parts < 2:
        return np.zeros(n, np.int64)
    slot = np.full(len(held), -1, np.int32)
    common = np.argsort(-held, kind="stable")[:SHARED]
    slot[common] = np.arange(len(common))
    vector = np.zeros((n, len(common)), np.float32)
    for a in range(0, n, 1000):  # by parts, which bounds the memory
        b = min(a + 1000, n)
        at, of = slot[term[row[a]:row[b]]], np.repeat(np.arange(a, b), np.diff(row[a:b + 1]))
        known = at >= 0
        vector[of[known], at[known]] = (LOG[tf[row[a]:row[b]]] * weight[term[row[a]:row[b]]])[known] / norm[of[known]]
    vector /= np.maximum(np.linalg.norm(vector, axis=1, keepdims=True), 1e-9)
    rng, far, centre = np.random.default_rng(0), np.linalg.norm(vector, axis=1).astype(float) + 1e-9, []
    for _ in range(parts):  # each next centre is an example, rather one far from those before
        centre.append(vector[rng.choice(n, p=far / far.sum())])
        far = np.minimum(far, np.maximum(1 - vector @ centre[-1], 0).astype(float) ** 2 * (far > 1e-6) + 1e-9)
    centre = np.array(centre)
    for _ in range(rounds):
        group = (vector @ centre.T).argmax(axis=1)
        for g in range(parts):
            if (group == g).any():
                centre[g] = vector[group == g].mean(axis=0)
        centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-9)
    return (vector @ centre.T).argmax(axis=1)


class Index:
    """A model opened for search."""

    _open: dict[str, Index] = {}  # the last one of this worker

    def __init__(self, model: Model):
        self.model, n = model, len(model.ids)
        blocks, groups = -(-n // BLOCK), max(len(model.edge) - 1, 1)
        self.edge = model.edge if n else np.zeros(2, np.int64)
        of_block = np.repeat(np.arange(groups), np.diff(self.edge))
        self.length = np.full(blocks * BLOCK, -3.0, np.float32)  # places after the last example stay below all bounds
        self.length[:n] = length_of(model.words) / model.norm
        # per group: its frequent terms, most frequent first, and every term's slot there
        room = min(max(1, DENSE_BYTES // (4 * BLOCK * max(blocks, 1))), (1 << 15) - 1)
        size, keys = np.diff(model.start), len(model.keys)
        held = np.zeros((groups, keys), np.int32)
        parts = [(a, min(a + 50_000, keys)) for a in range(0, keys, 50_000)]  # bound the memory
        for a, b in parts:
            lo, hi = model.start[a], model.start[b]
            cell = of_block[model.place[lo:hi] // BLOCK] * (b - a) + np.repeat(np.arange(b - a), size[a:b])
            held[:, a:b] = np.bincount(cell, minlength=groups * (b - a)).reshape(groups, -1)
        self.slot = np.full((groups, keys), -1, np.int16)
        for g in range(groups if n > BLOCK else 0):
            within = min(int(self.edge[g + 1]) * BLOCK, n) - int(self.edge[g]) * BLOCK
            own = np.flatnonzero(held[g].astype(np.int64) * FREQUENT > within)
            own = own[np.argsort(-held[g][own], kind="stable")[:room]]
            self.slot[g, own] = np.arange(len(own))
        del held
        frequent = int(self.slot.max(initial=-1)) + 1
        self.dense = np.zeros((blocks, frequent, BLOCK), np.float32)  # blocks x frequent terms of their group x examples
        rare, left = [], []
        for a, b in parts:
            lo, hi = model.start[a], model.start[b]
            place, of = model.place[lo:hi], np.repeat(np.arange(a, b), size[a:b])
            value = (LOG[model.tf[lo:hi]].astype(np.float32) * (model.weight[of] / model.norm[place])).astype(np.float32)
            at = self.slot[of_block[place // BLOCK], of]
            out = at < 0
            self.dense[place[~out] // BLOCK, at[~out], place[~out] % BLOCK] = value[~out]
            rare.append((place[out], value[out]))
            left.append(np.bincount(of[out] - a, minlength=b - a))
        self.start = np.append(0, np.cumsum(np.concatenate(left))) if left else np.zeros(1, np.int64)  # of the postings where terms are rare
        self.posting = np.empty(int(self.start[-1]), POSTING)
        at = 0
        while rare:
            place, value = rare.pop(0)
            self.posting["place"][at:at + len(place)], self.posting["value"][at:at + len(place)] = place, value
            at += len(place)
        self.block_max = np.ascontiguousarray(self.dense.max(axis=2).T)  # frequent terms x blocks
        self.frequent_norm = np.zeros((blocks, BLOCK), np.float32)
        for b in range(blocks):
            self.frequent_norm[b] = np.sqrt((self.dense[b].astype(float) ** 2).sum(axis=0))

    @staticmethod
    def opened(model: Model) -> Index:
        got = Index._open.get(model.name)
        if got is None:
            Index._open.clear()
            got = Index._open[model.name] = Index(model)
        return got

    def vector(self, term: np.ndarray, tf: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray, float]:
        """Terms, values and the length component of a unit vector."""
        v = LOG[tf] * self.model.weight[term]
        length = float(length_of(np.array([n_words]))[0])
        norm = math.sqrt(float(v @ v) + length * length)
        return term, v / norm, length / norm

    def nearest(self, t: np.ndarray, v: np.ndarray, length: float, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places of the ``k`` nearest examples that share a term, nearest
        first (ties: lower place), and their cosines."""
        return self.nearest_of([(t, v, length, skip)])[0]

    def nearest_of(self, texts: list[tuple[np.ndarray, np.ndarray, float, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of each text, ``TEXTS`` at a time."""
        return [x for a in range(0, len(texts), TEXTS) for x in self._nearest_of(texts[a:a + TEXTS])]

    def _found(self, t: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Every example's share of a cosine by the postings of rare terms, summed
        as doubles."""
        first, end = self.start[t], self.start[t + 1]
        size = end - first
        some, few = np.flatnonzero(size > SHORT), np.flatnonzero((size > 0) & (size <= SHORT))
        all_postings = self.posting.view(np.int64)  # as numbers, which are copied faster
        lists = [all_postings[a:b] for a, b in zip(first[some].tolist(), end[some].tolist(), strict=True)]
        lists.append(all_postings[_cells(first[few], size[few])])
        got = np.concatenate(lists).view(POSTING)
        many = np.repeat(np.append(v[some], v[few]).astype(np.float32), np.append(size[some], size[few]))
        return np.bincount(got["place"], weights=got["value"] * many, minlength=self.length.size)

    def _nearest_of(self, texts: list[tuple[np.ndarray, np.ndarray, float, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
        k, n, blocks = self.model.k, len(texts), self.dense.shape[0]
        if not blocks or not n:
            return [(np.zeros(0, np.int64), np.zeros(0))] * n
        base = np.empty((n, blocks * BLOCK), np.float32)
        for i, (t, v, _, _) in enumerate(texts):
            base[i] = self._found(t, v)
        touched = base > 0
        for i, (_, _, length, skip) in enumerate(texts):
            base[i] += np.float32(length) * self.length
            if skip >= 0:
                base[i, skip] = -2
        base, touched = base.reshape(n, blocks, BLOCK), touched.reshape(n, blocks, BLOCK)
        # what the frequent terms can add: by block maxima, or by norms
        of, t, v = np.repeat(np.arange(n), [len(x[0]) for x in texts]), np.concatenate([x[0] for x in texts]), np.concatenate([x[1] for x in texts])
        upper, weight = np.empty((n, blocks), np.float32), []
        for g in range(len(self.edge) - 1):
            own = self.slot[g, t]
            weight.append(np.zeros((n, self.dense.shape[1]), np.float32))
            weight[g][of[own >= 0], own[own >= 0]] = v[own >= 0]
            now = slice(self.edge[g], self.edge[g + 1])
            most = weight[g] @ self.block_max[:, now] + 1e-6
            norm = np.sqrt((weight[g] ** 2).sum(axis=1))
            upper[:, now] = np.minimum((base[:, now] + norm[:, None, None] * self.frequent_norm[now]).max(axis=2) + 1e-6, base[:, now].max(axis=2) + most)
        group = np.repeat(np.arange(len(self.edge) - 1), np.diff(self.edge))

        def looked_up(text: np.ndarray, block: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
            """Block by block: the block, its pairs' numbers, their texts, and the
            cosines of its examples (-3 without a common term)."""
            order = np.argsort(block, kind="stable")
            edge = np.searchsorted(block[order], np.arange(blocks + 1)).tolist()
            for b in np.unique(block).tolist():
                at = order[edge[b]:edge[b + 1]]
                who = text[at]
                more = weight[group[b]][who] @ self.dense[b]
                cosine = base[who, b] + more
                cosine[~(touched[who, b] | (more > 0))] = -3
                yield b, at, who, cosine

        # blocks of the highest bounds first, which settles others
        ahead, least = min(AHEAD, blocks), np.full(n, -1, np.float32)
        first = np.argpartition(-upper, ahead - 1, axis=1)[:, :ahead]
        early = np.empty((n * ahead, BLOCK), np.float32)
        for _, at, _, cosine in looked_up(np.repeat(np.arange(n), ahead), first.reshape(-1)):
            early[at] = cosine
        early = early.reshape(n, ahead * BLOCK)
        if ahead * BLOCK >= k:
            least = np.maximum(np.partition(early, -k, axis=1)[:, -k] - np.float32(2e-6), -1)
        at = np.nonzero(early >= least[:, None])
        found = [(at[0], first[at[0], at[1] // BLOCK] * BLOCK + at[1] % BLOCK, early[at])]
        np.put_along_axis(upper, first, -3, axis=1)
        for b, _, who, cosine in looked_up(*np.nonzero(upper >= least[:, None])):
            at = np.nonzero(cosine >= least[who, None])
            if len(at[0]):
                found.append((who[at[0]], b * BLOCK + at[1], cosine[at]))
        text, place, cosine = self._best(found, 2e-6)
        edge, out = np.searchsorted(text, np.arange(n + 1)).tolist(), []
        for i, (t, v, _, _) in enumerate(texts):
            p, exact = place[edge[i]:edge[i + 1]], cosine[edge[i]:edge[i + 1]].astype(float)
            if not (exact[:-1] - exact[1:] < 2e-6).any():
                out.append((p[:k], exact[:k]))
                continue
            # once more and in one order, so that equal examples tie
            exact = base[i, p // BLOCK, p % BLOCK].astype(float)
            for g in set(group[p // BLOCK].tolist()):
                own, here = self.slot[g, t], np.flatnonzero(group[p // BLOCK] == g)
                of, q = np.flatnonzero(own >= 0), p[here]
                exact[here] += (v[of, None] * self.dense[q // BLOCK, own[of, None], q % BLOCK]).sum(axis=0)
            best = np.lexsort((p, -exact))[:k]
            out.append((p[best], exact[best]))
        return out

    def _best(self, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], slack: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Texts, places and cosines by text and falling cosine: each text's
        best ``k`` and those that rounding may keep from them."""
        text, place, cosine = (np.concatenate([x[i] for x in found]) for i in range(3))
        order = np.lexsort((place, -cosine, text))
        text, place, cosine = text[order], place[order], cosine[order]
        many = np.bincount(text)
        first = np.cumsum(many) - many
        last = np.minimum(first + self.model.k, first + many) - 1
        kept = cosine >= cosine[last[text]] - np.float32(slack) if len(text) else np.zeros(0, bool)
        return text[kept], place[kept], cosine[kept]

    def votes(self, place: np.ndarray, cosine: np.ndarray) -> float:
        w = 1 / (1.05 - np.minimum(cosine, 1.0))
        return float((w @ self.model.toxic[place] + self.model.prior) / (w.sum() + 1))


class Calibration(NamedTuple):
    """Votes and the share of toxic rows there."""

    raw: np.ndarray
    share: np.ndarray

    def at(self, raw: float) -> float:
        """Isotonic share of toxic examples at these votes; the votes
        themselves keep the order where it is flat."""
        return min(1.0, max(0.0, 0.98 * float(np.interp(raw, self.raw, self.share)) + 0.02 * raw))


class Fitted(NamedTuple):
    """A model on its way to the workers, with its calibration."""

    model: object  # broadcast
    calibration: Calibration
    documents: DataFrame  # all documents, and their stored counts
    counts: DataFrame


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators fit: knots and their rising shares."""
    blocks: list[list[float]] = []
    order = np.argsort(raw, kind="stable")
    for x, v in zip(raw[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([x, v, 1.0])
        while len(blocks) > 1 and (blocks[-2][1] >= blocks[-1][1] or blocks[-2][0] == blocks[-1][0]):
            b = blocks.pop()
            a = blocks[-1]
            n = a[2] + b[2]
            blocks[-1] = [(a[0] * a[2] + b[0] * b[2]) / n, (a[1] * a[2] + b[1] * b[2]) / n, n]
    if not blocks:
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    # one pseudo-row with the votes' own value steadies small blocks
    return np.array([b[0] for b in blocks]), np.array([(b[1] * b[2] + b[0]) / (b[2] + 1) for b in blocks])


def training_rows(documents: DataFrame, labels: DataFrame, max_train: int) -> DataFrame:
    """``doc_id``, ``text`` and ``toxic`` of about ``max_train`` labelled rows
    outside the held-out fold, whose number bounds the broadcast side."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.where(~held_out(F.col("doc_id")))
    share = min(1.0, max_train / max(known.count(), 1))
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return docs.join(F.broadcast(sample), "doc_id")


def _numbers(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Edges and terms of several texts from the bytes of ``_packed``."""
    edge = np.append(0, np.cumsum([len(x) // 4 for x in packed])).astype(np.int64)
    term = np.append(0, np.cumsum(np.frombuffer(b"".join(packed), np.uint32), dtype=np.int64))
    return edge, term[1:] - np.repeat(term[edge[:-1]], np.diff(edge))


def _packed(edge: np.ndarray, term: np.ndarray) -> list[bytes]:
    """Each text's rising terms, less the one before, which compresses well."""
    step = np.diff(term, prepend=0)
    first = edge[:-1][np.diff(edge) > 0]
    step[first] = term[first]
    step = step.astype(np.uint32)
    return [step[i:j].tobytes() for i, j in zip(edge.tolist(), edge[1:].tolist(), strict=False)]


def counted(documents: DataFrame, known, carried: Sequence[str] | None = None) -> DataFrame:
    """The columns ``carried`` of ``documents`` (all, if None) but those that
    ``score`` adds, with the terms of the text (numbers of the keys that ``known``
    broadcasts, alone or in a model), their frequencies and the text's words."""
    schema = T.StructType([f for f in documents.schema.fields if f.name not in ADDED and (carried is None or f.name in carried)])
    with_text = schema.names if "text" in schema.names else [*schema.names, "text"]
    text, kept = with_text.index("text"), len(schema.names)
    out = T.StructType([*schema.fields, *T.StructType.fromDDL("_toxicity_words bigint, _toxicity_term binary, _toxicity_tf binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(known.value.keys if isinstance(known.value, Model) else known.value)
        for batch in batches:
            for a in range(0, batch.num_rows, PART):
                part = batch.slice(a, PART)
                edge, term, tf, words = terms.count(part.column(text).to_pylist())
                tf = [tf[i:j].tobytes() for i, j in zip(edge.tolist(), edge[1:].tolist(), strict=False)]
                yield pa.RecordBatch.from_arrays([*part.columns[:kept], pa.array(words), pa.array(_packed(edge, term), pa.binary()), pa.array(tf, pa.binary())], names=out.names)

    return documents.select(*with_text).mapInArrow(run, out)


def _document_frequencies(counts: DataFrame, n_keys: int) -> np.ndarray:
    """Texts with each term, over all documents; the last number is all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = np.zeros(n_keys + 1, np.int64)
        for batch in batches:
            for a in range(0, batch.num_rows, PART):
                got[:-1] += np.bincount(_numbers(batch.column(0).slice(a, PART).to_pylist())[1], minlength=n_keys)
            got[-1] += batch.num_rows
        at = np.flatnonzero(got)
        for a in range(0, len(at), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(at[a:a + 100_000]), pa.array(got[at[a:a + 100_000]])], names=["term", "n"])

    out = np.zeros(n_keys + 1, np.int64)
    got = counts.select("_toxicity_term").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out[got["term"].to_numpy()] = got["n"].to_numpy()
    return out


def _weights(n: np.ndarray, t: np.ndarray, p: float, full_chi2: float, prior_texts: int) -> np.ndarray:
    """Weights of terms with ``n`` examples, ``t`` of them toxic: chi-squared
    with continuity correction, less for few examples, as a share of
    ``full_chi2``, from ``FLOOR`` to 1."""
    if not 0 < p < 1:
        return np.full(len(n), FLOOR)
    chi2 = np.maximum(np.abs(t - n * p) - 0.5, 0) ** 2 / (n * p * (1 - p))
    return np.clip(chi2 * n / (n + prior_texts) / full_chi2, FLOOR, 1)


def _example_counts(rows: DataFrame) -> DataFrame:
    """The hashed terms of each training text, with frequencies, and its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            for a in range(0, batch.num_rows, PART):
                part = batch.slice(a, PART)
                edge, term, tf, words = terms.count(part.column("text").to_pylist())
                term, tf = (pa.array([x[i:j].tobytes() for i, j in zip(edge, edge[1:], strict=False)], pa.binary()) for x in (term, tf))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), pa.array(words), term, tf], names=["doc_id", "toxic", "words", "term", "tf"])

    return rows.select("doc_id", "text", "toxic").mapInArrow(run, "doc_id bigint, toxic int, words bigint, term binary, tf binary")


def _term_table(counts: DataFrame) -> pa.Table:
    """Per term's hash: training texts with it (``n``), and toxic ones (``t``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2000):  # by parts, which bounds the memory
                part = batch.slice(a, 2000)
                own = [np.frombuffer(x, np.int64) for x in part.column("term").to_pylist()]
                toxic = np.repeat(part.column("toxic").to_numpy(zero_copy_only=False), [len(x) for x in own])
                term, at = np.unique(np.concatenate(own), return_inverse=True)
                n, t = np.bincount(at, minlength=len(term)), np.bincount(at, weights=toxic, minlength=len(term)).astype(np.int64)
                for i in range(0, len(term), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(x[i:i + 50_000]) for x in (term, n, t)], names=["term", "n", "t"])

    return counts.select("term", "toxic").mapInArrow(run, "term bigint, n bigint, t bigint").groupBy("term").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).toArrow()


def _gathered(counts: DataFrame, keys: np.ndarray, parts: int = 8) -> tuple[np.ndarray, ...]:
    """Ids, labels, words, entries per example, terms' numbers and
    frequencies, part by part."""
    got = [(np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.int32), np.zeros(0, np.uint8))]
    for s in range(parts):
        t = counts.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) == s).toArrow()
        if len(t):
            term, tf = (np.frombuffer(b"".join(t[c].to_pylist()), kind) for c, kind in (("term", np.int64), ("tf", np.uint8)))
            per = np.array([len(x.as_buffer()) for x in t["tf"]], np.int64)
            got.append((*(t[c].to_numpy() for c in ("doc_id", "toxic", "words")), per, np.searchsorted(keys, term).astype(np.int32), tf))
    return tuple(np.concatenate([x[i] for x in got]) for i in range(6))


def fit(documents: DataFrame, labels: DataFrame, max_train: int = 20_000, k: int = 15, full_chi2: float = 25.0, prior_texts: int = 5,
        carried: Sequence[str] | None = None) -> Fitted:
    """Gather examples and statistics, weigh terms, index and calibrate.  Of these
    documents ``score`` passes the columns ``carried`` (all, if None)."""
    counts = stored(_example_counts(training_rows(documents, labels, max_train)), "toxicity-counts")
    n, t = counts.agg(F.count("*"), F.sum("toxic")).first()
    p = t / n if n else 0.0
    table = _term_table(counts).sort_by("term")
    keys, held, held_toxic = (table[c].to_numpy() for c in ("term", "n", "t"))
    sent = documents.sparkSession.sparkContext.broadcast(keys)
    everywhere = stored(counted(documents, sent, carried), "toxicity-terms")
    sent.destroy()
    df = _document_frequencies(everywhere, len(keys))
    weight = (np.log((df[-1] + 1) / (df[:-1] + 1)) + 1e-6) * _weights(held, held_toxic, p, full_chi2, prior_texts)
    ids, toxic, words, per, term, tf = _gathered(counts, keys)
    bare, full = toxic[per == 0], per > 0
    empty = float((bare.sum() + p) / (len(bare) + 1)) if n else 0.0
    model = Model.of(keys, weight, np.append(0, np.cumsum(per[full])), term, tf, words[full], ids[full], toxic[full], p, empty, k)
    known = documents.sparkSession.sparkContext.broadcast(model)
    return Fitted(known, _calibration(counts, known, len(model.ids)), documents, everywhere)


def _calibration(counts: DataFrame, known, n: int) -> Calibration:
    """Leave-one-out votes of the examples, and their isotonic fit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = known.value
        index = Index.opened(model)
        place = {(d, w): p for p, (d, w) in enumerate(zip(model.ids.tolist(), model.words.tolist(), strict=True))}
        for batch in batches:
            raw, toxic = [], []
            for a in range(0, batch.num_rows, PART):
                texts = []
                for doc_id, label, words, term, tf in zip(*(c.to_pylist() for c in batch.slice(a, PART).columns), strict=True):
                    if not tf:
                        continue
                    own = np.searchsorted(model.keys, np.frombuffer(term, np.int64)), np.frombuffer(tf, np.uint8)
                    texts.append((*index.vector(*own, words), place[doc_id, words]))
                    toxic.append(label)
                raw += [index.votes(*x) for x in index.nearest_of(texts)]
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.float64()), pa.array(toxic, pa.int32())], names=["raw", "toxic"])

    if not n:
        return Calibration(np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    got = counts.mapInArrow(run, "raw double, toxic int").toArrow().sort_by([("raw", "ascending"), ("toxic", "ascending")])  # one row an example
    return Calibration(*isotonic(got["raw"].to_numpy(), got["toxic"].to_numpy().astype(float)))


def scored(index: Index, calibration: Calibration, edge: np.ndarray, term: np.ndarray, tf: np.ndarray, words: np.ndarray) -> list[tuple[float, list[dict]]]:
    """Score and evidence of each text, from ``Terms.count``."""
    model, full, texts = index.model, np.flatnonzero(np.diff(edge)).tolist(), words.tolist()
    out: list[tuple[float, list[dict]]] = [(model.empty, [])] * len(words)
    near = index.nearest_of([(*index.vector(term[edge[i]:edge[i + 1]], tf[edge[i]:edge[i + 1]], texts[i]), -1) for i in full])
    for i, (place, cosine) in zip(full, near, strict=True):
        if len(place):
            found = [{"doc_id": int(model.ids[p]), "similarity": float(c), "toxic": int(model.toxic[p])} for p, c in zip(place[:EVIDENCE], cosine, strict=False)]
            out[i] = calibration.at(index.votes(place, cosine)), found
    return out


def score(documents: DataFrame, fitted: Fitted) -> DataFrame:
    """``documents`` with ``score``, ``predicted`` and ``evidence``; those that the
    model was fitted with are not counted again."""
    known, calibration, seen, counts = fitted
    if documents is not seen:
        counts = counted(documents, known)
    schema = T.StructType(counts.schema.fields[:-3])
    out = T.StructType([*schema.fields, *T.StructType.fromDDL(f"score double, predicted int, evidence {EVIDENCE_TYPE}").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index.opened(known.value)
        for batch in batches:
            for a in range(0, batch.num_rows, PART):
                part = batch.slice(a, PART)
                words, term, tf = part.columns[-3:]
                edge, number = _numbers(term.to_pylist())
                got = scored(index, calibration, edge, number, np.frombuffer(b"".join(tf.to_pylist()), np.uint8), words.to_numpy())
                s = np.array([x for x, _ in got], float)
                yield pa.RecordBatch.from_arrays([*part.columns[:-3], pa.array(s), pa.array((s >= 0.5).astype(np.int32)), pa.array([e for _, e in got], _EVIDENCE)], names=out.names)

    return counts.mapInArrow(run, out)
