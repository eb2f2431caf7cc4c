"""Operator 4, SimHash near-duplicates by a vantage-point tree.

Fingerprints are made inside each row.  Distinct fingerprints are dealt to the
leaves of a vantage-point tree; a fingerprint also visits every leaf that its
ball may reach by the triangle bounds, so each close pair meets in a leaf.
Leaves pass on a spanning forest of what they find, and components follow by
star operations.

The tree is built on a bounded sample of fingerprints (``sample``), which
decides only how evenly they are dealt.  A leaf that the tree cannot divide
(a dense ball) is divided by hash into parts that visit each other.

Defined results: null texts and texts without words have fingerprint zero and
are linked like any other; repeated rows share a fingerprint; null doc_ids get
the smallest doc_id of their component, or null; no rows, no result.  Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsgrain.llm.common import in_few_files, stored
from opsgrain.llm.components import stars

SHINGLE = 4
MAX_BITS = 4
SEED = 42
LEAF = 2048


# --- fingerprints -------------------------------------------------------------

def shingles(text: str | None, size: int = SHINGLE) -> list[bytes]:
    """Shingles of the A-Z lowered words, repeats included; all words as one
    shingle if they are fewer."""
    words = (text or "").encode().lower().split()  # bytes know ASCII only: A-Z, and \x20 \x09-\x0D
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    return [joined[a:b] for a, b in zip(starts[:1 - size].tolist(), ends[size - 1:].tolist(), strict=True)]


def simhash(texts: list[str | None], size: int = SHINGLE, seed: int = SEED, chunk: int = 1 << 17) -> np.ndarray:
    """64-bit fingerprints: a bit is set if more than half of the shingles'
    XXH64 have it."""
    import xxhash

    ones = np.zeros((len(texts), 64), np.int64)
    total = np.zeros(len(texts), np.int64)
    held: list[tuple[int, np.ndarray]] = []

    def flush() -> None:
        doc = np.concatenate([np.full(len(h), d) for d, h in held])
        bits = np.unpackbits(np.concatenate([h for _, h in held]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        ones[doc[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        held.clear()

    n = 0
    for d, text in enumerate(texts):
        s = shingles(text, size)
        total[d] = len(s)
        for a in range(0, len(s), chunk):
            part = s[a:a + chunk]
            if n + len(part) > chunk and held:
                flush()
                n = 0
            held.append((d, np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(seed)), "<u8", len(part))))
            n += len(part)
    if held:
        flush()
    return np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprints(documents: DataFrame, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``doc_id`` and ``fp`` (the 64 bits as a signed long) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = simhash(batch.column(1).to_pylist(), size, seed)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, fp bigint")


def with_fingerprints(rows: DataFrame, name: str, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``rows`` with the fingerprint of ``text`` as column ``name``, a signed long."""
    at = rows.columns.index("text")
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = simhash(batch.column(at).to_pylist(), size, seed)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fp.view(np.int64))], names=[*batch.schema.names, name])

    return rows.mapInArrow(run, schema)


# --- the tree -----------------------------------------------------------------

def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class VantageTree:
    """Regions of fingerprint space.  An inner node sends fingerprints within
    ``radius`` of its vantage point to one side and the rest to the other."""

    def __init__(self, sample: np.ndarray, share: float, leaf: int = LEAF):
        self.leaf, self.share = leaf, share  # the sample's share of all fingerprints
        self.regions = 0
        self.root = self._grow(sample, 0)

    def _grow(self, own: np.ndarray, depth: int):
        expected = len(own) / self.share
        if expected > self.leaf and depth < 40 and len(own) >= 8:
            # of a few vantage points, the one whose median cut leaves the fewest near the cut
            best = None
            for v in own[:: max(1, len(own) // 8)][:8]:
                d = distance(own, v)
                cut = int(np.median(d))
                inner = d <= cut
                if 0 < inner.sum() < len(own):
                    near = int((np.abs(d.astype(np.int64) - cut) <= MAX_BITS).sum()) + abs(2 * int(inner.sum()) - len(own))
                    if best is None or near < best[0]:
                        best = near, v, cut, inner
            if best:
                _, v, cut, inner = best
                return v, cut, self._grow(own[inner], depth + 1), self._grow(own[~inner], depth + 1)
        parts = max(1, round(expected / self.leaf)) if expected > 1.5 * self.leaf else 1
        first, self.regions = self.regions, self.regions + parts
        return first, parts

    def homes(self, fps: np.ndarray) -> np.ndarray:
        """The region of each fingerprint."""
        out = np.empty(len(fps), np.int64)

        def go(node, at: np.ndarray) -> None:
            if len(node) == 2:
                spread = (fps[at] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
                out[at] = node[0] + (spread % np.uint64(node[1])).astype(np.int64)
            elif len(at):
                inner = distance(fps[at], node[0]) <= node[1]
                go(node[2], at[inner])
                go(node[3], at[~inner])

        go(self.root, np.arange(len(fps)))
        return out

    def visits(self, fps: np.ndarray, homes: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """Regions behind a fingerprint's own that its ball may reach, with
        the places of those fingerprints.  A pair meets once: in the later
        region of the two."""

        def go(node, at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
            if not len(at):
                return
            if len(node) == 2:
                for region in range(node[0], node[0] + node[1]):
                    come = at[homes[at] < region]
                    if len(come):
                        yield region, come
                return
            d = distance(fps[at], node[0]).astype(np.int64)
            yield from go(node[2], at[d - radius <= node[1]])
            yield from go(node[3], at[d + radius > node[1]])

        yield from go(self.root, np.arange(len(fps)))


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Of each of ``n`` nodes, the smallest node that it is connected to."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def close_pairs(own: np.ndarray, guests: np.ndarray, radius: int, rows: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Links (as a forest) among ``own`` and between ``own`` and ``guests``.
    Only fingerprints whose distances to a vantage point differ by at most
    ``radius`` are compared."""
    everyone = np.concatenate([own, guests])
    d = distance(everyone, own[0]).astype(np.int64)
    order = np.argsort(d, kind="stable")
    d, ranked = d[order], everyone[order]
    mine = np.flatnonzero(order < len(own))
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    held = 0

    def squeeze() -> None:
        nonlocal held
        label = forest(np.concatenate(left), np.concatenate(right), len(ranked))
        linked = np.flatnonzero(label != np.arange(len(ranked)))
        left[:], right[:], held = [linked], [label[linked]], len(linked)

    for k in range(0, len(mine), rows):
        at = mine[k:k + rows]
        lo, hi = np.searchsorted(d, d[at[0]] - radius), np.searchsorted(d, d[at[-1]] + radius, "right")
        i, j = np.nonzero(distance(ranked[at][:, None], ranked[None, lo:hi]) <= radius)
        i, j = at[i], j + lo
        left.append(i[i != j])
        right.append(j[i != j])
        held += len(left[-1])
        if held > 2_000_000:
            squeeze()
    if left:
        squeeze()
        return ranked[left[0]], ranked[right[0]]
    return own[:0], own[:0]


# --- the operator -------------------------------------------------------------

def links(distinct: DataFrame, radius: int = MAX_BITS, leaf: int = LEAF, sample: int = 4096, points_a_leaf: int = 8) -> DataFrame:
    """Links ``(a, b)`` that connect the distinct ``fp`` that differ in at
    most ``radius`` bits (a forest of them, from each region)."""
    n = distinct.count()
    # eight points a leaf, so that the depth grows with the input; the bound, sixteen million, is 128 MB at the driver
    share = min(1.0, max(sample, min(points_a_leaf * n // leaf, 1 << 24)) / max(n, 1))
    some = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(share * (1 << 30))).select("fp").collect()
    points = np.sort(np.array([r["fp"] for r in some], np.int64)).view("<u8")
    tree = VantageTree(points, len(points) / n if n and len(points) else 1.0, leaf)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view("<u8")
            homes = tree.homes(fps)
            order = np.argsort(homes, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(homes[order])) + 1):
                if len(at):
                    yield _dealt(int(homes[at[0]]), True, fps[at])
            for region, at in tree.visits(fps, homes, radius):
                yield _dealt(region, False, fps[at])

    def search(table):  # one region: its own fingerprints and the guests
        got = {True: [np.zeros(0, "<u8")], False: [np.zeros(0, "<u8")]}
        for home, fps in zip(table.column("home").to_pylist(), table.column("fps").to_pylist(), strict=True):
            got[home].append(np.frombuffer(fps, "<u8"))
        own, guests = np.concatenate(got[True]), np.concatenate(got[False])
        a, b = close_pairs(own, guests, radius) if len(own) else (own, own)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = distinct.select("fp").mapInArrow(deal, "region bigint, home boolean, fps binary")
    return dealt.groupBy("region").applyInArrow(search, "a bigint, b bigint")


def _dealt(region: int, home: bool, fps: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([region]), pa.array([home]), pa.array([fps.tobytes()], pa.binary())], names=["region", "home", "fps"])


def near_duplicates(documents: DataFrame, size: int = SHINGLE, radius: int = MAX_BITS, seed: int = SEED) -> DataFrame:
    """Each row's ``doc_id``, ``fp``, ``root`` (a fingerprint that names the
    component) and ``component_id``: the smallest doc_id that chains of links
    reach."""
    docs = stored(fingerprints(documents, size, seed), "fingerprints")
    n = docs.count()
    distinct = stored(docs.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "distinct-fingerprints")
    star = stars(links(distinct, radius))
    rooted = distinct.join(star.withColumnRenamed("a", "fp"), "fp", "left").select("fp", "doc_id", F.coalesce("b", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classes = stored(in_few_files(rooted.join(smallest, "root").select("fp", "root", "component_id"), n), "classes")
    return in_few_files(docs.join(classes, "fp").select("doc_id", "fp", "root", "component_id"), n)
