"""Operator 5, quality by an interpolated modified Kneser-Ney n-gram model.

The model is over bytes (so every text has known symbols) and trained on all
trusted documents.  One pass counts the n-grams of all documents, trusted ones
apart.  Discounts, context totals and lower-order counts come from that table
by aggregation, and the probability of every n-gram that any document has by
joins of the counts, order by order, sharded by context and by suffix.  The
finished table is dealt out to the scoring tasks in shards of at most
``SHARD`` n-grams, one pass over the texts each.

A document is kept if its loss per byte is at most its language's threshold:
a quantile of the trusted documents' losses plus a margin.  These losses are
out of sample: trusted documents are dealt by text to ``FOLDS`` folds, and each
fold's are taken under the model of the other folds.  A language's quantile is
its mean plus a distance from it, which is drawn towards that of all languages
by ``min_trusted`` pseudo-documents.  Losses of short texts are drawn towards
their language's mean by ``shrink`` pseudo-bytes.

Defined results: null and empty texts consist of the end mark and are judged
like others; null languages, and languages without trusted documents, get the
threshold of all; without trusted documents all are kept, and where all trusted
texts are in one fold its model knows no text.  Repeated rows are scored alike; of several labels of one doc_id the
lowest holds, null labels are not trusted; a null doc_id is never trusted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsgrain.llm.common import broadcast_if_small, in_few_files, stored
from opsgrain.llm.pretokens import slices

ORDER = 5
BEGIN, END = 0xFF, 0xFE  # bytes that UTF-8 never has
SYMBOLS = 258
SHARD = 4_000_000
FOLDS = 4
BINS = 1000  # steps of a nat in which quantiles are taken
#: Columns that the operator adds; those of the same name are replaced.
COLUMNS = ("loss", "grams", "trusted", "mean", "threshold", "shrunk", "perplexity", "kept")


def grams(texts: list[str | None], order: int) -> tuple[np.ndarray, np.ndarray]:
    """N-grams (big-endian bytes) that end at each byte of each text and at its
    end mark, and their numbers per text."""
    pad = bytes([BEGIN]) * (order - 1)
    raw = [(t or "").encode() for t in texts]
    flat = np.frombuffer(b"".join(pad + r + bytes([END]) for r in raw), np.uint8)
    size = np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw))
    n = max(len(flat) - order + 1, 0)
    code = np.zeros(n, np.int64)
    for k in range(order):
        code <<= 8
        code |= flat[k:k + n]
    begin = np.cumsum(size + order - 1) - (size + order - 1)
    inside = np.ones(n, bool)
    for k in range(1, order):
        inside[begin[1:] - k] = False  # n-grams across two texts
    return code[inside], size


def _trusted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    good = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(
        (F.min(F.coalesce("quality", F.lit(0))) == 1).alias("trusted")).where("trusted")
    good = broadcast_if_small(stored(in_few_files(good, labels.count()), "trusted"))
    docs = documents.drop(*COLUMNS)
    return docs.join(good, F.col("doc_id").cast("bigint") == F.col("_id"), "left").drop("_id").withColumn("trusted", F.coalesce("trusted", F.lit(False)))


def count_grams(documents: DataFrame, order: int = ORDER) -> DataFrame:
    """``code``: every n-gram of any text; ``raw``: its number in trusted texts."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        code = np.concatenate([c for c, _ in parts])
        at = np.argsort(code, kind="stable")
        code, n = code[at], np.concatenate([x for _, x in parts])[at]
        first = np.flatnonzero(np.diff(code, prepend=-1))
        return code[first], np.add.reduceat(n, first) if len(first) else n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            good = np.array(batch.column("trusted").to_pylist(), bool)
            for a, b in slices(texts, 1 << 21):
                code, size = grams(texts[a:b], order)
                own = np.repeat(good[a:b], size)
                parts.append(np.unique(code[own], return_counts=True))
                rest = np.unique(code[~own])
                parts.append((rest, np.zeros(len(rest), np.int64)))
                if sum(len(c) for c, _ in parts) > 4_000_000:
                    parts = [merged(parts)]
                    if len(parts[0][0]) > 2_000_000:
                        yield from rows(parts.pop())
        if parts:
            yield from rows(merged(parts))

    def rows(part: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(part[0]), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[a:a + 100_000]) for x in part], names=["code", "raw"])

    return documents.select("text", "trusted").mapInArrow(run, "code bigint, raw bigint").groupBy("code").agg(F.sum("raw").alias("raw"))


def _level(above: DataFrame, k: int) -> DataFrame:
    """K-grams from (k+1)-grams: in trusted texts, their number (``raw``) and
    the number of symbols before them; ``a`` is what Kneser-Ney counts."""
    t = above.groupBy((F.col("code").bitwiseAND(F.lit((1 << 8 * k) - 1))).alias("code")).agg(
        F.sum("raw").alias("raw"), F.sum((F.col("raw") > 0).cast("bigint")).alias("before"))
    begins = F.shiftright("code", 8 * (k - 1)) == BEGIN  # nothing comes before the beginning
    return t.select("code", "raw", F.when(begins, F.col("raw")).otherwise(F.col("before")).alias("a"))


def _discounts(level: DataFrame) -> list[float]:
    """Chen and Goodman's discounts of counts 1, 2 and more, from the counts of
    counts; where those do not allow it, 0.5, 1 and 1.5."""
    n = level.agg(*(F.count(F.when(F.col("a") == i, 1)).alias(f"n{i}") for i in range(1, 5))).first()
    if not all(n):
        return [0.0, 0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    return [0.0, *(min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05 * i), float(i)) for i in (1, 2, 3))]


def log_probabilities(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``code`` and ``logp``, the natural logarithm of the probability of the
    n-gram's last byte after the others, for each code of ``counts``, a stored
    table."""
    n = counts.count()
    most = {k: min(n, SYMBOLS ** k) for k in range(1, order + 1)}
    levels = {order: counts.select("code", "raw", F.col("raw").alias("a"))}
    for k in range(order - 1, 0, -1):
        levels[k] = stored(in_few_files(_level(levels[k + 1], k), most[k]), f"grams-{k}")
    lower = None
    for k in range(1, order + 1):
        d = _discounts(levels[k])
        count = F.least("a", F.lit(3))
        discount = F.when(count == 1, d[1]).when(count == 2, d[2]).when(count == 3, d[3]).otherwise(0.0)
        t = levels[k].withColumn("context", F.shiftright("code", 8)).withColumn("suffix", F.col("code").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1)))
        t = t.withColumn("cut", discount)
        contexts = t.where("a > 0").groupBy("context").agg(F.sum("a").alias("total"), F.sum("cut").alias("freed"))
        t = t.join(contexts, "context", "left")
        if lower is None:
            t = t.withColumn("below", F.lit(1.0 / SYMBOLS))
        else:
            t = t.join(lower.select(F.col("code").alias("suffix"), F.col("p").alias("below")), "suffix")
        p = F.when(F.col("total").isNull(), F.col("below")).otherwise((F.col("a") - F.col("cut") + F.col("freed") * F.col("below")) / F.col("total"))
        lower = stored(in_few_files(t.select("code", p.alias("p")), most[k]), f"probabilities-{k}")
    return lower.select("code", F.ln("p").alias("logp"))


class GramTable:
    """Open-addressing table of n-grams and log probabilities."""

    def __init__(self, code: np.ndarray, logp: np.ndarray):
        self.bits = max(10, int(2 * len(code)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits, np.float32)
        left = np.arange(len(code))
        slot = self._slot(code)
        while len(left):
            free = self.keys[slot[left]] < 0
            self.keys[slot[left[free]]] = code[left[free]]
            done = self.keys[slot[left]] == code[left]
            self.values[slot[left[done]]] = logp[left[done]]
            left = left[~done]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, code: np.ndarray) -> np.ndarray:
        return ((code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, code: np.ndarray) -> np.ndarray:
        """Log probabilities; 0 for n-grams of other shards."""
        slot = self._slot(code)
        key = self.keys[slot]
        out = np.where(key == code, self.values[slot], np.float32(0))
        left = np.flatnonzero((key != code) & (key >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            key = self.keys[slot[left]]
            hit = key == code[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (key >= 0)]
        return out


def _add_losses(documents: DataFrame, shard: DataFrame, order: int) -> DataFrame:
    """One pass: adds the losses that this shard's n-grams make."""
    rows = shard.toArrow()  # at most about SHARD rows of 12 bytes
    table = documents.sparkSession.sparkContext.broadcast((rows["code"].to_numpy(), rows["logp"].to_numpy().astype(np.float32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None
        for batch in batches:
            known = known or GramTable(*table.value)
            texts = [t or "" for t in batch.column("text").to_pylist()]
            loss, n = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
            for a, b in slices(texts, 1 << 20):
                code, size = grams(texts[a:b], order)
                loss[a:b] = -np.add.reduceat(known.get(code).astype(np.float64), np.cumsum(size) - size)
                n[a:b] = size
            old = batch.column("loss").to_numpy()
            batch = batch.set_column(batch.schema.get_field_index("loss"), "loss", pa.array(old + loss))
            yield batch.set_column(batch.schema.get_field_index("grams"), "grams", pa.array(n))

    return documents.mapInArrow(run, documents.schema)


def _scored(docs: DataFrame, counts: DataFrame, order: int) -> DataFrame:
    """``docs`` with ``loss`` and ``grams`` under the model of ``counts``."""
    table = stored(log_probabilities(counts, order), "log-probabilities")
    shards = max(1, -(-table.count() // SHARD))
    docs = docs.withColumn("loss", F.lit(0.0)).withColumn("grams", F.lit(0).cast("bigint"))
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields])
    docs = docs.to(schema)
    for s in range(shards):
        docs = _add_losses(docs, table.where(F.pmod(F.xxhash64("code"), F.lit(shards)) == s), order)
    return docs


def with_losses(documents: DataFrame, labels: DataFrame, order: int = ORDER) -> DataFrame:
    """``documents`` with ``trusted``, ``loss`` (nats, whole text) and
    ``grams`` (bytes scored, the end mark included)."""
    docs = _trusted(documents, labels)
    return _scored(docs, stored(count_grams(docs, order), f"grams-{order}"), order)


def out_of_sample(documents: DataFrame, counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``lang``, ``loss`` and ``grams`` of the trusted ones of ``documents``,
    each under the model of the other folds.  ``counts`` are those of all."""
    good = stored(documents.where("trusted").select("lang", "text", "trusted", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).alias("fold")), "trusted-texts")
    n, out = counts.count(), []
    for f in range(FOLDS):
        fold = good.where(F.col("fold") == f)
        own = count_grams(fold, order).withColumnRenamed("raw", "own")
        # other folds' counts of every n-gram
        rest = counts.join(own, "code", "left").select("code", (F.col("raw") - F.coalesce("own", F.lit(0))).alias("raw"))
        out.append(_scored(fold, stored(in_few_files(rest, n), f"grams-without-{f}"), order).select("lang", "loss", "grams"))
    return reduce(DataFrame.unionAll, out)


def thresholds(losses: DataFrame, quantile: float, margin: float, shrink: float, min_trusted: int) -> DataFrame:
    """Per language (null: of all together): mean and threshold of the loss per
    byte, from an exact histogram of trusted documents' ``losses``, a stored
    table."""
    t = losses.select("lang", "loss", "grams")
    rows = 2 * losses.count()  # each counts for its language and for all
    t = t.where("lang is not null").unionAll(t.withColumn("lang", F.lit(None).cast("string")))
    means = stored(in_few_files(t.groupBy("lang").agg((F.sum("loss") / F.sum("grams")).alias("mean"), F.count("*").alias("n")), rows), "language-means")
    of = t.join(broadcast_if_small(means), t["lang"].eqNullSafe(means["lang"])).select(means["lang"], "mean", "n", (shrunk_loss(shrink) - F.col("mean")).alias("x"))
    bins = stored(in_few_files(of.groupBy("lang", "mean", "n", F.floor(F.col("x") * BINS).alias("bin")).agg(F.count("*").alias("c")), rows), "loss-bins")

    def distances(b: DataFrame) -> DataFrame:
        up_to = F.sum("c").over(Window.partitionBy("lang").orderBy("bin"))
        reached = b.withColumn("up_to", up_to).where(F.col("up_to") >= F.lit(quantile) * F.col("n"))
        return reached.groupBy("lang", "mean", "n").agg(((F.min("bin") + 1) / BINS).alias("distance"))

    own = bins.where("lang is not null")
    every = own.groupBy("bin").agg(F.sum("c").alias("c"))
    total = every.agg(F.sum("c")).first()[0] or 0
    every = distances(every.select(F.lit("").alias("lang"), F.lit(0.0).alias("mean"), F.lit(total).alias("n"), "bin", "c")).first()
    drawn = (F.col("n") * F.col("distance") + F.lit(min_trusted * (every["distance"] if every else 0.0))) / (F.col("n") + min_trusted)
    distance = F.when(F.col("lang").isNull(), F.col("distance")).otherwise(drawn)
    return distances(bins).select("lang", "mean", (F.col("mean") + distance + margin).alias("threshold"))


def shrunk_loss(shrink: float) -> Column:
    """Loss per byte, drawn towards the language's mean."""
    return (F.col("loss") + shrink * F.col("mean")) / (F.col("grams") + shrink)


def judge(documents: DataFrame, labels: DataFrame, order: int = ORDER, quantile: float = 0.99, margin: float = 0.1,
          shrink: float = 100.0, min_trusted: int = 50) -> DataFrame:
    """``documents`` with ``perplexity`` (per byte), ``threshold`` (on the
    shrunk loss per byte, ``shrunk``) and ``kept``."""
    docs = _trusted(documents, labels)
    counts = stored(count_grams(docs, order), f"grams-{order}")
    scored = _scored(docs, counts, order)
    limit = stored(thresholds(stored(out_of_sample(docs, counts, order), "losses"), quantile, margin, shrink, min_trusted), "thresholds")
    overall = limit.where("lang is null").first()
    mean, most = (overall["mean"], overall["threshold"]) if overall else (0.0, math.inf)
    by_lang = broadcast_if_small(limit.where("lang is not null").select(F.col("lang").alias("_lang"), "mean", "threshold"))
    out = scored.join(by_lang, F.col("lang") == F.col("_lang"), "left").drop("_lang")
    out = out.withColumn("mean", F.coalesce("mean", F.lit(mean))).withColumn("threshold", F.coalesce("threshold", F.lit(most)))
    out = out.withColumn("shrunk", shrunk_loss(shrink)).withColumn("perplexity", F.exp(F.col("loss") / F.col("grams")))
    return out.withColumn("kept", F.col("shrunk") <= F.col("threshold"))
