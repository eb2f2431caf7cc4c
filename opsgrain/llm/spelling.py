"""Operator 11, spelling variants by reduced-alphabet generation.

``vocabulary`` counts the words of all texts.  ``near_pairs`` hashes the
letters of each word to a few symbols, generates the one-edit neighbourhood of
the reduced word, joins it to the reduced vocabulary, and verifies the pairs on
the original strings.  A near pair of different lengths is one deletion from
its longer word, and a near pair of one length is one replacement from the word
with the smaller reduced form, so deletions and rising replacements of all
words find every pair, each once; insertions and falling replacements would
find the same pairs again from their other word, and are left out.

A reduced form that more than ``crowded`` words share is looked up with the
whole alphabet in place of the few symbols, where no two words share a form,
so no key of the join holds more than ``crowded`` vocabulary words and nothing
is dropped.  All joins are shuffled; only the crowded forms are broadcast, if a
count finds them few.  Words over ``LONG`` code points travel by hash, and their pairs
are joined back, so a very long word costs its length times the alphabet.

``forms`` counts each word's near words, picks its form, and follows forms to
their end by pointer doubling.

Defined results: null and empty texts have no words; a null doc_id reads as
empty in the hashed key; repeated rows count each; equal counts prefer the
smaller word in code-point order; a very long text is one row of the counting
task, which keeps its distinct words; an empty table gives no rows.  Other
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsgrain.llm.common import broadcast_if_small, shuffled, stored

MIN_LENGTH = 7
RUN = re.compile(f"[a-zÀ-ÿ]{{{MIN_LENGTH},}}")
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
SYMBOLS = 8
CROWDED = 64
LONG = 64
FLUSH = 400_000  # distinct words that a counting task holds
CELLS = 2_000_000  # keys that are made at a time
_BASE = 0x9E3779B97F4A7C15 | 1


def noisy(doc_id: str | None, run: str) -> str:
    """The word that a run of one document counts as."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % 31:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def words_of(doc_id: str | None, text: bytes) -> Counter:
    """Words of one text (UTF-8) with their occurrences; ``bytes.lower`` lowers A-Z only."""
    got: Counter = Counter()
    for run, n in Counter(RUN.findall(text.lower().decode())).items():
        word = noisy(doc_id, run)
        if len(word) >= MIN_LENGTH:
            got[word] += n
    return got


def vocabulary(documents: DataFrame, min_count: int = 2) -> DataFrame:
    """``(word, n)`` of all words that occur at least ``min_count`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                if text:
                    counts.update(words_of(doc_id, text))
                if len(counts) >= FLUSH:
                    yield flushed()
        yield flushed()

    texts = documents.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def symbols_of(letters: str, symbols: int | None) -> np.ndarray:
    """Symbol (from 1) of each letter: a hash to ``symbols`` of them, or with
    None the letter's own."""
    if symbols is None:
        return np.arange(1, len(letters) + 1)
    return np.array([zlib.crc32(f"letter {c}".encode()) % symbols + 1 for c in letters])


class Reducer:
    """Keys of reduced words and of their one-edit neighbourhoods, for many
    words of one length at a time."""

    def __init__(self, symbols: int | None):
        table = symbols_of(LETTERS, symbols)
        self.size = int(table.max())
        self.table = np.zeros(0x100, np.uint64)
        self.table[[ord(c) for c in LETTERS]] = table

    def reduced(self, words: list[str]) -> np.ndarray:
        """Words x positions: symbols."""
        raw = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        return self.table[raw].reshape(len(words), -1)

    @staticmethod
    def powers(n: int) -> np.ndarray:
        out = np.ones(n + 1, np.uint64)
        np.multiply.accumulate(np.full(n, _BASE, np.uint64), out=out[1:])
        return out

    def keys(self, words: list[str]) -> np.ndarray:
        """One key a word: a polynomial of its symbols, modulo 2^64."""
        s = self.reduced(words)
        return (s * self.powers(s.shape[1])[:-1][::-1]).sum(axis=1, dtype=np.uint64)

    def neighbours(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places in ``words`` and keys: the reduced word itself, its deletions
        and its rising replacements.  A key comes once a word, but words whose
        positions need several parts may repeat some."""
        s = self.reduced(words)
        n, length = s.shape
        power = self.powers(length)
        term = s * power[:-1][::-1]
        whole = term.sum(axis=1, dtype=np.uint64)
        before = np.cumsum(term, axis=1, dtype=np.uint64) - term  # of the symbols on the left, at their places
        after = whole[:, None] - before - term
        inverse = np.uint64(pow(_BASE, -1, 1 << 64))
        per = self.size // 2 + 2
        step = max(1, CELLS // max(1, n * per))
        for a in range(0, length, step):
            b = min(a + step, length)
            made = [before[:, a:b] * inverse + after[:, a:b]]
            place = power[:-1][::-1][a:b]
            for up in range(1, self.size):
                risen = np.where(s[:, a:b] + np.uint64(up) <= self.size, whole[:, None] + np.uint64(up) * place, made[0])
                made.append(risen)
            if a == 0:
                made.append(whole[:, None])
            keys = np.sort(np.concatenate(made, axis=1), axis=1)
            new = np.ones(keys.shape, bool)
            new[:, 1:] = keys[:, 1:] != keys[:, :-1]
            yield np.nonzero(new)[0], keys[new]


def _by_length(words: list[str]) -> Iterator[list[int]]:
    """Places of words of one length, a bounded number of letters at a time."""
    length = np.array([len(w) for w in words])
    for n in np.unique(length).tolist():
        places = np.flatnonzero(length == n).tolist()
        step = max(1, CELLS // (20 * n))
        for a in range(0, len(places), step):
            yield places[a:a + step]


def keyed(words: DataFrame, symbols: int | None) -> DataFrame:
    """``(key, word, n)``: the reduced vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reducer = Reducer(symbols)
        for batch in batches:
            own = batch.column("word").to_pylist()
            keys = np.zeros(len(own), np.uint64)
            for places in _by_length(own):
                keys[places] = reducer.keys([own[p] for p in places])
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *batch.columns], names=["key", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "key bigint, word string, n bigint")


def neighbourhoods(words: DataFrame, symbols: int | None) -> DataFrame:
    """``(key, own, ref)``: keys of each word's reduced neighbourhood.  ``own``
    is the word, or null over ``LONG`` code points; then ``ref`` is its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reducer = Reducer(symbols)
        for batch in batches:
            own, refs = batch.column("word").to_pylist(), batch.column("ref").to_numpy(zero_copy_only=False)
            for places in _by_length(own):
                part = [own[p] for p in places]
                short = len(part[0]) <= LONG
                for row, keys in reducer.neighbours(part):
                    for a in range(0, len(keys), 100_000):
                        r = row[a:a + 100_000]
                        word = pa.array(part, pa.string()).take(pa.array(r)) if short else pa.nulls(len(r), pa.string())
                        ref = pa.nulls(len(r), pa.int64()) if short else pa.array(refs[places][r])
                        yield pa.RecordBatch.from_arrays([pa.array(keys[a:a + 100_000].view(np.int64)), word, ref], names=["key", "own", "ref"])

    return words.select("word", F.xxhash64("word").alias("ref")).mapInArrow(run, "key bigint, own string, ref bigint")


def _reduced_text(word: Column, symbols: int) -> Column:
    return F.translate(word, LETTERS, "".join(map(str, symbols_of(LETTERS, symbols))))


def verified(candidates: DataFrame, symbols: int) -> DataFrame:
    """The pairs ``(own, word)`` one edit apart, in the one order in which a
    pair counts: longer first, else smaller reduced form, else smaller word."""
    own, word = F.col("own"), F.col("word")
    longer = F.length(own) - F.length(word)
    a, b = _reduced_text(own, symbols), _reduced_text(word, symbols)
    rising = (longer == 1) | ((longer == 0) & ((a < b) | ((a == b) & (own < word))))
    return candidates.where(F.abs(longer) <= 1).where(F.levenshtein(own, word, 1) == 1).where(rising).select("own", "word", "n")


def lookups(callers: DataFrame, index: DataFrame, symbols: int | None, long: bool) -> DataFrame:
    """``(own, word, n)``: candidates of ``callers(word)`` in ``index(key,
    word, n)``.  ``long``: whether there may be words over ``LONG``."""
    found = neighbourhoods(callers.where(F.length("word") <= LONG), symbols).join(shuffled(index), "key").select("own", "word", "n")
    if long:
        far = callers.where(F.length("word") > LONG)
        names = far.select(F.xxhash64("word").alias("ref"), F.col("word").alias("own"))
        found = found.unionByName(neighbourhoods(far, symbols).drop("own").distinct().join(shuffled(index), "key").join(shuffled(names), "ref").select("own", "word", "n"))
    return found


def near_pairs(words: DataFrame, symbols: int = SYMBOLS, crowded: int = CROWDED) -> DataFrame:
    """``(own, word, n)``: every unordered pair of words of ``words(word, n)``
    that are one edit apart, once, with the count of ``word``.  ``words``
    should be a stored table; ``symbols`` is at most 9."""
    long = not words.where(F.length("word") > LONG).isEmpty()
    reduced = stored(keyed(words, symbols), "reduced-vocabulary")
    heavy = stored(reduced.groupBy("key").count().where(F.col("count") > crowded).select("key"), "crowded-forms")
    if heavy.isEmpty():
        return verified(lookups(words, reduced, symbols, long), symbols)
    heavy = broadcast_if_small(shuffled(heavy))
    light = verified(lookups(words, reduced.join(heavy, "key", "left_anti"), symbols, long), symbols)
    # crowded forms: their words (the crowd) and the words with such a form in their neighbourhood (the callers) meet
    # by the whole alphabet; what rises there may fall here, so both sides' neighbourhoods are generated
    crowd = stored(reduced.join(heavy, "key", "left_semi").select("word", "n"), "crowd")
    near = neighbourhoods(words, symbols).join(heavy, "key", "left_semi")
    callers = near.where("own is not null").select(F.col("own").alias("word")).distinct()
    if long:
        refs = near.where("own is null").select("ref").distinct()
        callers = callers.unionByName(words.withColumn("ref", F.xxhash64("word")).join(shuffled(refs), "ref", "left_semi").select("word"))
    callers = stored(callers.withColumn("n", F.lit(0).cast("bigint")), "callers")
    there = lookups(callers, keyed(crowd, None), None, long)
    back = lookups(crowd, keyed(callers, None), None, long).select(F.col("word").alias("own"), F.col("own").alias("word"))
    exact = there.unionByName(back.join(shuffled(crowd), "word").select("own", "word", "n"))
    return light.unionByName(verified(exact, symbols).distinct())


def forms(words: DataFrame, pairs: DataFrame, factor: int = 10) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word."""
    named = pairs.select(F.col("own").alias("a"), F.col("word").alias("b"), F.col("n").alias("bn")).join(
        shuffled(words.select(F.col("word").alias("a"), F.col("n").alias("an"))), "a")
    best = F.struct((-F.col("m")).alias("less"), F.col("near").alias("word"))
    rows = words.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("bigint").alias("m"))
    rows = rows.unionByName(named.select(F.col("a").alias("word"), F.lit(None).cast("bigint").alias("n"), F.col("b").alias("near"), F.col("bn").alias("m")))
    rows = rows.unionByName(named.select(F.col("b").alias("word"), F.lit(None).cast("bigint").alias("n"), F.col("a").alias("near"), F.col("an").alias("m")))
    near = rows.groupBy("word").agg(F.max("n").alias("n"), F.count("near").alias("n_near"), F.min(F.when(F.col("near").isNotNull(), best)).alias("best"))
    strong = -F.col("best.less") >= factor * F.col("n")
    near = stored(near.select("word", "n", "n_near", F.when(strong, F.col("best.word")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n")), "near-words")
    return near.join(shuffled(roots(near.where("form is not null").select("word", "form"))), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(links: DataFrame) -> DataFrame:
    """``(word, root)`` of every word with a form; forms have larger counts, so
    there is no circle, and every round doubles the steps."""
    links = stored(links.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        links = stored(links.join(shuffled(ahead), "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        if links.where("moved").isEmpty():
            return links.select("word", "root")
        links = links.select("word", "root")


def spelling_variants(documents: DataFrame, min_count: int = 2, factor: int = 10, symbols: int = SYMBOLS, crowded: int = CROWDED) -> DataFrame:
    """Words of all texts with their near words counted, form and root."""
    words = stored(vocabulary(documents, min_count), "vocabulary")
    return forms(words, stored(near_pairs(words, symbols, crowded), "near-pairs"), factor)
