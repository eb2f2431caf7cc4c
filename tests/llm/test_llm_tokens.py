"""Operators 1, 6 and 7 against the library, text by text."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import LONG, edge_documents, empty_documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from opsgrain.llm import packing, registry, token_counts, token_files
from opsgrain.llm.pretokens import Encoder, Splitter, tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_library_on_odd_texts():
    rnd = random.Random(3)
    parts = [*"ab's tmdrel' \n\t\r!.,;1²٣Ⅷé漢字👍\u0000\u0085\u2003\u3000-<|>", "<|endoftext|>", "'ll", "'re", " 's", "  ", "\n\n", "x" * 40]
    encoder = Encoder(PATH, max_cached=50)  # the cache starts afresh again and again
    for _ in range(120):
        texts = ["".join(rnd.choices(parts, k=rnd.choice([0, 1, 2, 5, 60]))) for _ in range(rnd.choice([1, 4, 15]))]
        ids, ends = encoder.encode(texts, 0)
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == [ids_of(t) + [0] for t in texts]


def test_equal_codes_are_proved_even_when_mixed_words_collide(monkeypatch):
    splitter = Splitter(PATH)
    import pandas as pd

    real = pd.factorize
    monkeypatch.setattr("opsgrain.llm.pretokens.pd.factorize", lambda x: real(x % np.uint64(2)) if x.dtype == np.uint64 else real(x))
    joined, bounds, codes, first = splitter.split(["one two three one", "two"])
    pieces = [joined[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert all((codes[i] == codes[j]) == (pieces[i] == pieces[j]) for i in range(len(pieces)) for j in range(len(pieces)))


def test_token_counts(spark):
    docs = edge_documents(spark)
    got = token_counts.token_counts(docs).collect()
    want = [(r["doc_id"], len((r["text"] or "").encode()), len(ids_of(r["text"]))) for r in docs.collect()]
    assert Counter(map(tuple, got)) == Counter(want)
    assert token_counts.token_counts(empty_documents(spark)).count() == 0


def test_a_posting_counts_beyond_255(spark):
    docs = spark.createDataFrame([(1, "a" + " b" * 1000), (2, " b" * 255)], "doc_id long, text string")
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs).collect()} == {1: 1001, 2: 255}


def test_packing(spark):
    docs = edge_documents(spark)
    rows = packing.pack(docs, payload=F.crc32("ids").alias("ids_crc32")).collect()
    want = Counter()
    for r in docs.collect():
        ids = ids_of(r["text"]) + [0]
        head = (len(ids) - 1) % 2048 + 1
        cuts = [0, *range(head, len(ids), 2048), len(ids)]
        want.update((r["doc_id"], k, a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    at: dict[int, int] = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at.get(r["sequence_id"], 0)  # gapless from 0
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(at.values()) <= 2048
    assert packing.pack(empty_documents(spark)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_every_piece_once_and_beats_best_fit(seed):
    rnd = random.Random(seed)
    counts = Counter(min(100, int(rnd.expovariate(1 / 25)) + 1) for _ in range(3000))
    counts[37] += 2000  # one length holds a large share
    plan = packing.plan_bins(dict(counts), 100)
    used = Counter()
    for lengths, times in plan:
        assert sum(lengths) <= 100
        used.update({k: v * times for k, v in Counter(lengths).items()})
    assert used == counts
    bins, bound = sum(t for _, t in plan), -(-sum(k * v for k, v in counts.items()) // 100)
    free = [0] * 101  # best-fit decreasing, piece by piece
    for x in sorted(counts.elements(), reverse=True):
        gap = next((g for g in range(x, 100) if free[g]), None)
        if gap is not None:
            free[gap] -= 1
        free[(100 if gap is None else gap) - x] += 1
    assert bound <= bins <= sum(free) + 1
    where = packing.places(plan, 100)
    seats = set()
    for x, n in counts.items():
        mine = where[where[:, 0] == x]
        for rank in range(n):
            row = mine[np.searchsorted(mine[:, 1], rank, "right") - 1]
            k = rank - row[1]
            seats.update((int(row[2] + k // row[3]), int(row[4] + k % row[3] * x) + j) for j in range(x))
    assert len(seats) == sum(k * v for k, v in counts.items())  # no two pieces share a place


def test_two_replace_the_smallest():
    # greedy takes 60 + 30 and leaves 10; 20 + 20 fill the expanded gap
    assert ([60, 20, 20], 1) in packing.plan_bins({60: 1, 30: 1, 20: 2}, 100)


def test_token_files(spark):
    docs = edge_documents(spark)
    got = token_files.round_trip(docs).collect()
    want = Counter((r["doc_id"], len(ids_of(r["text"])) + 1, crc(ids_of(r["text"]) + [0])) for r in docs.collect())
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert [i for i in ids if i is not None] == sorted(i for i in ids if i is not None)
    assert token_files.round_trip(empty_documents(spark)).count() == 0


@pytest.mark.parametrize("bits", [8, 16])
def test_huffman_codes(bits):
    rnd = np.random.default_rng(5)
    counts = rnd.zipf(1.3, 200).clip(0, 3000)
    counts[::7] = 0
    lengths = token_files.code_lengths(counts, bits)
    used = counts > 0
    assert (lengths[used] > 0).all() and not lengths[~used].any() and lengths.max() <= bits
    assert (2.0 ** -lengths[used].astype(float)).sum() == pytest.approx(1)
    import heapq

    heap = [int(c) for c in counts[used]]
    heapq.heapify(heap)
    best = 0
    while len(heap) > 1:
        x = heapq.heappop(heap) + heapq.heappop(heap)
        best += x
        heapq.heappush(heap, x)
    total = int((counts * lengths).sum())
    assert total >= best and (bits == 8 or total == best)
    ids = rnd.choice(len(counts), 5000, p=counts / counts.sum()).astype(np.uint32)
    for n in (0, 1, 255, 256, 257, 5000):
        packed = token_files.encode_bits(ids[:n], token_files.canonical_codes(lengths), lengths)
        back = token_files.decode_bits(*packed, n, token_files.decode_table(lengths)) if n else ids[:0]
        assert (back == ids[:n]).all()


def test_one_symbol_is_one_bit():
    lengths = token_files.code_lengths(np.array([0, 9]))
    bits = token_files.encode_bits(np.ones(9, np.uint32), token_files.canonical_codes(lengths), lengths)
    assert token_files.decode_bits(*bits, 9, token_files.decode_table(lengths)).tolist() == [1] * 9


def test_registered_token_queries(spark):
    sf = "/root/testdata/sf0.001"
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in registry.op1_token_counts(spark, sf).collect():
        n = len(ids_of(text[r["doc_id"]]))
        assert (r["n_tokens"], r["over_limit"]) == (n, n > 1024)
    assert {r["doc_id"] for r in registry.op6_packing(spark, sf).collect()} == set(text)
    at = 0
    for r in sorted(registry.op7_token_files(spark, sf).collect(), key=lambda r: r["doc_id"]):
        ids = ids_of(text[r["doc_id"]]) + [0]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), crc(ids))
        at += len(ids)
    assert LONG
