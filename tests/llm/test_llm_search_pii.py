"""Operators 11 to 13 against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from llm_cases import LONG, edge_documents, edge_rows, empty_documents, prose
from pyspark.sql import functions as F

from opsgrain.llm import lexical, pii, registry, spelling
from opsgrain.llm.common import BATCH_BYTES, BATCH_SETTING, WIDE_ROWS, small_batches, stored

SF = "/root/testdata/sf0.001"
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


# --- operator 11 ----------------------------------------------------------------

def brute_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII_LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute_forms(n):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def forms_of(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_spelling_variants_equal_brute_force(spark):
    rnd = random.Random(5)
    roots = ["".join(rnd.choices("aeimnrstéß÷", k=rnd.randint(7, 11))) for _ in range(25)]

    def edited(w):
        i, kind = rnd.randrange(len(w)), rnd.randrange(3)
        return w[:i] + ("", rnd.choice("aeqÿ"), w[i] + rnd.choice("aeqÿ"))[kind] + w[i + 1:]

    words = [w for r in roots for w in [r] * 40 + [edited(r) for _ in range(12)] * 2 + [edited(edited(r)) for _ in range(9)] * 2]
    rnd.shuffle(words)
    rows = [(k if k % 7 else None, " ".join(words[a:a + 30]).upper() if k % 3 else "1".join(words[a:a + 30])) for k, a in enumerate(range(0, len(words), 30))]
    rows += [*rows[:3], (None, None), (5, "")]
    want = brute_forms(brute_words(rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert len([w for w in want if w[1]]) > 20
    assert forms_of(spelling.spelling_variants(docs)) == want
    # few symbols and a low bound of crowded forms: the exact way of crowded forms does most of the work
    assert forms_of(spelling.spelling_variants(docs, symbols=2, crowded=3)) == want


def test_words_of_one_reduced_form_are_all_linked(spark):
    same = [c for c, s in zip(spelling.LETTERS, spelling.symbols_of(spelling.LETTERS, spelling.SYMBOLS), strict=True) if s == 1]
    base = same[0] * 6
    words = {base + "".join(x): 2 for x in itertools.product(same, repeat=2)} | {same[1] * 80: 3, same[1] * 79 + same[0]: 40, same[1] * 79: 2}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    want = sorted(tuple(sorted(p)) for p in itertools.combinations(words, 2) if one_edit(*p))
    for crowded in (4, 10_000):
        assert sorted(tuple(sorted((r["own"], r["word"]))) for r in spelling.near_pairs(table, crowded=crowded).collect()) == want


def test_spelling_joins_are_not_broadcast_by_estimated_size(spark):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    rnd = random.Random(6)
    words = {"".join(rnd.choices("abcdefgh", k=8)): 2 for _ in range(300)} | {"z" * 80: 3, "z" * 79: 40, "y" * 7: 2, "y" * 8: 30}
    table = stored(spark.createDataFrame(list(words.items()), "word string, n long"), "test-words")
    pairs = spelling.near_pairs(table)
    assert "SortMergeJoin" in plan(pairs) and "Broadcast" not in plan(pairs)
    forms = spelling.forms(table, stored(pairs, "test-pairs"))
    assert "SortMergeJoin" in plan(forms) and "Broadcast" not in plan(forms)
    assert forms_of(forms) == brute_forms(words)
    # crowded forms, which were counted, are the only rows broadcast
    crowded = spelling.near_pairs(table, symbols=2, crowded=3)
    assert set(re.findall(r"BroadcastHashJoin \[([a-z]+)#", plan(crowded))) == {"key"}
    assert all("LeftAnti" in x or "LeftSemi" in x for x in re.findall("BroadcastHashJoin.*", plan(crowded)))
    assert forms_of(spelling.forms(table, stored(crowded, "test-pairs"))) == brute_forms(words)


def test_spelling_edge_cases(spark):
    docs = edge_documents(spark)
    want = brute_forms(brute_words([r[:2] for r in edge_rows()]))
    assert forms_of(spelling.spelling_variants(docs)) == want
    assert spelling.spelling_variants(empty_documents(spark)).count() == 0


# --- operator 12 ----------------------------------------------------------------

def brute_terms(text):
    return Counter(t.translate(ASCII_LOWER) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or ""))


def brute_search(rows, items, top):
    docs = [(d, brute_terms(t)) for d, t in rows]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    n, total = len(docs), sum(x[2] for x in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c, length in docs:
            m = 100 - 50 + 50 * length * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in brute_terms(text) if t in c)
            if s > 0:
                found.append((-s, d is None, d or 0))
        out += [(item, k + 1, None if x[1] else x[2], -x[0]) for k, x in enumerate(sorted(found)[:top])]
    return sorted(out, key=repr)


def ranked(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("postings", "query_terms"), [(lexical.BLOCK_POSTINGS, lexical.QUERY_TERMS), (300, 60)])
def test_search_equals_exhaustive_search(spark, monkeypatch, postings, query_terms):
    real = lexical.build
    monkeypatch.setattr(lexical, "build", lambda d: real(d, postings))
    rows = [(k, prose(k, 5 + k * 7 % 90)) for k in range(240)] + [(500 + k, prose(k, 5 + k * 7 % 90)) for k in range(40)] + [(None, prose(3, 26)), (3, prose(3, 26)), (9, None), (10, "?!")]
    items = [(k, prose(1000 + k, 12)) for k in range(20)] + [(20, prose(3, 26)), (20, prose(3, 26)), (None, "É " + prose(7, 4).upper()), (21, None), (22, ""), (23, "unseenterm")]
    docs, asked = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for top in (5, 50):
        assert ranked(lexical.lexical_search(docs.repartition(3), asked, top, query_terms)) == brute_search(rows, items, top)


def test_frequent_term_of_one_document_leaves_a_byte_a_posting(spark):
    rows = [(k, prose(k, 60)) for k in range(50)] + [(50, "often " * 254 + "once"), (51, "often " * 255), (52, "often " * 256 + prose(3, 9)), (53, "often " * 70_000 + "rare " * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    postings = sum(len(brute_terms(t)) for _, t in rows)
    found = lexical.build(docs.coalesce(1)).blocks.collect()
    assert sum(len(r["tfs"]) for r in found) == postings
    assert sorted(n for r in found for n in np.frombuffer(r["large"], np.int64).tolist()) == [255, 256, 300, 70_000]
    items = [(1, "often"), (2, "rare once " + prose(3, 9))]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert ranked(lexical.lexical_search(docs, asked, 60)) == brute_search(rows, items, 60)


def test_rows_of_megabytes_go_to_workers_a_few_at_a_time(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

    rows = stored(spark.range(0, 24, 1, 1).select(F.expr("randstr(1000000, 7)").cast("binary").alias("b")), "wide-rows", **WIDE_ROWS)
    found = [pq.ParquetFile(f.removeprefix("file://").removeprefix("file:")).metadata for f in rows.inputFiles()]
    groups = [m.row_group(i).num_rows for m in found for i in range(m.num_row_groups)]
    assert sum(groups) == 24 and max(groups) <= 12
    before = spark.conf.get(BATCH_SETTING)
    with small_batches(spark):
        got = [r["n"] for r in stored(rows.mapInArrow(sizes, "n bigint"), "batches").collect()]
    assert sum(got) == 24 and max(got) <= BATCH_BYTES // 1_000_000 + 1
    assert spark.conf.get(BATCH_SETTING) == before


def test_pair_bounds_are_true_and_tighter():
    rng = np.random.default_rng(3)
    tighter = 0
    for _ in range(300):
        scores = rng.integers(0, 100, (30, 6)) * (rng.random((30, 6)) < 0.5)  # documents x terms
        single = scores.max(axis=0).tolist()
        joint = [int(np.where((scores[:, i] > 0) & (scores[:, i + 1] > 0), scores[:, i] + scores[:, i + 1], 0).max()) for i in range(5)]
        bound = lexical.suffix_bounds(single, joint)
        assert all(scores[:, i:].sum(axis=1).max() <= bound[i] <= sum(single[i:]) for i in range(6))
        tighter += bound[0] < sum(single)
    assert tighter > 200


def test_search_edge_cases(spark):
    docs, rows = edge_documents(spark), [r[:2] for r in edge_rows()]
    items = [(1, prose(1, 60)), (2, "one 漢字 naïve"), (3, LONG)]
    asked = spark.createDataFrame([(*r, None) for r in items], "item_id long, text string, score string")
    got, want = ranked(lexical.lexical_search(docs, asked, 7)), brute_search(rows, items, 7)
    assert got == want
    assert lexical.lexical_search(empty_documents(spark), asked).count() == 0
    none = lexical.lexical_search(docs, asked.limit(0))
    assert none.count() == 0 and none.columns == ["item_id", "rank", "doc_id", "score"]


# --- operator 13 ----------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(text):
    d = [int(c) for c in reversed(text) if c.isdigit()]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


def brute_base(text):
    def right(kind, m):
        n = sum(c.isdigit() for c in m)
        return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.split(".")), "card": 13 <= n <= 19 and luhn(m), "phone": 9 <= n <= 15}[kind]

    return [f"{k}:{m.start()}:{m.end()}" for k, p in BASE.items() for m in re.finditer(p, text or "") if right(k, m.group())]


def card(rnd):
    while True:
        c = "".join(rnd.choices("0123456789", k=16))
        if luhn(c):
            return c


def personal_rows():
    rnd = random.Random(8)
    rows = []
    for k in range(240):
        junk = "".join(rnd.choices("0123456789", k=(16, 14, 11)[k % 3]))
        bit = [f"{'mail' if k % 12 else 'to'} ann.{k}@site{k % 7}.example.org now", f"at {k % 256}.{k % 199}.7.1, and", f"{'card' if k % 12 == 2 else 'the'} {card(rnd)} paid", f"{'call' if k % 12 == 3 else 'to'} +1 ({100 + k}) 555-{1000 + k} soon", f"id {junk} there", f"ref {junk[:5]} {junk[5:]} x"][k % 6]
        rows.append((k, f"{prose(k, 20)} {bit} {prose(k + 1, 20)}"))
    return rows


def test_base_spans_equal_brute_force_on_hard_texts(spark):
    rnd = random.Random(4)
    texts = ["".join(rnd.choices(list("ab@.-+_% ()019") + ["@a.b", "+1 ", "4111 1111 ", "1.2.3.", "👍", "é"], k=rnd.randint(1, 60))) for _ in range(600)]
    texts += ["a" * 6_000, "1" * 9_000, "1 2 " * 8_000, "a@" + "b." * 9_000 + "c", "1.2.3.4.5.6.7.8 999.1.2.3.4 00000000000000000000000001.2.3.4", "a@b.c_d@e.f", "4" * 15 + "\n" + "+" * 500,
              " ".join(f"x{k}@y.zz 10.0.0.{k % 300}" for k in range(1500)), None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.find_personal_data(docs).select("doc_id", pii.digest(F.col("base")).alias("base"), pii.digest(F.col("spans")).alias("spans")).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        want = brute_base(t)
        assert got[k]["base"] == ",".join(want)
        assert set(want) <= set(got[k]["spans"].split(","))


def test_spans_that_the_base_patterns_lose_are_added(spark):
    rnd = random.Random(9)
    a, b = card(rnd), card(rnd)
    bad = next(x for x in ("7536784127813050", "7536784127813051") if not luhn(x + b) and not luhn(x))
    cases = {
        1000: (f"pay {bad} {b} then", [f"card:{len(bad) + 5}:{len(bad) + 21}"]),
        1001: ("ring +1 (826) 555-4081 190.137.223.204 ok", ["ip:23:38", "phone:5:22"]),
        1002: ("mail ann.7(at)site.example(dot)org ok", ["email:5:34"]),
        1003: (f"pay {a[:4]}.{a[4:8]}.{a[8:12]}.{a[12:]} ok", ["card:4:23"]),
        1004: (f"clean text with {bad} and 2024 and 12 numbers", []),
        1005: (prose(77, 60), []),
    }
    docs = spark.createDataFrame(personal_rows() + [(k, t) for k, (t, _) in cases.items()], "doc_id long, text string")
    got = {r["doc_id"]: r["s"] for r in pii.find_personal_data(docs).select("doc_id", pii.digest(F.col("spans")).alias("s")).collect()}
    for k, (_, want) in cases.items():
        assert got[k] == ",".join(want), k
    assert all(got[k] == ",".join(brute_base(t)) for k, t in personal_rows())  # clean ones stay clean


def test_overlaps_go_to_the_highest_score(spark):
    rnd = random.Random(2)
    rows = [(k // 40, k % 3, rnd.randint(1, 4), f, f + rnd.randint(0, 5), k, k, round(rnd.random(), 1)) for k in range(200) for f in (rnd.randint(1, 12),)]
    rows = list({r[:5]: r for r in rows}.values())
    want = set()
    taken = set()
    for r in sorted(rows, key=lambda r: (-r[7], r[3] - r[4], r[2], r[3])):
        cells = {(r[0], r[1], c) for c in range(r[3], r[4] + 1)}
        if not cells & taken:
            taken |= cells
            want.add(r[:5])
    df = spark.createDataFrame(rows, "row long, region int, kind int, first int, last int, start int, end int, score double")
    assert {tuple(r)[:5] for r in pii.without_overlaps(df).select("row", "region", "kind", "first", "last").collect()} == want


def test_personal_data_edge_cases(spark):
    docs = edge_documents(spark)
    got = pii.find_personal_data(docs).select("doc_id", pii.digest(F.col("base")).alias("base")).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((r[0], ",".join(brute_base(r[1])))) for r in edge_rows())
    assert pii.find_personal_data(empty_documents(spark)).count() == 0


def test_personal_data_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = registry.op13_personal_data(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        want = brute_base(docs[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x.startswith(k) for x in want) for k in pii.KINDS]
        assert set(want) <= set(r["spans"].split(",")) or not want
