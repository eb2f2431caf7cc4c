"""Operators 4 and 8 and the pipeline against brute force."""

from __future__ import annotations

import random
import string

import numpy as np
import pytest
import xxhash
from llm_cases import CLASHING, DOCUMENTS, edge_documents, empty_documents, prose

import corpus_pipeline
from opsgrain.llm import common, components, decontaminate, packing, perplexity, registry, simhash

SF = "/root/testdata/sf0.001"


class Union(dict):
    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


# --- operator 4 -----------------------------------------------------------------

def brute_fingerprint(text):
    low = "".join(c.lower() if c in string.ascii_uppercase else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    s = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    u = Union()
    prints = [brute_fingerprint(t) for _, t in rows]
    for i in range(len(rows)):
        u.find(i)
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                u.join(i, j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = u.find(i)
        least[r] = min((x for x in (least.get(r), doc) if x is not None), default=None)
    return [(doc, prints[i], least[u.find(i)]) for i, (doc, _) in enumerate(rows)]


def key(rows):
    return sorted(rows, key=repr)


def test_near_duplicates_edge_cases(spark):
    docs = edge_documents(spark)
    got = [(r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in simhash.near_duplicates(docs).collect()]
    assert key(got) == key(brute_components([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert simhash.near_duplicates(empty_documents(spark)).count() == 0


def test_near_duplicates_on_given_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = [(r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in registry.op4_simhash(spark, SF).collect()]
    assert key(got) == key(brute_components([tuple(r) for r in docs]))


def planted_prints(n, seed):
    """Random fingerprints, and balls and chains of close ones."""
    rnd = random.Random(seed)
    out = {rnd.getrandbits(64) for _ in range(n)}
    for _ in range(12):
        x = rnd.getrandbits(64)
        for _ in range(n // 12):
            x ^= sum(1 << b for b in rnd.sample(range(64), rnd.choice([1, 3, 4, 5, 6])))
            out.add(x)
    ball = rnd.getrandbits(64)
    out |= {ball ^ (1 << a) ^ (1 << b) for a in range(25) for b in range(a)}  # the tree cannot divide it
    return sorted(out)


@pytest.mark.parametrize("leaf", [16, 100])
def test_tree_loses_no_pair(spark, leaf):
    prints = np.array(planted_prints(600, leaf), np.uint64)
    df = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long").repartition(5)
    found = Union()
    for r in simhash.links(df, 4, leaf=leaf, sample=300).collect():
        found.join(r["a"], r["b"])
    want = Union()
    signed = prints.view(np.int64).tolist()
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints[:i]) <= 4).tolist():
            want.join(signed[i], signed[j])
    assert all(found.find(x) == want.find(x) for x in signed)


@pytest.mark.parametrize("seed", [1, 2])
def test_stars(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1060)] + [(2000, 2000 + k) for k in range(1, 80)] + [(7, 7)]
    rnd.shuffle(edges)
    u = Union()
    for a, b in edges:
        u.join(a, b)
    got = {r["a"]: r["b"] for r in components.stars(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: u.find(x) for x in u if u.find(x) != x}
    assert components.stars(spark.createDataFrame([], "a long, b long")).count() == 0


def test_small_tables_make_few_files(spark, monkeypatch):
    """Where Spark merges no small partitions, a stored table of few rows is still one file."""
    files = {}

    def noted(df, name):
        out = common.stored(df, name)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    for module in (components, simhash, perplexity, packing, corpus_pipeline):
        monkeypatch.setattr(module, "stored", noted)
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    docs = spark.createDataFrame([(k, prose(k // 2, 40) + " x" * (k % 2), "en", "s", 1) for k in range(60)], DOCUMENTS)
    good = spark.createDataFrame([(k, 1, 0) for k in range(0, 60, 2)], "doc_id long, quality int, toxic int")
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        corpus_pipeline.simhash_near_dedup(spark, docs, SF).count()
        components.stars(spark.createDataFrame([(k, k + 1) for k in range(300)], "a long, b long"))
        perplexity.thresholds(perplexity.with_losses(docs, good).where("trusted"), 0.99, 0.1, 100.0, 50)
        packing.pack(docs).count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    one = {"large-stars", "stars", "classes", "near-duplicates", "duplicate-ids", "trusted", "piece-counts", "piece-offsets", "loss-bins",
           *(f"grams-{k}" for k in range(1, 5)), *(f"probabilities-{k}" for k in range(1, 6))}
    assert {k: files[k] for k in sorted(one)} == dict.fromkeys(sorted(one), 1)
    assert common.in_few_files(spark.range(10, numPartitions=7), 5 * common.FILE_ROWS).rdd.getNumPartitions() == 5
    assert common.in_few_files(spark.range(10, numPartitions=7), 9 * common.FILE_ROWS).rdd.getNumPartitions() == 7


# --- operator 8 -----------------------------------------------------------------

def items_frame(spark, rows):
    return spark.createDataFrame([(*r, None) for r in rows], "item_id long, text string, hits string")


def own_words(text):
    """Lower-cased words without punctuation at their ends, in plain Python."""
    out = []
    for w in (text or "").lower().split():
        while w and w[0] in string.punctuation:
            w = w[1:]
        while w and w[-1] in string.punctuation:
            w = w[:-1]
        out += [w] if w else []
    return out


def grams(words, n):
    return {" ".join(words[k:k + n]) for k in range(len(words) - n + 1)}


def question_and_answer(text):
    """The last sentence is the answer; sentences end with . ! or ? before a space."""
    text = (text or "").strip(" ")
    cuts = [k + 1 for k in range(len(text) - 1) if text[k] in ".!?" and text[k + 1].isspace() and text[k + 1:].strip()]
    cut = cuts[-1] if cuts else 0
    return own_words(text[:cut]), own_words(text[cut:])


def brute_hits(docs, items, share=0.8, part=0.5):
    """All runs of words that are twice as long as the longest item, at every
    multiple of its length."""
    asked = [(i, *question_and_answer(t)) for i, t in items]
    step = max((len(q) + len(x) for _, q, x in asked), default=1) or 1
    out = set()
    for doc, text in docs:
        w = own_words(text)
        for a in range(0, max(1, len(w) - step), step):
            run = w[a:a + 2 * step]
            have = {n: grams(run, n) for n in range(1, 6)}

            def held(words, n):
                want = grams(words, n)
                return len(want & have[n]) / len(want) if want else 1

            for i, q, x in asked:
                whole = held(q + x, min(5, len(q + x))) if q + x else 0
                parts = [held(y, 5 if len(y) >= 5 else 1) for y in (q, x)]
                if whole >= share - 1e-9 and min(parts) >= part - 1e-9:
                    out.add((doc, i))
    return out


ITEMS = [(1, prose(50, 30) + ". " + prose(51, 6) + "."), (2, prose(52, 12)), (3, "One two."), (4, None), (5, ""), (6, "..."), (7, prose(52, 12)), (8, "yes yes yes yes yes yes. yes")]


def contaminated_texts():
    item = ITEMS[0][1]
    w = item.split()
    return [prose(60, 200) + " " + item + " " + prose(61, 150), item.upper(), " ".join(w[:31]), " ".join(w[:20]), prose(62, 20) + " " + ITEMS[1][1], "so one, TWO!", "yes " * 9,
            " | ".join(w), " ".join(w[:15] + ["x"] + w[15:]), prose(63, 500), None, "", "***"]


def test_hits_equal_brute_force(spark):
    docs = list(enumerate(contaminated_texts()))
    frame = spark.createDataFrame([(*d, None) for d in docs], "doc_id long, text string, hits string").drop("hits")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(frame, items_frame(spark, ITEMS)).collect()}
    assert got == brute_hits(docs, ITEMS) and {(0, 1), (1, 1), (4, 2), (4, 7), (5, 3), (6, 8), (7, 1)} <= got and not any(d in (2, 3, 9, 10, 11, 12) for d, _ in got)
    shards = decontaminate.with_hits(frame, decontaminate.question_answer(items_frame(spark, ITEMS)), max_items=2)
    assert {(r["doc_id"], h["item_id"]) for r in shards.collect() for h in r["hits"]} == got


def test_hits_on_given_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert {(r["doc_id"], r["item_id"]) for r in registry.op8_decontamination(spark, SF).collect()} == brute_hits(docs, items)


def test_hits_edge_cases(spark):
    docs = edge_documents(spark)
    assert decontaminate.contaminated(docs, items_frame(spark, [])).count() == 0
    assert decontaminate.contaminated(empty_documents(spark), items_frame(spark, ITEMS)).count() == 0
    got = decontaminate.contaminated(docs, items_frame(spark, [(1, prose(1, 60)), (2, prose(4, 40))])).collect()
    assert sorted((r["doc_id"] is None, r["item_id"]) for r in got) == [(False, 1)] * 5 + [(True, 2)]


def test_wand_retrieves_all_above_threshold():
    rnd = random.Random(4)
    index = decontaminate.Index([(k, prose(100 + k, rnd.randint(1, 40)), "") for k in range(150)])
    for n in (1, 5, 40, 150, 300) * 6:
        terms = sorted(set(rnd.sample(range(len(index.numbers)), n)) | (set(index.items[n % 150].words) if n < 50 else set()))
        share = np.zeros(150)
        for t in terms:
            share[index.ids[t]] += index.share[t]
        assert {k for k, _ in index.retrieve(terms)} == set(np.flatnonzero(share >= 1 - 1e-9).tolist())


def test_a_question_without_its_answer_is_no_hit(spark):
    question, answer = prose(70, 24), "Ebro"
    long = prose(71, 8)
    items = spark.createDataFrame([(1, f"{question}? {answer}."), (2, f"{prose(72, 40)}? {long}.")], "item_id long, text string")
    docs = [(1, f"{prose(73, 30)} {question}? {prose(74, 30)}"), (2, f"{prose(73, 30)} {question}? {answer}. {prose(74, 30)}"), (3, f"{prose(72, 40)}? {prose(75, 8)}"),
            (4, f"{prose(72, 40)}? {long}"), (5, f"{prose(72, 40)}? {' '.join(long.split()[:6])} {prose(76, 9)}")]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert got == {(2, 1), (4, 2), (5, 2)}


# --- pipeline -------------------------------------------------------------------

def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_keep_columns_and_stand_edge_cases(spark):
    for docs in (edge_documents(spark), empty_documents(spark)):
        for name, f in corpus_pipeline.STAGES[:-1]:
            out = f(spark, docs, SF)
            assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
            assert out.count() <= docs.count()
        stage("best_fit_packing")(spark, docs, SF).collect()
    assert DOCUMENTS and CLASHING


def test_near_dedup_stage_keeps_one_of_each_group(spark):
    docs = edge_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = {d for d, _, c in brute_components(rows) if d == c and d is not None}
    got = [r["doc_id"] for r in stage("simhash_near_dedup")(spark, docs, SF).collect() if r["doc_id"] is not None]
    assert sorted(got) == sorted(want) and len(got) == len(set(got))


def test_near_dedup_tells_rows_of_one_doc_id_apart(spark):
    x, y, z, a, b, c = (prose(80 + k, 60) for k in range(6))
    rows = [(1, x), (5, x), (5, z), (7, a), (7, b), (7, b), (8, a), (9, y), (9, y), (None, y), (None, c), (None, c), (None, x)]
    docs = spark.createDataFrame([(*r, "en", "s", None) for r in rows], DOCUMENTS)
    got = [(r["doc_id"], r["text"]) for r in stage("simhash_near_dedup")(spark, docs, SF).collect()]
    assert sorted(got, key=repr) == sorted([(1, x), (5, z), (7, a), (7, b), (9, y), (None, c)], key=repr)


def test_pipeline_stage_by_stage(spark):
    """Each stage against brute force over what the stage before it kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = stage("quality_classifier")(spark, docs, SF).cache()
    kept = {r["doc_id"] for r in registry.op5_quality_classifier(spark, SF).collect() if r["kept"]}
    assert {r["doc_id"] for r in first.collect()} == kept
    second = stage("toxicity")(spark, first, SF).cache()
    assert second.exceptAll(first).count() == 0
    third = stage("simhash_near_dedup")(spark, second, SF).cache()
    rows = [(r["doc_id"], r["text"]) for r in second.collect()]
    assert {r["doc_id"] for r in third.collect()} == {d for d, _, c in brute_components(rows) if d == c}
    fourth = stage("benchmark_decontamination")(spark, third, SF).cache()
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {d for d, _ in brute_hits([(r["doc_id"], r["text"]) for r in third.collect()], items)}
    assert {r["doc_id"] for r in fourth.collect()} == {r["doc_id"] for r in third.collect()} - bad
    packed = stage("best_fit_packing")(spark, fourth, SF)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in fourth.collect()}
