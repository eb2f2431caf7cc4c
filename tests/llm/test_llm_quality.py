"""Operators 2, 5 and 9 against brute force, and their accuracy."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import edge_documents, empty_documents, labels, prose

from opsgrain.llm import host_rules, perplexity, registry, toxicity

SF = "/root/testdata/sf0.01"


# --- operator 2 -----------------------------------------------------------------

def brute_measure(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i:i + 8])].append(i)
    covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(8)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, rep = len(w), len(covered)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), rep, n < 20 or 100 * rep > 30 * n


def test_measures(spark):
    docs = edge_documents(spark)
    got = host_rules.measure(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert Counter(map(tuple, got)) == Counter((r["doc_id"], *brute_measure(r["text"])) for r in docs.collect())
    assert host_rules.apply_host_rules(empty_documents(spark)).count() == 0


def test_overlapping_windows_count_once(spark):
    texts = ["x " * 30, prose(5, 40) + " " + prose(5, 40), " ".join(f"w{k}" for k in range(50)) + " " + " ".join(f"w{k}" for k in range(3, 12))]
    docs = spark.createDataFrame([(k, t, "h") for k, t in enumerate(texts)], "doc_id long, text string, source string")
    got = {r["doc_id"]: r["n_repeat_words"] for r in host_rules.measure(docs).collect()}
    assert got == {k: brute_measure(t)[4] for k, t in enumerate(texts)}


def test_windows_are_sorted_once(spark):
    """Lambda bodies share no subexpressions: each mention of the sorted windows would sort them again."""
    docs = spark.createDataFrame([(1, "a b c d " * 60, "h")], "doc_id long, text string, source string")
    plan = host_rules.measure(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_sort(") == 2  # the windows, and the starts of the repeated ones


def test_bad_hosts_lose_their_good_documents(spark):
    rows = [(k, prose(k, 40) if k % 10 == 0 else "short", "bad") for k in range(200)]
    rows += [(1000 + k, prose(k, 40), f"h{k % 7}") for k in range(140)] + [(2000, prose(9, 40), None), (2001, "short", "h0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["kept"] for r in host_rules.apply_host_rules(docs).collect()}
    assert not any(kept[k] for k in range(200)) and all(kept[1000 + k] for k in range(140))
    assert kept[2000] and not kept[2001]


def test_one_bad_document_does_not_condemn_a_host(spark):
    rows = [(k, prose(k, 40), f"h{k % 50}") for k in range(500)] + [(9999, "short", "tiny"), (9998, prose(1, 30), "tiny")]
    got = host_rules.host_verdicts(host_rules.measure(spark.createDataFrame(rows, "doc_id long, text string, source string"))).where("host = 'tiny'").first()
    assert got["shrunk_rate"] < 0.5 and got["host_accepted"]


# --- operator 5 -----------------------------------------------------------------

class BruteKneserNey:
    """Interpolated modified Kneser-Ney by dictionaries."""

    def __init__(self, texts, order):
        self.order = order
        self.raw = [Counter() for _ in range(order + 1)]
        for t in texts:
            s = [255] * (order - 1) + list(t.encode()) + [254]
            for i in range(order - 1, len(s)):
                for k in range(1, order + 1):
                    self.raw[k][tuple(s[i - k + 1:i + 1])] += 1
        self.a = [None] * (order + 1)
        self.a[order] = self.raw[order]
        for k in range(order - 1, 0, -1):
            before = defaultdict(set)
            for g in self.raw[k + 1]:
                before[g[1:]].add(g[0])
            self.a[k] = {g: self.raw[k][g] if g[0] == 255 else len(before[g]) for g in self.raw[k]}
        self.d = [None]
        for k in range(1, order + 1):
            n = [sum(v == i for v in self.a[k].values()) for i in (1, 2, 3, 4)]
            if all(n):
                y = n[0] / (n[0] + 2 * n[1])
                self.d.append([0.0, *(min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05 * i), float(i)) for i in (1, 2, 3))])
            else:
                self.d.append([0.0, 0.5, 1.0, 1.5])
        self.context = [None] + [defaultdict(list) for _ in range(order)]
        for k in range(1, order + 1):
            for g, v in self.a[k].items():
                self.context[k][g[:-1]].append(v)

    def p(self, g):
        if not g:
            return 1 / 258
        k = len(g)
        below = self.p(g[1:])
        seen = self.context[k].get(g[:-1])
        if not seen:
            return below
        own = self.a[k].get(g, 0)
        return (own - self.d[k][min(own, 3)] + sum(self.d[k][min(v, 3)] for v in seen) * below) / sum(seen)

    def loss(self, text):
        s = [255] * (self.order - 1) + list((text or "").encode()) + [254]
        return -sum(math.log(self.p(tuple(s[i - self.order + 1:i + 1]))) for i in range(self.order - 1, len(s)))


TRUSTED = ["the cat sat on the mat", "the dog sat on a log", "a cat and a dog", "été à la mer", "the the the"]
OTHERS = ["the cat", "zzz ### qqq", "", None, "a log on the sea"]


@pytest.mark.parametrize("order", [2, 4])
def test_losses_equal_brute_force(spark, order, monkeypatch):
    monkeypatch.setattr(perplexity, "SHARD", 60)  # several shards
    rows = [(k, t, "en") for k, t in enumerate(TRUSTED + OTHERS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = labels(spark, [(k, 1, 0) for k in range(len(TRUSTED))] + [(0, 1, 1), (len(TRUSTED), None, 0), (len(TRUSTED) + 1, 0, 0)])
    model = BruteKneserNey(TRUSTED, order)
    got = {r["doc_id"]: r for r in perplexity.with_losses(docs, marks, order).collect()}
    for k, t, _ in rows:
        assert got[k]["grams"] == len((t or "").encode()) + 1
        assert got[k]["loss"] == pytest.approx(model.loss(t), rel=1e-5)
        assert got[k]["trusted"] == (k < len(TRUSTED))
    everything = [*range(254), 254]
    for context in ((255,) * (order - 1), tuple(b"e cat"[-(order - 1):]), tuple(b"zqzq"[:order - 1])):
        assert sum(model.p((*context, x)) for x in everything) <= 1 + 1e-9


def test_quality_edge_cases(spark):
    docs = edge_documents(spark)
    got = perplexity.judge(docs, labels(spark, [(k, 1, None) for k in range(14)])).collect()
    assert len(got) == docs.count() and all(r["kept"] is not None for r in got)
    assert all(r["kept"] for r in perplexity.judge(docs, labels(spark, [])).collect())  # nothing is trusted
    assert perplexity.judge(empty_documents(spark), labels(spark, [])).count() == 0


def test_quality_accuracy(spark):
    got = {r["doc_id"]: r["kept"] for r in registry.op5_quality_classifier(spark, SF).collect()}
    known = spark.read.parquet(f"{SF}/labels.parquet").collect()
    good, bad = ([got[r["doc_id"]] for r in known if r["quality"] == q] for q in (1, 0))
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.2


def test_thresholds_hold_for_documents_the_model_has_not_seen(spark):
    # a large language, and a small one of harder texts; a quarter of each is clean but not trusted
    def hard(k):
        rnd = np.random.default_rng(k)
        return " ".join("".join(rnd.choice(list("qwxyzjkéèüöß"), rnd.integers(2, 9))) for _ in range(60))

    rows = [(k, prose(k, 60), "en") for k in range(400)] + [(1000 + k, hard(k), "xx") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in perplexity.judge(docs, labels(spark, [(k, 1, 0) for k, _, _ in rows if k % 4])).collect()}
    for lang in ("en", "xx"):
        assert np.mean([got[k]["kept"] for k, _, x in rows if x == lang and k % 4 == 0]) >= 0.9


# --- operator 9 -----------------------------------------------------------------

def vectors_of(rows, weights):
    """Brute force: unit vectors as dicts, from texts' term counts and words."""
    out = []
    for counts, words in rows:
        v = {t: (1 + math.log(min(c, 255))) * weights[t] for t, c in counts.items() if t in weights}
        if v:
            v[None] = toxicity.LENGTH_WEIGHT * (1 + math.log(max(words, 1)))
            norm = math.sqrt(sum(x * x for x in v.values()))
            v = {t: x / norm for t, x in v.items()}
        out.append(v)
    return out


def cosine_of(a, b):
    """None where they share the length only."""
    both = a.keys() & b.keys()
    return sum(a[t] * b[t] for t in both) if both - {None} else None


def test_nearest_equals_exhaustive_search():
    rng = np.random.default_rng(1)
    n, terms = 700, 300
    weight = rng.uniform(0.5, 3, terms)
    often = np.append(np.full(20, 0.03), np.full(280, 0.4 / 280))  # frequent terms and others
    rows = [({int(t): int(rng.integers(1, 400) if i % 50 == 0 else rng.integers(1, 4)) for t in rng.choice(terms, rng.integers(1, 25), replace=False, p=often)}, int(rng.integers(1, 500))) for i in range(n)]
    rows[5] = rows[6] = rows[7]  # ties
    row = np.cumsum([0, *(len(c) for c, _ in rows)])
    term, tf = (np.concatenate([np.array(list(x(c)), np.int64) for c, _ in rows]) for x in (dict.keys, dict.values))
    model = toxicity.Model.of(np.arange(terms), weight, row, term.astype(np.int32), np.minimum(tf, 255).astype(np.uint8), np.array([w for _, w in rows]), np.arange(n), rng.integers(0, 2, n), 0.2, 0.1, 15)
    index = toxicity.Index(model)
    assert index.block_max.shape[1] == 11 and index.block_max.shape[0] >= 20  # blocks and frequent terms
    at = {d: p for p, d in enumerate(model.ids.tolist())}
    vectors = vectors_of(rows, dict(enumerate(weight)))
    for i in range(0, n, 9):
        want = sorted((x for j in range(n) if j != i and (x := cosine_of(vectors[i], vectors[j])) is not None), reverse=True)[:15]
        own = np.array(list(rows[i][0])), np.minimum(list(rows[i][0].values()), 255)
        place, got = index.nearest(*index.vector(*own, rows[i][1]), skip=at[i])
        assert np.allclose(got, want, atol=1e-5)
        assert np.allclose([cosine_of(vectors[i], vectors[model.ids[p]]) for p in place], got, atol=1e-5)


def test_many_texts_at_a_time_equal_exhaustive_search(monkeypatch):
    monkeypatch.setattr(toxicity, "GROUP", 200)  # four groups
    monkeypatch.setattr(toxicity, "TEXTS", 100)
    monkeypatch.setattr(toxicity, "AHEAD", 3)
    rng = np.random.default_rng(2)
    n, terms = 900, 360
    # three "languages" of 120 terms, each with frequent ones, and texts of one term, which every group holds
    often = np.append(np.full(15, 0.04), np.full(105, 0.4 / 105))
    rows = [({int(t) + 120 * (i % 3): int(rng.integers(1, 400) if i % 50 == 0 else rng.integers(1, 4)) for t in rng.choice(120, rng.integers(1, 25), replace=False, p=often)}, int(rng.integers(1, 500))) for i in range(n)]
    rows[5] = rows[500] = rows[7]  # ties
    row = np.cumsum([0, *(len(c) for c, _ in rows)])
    term, tf = (np.concatenate([np.array(list(x(c)), np.int64) for c, _ in rows]) for x in (dict.keys, dict.values))
    weight = rng.uniform(0.5, 3, terms)
    model = toxicity.Model.of(np.arange(terms), weight, row, term.astype(np.int32), np.minimum(tf, 255).astype(np.uint8), np.array([w for _, w in rows]), np.arange(n), rng.integers(0, 2, n), 0.2, 0.1, 15)
    index = toxicity.Index(model)
    assert sorted(model.ids) == list(range(n)) and len(model.edge) > 2  # groups
    assert any((index.slot[:, t] >= 0).any() and (index.slot[:, t] < 0).any() for t in range(terms))  # frequent in some groups only
    at = {d: p for p, d in enumerate(model.ids.tolist())}
    vectors = vectors_of(rows, dict(enumerate(weight)))
    asked = [*range(0, n, 5), 7]
    got = index.nearest_of([(*index.vector(np.array(list(rows[i][0])), np.minimum(list(rows[i][0].values()), 255), rows[i][1]), at[i]) for i in asked])
    for i, (place, cosine) in zip(asked, got, strict=True):
        want = sorted((x for j in range(n) if j != i and (x := cosine_of(vectors[i], vectors[j])) is not None), reverse=True)[:15]
        assert np.allclose(cosine, want, atol=1e-5)
        assert np.allclose([cosine_of(vectors[i], vectors[model.ids[p]]) for p in place], cosine, atol=1e-5)
    ties = got[asked.index(5)][0][:2]
    assert model.ids[ties].tolist() == [7, 500] and (np.diff(ties) > 0).all()  # equal examples by place
    assert index.nearest_of([]) == []


def test_terms_are_counted_like_a_regular_expression():
    texts = ["Word, word. word", "x1y_z it's\u00a0\u00c9t\u00e9 \u00b2\u0663 \u039f\u03a3 \u039f\u03a3.", "", None, "aaaa " * 300 + "aaaa-aaaa", "internationally internationale"]
    for keys in (None, np.sort(toxicity.hashes_of(["word", "it", "aaaa", "inter*", "interna*", "internationally"]))):
        for limit in (300_000, 2):
            edge, term, tf, words = (counter := toxicity.Terms(keys, limit)).count(texts)
            edge, term, tf, words = counter.count(texts)  # from what it keeps
            for i, text in enumerate(texts):
                found = re.findall(r"[^\W\d_]+", (text or "").lower())
                want = Counter(int(h) for w in found for h in toxicity.hashes_of(toxicity.terms_of(w)) if keys is None or h in keys)
                own = term[edge[i]:edge[i + 1]]
                own = own.tolist() if keys is None else keys[own].tolist()
                assert dict(zip(own, tf[edge[i]:edge[i + 1]].tolist(), strict=True)) == {h: min(c, 255) for h, c in want.items()} and words[i] == len(found)


def test_texts_are_counted_once(spark):
    rows = [(k, prose(k, 30) + (" vile" if k % 2 else ""), k % 7, k % 2) for k in range(200)] + [(None, None, 1, 0), (300, "", 2, 0), (300, "", 3, 0)]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, other int")
    marks = labels(spark, [(r[0], 1, r[3]) for r in rows[:150]])
    fitted = toxicity.fit(docs, marks)
    again = docs.select("doc_id", "text", "other")  # counted anew, as it is another table
    a, b = (sorted((tuple(r[:5]) for r in toxicity.score(d, fitted).collect()), key=str) for d in (docs, again))
    assert a == b and len(a) == len(rows) and toxicity.score(docs, fitted).columns == ["doc_id", "text", "other", "score", "predicted", "evidence"]
    lean = toxicity.fit(docs, marks, carried=["doc_id"])
    assert "text" not in lean.counts.columns  # stored terms, no text
    assert sorted(((r[0], *r[1:3]) for r in toxicity.score(docs, lean).collect()), key=str) == sorted(((r[0], *r[3:5]) for r in a), key=str)


def test_scores_equal_brute_force(spark):
    """The whole operator on the small tables, with its own terms, statistics,
    weights, neighbours, votes and calibration in plain Python."""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    marks = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    train = [d for d in marks if zlib.crc32(str(d).encode()) % 5]

    def counted(text):
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        return Counter(t for w in words for t in {w, *(w[:k] + "*" for k in (5, 7) if len(w) > k)}), len(words)

    rows = {d: counted(t) for d, t in docs.items()}
    n, p = len(train), sum(marks[d] for d in train) / len(train)
    held, toxic, df = Counter(), Counter(), Counter()
    for d in train:
        held.update(rows[d][0].keys())
        toxic.update(rows[d][0].keys() if marks[d] else ())
    for c, _ in rows.values():
        df.update(c.keys() & held.keys())

    def separates(t):
        chi2 = max(abs(toxic[t] - held[t] * p) - 0.5, 0) ** 2 / (held[t] * p * (1 - p))
        return min(max(chi2 * held[t] / (held[t] + 5) / 25, 0.05), 1)

    weights = {t: (math.log((len(docs) + 1) / (df[t] + 1)) + 1e-6) * separates(t) for t in held}
    vectors = dict(zip(rows, vectors_of(rows.values(), weights), strict=True))
    bare = [marks[d] for d in train if not rows[d][0]]

    def votes(d, skip):
        near = sorted(((x, e) for e in train if e != skip and vectors[e] and (x := cosine_of(vectors[d], vectors[e])) is not None), reverse=True)[:15]
        w = [1 / (1.05 - min(x, 1)) for x, _ in near]
        return (sum(a * marks[e] for a, (_, e) in zip(w, near, strict=True)) + p) / (sum(w) + 1) if near else None

    out = [(votes(d, d), marks[d]) for d in train if vectors[d]]
    knots, share = toxicity.isotonic(np.array([x if x is not None else p for x, _ in out]), np.array([float(y) for _, y in out]))
    got = {r["doc_id"]: r["score"] for r in registry.op9_toxicity(spark, SF).collect()}
    off = []
    for d in docs:
        v = votes(d, None) if vectors[d] else None
        want = (sum(bare) + p) / (len(bare) + 1) if v is None else min(1, max(0, 0.98 * float(np.interp(v, knots, share)) + 0.02 * v))
        off.append(abs(got[d] - want))
    assert np.mean(np.array(off) > 1e-3) < 0.02  # ties of equal texts may be broken otherwise


def test_isotonic_rises_and_fits():
    x = np.array([0.1, 0.2, 0.2, 0.3, 0.9])
    at, share = toxicity.isotonic(x, np.array([0, 1.0, 0, 0, 1]))
    assert (np.diff(share) >= 0).all() and (np.diff(at) > 0).all()


def test_toxicity_edge_cases(spark):
    docs = edge_documents(spark)
    for marks in ([], [(1, 1, 0)], [(None, 1, 1), (3, 0, None), (5, 1, 1), (5, 1, 0), (6, 0, 0)]):
        got = toxicity.score(docs, toxicity.fit(docs, labels(spark, marks))).collect()
        assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert toxicity.score(empty_documents(spark), toxicity.fit(empty_documents(spark), labels(spark, []))).count() == 0


def test_labels_of_the_held_out_fold_are_never_learnt(spark):
    rows = [(k, prose(k, 30) + (" vile" if k % 2 else ""), k % 2) for k in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    out = {k for k in range(300) if zlib.crc32(str(k).encode()) % 5 == 0}
    flipped = [(k, 1, 1 - t if k in out else t) for k, _, t in rows]
    a, b = ({r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels(spark, m))).collect()} for m in ([(k, 1, t) for k, _, t in rows], flipped))
    assert a == b and np.mean([(a[k] >= 0.5) == rows[k][2] for k in out]) > 0.95


def test_toxicity_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in registry.op9_toxicity(spark, sf).collect()}
    known = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r["doc_id"]]["held_out"]]
    hit = np.mean([got[r["doc_id"]]["predicted"] for r in known if r["toxic"]])
    false = np.mean([got[r["doc_id"]]["predicted"] for r in known if not r["toxic"]])
    assert hit > 0.8 and false < 0.01


def test_toxic_texts_with_rare_words_are_found(spark):
    # 40 kinds of toxic texts with words of their own, each 0.2 % of all rows
    rows = [(k, prose(k, 40), 0) for k in range(1600)]
    rows += [(2000 + 4 * g + c, f"{prose(90_000 + g, 12)} zq{chr(97 + g // 8)}{chr(97 + g % 8)}xv kw{chr(97 + g // 8)}{chr(97 + g % 8)}yj {prose(90_000 + g, 20)}", 1) for g in range(40) for c in range(4)]
    learnt = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    toxic = [r for r in learnt if r[2]]
    copies = [(10_000 + k, r[1]) for k, r in enumerate(toxic)]
    docs = spark.createDataFrame([*(r[:2] for r in rows), *copies], "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.score(docs, toxicity.fit(docs, labels(spark, [(k, 1, t) for k, _, t in rows]))).collect()}
    assert all(got[k]["predicted"] == 1 and got[k]["evidence"][0]["similarity"] > 0.999 for k, _ in copies)
    assert np.mean([got[k]["predicted"] for k, _, t in rows if not t]) < 0.01
