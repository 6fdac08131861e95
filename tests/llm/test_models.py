import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotemill.llm import decontamination, log_bilinear, multi_index, quality_attention, toxicity
from quotemill.llm.fm_index import FMIndex, suffix_order
from tests.llm.tables import awkward, empty, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("seed", range(5))
def test_fm_index(seed):
    rng = random.Random(seed)
    for _ in range(60):
        s = np.array([rng.randint(0, rng.choice([1, 3, 9])) for _ in range(rng.randint(1, 80))] + [0], np.int32)
        order = suffix_order(s)
        rank = lambda i: [(0, k) if s[k] == 0 else (1, int(s[k])) for k in range(i, len(s))]
        assert order.tolist() == sorted(range(len(s)), key=rank)
        index = FMIndex(s)
        phrases = np.array([[rng.randint(1, 4) for _ in range(3)] for _ in range(12)])
        lengths = np.array([rng.randint(1, 3) for _ in range(12)])
        low, high = index.search(phrases, lengths)
        for phrase, n, a, b in zip(phrases.tolist(), lengths.tolist(), low, high):
            places = [i for i in range(len(s) - n + 1) if s[i : i + n].tolist() == phrase[:n]]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == places


def slow_hits(docs, items):
    windows = {}
    for item, text in items:
        w = WORD.findall(lower(text))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = WORD.findall(lower(text)), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


@pytest.mark.parametrize("block", [500_000, 5])
def test_decontamination(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", block)
    monkeypatch.setattr(decontamination, "SHARD", 200)
    docs = awkward(spark).select("doc_id", "text", F.lit(1).alias("n_words"), F.lit(2).alias("a.b"))
    items = [(1, prose(80, 99)), (20, "One TWO"), (3, None), (4, ""), (5, "!!"), (6, prose(12, 9)), (6, prose(12, 9)), (7, "idiot moron")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = Counter(map(tuple, decontamination.digest(docs, benchmark).collect()))
    assert got == slow_hits(rows, items) and any(r[5] for r in got)
    cleaned = decontamination.remove(docs, benchmark)
    assert cleaned.columns == docs.columns and {r.n_words for r in cleaned.collect()} == {1} and cleaned.count() == docs.count()
    assert decontamination.digest(empty(spark), benchmark).collect() == []
    assert not decontamination.digest(docs, benchmark.limit(0)).where("contaminated").collect()


def labelled(spark, n, bad):
    rows = [(i, prose(40 + i % 50, i) + (bad(i) if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, label int")


@pytest.mark.parametrize("module, bad", [
    (toxicity, lambda i: " you scumbag" + "xyz"[i % 3]),
    (quality_attention, lambda i: " spam" * 120),
])
def test_classifiers_on_held_out_rows(spark, module, bad):
    rows = labelled(spark, 500, bad)
    train, test = rows.where("doc_id % 5 <> 1"), rows.where("doc_id % 5 = 1")
    model = module.fit(rows.drop("label"), train.select("doc_id", "label"))
    scored = module.score(test, model).select("label", "score").collect()
    assert sum((r.score >= 0.5) == r.label for r in scored) / len(scored) > 0.9


@pytest.mark.parametrize("module", [toxicity, quality_attention])
def test_classifiers_of_awkward_rows(spark, module):
    docs = awkward(spark)
    none = spark.createDataFrame([], "doc_id long, label int")
    some = spark.createDataFrame([(0, 1), (2, 0), (3, 0), (None, 1), (5, None), (0, 1), (99, 0)], "doc_id long, label int")
    for labels in (none, some):
        scored = module.score(docs, module.fit(docs, labels))
        assert Counter(scored.columns) == Counter(docs.columns)
        assert all(0 <= r.score <= 1 for r in scored.select("score").collect())
    assert module.score(empty(spark), module.fit(empty(spark), none)).collect() == []


def slow_base(rows, training):
    tokens = [lower(t).encode().split() + [None] for _, t in rows]
    held = Counter(x for (i, _), t in zip(rows, tokens) if training(i) for x in t)
    n, v = sum(held.values()), len(held)
    out = []
    for (i, _), t in zip(rows, tokens):
        base = sum(math.log10((held[x] + 1) / (n + v + 1)) for x in t)
        out.append((i, len(t), sum(held[x] > 0 for x in t), n, round(base, 6)))
    return Counter(out)


@pytest.mark.parametrize("head", [200_000, 7])
def test_language_model(spark, head):
    settings = log_bilinear.Settings(head=head, classes=6, rounds=1)
    docs = awkward(spark)
    scored = log_bilinear.fit_and_score(docs, F.col("doc_id") % 3 != 1, settings).collect()
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    wanted = slow_base(rows, lambda i: i is not None and i % 3 != 1)
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in scored) == wanted
    assert all(r.score < 0 for r in scored)
    nothing = log_bilinear.fit_and_score(docs, F.lit(False), settings).collect()
    assert all(r.n_known == 0 and r.base_score == 0 for r in nothing)
    assert log_bilinear.fit_and_score(empty(spark), F.lit(True), settings).collect() == []


def test_language_model_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(i, prose(60, i)) for i in range(40)], "doc_id long, text string")
    settings = log_bilinear.Settings(classes=20, rounds=1)
    counts = log_bilinear.count_words(docs, settings)
    model = log_bilinear.fit(docs, counts, settings)
    words = [bytes(r.word) for r in counts.table.collect()] + [b"unseen"]
    ended = log_bilinear.score(docs.limit(1).withColumn("text", F.lit("")), counts, model, settings).first().score
    one = spark.createDataFrame([(i, w.decode()) for i, w in enumerate(words)], "doc_id long, text string")
    both = log_bilinear.score(one, counts, model, settings).collect()
    place = {w: i for i, w in enumerate(counts.head)}
    norm = log_bilinear.normalisers(model)
    start, total = len(model.context) - 1, 10**ended
    for r in both:
        at = place.get(words[r.doc_id], -1)
        own = at + 2 if 0 <= at < 20 else log_bilinear.RARE
        expected = model.context[own] * model.mix[0] + model.context[start] * model.mix[1]
        end = expected @ model.target[log_bilinear.END] + model.bias[log_bilinear.END] - norm[own, start]
        total += 10 ** (r.score - end / math.log(10))
    assert abs(total - 1) < 1e-3


def slow_nearest(rows, asked, k):
    good = {}
    for i, v in rows:
        if i is not None and v and len(v) == 4 and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, float)
    cosine = lambda a, b: float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))
    out = []
    for q in asked:
        if q in good:
            ranked = sorted((-cosine(good[q], v), i) for i, v in good.items() if i != q)[:k]
            out += [(q, n + 1, i, round(-s, 9)) for n, (s, i) in enumerate(ranked)]
    return Counter(out)


def test_nearest_of_awkward_vectors(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(200)]
    rows += [(300 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(40)] + [(500, None), (501, [0.0] * 4), (502, [1.0, None, 1.0, 1.0])]
    rows += [(503, [math.nan, 1.0, 1.0, 1.0]), (504, [math.inf, 1.0, 1.0, 1.0]), (505, [1.0]), (None, [1.0] * 4), (7, rows[7][1])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("query_id", F.lit(1))
    asked = vectors.where("vec_id % 10 = 0 OR vec_id >= 500")
    got = multi_index.nearest(vectors, asked).collect()
    wanted = slow_nearest(rows, sorted({i for i, _ in rows if i is not None and (i % 10 == 0 or i >= 500)}), 5)
    assert Counter((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got) == wanted
    few = vectors.where("vec_id < 3")
    assert multi_index.nearest(few, few).count() == 6
    assert multi_index.nearest(vectors.limit(0), vectors).collect() == []


def test_recall_with_few_candidates(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 16))
    data = centres[rng.integers(0, 20, 1500)] + 0.4 * rng.normal(size=(1500, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    settings = multi_index.Settings(candidates=300, share=0.0, block=50)
    got = {(r.query_id, r.vec_id) for r in multi_index.nearest(vectors, vectors.where("vec_id % 50 = 0"), 5, settings).collect()}
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    best = {(q, int(i)) for q in range(0, 1500, 50) for i in [x for x in np.argsort(-(unit @ unit[q])) if x != q][:5]}
    assert len(got & best) / len(best) >= 0.9


def test_traversal_follows_summed_distance():
    rng = np.random.default_rng(1)
    first, second, held = rng.random(6), rng.random(5), rng.integers(0, 3, (6, 5))
    cells = multi_index.traverse(first, second, held, 10**9)
    sums = [first[a] + second[b] for a, b in cells]
    assert sums == sorted(sums) and len(cells) == (held > 0).sum()
