from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest

from regulus.llm.queries import QUERIES
from regulus.llm.toxicity import BUCKETS, LENGTHS, THRESHOLD, features, held_out, ratios, sampled, score, train, training_rows


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.fixture(scope="module")
def corpus(spark):
    """Clean words, and toxic texts that hold one of two stems with a random ending."""
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abdeghilmnorstu") for _ in range(draw.randint(2, 8)))
    rows, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        words = [word() for _ in range(draw.randint(5, 60))]
        if toxic:
            for _ in range(2):
                words.insert(draw.randrange(len(words)), draw.choice(["zwyx", "quoff"]) + word())
        rows.append((i, " ".join(words).capitalize() + ".", "s", 0.5))
        labels.append((i, 1, int(toxic)))
    return (spark.createDataFrame(rows, "doc_id long, text string, source string, toxicity double").cache(),
            spark.createDataFrame(labels + [(None, 1, 1), (5000, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int").cache())


def test_held_out_accuracy(spark, corpus):
    docs, labels = corpus
    got = score(docs, train(docs, labels)).select("doc_id", "text", "toxicity", held_out().alias("held_out")).collect()
    assert all(r.held_out == is_held_out(r.doc_id) and 0 <= r.toxicity <= 1 for r in got)
    own = [r for r in got if r.held_out]
    right = [(r.toxicity >= THRESHOLD) == (r.doc_id % 6 == 0) for r in own]
    assert len(own) > 150 and sum(right) / len(right) > 0.95


def test_held_out_labels_are_not_learnt(spark, corpus):
    docs, labels = corpus
    other = labels.selectExpr("doc_id", "quality", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - toxic, toxic) as toxic")
    a, b = train(docs, labels), train(docs, other)
    assert np.array_equal(a.weights, b.weights) and a.intercept == b.intercept


def test_features_are_whole_and_cleared():
    seen = np.zeros(BUCKETS, dtype=bool)
    a = set(features("Ab cd " * 5000 + "zebra", seen))
    assert not seen.any() and set(features("zebra", seen)) < a | set(features("ZEBRA!", seen))
    assert len(features(None, seen)) == len(features("", seen)) and set(features("ab", seen)) == set(features("AB", seen))
    r = ratios(np.array([50, 0, 5]), np.array([0, 400, 40]), 100, 800)
    assert r[0] > 0 and r[2] == 0


def test_every_sure_ratio_counts():
    n = 20_000
    r = ratios(np.full(n, 60), np.full(n, 20), 1000, 4000)
    assert (r > 0).all()


def test_copies_are_sampled_one_by_one(spark):
    docs = spark.range(4000).selectExpr("if(id < 2000, id, 1) as doc_id", "'the same text' as text")
    labels = spark.range(2000).selectExpr("id as doc_id", "cast(id = 1 as int) as toxic")
    rows = training_rows(docs, labels)
    n = rows.where("toxic = 1").count()
    assert n > 1900 and abs(sampled(rows, 0.2, 0.0).count() / n - 0.2) < 0.05


def test_sample_does_not_depend_on_the_split(spark, corpus):
    docs, labels = corpus
    docs = docs.unionByName(docs.limit(50))
    a, b = (train(docs.repartition(n), labels, sample=200) for n in (1, 7))
    assert np.array_equal(a.weights, b.weights) and a.intercept == b.intercept
    assert 0 < sampled(training_rows(docs, labels), 0.3, 0.1).count() < 200


def test_features_are_characters():
    seen = np.zeros(BUCKETS, dtype=bool)
    for text in ("日本語のテキスト", "Füße übel", "a\U0001f600b c", "x"):
        assert set(features(text, seen).tolist()) == buckets_of(text)


def test_nulls_repeated_rows_and_missing_labels(spark, corpus):
    docs, labels = corpus
    odd = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "x" * 200_000)], "doc_id long, text string")
    model = train(docs, labels)
    got = score(odd, model).collect()
    assert len(got) == 4 and got[0].toxicity == got[1].toxicity == got[2].toxicity
    assert score(odd.limit(0), model).collect() == []
    empty = train(docs, labels.limit(0))
    assert all(r.toxicity < 1e-9 for r in score(odd, empty).collect())


def test_query(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    got = QUERIES["op8_toxicity"](spark, sf_dir).collect()
    assert len(got) == n and all(r.held_out == is_held_out(r.doc_id) and r.predicted == (r.score >= 0.3) for r in got)


def buckets_of(text):
    """The definition of the features in plain integers: characters of the lower-cased text, ASCII marks and spaces alike."""
    data = [ord(c) if ord(c) >= 128 or c.isalnum() else 32 for c in f" {(text or '').lower()} "]
    data = [x ^ x >> 16 for x in (c * 0x9E3779B1 & 0xFFFFFFFF for c in data)]
    out = set()
    for n in LENGTHS:
        for i in range(len(data) - n + 1):
            h = 0
            for b in data[i:i + n]:
                h = (h * 0x01000193 + b) & 0xFFFFFFFF
            out.add((((h ^ (h >> 15)) * 0x2C1B3C6D) & 0xFFFFFFFF) >> 14)
    return out


def test_against_brute_force(spark, corpus):
    """Features, counts, ratios, fit and scores again, without any of the operator's own steps."""
    docs, labels = corpus
    texts = {r.doc_id: r.text for r in docs.collect()}
    learnt = [(buckets_of(texts[r.doc_id]), int(r.toxic > 0)) for r in labels.collect()
              if r.doc_id in texts and r.toxic is not None and not is_held_out(r.doc_id)]
    n = [sum(t == k for _, t in learnt) for k in (0, 1)]
    held = {}
    for found, t in learnt:
        for b in found:
            held.setdefault(b, [0, 0])[t] += 1
    ratio, sure = {}, {}
    for b, (other, toxic) in held.items():
        r = math.log((toxic + 1) / (n[1] + 2)) - math.log((other + 1) / (n[0] + 2))
        if toxic + other >= 5:
            ratio[b], sure[b] = r, abs(r) / math.sqrt(1 / (toxic + 1) + 1 / (other + 1))
    ranked = sorted(sure, key=lambda b: (-sure[b], b))
    used = sorted(b for k, b in enumerate(ranked) if sure[b] >= 4 or sure[b] >= 1.5 and k < 1000)
    # the sample of 12,000 rows takes all of these: a dense logistic regression by the same steps
    x = np.array([[ratio[b] if b in found else 0.0 for b in used] for found, _ in learnt])
    y = np.array([t for _, t in learnt], dtype=float)
    w, mean, square = np.zeros(len(used) + 1), np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, 81):
        error = (1 / (1 + np.exp(-(x @ w[:-1] + w[-1]))) - y) / len(y)
        slope = np.append(x.T @ error + 2e-3 * w[:-1], error.sum())
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope ** 2
        w = w - 0.05 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    weight = {b: v * ratio[b] for b, v in zip(used, w[:-1])}
    model = train(docs, labels)
    assert set(np.flatnonzero(model.weights).tolist()) <= set(used) and model.intercept == pytest.approx(w[-1], abs=1e-4)
    for r in score(docs, model).collect():
        z = w[-1] + sum(weight.get(b, 0.0) for b in buckets_of(r.text))
        assert r.toxicity == pytest.approx(1 / (1 + math.exp(-z)), abs=2e-3)
