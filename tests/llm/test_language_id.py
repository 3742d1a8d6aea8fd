from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest

from regulus.llm import language_id
from regulus.llm.language_id import BUCKETS, LENGTHS, Model, codebook, distance_of, features, identify, train
from regulus.llm.queries import QUERIES

SYLLABLES = {"aa": "ba ke lo mi nu".split(), "bb": "tra skö pfü ungen ßig".split(), "cc": "ção eau ñez oir ux".split(), "dd": "да не что ова мир".split()}


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def texts(n, seed=1):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        lang = draw.choice(list(SYLLABLES))
        words = ["".join(draw.choices(SYLLABLES[lang], k=draw.randint(1, 3))) for _ in range(draw.randint(1, 40))]
        out.append((i, " ".join(words).capitalize() + draw.choice([".", " 12!", ""]), lang))
    return out


@pytest.fixture(scope="module")
def corpus(spark):
    rows = texts(600) + [(600, None, "aa"), (601, "", "bb"), (602, "12 + 3", "cc"), (603, "bake lomi", None), (None, "trasköpfü", "aa"), (604, "77", "only digits")]
    rows += rows[:20]
    schema = "doc_id long, text string, lang string, score double, second int"
    return rows, spark.createDataFrame([(*r, 0.5, 1) for r in rows], schema).cache()


def buckets(text):
    """The definition of the features, in plain integers."""
    chars = [ord(c) if c.isalpha() else 32 for c in f" {text.lower()} "]
    if all(c == 32 for c in chars):
        return None
    out = set()
    for n in LENGTHS:
        for i in range(len(chars) - n + 1):
            h = 0
            for c in chars[i:i + n]:
                h = (h * 0x9E3779B1 + c) & 0xFFFFFFFF
            out.add((((h ^ (h >> 15)) * 0x2C1B3C6D) & 0xFFFFFFFF) >> 16)
    return out


def brute(rows):
    """Counts, weights, margins and decoding in plain Python."""
    learnt = [(buckets(t), lang) for i, t, lang in rows if None not in (i, t, lang) and not is_held_out(i)]
    learnt = [(b, lang) for b, lang in learnt if b]
    names = sorted({lang for _, lang in learnt})
    code = codebook(len(names)).tolist()
    bits = range(len(code[0]))
    n = [sum(lang == x for _, lang in learnt) for x in names]
    df = {}
    for b, lang in learnt:
        for g in b:
            df.setdefault(g, [0] * len(names))[names.index(lang)] += 1
    weight = {}
    for g, own in df.items():
        if sum(own) >= 2:
            side = lambda k, one: [(own[j] + 0.5) / n[j] for j in range(len(names)) if code[j][k] == one]
            weight[g] = [math.log(sum(side(k, 1)) / len(side(k, 1))) - math.log(sum(side(k, 0)) / len(side(k, 0))) for k in bits]
    raw = lambda b: [sum(weight.get(g, [0] * len(bits))[k] for g in b) / math.sqrt(len(b)) for k in bits]
    by_lang = [[raw(b) for b, lang in learnt if lang == x] for x in names]
    mean = [[sum(z[k] for z in own) / len(own) for k in bits] for own in by_lang]
    var = [[sum(z[k] ** 2 for z in own) / len(own) - mean[j][k] ** 2 for k in bits] for j, own in enumerate(by_lang)]
    scale, shift = [], []
    for k in bits:
        one, zero = ([mean[j][k] for j in range(len(names)) if code[j][k] == s] for s in (1, 0))
        one, zero = sum(one) / len(one), sum(zero) / len(zero)
        scale.append((one - zero) / (sum(v[k] for v in var) / len(var) + 0.01))
        shift.append(-scale[k] * (one + zero) / 2)
    trust = []
    for j in range(len(names)):
        own = [0.5 * (1 + math.erf((2 * code[j][k] - 1) * (mean[j][k] * scale[k] + shift[k]) / math.sqrt((var[j][k] + 0.01) * scale[k] ** 2) / math.sqrt(2))) + 1e-3 for k in bits]
        trust.append([x / sum(own) for x in own])

    def predict(text):
        b = buckets(text or "")
        if b is None:
            return "und", 0.0
        f = [z * s + t for z, s, t in zip(raw(b), scale, shift)]
        loss = [sum(trust[j][k] * np.logaddexp(0, -(2 * code[j][k] - 1) * f[k]) for k in bits) * len(bits) for j in range(len(names))]
        share = [math.exp(min(loss) - x) for x in loss]
        best = min(range(len(names)), key=lambda j: (loss[j], j))
        return names[best], share[best] / sum(share)

    return predict


def test_against_brute_force(spark, corpus):
    rows, docs = corpus
    predict = brute(rows)
    got = identify(docs, train(docs)).collect()
    assert len(got) == len(rows)
    for r in got:
        lang, score = predict(r.text)
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=2e-3)


def test_held_out_accuracy_and_labels(spark, corpus):
    rows, docs = corpus
    model = train(docs)
    got = identify(docs, model).where("lang is not null and text rlike '[a-zа-я]'").collect()
    own = [r for r in got if r.doc_id is not None and is_held_out(r.doc_id)]
    assert len(own) > 80 and sum(r.lang == r.lang_pred for r in own) / len(own) > 0.97
    assert model.languages == ["aa", "bb", "cc", "dd"]
    other = docs.selectExpr("doc_id", "text", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 'aa', lang) as lang")
    again = train(other.repartition(7))
    assert np.array_equal(model.weights, again.weights) and np.array_equal(model.scale, again.scale) and np.array_equal(model.trust, again.trust)


def test_wrong_bits_are_corrected():
    """A codeword with as many wrong bits as the code corrects is still the nearest, one midway is ambiguous."""
    languages = [f"l{i:02}" for i in range(12)]
    code = codebook(12)
    apart = distance_of(code)
    corrects = (apart - 1) // 2
    assert apart >= 20 and all(0 < c.sum() < 12 for c in code.T)
    bits = code.shape[1]
    for i in range(12):
        wrong = np.random.default_rng(i).permutation(bits)[:corrects]
        signs = 2.0 * code[i] - 1
        signs[wrong] *= -1
        model = Model(languages, code, np.array([signs]), np.ones(bits), np.zeros(bits), np.full((12, bits), 1 / bits), corrects)
        lang, score, second, ambiguous = model.decode(np.array([0]))
        assert lang == languages[i] and not ambiguous and 0 < score <= 1
    half = 2.0 * code[0] - 1
    differ = np.flatnonzero(code[0] != code[1])
    half[differ[:len(differ) // 2]] *= -1
    if len(differ) % 2:
        half[differ[-1]] = 0
    lang, score, second, ambiguous = Model(languages, code, np.array([half]), np.ones(bits), np.zeros(bits), np.full((12, bits), 1 / bits), corrects).decode(np.array([0]))
    assert ambiguous and {lang, second} <= set(languages)


@pytest.mark.parametrize("n", range(2, 9))
def test_codebooks(n):
    code = codebook(n)
    assert len({tuple(c) for c in code}) == n and all(0 < c.sum() < n for c in code.T)
    assert n > 6 or distance_of(code) == 2 ** (n - 2)


def test_features_of_long_texts(monkeypatch):
    seen = np.zeros(BUCKETS, dtype=bool)
    text = " ".join(t for _, t, _ in texts(50))
    whole = features(text, seen).tolist()
    monkeypatch.setattr(language_id, "_PIECE", 37)
    assert features(text, seen).tolist() == whole == sorted(buckets(text)) and not seen.any()
    assert features("a\ud800", seen) is not None and features("1 ²", seen) is None and features(None, seen) is None


def test_few_languages_and_empty_tables(spark, corpus):
    _, docs = corpus
    none, one, two = train(docs.limit(0)), train(docs.where("lang = 'bb'")), train(docs.where("lang in ('bb', 'only digits', 'dd')"))
    assert {r.lang_pred for r in identify(docs, none).collect()} == {"und"}
    got = {(r.lang_pred, r.score) for r in identify(docs, one).collect()}
    assert got == {("und", 0.0), ("bb", 1.0)} and two.languages == ["bb", "dd"]
    assert {r.lang_pred for r in identify(docs, two).collect()} == {"und", "bb", "dd"}
    assert identify(docs.limit(0), two).collect() == []
    with pytest.raises(ValueError, match="second"):
        identify(docs, two, text="second")


def test_query(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op12_language_id"](spark, sf_dir).collect()
    assert len(got) == len(docs) and all(r.held_out == is_held_out(r.doc_id) and 0 <= r.score <= 1 for r in got)
    own = [r for r in got if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in own) / len(own) > 0.9
