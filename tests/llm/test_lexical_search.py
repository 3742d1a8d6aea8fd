from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from compare import compare
from regulus.llm import lexical_search
from regulus.llm.lexical_search import BETWEEN, Vocabulary, bags, search, terms_of
from regulus.llm.queries import ORACLES, QUERIES
from regulus.llm.words import Words

TERM = re.compile(f"[^{BETWEEN}]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=50):
    bag = [(i, Counter(terms(t))) for i, t in docs]
    bag = [(i, b) for i, b in bag if b]
    n, total = len(bag), sum(sum(b.values()) for _, b in bag)
    df = Counter(t for _, b in bag for t in b)
    out = []
    for item, text in items:
        scored = []
        for i, b in bag:
            m = 100 - 50 + 50 * sum(b.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * b[t] // (1000 * b[t] + 20 * m)) for t in set(terms(text)) if t in b)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_against_sql(spark, duck, sf_dir):
    assert compare(QUERIES["op13_lexical_search"](spark, sf_dir), duck, ORACLES["op13_lexical_search"]) is None


def test_terms():
    texts = ["Ab-cÄÖ 1x\x00y\x7fz é_e", None, "", "...", "ÀB" * 3, "x"]
    got = [[w.data[a:b].tobytes().decode() for a, b in zip(w.starts[w.bounds[i]:w.bounds[i + 1]], w.ends[w.bounds[i]:w.bounds[i + 1]])]
           for w in terms_of(pa.array(texts)) for i in range(len(w.bounds) - 1)]
    assert got == [terms(t) for t in texts]


@pytest.fixture(scope="module")
def corpus():
    random = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)] + ["Éa", "the", "The"]
    docs = [(i, " ".join(random.choice(words, random.integers(1, 25)))) for i in range(400)]
    docs += [(1000 + 3 * i, "the w1 w2 w2.") for i in range(80)] + [(900 - i, "w2 W1, w2 THE") for i in range(70)]
    docs += [(None, None), (2000, ""), (2001, "?!"), (5, "the w1 w2 w2"), (None, "the w1 w2 w2"), (2002, "nothing known"), (2003, "w3 " * 30_000)]
    items = [(i, " ".join(random.choice(words, 6))) for i in range(30)] + [(40, None), (41, ""), (42, "unseen"), (43, "w1 w2 the"), (43, "w1 w2 the"), (None, "w5 w6")]
    return docs, items


@pytest.mark.parametrize("many", [200_000, 60])
def test_against_brute_force(spark, corpus, many):
    """Copies in great number, ties, nulls, repeated items; in one pass and in several."""
    docs, items = corpus
    d = spark.createDataFrame([(i, t, "s", 1) for i, t in docs], "doc_id long, text string, terms string, item int").repartition(5)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    assert rows(search(d, q, terms=many)) == brute(docs, items)


def test_equal_bags_are_scored_once(spark, corpus, monkeypatch):
    docs, items = corpus
    scored = []
    monkeypatch.setattr(lexical_search, "ranked_classes", lambda classes, *a: scored.append(classes.count()) or original(classes, *a))
    search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items[:30], "item_id long, text string"))
    assert 380 < scored[0] < 410  # 400 texts of their own and 152 copies of one bag


original = lexical_search.ranked_classes


def test_empty_tables(spark, corpus):
    docs, items = corpus
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert search(d.limit(0), q).collect() == [] and search(d, q.limit(0)).collect() == []


def test_terms_of_equal_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(Words, "hashes", lambda self: (self.ends - self.starts).astype(np.uint64))
    vocabulary = Vocabulary([b"ab", b"cd", b"xyz"])
    for words in terms_of(pa.array(["cd ab ef xyz xyy"])):
        assert vocabulary.numbers(words).tolist() == [1, 0, -1, 2, -1]


def test_counts_of_tasks_add_up(spark, corpus):
    docs, _ = corpus
    told = bags(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), [b"the", b"w1"])
    own = [r for r in told.collect() if r.is_count]
    df = Counter()
    for r in own:
        df.update(dict(zip(r.terms, r.counts)))
    assert len(own) == 4 and df == {k: sum(t in terms(x) for _, x in docs) for k, t in enumerate(["the", "w1"])}
