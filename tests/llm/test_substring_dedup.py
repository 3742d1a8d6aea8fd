from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from compare import compare
from regulus.llm.fm_index import FMIndex, repeated_stretches, suffix_array
from regulus.llm.queries import ORACLES, QUERIES
from regulus.llm.substring_dedup import without_repeats


def brute(rows, window):
    """(doc_id, n_words, n_removed, kept) of rows (doc_id, text)."""
    words = [[w for w in re.split("[\x20\x09-\x0d]+", t or "") if w] for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = {i + k for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for k in range(window)}
        out.append((str(doc_id), len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out)


def test_query_against_sql(spark, duck, sf_dir):
    assert compare(QUERIES["op2_substring_dedup"](spark, sf_dir), duck, ORACLES["op2_substring_dedup"]) is None


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(12)
    word = lambda: "".join(draw.choice("abcé") for _ in range(3))
    passages = [[word() for _ in range(draw.randint(5, 40))] for _ in range(6)]
    rows = []
    for i in range(160):
        words = [word() for _ in range(draw.randint(0, 30))]
        for _ in range(draw.randint(0, 3)):
            own = list(draw.choice(passages))
            if draw.random() < 0.4:
                own[draw.randrange(len(own))] = word()
            words += own + [word() for _ in range(draw.randint(0, 9))]
        rows.append((i if i % 11 else None, draw.choice([" ", "\n", "\t ", " \x0b"]).join(words)))
    rows += [(1, rows[1][1]), (1, rows[1][1]), (900, None), (901, ""), (902, " \n "), (903, "x " * 500), (904, "y"), (905, "ab cd " * 40), (None, None)]
    return rows


@pytest.mark.parametrize("window,gram,shard,hot", [(8, 3, 400_000, 20_000), (8, 3, 500, 20_000), (8, 3, 2000, 3), (6, 6, 1000, 20_000), (1, 1, 1000, 20_000)])
def test_against_brute_force(spark, corpus, window, gram, shard, hot):
    df = spark.createDataFrame([(*r, 1, "k", 0) for r in corpus], "doc_id long, text string, n int, key string, spans int").repartition(4)
    got = without_repeats(df, window=window, gram=gram, shard=shard, hot=hot).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in got) == brute(corpus, window)


@pytest.mark.parametrize("seed", range(25))
def test_matching_statistics(seed):
    random_ = np.random.default_rng(seed)
    window, kinds = int(random_.integers(2, 9)), int(random_.integers(2, 25))
    base = [random_.integers(1, kinds + 1, random_.integers(1, 30)) for _ in range(3)]
    texts = [np.concatenate([[1], base[random_.integers(3)][random_.integers(5):], random_.integers(1, kinds + 1, random_.integers(12)), base[random_.integers(3)]])
             for _ in range(random_.integers(1, 15))]
    symbols = np.concatenate([np.append(t, 0) for t in texts])
    lengths = np.array([len(t) for t in texts])
    ends = np.cumsum(lengths + 1) - 1
    begins = ends - lengths
    index = FMIndex(symbols)
    low, high = index.extend(np.array([1]), np.array([0]), np.array([len(symbols)]))
    assert high[0] - low[0] == (symbols == 1).sum()
    order = suffix_array(symbols).tolist()
    assert sorted(order) == list(range(len(symbols)))
    seen = Counter(tuple(t[i:i + window].tolist()) for t in texts for i in range(len(t) - window + 1))
    got, want = np.zeros(len(symbols), dtype=bool), np.zeros(len(symbols), dtype=bool)
    for _, a, b in repeated_stretches(index, symbols, begins, ends, window, probe=int(random_.integers(1, 5))):
        got[a:b] = True
    for t, b in zip(texts, begins):
        for i in range(len(t) - window + 1):
            want[b + i:b + i + window] |= seen[tuple(t[i:i + window].tolist())] > 1
    assert (got == want).all()


def test_empty_table(spark):
    assert without_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
