from __future__ import annotations

import random
import re

import numpy as np
import pytest

from regulus.llm.components import components
from regulus.llm.jaccard_join import SIMILARITY, _candidates, _signed, banding_for, similar
from regulus.llm.queries import QUERIES


def grams(text, n=5):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())


def brute(rows):
    """(doc_id, class_id, n_links) of rows (doc_id, text)."""
    sets = [grams(t) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_gram = {}
    for i, s in enumerate(sets):
        partners = {j for g in s for j in by_gram.get(g, ())}
        for j in partners:
            both = len(s & sets[j])
            if 5 * both >= 4 * (len(s) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
        for g in s:
            by_gram.setdefault(g, []).append(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted((str(rows[i][0]), str(least.get(root(i))), links[i]) for i in range(len(rows)))


def seen(df):
    return sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in df.collect())


def test_query_against_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert seen(QUERIES["op7_ngram_jaccard_join"](spark, sf_dir)) == brute(rows)


@pytest.fixture(scope="module")
def family():
    """A large family of near copies, small ones, exact copies, empty and tiny texts, repeated rows."""
    draw = random.Random(9)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    rows, n = [], 0
    for size, length, edits in ((60, 120, 5), (7, 40, 1), (5, 300, 6), (3, 8, 1)):
        base = [word() for _ in range(length)]
        for _ in range(size):
            words = list(base)
            for _ in range(draw.randint(0, edits)):
                words[draw.randrange(length)] = word()
            rows.append((n, " ".join(words)))
            n += 1
    rows += [(500, rows[0][1]), (501, rows[0][1].replace(" ", "\n\t")), (None, rows[3][1]), (4, rows[4][1]), (600, None), (601, ""), (602, " \n"), (603, "one two"), (604, "two one"),
             (605, "one two"), (None, None), (606, "a " * 4000), (607, "a " * 5)]
    return rows


@pytest.mark.parametrize("block", [256, 9])
def test_families_in_blocks(spark, family, block):
    df = spark.createDataFrame([(*r, 1, b"x") for r in family], "doc_id long, text string, n int, bands binary").repartition(3)
    assert seen(similar(df, block=block)) == brute(family)


def test_buckets_in_blocks_and_refused_names(spark, family):
    banding = banding_for(0.8)
    df = spark.createDataFrame(family, "doc_id long, text string")
    sets = _signed(df, "text", ("doc_id",), 5, banding).where("set_id is not null").dropDuplicates(["set_id"]).cache()
    whole, cut = (sorted((bytes(r.node), bytes(r.root)) for r in _candidates(sets, banding, SIMILARITY, block).collect()) for block in (2048, 7))
    assert whole == cut and len(whole) > 50
    for name in ("class_id", "Minima", "text"):
        with pytest.raises(ValueError):
            similar(df, carry=(name,))


def test_texts_a_little_alike_form_no_groups(spark):
    """A chain of texts, each of similarity 0.4 to the next: many share a band, none is a candidate."""
    draw = random.Random(2)
    words = ["".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(9000)]
    rows = [(i, " ".join(words[43 * i:43 * i + 104])) for i in range(200)]
    banding = banding_for(0.8)
    sets = _signed(spark.createDataFrame(rows, "doc_id long, text string"), "text", ("doc_id",), 5, banding).cache()
    bands = [np.frombuffer(r.bands, dtype=np.int64) for r in sets.orderBy("doc_id").collect()]
    assert sum((a == b).any() for a, b in zip(bands, bands[1:])) > 10
    assert _candidates(sets, banding, SIMILARITY).collect() == []
    assert all(r.n_links == 0 and r.class_id == r.doc_id for r in similar(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_recall_and_components(spark):
    assert banding_for(0.8).recall(0.8) >= 0.99999 and banding_for(0.8).bands < 60 and 140 < banding_for(0.8).least_agreeing(0.8) < 155
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7), (None, 3), (200, 201), (201, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100, 200: 200, 201: 200}


def test_empty_table(spark):
    assert similar(spark.createDataFrame([], "doc_id long, text string")).collect() == []
