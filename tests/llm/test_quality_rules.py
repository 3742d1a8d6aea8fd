from __future__ import annotations

import re

import pytest

from regulus.llm.quality_rules import quality

SPACE = "[\x20\x09-\x0d]+"


def brute(text):
    text = text or ""
    words = [w for w in re.split(SPACE, text) if w]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


TEXTS = [None, "", " ", "\n\n", "a", "a b", "a b c", "a a a", "a a a a", "x y z x y z q", "un mot 　deux", "a\x0bb\x0cc\rd\te\nf",
         "l1 w\nl1 w\n\n \nl1 w\r\nl2", "#*$%&|<> ## é😀", "the of and " * 40, " ".join(f"w{i} the" for i in range(60)),
         " ".join(f"w{i % 977}" for i in range(6000)), "é" * 5000]


def test_measures_against_brute_force(spark):
    rows = [(i % 7 if i % 5 else None, t, "x", 1) for i, t in enumerate(TEXTS + TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int")
    got = quality(df).select("doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert sorted((repr(r[0]), repr(r[1])) for r in got) == sorted((repr(a), repr(b)) for a, b, _, _ in rows)
    for r in got:
        want = brute(r.text)
        assert tuple(r)[2:7] == want, r.text and r.text[:50]
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_verdicts(spark):
    clean = " ".join(f"word{i} of" for i in range(40))
    texts = [clean, " | ".join(f"word{i}" for i in range(60)), " ".join(f"wort{i}" for i in range(80)), "\n".join(["same line of the text"] * 3 + [clean])]
    got = [r.kept for r in quality(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)).collect()]
    assert got == [True, False, False, True]


def test_empty_table_and_plan(spark):
    df = spark.createDataFrame([], "doc_id long, text string, __other string")
    out = quality(df)
    assert out.collect() == [] and "__other" in out.columns
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("name", ["op9_quality_rules"])
def test_query_against_sql(spark, duck, sf_dir, name):
    from compare import compare

    from regulus.llm.queries import ORACLES, QUERIES
    assert compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None
