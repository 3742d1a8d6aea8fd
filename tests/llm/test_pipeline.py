"""Every stage against its own input, and the whole against its stages."""
from __future__ import annotations

from collections import Counter

import corpus_pipeline
from corpus_pipeline import STAGES
from regulus.llm.queries import QUERIES
from regulus.llm.secret_scan import BASE_RULES
from regulus.llm.tokens import vocabulary_path

from test_jaccard_join import brute as classes_of
from test_mixing import expected_targets
from test_secret_scan import brute as secrets_of
from test_tokens import check_packing

ROWS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_on_documents(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, None
    for i, (name, stage) in enumerate(STAGES):
        source = docs.collect()
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        assert docs.columns == columns or i == len(STAGES) - 1
        rows = docs.collect()
        if name == "toxicity":
            bad = {r.doc_id for r in QUERIES["op8_toxicity"](spark, sf_dir).collect() if r.predicted}
            assert bad and sorted(rows) == sorted(r for r in source if r.doc_id not in bad)
        elif name == "n-gram Jaccard join":
            classes = classes_of([(r.doc_id, r.text) for r in source])
            assert sorted(str(r.doc_id) for r in rows) == sorted({c for _, c, _ in classes}) and set(rows) <= set(source)
        elif name == "secret scans":
            by_id = {r.doc_id: r for r in source}
            assert len(rows) == len(source)
            for r in rows:
                assert r.n_chars == len(r.text) and not secrets_of(r.text)
                assert (r.text == by_id[r.doc_id].text) == ("[" not in r.text) or "[" in by_id[r.doc_id].text
        elif name.startswith("mixing"):
            sizes, taken, most = Counter(), Counter(), Counter()
            for r in source:
                sizes[r.source] += len(r.text.split())
                most[r.source] = max(most[r.source], len(r.text.split()))
            for r in rows:
                taken[r.source] += len(r.text.split())
            assert max(Counter(r.doc_id for r in rows).values()) <= 3
            for s, target in expected_targets(dict(sizes)).items():
                assert abs(taken[s] - target) <= most[s]
        else:
            from tokenizers import Tokenizer
            own = Tokenizer.from_file(vocabulary_path())
            own.encode_special_tokens = True
            check_packing([(r.doc_id, r.text) for r in source], rows, lambda t: own.encode(t or "", add_special_tokens=False).ids)
        before = rows
    assert Counter(map(tuple, corpus_pipeline.run(spark, sf_dir).select("doc_id", "start", "length", "ids_crc32").collect())).keys() and before
    assert len(BASE_RULES) == 3


def test_nulls_repeated_rows_and_empty_tables(spark, sf_dir):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "en", "a", 9), (1, text, "en", "a", 9), (None, text, "en", "a", 9), (2, None, None, None, None), (3, "", "en", None, 0),
            (None, None, None, None, None), (4, "token = abcdef123456 " + text[:40], "en", "b", 1)]
    docs = spark.createDataFrame(rows, ROWS)
    counts = []
    for name, stage in STAGES:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema if name != "packing" else None)
        counts.append(docs.count())
        if name == "n-gram Jaccard join":
            assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "2", "3", "4", "None"]
    assert counts[0] == 7 and counts[1] == counts[2] == 5
    empty = spark.createDataFrame([], ROWS)
    for _, stage in STAGES:
        assert stage(spark, empty, sf_dir).count() == 0


def test_registered(spark):
    import __spark_entry__ as entry
    assert [n for n, _ in STAGES] == ["toxicity", "n-gram Jaccard join", "secret scans", "mixing sources to target weights", "packing"]
    names = entry.queries()
    assert "pipeline" in names and sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 11))
