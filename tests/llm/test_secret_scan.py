from __future__ import annotations

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from regulus.llm.automaton import compiled
from regulus.llm.queries import QUERIES
from regulus.llm.secret_scan import RULES, find_secrets, redact, scanner
from regulus.llm.words import utf8

_KEY = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in ("password", "passwd", "secret", "token", "api_?key"))
PATTERNS = {
    "assign": (re.compile(rf"({_KEY})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), lambda m: len(m[2]) >= 6),
    "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    "hex": (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
}


def brute(text):
    """Base spans by start and kind."""
    found = []
    for k, (kind, (pattern, holds)) in enumerate(PATTERNS.items()):
        found += [(m.start(), k, kind, m.end()) for m in pattern.finditer(text or "") if holds(m)]
    return [f"{kind}:{s}:{e}" for s, _, kind, e in sorted(found)]


PARTS = st.sampled_from(["password", "Secret", "TOKEN", "api_key", "apikey", " ", "  ", ":", "=", '"', "'", "AKIA", "A" * 9, "0123456789abcdef", "f" * 8,
                         "abcdef", "é", "\n", ",", ".", "x", "12", "==", "ſecret", "K"])


def scan(texts):
    import pyarrow as pa
    data, offsets = utf8(pa.array(texts, pa.string()))
    found = scanner(RULES).scan(data, offsets)
    return [[f"{RULES[k].kind}:{s}:{e}" for s, k, e in sorted(found.get(i, [])) if k < 3] for i in range(len(texts))]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=14).map("".join), min_size=1, max_size=6))
def test_base_spans_against_regular_expressions(texts):
    assert scan(texts) == [brute(t) for t in texts]


def test_long_texts_and_pieces():
    texts = ["a" * 100_000, "g " * 50_000 + "secret = abcdef", "0" * 70_000, "é" * 5000 + "AKIA" + "Z" * 5000, "secret: token: abcdefgh", ""]
    assert scan(texts) == [brute(t) for t in texts]


def test_automaton_is_minimal_and_exact():
    a = compiled(["ab*", "ac"], anywhere=False)
    assert len(a.table) == 5  # dead, start, a, ab.., ac
    assert a.longest(b"abbbx", 0, 5) == 4 and a.longest(b"ac", 0, 2) == 2 and a.longest(b"b", 0, 1) == -1


def test_rows_pass_through(spark):
    rows = [(None, None, 1), (1, "", 2), (1, "token: ghp_" + "a1B2" * 10, 3), (1, "token: ghp_" + "a1B2" * 10, 3),
            (2, "é password='hunter22' und -----BEGIN RSA PRIVATE KEY-----", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, secrets int")
    out = find_secrets(df).collect()
    assert len(out) == 5 and out[0].secrets == [] and out[1].secrets == []
    assert [s.kind for s in out[2].secrets] == ["assign", "github"] and out[2].secrets == out[3].secrets
    assert [(s.kind, s.start, s.end) for s in out[4].secrets] == [("assign", 2, 20), ("pem", 26, 57)]
    assert [r.text for r in redact(df).collect()] == [None, "", "[assign]", "[assign]", "é [assign]' und [pem]"]
    assert find_secrets(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_whole_key_blocks(spark):
    lines = [("Ab3+/xYz" * 8), ("Qr7/kLmN" * 8), "c2hvcnQ="]
    head, foot = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    block = "\n".join([head, *lines, foot])
    texts = {
        f"é vor\n{block}\nnach é": "é vor\n[pem]\nnach é",
        f"{block}\nund\n{block}": "[pem]\nund\n[pem]",
        block.replace("\n", "\r\n") + " x": "[pem] x",
        '{"key": "' + block.replace("\n", "\\n") + '\\n", "id": 1}': '{"key": "[pem]\\n", "id": 1}',
        block.replace("\n", " ") + " x": "[pem] x",
        "\n".join([head, "Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,00FF", "", *lines, foot, "x"]): "[pem]\nx",
        "\n".join([head, *lines, "No end: two words."]): "[pem]\nNo end: two words.",
        "\n".join([head, "Proc-Type: 4,ENCRYPTED", "", *lines[:1], "", "Öl"]): "[pem]\n\nÖl",
        f"{head} is how, (it) begins": "[pem] is how, (it) begins",
        head + "\nQQ==": "[pem]",
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, block[:60]])], "doc_id long, text string")
    got = {r.doc_id: r.text for r in redact(df).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts.values())
    assert got[len(texts)] == "[pem]"


def test_many_key_headers_end():
    texts = ["-----BEGIN PRIVATE KEY-----\n" * 3000, "-----BEGIN PRIVATE KEY-----" + "\n " * 30_000 + "(", "-----BEGIN PRIVATE KEY-----" + "QUJD" * 50_000]
    assert scan(texts) == [[], [], []]


def test_query_against_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op3_secret_scans"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in want) for k in PATTERNS)
        assert set(want) <= set(r.spans.split(",")) | {""}
