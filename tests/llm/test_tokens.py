from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from regulus.llm.binary_output import framed, masked, read_at, read_records, unframed, write_records
from regulus.llm.packing import pack
from regulus.llm.queries import QUERIES
from regulus.llm.tokens import Encoder, encoded, vocabulary_path


@pytest.fixture(scope="module")
def plain():
    own = Tokenizer.from_file(vocabulary_path())
    own.encode_special_tokens = True
    return lambda text: own.encode(text or "", add_special_tokens=False).ids


PARTS = st.sampled_from([" ", "  ", "\n", "\t", "a", "Wort", "don't", "'s", "12", ".", "%%%", "é", "　", "\x85", "\x1f", "​", "😀", "<|endoftext|>", "_"])


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.lists(PARTS, max_size=12).map("".join), min_size=1, max_size=5))
def test_units_encode_as_whole_texts(plain, texts):
    assert [x.tolist() for x in encoded(pa.array(texts), vocabulary_path())] == [plain(t) for t in texts]


def test_bounded_units(plain, monkeypatch):
    """Units of the old generation come back, those of an older one are learnt anew."""
    monkeypatch.setattr("regulus.llm.tokens._MOST_UNITS", 3)
    own = Encoder(vocabulary_path())
    texts = ["one two, three four", "five six seven one", "eight two, nine", "one\ntwo three", "öne two... thrée\nfour4 don't", "eight two, nine"]
    for t in texts:
        assert own.encode(pa.array([t], pa.large_string()))[0].tolist() == plain(t)
        assert len(own.young.units) <= 3 + 6


def test_given_texts_encode_as_whole_texts(plain, sf_dir):
    texts = pq.read_table(f"{sf_dir}/documents.parquet", columns=["text"])["text"].combine_chunks()
    assert [x.tolist() for x in encoded(texts, vocabulary_path(), 1 << 16)] == [plain(t) for t in texts.to_pylist()]


ROWS = [(1, "a b c"), (1, "a b c"), (None, "null id"), (3, None), (2, ""), (5, "word " * 3000 + "end"), (4, "x" * 5000), (None, None)]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def check_packing(rows, got, plain):
    """rows: (doc_id, text), ids may repeat; got: rows of pack()."""
    want = defaultdict(list)
    for doc_id, text in rows:
        want[doc_id].append(plain(text) + [0])
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    assert set(pieces) == set(want)
    for doc_id, all_ids in want.items():
        for ids in all_ids:  # equal ids: each document finds its own pieces
            at = 0
            while at < len(ids):
                piece = next(p for p in pieces[doc_id] if p[0] == at and p[3] == len(ids) and crc(ids[at:at + p[1]]) == p[2])
                pieces[doc_id].remove(piece)
                at += piece[1]
            assert at == len(ids)
        assert not pieces[doc_id]
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    lengths = []
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        lengths.append(at)
    assert max(lengths) <= 1024 and sum(n < 1024 for n in lengths) <= 1


def test_packing_query(spark, sf_dir, plain):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check_packing(rows, QUERIES["op5_packing"](spark, sf_dir).collect(), plain)


@pytest.mark.parametrize("partitions", [1, 3, 9])
def test_packing_in_rounds(spark, plain, partitions):
    rows = ROWS + [(100 + i, "some words " * (i * 37 % 400)) for i in range(150)]
    df = spark.createDataFrame([(*r, 0, "y") for r in rows], "doc_id long, text string, start int, ids string").repartition(partitions)
    check_packing(rows, pack(df, merged=2, open_windows=3).collect(), plain)


def test_binary_query(spark, sf_dir, plain):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    got = {r.doc_id: r for r in QUERIES["op10_binary_output"](spark, sf_dir).collect()}
    start = 0
    for doc_id, text in rows:
        ids = plain(text) + [2]
        assert tuple(got.pop(doc_id)) == (doc_id, start, len(ids), crc(ids))
        start += len(ids)
    assert not got


def test_records_and_index(spark, tmp_path, plain):
    folder = f"file://{tmp_path}/records"
    df = spark.createDataFrame([(*r, 1) for r in ROWS], "doc_id long, text string, hash int").repartition(3)
    manifest = write_records(df, folder)
    got = sorted(map(tuple, read_records(manifest, folder).collect()), key=lambda r: r[1])
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r[0] for r in got] == [r[0] for r in order] and [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()
    assert sorted((str(a), n, c) for a, _, n, c in got) == sorted((str(a), len(plain(t)) + 1, crc(plain(t) + [2])) for a, t in ROWS)
    at = {r["part"]: r for r in manifest.collect()}[0]
    numbers = list(range(at["n_records"]))[::-1]
    assert [(a, len(ids)) for a, ids in read_at(folder, at["name"], numbers)] == [(r[0], r[2]) for r in got[:at["n_records"]]][::-1]


def test_damage_is_found():
    import io
    frame = bytearray(framed(7, np.array([1, 70000, 3], dtype=np.uint32)))
    assert unframed(io.BytesIO(bytes(frame)).read)[1].tolist() == [1, 70000, 3] and masked(b"") == 0xA282EAD8
    for k in (0, 9, 20, len(frame) - 1):
        hurt = frame.copy()
        hurt[k] ^= 1
        with pytest.raises(ValueError):
            unframed(io.BytesIO(bytes(hurt)).read)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pack(df).collect() == []
    from regulus.llm.binary_output import records_of
    assert records_of(df).collect() == []


def test_packing_keeps_great_ids_beside_null(spark, plain):
    """Ids above 2^53 and arrays come back as they are, next to nulls."""
    great = 9007199254740993
    rows = [(great, "a b", [1, 2]), (None, "c", None), (7, "d e f", [great]), (great + 2, "g", []), (-great, "h i", [None])]
    df = spark.createDataFrame(rows, "doc_id long, text string, tags array<long>").repartition(4)
    got = pack(df, carry=("doc_id", "tags")).collect()
    assert sorted(((r.doc_id, r.tags, r.ids_crc32) for r in got), key=str) == sorted(((i, t, crc(plain(x) + [0])) for i, x, t in rows), key=str)
    assert len({r.sequence_id for r in got}) == 1


@pytest.mark.parametrize("carry", [("start",), ("doc_id", "part"), ("doc_id", "doc_id")])
def test_carried_names_that_clash_are_refused(spark, carry):
    df = spark.createDataFrame([(1, "a", 2, 3)], "doc_id long, text string, start long, part long")
    with pytest.raises(ValueError, match="cannot be carried"):
        pack(df, carry=carry)
