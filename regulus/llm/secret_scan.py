"""Secrets in texts, found by one deterministic automaton that reads every byte once.

All rules are compiled into one minimised transition array (``automaton.py``). A batch of texts is cut at bytes that no rule can
contain, where the automaton is at its start whatever came before; the pieces then run through the array side by side, one byte of
each per step. Where the automaton reports a hit, the automata of the single kinds read the surrounding piece for exact spans. A key
block goes on over line breaks: behind its first line the rest is read from the text.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from regulus.llm.automaton import Automaton, compiled
from regulus.llm.words import slices, utf8


class Rule(NamedTuple):
    """``base`` gives the leftmost longest spans, ``valid`` those that count; ``trigger`` ends in every text that has a valid span.

    ``tails`` are expressions over bytes, none beyond ASCII: the first that matches right behind a span, line breaks included, belongs to it.
    """

    kind: str
    base: str
    valid: str
    trigger: str
    tails: tuple[bytes, ...] = ()


_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]"""
BASE_RULES = (
    Rule("assign", _ASSIGN + "+", _ASSIGN + "{6,}", _ASSIGN + "{6}"),
    Rule("access", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]{16,}", "AKIA[A-Z0-9]{4}"),
    Rule("hex", "[0-9a-f]+", "[0-9a-f]{24,}", "[0-9a-f]{16}"),
)
#: The body of a key: up to the END line, or as far as base64 lines go and one shorter last line. Breaks may be escaped, blank or quoted.
_BREAK = rb"(?:[ \t>\"'+,]*+(?:\r?\n|\\r|\\n))++[ \t>\"']*+"
_PEM_TAILS = (
    rb"(?:[A-Za-z0-9+/=\s:,.>\"'\\]|-(?!----))*+-----END [A-Z ]*PRIVATE KEY-----",
    rb"(?:" + _BREAK + rb"(?:Proc-Type|DEK-Info):[\x20-\x7e]*+)*+(?:(?:" + _BREAK + rb"|[ \t]++)[A-Za-z0-9+/]{16,}+={0,2})*+"
    rb"(?:" + _BREAK + rb"[A-Za-z0-9+/]++={0,2}(?=[ \t\"',]*(?:[\r\n\\]|\Z)))?",
)
MORE_RULES = (
    Rule("github", "gh[oprsu]_[A-Za-z0-9]+", "gh[oprsu]_[A-Za-z0-9]{36,}", "gh[oprsu]_[A-Za-z0-9]"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", "xox[abprs]-[A-Za-z0-9-]{10,}", "xox[abprs]-[A-Za-z0-9-]"),
    Rule("google", "AIza[A-Za-z0-9_-]+", "AIza[A-Za-z0-9_-]{35,}", "AIza[A-Za-z0-9_-]"),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "BEGIN [A-Z ]*PRIVATE KEY", _PEM_TAILS),
)
RULES = BASE_RULES + MORE_RULES
SPANS = ArrayType(StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())]))
#: Bytes scanned at once, and the bytes of a piece after which the next cut is taken.
_AT_ONCE, _PIECE = 4 << 20, 2048


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.kinds = [r.kind for r in rules]
        self.all = compiled([r.trigger for r in rules], anywhere=True)
        self.base = [compiled([r.base], anywhere=False) for r in rules]
        self.valid = [compiled([r.valid], anywhere=False) for r in rules]
        self.tails = [[re.compile(t) for t in r.tails] for r in rules]
        self.first = [np.flatnonzero(a.first_bytes()).tolist() for a in self.base]
        cut = (self.all.table == self.all.start)[1:].all(axis=0)
        for a in self.base:
            cut &= (a.table == 0).all(axis=0)
        self.cut = cut
        assert cut[0x0A], "a line break has to end every match"

    def hits(self, data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Positions at which the combined automaton accepts. ``cuts``: positions of cutting bytes, the last one at the end."""
        edges = np.unique(cuts[np.minimum(np.searchsorted(cuts, np.arange(_PIECE, len(data) + _PIECE, _PIECE)), len(cuts) - 1)])
        starts = np.concatenate([[0], edges[:-1] + 1])
        lengths = edges - starts
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        flat, first = (self.all.table * 256).astype(np.int32).ravel(), self.all.accepting * 256
        state = np.full(len(starts), self.all.start * 256, dtype=np.int32)
        found = []
        active = np.searchsorted(-lengths, -np.arange(1, int(lengths[0]) + 1), side="right") if len(lengths) else []
        for t, n in enumerate(active):
            now = flat[state[:n] + data[starts[:n] + t]]
            state[:n] = now
            if now.max() >= first:
                found.append(starts[:n][now >= first] + t)
        return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)

    def spans_of(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, number of the kind, end) of every valid span of a piece without cutting bytes, in order."""
        found = []
        for k, (base, valid, first) in enumerate(zip(self.base, self.valid, self.first)):
            at, begins = 0, set(first)
            while at < len(data):
                if data[at] not in begins or (end := base.longest(data, at, len(data))) < 0:
                    at += 1
                    continue
                if valid.longest(data, at, end) == end:
                    found.append((at, k, end))
                at = end
        return sorted(found)

    def behind(self, kind: int, data: memoryview, at: int, end: int) -> int:
        """How many bytes behind a span its rule's tails add to it."""
        return next((m.end() - at for t in self.tails[kind] if (m := t.match(data, at, end))), 0)

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
        """Spans, in code points, of the texts that have any, by the number of the text."""
        lengths = np.diff(offsets)
        ends = np.cumsum(lengths + 1) - 1
        joined = np.full(int(ends[-1]) + 1 if len(ends) else 0, 0x0A, dtype=np.uint8)
        inside = np.ones(len(joined), dtype=bool)
        inside[ends] = False
        joined[inside] = data[offsets[0]:offsets[-1]]
        cuts = np.flatnonzero(self.cut[joined])
        hits, whole = self.hits(joined, cuts), memoryview(joined)
        after = np.unique(np.searchsorted(cuts, hits))
        out: dict[int, list[tuple[int, int, int]]] = {}
        for c in after:
            begin, end = int(cuts[c - 1]) + 1 if c else 0, int(cuts[c])
            spans = self.spans_of(joined[begin:end].tobytes())
            if spans:
                doc = int(np.searchsorted(ends, begin))
                head = int(ends[doc - 1]) + 1 if doc else 0
                # every byte of a span is one code point; only what stands before it has to be counted
                before = int(np.count_nonzero((joined[head:begin] & 0xC0) != 0x80))
                piece = (joined[begin:end] & 0xC0) != 0x80
                points = np.concatenate([[0], np.cumsum(piece)])
                out.setdefault(doc, []).extend((before + int(points[s]), k, before + int(points[e]) + self.behind(k, whole, begin + e, int(ends[doc])))
                                               for s, k, e in spans)
        return out


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def _spans_by_row(column: pa.Array, rules: tuple[Rule, ...]) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    own = scanner(rules)
    data, offsets = utf8(column)
    for i, j in slices(offsets, _AT_ONCE):
        for doc, spans in own.scan(data, offsets[i:j + 1]).items():
            yield i + doc, sorted(spans)


def find_secrets(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``df`` with ``secrets``: kind, start and end (exclusive, in code points) of every span, by start and kind.

    Null and empty texts have none; repeated rows are scanned each on its own; a column already named ``secrets`` is replaced.
    """
    df = df.drop("secrets")
    kinds = [r.kind for r in rules]

    def scan(batches):
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            found = [[] for _ in range(batch.num_rows)]
            for i, spans in _spans_by_row(batch.column(text), rules):
                found[i] = [{"kind": kinds[k], "start": s, "end": e} for s, k, e in spans]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(kind))], names=[*batch.schema.names, "secrets"])

    return df.mapInArrow(scan, StructType([*df.schema.fields, StructField("secrets", SPANS)]))


def redact(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``df`` with every secret replaced by its kind in brackets; overlapping spans become one, named after the first.

    Null texts stay null.
    """
    kinds = [r.kind for r in rules]

    def clean(batches):
        for batch in batches:
            column = batch.column(text)
            texts = None
            for i, spans in _spans_by_row(column, rules):
                texts = texts if texts is not None else column.to_pylist()
                whole, out, at, upto = texts[i], [], 0, 0
                for s, k, e in spans:
                    if s >= upto:
                        out += [whole[at:s], f"[{kinds[k]}]"]
                    at = upto = max(upto, e)
                texts[i] = "".join([*out, whole[at:]])
            if texts is not None:
                at = batch.schema.get_field_index(text)
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, column.type))
            yield batch

    return df.mapInArrow(clean, df.schema)


def joined_spans(spans: Column | str, kinds: tuple[str, ...] | None = None) -> Column:
    """Spans as text: kind:start:end, joined by commas; with ``kinds`` only those."""
    spans = F.col(spans) if isinstance(spans, str) else spans
    if kinds is not None:
        spans = F.filter(spans, lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def n_of(kind: str, spans: str = "secrets") -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


__all__ = ["BASE_RULES", "MORE_RULES", "RULES", "Automaton", "Rule", "find_secrets", "joined_spans", "n_of", "redact", "scanner"]
