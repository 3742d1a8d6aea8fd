"""Token ids of whole texts by the public byte-level tokenizer.

The tokenizer splits a text before it merges bytes. It always splits in front of a single space between two other characters, and on both
sides of a single line break between two. So a text without runs of white space is the sequence of its units (a word with the space
or the line break before it), each with ids of its own. Arrow cuts a batch into units and numbers the distinct ones; a worker encodes each
unit once and keeps it as long as the kept units fit their bound. Any other text is encoded whole.
"""
from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from regulus.llm.words import slices, utf8

#: The default tokenizer file; operators take another path as a parameter.
VOCABULARY = "byte_bpe_50k.json"
#: Units in each of the two generations that a worker keeps. When the young one is full it becomes the old one, whose units come back as they are met.
_MOST_UNITS = 1_500_000
#: Bytes of text cut at once.
_SLICE = 16 << 20
#: Texts that are encoded whole: white space at an end, next to other white space, or anything but a space or line break.
_RARE = "".join(f"\\x{{{ord(c):x}}}" for c in map(chr, range(0x110000)) if c.isspace() and c not in " \n")
_RUNS = rf"\A[ \n]|[ \n]\z|[ \n][ \n]|[{_RARE}]"
#: A unit of letters and the marks behind them, in front of which the tokenizer splits.
_SIMPLE = r"\A(?P<stem>\n?\p{L}+)(?P<tail>[^\p{L}\p{N}\s]*)\z"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _letters_of_bytes() -> dict[int, str]:
    """The character that stands for each byte in the vocabulary: printable ones for themselves, the others from U+0100 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in kept]
    return {**{b: chr(b) for b in kept}, **{b: chr(0x100 + k) for k, b in enumerate(others)}}


_LETTER = _letters_of_bytes()


def _lists(ends, flat) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(flat, pa.uint32()))


class _Kept:
    """Units and their ids."""

    def __init__(self) -> None:
        self.units, self.ids = pa.array([], pa.large_string()), _lists([0], [])

    def add(self, units: pa.Array, ids: pa.Array) -> None:
        self.units, self.ids = pa.concat_arrays([self.units, units]), pa.concat_arrays([self.ids, ids])


class Encoder:
    """Strings of special tokens inside a text are ordinary text."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.newline = self.tokenizer.token_to_id(_LETTER[10])
        self.young, self.old = _Kept(), _Kept()

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _merged(self, parts: pa.Array, spaced: bool) -> pa.Array:
        """The ids of letters, with a space or their line break in front, or of marks without one: the tokenizer does not split them, so its merges are all."""
        merge, flat, ends = self.tokenizer.model.tokenize, [], [0]
        for part in parts.to_pylist():
            if spaced and part[0] == "\n":
                flat.append(self.newline)
                part = part[1:]
            elif spaced:
                part = " " + part
            if part:
                flat += [t.id for t in merge(part.encode().decode("latin-1").translate(_LETTER))]
            ends.append(len(flat))
        return _lists(ends, flat)

    def _learnt(self, units: pa.Array) -> pa.Array:
        """The ids of new units. Those of letters with marks behind them are put together from both."""
        cut = pc.extract_regex(units, _SIMPLE)
        simple = pc.is_valid(cut).to_numpy(zero_copy_only=False)
        rest = units.filter(pa.array(~simple)).to_pylist()
        whole = [self._whole([u if u.startswith("\n") else " " + u])[0] for u in rest]
        cut = cut.filter(pa.array(simple))
        stems, tails = cut.field("stem").dictionary_encode(), cut.field("tail").dictionary_encode()
        parts = pa.concat_arrays([self._merged(stems.dictionary, True), self._merged(tails.dictionary, False),
                                  _lists(np.cumsum([0, *map(len, whole)]), [i for ids in whole for i in ids]), _lists([0, 0], [])])
        # two parts for each unit: stem and tail, or the whole and nothing
        first, n_stems, n_tails = np.empty((len(units), 2), dtype=np.int64), len(stems.dictionary), len(tails.dictionary)
        first[simple, 0], first[simple, 1] = stems.indices.to_numpy(), n_stems + tails.indices.to_numpy()
        first[~simple, 0], first[~simple, 1] = n_stems + n_tails + np.arange(len(rest)), len(parts) - 1
        both = parts.take(pa.array(first.reshape(-1)))
        return pa.LargeListArray.from_arrays(pa.array(both.offsets.to_numpy()[::2]), both.values)

    def _known(self, units: pa.Array) -> pa.Array:
        """The places of distinct units among those kept."""
        if len(self.young.units) > _MOST_UNITS:
            self.young, self.old = _Kept(), self.young
        place = pc.index_in(units, value_set=self.young.units)
        if place.null_count:
            missing = units.filter(pc.is_null(place))
            before = pc.index_in(missing, value_set=self.old.units)
            self.young.add(missing.filter(pc.is_valid(before)), self.old.ids.take(before.drop_null()))
            fresh = missing.filter(pc.is_null(before))
            self.young.add(fresh, self._learnt(fresh))
            place = pc.index_in(units, value_set=self.young.units)
        return place

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        runs = pc.match_substring_regex(texts, _RUNS).to_numpy(zero_copy_only=False) & (lengths > 0)
        out: list[np.ndarray] = [np.zeros(0, dtype="<u4")] * len(texts)
        plain, whole = np.flatnonzero(~runs & (lengths > 0)), np.flatnonzero(runs)
        if len(plain):
            for i, ids in zip(plain.tolist(), self._units(texts if len(plain) == len(texts) else texts.take(pa.array(plain)))):
                out[i] = ids
        for k in range(0, len(whole), 256):
            part = whole[k:k + 256]
            for i, ids in zip(part.tolist(), self._whole(texts.take(pa.array(part)).to_pylist())):
                out[i] = np.array(ids, dtype="<u4")
        return out

    def _units(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of texts without runs of white space."""
        # a line break leads the text, so that its first word is a unit too; its id is left out below
        lead, nothing = pa.scalar("\n", texts.type), pa.scalar("", texts.type)
        told = pc.binary_join_element_wise(lead, pc.replace_substring(texts, "\n", " \n"), nothing)
        lists = pc.split_pattern(told, " ")
        units = lists.flatten().dictionary_encode()
        place = self._known(units.dictionary).take(units.indices)
        found = self.young.ids.take(place)
        ids, ends = found.flatten().to_numpy(), found.offsets.to_numpy()
        offsets = lists.offsets.to_numpy()
        bounds = (ends[offsets - offsets[0]] - ends[0]).tolist()
        for a, b in zip(bounds, bounds[1:]):
            yield ids[a + 1:b]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(column: pa.Array, path: str, most: int = _SLICE) -> Iterator[np.ndarray]:
    """The ids of each text of a column, in order; null is empty."""
    own = encoder(path)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    for i, j in slices(utf8(column)[1], most):
        yield from own.encode(column.slice(i, j - i))
