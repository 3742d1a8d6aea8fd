"""Ranked lexical search in which documents with the same bag are scored once.

Documents are cut down to the terms that the items use. What a score depends on is then a document's bag: how often it holds each such
term, and its length factor m. Equal bags are found by hash and verified by value, every class of them is scored once against all items,
and the classes an item ranks first are expanded to their documents by ascending id.
"""
from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regulus.llm.store import written
from regulus.llm.words import Words, utf8, slices

#: The characters between terms, as the body of a regular-expression class.
BETWEEN = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
#: Terms of all the items that one pass over the documents answers, about; more items take more passes.
TERMS = 200_000
#: Results of an item.
TOP = 50
#: Classes scored at once, and the matches of terms and items that this may bring about.
_CLASSES, _MATCHES = 1024, 1 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32
_IS_TERM = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])


def terms_of(column: pa.Array) -> Iterator[Words]:
    """The terms of a string column, slice by slice: only A to Z are lower-cased."""
    everything, offsets = utf8(column)
    for i, j in slices(offsets):
        data = _FOLD[everything[offsets[i]:offsets[j]]]
        cuts = offsets[i:j + 1] - offsets[i]
        inner = np.zeros(len(data) + 2, dtype=bool)
        inner[1:-1] = _IS_TERM[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[cuts] = True
        starts = np.flatnonzero(inner[1:] & (~inner[:-1] | edge))
        ends = np.flatnonzero(inner[:-1] & (~inner[1:] | edge))
        yield Words(i, data, starts, ends, np.searchsorted(starts, cuts))


def _flat(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places starts[i] to starts[i] + lengths[i] - 1 of every i, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class Vocabulary:
    """Terms with numbers. A term is looked up by its hash and verified by its bytes."""

    def __init__(self, terms: list[bytes]) -> None:
        """``terms``: distinct; their numbers are their places."""
        self.size = len(terms)
        self.data = np.frombuffer(b"".join(terms), dtype=np.uint8)
        self.lengths = np.array([len(t) for t in terms], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        hashes = Words(0, self.data, self.starts, self.starts + self.lengths, np.zeros(1, dtype=np.int64)).hashes()
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        alone = np.ones(len(terms), dtype=bool)
        alone[1:] = hashes[1:] != hashes[:-1]
        self.hashes, self.number = hashes[alone], order[alone].astype(np.int32)
        # terms that share a hash are told apart by a plain look-up
        shared = set(hashes[~alone].tolist())
        self.shared = {terms[i]: i for h, i in zip(hashes.tolist(), order.tolist()) if h in shared}
        self.shared_hashes = np.array(sorted(shared), dtype=np.uint64)

    def numbers(self, words: Words) -> np.ndarray:
        """The number of each term, -1 for one that is not among them."""
        out = np.full(len(words.starts), -1, dtype=np.int32)
        if not self.size or not len(out):
            return out
        hashes = words.hashes()
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        number = self.number[place]
        lengths = words.ends - words.starts
        some = np.flatnonzero((self.hashes[place] == hashes) & (self.lengths[number] == lengths))
        if len(some):
            n = lengths[some]
            same = words.data[_flat(words.starts[some], n)] == self.data[_flat(self.starts[number[some]], n)]
            some = some[np.logical_and.reduceat(same, np.cumsum(n) - n)]
            out[some] = number[some]
        if len(self.shared_hashes):
            for i in np.flatnonzero(np.isin(hashes, self.shared_hashes)).tolist():
                out[i] = self.shared.get(words.data[words.starts[i]:words.ends[i]].tobytes(), -1)
        return out


class Items(NamedTuple):
    """Items of one pass. ``first`` and ``of`` list the items of each term number: of[first[t]:first[t + 1]]."""

    ids: list            # the id of each item; a repeated item is one more
    terms: list[bytes]
    first: np.ndarray
    of: np.ndarray


def read_items(rows: pa.Table) -> Items:
    """Items from (item_id, text) rows; null text has no terms."""
    ids, numbers, pairs = rows["item_id"].to_pylist(), {}, []
    for words in terms_of(rows["text"].combine_chunks()):
        for i in range(len(words.bounds) - 1):
            for a, b in {(words.data[s:e].tobytes(), 0) for s, e in zip(words.starts[words.bounds[i]:words.bounds[i + 1]], words.ends[words.bounds[i]:words.bounds[i + 1]])}:
                pairs.append((numbers.setdefault(a, len(numbers)), words.first + i))
    pairs = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
    return Items(ids, list(numbers), np.searchsorted(pairs[:, 0], np.arange(len(numbers) + 1)), pairs[:, 1].astype(np.int32))


BAGS = "doc_id {id}, n long, terms array<int>, counts array<int>, is_count boolean"


def bags(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """Of every document with a term: doc_id, n (its terms with repeats), the item terms it holds and how often. Null text has none.

    Each task adds a row with is_count: in how many of its documents each term stands.
    """
    schema = BAGS.format(id=docs.schema["doc_id"].dataType.simpleString())

    def run(batches):
        vocabulary, df, id_type = Vocabulary(terms), np.zeros(len(terms) + 1, dtype=np.int64), None

        def batch_of(ids, n, bounds, found, counts, is_count):
            offsets = pa.array(bounds, pa.int32())
            return pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32())), pa.array([is_count] * len(n), pa.bool_())],
                names=["doc_id", "n", "terms", "counts", "is_count"])

        for batch in batches:
            id_type = batch.column("doc_id").type
            for words in terms_of(batch.column("text")):
                n = np.diff(words.bounds)
                number = vocabulary.numbers(words)
                known = number >= 0
                # one number for each pair of document and term
                pair = np.repeat(np.arange(len(n)), n)[known] * np.int64(max(1, len(terms))) + number[known]
                pair, counts = np.unique(pair, return_counts=True)
                doc, term = pair // max(1, len(terms)), pair % max(1, len(terms))
                df += np.bincount(term, minlength=len(df))
                kept = np.flatnonzero(n)
                yield batch_of(batch.column("doc_id").slice(words.first, len(n)).take(pa.array(kept)), n[kept],
                               np.append(np.searchsorted(doc, kept), len(doc)), term, counts, False)
        if id_type is not None:
            used = np.flatnonzero(df)
            yield batch_of(pa.nulls(1, id_type), [0], [0, len(used)], used, np.minimum(df[used], np.iinfo(np.int32).max), True)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _contributions(weights: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m))


def ranked_classes(classes: DataFrame, items: Items, weights: np.ndarray, top: int) -> DataFrame:
    """(item, class, least, score): the classes each task ranks first for each item, by score and then by least id."""
    n_items = len(items.ids)
    fan = np.diff(items.first)
    schema = f"item int, class long, least {classes.schema['least'].dataType.simpleString()}, score long"

    def run(batches):
        best: list[list] = [[] for _ in range(n_items)]  # heaps with the worst in front
        types = None
        for batch in batches:
            types = pa.int32(), pa.int64(), batch.column("least").type, pa.int64()
            m, number = batch.column("m").to_numpy(), batch.column("class").to_numpy()
            least = batch.column("least").to_pylist()
            lists, tf = batch.column("terms"), batch.column("counts").flatten().to_numpy()
            lengths, term = lists.value_lengths().to_numpy().astype(np.int64), lists.flatten().to_numpy()
            ends = np.cumsum(lengths)
            spread = np.concatenate([[0], np.cumsum(fan[term])])
            i = 0
            while i < len(m):
                # as many classes as stay within the bounds, one at least
                a = ends[i] - lengths[i]
                j = int(np.searchsorted(spread[ends], spread[a] + _MATCHES, side="right"))
                j = min(max(j, i + 1), i + _CLASSES, len(m))
                b, row = ends[j - 1], np.repeat(np.arange(j - i), lengths[i:j])
                points = _contributions(weights, term[a:b], tf[a:b], m[i:j][row])
                times = fan[term[a:b]]
                cell = np.repeat(row * n_items, times) + items.of[_flat(items.first[term[a:b]], times)]
                # whole numbers below 2^53 are exact in double precision
                scores = np.bincount(cell, weights=np.repeat(points, times), minlength=(j - i) * n_items).astype(np.int64).reshape(j - i, n_items)
                floor = np.array([heap[0][0] if len(heap) == top else 1 for heap in best])
                for r, q in zip(*np.nonzero(scores >= np.maximum(floor, 1))):
                    id_ = least[i + r]
                    entry = (int(scores[r, q]), _Later(id_), int(number[i + r]))
                    if len(best[q]) < top:
                        heapq.heappush(best[q], entry)
                    elif best[q][0] < entry:
                        heapq.heapreplace(best[q], entry)
                i = j
        found = [(q, c, least.id, score) for q, heap in enumerate(best) for score, least, c in heap]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(types)], names=["item", "class", "least", "score"])

    return classes.select("class", "least", "m", "terms", "counts").mapInArrow(run, schema)


class _Later:
    """An id in reverse order: of equal scores the smaller id is the better; none is the worst."""

    __slots__ = ("id",)

    def __init__(self, id_) -> None:
        self.id = id_

    def __lt__(self, other: "_Later") -> bool:
        return other.id is not None and (self.id is None or self.id > other.id)

    def __eq__(self, other) -> bool:
        return self.id == other.id


def search(docs: DataFrame, items: DataFrame, top: int = TOP, terms: int = TERMS) -> DataFrame:
    """The ``top`` documents of each item with a score above 0: item_id, rank from 1, doc_id, score; equal scores by ascending doc_id.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are not read, so none can clash. Null and empty texts hold no
    term. Repeated documents are ranked each; a document without an id comes after its equals. A repeated item is answered once for
    each row. An empty table on either side gives an empty result. Items are answered in passes of about ``terms`` terms, whose items and
    vocabulary are sent to all tasks; the terms of a single item are not split.
    """
    spark = docs.sparkSession
    ids = items.select("item_id", "text")
    # at least two characters a term
    passes = max(1, -(-(ids.agg(F.sum(F.length("text"))).first()[0] or 0) // (2 * terms)))
    dealt = ids.withColumn("pass", F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)))
    out = None
    for number in range(passes):
        own = read_items(dealt.where(F.col("pass") == number).select("item_id", "text").toArrow())
        found = _search(docs, own, top).join(
            F.broadcast(spark.createDataFrame(list(enumerate(own.ids)), f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")), "item")
        found = found.select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return out


def _search(docs: DataFrame, items: Items, top: int) -> DataFrame:
    told = written(bags(docs, items.terms), "bags")
    of_docs = told.where("not is_count")
    n_docs, n_terms = of_docs.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # a row of counts for each task; added up term by term
    df = np.zeros(len(items.terms), dtype=np.int64)
    counts = (told.where("is_count").select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
              .groupBy("x.terms").agg(F.sum("x.counts").alias("df")).toArrow())
    df[counts["terms"].to_numpy()] = counts["df"].to_numpy()
    weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)

    m = F.lit(50) + F.floor(F.expr(f"(50 * n * {n_docs}L) div {max(1, n_terms)}L"))
    of_docs = of_docs.where("size(terms) > 0").select("doc_id", m.cast("long").alias("m"), "terms", "counts")
    of_docs = of_docs.withColumn("bag", F.xxhash64("m", "terms", "counts"))
    # the hash sends equal bags to one place, the values in the key verify them; a bag with many documents is reduced in each task first
    key = ["bag", "m", "terms", "counts"]
    classes = written(of_docs.groupBy(*key).agg(F.min("doc_id").alias("least")).withColumn("class", F.monotonically_increasing_id()), "classes")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("least").asc_nulls_last(), "class")
    first = written(ranked_classes(classes, items, weights, top).withColumn("place", F.row_number().over(order))
                    .where(F.col("place") <= top).select("item", "class", "score"), "first")
    # at most ``top`` classes an item
    wanted = written(classes.join(F.broadcast(first.select("class").distinct()), "class").select("class", *key), "wanted")
    # no item takes more than ``top`` documents of a class
    member = Window.partitionBy(*key).orderBy(F.col("doc_id").asc_nulls_last())
    members = (of_docs.join(F.broadcast(wanted.select("bag").distinct()), "bag", "left_semi")
               .withColumn("place", F.row_number().over(member)).where(F.col("place") <= top))
    members = members.join(wanted, key).select("class", "doc_id")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return (first.join(members, "class").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("item", "rank", "doc_id", "score"))
