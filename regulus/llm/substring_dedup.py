"""Words of repeated passages found by compressed FM-indexes and removed.

A window is a run of ``window`` consecutive words. Every window is dealt to a shard by its least hash among its ``GRAM``-word grams, so equal
windows meet, and neighbouring windows with the same least gram travel as one piece. Only pieces whose gram occurs twice or more are dealt; equal
pieces are one with a count. A shard builds an FM-index over its pieces and streams them through backward search; the matching
statistics give the stretches in which every window occurs again. Hashes only decide where windows meet, the words decide the result.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from regulus.llm.fm_index import FMIndex, repeated_stretches
from regulus.llm.store import row_key, written
from regulus.llm.words import Words, grams, words_of

#: Words of a window and of a gram, words of a shard, pieces of a gram beyond which its windows are dealt one by one.
WINDOW, GRAM, SHARD, HOT = 35, 12, 200_000, 20_000


def _least(values: np.ndarray, n: int, pick=np.minimum, fill=np.uint64(0xFFFFFFFFFFFFFFFF)) -> np.ndarray:
    """The least of every n values from each position on, by doubling."""
    out, width = values, 1
    shifted = lambda x, k: np.concatenate([x[k:], np.full(min(k, len(x)), fill, dtype=x.dtype)])
    while width * 2 <= n:
        out, width = pick(out, shifted(out, width)), width * 2
    return pick(out, shifted(out, n - width)) if width < n else out


def _window_grams(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a slice: the document of every word, the hash of its gram, and the least gram of the window from it on (0: no window)."""
    lengths = np.diff(words.bounds)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    hashes = words.hashes()
    own = np.full(len(hashes), np.uint64(0xFFFFFFFFFFFFFFFF))
    every = grams(hashes, gram)
    own[:len(every)] = every | np.uint64(1)
    least = _least(own, window - gram + 1)
    left = words.bounds[1:][doc] - np.arange(len(doc)) if len(doc) else np.zeros(0, dtype=np.int64)
    least[left < window] = 0
    return doc, own, least


def _anchors(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(key, gram, n): the grams that are the least of some window of a document, and how often they are (2 for more)."""
    def find(batches):
        for batch in batches:
            keys, found, counts = [], [], []
            for words in words_of(batch.column("__text")):
                doc, own, least = _window_grams(words, window, gram)
                # a gram is chosen if it is the least of a window that begins up to window - gram words before it
                span = window - gram + 1
                chosen = np.flatnonzero((own == _least(least[::-1], span, np.maximum, np.uint64(0))[::-1]) & (own != np.uint64(0xFFFFFFFFFFFFFFFF)))
                pair = np.lexsort((own[chosen], doc[chosen]))
                d, g = doc[chosen][pair], own[chosen][pair]
                new = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (g[1:] != g[:-1]))) if len(d) else np.zeros(0, dtype=np.int64)
                keys.append(d[new] + words.first)
                found.append(g[new].view(np.int64))
                counts.append(np.minimum(np.diff(np.append(new, len(d))), 2))
            if keys:
                rows = pa.array(np.concatenate(keys))
                yield pa.RecordBatch.from_arrays([batch.column("key").take(rows), pa.array(np.concatenate(found)), pa.array(np.concatenate(counts), pa.int64())],
                                                 names=["key", "gram", "n"])

    return docs.mapInArrow(find, "key binary, gram long, n long")


def _pieces(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(key, start, gram, piece) of the windows whose least gram is in ``grams``: runs with one gram, cut so that a piece stays short."""
    def cut(batches):
        for batch in batches:
            wanted = batch.column("grams")
            for words in words_of(batch.column("__text")):
                keys, starts, found, pieces = [], [], [], []
                doc, _, least = _window_grams(words, window, gram)
                for d in range(len(words.bounds) - 1):
                    a, b = int(words.bounds[d]), int(words.bounds[d + 1])
                    if b - a < window:
                        continue
                    own = least[a:b - window + 1]
                    hits = np.isin(own, np.array(wanted[words.first + d].as_py(), dtype=np.int64).view(np.uint64))
                    if not hits.any():
                        continue
                    edge = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (hits[1:] != hits[:-1])))
                    text = words.text(d)
                    for s, e in zip(edge.tolist(), np.append(edge[1:], len(own)).tolist()):
                        if not hits[s]:
                            continue
                        for k in range(s, e, window - gram + 1):
                            upto = min(e, k + window - gram + 1) + window - 1
                            keys.append(words.first + d)
                            starts.append(k)
                            found.append(own[s].view(np.int64))
                            pieces.append(b" ".join(text[k:upto]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(keys, pa.int64())), pa.array(starts, pa.int64()), pa.array(found, pa.int64()), pa.array(pieces, pa.binary()).cast(pa.string())],
                    names=["key", "start", "gram", "piece"])

    return docs.mapInArrow(cut, "key binary, start long, gram long, piece string")


def _search(shard: pa.Table, window: int) -> pa.Table:
    """Stretches of the pieces of a shard, as (piece_id, begins, ends), in words."""
    texts = [t.split(b" ") for t in shard["piece"].cast(pa.binary()).to_pylist()]
    lengths = np.array([len(t) for t in texts])
    codes, _ = pd.factorize(np.array([w for t in texts for w in t], dtype=object))
    ends = np.cumsum(lengths + 1) - 1
    symbols = np.zeros(int(ends[-1]) + 1, dtype=np.int64)
    inside = np.ones(len(symbols), dtype=bool)
    inside[ends] = False
    symbols[inside] = codes + 1
    begins = ends - lengths
    # a piece that occurs more than once is repeated as a whole
    several = shard["n"].to_numpy() > 1
    single = np.flatnonzero(~several)
    found = repeated_stretches(FMIndex(symbols), symbols, begins[single], ends[single], window)
    found[:, 0] = single[found[:, 0]]
    whole = np.flatnonzero(several)
    found = np.concatenate([found, np.column_stack([whole, begins[whole], ends[whole]])])
    rows = found[:, 0]
    return pa.table([shard["piece_id"].take(pa.array(rows)), pa.array(found[:, 1] - begins[rows]), pa.array(found[:, 2] - begins[rows])],
                    names=["piece_id", "begin", "end"])


def _hot_windows(pieces: DataFrame, window: int) -> DataFrame:
    """The same for grams with very many different pieces, which would not fit a shard: their windows are counted one by one."""
    def split(batches):
        for batch in batches:
            ids, begins, counts, texts = [], [], [], []
            for piece_id, piece, n in zip(batch.column("piece_id").to_pylist(), batch.column("piece").to_pylist(), batch.column("n").to_pylist()):
                words = piece.split(" ")
                for k in range(len(words) - window + 1):
                    ids.append(piece_id)
                    begins.append(k)
                    counts.append(n)
                    texts.append(" ".join(words[k:k + window]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(begins, pa.int64()), pa.array(counts, pa.int64()), pa.array(texts, pa.string())],
                                             names=["piece_id", "begin", "n", "text"])

    windows = written(pieces.select("piece_id", "piece", "n").mapInArrow(split, "piece_id binary, begin long, n long, text string"), "windows")
    twice = windows.groupBy("text").agg(F.sum("n").alias("n")).where("n > 1").select("text")
    return windows.join(twice, "text", "left_semi").select("piece_id", "begin", (F.col("begin") + window).alias("end"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard: int = SHARD, hot: int = HOT) -> DataFrame:
    """(key, spans) of the documents (key, __text) that hold repeated windows: begin and end of stretches of words, in turn."""
    anchors = written(_anchors(docs, window, gram), "anchors")
    repeated = anchors.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram")
    wanted = anchors.select("key", "gram").join(repeated, "gram").groupBy("key").agg(F.collect_set("gram").alias("grams"))
    pieces = written(_pieces(docs.join(wanted, "key").select("key", "__text", "grams"), window, gram), "pieces")
    piece_id = F.unhex(F.md5(F.col("piece").cast("binary")))
    # copies of a piece are counted before they are shuffled
    distinct = written(pieces.groupBy("gram", "piece").agg(F.count("*").alias("n")).withColumn("piece_id", piece_id), "distinct")
    sizes = distinct.groupBy("gram").agg(F.count("*").alias("pieces"))
    many = written(sizes.where(F.col("pieces") > hot).select("gram"), "hot")
    shards = max(1, -(-distinct.count() * (2 * window - gram) // shard))
    placed = distinct.join(many, "gram", "left_anti").select("piece_id", "piece", "n", F.pmod(F.xxhash64("gram"), F.lit(shards)).alias("shard"))
    found = placed.groupBy("shard").applyInArrow(lambda t: _search(t, window), "piece_id binary, begin long, end long")
    found = written(found.unionByName(_hot_windows(distinct.join(many, "gram", "left_semi"), window)), "stretches")
    places = pieces.select("key", "start", piece_id.alias("piece_id"))
    span = F.struct((F.col("start") + F.col("begin")).alias("begin"), (F.col("start") + F.col("end")).alias("end"))
    spans = places.join(found, "piece_id").groupBy("key").agg(F.collect_set(span).alias("spans"))
    return spans.select("key", F.flatten(F.transform("spans", lambda s: F.array(s["begin"], s["end"]))).alias("spans"))


def without_repeats(df: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",), window: int = WINDOW, gram: int = GRAM,
                    shard: int = SHARD, hot: int = HOT) -> DataFrame:
    """One row per row of ``df``: the columns named in ``carry``, n_words, n_removed and ``kept``, the words left, joined by single spaces.

    A word goes if it lies in a window whose words also stand, in this order, at another place of this or any other row; windows are judged on the
    texts as they came. A null text has no words; repeated rows repeat each other's windows and all go alike. Other columns are not
    read, so their names cannot clash. An empty table gives an empty one.
    """
    if not 1 <= gram <= window:
        raise ValueError("a gram has to fit into a window")
    docs = df.select(*[F.col(c) for c in carry], F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    docs = docs.withColumn("key", row_key(*docs.columns))
    spans = written(repeated_spans(docs.select("key", "__text"), window, gram, shard, hot), "spans")
    fields = [docs.schema[c] for c in carry]
    schema = StructType([*fields, StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept", StringType())])

    def keep(batches):
        for batch in batches:
            for words in words_of(batch.column("__text")):
                rows = batch.slice(words.first, len(words.bounds) - 1)
                totals, removed, kept = [], [], []
                for d, own_spans in enumerate(rows.column("spans").to_pylist()):
                    own = words.text(d)
                    totals.append(len(own))
                    if own_spans:
                        depth = np.zeros(len(own) + 1, dtype=np.int64)
                        np.add.at(depth, own_spans[0::2], 1)
                        np.add.at(depth, own_spans[1::2], -1)
                        stays = (np.cumsum(depth)[:-1] == 0).tolist()
                        own = [w for w, s in zip(own, stays) if s]
                    removed.append(totals[-1] - len(own))
                    kept.append(b" ".join(own))
                yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in carry], pa.array(totals, pa.int64()), pa.array(removed, pa.int64()),
                                                  pa.array(kept, pa.binary()).cast(pa.string())], names=schema.names)

    return docs.join(spans, "key", "left").select(*carry, "__text", "spans").mapInArrow(keep, schema)


