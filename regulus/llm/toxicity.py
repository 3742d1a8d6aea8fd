"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text has a feature for every n-gram it holds, hashed to a fixed number of buckets. The log ratio of a bucket's frequency in toxic and
in other training texts (counted over all of them) scales the feature; a logistic regression on the scaled features, fitted to a
bounded sample, gives the weights. A score is one sum over the features of the whole text.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

#: Lengths of the n-grams in characters (code points), and buckets.
LENGTHS, BUCKETS = (4, 5, 6), 1 << 18
#: Rows of the training sample, at most half of them toxic; the ratios are counted over all training rows.
SAMPLE = 12_000
#: Ratios within so many standard errors of 0, and those of buckets that fewer texts have, are left out as chance; the model has all others.
#: Few labels make few sure ratios: then the model has some of the less sure ones too.
ERRORS, LEAST_TEXTS = 4.0, 5
LESS_ERRORS, LEAST_FEATURES = 1.5, 1000
#: Rows of the sample that a step of the fit takes at once.
_ROWS = 128
#: Beyond so many labels they are joined by a shuffle and not sent to all executors.
MOST_SENT = 1_000_000
THRESHOLD = 0.3

_MARKS = np.array([c < 128 and not chr(c).isalnum() for c in range(129)])


def features(text: str | None, seen: np.ndarray) -> np.ndarray:
    """The buckets of a text's n-grams, each once. ``seen``: a cleared array of BUCKETS flags, cleared again on return."""
    data = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le"), dtype=np.uint32)
    code = np.where(_MARKS[np.minimum(data, 128)], np.uint32(0x20), data) * np.uint32(0x9E3779B1)
    code ^= code >> np.uint32(16)
    rolled = np.zeros(len(code), dtype=np.uint32)
    for n in range(1, max(LENGTHS) + 1):
        rolled = rolled[:len(code) - n + 1] * np.uint32(0x01000193) + code[n - 1:]
        if n in LENGTHS:
            seen[((rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - 18)] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


def _features(column: pa.Array) -> Iterator[np.ndarray]:
    seen = np.zeros(BUCKETS, dtype=bool)
    for k in range(0, len(column), 64):
        for text in column.slice(k, 64).to_pylist():
            yield features(text, seen)


class Model(NamedTuple):
    weights: np.ndarray  # a float for each bucket, the ratio included
    intercept: float

    def score(self, buckets: np.ndarray) -> float:
        return 1.0 / (1.0 + float(np.exp(-np.clip(self.intercept + self.weights[buckets].sum(dtype=np.float64), -50, 50))))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether labels of a document may not be learnt."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of the labelled documents that are not held out. Rows without an id or a label teach nothing.

    A document labelled twice counts twice, and so does a repeated row. Empty tables give no rows.
    """
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out()).select(
        F.col("doc_id"), (F.col("toxic") > 0).cast("int").alias("toxic"))
    few = known.count() <= MOST_SENT
    return docs.select("doc_id", "text").join(F.broadcast(known) if few else known, "doc_id")


def _counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Toxic and other texts with each bucket, and of each kind."""
    def count(batches):
        own = np.zeros((2, BUCKETS + 1), dtype=np.int64)
        for batch in batches:
            for toxic, found in zip(batch.column("toxic").to_pylist(), _features(batch.column("text"))):
                own[toxic, found] += 1
                own[toxic, BUCKETS] += 1
        used = np.flatnonzero(own.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(own[1, used]), pa.array(own[0, used])], names=["bucket", "toxic", "other"])

    got = (rows.select("text", "toxic").mapInArrow(count, "bucket long, toxic long, other long")
           .groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))).toPandas()
    full = np.zeros((2, BUCKETS + 1), dtype=np.int64)
    full[0, got["bucket"]], full[1, got["bucket"]] = got["toxic"], got["other"]
    return full[0, :-1], full[1, :-1], int(full[0, -1]), int(full[1, -1])


def ratios(toxic: np.ndarray, other: np.ndarray, n_toxic: int, n_other: int) -> np.ndarray:
    """The log-count ratio of each bucket the model has, 0 for the rest."""
    ratio = np.log((toxic + 1.0) / (n_toxic + 2.0)) - np.log((other + 1.0) / (n_other + 2.0))
    sure = np.abs(ratio) / np.sqrt(1 / (toxic + 1.0) + 1 / (other + 1.0))
    sure[toxic + other < LEAST_TEXTS] = 0
    place = np.argsort(np.argsort(-sure, kind="stable"), kind="stable")
    ratio[~((sure >= ERRORS) | (sure >= LESS_ERRORS) & (place < LEAST_FEATURES))] = 0.0
    return ratio


def fit(buckets: list[np.ndarray], toxic: np.ndarray, ratio: np.ndarray, rounds: int = 80, penalty: float = 2e-3) -> tuple[np.ndarray, float]:
    """Logistic regression on presence times ratio: weights by bucket and the intercept, by gradient steps of adaptive length."""
    used = np.flatnonzero(ratio)
    number = np.zeros(len(ratio), dtype=np.int32)
    number[used] = np.arange(len(used))
    blocks = []
    for k in range(0, len(buckets), _ROWS):
        part = buckets[k:k + _ROWS]
        lengths = np.array([len(b) for b in part])
        blocks.append((slice(k, k + len(part)), np.concatenate([number[b] for b in part]), lengths, np.cumsum(lengths) - lengths))
    scale = ratio[used]
    w = np.zeros(len(used) + 1)
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        scaled, total, slope = w[:-1] * scale, 0.0, np.zeros(len(used))
        for rows, place, lengths, starts in blocks:
            z, full = np.full(len(lengths), w[-1]), lengths > 0
            if full.any():
                z[full] += np.add.reduceat(scaled[place], starts[full])
            error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - toxic[rows]) / len(buckets)
            slope += np.bincount(place, weights=np.repeat(error, lengths), minlength=len(used))
            total += error.sum()
        slope = np.append(slope * scale + penalty * w[:-1], total)
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope * slope
        w = w - 0.05 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    out = np.zeros(len(ratio))
    out[used] = w[:-1] * scale
    return out, float(w[-1])


def sampled(rows: DataFrame, toxic: float, other: float) -> DataFrame:
    """About these shares of the toxic and of the other rows: (text, toxic).

    A row is drawn by its content and its number among equal rows, so copies do not come together, and the same rows come back however the
    files are split. Equal rows are counted, not collected; only the drawn ones are sent to all executors, and their texts are taken once.
    """
    most = 1 << 30
    equal = ["doc_id", "__hash", "toxic"]
    hashed = rows.select("doc_id", "text", "toxic", F.xxhash64("text").alias("__hash"))
    limit = F.when(F.col("toxic") == 1, int(toxic * most)).otherwise(int(other * most))
    counted = hashed.groupBy(*equal).agg(F.count("*").alias("n"))
    drawn = F.filter(F.sequence(F.lit(1), F.col("n")), lambda k: F.pmod(F.xxhash64("doc_id", "__hash", k, F.lit("sample")), F.lit(most)) < limit)
    picked = counted.withColumn("times", F.size(drawn)).where("times > 0").select(*equal, "times")
    once = hashed.join(F.broadcast(picked), equal).groupBy(*equal).agg(F.first("text").alias("text"), F.first("times").alias("times"))
    return once.select("text", "toxic", F.explode(F.sequence(F.lit(1), F.col("times")))).select("text", "toxic")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the documents that ``labels`` marks. Without both kinds of label every score is the share of toxic ones, or 0."""
    rows = training_rows(docs, labels)
    toxic, other, n_toxic, n_other = _counts(rows)
    if not n_toxic or not n_other:
        return Model(np.zeros(BUCKETS, dtype=np.float32), 50.0 if n_toxic else -50.0)
    ratio = ratios(toxic, other, n_toxic, n_other)
    told = np.flatnonzero(ratio)
    take = {1: min(n_toxic, sample // 2)}
    take[0] = min(n_other, sample - take[1])
    share = {1: take[1] / n_toxic, 0: take[0] / n_other}
    mask = ratio != 0

    def keep(batches):
        for batch in batches:
            found = [f[mask[f]].astype(np.int32) for f in _features(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.list_(pa.int32()))], names=["toxic", "buckets"])

    def learn(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        values, offsets = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int32)
        if table.num_rows:
            column = table["buckets"].chunk(0)
            values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
        found = [values[i:j] for i, j in zip(offsets[:-1], offsets[1:])]
        every = table["toxic"].to_numpy()
        order = sorted(range(len(found)), key=lambda i: (every[i], hashlib.md5(found[i].tobytes()).digest()))
        marks = every[order]
        weights, intercept = fit([found[i] for i in order], marks, ratio)
        # the sample holds more toxic texts than the corpus: take its odds back to those of all training rows
        odds = marks.sum() / max(1, (1 - marks).sum())
        intercept -= np.log(max(odds, 1e-9)) - np.log(n_toxic / n_other)
        return pa.table([pa.array([weights[told]], pa.list_(pa.float64())), pa.array([float(intercept)])], names=["weights", "intercept"])

    picked = sampled(rows, share[1], share[0]).mapInArrow(keep, StructType([StructField("toxic", IntegerType()), StructField("buckets", ArrayType(IntegerType()))]))
    fitted = picked.groupBy().applyInArrow(learn, StructType([StructField("weights", ArrayType(DoubleType())), StructField("intercept", DoubleType())])).first()
    weights = np.zeros(BUCKETS, dtype=np.float32)
    weights[told] = fitted["weights"]
    return Model(weights, fitted["intercept"])


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``df`` with ``toxicity`` from 0 to 1. Null is empty text; repeated rows are scored each on its own."""
    df = df.drop("toxicity")

    def run(batches):
        for batch in batches:
            scores = [model.score(found) for found in _features(batch.column(text))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "toxicity"])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField("toxicity", DoubleType())]))
