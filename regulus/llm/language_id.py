"""Language identification by error-correcting output codes over character n-grams.

Every language has a codeword. For each bit a binary classifier, linear in the hashed n-grams that a text holds, separates the languages
with a 1 from those with a 0: a weight is the log ratio of an n-gram's mean frequencies on both sides, counted over all training texts,
and the margin is scaled by the means and the spread that all training texts show. A text gets the language whose codeword costs
least: the logistic losses of its bits, each weighted by how well its classifier does on that language. A text whose second
codeword costs little more, or whose bits are further from the first than the code corrects, is ambiguous.
"""
from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from regulus.llm.store import written

#: Lengths of the n-grams in characters, and buckets.
LENGTHS, BUCKETS = (1, 2, 3, 4), 1 << 16
#: An n-gram in fewer training texts tells nothing; what is added to the counts of a language.
LEAST_TEXTS, ADDED = 2, 0.5
#: Up to so many languages the code has every split of them, beyond it so many bits.
ALL_SPLITS, BITS = 6, 63
#: A text is ambiguous when the second language's share is above this part of the first's.
CLOSE = 0.5
UNKNOWN = "und"

#: Characters of a text handled at once, and languages counted at once by a task.
_PIECE, _LANGUAGES = 1 << 20, 32
_IS_LETTER: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _IS_LETTER
    if _IS_LETTER is None:
        _IS_LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _IS_LETTER


def features(text: str | None, seen: np.ndarray) -> np.ndarray | None:
    """The buckets of a text's n-grams, each once; None without a letter. Anything but a letter counts as a space.

    ``seen``: a cleared array of BUCKETS flags, cleared again on return.
    """
    code = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _is_letter()[code]
    if not letter.any():
        return None
    code = np.where(letter, code, np.uint32(32))
    longest = max(LENGTHS)
    for k in range(0, len(code), _PIECE):
        part = code[k:k + _PIECE + longest - 1]
        rolled = np.zeros(len(part), dtype=np.uint32)
        for n in range(1, min(longest, len(part)) + 1):
            rolled = rolled[:len(part) - n + 1] * np.uint32(0x9E3779B1) + part[n - 1:]
            if n in LENGTHS:
                seen[((rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(16)] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


def codebook(languages: int) -> np.ndarray:
    """A codeword of zeros and ones for each language, as rows."""
    if languages < 2:
        return np.zeros((languages, 0), dtype=np.int8)
    if languages <= ALL_SPLITS:
        # the first language has ones only, the others take every combination but that
        splits = np.arange(2 ** (languages - 1) - 1)
        rows = [np.ones_like(splits)] + [splits >> k & 1 for k in range(languages - 1)]
        return np.array(rows, dtype=np.int8)
    best, distance = None, -1
    for seed in range(64 if languages <= 512 else 1):
        code = np.random.default_rng(seed).integers(0, 2, (languages, BITS), dtype=np.int8)
        code[0], code[1] = np.where(code.all(axis=0), 0, code[0]), np.where(~code.any(axis=0), 1, code[1])
        signs = 2 * code.astype(np.int32) - 1
        apart = (BITS - (signs @ signs.T - 2 * BITS * np.eye(languages, dtype=np.int32)).max()) // 2 if languages <= 512 else 0
        if apart > distance:
            best, distance = code, apart
    return best


def distance_of(code: np.ndarray) -> int:
    """The least distance between two codewords."""
    return min((int((a != b).sum()) for i, a in enumerate(code) for b in code[:i]), default=0)


class Model(NamedTuple):
    languages: list[str]   # ascending
    code: np.ndarray       # languages x bits
    weights: np.ndarray    # BUCKETS x bits
    scale: np.ndarray      # of the margin of each bit
    shift: np.ndarray
    trust: np.ndarray      # languages x bits, each row of sum 1: how much a bit counts for a language
    corrects: int          # wrong bits that the code corrects

    def margins(self, found: np.ndarray) -> np.ndarray:
        return raw_margins(self.weights, found) * self.scale + self.shift

    def decode(self, found: np.ndarray | None) -> tuple[str, float, str | None, bool]:
        """Language, its share, the second language and whether the choice is ambiguous."""
        if found is None or not self.languages:
            return UNKNOWN, 0.0, None, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, None, False
        margin = self.margins(found)
        signs = 2.0 * self.code - 1.0
        bits = self.code.shape[1]
        loss = (self.trust * np.logaddexp(0.0, -signs * margin)).sum(axis=1) * bits
        share = np.exp(loss.min() - loss)
        share /= share.sum()
        order = np.lexsort((np.arange(len(share)), loss))
        first, second = int(order[0]), int(order[1])
        wrong = int(((margin > 0) != (self.code[first] > 0)).sum())
        return (self.languages[first], float(share[first]), self.languages[second],
                bool(share[second] > CLOSE * share[first] or wrong > self.corrects))


def raw_margins(weights: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Sums of weights over the root of the number of n-grams, for every bit."""
    return weights[found].sum(axis=0, dtype=np.float64) / math.sqrt(len(found))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document may not be learnt from. A row without an id is never learnt from, yet not counted as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame) -> DataFrame:
    """(text, lang) of the documents that may be learnt from."""
    return docs.where("doc_id is not null and lang is not null and text is not null").where(~held_out()).select("text", "lang")


def _counts(rows: DataFrame, languages: list[str]) -> DataFrame:
    """(language, bucket, n): texts with the n-gram; bucket BUCKETS has the texts themselves. Texts without a letter teach nothing."""
    place = {name: i for i, name in enumerate(languages)}

    def run(batches):
        held: dict[int, np.ndarray] = {}
        seen = np.zeros(BUCKETS, dtype=bool)

        def flushed():
            for language, own in held.items():
                used = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), language, dtype=np.int32)), pa.array(used.astype(np.int32)), pa.array(own[used])],
                                                 names=["language", "bucket", "n"])
            held.clear()

        for batch in batches:
            texts = batch.column("text")
            for i, lang in enumerate(batch.column("lang").to_pylist()):
                found = features(texts[i].as_py(), seen)
                if found is None:
                    continue
                language = place[lang]
                if language not in held:
                    if len(held) == _LANGUAGES:
                        yield from flushed()
                    held[language] = np.zeros(BUCKETS + 1, dtype=np.int64)
                held[language][found] += 1
                held[language][BUCKETS] += 1
        yield from flushed()

    return rows.mapInArrow(run, "language int, bucket int, n long").groupBy("language", "bucket").agg(F.sum("n").alias("n"))


def _weights(counts: DataFrame, code: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weight of every bucket in every bit: the log ratio of its mean frequency among the languages with a 1 and those with a 0.

    The counts are added up bit by bit in Spark, so the driver gets two numbers for each bucket and bit, however many languages there are.
    """
    bits = code.shape[1]
    spark = counts.sparkSession
    table = spark.createDataFrame([(i, 1.0 / int(n[i]), [float(b) for b in code[i]]) for i in range(len(n)) if n[i]], "language int, part double, code array<double>")
    joined = counts.where(F.col("bucket") < BUCKETS).join(F.broadcast(table), "language")
    # parts of 2^40, so that the sums are whole numbers and do not depend on their order
    part = F.round(F.col("n") * F.col("part") * float(1 << 40)).cast("long")
    got = joined.groupBy("bucket").agg(
        F.sum("n").alias("texts"), F.sum(part).alias("all"),
        *[F.sum(part * F.col("code")[b].cast("long")).alias(f"one{b}") for b in range(bits)]).toArrow()
    bucket = got["bucket"].to_numpy()
    # a bucket that a language does not have adds nothing to its mean but what is added to all
    least = np.array([ADDED / max(1, x) for x in n])
    out = np.zeros((BUCKETS, bits), dtype=np.float32)
    enough = got["texts"].to_numpy() >= LEAST_TEXTS
    for b in range(bits):
        one = got[f"one{b}"].to_numpy() / (1 << 40)
        zero = got["all"].to_numpy() / (1 << 40) - one
        side = code[:, b] > 0
        ratio = np.log((one + least[side].sum()) / side.sum()) - np.log((zero + least[~side].sum()) / (~side).sum())
        out[bucket, b] = np.where(enough, ratio, 0.0)
    return out


def _spread(rows: DataFrame, languages: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and variance of the raw margin of every bit over all training texts of every language."""
    place = {name: i for i, name in enumerate(languages)}
    bits = weights.shape[1]

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        seen = np.zeros(BUCKETS, dtype=bool)
        for batch in batches:
            texts = batch.column("text")
            for i, lang in enumerate(batch.column("lang").to_pylist()):
                found = features(texts[i].as_py(), seen)
                if found is not None:
                    # in 4096ths: whole numbers, whose sums do not depend on the order of the texts
                    z = np.round(raw_margins(weights, found) * 4096).astype(np.int64)
                    own = sums.setdefault(place[lang], np.zeros((3, bits), dtype=np.int64))
                    own += np.stack([np.ones_like(z), z, z * z])
        out = [(language, b, *own[:, b].tolist()) for language, own in sums.items() for b in range(bits)]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                                         names=["language", "bit", "n", "z", "zz"])

    # the sum of squares may pass the long of a whole corpus
    got = (rows.mapInArrow(run, "language int, bit int, n long, z long, zz long").groupBy("language", "bit")
           .agg(F.sum("n").alias("n"), F.sum("z").alias("z"), F.sum(F.col("zz").cast("decimal(38,0)")).alias("zz")).collect())
    mean, variance = np.zeros((len(languages), bits)), np.ones((len(languages), bits))
    for r in got:
        mean[r.language, r.bit] = r.z / r.n / 4096
        variance[r.language, r.bit] = max(0.0, float(r.zz) / r.n / 4096 ** 2 - mean[r.language, r.bit] ** 2)
    return mean, variance


def calibrated(code: np.ndarray, mean: np.ndarray, variance: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scale and shift of every bit's margin, and the trust of every language in every bit.

    A margin is read as normal on both sides with one spread: its log odds are linear. Trust is the chance of the right sign.
    """
    side = code > 0
    one = np.array([mean[side[:, b], b].mean() for b in range(code.shape[1])])
    zero = np.array([mean[~side[:, b], b].mean() for b in range(code.shape[1])])
    within = variance.mean(axis=0) + 1e-2
    scale = (one - zero) / within
    shift = -scale * (one + zero) / 2
    z = (2.0 * code - 1.0) * (mean * scale + shift) / np.sqrt((variance + 1e-2) * scale ** 2 + 1e-12)
    trust = 0.5 * (1 + np.vectorize(math.erf)(z / math.sqrt(2))) + 1e-3
    return scale, shift, trust / trust.sum(axis=1, keepdims=True)


def train(docs: DataFrame) -> Model:
    """A model from doc_id, text and lang of the documents that are not held out; the languages are those with a text with a letter.

    Repeated rows count each. Without any language every text is unknown, with one only every text with a letter has it. Languages are
    taken to be a small set of codes: one row for each goes through the driver.
    """
    rows = training_rows(docs)
    names = sorted(r.lang for r in rows.select("lang").distinct().collect())
    counts = written(_counts(rows, names), "language-counts")
    n = np.zeros(len(names), dtype=np.int64)
    for r in counts.where(F.col("bucket") == BUCKETS).collect():
        n[r.language] = r.n
    if (n == 0).any():  # their texts have no letter
        left = [name for name, k in zip(names, n) if k]
        number = {name: i for i, name in enumerate(left)}
        renamed = docs.sparkSession.createDataFrame([(names.index(x), i) for x, i in number.items()], "language int, new int")
        counts = counts.join(F.broadcast(renamed), "language").select(F.col("new").alias("language"), "bucket", "n")
        rows, names, n = rows.where(F.col("lang").isin(left)), left, n[n > 0]
    code = codebook(len(names))
    if len(names) < 2:
        return Model(names, code, np.zeros((BUCKETS, 0), dtype=np.float32), np.zeros(0), np.zeros(0), np.zeros(code.shape), 0)
    weights = _weights(counts, code, n)
    scale, shift, trust = calibrated(code, *_spread(rows, names, weights))
    return Model(names, code, weights, scale, shift, trust, max(0, (distance_of(code) - 1) // 2))


OUT = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("second", StringType()),
                  StructField("ambiguous", BooleanType())])


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``df`` with lang_pred, score (its share, 0 to 1), second (the next language) and ambiguous.

    A null text, or one without a letter, is ``und`` with score 0 and ambiguous. Columns of these names that ``df`` has are replaced.
    Repeated rows get equal results; equal losses go to the language that sorts first.
    """
    df = df.drop(*[c for c in OUT.names if c != text])
    if text in OUT.names:
        raise ValueError(f"the text column may not be called {text}")

    def run(batches):
        seen = np.zeros(BUCKETS, dtype=bool)
        for batch in batches:
            column = batch.column(text)
            got = [model.decode(features(column[i].as_py(), seen)) for i in range(batch.num_rows)]
            new = [pa.array([g[k] for g in got], t) for k, t in enumerate((pa.string(), pa.float64(), pa.string(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *OUT.names])

    return df.mapInArrow(run, StructType([*df.schema.fields, *OUT.fields]))
