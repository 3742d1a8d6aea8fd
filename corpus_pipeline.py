"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regulus.llm.jaccard_join import one_of_each
from regulus.llm.mixing import mix
from regulus.llm.packing import pack
from regulus.llm.secret_scan import redact
from regulus.llm.store import table, written
from regulus.llm.toxicity import THRESHOLD, score, train

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, does not reject.

    A null or empty text is scored as such and stays, as does a document without an id, which teaches nothing. Repeated rows get one score
    each and go or stay together. Labels without a document, or without a value, teach nothing; without labels nothing is rejected.
    """
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).where(F.col("toxicity") < THRESHOLD).select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near copies.

    The row with the least doc_id stays, one without an id only where none has one, and of equal ids one. Null texts, and others without a
    word, are no copies of one another and all stay.
    """
    return one_of_each(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind and n_chars, which documents have, counted anew. A null text stays null; repeated rows stay."""
    return redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it.

    A null text, or one without a word, has no size and is never taken; a null source is a source of its own, the last one. Repeated rows are
    taken each on their own.
    """
    rows = docs.select("text", "source", F.struct(*docs.columns).alias("row"))
    taken = mix(rows, carry=("row",)).where("times > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("time"))
    return taken.select(*[F.col(f"row.{c}").alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence. A null text is empty; repeated rows are packed each; ids may be null."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity), ("n-gram Jaccard join", ngram_jaccard_join), ("secret scans", secret_scans),
    ("mixing sources to target weights", mixing), ("packing", packing)]
#: SQL cannot express the classifier, the balanced sample or the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
