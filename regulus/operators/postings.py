"""Keyword search over an inverted index: a search reads postings and no texts."""
from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Folders of the index; a term lies in the one that its checksum names.
BUCKETS = 64
#: Postings of the rarest term up to which they are sent to all tasks.
MOST_SENT = 200_000
WORD = r"[\p{L}\p{N}]+"


def bucket_of(term: Column, buckets: int = BUCKETS) -> Column:
    return (F.crc32(term.cast("binary")) % buckets).cast("int")


def postings(texts: DataFrame, key: str, text: str, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, term, key, occurrences) of every word of every text, in lower case.

    Words are counted within their text before they move. Stored by bucket and sorted by term, a term is a few row groups of one folder.
    A null or empty text has none; rows of one key count together.
    """
    words = texts.select(key, F.explode(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))).alias("term"))
    counted = words.groupBy(key, "term").agg(F.count(F.lit(1)).alias("occurrences"))
    return counted.select(bucket_of(F.col("term"), buckets).alias("bucket"), "term", key, "occurrences")


def frequencies(index: DataFrame) -> DataFrame:
    """(bucket, term, documents): in how many texts a term stands."""
    return index.groupBy("bucket", "term").agg(F.count(F.lit(1)).alias("documents"))


def _of(table: DataFrame, term: str, buckets: int) -> DataFrame:
    return table.filter((F.col("bucket") == zlib.crc32(term.encode()) % buckets) & (F.col("term") == term))


def search(index: DataFrame, documents: DataFrame, terms: list[str], key: str, buckets: int = BUCKETS) -> DataFrame:
    """(key, score): the texts that hold every term as a word, and the number of their occurrences.

    ``index`` and ``documents`` are what ``postings`` and ``frequencies`` gave. The postings are intersected from the rarest term on; as
    long as the rarest term's are few they are sent to all tasks, so that a common term's are filtered and not shuffled. A term that is
    not one word occurs nowhere, and no term asks for nothing.
    """
    wanted = sorted({t.lower() for t in terms})
    nothing = index.select(key, F.col("occurrences").alias("score")).limit(0)
    if not wanted or not all(t.isalnum() for t in wanted):
        return nothing
    known = documents.filter(F.col("bucket").isin([zlib.crc32(t.encode()) % buckets for t in wanted]) & F.col("term").isin(wanted))
    n = {r["term"]: r["documents"] for r in known.collect()}
    if len(n) < len(wanted):
        return nothing
    wanted.sort(key=lambda t: (n[t], t))
    few = n[wanted[0]] <= MOST_SENT
    found = _of(index, wanted[0], buckets).select(key, F.col("occurrences").alias("score"))
    for term in wanted[1:]:
        more = _of(index, term, buckets).select(key, "occurrences")
        found = more.join(F.broadcast(found) if few else found, key).select(key, (F.col("score") + F.col("occurrences")).alias("score"))
    return found
