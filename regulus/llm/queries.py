"""The registered queries of this folder and the SQL of those that SQL can express."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regulus.llm.binary_output import records_of
from regulus.llm.hard_negatives import labelled_vectors, mine
from regulus.llm.html_extraction import extract
from regulus.llm.jaccard_join import similar
from regulus.llm.language_id import held_out as not_learnt
from regulus.llm.language_id import identify
from regulus.llm.language_id import train as language_model
from regulus.llm.lexical_search import search
from regulus.llm.mixing import mix
from regulus.llm.packing import pack
from regulus.llm.quality_rules import STOP_WORDS, quality
from regulus.llm.secret_scan import BASE_RULES, find_secrets, joined_spans, n_of
from regulus.llm.store import table
from regulus.llm.substring_dedup import without_repeats
from regulus.llm.topk_search import top_k, whole_vectors
from regulus.llm.toxicity import THRESHOLD, held_out, score, train

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def wrap(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return wrap


_QUALITY_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
win AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
        FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep CROSS JOIN (VALUES (0), (1), (2)) AS v(k) GROUP BY rid),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             CAST(len(list_filter(w, lambda x: x IN ({stop}))) AS BIGINT) AS n_stop,
             CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN cov USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars >= 2 * n_words AND word_chars <= 20 * n_words AND 10 * n_symbols <= n_words
       AND 50 * n_stop >= n_words AND 2 * n_dup_lines <= n_lines AS kept
FROM b
"""


@query("op9_quality_rules", _QUALITY_SQL.replace("{stop}", ", ".join(f"'{x}'" for x in sorted(set(STOP_WORDS)))))
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and verdict of every document."""
    return quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op3_secret_scans")
def secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; the base digest covers the three base kinds only."""
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = tuple(r.kind for r in BASE_RULES)
    return found.select(
        "doc_id", *[n_of(kind).alias(f"n_{kind}") for kind in kinds],
        F.sha2(joined_spans("secrets", kinds), 256).alias("base_sha256"), joined_spans("secrets").alias("spans"))


@query("op6_mixing")
def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: how many words of each it takes."""
    return mix(table(spark, sf_dir, "documents"), carry=("doc_id",)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


@query("op5_packing")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document, and where it is packed."""
    return pack(table(spark, sf_dir, "documents"))


@query("op10_binary_output")
def binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's record, read back from the files."""
    return records_of(table(spark, sf_dir, "documents"))


@query("op8_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = score(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), F.col("toxicity").alias("score"),
                         (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"))


_TOP_K_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


@query("op4_topk_search", _TOP_K_SQL)
def topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best neighbours of every fiftieth vector."""
    vectors = whole_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors.where("vec_id % 50 = 0"), vectors)


@query("op7_ngram_jaccard_join")
def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near copies and the number of its links."""
    return similar(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


_REPEATS_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT rid, i, array_to_string(w[i:i + 34], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY g) AS c FROM win) WHERE c > 1),
gone AS (SELECT DISTINCT rid, i + k AS p FROM rep CROSS JOIN range(35) AS r(k)),
words AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""


@query("op2_substring_dedup", _REPEATS_SQL)
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages that stand elsewhere too."""
    return without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op1_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


_SEARCH_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (SELECT row_number() OVER () AS iid, item_id, unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
      FROM benchmark),
c AS (SELECT count(*) AS nn, sum(len(w)) AS ll FROM d WHERE len(w) > 0),
m AS (SELECT rid, doc_id, 50 + (50 * len(w) * nn) // ll AS m FROM d, c WHERE len(w) > 0),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) GROUP BY rid, term),
df AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, c GROUP BY term),
s AS (SELECT iid, item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS score
      FROM q JOIN df USING (term) JOIN tf USING (term) JOIN m USING (rid) GROUP BY iid, item_id, rid, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 50
"""


@query("op13_lexical_search", _SEARCH_SQL)
def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), language_model(docs))
    return found.select("doc_id", not_learnt().alias("held_out"), "lang_pred", "score", "second", "ambiguous")


_NEGATIVES_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.x, c.x) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same) WHERE place <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.place ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


@query("op11_hard_negatives", _NEGATIVES_SQL)
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every fiftieth vector; labels of every seventh are shifted by one."""
    vectors = labelled_vectors(table(spark, sf_dir, "embeddings"))
    vectors = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine(vectors.where("vec_id % 50 = 0"), vectors)
