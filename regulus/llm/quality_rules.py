"""Quality rules as one projection of built-in functions.

Every measure is a column expression over the words and lines of a text, and the table of limits is compiled into a single verdict
expression. No user function runs: the plan has no Python, no shuffle and no join.
"""
from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Frequent words of English, Spanish, French and German.
STOP_WORDS = (
    "the of and a to in is that for it as was with on be by this are from or an at not which have has you he they we "
    "de la el en y que los se del las un una por con para es su al lo como "
    "le les des et du est dans pour sur pas par au ne qui avec ce "
    "der die das und den von mit zu ist im auf für ein eine nicht sich dem als auch"
).split()

#: measure: (least, most), None for no limit. A text is kept if all measures lie within their limits.
LIMITS: Mapping[str, tuple[float | None, float | None]] = {
    "n_words": (50, None),
    "repeat_ratio": (None, 0.5),
    "mean_word_length": (2, 20),
    "symbol_ratio": (None, 0.1),
    "stop_word_ratio": (0.02, None),
    "dup_line_ratio": (None, 0.5),
}

_SPACE = r"[\x20\x09-\x0D]"


def _measures(df: DataFrame, text: str) -> DataFrame:
    """Words, windows and counts, one projection after the other, so that no array is computed twice."""
    words = F.split(F.trim(F.col("__text"), F.lit(" \t\n\x0b\x0c\r")), _SPACE + "+")
    lines = F.filter(F.split(F.col("__text"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select("*", F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    df = df.select("*", F.when(F.col("__text").rlike(r"[^\x20\x09-\x0D]"), words).otherwise(F.array().cast("array<string>")).alias("__words"),
                   lines.alias("__lines"))
    word = lambda i, k: F.get(F.col("__words"), i + k)
    windows = F.transform(
        F.sequence(F.lit(0), F.size("__words") - 3),
        lambda i: F.struct(F.concat_ws(" ", word(i, 0), word(i, 1), word(i, 2)).alias("w"), i.alias("i")))
    df = df.select(
        "*",
        F.size("__words").cast("long").alias("__n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("__word_chars"),
        F.regexp_count(F.col("__text"), F.lit(r"[#*$%&|<>]")).cast("long").alias("__n_symbols"),
        F.size("__lines").cast("long").alias("__n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("__n_dup_lines"),
        F.size(F.filter("__words", lambda x: x.isin(STOP_WORDS))).cast("long").alias("__n_stop_words"),
        F.when(F.size("__words") > 3, F.sort_array(windows)).otherwise(F.array().cast("array<struct<w:string,i:int>>")).alias("__windows"),
    ).drop("__text", "__words", "__lines")
    at = lambda j: F.get(F.col("__windows"), j)["w"]
    twice = F.filter("__windows", lambda x, j: F.coalesce(x["w"] == at(j + 1), F.lit(False))
                     | F.coalesce((j > 0) & (x["w"] == at(F.greatest(j - 1, F.lit(0)))), F.lit(False)))
    df = df.select("*", F.transform(twice, lambda x: x["i"]).alias("__twice")).drop("__windows")
    covered = F.array_distinct(F.flatten(F.transform("__twice", lambda i: F.array(i, i + 1, i + 2))))
    return df.select("*", F.size(covered).cast("long").alias("__n_repeat_words")).drop("__twice")


def _within(measure: Column, least: float | None, most: float | None) -> Column:
    verdict = F.lit(True)
    if least is not None:
        verdict = verdict & (measure >= least)
    if most is not None:
        verdict = verdict & (measure <= most)
    return verdict


def quality(df: DataFrame, text: str = "text", limits: Mapping[str, tuple[float | None, float | None]] = LIMITS) -> DataFrame:
    """The rows of ``df`` with their measures, ``base_failed`` and ``kept``.

    Null text counts as empty; a text without words has ratios of 0 and fails. Repeated rows are judged each on its own; other columns
    pass through, except that a column named like a result is replaced. An empty table gives an empty table.
    """
    results = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "base_failed", "kept"]
    rest = [F.col(f"`{c}`") for c in df.columns if c not in results]
    measured = _measures(df, text)
    n = F.greatest(F.col("__n_words"), F.lit(1))
    ratios = {
        "n_words": F.col("__n_words"),
        "repeat_ratio": F.col("__n_repeat_words") / n,
        "mean_word_length": F.col("__word_chars") / n,
        "symbol_ratio": F.col("__n_symbols") / n,
        "stop_word_ratio": F.col("__n_stop_words") / n,
        "dup_line_ratio": F.col("__n_dup_lines") / F.greatest(F.col("__n_lines"), F.lit(1)),
    }
    verdict = reduce(lambda a, b: a & b, [_within(ratios[name], *bounds) for name, bounds in limits.items()], F.lit(True))
    failed = (F.col("__n_words") < 50) | (100 * F.col("__n_repeat_words") > 50 * F.col("__n_words"))
    return measured.select(
        *rest, *[F.col(f"__{c}").alias(c) for c in results[:7]],
        failed.alias("base_failed"), (~failed & verdict).alias("kept"))
