"""Entitled exports: filtered, capped, written as CSV."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Values of the hash by which the rows of a page are counted.
SLOTS_A_PAGE = 64
BOM = "﻿"


class TooManyRows(ValueError):
    """The result is larger than the caller may read at once."""


def guarded(df: DataFrame, limit: int) -> DataFrame:
    """The frame, or an error when it has more than ``limit`` rows; reads at most one row more."""
    if df.limit(limit + 1).count() > limit:
        raise TooManyRows(f"more than {limit} rows; narrow the range")
    return df


def guarded_pages(df: DataFrame, limit: int, by: str) -> list[DataFrame]:
    """All rows of the frame, in pages that each pass the guard.

    Rows are counted per hash of ``by``, and neighbouring hashes share a page as long as it keeps the limit. Rows of one value are never
    parted, so more of them than the limit are refused.
    """
    rows = df.count()
    if rows <= limit:
        return [guarded(df, limit)]
    slots = F.pmod(F.xxhash64(by), F.lit(SLOTS_A_PAGE * -(-rows // limit)))
    pages, held = [], limit
    for slot, n in sorted((r["slot"], r["n"]) for r in df.groupBy(slots.alias("slot")).agg(F.count(F.lit(1)).alias("n")).collect()):
        if n > limit:
            raise TooManyRows(f"more than {limit} rows; narrow the range")
        if held + n > limit:
            pages.append([slot, slot])
            held = 0
        pages[-1][1] = slot
        held += n
    return [df.filter(slots.between(first, last)) for first, last in pages]


def export_rows(df: DataFrame, layer: str, since: str, limit: int, row_limit: int) -> DataFrame:
    """The first rows in a fixed order, at most the requested and the permitted number; bronze has no cohort to filter on."""
    cap = min(limit, row_limit or 0)
    if cap <= 0:
        raise PermissionError("no export entitlement")
    rows = df if layer == "bronze" else df.filter(F.col("cohort_month") >= since)
    order = [c for c in ("cohort_month", "record_id", "ingest_day", "partition", "offset") if c in rows.columns]
    return rows.orderBy(*order).limit(cap) if order else rows.limit(cap)


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header in UTF-8 with byte order mark, which rides on the first column name.

    An export is capped before it is written, so one task can hold it.
    """
    first, *rest = df.columns
    df.select(F.col(first).alias(BOM + first), *rest).coalesce(1).write.mode("overwrite").option(
        "header", True).option("encoding", "UTF-8").csv(path)
