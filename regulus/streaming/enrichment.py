"""Incremental lookup of entities that have no enrichment row yet."""
from __future__ import annotations

import queue
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regulus.contract import ENRICHMENT_SCHEMA

Lookup = Callable[[str], dict]
PAYLOAD = ("legal_name", "country", "risk_tier", "registry_status")


def pending(applications: DataFrame, enrichment: DataFrame, limit: int | None = None) -> DataFrame:
    """Distinct entities without an enrichment row; ``limit`` bounds one run."""
    rows = applications.select("entity_id").distinct().join(
        enrichment.select("entity_id"), "entity_id", "left_anti")
    return rows if limit is None else rows.limit(limit)


def call(lookup: Lookup, entity: str, timeout: float) -> dict:
    """One call with its clock started together with it. A call that never returns is left behind in a daemon thread."""
    answers: queue.SimpleQueue = queue.SimpleQueue()

    def ask() -> None:
        try:
            answers.put((lookup(entity), None))
        except BaseException as error:  # handed to the caller below
            answers.put((None, error))

    threading.Thread(target=ask, daemon=True).start()
    try:
        answer, error = answers.get(timeout=timeout)
    except queue.Empty:
        raise TimeoutError(entity) from None
    if error is not None:
        raise error
    return answer


def enrich(entities: DataFrame, lookup: Lookup, partitions: int, concurrency: int = 16,
           attempts: int = 3, timeout: float = 2.0, pause: float = 0.2) -> DataFrame:
    """One row per entity: the answer, or ``unavailable`` after the last attempt.

    Lookups run at most ``concurrency`` at a time in each of ``partitions`` tasks. An entity that
    cannot be reached gives a row, so it does not stop the others and is not asked for ever; a call
    that hangs holds up neither the entities behind it nor the end of the task.
    """
    def ask(entity: str) -> dict:
        started = time.monotonic()
        for attempt in range(attempts):
            try:
                answer = call(lookup, entity, timeout)
                return {**{k: answer.get(k) for k in PAYLOAD}, "status": "enriched",
                        "source_latency_ms": int((time.monotonic() - started) * 1000)}
            except (TimeoutError, ConnectionError):
                if attempt + 1 < attempts:
                    time.sleep(pause * 2 ** attempt)
        return {**dict.fromkeys(PAYLOAD), "status": "unavailable",
                "source_latency_ms": int((time.monotonic() - started) * 1000)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(concurrency) as pool:
            for batch in batches:
                rows = list(pool.map(lambda e: {"entity_id": e, **ask(e)}, list(batch["entity_id"])))
                frame = pd.DataFrame(rows, columns=[f for f in ENRICHMENT_SCHEMA.fieldNames()
                                                    if f != "enriched_at"])
                frame["enriched_at"] = pd.Timestamp(datetime.now(timezone.utc))
                yield frame[ENRICHMENT_SCHEMA.fieldNames()]

    # The ids are distinct, so dealing them out evenly gives every task the same number of calls.
    return entities.select("entity_id").repartition(partitions).mapInPandas(
        run, schema=ENRICHMENT_SCHEMA)


def append(rows: DataFrame, path: str, run_id: str) -> None:
    """Add the rows of one run; the same run written again replaces itself."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
        f"{path}/run_id={run_id}")


def statuses(enrichment: DataFrame) -> DataFrame:
    return enrichment.groupBy("status").agg(F.count(F.lit(1)).alias("entities"))
