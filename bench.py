"""Wall time of the headline queries: one JSON line.

Every query gets one warm-up run and then the median of three runs into a sink that discards rows.
``gold_build`` is the time to write the gold tables from the given tables once, after a warm-up on
the smallest tables; the other queries read those tables, as reports read a lakehouse.
``operational`` holds the two published operational numbers: looking up 321 entities in eight tasks
of three calls at a time (a call answers after 0.05 to 1.2 s and one in twenty fails), and erasing one entity
from the streamed tables.
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from regulus.plans import QUERIES  # noqa: E402
from regulus.plans.changes import streamed  # noqa: E402
from regulus.session import build_session  # noqa: E402
from regulus.sources import gold  # noqa: E402
from regulus.streaming.enrichment import enrich  # noqa: E402

HEADLINE = (
    "a01_kpi_quarterly", "a14_kpi_from_facts", "a09_application_throughput",
    "a10_turnaround_performance", "a11_delay_analysis", "a12_quality_metrics", "j03_rule_join",
    "w04_latest_state", "p02_quarantine", "a16_quarterly_volumes", "a18_step_performance",
    "a19_bottleneck_medians", "a42_backlog", "j02_enriched_applications", "g03_erasure_report",
    "a37_effective_entitlement", "s07_query_events", "l01_lineage_edges", "n02_impact_upstream",
    "n03_resolved_edges", "t14_stale_marking", "n07_all_terms_search")


ENTITIES = 321


def enrichment_seconds(spark) -> float:
    def lookup(entity: str) -> dict:
        import random
        import time as clock
        draw = random.Random(entity)
        clock.sleep(draw.uniform(0.05, 1.2))
        if draw.random() < 0.05:
            raise ConnectionError(entity)
        return {"legal_name": entity, "country": "X", "risk_tier": "low", "registry_status": "active"}

    entities = spark.range(ENTITIES).selectExpr("concat('entity-', id) AS entity_id")
    started = time.perf_counter()
    rows = enrich(entities, lookup, partitions=8, concurrency=3).count()  # 24 calls at a time
    assert rows == ENTITIES
    return time.perf_counter() - started


def erasure_seconds(spark, sf_dir: str) -> float:
    medallion, _ = streamed(spark, sf_dir)
    subject = medallion.silver(spark).select("entity_id").limit(1)
    started = time.perf_counter()
    medallion.erase(spark, subject)
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", master=f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    def build_gold(folder: str) -> float:
        started = time.perf_counter()
        for build in (gold.activities, gold.steps, gold.applications, gold.measurements):
            build(spark, folder)
        return time.perf_counter() - started

    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small) and small != sf_dir:
        build_gold(small)
    seconds = {"gold_build": round(build_gold(sf_dir), 3)}
    started = time.perf_counter()
    gold.history(spark, sf_dir)
    seconds["history_build"] = round(time.perf_counter() - started, 3)
    started = time.perf_counter()
    streamed(spark, sf_dir)
    seconds["stream_build"] = round(time.perf_counter() - started, 3)
    for name in HEADLINE:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    operational = {"enrichment_321_entities": round(enrichment_seconds(spark), 3)}
    operational["erasure_one_entity"] = round(erasure_seconds(spark, sf_dir), 3)
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds,
                      "operational": operational, "sf": os.path.basename(sf_dir)}))


if __name__ == "__main__":
    main()
