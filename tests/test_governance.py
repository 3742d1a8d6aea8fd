"""Entitlements, audiences, enrichment and the query log."""
from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from regulus.contract import AUDIT_SCHEMA
from regulus.operators import audit, governance as g
from regulus.streaming import audit_log, enrichment


def test_unknown_groups_grant_nothing(spark):
    members = spark.createDataFrame(
        [("a", "public"), ("a", "ghost"), ("b", "ghost"), ("c", "executive"), ("c", "ct-analysts")],
        "user_name string, group_name string")
    got = {r["user_name"]: r for r in g.effective_entitlements(members, g.entitlements(spark)).collect()}
    assert got["b"]["groups"] == [] and got["b"]["processes"] == [] and got["b"]["row_limit"] == 0
    assert len(got["a"]["indicators"]) == 6 and not got["a"]["can_export"]
    assert got["c"]["indicators"] == ["*"] and got["c"]["full_dashboard"] and got["c"]["can_export"]
    assert got["c"]["row_limit"] == 250_000 and got["c"]["processes"] == ["CT", "GMP", "MA"]


def test_role_without_tenant_is_an_error(spark):
    schema = "tenant string, role string, user_name string, enabled boolean"
    fine = spark.createDataFrame([("t1", "analyst", "u1", True), ("t1", "analyst", "u2", False),
                                  (None, "visitor", "u3", True)], schema)
    assert [r["user_name"] for r in g.tenant_roles(fine).collect()] == ["u1"]
    bad = spark.createDataFrame([(None, "analyst", "u1", True)], schema)
    with pytest.raises(Exception, match="role without tenant"):
        g.tenant_roles(bad).collect()


def test_products_are_denied_by_default(spark):
    roles = spark.createDataFrame([("u", "business_user"), ("v", "guest")], "user_name string, role string")
    got = {(r["user_name"], r["product"]) for r in
           g.readable_products(roles, g.product_audience(spark)).collect()}
    assert len(got) == 4 and ("u", "quality_metrics") not in got


def test_redaction_and_masking(spark):
    row = spark.range(1).select(F.create_map(
        F.lit("db_Password"), F.lit("x"), F.lit("TOKEN_a"), F.lit("y"), F.lit("name"), F.lit("z")).alias("m"))
    safe = row.select(g.redact_secrets("m").alias("m")).first()["m"]
    assert safe == {"db_Password": "***redacted***", "TOKEN_a": "***redacted***", "name": "z"}
    process = spark.range(1).select(g.process_of_table(F.lit("fact_gmp_steps")).alias("a"),
                                    g.process_of_table(F.lit("dim_x")).alias("b")).first()
    assert tuple(process) == ("GMP", None)


def test_sandbox_plan_keeps_the_published_order(spark):
    day = 86_400_000
    items = spark.createDataFrame([
        ("s", "old", "TABLE", 50.0, 0), ("s", "b", "TABLE", 60.0, 50 * day), ("s", "c", "TABLE", 60.0, 51 * day),
        ("s", "d", "TABLE", 60.0, 52 * day), ("s", "v", "VIEW", 0.0, None)],
        "schema_name string, name string, kind string, megabytes double, last_changed bigint")
    plan = {r["name"]: r["reason"] for r in g.sandbox_plan(items, 60 * day, 30, 150.0).collect()}
    # the total of 230 still counts the old table, so two more go
    assert plan == {"old": "untouched", "b": "over quota", "c": "over quota"}


def test_enrichment_gives_one_row_per_entity(spark, tmp_path):
    def lookup(entity):
        if entity == "e3":
            raise ConnectionError("down")
        if entity == "e4":
            time.sleep(1.0)
        return {"legal_name": f"Name {entity}", "country": "X", "risk_tier": "low", "registry_status": "active"}

    apps = spark.createDataFrame([(f"e{i % 40}",) for i in range(200)], "entity_id string")
    path = str(tmp_path / "enrichment")
    none = spark.createDataFrame([], "entity_id string")
    first = enrichment.pending(apps, none)
    rows = enrichment.enrich(first, lookup, partitions=2, concurrency=8, attempts=2, timeout=0.3, pause=0.01)
    enrichment.append(rows, path, "run-1")
    stored = spark.read.parquet(path)
    assert stored.count() == stored.select("entity_id").distinct().count() == 40
    assert {r["status"]: r["entities"] for r in enrichment.statuses(stored).collect()} == {
        "enriched": 38, "unavailable": 2}
    assert stored.filter("status = 'unavailable' AND legal_name IS NULL").count() == 2
    assert enrichment.pending(apps, stored).isEmpty()
    more = apps.unionByName(spark.createDataFrame([("e99",)], "entity_id string"))
    again = enrichment.enrich(enrichment.pending(more, stored), lookup, partitions=1)
    enrichment.append(again, path, "run-2")
    assert spark.read.parquet(path).count() == 41


EVENTS = [
    '{"metadata":{"queryId":"q1","query":"select 1"},"context":{"user":"alice","principal":"admin"},'
    '"statistics":{"cpuTime":1.5,"outputRows":7},"endTime":"2026-01-02T03:04:05.123456Z",'
    '"ioMetadata":{"inputs":[{"catalogName":"c","schema":"s","table":"b"},{"catalogName":"c","schema":"s","table":"a"},'
    '{"catalogName":"c","schema":"s","table":"a"},{"catalogName":"c","schema":"s"}]}}',
    '{"metadata":{"queryId":"q2"},"failureInfo":{"errorCode":{"name":"DENIED"}},"endTime":"2026-01-02T04:00:00Z"}',
    '{"metadata":{"queryId":"q3","queryState":"CANCELED"},"errorCode":"LIMIT","endTime":"2026-01-03T04:00:00Z"}',
]


def test_audit_projection(spark):
    events = spark.createDataFrame([(e,) for e in EVENTS], "payload string")
    rows = {r["query_id"]: r for r in audit.audit_rows(events).collect()}
    q1, q2, q3 = rows["q1"], rows["q2"], rows["q3"]
    assert (q1["username"], q1["principal"], q1["state"], q1["cpu_ms"]) == ("alice", "admin", "FINISHED", 1500)
    assert (q1["tables_accessed"], q1["event_time"]) == ("c.s.a,c.s.b", "2026-01-02 03:04:05.123456")
    assert (q2["state"], q2["error_code"], q2["query_text"]) == ("FAILED", "DENIED", "")
    assert (q3["state"], q3["error_code"], q3["audit_day"]) == ("CANCELED", "LIMIT", "2026-01-03")


def test_audit_stream(spark, tmp_path):
    src, root = tmp_path / "in", str(tmp_path / "log")
    for k, e in enumerate(EVENTS):
        spark.createDataFrame([(e,)], "payload string").coalesce(1).write.mode("append").text(f"{src}/f{k}")
    stream = spark.readStream.schema("payload string").option("maxFilesPerTrigger", 1).text(f"{src}/*")
    for _ in range(2):
        audit_log.start_audit(stream, root, str(tmp_path / "ck")).awaitTermination()
    assert audit_log.read_audit(spark, root).count() == 3
    assert spark.read.parquet(f"{root}/raw/run=*/batch=*").count() == 3
    # a batch from before a column existed
    old = audit_log.read_audit(spark, root).drop("principal").withColumn("query_id", F.lit("old"))
    old.write.partitionBy("audit_day").parquet(f"{root}/audit/run=old/batch=0")
    rows = audit_log.read_audit(spark, root)
    assert rows.columns == AUDIT_SCHEMA.fieldNames()
    assert rows.filter("query_id = 'old' AND principal IS NULL").count() == 3
