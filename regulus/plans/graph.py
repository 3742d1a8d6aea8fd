"""Lineage, impact, inventory, search and stage gates."""
from __future__ import annotations

from pyspark.sql import functions as F

from regulus.functions import columns as x
from regulus.operators import graph, inventory as inv, lineage, postings as post
from regulus.plans import oracle as o
from regulus.plans.registry import query
from regulus.sources import gold, tables

START_UP, START_DOWN = "region:1", "order:7"


def start(spark, urn):
    return spark.range(1).select(F.lit(urn).alias("urn"))


# ---- lineage ------------------------------------------------------------------------------------
def jobs(spark, d):
    """Job descriptions with nested inputs and outputs, one row per job.

    Every customer has an enrichment job and every order a publication job.
    """
    customer = tables.read(spark, d, "customer")
    k, n = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")

    def ds(namespace, name):
        return F.struct(F.lit(namespace).alias("namespace"), name.alias("name"))

    def source_field(namespace, name, field):
        return F.struct(F.lit(namespace).alias("namespace"), name.alias("name"),
                        F.lit(field).alias("field"))

    def column(name, kind, *fields):
        return F.struct(F.lit(name).alias("name"), F.lit(kind).alias("transformation"),
                        F.array(*fields).alias("input_fields"))

    def out(namespace, name, *columns):
        return F.struct(F.lit(namespace).alias("namespace"), name.alias("name"),
                        F.array(*columns).alias("columns"))

    c, nat = F.concat(F.lit("customer:"), k), F.concat(F.lit("nation:"), n)
    enrich = customer.select(
        F.concat(F.lit("enrich:"), k).alias("job"),
        F.array(ds("crm", c), ds("geo", nat)).alias("inputs"),
        F.array(out("lake", F.concat(F.lit("enriched:"), k),
                    column("legal_name", "IDENTITY", source_field("crm", c, "c_name")),
                    column("place", "AGGREGATION", source_field("crm", c, "c_nationkey"),
                           source_field("geo", nat, "n_name"))),
                out("lake", F.concat(F.lit("masked:"), k),
                    column("entity_id", "MASKING", source_field("crm", c, "c_custkey"))))
        .alias("outputs"))
    orders = tables.read(spark, d, "orders")
    ok, ck = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    mart = F.concat(F.lit("throughput:"), (F.col("o_orderkey") % 3).cast("string"))
    publish = orders.select(
        F.concat(F.lit("publish:"), ok).alias("job"),
        F.array(ds("lake", F.concat(F.lit("enriched:"), ck)),
                ds("intake", F.concat(F.lit("order:"), ok))).alias("inputs"),
        F.array(out("mart", mart, column("received", "AGGREGATION", source_field(
            "intake", F.concat(F.lit("order:"), ok), "o_orderdate")))).alias("outputs"))
    return enrich.unionByName(publish)


o.register("l_edges", """SELECT 'enrich:'||c_custkey AS job, i AS source, s AS sink FROM customer,
 LATERAL (SELECT unnest(['crm|customer:'||c_custkey, 'geo|nation:'||c_nationkey]) AS i) a,
 LATERAL (SELECT unnest(['lake|enriched:'||c_custkey, 'lake|masked:'||c_custkey]) AS s) b
 UNION ALL SELECT 'publish:'||o_orderkey, i, 'mart|throughput:'||(o_orderkey%3) FROM orders,
 LATERAL (SELECT unnest(['lake|enriched:'||o_custkey, 'intake|order:'||o_orderkey]) AS i) a""")


def edges(spark, d):
    return lineage.dataset_edges(jobs(spark, d))


@query("l01_lineage_edges", "SELECT * FROM l_edges")
def _(spark, d):
    return edges(spark, d)


@query("j15_edges_per_job", "SELECT job, count(*) AS edges FROM l_edges GROUP BY 1")
def _(spark, d):
    return edges(spark, d).groupBy("job").agg(F.count(F.lit(1)).alias("edges"))


@query("l02_trace_upstream", """WITH RECURSIVE t(dataset, level) AS (SELECT 'mart|throughput:1', 0 UNION SELECT e.source, t.level+1
 FROM l_edges e JOIN t ON e.sink=t.dataset WHERE t.level<8) SELECT dataset, CAST(min(level) AS INT) AS level FROM t GROUP BY 1 HAVING min(level)>0""")
def _(spark, d):
    begin = spark.range(1).select(F.lit("mart|throughput:1").alias("dataset"))
    return graph.trace(edges(spark, d), begin, "up")


@query("l02_trace_downstream", """WITH RECURSIVE t(dataset, level) AS (SELECT 'geo|nation:3', 0 UNION SELECT e.sink, t.level+1
 FROM l_edges e JOIN t ON e.source=t.dataset WHERE t.level<8) SELECT dataset, CAST(min(level) AS INT) AS level FROM t GROUP BY 1 HAVING min(level)>0""")
def _(spark, d):
    begin = spark.range(1).select(F.lit("geo|nation:3").alias("dataset"))
    return graph.trace(edges(spark, d), begin, "down")


@query("l03_orphan_datasets", """SELECT DISTINCT source AS dataset FROM l_edges WHERE source NOT IN (SELECT sink FROM l_edges)
 AND NOT starts_with(source,'intake|') AND NOT starts_with(source,'geo|')""")
def _(spark, d):
    """Consumed but never produced, with intake and geography declared as origins."""
    e = edges(spark, d)
    origins = e.filter(F.col("source").startswith("intake|") | F.col("source").startswith("geo|")
                       ).select(F.col("source").alias("dataset"))
    return lineage.orphan_datasets(e, origins)


@query("l03_missing_edges", """SELECT DISTINCT source, sink FROM l_edges WHERE starts_with(sink,'lake|masked')""")
def _(spark, d):
    """Declared edges against a published graph that lost the masked outputs."""
    e = edges(spark, d)
    return lineage.missing_edges(e, e.filter(~F.col("sink").startswith("lake|masked")))


@query("l04_column_lineage", """SELECT 'enrich:'||c_custkey AS job, 'lake|enriched:'||c_custkey AS sink, 'legal_name' AS target_column,
 'IDENTITY' AS transformation, 'crm|customer:'||c_custkey AS source, 'c_name' AS source_column FROM customer
 UNION ALL SELECT 'enrich:'||c_custkey, 'lake|enriched:'||c_custkey, 'place', 'AGGREGATION', 'crm|customer:'||c_custkey, 'c_nationkey' FROM customer
 UNION ALL SELECT 'enrich:'||c_custkey, 'lake|enriched:'||c_custkey, 'place', 'AGGREGATION', 'geo|nation:'||c_nationkey, 'n_name' FROM customer
 UNION ALL SELECT 'enrich:'||c_custkey, 'lake|masked:'||c_custkey, 'entity_id', 'MASKING', 'crm|customer:'||c_custkey, 'c_custkey' FROM customer
 UNION ALL SELECT 'publish:'||o_orderkey, 'mart|throughput:'||(o_orderkey%3), 'received', 'AGGREGATION', 'intake|order:'||o_orderkey, 'o_orderdate' FROM orders""")
def _(spark, d):
    return lineage.column_edges(jobs(spark, d))


_HASH = f"sha1(unhex('{x.URL_NAMESPACE}') || encode('lineage:' || job))"


@query("f14_stable_run_ids", f"""SELECT job, substr(h,1,8) || '-' || substr(h,9,4) || '-5' || substr(h,14,3) || '-' ||
 translate(substr(h,17,1),'0123456789abcdef','89ab89ab89ab89ab') || substr(h,18,3) || '-' || substr(h,21,12) AS run_id
 FROM (SELECT job, {_HASH} AS h FROM (SELECT DISTINCT job FROM l_edges))""")
def _(spark, d):
    return jobs(spark, d).select("job", x.name_uuid(F.concat(F.lit("lineage:"), "job")).alias("run_id"))


@query("l02_trace_edges", """WITH RECURSIVE t(dataset, level) AS (SELECT 'mart|throughput:1', 0 UNION SELECT e.source, t.level+1
 FROM l_edges e JOIN t ON e.sink=t.dataset WHERE t.level<8), n AS (SELECT dataset, CAST(min(level) AS INT) AS level FROM t GROUP BY 1)
 SELECT n.level, e.job, n.dataset AS node, e.source AS next FROM n JOIN l_edges e ON e.sink=n.dataset""")
def _(spark, d):
    begin = spark.range(1).select(F.lit("mart|throughput:1").alias("dataset"))
    return graph.trace_edges(edges(spark, d), begin, "up")


# ---- impact -------------------------------------------------------------------------------------
def _reach(begin, a, b, depth=5):
    return f"""WITH RECURSIVE reach(urn,hops,type,rule,confidence) AS (SELECT {b}, 1, type, rule, confidence FROM f_edges WHERE {a}='{begin}'
 UNION SELECT e.{b}, r.hops+1, e.type, e.rule, e.confidence FROM f_edges e JOIN reach r ON e.{a}=r.urn WHERE r.hops<{depth}),
 best AS (SELECT urn, CAST(min(hops) AS INT) AS hops, min(struct_pack(h:=hops,t:=type,r:=rule)) AS f, min(confidence) AS confidence FROM reach
  WHERE urn<>'{begin}' GROUP BY urn),
 found AS (SELECT b.urn, b.hops, b.f.t AS type, b.f.r AS rule, b.confidence, s.kind, s.name, s.provider, s.scope, s.status,
 CASE WHEN b.confidence IS NULL OR b.confidence>=1 THEN 'Confirmed' WHEN b.confidence>=0.85 THEN 'Declared' ELSE 'Likely' END AS confidence_label
 FROM best b LEFT JOIN f_resources s ON s.urn=b.urn)"""


def _impact(spark, d, begin, direction):
    return graph.impact(gold.edges(spark, d), tables.resources(spark, d), start(spark, begin), direction)


@query("n02_impact_upstream", _reach(START_UP, "dst", "src") + " SELECT * FROM found")
def _(spark, d):
    return _impact(spark, d, START_UP, "upstream")


@query("n02_impact_downstream", _reach(START_DOWN, "src", "dst") + " SELECT * FROM found")
def _(spark, d):
    return _impact(spark, d, START_DOWN, "downstream")


@query("u04_impact_summary", _reach(START_UP, "dst", "src")
       + " SELECT count(*) AS count, count(*) FILTER (WHERE coalesce(confidence,1)<0.8) AS low_confidence FROM found")
def _(spark, d):
    return graph.impact_summary(_impact(spark, d, START_UP, "upstream"))


@query("n04_effective_access", _reach(START_UP, "dst", "src")
       + " SELECT urn, kind, hops FROM found WHERE kind IN ('role','data_product','access_rule','schema','table','view')")
def _(spark, d):
    return graph.effective_access(_impact(spark, d, START_UP, "upstream")).select("urn", "kind", "hops")


_AROUND = """WITH d1 AS (SELECT * FROM f_edges WHERE src='nation:3' OR dst='nation:3'),
 s1 AS (SELECT src AS u FROM d1 UNION SELECT dst FROM d1 UNION SELECT 'nation:3'),
 d2 AS (SELECT * FROM f_edges WHERE src IN (SELECT u FROM s1) OR dst IN (SELECT u FROM s1)),
 s2 AS (SELECT src AS u FROM d2 UNION SELECT dst FROM d2)"""


@query("n01_neighbourhood_edges", _AROUND + " SELECT DISTINCT src, dst, type, rule, confidence FROM d2")
def _(spark, d):
    return graph.neighbourhood(gold.edges(spark, d), start(spark, "nation:3"), 2)[1]


@query("n01_neighbourhood_nodes", _AROUND + " SELECT u AS urn, kind, name, provider FROM s2 LEFT JOIN f_resources ON urn=u")
def _(spark, d):
    nodes, _ = graph.neighbourhood(gold.edges(spark, d), start(spark, "nation:3"), 2, resources=tables.resources(spark, d))
    return nodes.select("urn", "kind", "name", "provider")


@query("n06_confidence_bands", """SELECT type, CASE WHEN confidence IS NULL OR confidence>=1 THEN 'Confirmed' WHEN confidence>=0.85 THEN 'Declared'
 ELSE 'Likely' END AS label, count(*) AS edges FROM f_edges GROUP BY 1,2""")
def _(spark, d):
    return gold.edges(spark, d).groupBy("type", x.confidence_label("confidence").alias("label")).agg(
        F.count(F.lit(1)).alias("edges"))


# ---- inventory ----------------------------------------------------------------------------------
def states(spark, d):
    """State documents as JSON text, one per customer."""
    c = tables.read(spark, d, "customer")
    k = F.col("c_custkey").cast("string")

    def instance(index, *dependencies):
        return F.struct(index.alias("index_key"), F.array(*dependencies).alias("dependencies"),
                        F.create_map(F.lit("name"), F.col("c_name"), F.lit("api_Token"), k,
                                     F.lit("db_password"), k).alias("attributes"))

    resource = F.struct(
        F.lit("crm_account").alias("type"), F.concat(F.lit("c"), k).alias("name"),
        F.when(F.col("c_custkey") % 4 == 0, "data").alias("mode"), F.lit("crm").alias("provider"),
        F.array(instance(F.lit(None).cast("string"), F.lit("crm_root.main")),
                instance(F.lit("b"), F.lit("crm_root.main"), F.concat(F.lit("crm_account.c"), k)))
        .alias("instances"))
    body = F.struct(F.concat(F.lit("nation-"), F.col("c_nationkey").cast("string")).alias("workspace"),
                    F.lit(1).alias("serial"), F.array(resource).alias("resources"))
    return c.select(F.to_json(body).alias("payload"))


def parsed_states(spark, d):
    return states(spark, d).select(
        F.from_json("payload", inv.STATE_SCHEMA, {"mode": "FAILFAST"}).alias("s")).select("s.*")


def instances(spark, d):
    return inv.state_resources(parsed_states(spark, d))


def declared(spark, d):
    """State documents whose resources name runtime objects, one per supplier."""
    s = tables.read(spark, d, "supplier")
    k = F.col("s_suppkey")
    name = F.lower(F.replace("s_name", F.lit("#"), F.lit("-")))
    kinds = [("keycloak_group", F.create_map(F.lit("name"), name)), ("local_file", F.create_map(F.lit("filename"), F.concat(F.lit("/etc/x/"), name))),
             ("minio_s3_bucket", F.create_map(F.lit("name"), name)),
             ("kubernetes_service_v1", F.create_map(F.lit("metadata"), F.concat(F.lit('[{"name":"'), name, F.lit('","namespace":"ns"}]')))),
             ("other_thing", F.create_map(F.lit("name"), name))]
    kind, attributes = F.lit(kinds[-1][0]), kinds[-1][1]
    for i, (type_, values) in enumerate(kinds[:-1]):
        kind, attributes = F.when(k % 5 == i, type_).otherwise(kind), F.when(k % 5 == i, values).otherwise(attributes)
    instance = F.struct(attributes.alias("attributes"))
    body = F.struct(F.lit("live").alias("workspace"), F.lit(3).alias("serial"), F.array(F.struct(
        kind.alias("type"), F.concat(F.lit("s"), k.cast("string")).alias("name"), F.array(instance).alias("instances"))).alias("resources"))
    return s.select(F.to_json(body).alias("payload")).select(
        F.from_json("payload", inv.STATE_SCHEMA, {"mode": "FAILFAST"}).alias("s")).select("s.*")


@query("s08_workspaces", """SELECT DISTINCT 'urn:infra:terraform:workspace:iac/nation-'||c_nationkey AS urn, CAST(1 AS INT) AS resource_count
 FROM customer""")
def _(spark, d):
    return inv.state_workspaces(parsed_states(spark, d)).select("urn", "resource_count")


@query("s08_managed_edges", """SELECT type, rule, CASE s_suppkey%5 WHEN 0 THEN 'urn:infra:keycloak:group:internal/' WHEN 1 THEN 'urn:infra:file:config:generated/'
 WHEN 2 THEN 'urn:infra:minio:bucket:default/' ELSE 'urn:infra:kubernetes:service:ns/' END || lower(replace(s_name,'#','-')) AS target
 FROM supplier, LATERAL (SELECT 'MANAGES' AS type, CASE WHEN s_suppkey%5=1 THEN 'declared-filename' ELSE 'declared' END AS rule) r WHERE s_suppkey%5<4""")
def _(spark, d):
    """The runtime objects that state resources manage."""
    return inv.managed_edges(inv.state_resources(declared(spark, d))).select("type", "rule", "target")


_INSTANCES = """SELECT 'nation-'||c_nationkey AS workspace, 'crm_account.c'||c_custkey||suffix AS address,
 CASE WHEN c_custkey%4=0 THEN 'data' ELSE 'managed' END AS mode, deps, CAST(c_custkey AS VARCHAR) AS k, c_name
 FROM customer, (VALUES ('', CAST(1 AS INT)), ('[b]', CAST(2 AS INT))) AS i(suffix, deps)"""
o.register("n_instances", _INSTANCES)


@query("s08_inventory_instances", """SELECT 'urn:infra:terraform:state_resource:'||workspace||'/'||
 CASE WHEN deps=1 THEN address ELSE replace(address,'[b]','-b') END AS urn, workspace, address, mode, deps FROM n_instances""")
def _(spark, d):
    return instances(spark, d).select("urn", "workspace", "address", "mode",
                                      F.size("dependencies").alias("deps"))


@query("s08_candidate_edges", """SELECT type, target, count(*) AS edges FROM (SELECT 'CONTAINS' AS type, 'workspace::'||workspace AS target FROM n_instances
 UNION ALL SELECT 'DEPENDS_ON', 'address::crm_root.main' FROM n_instances
 UNION ALL SELECT 'DEPENDS_ON', 'address::'||replace(address,'[b]','') FROM n_instances WHERE deps=2) GROUP BY 1,2""")
def _(spark, d):
    return inv.candidate_edges(instances(spark, d)).groupBy("type", "target").agg(
        F.count(F.lit(1)).alias("edges"))


@query("p21_redacted_attributes", """SELECT address, c_name AS name, '***redacted***' AS token, '***redacted***' AS password FROM n_instances""")
def _(spark, d):
    from regulus.operators.governance import redact_secrets
    safe = instances(spark, d).withColumn("attributes", redact_secrets("attributes"))
    return safe.select("address", F.col("attributes")["name"].alias("name"),
                       F.col("attributes")["api_Token"].alias("token"),
                       F.col("attributes")["db_password"].alias("password"))


def references(spark, d):
    """Orders that point at their customer in one of four ways."""
    way, k = F.col("o_orderkey") % 4, F.col("o_custkey").cast("string")
    own = F.concat(F.lit("order-"), F.col("o_orderkey").cast("string"))
    return tables.read(spark, d, "orders").select(
        F.concat(F.lit("order:"), F.col("o_orderkey").cast("string")).alias("src"),
        F.lit("DEPENDS_ON").alias("type"),
        F.when(way == 0, "crm-id").alias("source"), F.when(way == 0, k).alias("native_id"),
        F.when(way.isin(1, 2), "crm").when(way == 3, "intake").alias("provider"),
        F.when(way == 2, "group").alias("kind"), F.lit(None).cast("string").alias("scope"),
        F.when(way.isin(1, 2), k).when(way == 3, own).alias("name"),
        F.when(way == 0, "native-id").when(way == 1, "declared").otherwise("convention").alias("rule"))


def aliases(spark, d):
    k = F.col("c_custkey").cast("string")
    target = F.concat(F.lit("customer:"), k).alias("urn")
    customer = tables.read(spark, d, "customer")
    order = F.col("o_orderkey").cast("string")
    return (customer.filter(F.col("c_custkey") % 3 == 0).select(
        F.concat(F.lit("crm-id::"), k).alias("key"), target)
        .unionByName(customer.filter(F.col("c_custkey") % 2 == 0).select(
            F.concat(F.lit("crm::default/"), k).alias("key"), target))
        .unionByName(tables.read(spark, d, "orders").select(
            F.concat(F.lit("intake::default/order-"), order).alias("key"),
            F.concat(F.lit("order:"), order).alias("urn"))))


def minted(spark, d):
    return tables.read(spark, d, "customer").filter(F.col("c_custkey") % 5 == 0).select(
        F.concat(F.lit("urn:infra:crm:group:default/"), F.col("c_custkey").cast("string")).alias("urn"))


o.register("n_resolved", """SELECT 'order:'||o_orderkey AS src, CASE o_orderkey%4
 WHEN 0 THEN CASE WHEN o_custkey%3=0 THEN 'customer:'||o_custkey END
 WHEN 1 THEN CASE WHEN o_custkey%2=0 THEN 'customer:'||o_custkey END
 WHEN 2 THEN CASE WHEN o_custkey%2=0 THEN 'customer:'||o_custkey WHEN o_custkey%5=0 THEN 'urn:infra:crm:group:default/'||o_custkey END
 ELSE 'order:'||o_orderkey END AS dst, CASE o_orderkey%4 WHEN 0 THEN 'native-id' WHEN 1 THEN 'declared' ELSE 'convention' END AS rule,
 CASE o_orderkey%4 WHEN 0 THEN 1.0e0 WHEN 1 THEN 0.9e0 ELSE 0.6e0 END AS confidence, o_orderkey%4 AS way FROM orders""")


def resolved(spark, d):
    return inv.resolve_references(references(spark, d), aliases(spark, d), minted(spark, d))


@query("n03_resolved_edges", "SELECT src, dst, 'DEPENDS_ON' AS type, rule, confidence FROM n_resolved WHERE dst IS NOT NULL AND dst<>src")
def _(spark, d):
    return inv.resolved_edges(resolved(spark, d))


@query("j13_alias_priority", """SELECT coalesce(CASE WHEN dst IS NULL THEN 'unresolved' WHEN starts_with(dst,'urn:') THEN 'minted'
 WHEN way=0 THEN 'native-id' ELSE 'coordinates' END) AS found_by, count(*) AS references_found FROM n_resolved GROUP BY 1""")
def _(spark, d):
    rows = resolved(spark, d)
    return rows.groupBy(F.coalesce("found_by", F.lit("unresolved")).alias("found_by")).agg(
        F.count(F.lit(1)).alias("references_found"))


@query("j13_unresolved", "SELECT src FROM n_resolved WHERE dst IS NULL")
def _(spark, d):
    return inv.unresolved(resolved(spark, d)).select("src")


def sighting(spark, d):
    """A later collection: some orders gone, some customers changed, owners not reported."""
    rows = tables.resources(spark, d)
    key = F.element_at(F.split("urn", ":"), 2).cast("long")
    crm = (rows.filter(F.col("provider") == "crm").withColumn("_k", key)
           .withColumn("status", F.when(F.col("_k") % 7 == 0, "closed").otherwise(F.col("status")))
           .withColumn("owner", F.when(F.col("_k") % 2 == 0, F.col("owner"))))
    intake = rows.filter(F.col("provider") == "intake").withColumn("_k", key).filter("_k % 5 <> 0")
    fresh = spark.range(1).select(
        F.lit("customer:new").alias("urn"), F.lit("crm").alias("provider"), F.lit("group").alias("kind"),
        F.lit("new").alias("name"), F.lit("nation-0").alias("scope"), F.lit("SALES").alias("owner"),
        F.lit("production").alias("environment"), F.lit("active").alias("status"))
    return crm.drop("_k").unionByName(intake.drop("_k")).unionByName(fresh)


o.register("n_merged", """SELECT urn, CASE WHEN provider='crm' AND CAST(split_part(urn,':',2) AS BIGINT)%7=0 THEN 'closed' ELSE status END AS new_status,
 owner, status, provider, (provider='intake' AND CAST(split_part(urn,':',2) AS BIGINT)%5=0) AS stale FROM f_resources""")


@query("t14_stale_marking", """SELECT urn, owner, new_status AS status, stale FROM n_merged
 UNION ALL SELECT 'customer:new','SALES','active',false""")
def _(spark, d):
    stored = tables.resources(spark, d).withColumn("stale", F.lit(False))
    return inv.merge_sighting(stored, sighting(spark, d), ["crm", "intake"]).select(
        "urn", "owner", "status", "stale")


@query("t13_change_detection", """SELECT provider, count(*) AS rows, count(*) FILTER (WHERE changed) AS changed FROM (SELECT provider,
 stale OR new_status<>status AS changed FROM n_merged UNION ALL SELECT 'crm', true) GROUP BY 1""")
def _(spark, d):
    stored = tables.resources(spark, d).withColumn("stale", F.lit(False))
    return inv.merge_sighting(stored, sighting(spark, d), ["crm", "intake"]).groupBy("provider").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("changed").alias("changed"))


def runs(spark, d):
    return tables.read(spark, d, "events").select(
        F.col("event_type").alias("plugin"), F.col("event_id").alias("id"),
        F.when(F.col("value") > 5, "ok").otherwise("failed").alias("status"),
        (F.col("user_id") % 9).alias("entities"))


@query("j11_latest_runs", """SELECT event_type AS plugin, event_id AS id, CASE WHEN value>5 THEN 'ok' ELSE 'failed' END AS status, user_id%9 AS entities
 FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC)=1""")
def _(spark, d):
    return inv.latest_runs(runs(spark, d))


@query("j12_edges_with_ends", """SELECT e.src, e.dst, e.type, a.kind AS src_kind, a.name AS src_name, b.kind AS dst_kind, b.name AS dst_name
 FROM f_edges e LEFT JOIN f_resources a ON a.urn=e.src LEFT JOIN f_resources b ON b.urn=e.dst""")
def _(spark, d):
    return inv.with_ends(gold.edges(spark, d), tables.resources(spark, d)).select(
        "src", "dst", "type", "src_kind", "src_name", "dst_kind", "dst_name")


_Q = "(contains(lower(name),'0001') OR contains(lower(urn),'0001') OR contains(lower(scope),'0001'))"


@query("p19_keyword_and_facets", f"SELECT urn, provider, kind, name, scope, owner, environment, status FROM f_resources WHERE {_Q} AND kind='group' AND status='active'")
def _(spark, d):
    return inv.matching(tables.resources(spark, d), "0001", kind="group", status="active")


@query("a33_facet_counts", " UNION ALL ".join(
    f"SELECT '{f}' AS facet, {f} AS value, count(*) AS count FROM f_resources WHERE provider='crm' AND {f}<>'' GROUP BY 2"
    for f in inv.FACETS))
def _(spark, d):
    return inv.facet_counts(inv.matching(tables.resources(spark, d), provider="crm"))


@query("o04_page_with_total", """SELECT urn, provider, kind, name, (SELECT count(*) FROM f_resources WHERE kind='group') AS total
 FROM f_resources WHERE kind='group' ORDER BY provider, kind, name, urn LIMIT 50 OFFSET 100""")
def _(spark, d):
    rows = inv.matching(tables.resources(spark, d), kind="group")
    return inv.page(rows, 50, 100).select("urn", "provider", "kind", "name", "total")


@query("a34_inventory_stats", """SELECT 'resources' AS measure, 'all' AS value, count(*)+1 AS n FROM n_merged
 UNION ALL SELECT 'stale', 'all', count(*) FILTER (WHERE stale) FROM n_merged UNION ALL SELECT 'edges', 'all', count(*) FROM f_edges
 UNION ALL SELECT 'provider', provider, count(*) FROM (SELECT provider FROM n_merged UNION ALL SELECT 'crm') GROUP BY provider
 UNION ALL SELECT 'kind', kind, count(*) FROM (SELECT kind FROM f_resources UNION ALL SELECT 'group') GROUP BY kind""")
def _(spark, d):
    """Totals after one collection, the stale resources among them."""
    stored = tables.resources(spark, d).withColumn("stale", F.lit(False))
    merged = inv.merge_sighting(stored, sighting(spark, d), ["crm", "intake"])
    return inv.inventory_stats(merged, gold.edges(spark, d))


# ---- gates --------------------------------------------------------------------------------------
o.register("n_gates", """SELECT item, i.stage, i.rank, coalesce(status,'not run') AS state FROM (SELECT DISTINCT 'a'||user_id AS item FROM events)
 CROSS JOIN (VALUES ('ephemeral',CAST(0 AS INT)),('staging',CAST(1 AS INT)),('production',CAST(2 AS INT))) AS i(stage,rank) LEFT JOIN (SELECT 'a'||user_id AS item2, CASE event_id%3 WHEN 0 THEN 'ephemeral'
 WHEN 1 THEN 'staging' ELSE 'production' END AS stage2, CASE WHEN value>3 THEN 'passed' ELSE 'failed' END AS status FROM events
 QUALIFY row_number() OVER (PARTITION BY user_id, event_id%3 ORDER BY event_id DESC)=1) ON item2=item AND stage2=i.stage""")


def verifications(spark, d):
    e = F.col("event_id")
    return tables.read(spark, d, "events").select(
        F.concat(F.lit("a"), F.col("user_id").cast("string")).alias("item"),
        F.when(e % 3 == 0, "ephemeral").when(e % 3 == 1, "staging").otherwise("production").alias("stage"),
        F.when(F.col("value") > 3, "passed").otherwise("failed").alias("status"), e.alias("at"))


@query("j19_stage_gates", """SELECT item, stage, rank, state, coalesce(rank=0 OR lag(state) OVER (PARTITION BY item ORDER BY rank)='passed', false) AS eligible
 FROM n_gates""")
def _(spark, d):
    return inv.stage_gates(verifications(spark, d))


@query("w11_previous_stage", "SELECT item, stage, state, lag(state) OVER (PARTITION BY item ORDER BY rank) AS previous_state FROM n_gates")
def _(spark, d):
    return inv.previous_stage_status(inv.stage_gates(verifications(spark, d))).select(
        "item", "stage", "state", "previous_state")


# ---- text search --------------------------------------------------------------------------------
_TERMS = ("the", "and", "of")


def index(spark, d):
    """The postings of all documents and how many documents each term has, built once."""
    stored = gold.stored(spark, d, "postings", lambda: post.postings(tables.read(spark, d, "documents"), "doc_id", "text"), "bucket", ("term",))
    return stored, gold.stored(spark, d, "frequencies", lambda: post.frequencies(stored), "bucket", ("term",))


@query("n07_all_terms_search", """SELECT doc_id, source, CAST(len(hits) AS INT) AS score FROM (SELECT doc_id, source,
 list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w IN ('the','and','of')) AS hits FROM documents)
 WHERE len(list_distinct(hits))=3""")
def _(spark, d):
    """Documents that contain every term, over their whole text; the texts are read once, when the index is built."""
    hits = post.search(*index(spark, d), list(_TERMS), "doc_id")
    return tables.read(spark, d, "documents").select("doc_id", "source").join(hits, "doc_id").select(
        "doc_id", "source", F.col("score").cast("int").alias("score"))


@query("n07_ranked_search", """SELECT doc_id, quality, CAST(len(hits) AS INT) AS score FROM (SELECT d.doc_id, quality,
 list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w IN ('the','and')) AS hits FROM documents d LEFT JOIN labels l ON l.doc_id=d.doc_id)
 WHERE len(list_distinct(hits))=2 ORDER BY quality DESC NULLS LAST, score DESC, doc_id LIMIT 20""")
def _(spark, d):
    """The twenty best hits: better tier first, then more occurrences; documents without a tier come last."""
    hits = post.search(*index(spark, d), ["and", "the"], "doc_id").join(tables.read(spark, d, "labels"), "doc_id", "left")
    return (hits.select("doc_id", "quality", F.col("score").cast("int").alias("score"))
            .orderBy(F.desc_nulls_last("quality"), F.desc("score"), "doc_id").limit(20))
