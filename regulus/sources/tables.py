"""Facts projected from the driver's tables.

The projection gives the same eighteen columns a change-capture feed of the three processes would
deliver. Children carry ``application_id``, so they meet their application on one key. Only the
columns each relation needs are selected, so the scans read nothing else. No join is hinted: the
optimizer broadcasts a side only when its measured size is under the configured threshold.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regulus.contract import DAY_MS, FACT_COLUMNS
from regulus.functions.columns import epoch_ms
from regulus.operators.quantiles import running_total_before
from regulus.session import use_business_time

# Order of the change history of one line; the trailing columns make it total.
HISTORY_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus")
_LINE_COLUMNS = ("l_orderkey", "l_linenumber", *HISTORY_ORDER)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    use_business_time(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _by_key(key: Column, names: list[str]) -> Column:
    result = F.when(F.lit(False), "")
    for index, name in enumerate(names[:-1]):
        result = result.when(F.pmod(key, F.lit(len(names))) == index, name)
    return result.otherwise(names[-1])


def _route(key: str) -> Column:
    return _by_key(F.col(key), [
        "on_site_domestic", "on_site_foreign", "reliance_joint_on_site_foreign",
        "reliance_joint_desk_based_foreign"])


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the region of their customer, in the columns of the tables."""
    orders = read(spark, sf_dir, "orders")
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    home = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_regionkey")
    return orders.join(home, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "n_regionkey")


def _cohort_month() -> Column:
    return F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM").alias("cohort_month")


def _shared(key: str) -> list[Column]:
    """What every fact of an application shares, from the columns of its order; ``key`` names the order's key."""
    process = _by_key(F.col(key), ["MA", "CT", "GMP"])
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    medium = F.col("o_orderpriority") == "3-MEDIUM"
    app_type = (
        F.when(process == "MA", F.when(urgent, "new").when(medium, "renewal").otherwise("variation"))
        .when(process == "CT", F.when(urgent | medium, "new").otherwise("amendment"))
        .otherwise("inspection"))
    return [_by_key(F.col("n_regionkey"), ["internal", "partner_alpha", "partner_beta"]).alias("tenant_id"),
            F.col(key).cast("string").alias("application_id"), F.col("o_custkey").cast("string").alias("entity_id"),
            process.alias("process_code"), app_type.alias("application_type")]


def dossiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every fact of an application shares: tenant, entity, process, type, cohort."""
    return _orders(spark, sf_dir).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", *_shared("o_orderkey"), _cohort_month())


_SHARED = ("application_id", "tenant_id", "entity_id", "process_code", "application_type",
           "cohort_month")


def _activity_type() -> Column:
    p, n = F.col("process_code"), F.col("l_linenumber")
    return (
        F.when(p == "MA", F.when(n == 2, "fir_response").when(n == 3, "query_response")
               .when(n.isin(4, 5), "decision").otherwise("evaluation"))
        .when(p == "CT", F.when(n == 2, "inspection").when(n == 3, "safety_report")
              .when(n == 4, "registration").when(n == 5, "capa").when(n == 6, "decision")
              .otherwise("evaluation"))
        .otherwise(F.when(n == 1, "waiver").when(n.isin(2, 6), "inspection").when(n == 3, "capa")
                   .when(n == 5, "report").otherwise("decision")))


def _line_facts(lines: DataFrame, due_days: Column, suffix: str = "") -> DataFrame:
    """Columns of a child fact that come from the line alone."""
    shipped = epoch_ms("l_shipdate")
    done = F.col("l_linestatus") == "F"
    received = shipped - F.floor("l_quantity").cast("long") * DAY_MS
    return lines.select(
        F.col("l_orderkey"), F.col("l_linenumber"),
        F.concat((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string"),
                 F.lit(suffix)).alias("record_id"),
        _route("l_suppkey").alias("route"),
        received.alias("received_at"),
        (received + due_days.cast("long") * DAY_MS).alias("due_at"),
        F.when(done, shipped).alias("completed_at"),
        shipped.alias("updated_at"),
        F.when(done, "COMPLETED").otherwise("IN_REVIEW").alias("status"),
        F.when(done, F.when(F.col("l_returnflag") == "A", "COMPLIANT")
               .when(F.col("l_returnflag") == "R", "NON_COMPLIANT")
               .otherwise("APPROVED")).alias("outcome"),
        (F.col("l_quantity") * (1 - 5 * F.col("l_discount"))).alias("touch_days"),
        (F.col("l_quantity") * 5 * F.col("l_discount")).alias("wait_days"),
        F.col("revision").cast("int").alias("revision"),
        *[c for c in ("p_type", "p_size", *_SHARED) if c in lines.columns])


#: Lines of an order beyond which they are not left to one task.
HOT_LINES = 1_000_000
#: What facts need of a line and of its order, as the tables have it.
_LAST = ("l_orderkey", "l_linenumber", "revision", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax",
         "l_returnflag", "l_linestatus")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line that can belong to an order."""
    return read(spark, sf_dir, "lineitem").select(*_LINE_COLUMNS).filter(F.col("l_orderkey").isNotNull())


def _split_by_order(lines: DataFrame, usual, hot) -> DataFrame:
    """``usual`` of the lines brought together by order, which is also where they meet their dossier, and ``hot`` of the orders with
    very many lines, as they come."""
    found = lines.groupBy("l_orderkey").count().filter(F.col("count") > HOT_LINES).select("l_orderkey").collect()
    if not found:
        return usual(lines.repartition("l_orderkey"))
    is_hot = F.col("l_orderkey").isin([r[0] for r in found])
    return usual(lines.filter(~is_hot).repartition("l_orderkey")).unionByName(hot(lines.filter(is_hot)))


def _current_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last state of every line; an order with very many lines is combined before it shuffles."""
    def last(lines: DataFrame) -> DataFrame:
        return (lines.groupBy("l_orderkey", "l_linenumber")
                .agg(F.max(F.struct(*HISTORY_ORDER)).alias("last"), F.count(F.lit(1)).alias("revision"))
                .select("l_orderkey", "l_linenumber", "revision", "last.*").select(*_LAST))
    return _split_by_order(_lines(spark, sf_dir), last, last)


def _activity_due() -> Column:
    return F.when(F.col("l_tax") == 0.08, -1).otherwise(30)


def _with_order(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "n_regionkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        *_LAST, "o_custkey", "o_orderpriority", "n_regionkey", _cohort_month())


def _with_dossier(lines: DataFrame) -> DataFrame:
    return lines.select("*", *_shared("l_orderkey"))


def current_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last state of every line with what its dossier is made of: numbers and codes, which move and are stored as few bytes."""
    return _with_order(spark, sf_dir, _current_lines(spark, sf_dir))


def activities_of(lines: DataFrame) -> DataFrame:
    """Activities from lines with their order."""
    return _line_facts(_with_dossier(lines), _activity_due()).withColumn("activity_type", _activity_type()).select(*FACT_COLUMNS)


def line_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every recorded state of every line, numbered by revision, with what its dossier is made of.

    The number counts the earlier states. In an order with very many lines they are counted per day first, which keeps a key with a
    large share of all states out of a single sort. A state without a day counts as an earlier one, but neither it nor one without line
    number has a place in a history.
    """
    keys = ["l_orderkey", "l_linenumber"]

    def numbered(lines: DataFrame) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*HISTORY_ORDER))
        return lines.withColumn("revision", place.cast("long")).filter(F.col("l_shipdate").isNotNull()).select(*_LAST)

    def counted(lines: DataFrame) -> DataFrame:
        rows = running_total_before(lines, keys, F.col("l_shipdate"), list(HISTORY_ORDER[1:]), F.lit(1), "_earlier")
        return rows.withColumn("revision", F.col("_earlier") + 1).select(*_LAST)

    lines = _lines(spark, sf_dir).filter(F.col("l_linenumber").isNotNull())
    return _with_order(spark, sf_dir, _split_by_order(lines, numbered, counted))


def activity_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every recorded state of every activity, numbered by revision."""
    return activities_of(line_history(spark, sf_dir))


def activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current state of every activity, valid or not."""
    return activities_of(current_lines(spark, sf_dir))


# Workflow stages per process, in the order of the six part types.
STAGES = {
    "MA": ("Preliminary Screening", "Technical Dossier Review", "Quality Review",
           "Queries to Applicant", "Applicant Response Review", "Decision Issued"),
    "CT": ("Administrative Screening", "Ethics Review", "Technical Review", "GCP Inspection",
           "Applicant Response Review", "Decision Issued"),
    "GMP": ("Application Screening", "Inspection Planning", "Inspection Conducted",
            "CAPA Requested", "CAPA Review", "Final Decision Issued"),
}
PART_TYPES = ("STANDARD", "MEDIUM", "PROMO", "SMALL", "ECONOMY", "LARGE")
STAGE_SUFFIXES = ("_domestic", "_foreign", "_reliance_joint_on_site_foreign",
                  "_reliance_joint_desk_based_foreign")


def _stage() -> Column:
    p, kind = F.col("process_code"), F.col("p_type")
    result = F.when(F.lit(False), "")
    for process, names in STAGES.items():
        for part_type, name in zip(PART_TYPES, names):
            result = result.when((p == process) & (kind == part_type), name)
    split = (p == "GMP") & (F.pmod(F.col("p_size"), F.lit(5)) == 0)
    ending = F.when(F.col("route") == "on_site_domestic", STAGE_SUFFIXES[0])
    ending = ending.when(F.col("route") == "on_site_foreign", STAGE_SUFFIXES[1])
    ending = ending.when(F.col("route") == "reliance_joint_on_site_foreign", STAGE_SUFFIXES[2])
    return F.concat(result.otherwise(kind),
                    F.when(split, ending.otherwise(STAGE_SUFFIXES[3])).otherwise(""))


def staged_lines(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Lines with the kind and size of their part."""
    part = read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")


def steps_of(staged: DataFrame) -> DataFrame:
    """Workflow steps from lines with their order and part."""
    facts = _line_facts(_with_dossier(staged), 10 + F.pmod(F.col("p_size"), F.lit(30)), suffix="-s")
    return facts.withColumn("activity_type", _stage()).select(*FACT_COLUMNS)


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current state of every workflow step."""
    return steps_of(staged_lines(spark, sf_dir, current_lines(spark, sf_dir)))


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the region of their customer and their cohort month."""
    return _orders(spark, sf_dir).withColumn("cohort_month", _cohort_month())


def applications_of(orders: DataFrame) -> DataFrame:
    """Applications from dated orders."""
    ordered = epoch_ms("o_orderdate")
    done = F.col("o_orderstatus") == "F"
    spent = F.pmod(F.floor("o_totalprice").cast("long"), F.lit(150))
    days = F.when(done, spent.cast("double")).otherwise(F.lit(0.0))
    completed = F.when(done, ordered + spent * DAY_MS)
    return orders.select("*", *_shared("o_orderkey")).select(
        F.col("application_id").alias("record_id"), *_SHARED,
        F.lit("application").alias("activity_type"), _route("o_custkey").alias("route"),
        ordered.alias("received_at"), (ordered + 90 * DAY_MS).alias("due_at"),
        completed.alias("completed_at"), F.coalesce(completed, ordered).alias("updated_at"),
        F.when(done, "COMPLETED").when(F.col("o_orderstatus") == "P", "IN_REVIEW")
        .otherwise("RECEIVED").alias("status"),
        F.when(done, "APPROVED").alias("outcome"),
        (days * 0.6).alias("touch_days"), (days * 0.4).alias("wait_days"),
        F.when(done, 3).when(F.col("o_orderstatus") == "P", 2).otherwise(1).cast("int")
        .alias("revision")).select(*FACT_COLUMNS)


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current state of every application."""
    return applications_of(dated_orders(spark, sf_dir))


def enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Looked-up attributes of nine entities in ten; one in twenty could not be reached."""
    customer = read(spark, sf_dir, "customer").filter(F.col("c_custkey") % 10 != 0)
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    found = F.col("c_custkey") % 20 != 1
    tier = (F.when(F.col("c_acctbal") < 0, "high").when(F.col("c_acctbal") < 3000, "elevated")
            .when(F.col("c_acctbal") < 7000, "standard").otherwise("low"))
    state = F.when(F.col("c_acctbal") < 0, "suspended").otherwise("active")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("entity_id"),
        F.when(found, F.col("c_name")).alias("legal_name"),
        F.when(found, F.col("n_name")).alias("country"),
        F.when(found, tier).alias("risk_tier"),
        F.when(found, state).alias("registry_status"),
        F.lit(None).cast("timestamp").alias("enriched_at"),
        (F.col("c_custkey") % 250).alias("source_latency_ms"),
        F.when(found, "enriched").otherwise("unavailable").alias("status"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations order -> customer -> nation -> region with their rule and confidence."""
    def part(table: str, src: str, key: str, dst: str, ref: str, kind: str, rule: str, c: float):
        return read(spark, sf_dir, table).select(
            F.concat(F.lit(f"{src}:"), F.col(key).cast("string")).alias("src"),
            F.concat(F.lit(f"{dst}:"), F.col(ref).cast("string")).alias("dst"),
            F.lit(kind).alias("type"), F.lit(rule).alias("rule"), F.lit(c).alias("confidence"))
    return (
        part("nation", "nation", "n_nationkey", "region", "n_regionkey", "MEMBER_OF", "native-id", 1.0)
        .unionByName(part("customer", "customer", "c_custkey", "nation", "c_nationkey",
                          "MEMBER_OF", "declared", 0.9))
        .unionByName(part("orders", "order", "o_orderkey", "customer", "o_custkey",
                          "DEPENDS_ON", "convention", 0.6)))


def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory rows behind the ends of the relations."""
    def part(table: str, prefix: str, key: str, provider: str, kind: str, name: Column,
             scope: Column, owner: Column, environment: Column, status: Column):
        return read(spark, sf_dir, table).select(
            F.concat(F.lit(f"{prefix}:"), F.col(key).cast("string")).alias("urn"),
            F.lit(provider).alias("provider"), F.lit(kind).alias("kind"), name.alias("name"),
            scope.alias("scope"), owner.alias("owner"), environment.alias("environment"),
            status.alias("status"))
    null = F.lit(None).cast("string")
    return (
        part("region", "region", "r_regionkey", "directory", "schema", F.col("r_name"),
             F.lit("global"), null, F.lit("control-plane"), F.lit("ok"))
        .unionByName(part("nation", "nation", "n_nationkey", "directory", "role", F.col("n_name"),
                          F.concat(F.lit("region-"), F.col("n_regionkey").cast("string")), null,
                          F.lit("control-plane"), F.lit("ok")))
        .unionByName(part("customer", "customer", "c_custkey", "crm", "group", F.col("c_name"),
                          F.concat(F.lit("nation-"), F.col("c_nationkey").cast("string")),
                          F.col("c_mktsegment"), F.lit("production"),
                          F.when(F.col("c_acctbal") < 0, "suspended").otherwise("active")))
        .unionByName(part("orders", "order", "o_orderkey", "intake", "table",
                          F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")),
                          F.lit("default"), null, F.lit("production"),
                          F.lower(F.col("o_orderstatus")))))


def audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completed-query rows projected from the event table."""
    day = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd")
    return read(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("query_id"),
        F.col("user_id").cast("string").alias("username"),
        (F.col("user_id") % 7).cast("string").alias("principal"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("FINISHED").alias("state"),
        F.floor(F.col("value") * 10).cast("long").alias("wall_ms"),
        F.get_json_object("props", "$.k").cast("long").alias("rows_returned"),
        F.concat(F.lit("lake.gold."), F.col("event_type")).alias("tables_accessed"),
        day.alias("audit_day"))
