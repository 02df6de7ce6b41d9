"""Plan queries: ``orders`` plays the plans, its priority the provider."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landsync.catalog.registry import nothing, query, run_time, sql_id, table
from landsync.operators import dedup, filters, merge, records, stats
from landsync.plans.plan_sync import union_providers
from landsync.sources import state as S


# --- bindings ---------------------------------------------------------------
def stored(spark: SparkSession, sf: str) -> DataFrame:
    """The stored plans, one per order: values cut to one decimal and lists turned round
    for the early ones; status F is inactive. Each seventh order is stored under an id
    that today's plans lack, so that plans go and new ones come while all rows count."""
    o = table(spark, sf, "orders")
    early = F.col("o_orderdate") < F.lit("1996-01-01")
    return o.select(
        F.concat(F.when(F.col("o_orderkey") % 7 == 0, "old-").otherwise(""),
                 F.col("o_orderkey").cast("string")).alias("id"),
        F.col("o_orderpriority").alias("provider_name"),
        F.concat(F.lit("Plan "), F.col("o_custkey").cast("string")).alias("plan_name"),
        (F.floor(F.col("o_totalprice") * 10) / 10).cast("double").alias("annual_limit"),
        F.when(early, F.array("o_orderpriority", "o_orderstatus"))
        .otherwise(F.array("o_orderstatus", "o_orderpriority")).alias("covered_conditions"),
        F.lit("kept text").alias("claim_process"),
        (F.col("o_orderstatus") != "F").alias("is_active"),
        F.lit("2020-01-01").cast("timestamp").alias("created_at"),
        F.lit("2020-01-01").cast("timestamp").alias("updated_at"))


def incoming(spark: SparkSession, sf: str) -> DataFrame:
    """Today's plans, one per order; one provider gives no limits."""
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("seq"), F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderpriority").alias("provider_name"),
        F.concat(F.lit("Plan "), F.col("o_custkey").cast("string")).alias("plan_name"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("annual_limit"),
        F.array("o_orderstatus", "o_orderpriority").alias("covered_conditions"))


STORED = """SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'old-' ELSE '' END || o_orderkey AS id,
  o_orderpriority AS provider_name,
  'Plan ' || o_custkey AS plan_name, floor(o_totalprice * 10) / 10 AS annual_limit,
  CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN [o_orderpriority, o_orderstatus]
       ELSE [o_orderstatus, o_orderpriority] END AS covered_conditions,
  'kept text' AS claim_process, o_orderstatus <> 'F' AS is_active FROM orders"""
INCOMING = """SELECT o_orderkey AS seq, CAST(o_orderkey AS VARCHAR) AS id,
  o_orderpriority AS provider_name, 'Plan ' || o_custkey AS plan_name,
  CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS annual_limit,
  [o_orderstatus, o_orderpriority] AS covered_conditions FROM orders"""
DIFF = f"""SELECT n.id, n.provider_name, CASE
  WHEN o.id IS NULL THEN 'new' WHEN NOT o.is_active THEN 'conflict'
  WHEN n.plan_name <> o.plan_name OR n.covered_conditions <> o.covered_conditions
    OR (n.annual_limit IS NOT NULL AND abs(n.annual_limit - o.annual_limit) > 0.01)
  THEN 'updated' ELSE 'unchanged' END AS status
FROM ({INCOMING}) n LEFT JOIN ({STORED}) o ON n.id = o.id"""


def diffed(spark: SparkSession, sf: str) -> DataFrame:
    return merge.diff_plans(stored(spark, sf), incoming(spark, sf))


# --- diff, merge, soft delete -----------------------------------------------
@query(DIFF)
def mrg2_snapshot_diff(spark: SparkSession, sf: str) -> DataFrame:
    return diffed(spark, sf).select("id", "provider_name", "status")


@query(f"""
SELECT coalesce(o.id, n.id) AS id, CASE WHEN n.id IS NULL THEN 'kept' ELSE d.status END
    AS sync_status,
  CASE WHEN d.status IN ('new', 'updated') THEN n.annual_limit ELSE o.annual_limit END
    AS annual_limit,
  array_to_string(CASE WHEN d.status IN ('new', 'updated') THEN n.covered_conditions
    ELSE o.covered_conditions END, '|') AS covered, o.claim_process AS claim_process,
  CASE WHEN d.status = 'new' THEN 2026 ELSE 2020 END AS created_year,
  CASE WHEN d.status IN ('new', 'updated') THEN 2026 ELSE 2020 END AS updated_year
FROM ({STORED}) o FULL JOIN ({INCOMING}) n ON n.id = o.id LEFT JOIN ({DIFF}) d ON d.id = n.id""")
def mrg2_plan_table(spark: SparkSession, sf: str) -> DataFrame:
    """The next plan table with what became of each row."""
    out = merge.sync_plans(stored(spark, sf), incoming(spark, sf), run_time())
    return out.select("id", "sync_status", "annual_limit",
                      F.array_join("covered_conditions", "|").alias("covered"), "claim_process",
                      F.year("created_at").alias("created_year"),
                      F.year("updated_at").alias("updated_year"))


@query(f"""
SELECT coalesce(o.id, n.id) AS id, CASE WHEN n.id IS NULL THEN 'kept' WHEN d.status = 'conflict'
    THEN 'updated' ELSE d.status END AS sync_status,
  CASE WHEN d.status IN ('new', 'updated', 'conflict') THEN coalesce(n.annual_limit, o.annual_limit)
    ELSE o.annual_limit END AS annual_limit
FROM ({STORED}) o FULL JOIN ({INCOMING}) n ON n.id = o.id LEFT JOIN ({DIFF}) d ON d.id = n.id""")
def mrg2_preserve_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """As above with nulls kept out and inactive rows revived."""
    out = merge.sync_plans(stored(spark, sf), incoming(spark, sf), run_time(),
                           null_policy="preserve", reactivate=True)
    return out.select("id", "sync_status", "annual_limit")


@query(f"""SELECT provider_name, status, count(*) AS plans FROM ({DIFF})
GROUP BY provider_name, status""")
def agg1_status_by_provider(spark: SparkSession, sf: str) -> DataFrame:
    return (diffed(spark, sf).groupBy("provider_name", "status")
            .agg(F.count(F.lit(1)).alias("plans")))


@query(f"""SELECT count(*) FILTER (WHERE status <> 'conflict') AS processed,
  count(*) FILTER (WHERE status IN ('new', 'updated')) AS success,
  count(*) FILTER (WHERE status = 'conflict') AS errors,
  count(*) FILTER (WHERE status = 'new') AS new,
  count(*) FILTER (WHERE status = 'updated') AS updated,
  count(*) FILTER (WHERE status = 'unchanged') AS unchanged FROM ({DIFF})""")
def agg1_sync_report(spark: SparkSession, sf: str) -> DataFrame:
    return stats.sync_report(diffed(spark, sf))


LISTED = """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS provider_name
FROM orders WHERE o_totalprice > 100000 AND o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW')"""
GONE = f"""SELECT s.id, s.provider_name FROM ({STORED}) s
WHERE s.is_active AND s.provider_name <> '5-LOW'
  AND NOT EXISTS (SELECT 1 FROM ({LISTED}) l WHERE l.id = s.id)"""


def listed(spark: SparkSession, sf: str) -> DataFrame:
    """Ids still offered; one provider lists none."""
    o = table(spark, sf, "orders").filter(
        (F.col("o_totalprice") > 100000)
        & ~F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW"))
    return o.select(F.col("o_orderkey").cast("string").alias("id"),
                    F.col("o_orderpriority").alias("provider_name"))


def called(spark: SparkSession, sf: str) -> DataFrame:
    """Providers in the call: all but one."""
    return (table(spark, sf, "orders").filter(F.col("o_orderpriority") != "5-LOW")
            .select(F.col("o_orderpriority").alias("provider_name")).distinct())


@query(GONE)
def set3_missing_ids(spark: SparkSession, sf: str) -> DataFrame:
    return merge.missing_plans(stored(spark, sf), listed(spark, sf), called(spark, sf))


@query(f"""SELECT s.id, s.is_active AND g.id IS NULL AS is_active, g.id IS NOT NULL AS deactivated,
  CASE WHEN g.id IS NOT NULL THEN 2026 ELSE 2020 END AS updated_year
FROM ({STORED}) s LEFT JOIN ({GONE}) g ON s.id = g.id""")
def ant1_deactivate_missing(spark: SparkSession, sf: str) -> DataFrame:
    out = merge.deactivate_missing(stored(spark, sf), listed(spark, sf), called(spark, sf),
                                   run_time())
    return out.select("id", "is_active", "deactivated", F.year("updated_at").alias("updated_year"))


@query(f"""SELECT coalesce(o.id, n.id) AS id,
  CASE WHEN n.id IS NOT NULL THEN n.annual_limit ELSE o.annual_limit END AS annual_limit,
  o.claim_process AS claim_process, CASE WHEN n.id IS NULL THEN 2020 ELSE 2026 END AS created_year
FROM ({STORED}) o FULL JOIN ({INCOMING}) n ON n.id = o.id""")
def snk3_direct_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Plans written without comparison, as the single-row writes do."""
    out = merge.direct_upsert_plans(stored(spark, sf), incoming(spark, sf), run_time())
    return out.select("id", "annual_limit", "claim_process",
                      F.year("created_at").alias("created_year"))


# --- reads and counts -------------------------------------------------------
@query("""SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderstatus <> 'F' AND o_orderpriority = '1-URGENT'""")
def src6_active_plans(spark: SparkSession, sf: str) -> DataFrame:
    plans = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("provider_name"),
        (F.col("o_orderstatus") != "F").alias("is_active"))
    return filters.active_plans(plans, "1-URGENT").select("o_orderkey", "o_totalprice")


@query(f"""SELECT provider_name, count(*) AS plans FROM ({STORED}) WHERE is_active
GROUP BY provider_name""")
def agg6_active_count(spark: SparkSession, sf: str) -> DataFrame:
    return stats.active_count_by_provider(stored(spark, sf))


@query(f"""SELECT count(*) AS plans FROM ({STORED}) WHERE is_active
  AND provider_name = '2-HIGH'""")
def agg6_active_count_of_one(spark: SparkSession, sf: str) -> DataFrame:
    return stats.active_count(stored(spark, sf), "2-HIGH")


@query("""SELECT coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END, 'Unknown')
    AS provider_name, count(*) AS plans, count(DISTINCT o_custkey) AS unique_ids
FROM orders GROUP BY ALL""")
def agg8_group_by_provider(spark: SparkSession, sf: str) -> DataFrame:
    plans = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("provider_name"),
        F.col("o_custkey").alias("id"))
    return stats.group_by_provider(plans)


@query("""
SELECT batch, count(*) AS records,
  CASE WHEN bool_or(bad) THEN 0 ELSE count(*) END AS success,
  CASE WHEN bool_or(bad) THEN count(*) ELSE 0 END AS errors
FROM (SELECT (row_number() OVER (ORDER BY o_orderkey) - 1) // 500 + 1 AS batch,
        o_totalprice < 1500 AS bad FROM orders)
GROUP BY batch""")
def agg9_batch_accounting(spark: SparkSession, sf: str) -> DataFrame:
    return stats.batch_accounting(table(spark, sf, "orders"), "o_orderkey",
                                  failed=F.col("o_totalprice") < 1500)


# --- dedup and ids ----------------------------------------------------------
@query("""
SELECT id, seq, provider_name FROM (
  SELECT o_orderkey AS seq, CAST(o_custkey AS VARCHAR) AS id, o_orderpriority AS provider_name,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn
  FROM orders WHERE o_orderstatus = 'O') WHERE rn = 1""")
def dup2_keep_first_plan(spark: SparkSession, sf: str) -> DataFrame:
    """One plan per customer; plans of two states have no id."""
    o = table(spark, sf, "orders")
    plans = o.select(
        F.col("o_orderkey").alias("seq"),
        F.when(F.col("o_orderstatus") == "P", "").when(
            F.col("o_orderstatus") == "O", F.col("o_custkey").cast("string")).alias("id"),
        F.col("o_orderpriority").alias("provider_name"))
    return dedup.unique_plans(plans)


@query("""SELECT count(*) FILTER (WHERE o_orderstatus = 'O') AS kept,
  count(*) FILTER (WHERE o_orderstatus <> 'O') AS rejected FROM orders""")
def flt8_plans_without_id(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") == "P", "").when(
            F.col("o_orderstatus") == "O", F.col("o_orderkey").cast("string")).alias("id"))
    return stats.without_id_report(o)


# --- provider dimension and records -----------------------------------------
@query("""SELECT n_name AS provider_key, count(s_suppkey) AS plans
FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_acctbal > 5000
GROUP BY n_name""")
def agg2_plans_per_provider(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation")
    plans = (table(spark, sf, "supplier").filter(F.col("s_acctbal") > 5000)
             .select(F.col("s_nationkey").alias("n_nationkey"), F.col("s_suppkey").alias("id")))
    counted = stats.plans_per_provider(nation, plans, "n_nationkey")
    return (counted.join(nation, "n_nationkey")
            .select(F.col("n_name").alias("provider_key"), "plans"))


def providers(spark: SparkSession, sf: str) -> DataFrame:
    """The nations outside the first region as providers of part brands."""
    n = table(spark, sf, "nation").filter(F.col("n_regionkey") != 0)
    key = F.concat(F.lit("Brand#"), F.col("n_nationkey").cast("string"))
    return n.select(key.alias("provider_key"), F.col("n_name").alias("name"),
                    F.concat(F.lit("1300-"), F.col("n_nationkey").cast("string"))
                    .alias("contact_phone"),
                    F.concat(F.lit("https://"), F.lower("n_name"), F.lit(".example"))
                    .alias("website"))


DIM = """SELECT 'Brand#' || n_nationkey AS provider_key, n_name AS name,
  '1300-' || n_nationkey AS contact_phone, 'https://' || lower(n_name) || '.example' AS website
FROM nation WHERE n_regionkey <> 0"""


@query(f"""SELECT p_partkey, coalesce(d.name, p_brand) AS provider_name, d.contact_phone
FROM part LEFT JOIN ({DIM}) d ON p_brand = d.provider_key""")
def jon1_provider_lookup(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "part").select(
        "p_partkey", F.col("p_brand").alias("provider_key"), F.col("p_name").alias("plan_name"))
    return (records.plan_records(raw, providers(spark, sf), keep=("p_partkey",))
            .select("p_partkey", "provider_name", "contact_phone"))


@query(f"""
SELECT p_partkey, {sql_id("coalesce(d.name, p_brand)", "p_name")} AS id,
  coalesce(d.name, p_brand) AS provider_name, p_name AS plan_name, 'Medical' AS plan_type,
  CASE WHEN p_type <> 'ECONOMY' THEN p_size * 1000.0::DOUBLE END AS annual_limit,
  p_size * 1000000.0::DOUBLE AS lifetime_limit, p_retailprice AS deductible,
  p_size::DOUBLE AS co_payment_percentage, p_size AS min_age, p_size + 1 AS max_age,
  CAST(NULL AS BOOLEAN) AS dental_covered,
  CASE WHEN p_size > 25 THEN 'https://own' ELSE d.website END AS website, TRUE AS is_active
FROM part LEFT JOIN ({DIM}) d ON p_brand = d.provider_key""")
def prj4_plan_record(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    raw = table(spark, sf, "part").select(
        "p_partkey", F.col("p_brand").alias("provider_key"), F.col("p_name").alias("plan_name"),
        F.when(F.col("p_type") == "ECONOMY", F.lit("as charged"))
        .otherwise(F.concat(F.lit("RM "), size, F.lit(",000"))).alias("annual_limit"),
        F.concat(size, F.lit(" Million")).alias("lifetime_limit"),
        F.col("p_retailprice").alias("deductible"),
        F.concat(size, F.lit("% co-pay")).alias("co_payment_percentage"),
        F.concat(size, F.lit(" days old")).alias("min_age"), (F.col("p_size") + 1).alias("max_age"),
        F.when(F.col("p_size") > 25, "https://own").otherwise("").alias("website"))
    out = records.plan_records(raw, providers(spark, sf), keep=("p_partkey",))
    return out.select("p_partkey", "id", "provider_name", "plan_name", "plan_type", "annual_limit",
                      "lifetime_limit", "deductible", "co_payment_percentage", "min_age",
                      "max_age", "dental_covered", "website", "is_active")


@query("""
SELECT 0 AS provider_rank, s_name AS plan_name, s_acctbal AS deductible,
  CAST(NULL AS VARCHAR) AS plan_type FROM supplier
UNION ALL SELECT 1, c_name, NULL, c_mktsegment FROM customer""")
def set1_union_providers(spark: SparkSession, sf: str) -> DataFrame:
    """Two sources with different columns, in provider order."""
    a = table(spark, sf, "supplier").select(F.col("s_name").alias("plan_name"),
                                            F.col("s_acctbal").alias("deductible"))
    b = table(spark, sf, "customer").select(F.col("c_name").alias("plan_name"),
                                            F.col("c_mktsegment").alias("plan_type"))
    return union_providers([a, b])


# --- page facts and reply facts ---------------------------------------------
def fact_pages(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    return d.select(
        F.col("doc_id").alias("url"), F.lit("k").alias("provider_key"),
        F.concat(F.lit("Doc "), F.col("doc_id").cast("string")).alias("plan_name"),
        F.concat(F.lit("RM "), F.col("n_chars").cast("string")).alias("annual_limit"),
        F.when(F.col("lang") == "en", F.lit(True)).when(F.col("lang") == "fr", F.lit(False))
        .alias("outpatient_covered"))


def fact_replies(spark: SparkSession, sf: str) -> DataFrame:
    lab = table(spark, sf, "labels")
    return lab.select(
        F.col("doc_id").alias("url"),
        F.when(F.col("toxic") == 1, "").otherwise("Model plan").alias("plan_name"),
        F.when(F.col("toxic") == 1, nothing("string")).otherwise("Life").alias("plan_type"),
        F.col("quality").cast("double").alias("annual_limit"),
        F.when(F.col("quality") == 0, F.lit(False)).alias("outpatient_covered"),
        F.col("toxic").alias("min_age"))


MERGED = """SELECT d.doc_id AS url,
  CASE WHEN l.toxic = 0 THEN 'Model plan' ELSE 'Doc ' || d.doc_id END AS plan_name,
  CASE WHEN l.toxic = 0 THEN 'Life' ELSE 'Medical' END AS plan_type,
  'Individual' AS coverage_type,
  CASE WHEN l.quality <> 0 THEN l.quality ELSE d.n_chars END::DOUBLE AS annual_limit,
  CASE WHEN l.quality = 0 THEN FALSE WHEN d.lang = 'en' THEN TRUE
       WHEN d.lang = 'fr' THEN FALSE END AS outpatient_covered, l.toxic AS min_age
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


@query(MERGED)
def prj12_merge_facts(spark: SparkSession, sf: str) -> DataFrame:
    out = records.merge_facts(fact_pages(spark, sf), fact_replies(spark, sf))
    return out.select("url", "plan_name", "plan_type", "coverage_type", "annual_limit",
                      "outpatient_covered", "min_age")


@query("""SELECT count(*) AS pages, count(l.doc_id) AS with_reply
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def mrg4_pages_with_replies(spark: SparkSession, sf: str) -> DataFrame:
    out = records.merge_facts(fact_pages(spark, sf), fact_replies(spark, sf))
    return out.agg(F.count(F.lit(1)).alias("pages"), F.count("min_age").alias("with_reply"))


# --- source change detection ------------------------------------------------
def sources(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as sources, modified at their last order; no time where the
    balance is negative."""
    o = table(spark, sf, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("t"))
    c = table(spark, sf, "customer")
    iso = F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return c.join(o, c.c_custkey == o.o_custkey, "left").select(
        F.col("c_custkey").cast("string").alias("source_id"),
        F.when(F.col("c_acctbal") >= 0, iso).alias("modified_time"))


def state(spark: SparkSession, sf: str) -> DataFrame:
    """Times stored earlier: the last order that was not pending."""
    o = table(spark, sf, "orders").filter(F.col("o_orderstatus") != "P")
    last = o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("t"))
    return last.select(F.col("o_custkey").cast("string").alias("source_id"),
                       F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss+00:00").alias("last_modified"))


SOURCES = """SELECT CAST(c_custkey AS VARCHAR) AS source_id,
  CASE WHEN c_acctbal >= 0 THEN t END AS modified_time
FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS t FROM orders GROUP BY 1)
  ON c_custkey = o_custkey"""
STATE = """SELECT CAST(o_custkey AS VARCHAR) AS source_id, max(o_orderdate) AS last_modified
FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1"""


@query(f"""SELECT source_id, coalesce(modified_time > last_modified, TRUE) AS changed
FROM ({SOURCES}) LEFT JOIN ({STATE}) USING (source_id)""")
def src7_source_gate(spark: SparkSession, sf: str) -> DataFrame:
    out = S.changed_sources(sources(spark, sf), state(spark, sf))
    return out.select("source_id", "changed")


@query("""
SELECT o_orderstatus, coalesce(CASE WHEN o_orderpriority <> '5-LOW'
    THEN o_orderdate > l_shipdate END, TRUE) AS newer, count(*) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""")
def dat1_iso_time_compare(spark: SparkSession, sf: str) -> DataFrame:
    """Order time against shipping time, both as ISO text, one provider unreadable."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.when(
        F.col("o_orderpriority") == "5-LOW", F.lit("yesterday")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("cur"))
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss+00:00").alias("last"))
    return (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("o_orderstatus", S.newer("cur", "last").alias("newer"))
            .agg(F.count(F.lit(1)).alias("n")))
