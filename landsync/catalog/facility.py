"""Facility queries: ``part`` plays the sheet, ``customer`` the stored facilities
and ``events`` the lookup results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landsync.catalog.registry import nothing, query, run_time, sql_id, table
from landsync.functions.text import deterministic_id
from landsync.operators import dedup, filters, merge, records, stats
from landsync.plans.facility_sync import facility_batch
from landsync.sources.sheet import header_columns, sheet_rows

NBSP = " "


# --- bindings ---------------------------------------------------------------
def sheet(spark: SparkSession, sf: str) -> DataFrame:
    """``part`` as raw sheet rows."""
    return sheet_of(table(spark, sf, "part"))


def sheet_of(p: DataFrame) -> DataFrame:
    return p.select(
        F.col("p_partkey").alias("seq"),
        F.concat(F.lit(" "), "p_name",
                 F.when(F.col("p_type") == "ECONOMY", " 24 Jam").otherwise(""),
                 F.lit(NBSP)).alias("nama_penuh_fasiliti"),
        F.col("p_type").alias("jenis_fasiliti"), F.col("p_brand").alias("alamat"),
        F.col("p_size").cast("string").alias("poskod"))


SHEET = ("SELECT p_partkey AS seq, ' ' || p_name || CASE WHEN p_type = 'ECONOMY' THEN ' 24 Jam' "
         f"ELSE '' END || '{NBSP}' AS name, p_type AS facility_type, p_brand AS address, "
         "CAST(p_size AS VARCHAR) AS postcode FROM part")


def stored(spark: SparkSession, sf: str) -> DataFrame:
    """``customer`` as stored facilities: pending, failed and done."""
    c = table(spark, sf, "customer")
    lat = F.when(F.col("c_mktsegment") == "BUILDING", 3.5).when(F.col("c_acctbal") < 0, 0.0)
    return c.select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"),
        F.concat(F.lit("Road "), F.col("c_nationkey").cast("string")).alias("address"),
        F.col("c_mktsegment").alias("city"), nothing("string").alias("state"),
        nothing("string").alias("postcode"), F.lit("Clinic").alias("facility_type"),
        (F.col("c_nationkey") != 0).alias("is_active"),
        lat.alias("latitude"), lat.alias("longitude"),
        F.when(F.col("c_acctbal") > 5000, F.lit("03-1")).alias("phone"),
        nothing("string").alias("website"), nothing("double").alias("google_rating"))


STORED = """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
  'Road ' || c_nationkey AS address, c_mktsegment AS city, CAST(NULL AS VARCHAR) AS state,
  CAST(NULL AS VARCHAR) AS postcode, 'Clinic' AS facility_type, c_nationkey <> 0 AS is_active,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 3.5::DOUBLE WHEN c_acctbal < 0 THEN 0.0::DOUBLE END
    AS latitude,
  CASE WHEN c_acctbal > 5000 THEN '03-1' END AS phone
FROM customer"""


def results(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as lookup results, in order of ``event_id``."""
    e = table(spark, sf, "events")
    return results_of(e)


def results_of(e: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return e.select(
        F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").cast("string").alias("clinic_id"),
        (kind != "error").alias("scrape_success"),
        F.when(kind != "signup", F.col("value")).alias("latitude"),
        F.when(kind != "signup", F.col("value") * 2).alias("longitude"),
        F.when(kind == "click", F.get_json_object("props", "$.k")).alias("phone"),
        F.when(kind == "view", F.concat(F.lit("w"), F.col("event_id").cast("string")))
        .alias("website"),
        F.col("value").alias("google_rating"))


RESULTS = """SELECT event_id AS seq, ts, CAST(user_id AS VARCHAR) AS clinic_id,
  event_type <> 'error' AS scrape_success,
  CASE WHEN event_type <> 'signup' THEN value END AS latitude,
  CASE WHEN event_type <> 'signup' THEN value * 2 END AS longitude,
  CASE WHEN event_type = 'click' THEN json_extract_string(props, '$.k') END AS phone,
  CASE WHEN event_type = 'view' THEN 'w' || event_id END AS website,
  value AS google_rating
FROM events"""

# Joint effect of each facility's results, in order.
FOLDED = f"""SELECT clinic_id,
  (arg_max(struct_pack(v := CASE WHEN scrape_success THEN latitude ELSE 0.0 END), seq)).v
    AS latitude,
  (arg_max(struct_pack(v := CASE WHEN scrape_success THEN longitude ELSE 0.0 END), seq)).v
    AS longitude,
  arg_max(phone, seq) FILTER (WHERE scrape_success AND phone IS NOT NULL) AS phone,
  arg_max(website, seq) FILTER (WHERE scrape_success AND website IS NOT NULL) AS website,
  arg_max(google_rating, seq) FILTER (WHERE scrape_success AND google_rating IS NOT NULL)
    AS google_rating,
  arg_max(scrape_success, seq) AS scrape_success
FROM ({RESULTS}) GROUP BY clinic_id"""


# --- sheet and records ------------------------------------------------------
HEADER = [" bil ", "Jenis_Fasiliti", "other", "NAMA_PENUH_FASILITI", "POSKOD", "ALAMAT", "poskod"]


@query(rf"""
SELECT c_custkey AS seq, CAST(c_custkey AS VARCHAR) AS bil, c_mktsegment AS jenis_fasiliti,
  c_name AS nama_penuh_fasiliti, '12, "Road" ' || c_nationkey AS alamat,
  CASE WHEN c_acctbal < 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS poskod
FROM customer WHERE c_mktsegment <> 'BUILDING'
""")
def src1_sheet_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as lines of CSV text, read back as cells with padded values, a
    repeated header, short rows, blank rows and rows without a name."""
    c = table(spark, sf, "customer")
    named = F.col("c_mktsegment") != "BUILDING"
    line = F.to_csv(F.struct(
        F.col("c_custkey").cast("string").alias("a"), F.col("c_mktsegment").alias("b"),
        F.lit("x").alias("c"),
        F.when(named, F.concat(F.lit("  "), "c_name", F.lit(NBSP))).alias("d"),
        F.lit("00000").alias("e"),
        F.concat(F.lit(' 12, "Road" '), F.col("c_nationkey").cast("string"), F.lit(" "))
        .alias("f"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey").cast("string")).alias("g")),
        {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
         "escape": '"'})
    line = F.when(named | (F.col("c_acctbal") >= 0), line).otherwise(F.lit(",,,,,,"))
    schema = ", ".join(f"c{i} string" for i in range(len(HEADER)))
    parsed = F.from_csv(line, F.lit(schema), {"escape": '"'})
    cells = c.select(F.col("c_custkey").alias("seq"), parsed.alias("p")).select(
        "seq", F.array(*[F.col(f"p.c{i}") for i in range(len(HEADER))]).alias("cells"))
    return sheet_rows(cells, header_columns(HEADER))


@query(f"SELECT *, '' AS city, '' AS state FROM ({SHEET})")
def prj1_rename_sheet(spark: SparkSession, sf: str) -> DataFrame:
    return records.rename_sheet(sheet(spark, sf))


@query(f"""
SELECT seq, {sql_id('name', 'address')} AS id, name, facility_type, address,
  CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state, postcode,
  facility_type = 'ECONOMY' AS is_24_hours, FALSE AS is_government, TRUE AS is_active,
  CAST(NULL AS VARCHAR) AS email, CAST(NULL AS BOOLEAN) AS has_emergency
FROM ({SHEET})""")
def prj2_facility_record(spark: SparkSession, sf: str) -> DataFrame:
    rows = records.rename_sheet(sheet(spark, sf))
    return records.facility_records(rows, run_time()).drop("updated_at")


@query(f"""SELECT c_custkey, {sql_id("c_name || '  '", "upper(c_mktsegment)")} AS id
FROM customer""")
def prj3_deterministic_id(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select("c_custkey", deterministic_id(
        F.concat(F.lit(NBSP), F.upper("c_name")), F.concat("c_mktsegment", F.lit("\t"))).alias("id"))


@query("""
SELECT c_custkey, concat_ws(', ', c_name, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END,
  n_name, CASE WHEN c_acctbal >= 0 THEN r_name END, 'Malaysia') AS query
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def prj5_search_query(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    rows = (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select("c_custkey", F.col("c_name").alias("name"),
                    F.when(F.col("c_mktsegment") == "BUILDING", "")
                    .otherwise(F.col("c_mktsegment")).alias("address"),
                    F.col("n_name").alias("city"),
                    F.when(F.col("c_acctbal") >= 0, F.col("r_name")).alias("state")))
    return rows.select("c_custkey", records.search_query().alias("query"))


# --- dedup, upsert, queue ---------------------------------------------------
@query(f"""
SELECT id, seq, name FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn
  FROM (SELECT {sql_id('name', 'address')} AS id, seq, name FROM ({SHEET})))
WHERE rn = 1""")
def dup1_keep_first_facility(spark: SparkSession, sf: str) -> DataFrame:
    rows = records.rename_sheet(sheet(spark, sf))
    return dedup.unique_facilities(records.facility_records(rows, run_time())).select("id", "seq", "name")


@query(f"""
SELECT count(*) AS rows_in, count(DISTINCT id) AS unique_rows,
  count(*) - count(DISTINCT id) AS removed
FROM (SELECT {sql_id('name', 'address')} AS id FROM ({SHEET}))""")
def agg7_duplicate_report(spark: SparkSession, sf: str) -> DataFrame:
    rows = records.rename_sheet(sheet(spark, sf))
    return dedup.duplicate_report(records.facility_records(rows, run_time()))


@query(f"""
WITH tgt AS ({STORED}),
old AS (SELECT * FROM tgt WHERE city <> 'MACHINERY'),
src AS (SELECT CAST(c_custkey AS VARCHAR) AS id, upper(c_name) AS name,
    CASE WHEN c_acctbal > 8000 THEN NULL ELSE 'new' END AS phone
  FROM customer WHERE c_acctbal > 1000)
SELECT coalesce(src.id, old.id) AS id,
  CASE WHEN src.id IS NOT NULL THEN src.name ELSE old.name END AS name,
  CASE WHEN src.id IS NOT NULL THEN src.phone ELSE old.phone END AS phone,
  old.city AS city, old.latitude AS latitude
FROM old FULL JOIN src ON old.id = src.id""")
def mrg1_facility_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The stored table without one segment takes a batch with two columns."""
    target = (stored(spark, sf).filter(F.col("city") != "MACHINERY")
              .select("id", "name", "phone", "city", "latitude"))
    c = table(spark, sf, "customer").filter(F.col("c_acctbal") > 1000)
    batch = c.select(F.col("c_custkey").cast("string").alias("id"),
                     F.upper("c_name").alias("name"),
                     F.when(F.col("c_acctbal") > 8000, nothing("string"))
                     .otherwise("new").alias("phone"))
    return merge.upsert(target, batch)


@query(f"""SELECT id, name, address, city, state, postcode, facility_type
FROM ({STORED}) WHERE latitude IS NULL AND is_active""")
def flt2_pending_facilities(spark: SparkSession, sf: str) -> DataFrame:
    return filters.pending(stored(spark, sf))


@query(f"""SELECT id, name, address, city, state, postcode, facility_type
FROM ({STORED}) WHERE latitude IS NULL AND is_active ORDER BY id LIMIT 50""")
def lim1_work_batch(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.work_batch(filters.pending(stored(spark, sf)), 50)


@query(f"SELECT count(*) AS pending FROM ({STORED}) WHERE latitude IS NULL AND is_active")
def agg5_pending_count(spark: SparkSession, sf: str) -> DataFrame:
    return stats.pending_count(stored(spark, sf))


# --- lookup results ---------------------------------------------------------
@query(f"""SELECT clinic_id, latitude, longitude, phone, website, google_rating
FROM ({FOLDED.replace('FROM (' + RESULTS + ')', 'FROM (' + RESULTS + ') WHERE scrape_success')})""")
def prj6_enrichment_update(spark: SparkSession, sf: str) -> DataFrame:
    """Update record per facility from its successful lookups."""
    good = results(spark, sf).filter("scrape_success")
    return merge.fold_results(good).drop("scrape_success")


@query(f"""
SELECT f.id, CASE WHEN r.clinic_id IS NOT NULL THEN 0.0 ELSE f.latitude END AS latitude, f.phone,
  CASE WHEN r.clinic_id IS NOT NULL OR f.latitude = 0 THEN 'failed'
       WHEN f.latitude IS NULL THEN 'pending' ELSE 'done' END AS state
FROM ({STORED}) f LEFT JOIN (SELECT DISTINCT clinic_id FROM ({RESULTS})
  WHERE NOT scrape_success) r ON f.id = r.clinic_id""")
def prj7_failure_marker(spark: SparkSession, sf: str) -> DataFrame:
    """Facilities after failed lookups only, with the state the marker encodes."""
    bad = results(spark, sf).filter("not scrape_success")
    out = merge.apply_results(stored(spark, sf), merge.fold_results(bad))
    return out.select("id", "latitude", "phone", filters.enrichment_state().alias("state"))


@query(f"""
SELECT f.id, CASE WHEN r.clinic_id IS NOT NULL THEN r.latitude ELSE f.latitude END AS latitude,
  coalesce(r.phone, f.phone) AS phone, r.website AS website, r.google_rating AS google_rating
FROM ({STORED}) f LEFT JOIN ({FOLDED}) r ON f.id = r.clinic_id""")
def mrg3_apply_results(spark: SparkSession, sf: str) -> DataFrame:
    out = merge.apply_results(stored(spark, sf), merge.fold_results(results(spark, sf)))
    return out.select("id", "latitude", "phone", "website", "google_rating")


@query(f"""
SELECT f.id, CAST(CASE WHEN coalesce(r.latitude, 0) <> 0 THEN 1 ELSE 0 END
  + CASE WHEN coalesce(r.longitude, 0) <> 0 THEN 1 ELSE 0 END
  + CASE WHEN coalesce(r.phone, '') <> '' THEN 1 ELSE 0 END
  + CASE WHEN coalesce(r.google_rating, 0) <> 0 THEN 1 ELSE 0 END
  + CASE WHEN r.website IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS filled
FROM ({STORED}) f LEFT JOIN ({FOLDED}) r ON f.id = r.clinic_id""")
def prj9_completeness(spark: SparkSession, sf: str) -> DataFrame:
    """Filled compulsory fields per facility; the website stands in as a service."""
    folded = merge.fold_results(results(spark, sf))
    joined = stored(spark, sf).select("id").join(
        folded, F.col("id") == F.col("clinic_id"), "left").withColumn(
        "services", F.array_compact(F.array("website")))
    return joined.select("id", records.completeness(joined).alias("filled"))


@query(f"""SELECT count(*) AS total, count(*) FILTER (WHERE scrape_success) AS success,
  count(*) FILTER (WHERE NOT scrape_success) AS failed FROM ({RESULTS})""")
def agg3_scrape_totals(spark: SparkSession, sf: str) -> DataFrame:
    return stats.scrape_totals(results(spark, sf))


@query(f"""
WITH merged AS (SELECT f.id, f.is_active,
    CASE WHEN r.clinic_id IS NOT NULL THEN r.latitude ELSE f.latitude END AS latitude
  FROM ({STORED}) f LEFT JOIN ({FOLDED}) r ON f.id = r.clinic_id)
SELECT (SELECT count(*) FROM ({RESULTS}) WHERE scrape_success) AS updated,
  (SELECT count(*) FROM ({RESULTS}) WHERE NOT scrape_success) AS failed,
  (SELECT count(*) FROM merged WHERE latitude IS NULL AND is_active) AS remaining""")
def agg4_update_totals(spark: SparkSession, sf: str) -> DataFrame:
    found = results(spark, sf)
    merged = merge.apply_results(stored(spark, sf), merge.fold_results(found))
    return stats.update_totals(found, merged)


@query("""
SELECT count(*) FILTER (WHERE event_type NOT IN ('signup', 'view')) AS identified,
  count(*) FILTER (WHERE event_type IN ('signup', 'view')) AS failed FROM events""")
def flt9_results_without_id(spark: SparkSession, sf: str) -> DataFrame:
    """Signups lose their facility id and views have an empty one."""
    kind = F.col("event_type")
    rows = table(spark, sf, "events").select(
        F.when(kind == "view", "").when(kind != "signup", F.col("user_id").cast("string"))
        .alias("clinic_id"))
    return stats.without_id_report(rows, "clinic_id").select(
        F.col("kept").alias("identified"), F.col("rejected").alias("failed"))


@query(f"""
SELECT count(*) AS facilities, count(*) FILTER (WHERE is_24_hours) AS open_24_hours
FROM (SELECT DISTINCT id, first_value(is24) OVER (PARTITION BY id ORDER BY seq) AS is_24_hours
  FROM (SELECT {sql_id('name', 'address')} AS id, seq, facility_type = 'ECONOMY' AS is24
        FROM ({SHEET})))""")
def facility_load(spark: SparkSession, sf: str) -> DataFrame:
    """Rename, build, id and keep-first in one job."""
    batch = facility_batch(records.rename_sheet(sheet(spark, sf)), run_time())
    return batch.agg(F.count(F.lit(1)).alias("facilities"),
                     stats.count_if(F.col("is_24_hours")).alias("open_24_hours"))


