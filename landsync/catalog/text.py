"""Text, number and array queries over ``part``, ``supplier``, ``documents`` and
``conversations``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landsync import rules
from landsync.catalog.registry import nothing, query, sql_quote, sql_trim, table
from landsync.functions import text as X
from landsync.operators import extract, filters, inference
from landsync.operators.dedup import unique_names
from landsync.operators.stats import count_if


def _sql_any(x: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {sql_quote(w)})" for w in words) + ")"


def _sql_alternation(words: list[str]) -> str:
    return "|".join(rf"\Q{w}\E" for w in words)


# --- numbers in text --------------------------------------------------------
MONEY = {"ECONOMY": ("RM ", ",000"), "SMALL": ("", ".5 million"), "STANDARD": ("RM", "/day")}


def _size() -> Column:
    return F.col("p_size").cast("string")


@query("""SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN p_size * 1000.0::DOUBLE
  WHEN 'SMALL' THEN (p_size + 0.5::DOUBLE) * 1000000.0::DOUBLE WHEN 'STANDARD' THEN NULL
  ELSE p_size::DOUBLE END AS money FROM part""")
def txt1_money(spark: SparkSession, sf: str) -> DataFrame:
    text = _size()
    for kind, (before, after) in MONEY.items():
        text = F.when(F.col("p_type") == kind,
                      F.concat(F.lit(before), _size(), F.lit(after))).otherwise(text)
    return table(spark, sf, "part").select("p_partkey", X.parse_money(text).alias("money"))


@query("""SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN NULL
  ELSE (p_size + 0.25::DOUBLE) END AS percent FROM part""")
def txt2_percentage(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("p_type") == "ECONOMY", "none").otherwise(
        F.concat(F.lit("co-pay "), _size(), F.lit(".25% of 90")))
    return table(spark, sf, "part").select("p_partkey", X.parse_percentage(text).alias("percent"))


@query("""SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN NULL ELSE p_size END AS whole
FROM part""")
def txt3_integer(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("p_type") == "ECONOMY", "n/a").otherwise(
        F.concat(F.lit("from "), _size(), F.lit(" days to 70")))
    return table(spark, sf, "part").select("p_partkey", X.parse_int(text).alias("whole"))


def map_urls(spark: SparkSession, sf: str) -> DataFrame:
    """Map URLs of suppliers: latitude from the key, first notation out of range
    for some nations, none for others."""
    lat = F.concat(F.col("s_nationkey").cast("string"), F.lit("."),
                   F.col("s_suppkey").cast("string"))
    lng = F.concat(F.lit("-10"), F.col("s_nationkey").cast("string"))
    first = F.when(F.col("s_nationkey") < 5, F.concat(F.lit("@95.5,"), lng)).otherwise(
        F.concat(F.lit("@"), lat, F.lit(","), lng))
    second = F.when(F.col("s_nationkey") > 2, F.concat(F.lit("!3d-"), lat, F.lit("!4d"), lng)
                    ).otherwise("")
    url = F.when(F.col("s_nationkey") > 20, "https://maps.example/search").otherwise(
        F.concat(F.lit("https://maps.example/place/"), first, F.lit(",17z"), second))
    return table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", url.alias("url"))


@query("""
WITH u AS (SELECT s_suppkey, s_nationkey AS n, CAST(s_nationkey || '.' || s_suppkey AS DOUBLE) AS lat,
    CAST('-10' || s_nationkey AS DOUBLE) AS lng FROM supplier)
SELECT s_suppkey, CASE WHEN n > 20 OR n <= 2 OR abs(lng) > 180 THEN NULL WHEN n < 5 THEN -lat
    ELSE lat END AS latitude,
  CASE WHEN n > 20 OR n <= 2 OR abs(lng) > 180 THEN NULL ELSE lng END AS longitude FROM u""")
def txt4_coordinates(spark: SparkSession, sf: str) -> DataFrame:
    point = X.coordinates("url")
    return map_urls(spark, sf).select("s_suppkey", point["latitude"].alias("latitude"),
                                      point["longitude"].alias("longitude"))


@query("""SELECT s_suppkey, CASE WHEN s_nationkey < 8 THEN '0xa' || s_suppkey || ':0'
  WHEN s_nationkey < 16 THEN 'ChIJ_' || s_suppkey WHEN s_nationkey < 22 THEN 'p-' || s_suppkey
  END AS place_id FROM supplier""")
def txt5_place_id(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("s_suppkey").cast("string")
    n = F.col("s_nationkey")
    url = (F.when(n < 8, F.concat(F.lit("x/ChIJzz!1s0xa"), key, F.lit(":0x9!8m")))
           .when(n < 16, F.concat(F.lit("q=place_id:no&id=ChIJ_"), key, F.lit("&")))
           .when(n < 22, F.concat(F.lit("?place_id=p-"), key, F.lit("&hl")))
           .otherwise("https://maps.example/"))
    return table(spark, sf, "supplier").select("s_suppkey", X.place_id(url).alias("place_id"))


@query("""SELECT s_suppkey, CASE WHEN s_nationkey < 20 THEN (s_nationkey // 5 + 0.5::DOUBLE)
  WHEN s_nationkey < 23 THEN 4.0::DOUBLE END AS rating FROM supplier""")
def txt6_rating(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("s_nationkey")
    text = (F.when(n < 20, F.concat(F.floor(n / 5).cast("string"), F.lit(",5 stars")))
            .when(n < 23, F.lit("4 stars")).otherwise("new"))
    return table(spark, sf, "supplier").select("s_suppkey", X.parse_rating(text).alias("rating"))


@query("""SELECT s_suppkey, CASE WHEN s_nationkey < 20 THEN CAST(s_suppkey || '287' AS INTEGER)
  END AS reviews FROM supplier""")
def txt7_review_count(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("s_nationkey") < 20, F.concat(
        F.lit("("), F.col("s_suppkey").cast("string"), F.lit(",2 87 reviews)"))).otherwise("none")
    return table(spark, sf, "supplier").select(
        "s_suppkey", X.parse_review_count(text).alias("reviews"))


@query(r"""
SELECT doc_id, nullif(regexp_replace(trim(regexp_extract(text, '[\d\s+\-()]{8,}'), E' \t\n\r\f'),
  '[^\d+\-\s()]+', '', 'g'), '') AS phone, nullif(regexp_replace(
  regexp_replace(source, '^src', '012-'), '[^\d+\-\s()]+', '', 'g'), '') AS own FROM documents""")
def txt8_phone(spark: SparkSession, sf: str) -> DataFrame:
    """Phone-like runs in whole texts by the label rule, and a phone attribute made
    from the source by the attribute rule."""
    d = table(spark, sf, "documents")
    empty = F.array().cast("array<string>")
    attribute = F.concat(F.lit("phone:tel:"), F.regexp_replace("source", "^src", "012-"))
    return d.select(
        "doc_id", X.pick_phone(nothing("string"), "text", empty, empty).alias("phone"),
        X.pick_phone(attribute, "text", empty, empty).alias("own"))


def _lines() -> Column:
    return F.split("text", "\n")


SQL_LINES = rf"""SELECT doc_id, i, {sql_trim('line')} AS line FROM (
  SELECT doc_id, unnest(string_split(text, E'\n')) AS line,
    generate_subscripts(string_split(text, E'\n'), 1) AS i FROM documents)"""


@query(rf"""
WITH l AS ({SQL_LINES}), good AS (SELECT * FROM l WHERE length(line) > 3)
SELECT d.doc_id, coalesce((SELECT string_agg(replace(line, E'\t', ' '), '|' ORDER BY i) FROM good g
    WHERE g.doc_id = d.doc_id),
  CASE WHEN length(d.source || d.lang || 'hours of opening') > 10
    THEN d.source || d.lang || 'hours of opening' END) AS hours
FROM documents d""")
def txt9_opening_hours(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of whole texts as opening-hours entries."""
    label = F.concat("source", "lang", F.lit("hours of opening"))
    hours = X.pick_hours(F.array(F.array().cast("array<string>"), _lines()), label)
    return table(spark, sf, "documents").select(
        "doc_id", F.array_join(hours["weekday_text"], "|").alias("hours"))


@query(rf"""
WITH l AS ({SQL_LINES}), good AS (
  SELECT doc_id, line, min(i) AS i FROM l WHERE length(line) > 3 AND length(line) < 100
  GROUP BY doc_id, line),
top AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS rn FROM good),
c AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS rn FROM l
  WHERE length(line) > 0 AND length(line) < 100)
SELECT d.doc_id, s.services, c.line AS specialty FROM documents d
LEFT JOIN (SELECT doc_id, string_agg(line, '|' ORDER BY i) AS services FROM top
  GROUP BY doc_id) s USING (doc_id)
LEFT JOIN c ON c.doc_id = d.doc_id AND c.rn = 1""")
def dup5_services(spark: SparkSession, sf: str) -> DataFrame:
    services = X.pick_services(F.array(_lines()))
    return table(spark, sf, "documents").select(
        "doc_id", F.array_join(services, "|").alias("services"),
        F.get(X.pick_specialties(_lines()), F.lit(0)).alias("specialty"))


# --- coverage, limits, ages, flags ------------------------------------------
# Words that occur in the documents, beside the insurance words.
EXTRA_WORDS = {"outpatient_covered": ["token", "api_key", "outpatient"],
               "maternity_covered": ["license", "copyright"],
               "dental_covered": ["@"], "optical_covered": ["hour"],
               "mental_health_covered": ["year"]}
ALL_WORDS = {**rules.COVERAGE_WORDS, **{k: rules.COVERAGE_WORDS[k] + v
                                        for k, v in EXTRA_WORDS.items()}}


def clauses(spark: SparkSession, sf: str) -> DataFrame:
    """Policy clauses made from orders: which words occur depends on the row."""
    o = table(spark, sf, "orders")
    status, low = F.col("o_orderstatus"), F.col("o_orderpriority")
    price = F.floor("o_totalprice").cast("string")
    return o.select("o_orderkey", F.concat(
        F.lit("Order "), F.col("o_orderkey").cast("string"),
        F.when(status == "F", " Out-Patient care.").when(status == "O", " OUTPATIENT ward.")
        .otherwise(" A ward."),
        F.when(low == "5-LOW", " This is Not Covered.").otherwise(""),
        F.when(low == "2-HIGH", " Dental and eye care.").otherwise(""),
        F.when(low == "1-URGENT", " Psychiatric help.").otherwise(""),
        F.when(status == "P", F.concat(F.lit(" Annual  limit: RM "), price)).otherwise(
            F.concat(F.lit(" yearly limit RM"), price)),
        F.when(low == "3-MEDIUM", " Overall Limit: 1.5 Million").otherwise(""),
        F.lit("\nRoom & Board: RM 250 per day, entry age: 15 days - 70 years old\n")).alias("text"))


CLAUSES = r"""SELECT o_orderkey, 'Order ' || o_orderkey
  || CASE o_orderstatus WHEN 'F' THEN ' Out-Patient care.' WHEN 'O' THEN ' OUTPATIENT ward.'
     ELSE ' A ward.' END
  || CASE WHEN o_orderpriority = '5-LOW' THEN ' This is Not Covered.' ELSE '' END
  || CASE WHEN o_orderpriority = '2-HIGH' THEN ' Dental and eye care.' ELSE '' END
  || CASE WHEN o_orderpriority = '1-URGENT' THEN ' Psychiatric help.' ELSE '' END
  || CASE WHEN o_orderstatus = 'P' THEN ' Annual  limit: RM ' ELSE ' yearly limit RM' END
  || CAST(floor(o_totalprice) AS BIGINT)
  || CASE WHEN o_orderpriority = '3-MEDIUM' THEN ' Overall Limit: 1.5 Million' ELSE '' END
  || E'\nRoom & Board: RM 250 per day, entry age: 15 days - 70 years old\n' AS text FROM orders"""


def _sql_flags(low: str, words: dict[str, list[str]]) -> str:
    out = []
    for name, group in words.items():
        value = "TRUE"
        if name == "outpatient_covered":
            value = f"(NOT contains({low}, 'not covered') OR contains({low}, 'outpatient'))"
        out.append(f"CASE WHEN {_sql_any(low, group)} THEN {value} END AS {name}")
    return ", ".join(out)


@query(f"""SELECT o_orderkey, {_sql_flags('low', rules.COVERAGE_WORDS)}
FROM (SELECT o_orderkey, lower(text) AS low FROM ({CLAUSES}))""")
def txt10_coverage_clauses(spark: SparkSession, sf: str) -> DataFrame:
    low = clauses(spark, sf).withColumn("low", F.lower("text"))
    return low.select("o_orderkey", *[v.alias(k) for k, v in extract.coverage_flags("low").items()])


@query(f"""SELECT doc_id, {_sql_flags('low', ALL_WORDS)}
FROM (SELECT doc_id, lower(text) AS low FROM documents)""")
def txt10_coverage_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents, with words added that occur in them."""
    low = table(spark, sf, "documents").select("doc_id", F.lower("text").alias("low"))
    return low.select("doc_id", *[v.alias(k) for k, v in
                                  extract.coverage_flags("low", ALL_WORDS).items()])


@query("""SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT)::VARCHAR AS annual_limit,
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN '1.5 million' END AS lifetime_limit,
  '250' AS room_board_limit,
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1500000.0::DOUBLE END AS lifetime_amount
FROM orders""")
def txt11_limits(spark: SparkSession, sf: str) -> DataFrame:
    low = clauses(spark, sf).withColumn("low", F.lower("text"))
    found = low.select("o_orderkey", *[v.alias(k) for k, v in extract.limit_texts("low").items()])
    return found.withColumn("lifetime_amount", X.parse_money("lifetime_limit"))


@query(rf"""SELECT doc_id,
  nullif(coalesce(nullif(regexp_extract(text, '(?i)(the\s+[a-z]+ing)\b', 1), ''),
    nullif(regexp_extract(text, '(?i)([a-z]+tion\s+[a-z]+)', 1), '')), '') AS phrase
FROM documents""")
def txt12_phrase_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Ordered ignore-case patterns over whole documents."""
    table_ = {"k": [r"(?i)(the\s+[a-z]+ing)\b", r"(?i)([a-z]+tion\s+[a-z]+)"]}
    d = table(spark, sf, "documents").withColumn("provider_key", F.lit("k"))
    return d.select("doc_id", extract.eligible_age("text", patterns=table_).alias("phrase"))


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN
  (o_orderkey % 28 + 1) || ' days - ' || (o_orderkey % 40 + 50) || ' years old' END AS age FROM orders""")
def txt12_eligible_age(spark: SparkSession, sf: str) -> DataFrame:
    """Phrases that vary by row, under each provider's own age patterns."""
    key = F.create_map(*[F.lit(x) for pair in (
        ("1-URGENT", "AIA"), ("2-HIGH", "Allianz"), ("3-MEDIUM", "GreatEastern"),
        ("4-NOT SPECIFIED", "Etiqa"), ("5-LOW", "nobody")) for x in pair])
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    phrase = F.concat(F.lit("Entry age: "), (k % 28 + 1).cast("string"), F.lit(" days - "),
                      (k % 40 + 50).cast("string"), F.lit(" years old\n"))
    return o.select("o_orderkey", phrase.alias("text"), F.element_at(key, F.col("o_orderpriority"))
                    .alias("provider_key")).select(
        "o_orderkey", extract.eligible_age("text").alias("age"))


@query("""SELECT doc_id, CASE WHEN contains(lower(text), '24 hour') OR contains(lower(text),
  '24-hour') OR contains(lower(text), 'emergency') OR lang = 'de' THEN TRUE END AS emergency,
  contains(upper(text), '24 JAM') OR contains(upper(text), '24JAM') OR lang = 'es' AS open_24
FROM documents""")
def txt19_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents; a notice is added to those of two languages."""
    lang = F.col("lang")
    text = F.concat("text", F.when(lang == "de", " Emergency ward").when(
        lang == "es", " Klinik 24jam").otherwise(""))
    return table(spark, sf, "documents").select(
        "doc_id", X.emergency_flag(text).alias("emergency"),
        X.is_open_24_hours(text).alias("open_24"))


# --- plan names -------------------------------------------------------------
def names(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("p_type")
    name = (F.when(kind == "ECONOMY", F.concat(F.lit("Smart "), "p_name"))
            .when(kind == "SMALL", F.concat(F.lit("Home "), "p_name"))
            .when(kind == "STANDARD", F.concat(F.col("p_size").cast("string"), F.lit(" "), "p_name"))
            .otherwise(F.col("p_name")))
    return table(spark, sf, "part").select("p_partkey", "p_type", name.alias("name"))


NAMES = """SELECT p_partkey, p_type, CASE p_type WHEN 'ECONOMY' THEN 'Smart ' || p_name
  WHEN 'SMALL' THEN 'Home ' || p_name WHEN 'STANDARD' THEN p_size || ' ' || p_name
  ELSE p_name END AS name FROM part"""


def _sql_plan_name(x: str) -> str:
    low = sql_trim(f"lower({x})")
    return rf"""(length({x}) BETWEEN 4 AND 80 AND regexp_matches({x}, '^\pL')
  AND length(regexp_replace({x}, '\PL', '', 'g')) >= 3
  AND (length({x}) >= 12 OR regexp_matches({low},
    '^(?:{_sql_alternation(rules.KNOWN_NAME_PREFIXES)})'))
  AND NOT regexp_matches({low}, '{_sql_alternation(rules.BLOCKED_NAME_PARTS)}'))"""


@query(f"SELECT p_partkey, name, {_sql_plan_name('name')} AS valid FROM ({NAMES})")
def flt1_plan_names(spark: SparkSession, sf: str) -> DataFrame:
    return names(spark, sf).withColumn("valid", filters.is_plan_name("name")).drop("p_type")


@query("""SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN TRUE
  WHEN 'SMALL' THEN length('Great Eastern ' || p_size) < 20 ELSE FALSE END AS false_hit FROM part""")
def flt4_false_names(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("p_type")
    size = F.col("p_size").cast("string")
    rows = table(spark, sf, "part").select(
        "p_partkey",
        F.when(kind == "ECONOMY", "Etiqa").when(kind == "SMALL", "GreatEastern")
        .otherwise("AIA").alias("key"),
        F.when(kind == "ECONOMY", F.concat(F.lit("Etiqa Insurance "), "p_name"))
        .otherwise(F.concat(F.lit("Great Eastern "), size)).alias("name"))
    return rows.select("p_partkey", filters.false_name("key", "name").alias("false_hit"))


@query("""
WITH c AS (SELECT p_brand AS provider_key, p_name AS name, 0 AS strategy, p_partkey AS pos FROM part
  UNION ALL SELECT p_brand, upper(p_name), 1, p_partkey FROM part)
SELECT provider_key, name, strategy, pos FROM (SELECT *, row_number() OVER (
  PARTITION BY provider_key, lower(name) ORDER BY strategy, pos) AS rn FROM c) WHERE rn = 1""")
def dup3_unique_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names of two strategies; the second writes them in capitals."""
    p = table(spark, sf, "part")
    first = p.select(F.col("p_brand").alias("provider_key"), F.col("p_name").alias("name"),
                     F.lit(0).alias("strategy"), F.col("p_partkey").alias("pos"))
    second = first.select("provider_key", F.upper("name").alias("name"),
                          F.lit(1).alias("strategy"), "pos")
    return unique_names(first.unionByName(second), ("strategy", "pos"))


# --- text for analysis ------------------------------------------------------
@query(f"""SELECT count(*) FILTER (WHERE length(text) > 500) AS pages,
  count(*) FILTER (WHERE length({sql_trim('text')}) >= 100) AS documents FROM documents""")
def flt5_length_gates(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    return d.agg(count_if(filters.long_enough("text")).alias("pages"),
                 count_if(filters.document_long_enough("text")).alias("documents"))


_CONTEXT = {"plan_name": "'Doc ' || doc_id", "description": "coalesce(CASE WHEN lang <> 'fr' THEN "
            "source END, 'Not available')", "eligible_age": "'Not specified'",
            "provider_name": "lang"}
_SQL_PROMPT = " || ".join(
    [sql_quote(inference.PROMPT_HEAD),
     "text"]
    + [f"{sql_quote(label)} || {_CONTEXT[name]}" for label, name in inference.PROMPT_CONTEXT])


@query(f"""SELECT doc_id, length(prompt) AS chars, md5(prompt) AS digest FROM (
  SELECT doc_id, {_SQL_PROMPT} AS prompt FROM documents
  WHERE length({sql_trim('text')}) >= 100)""")
def prj10_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """Prompts over whole documents."""
    d = table(spark, sf, "documents").select(
        "doc_id", "text", F.concat(F.lit("Doc "), F.col("doc_id").cast("string")).alias("plan_name"),
        F.when(F.col("lang") != "fr", F.col("source")).alias("description"),
        F.col("lang").alias("provider_name"))
    out = inference.prompts(d)
    return out.select("doc_id", F.length("prompt").cast("long").alias("chars"),
                      F.md5("prompt").alias("digest"))


_PART, _OVERLAP = 4_000, 400
_SQL_PARTS = f"""(SELECT * EXCLUDE (whole), substr(whole, part * {_PART - _OVERLAP} + 1, {_PART}) AS text
  FROM (SELECT *, unnest(range(n_parts)) AS part FROM (SELECT doc_id, lang, source, text AS whole,
    greatest(ceil((length(text) - {_OVERLAP}) / {_PART - _OVERLAP}), 1)::INTEGER AS n_parts
    FROM documents WHERE length({sql_trim('text')}) >= 100)))"""


@query(f"""SELECT doc_id, part::INTEGER AS part, n_parts, length(prompt) AS chars, md5(prompt) AS digest
FROM (SELECT *, {_SQL_PROMPT} AS prompt FROM {_SQL_PARTS})""")
def prj10_part_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """Prompts over overlapping parts of whole documents."""
    d = table(spark, sf, "documents").select(
        "doc_id", "text", F.concat(F.lit("Doc "), F.col("doc_id").cast("string")).alias("plan_name"),
        F.when(F.col("lang") != "fr", F.col("source")).alias("description"),
        F.col("lang").alias("provider_name"))
    return inference.part_prompts(d, part_chars=_PART, overlap=_OVERLAP).select(
        "doc_id", "part", "n_parts", F.length("prompt").cast("long").alias("chars"),
        F.md5("prompt").alias("digest"))


@query(f"""WITH p AS {_SQL_PARTS}, e AS (
  SELECT doc_id, substr(text, 1, 1) AS entry, min(part) AS place FROM p GROUP BY ALL)
SELECT doc_id, count(*) AS n_replies,
  min_by(substr(text, 1, 12), part) FILTER (WHERE part % 2 = 1) AS plan_name,
  min_by(length(text), part)::DOUBLE AS annual_limit, max(n_parts) AS min_age,
  bool_or(contains(text, 'q')) AS dental_covered, NULL::BOOLEAN AS maternity_covered,
  (SELECT 'part|' || string_agg(entry, '|' ORDER BY place) FROM e WHERE e.doc_id = p.doc_id) AS conditions
FROM p GROUP BY doc_id""")
def jsn1_folded_replies(spark: SparkSession, sf: str) -> DataFrame:
    """Replies to every part, folded to one record a document. Odd parts name the plan, the
    last one the age."""
    parts = inference.document_parts(
        table(spark, sf, "documents").filter(filters.document_long_enough("text")),
        part_chars=_PART, overlap=_OVERLAP)
    reply = F.to_json(F.struct(
        F.when(F.col("part") % 2 == 1, F.substring("text", 1, 12)).alias("plan_name"),
        F.length("text").alias("annual_limit"),
        F.when(F.col("part") == F.col("n_parts") - 1, F.col("n_parts")).alias("min_age"),
        F.contains("text", F.lit("q")).alias("dental_covered"),
        F.array(F.lit("part"), F.substring("text", 1, 1)).alias("covered_conditions")))
    parsed = inference.parse_replies(parts.select("doc_id", "part", reply.alias("reply")))
    return inference.fold_replies(parsed).select(
        "doc_id", "n_replies", "plan_name", "annual_limit", "min_age", "dental_covered",
        "maternity_covered", F.array_join("covered_conditions", "|").alias("conditions"))


@query("""SELECT doc_id, md5(coalesce(CASE WHEN lang <> 'fr' THEN text END, '') || ' '
  || source) AS digest FROM documents""")
def prj11_class_text(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    text = inference.class_text(F.when(F.col("lang") != "fr", F.col("text")), "source")
    return d.select("doc_id", F.md5(text).alias("digest"))


@query("""SELECT d.doc_id, coalesce(l.quality = 1, TRUE) AS medical
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def flt6_class_replies(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id")
    reply = table(spark, sf, "labels").select("doc_id", F.when(
        F.col("quality") == 1, " medical").otherwise("CRITICAL_ILLNESS").alias("reply"))
    return d.join(reply, "doc_id", "left").select(
        "doc_id", filters.is_medical("reply").alias("medical"))


@query("""SELECT conv_id AS doc_id, string_agg(text, E'\\n\\n' ORDER BY turn) AS text
FROM conversations WHERE length(text) > 0 GROUP BY conv_id""")
def src5_brochure_text(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "conversations").select(
        F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_no"), "text")
    return inference.join_page_texts(c)
