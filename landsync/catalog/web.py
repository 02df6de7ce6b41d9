"""Page, link, response and reply queries over ``pages``, ``supplier``, ``part``
and ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landsync.catalog.registry import (query, sql_quote, sql_squeeze, sql_text_of, sql_trim,
                                       sql_unescape, table)
from landsync.functions.html import anchors, body_text
from landsync.operators import extract, filters, inference, records
from landsync.operators.dedup import first_links, unique_names
from landsync.rules import LinkRule, RuleTable


def pages(spark: SparkSession, sf: str, key: str | None = "k") -> DataFrame:
    p = table(spark, sf, "pages").select("page_id", "url", "html")
    return p if key is None else p.withColumn("provider_key", F.lit(key))


def sql_numbered(source: str, pattern: str, group: int, key: str = "url", doc: str = "html") -> str:
    """All matches with their place (from 0), per row of ``source``."""
    found = f"regexp_extract_all({doc}, {sql_quote(pattern)}, {group})"
    return (f"SELECT {key}, unnest({found}) AS m, generate_subscripts({found}, 1) - 1 AS i "
            f"FROM {source}")


# --- scan -------------------------------------------------------------------
HOSTS = [("sh", "", "https://blog.tionsh.example.net"), ("org", "", "https://ththed.example.org"),
         ("pills", "", "https://www.cheap-pills.example.com")]
_BARE = (r"(?is)<head\b.*?</head\s*>|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
         r"|<noscript\b.*?</noscript\s*>|<template\b.*?</template\s*>|<!--.*?-->")
_BREAKS = (r"(?i)<(?:br|/p|/div|/li|/tr|/h[1-6]|/ul|/ol|/table|/section|/article)\b[^>]*>")
_SQL_BODY = sql_trim(
    "regexp_replace(" + sql_unescape(
        "regexp_replace(regexp_replace(regexp_replace(html, " + sql_quote(_BARE)
        + ", '', 'g'), " + sql_quote(_BREAKS) + r", E'\n', 'g'), '<[^>]*>', '', 'g')")
    + r", '[ \t]*\n[ \t\r\n]*', E'\n', 'g')")


@query(rf"""
SELECT page_id, CASE lower(regexp_extract(url, '(?i)^https?://([^/?#]+)', 1))
  WHEN 'blog.tionsh.example.net' THEN 'sh' WHEN 'ththed.example.org' THEN 'org'
  WHEN 'www.cheap-pills.example.com' THEN 'pills' END AS provider_key,
  {_SQL_BODY} AS body FROM pages""")
def src2_page_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Provider by host and the visible text of whole pages."""
    return pages(spark, sf, None).select(
        "page_id", extract.provider_of("url", HOSTS).alias("provider_key"),
        body_text("html").alias("body"))


# --- names ------------------------------------------------------------------
HEADINGS = {"k": ["article h1", ".ad", "li a"]}


def _sql_texts(source: str, pattern: str, rank: int, doc: str = "html", strategy: int = 0) -> str:
    return f"""SELECT url, {strategy} AS strategy, {rank} AS rank,
      CAST(row_number() OVER (PARTITION BY url ORDER BY i) - 1 AS INTEGER) AS pos, name
    FROM (SELECT url, i, {sql_text_of('m')} AS name FROM ({sql_numbered(source, pattern, 1, doc=doc)}))
    WHERE length(name) > 0"""


_ARTICLES = "(SELECT url, regexp_extract(html, '(?is)<article\\b[^>]*>(.*?)</article', 1) AS html FROM pages)"
_SQL_HEADINGS = " UNION ALL ".join([
    _sql_texts(_ARTICLES, r"(?is)<h1\b[^>]*>(.*?)</h1\s*>", 0),
    _sql_texts("pages", r'(?is)<div class="ad">(.*?)</div>', 1),
    _sql_texts("pages", r"(?is)<li\b[^>]*><a\b[^>]*>(.*?)</a\s*>", 2)])


@query(_SQL_HEADINGS)
def txt13_heading_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return extract.heading_candidates(pages(spark, sf), HEADINGS).drop("provider_key")


BODY = {"k": [r"[A-Z][a-z]+ing\s+[a-z]+", r"(?i)the\s+[a-z]+(?:\s+of)?"]}
_SQL_BODY_NAMES = " UNION ALL ".join(
    f"SELECT url, 1 AS strategy, {rank} AS rank, CAST(i AS INTEGER) AS pos, {sql_trim('m')} AS name "
    f"FROM ({sql_numbered('pages', p, 0)})" for rank, p in enumerate(BODY["k"]))


@query(_SQL_BODY_NAMES)
def txt14_body_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return extract.body_candidates(pages(spark, sf), BODY).drop("provider_key")


@query(f"""
WITH c AS (SELECT 'k' AS provider_key, * FROM ({_SQL_HEADINGS} UNION ALL {_SQL_BODY_NAMES}))
SELECT strategy, rank, pos, url, name FROM (SELECT *, row_number() OVER (
    PARTITION BY provider_key, lower(name) ORDER BY strategy, rank, pos, url) AS rn FROM c)
WHERE rn = 1""")
def set2_union_strategies(spark: SparkSession, sf: str) -> DataFrame:
    """Names of all strategies, one per name over all pages."""
    found = extract.listing_candidates(pages(spark, sf), HEADINGS, BODY)
    return unique_names(found, ("strategy", "rank", "pos", "url")).drop("provider_key")


_SQL_H1 = sql_text_of(r"regexp_extract(doc, '(?is)<h1\b[^>]*>(.*?)</h1\s*>', 1)")


@query(f"""SELECT page_id, CASE WHEN contains(url, 'blog.')
    THEN {sql_trim("split_part(nullif(t, ''), '|', 1)")} ELSE nullif(t, '') END AS title
FROM (SELECT page_id, url, {_SQL_H1} AS t FROM (
  SELECT page_id, url, replace(html, ' and ', ' | ') AS doc FROM pages))""")
def txt15_page_title(spark: SparkSession, sf: str) -> DataFrame:
    """Page titles; some providers keep only the part before the first bar."""
    p = pages(spark, sf, None).withColumns({
        "html": F.replace("html", F.lit(" and "), F.lit(" | ")),
        "provider_key": F.when(F.contains("url", F.lit("blog.")), "GreatEastern")
        .otherwise("Etiqa")})
    return p.select("page_id", extract.page_title().alias("title"))


@query(f"""
SELECT page_id, CASE WHEN length(slug) >= 4 THEN lower(slug) END AS slug FROM (SELECT page_id,
  {sql_squeeze("replace(replace(regexp_extract(regexp_replace(url, '/+$', ''), '([^/]*)$', 1), '.html', ''), '-', ' ')")}
  AS slug FROM pages)""")
def txt16_slug_name(spark: SparkSession, sf: str) -> DataFrame:
    return pages(spark, sf).select("page_id", F.lower(extract.slug_name("url")).alias("slug"))


# --- links ------------------------------------------------------------------
LINKS = {"k": [LinkRule(css="li a", skip=("que", ","), complete="all"),
               LinkRule(pattern=r'href="(/[A-Z][^"]*)"', query="drop", complete="slash"),
               LinkRule(css="a[href*='the']", needs_any_case=("h",), complete="all")]}
_SQL_LINKS = f"""
SELECT url AS page_url, 0 AS rank, CAST(i AS INTEGER) AS pos, 'https://h' || m AS url
  FROM ({sql_numbered('pages', r'(?is)<li\b[^>]*><a\b[^>]*?\shref="([^"]*)"', 1)})
  WHERE length(m) > 0 AND NOT (contains(m, 'que') OR contains(m, ','))
UNION ALL SELECT url, 1, CAST(i AS INTEGER), 'https://h' || m
  FROM ({sql_numbered('pages', r'href="(/[A-Z][^"]*)"', 1)}) WHERE NOT contains(m, '?')
UNION ALL SELECT url, 2, CAST(i AS INTEGER), 'https://h' || m
  FROM ({sql_numbered('pages', r'(?i:<a\b[^>]*?\shref=)"([^"]*the[^"]*)"', 1)})
  WHERE contains(lower(m), 'h')"""


def _links(spark: SparkSession, sf: str) -> DataFrame:
    return extract.product_links(pages(spark, sf), LINKS, F.lit("https://h"))


@query(_SQL_LINKS)
def txt17_product_links(spark: SparkSession, sf: str) -> DataFrame:
    return _links(spark, sf).drop("provider_key")


@query(f"""SELECT rank, count(*) AS links, count(DISTINCT page_url) AS pages
FROM ({_SQL_LINKS}) GROUP BY rank""")
def flt3_link_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Links each rule lets through."""
    per_page = (_links(spark, sf).groupBy("rank", "page_url")
                .agg(F.count(F.lit(1)).alias("n")))
    return per_page.groupBy("rank").agg(F.sum("n").alias("links"),
                                        F.count(F.lit(1)).alias("pages"))


@query(f"""
WITH firsts AS (SELECT page_url, url, min((rank, pos)) AS place FROM ({_SQL_LINKS})
  GROUP BY page_url, url),
ranked AS (SELECT *, row_number() OVER (PARTITION BY page_url ORDER BY place, url) AS link_rank
  FROM firsts)
SELECT page_url, url, CAST(link_rank AS INTEGER) AS link_rank FROM ranked""")
def dup4_first_links(spark: SparkSession, sf: str) -> DataFrame:
    """The distinct links of every page, by first place."""
    return (first_links(_links(spark, sf), group="page_url")
            .select("page_url", "url", "link_rank"))


@query(f"""
WITH firsts AS (SELECT url, min((rank, pos)) AS place FROM ({_SQL_LINKS}) GROUP BY url)
SELECT 'k' AS provider_key, url,
  CAST(row_number() OVER (ORDER BY place, url) AS INTEGER) AS link_rank FROM firsts""")
def dup4_provider_links(spark: SparkSession, sf: str) -> DataFrame:
    """The distinct links of one provider that has all pages, by first place."""
    return first_links(_links(spark, sf)).select("provider_key", "url", "link_rank")


@query(rf"""
WITH a AS (SELECT page_id, i, regexp_extract(m, '(?is)^<a\b[^>]*?\shref="([^"]*)"', 1) AS href,
    {sql_text_of('m')} AS text
  FROM ({sql_numbered('pages', r'(?is)<a\b[^>]*>.*?</a\s*>', 0, key='page_id')})),
r AS (SELECT page_id, 0 AS rank, arg_min(href, i) AS href FROM a WHERE contains(lower(text), 'tion')
    GROUP BY page_id
  UNION ALL SELECT page_id, 1, arg_min(href, i) FROM a WHERE contains(href, '/de') GROUP BY page_id
  UNION ALL SELECT page_id, 2, arg_min(href, i) FROM a WHERE contains(href, '/') GROUP BY page_id)
SELECT p.page_id, b.link FROM pages p LEFT JOIN (
  SELECT page_id, arg_min('https://h' || href, rank) AS link FROM r
  WHERE contains(lower(href), 'e') GROUP BY page_id) b USING (page_id)""")
def txt18_brochure_link(spark: SparkSession, sf: str) -> DataFrame:
    """First link of the best rule; a letter stands in for the file extension,
    which no page has."""
    rules_ = {"k": [("text", "Tion"), ("href", "/de"), ("href", "/")]}
    link = extract.brochure_link(table=rules_, base=F.lit("https://h"), links=F.col("links"),
                                 any_link=[], page_patterns={}, extension="e")
    found = pages(spark, sf).select("page_id", "provider_key", anchors("html").alias("links"))
    return found.select("page_id", link.alias("link"))


@query(rf"""
WITH t AS (SELECT page_id,
    nullif({sql_text_of("regexp_extract(html, '(?is)<div class=" + '"ad"' + ">(.*?)</div>', 1)")}, '') AS ad,
    nullif({sql_text_of("regexp_extract(regexp_extract(html, '(?is)<article.*?</article', 0), '(?is)<p>(.*?)(?:</?(?:p|div|ul|ol|h[1-6]|table|section|article)" + chr(92) + "b|</body)', 1)")}, '')
      AS par FROM pages)
SELECT page_id, CASE WHEN length(ad) > 30 THEN ad ELSE par END AS description FROM t""")
def txt20_description(spark: SparkSession, sf: str) -> DataFrame:
    """The notice if it is longer than 30 characters, else the first paragraph."""
    text = extract.description(selectors={"k": [".ad", "article p"]}, min_length={"k": 30})
    return pages(spark, sf).select("page_id", text.alias("description"))


@query("""SELECT page_id, NOT blocked AS scrape_success,
  CASE WHEN blocked THEN 'CAPTCHA detected' END AS scrape_error
FROM (SELECT page_id, contains(url, 'cheap-pills') OR contains(url, 'spam-farm') AS blocked
  FROM pages)""")
def flt7_blocked_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Whole pages; the notices are added to those of two hosts."""
    note = (F.when(F.contains("url", F.lit("cheap-pills")), "<p>Unusual Traffic seen</p>")
            .when(F.contains("url", F.lit("spam-farm")), "<b>CAPTCHA</b>").otherwise(""))
    p = pages(spark, sf).withColumn("html", F.concat("html", note))
    return filters.mark_blocked(p).select("page_id", "scrape_success", "scrape_error")


# --- one rule table for two invented providers ------------------------------
_EXT_HEADINGS = {"blog": ["h1", "li a"], "other": ["article h1"]}
_EXT_BODY = {"blog": [r"[A-Z][a-z]+ing"], "other": [r"[A-Z][a-z]+tion", r"[A-Z][a-z]+he"]}
_EXT_LINKS = {"blog": [LinkRule(css="li a")], "other": [LinkRule(pattern=r'href="(/t[^"]*)"')]}
_BLOG = "(SELECT * FROM pages WHERE contains(url, '//blog.'))"
_OTHER = "(SELECT * FROM pages WHERE NOT contains(url, '//blog.'))"
_OTHER_ARTICLES = f"({_ARTICLES[1:-1]} WHERE NOT contains(url, '//blog.'))"


def _ext_body(source: str, key: str) -> str:
    return " UNION ALL ".join(
        f"SELECT url, 1 AS strategy, {r} AS rank, CAST(i AS INTEGER) AS pos, m AS name "
        f"FROM ({sql_numbered(source, p, 0)})" for r, p in enumerate(_EXT_BODY[key]))


@query(" UNION ALL ".join([
    _sql_texts(_BLOG, r"(?is)<h1\b[^>]*>(.*?)</h1\s*>", 0),
    _sql_texts(_BLOG, r"(?is)<li\b[^>]*><a\b[^>]*>(.*?)</a\s*>", 1),
    _sql_texts(_OTHER_ARTICLES, r"(?is)<h1\b[^>]*>(.*?)</h1\s*>", 0),
    _ext_body(_BLOG, "blog"), _ext_body(_OTHER, "other"),
    "SELECT url, 2, 0, CAST(i AS INTEGER), 'https://h' || m FROM ("
    + sql_numbered(_BLOG, r'(?is)<li\b[^>]*><a\b[^>]*?\shref="([^"]*)"', 1) + ") WHERE m <> ''",
    "SELECT url, 2, 0, CAST(i AS INTEGER), 'https://h' || m FROM ("
    + sql_numbered(_OTHER, r'href="(/t[^"]*)"', 1) + ")",
]))
def ext1_rule_table(spark: SparkSession, sf: str) -> DataFrame:
    """Headings, body names and links of two host classes, each with its own rules."""
    return by_rules(spark, sf, RuleTable(headings=_EXT_HEADINGS, body_names=_EXT_BODY, detail_links=_EXT_LINKS))


def by_rules(spark: SparkSession, sf: str, table: RuleTable) -> DataFrame:
    """What the rules of two host classes find."""
    p = pages(spark, sf, None).withColumn("provider_key", F.when(
        F.contains("url", F.lit("//blog.")), "blog").otherwise("other"))
    links = extract.product_links(p, table.detail_links, F.lit("https://h")).select(
        "provider_key", F.col("page_url").alias("url"), F.lit(2).alias("strategy"), "rank", "pos",
        F.col("url").alias("name"))
    return (extract.heading_candidates(p, table.headings)
            .unionByName(extract.body_candidates(p, table.body_names))
            .unionByName(links).drop("provider_key"))


# --- responses and replies --------------------------------------------------
def places(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as landed search and details responses: no hit, a hit without
    place id, details without a local number, details without hours."""
    n = F.col("s_nationkey")
    key = F.col("s_suppkey").cast("string")
    hit = F.struct(
        F.when(n < 7, "").otherwise(F.concat(F.lit("pid-"), key)).alias("place_id"),
        F.struct(F.struct(F.col("s_acctbal").alias("lat"), (F.col("s_acctbal") / 2).alias("lng"))
                 .alias("location")).alias("geometry"),
        F.lit(4.5).alias("rating"), n.alias("user_ratings_total"))
    second = F.struct(F.lit("second").alias("place_id"), hit["geometry"].alias("geometry"),
                      hit["rating"].alias("rating"), n.alias("user_ratings_total"))
    found = F.filter(F.array(hit, second), lambda h: n >= 4)
    hours = F.when(n < 20, F.struct(F.array(F.lit("Mon 9-5"), F.concat(F.lit("Tue "), key))
                                    .alias("weekday_text")))
    details = F.struct(
        F.when(n < 12, "").otherwise(F.concat(F.lit("03-"), key)).alias("formatted_phone_number"),
        F.concat(F.lit("+603-"), key).alias("international_phone_number"),
        F.concat(F.lit("https://"), key).alias("website"), hours.alias("opening_hours"))
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey"), F.to_json(F.struct(found.alias("results"))).alias("search_json"),
        F.to_json(F.struct(details.alias("result"))).alias("details_json"))


SQL_PLACES = """SELECT s_suppkey,
  CASE WHEN s_nationkey >= 4 THEN s_acctbal END AS latitude,
  CASE WHEN s_nationkey >= 4 THEN s_acctbal / 2 END AS longitude,
  CASE WHEN s_nationkey >= 12 THEN '03-' || s_suppkey WHEN s_nationkey >= 7
    THEN '+603-' || s_suppkey END AS phone,
  CASE WHEN s_nationkey >= 7 THEN 'https://' || s_suppkey END AS website,
  CASE WHEN s_nationkey >= 7 AND s_nationkey < 20 THEN 'Mon 9-5|Tue ' || s_suppkey END AS hours,
  CASE WHEN s_nationkey >= 7 AND s_nationkey < 20 THEN '[]' END AS periods,
  CASE WHEN s_nationkey >= 7 THEN 'pid-' || s_suppkey END AS google_place_id,
  CASE WHEN s_nationkey >= 4 THEN 4.5::DOUBLE END AS google_rating,
  CASE WHEN s_nationkey >= 4 THEN s_nationkey END AS google_reviews_count FROM supplier"""


@query(SQL_PLACES)
def prj8_flatten_places(spark: SparkSession, sf: str) -> DataFrame:
    flat = records.flatten_places(places(spark, sf)).drop("search_json", "details_json")
    return flat.withColumns({
        "hours": F.array_join("operating_hours.weekday_text", "|"),
        "periods": F.to_json("operating_hours.periods")}).drop("operating_hours")


@query("""SELECT s_suppkey, CASE WHEN s_nationkey < 4 THEN 0 ELSE 2 END AS hits,
  CASE WHEN s_nationkey >= 4 THEN CASE WHEN s_nationkey < 7 THEN '' ELSE 'pid-' || s_suppkey END END
    AS first_hit, '+603-' || s_suppkey AS international FROM supplier""")
def src3_places_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Landed responses parsed to their nested form."""
    p = places(spark, sf)
    search, details = records.parse_search("search_json"), records.parse_details("details_json")
    return p.select("s_suppkey", F.size(search["results"]).alias("hits"),
                    F.get(search["results"], F.lit(0))["place_id"].alias("first_hit"),
                    details["result"]["international_phone_number"].alias("international"))


@query(f"SELECT s_suppkey, hours, periods FROM ({SQL_PLACES})")
def jsn2_response_hours(spark: SparkSession, sf: str) -> DataFrame:
    return prj8_flatten_places(spark, sf).select("s_suppkey", "hours", "periods")


@query("""SELECT event_id, CASE WHEN event_type <> 'error'
  THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k FROM events""")
def src4_reply_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Event properties as replies about an age; those of errors are cut JSON."""
    e = table(spark, sf, "events")
    reply = F.replace("props", F.lit('"k"'), F.lit('"min_age"'))
    cut = F.when(F.col("event_type") == "error", F.replace(reply, F.lit("}"), F.lit("")))
    parsed = inference.parse_replies(e.select("event_id", F.coalesce(cut, reply).alias("reply")))
    return parsed.select("event_id", F.col("min_age").alias("k"))


_REPLIES = {
    # p_type: limit, percentage, age, flag, list, name
    "ECONOMY": ('"RM 1,0@"', '"@% of bill"', '"@ years"', '"Yes"', '["x","",0,null,"0",@,true]',
                '"Plan @"'),
    "SMALL": ("0", "0", "0", "0", '"x"', '""'),
    "STANDARD": ("@.5", "@", "@.9", "true", "[]", "null"),
    "PROMO": ('"1.2.3"', "null", '"none"', '"no"', "null", "@"),
}
_FALLBACK = ("[1]", "true", "true", "[]", '[[], {"a": 1}]', "false")


@query("""SELECT p_partkey,
  CASE p_type WHEN 'ECONOMY' THEN 'Plan ' || p_size WHEN 'PROMO' THEN p_size::VARCHAR END
    AS plan_name,
  CASE p_type WHEN 'ECONOMY' THEN CAST('10' || p_size AS DOUBLE)
    WHEN 'STANDARD' THEN p_size + 0.5::DOUBLE END AS annual_limit,
  CASE p_type WHEN 'ECONOMY' THEN p_size::DOUBLE WHEN 'STANDARD' THEN nullif(p_size, 0)::DOUBLE
    WHEN 'SMALL' THEN NULL WHEN 'PROMO' THEN NULL ELSE 1.0::DOUBLE END AS co_payment_percentage,
  CASE p_type WHEN 'ECONOMY' THEN p_size WHEN 'SMALL' THEN 0 WHEN 'STANDARD' THEN p_size
    WHEN 'PROMO' THEN NULL ELSE 1 END AS min_age,
  p_type IN ('ECONOMY', 'STANDARD') AS dental_covered,
  CASE p_type WHEN 'ECONOMY' THEN 'x|0|' || p_size || '|True' WHEN 'SMALL' THEN NULL
    WHEN 'STANDARD' THEN '' WHEN 'PROMO' THEN NULL ELSE '{"a":1}' END AS conditions,
  CAST(NULL AS VARCHAR) AS claim_process
FROM part""")
def jsn1_reply_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Replies with values of every JSON type, by part type."""
    kind = F.col("p_type")
    names = ("annual_limit", "co_payment_percentage", "min_age", "dental_covered",
             "covered_conditions", "plan_name")

    def text(values: tuple[str, ...]):
        body = ", ".join(f'"{n}": {v}' for n, v in zip(names, values))
        return F.replace(F.lit("{" + body + "}"), F.lit("@"), F.col("p_size").cast("string"))

    reply = text(_FALLBACK)
    for name, values in _REPLIES.items():
        reply = F.when(kind == name, text(values)).otherwise(reply)
    parsed = inference.parse_replies(table(spark, sf, "part").select(
        "p_partkey", reply.alias("reply")))
    return parsed.select("p_partkey", "plan_name", "annual_limit", "co_payment_percentage",
                         "min_age", "dental_covered",
                         F.array_join("covered_conditions", "|").alias("conditions"),
                         "claim_process")
