"""URL filter rules.

Two kinds of rules judge a URL. A *site rule* names a host and a path prefix; it
fits the host and its subdomains, and the longest fitting rule wins. A *pattern
rule* is a regular expression with the literal tokens that any match contains.
Each pattern rule is filed under the token of its own that is rarest among the
URLs at hand; a URL's tokens fetch the rules filed under them, and only these
rules run their expression.

Cases: a null URL, or one without ``://``, has an empty host and path, fits no
site rule and no pattern, and is allowed. An empty rule table allows everything.
A pattern rule without tokens can't be filed and is refused. Repeated rows are
judged each for itself. Of pattern rules that match, one that allows wins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landsync.llm.common import BROADCAST_ROWS, fold_case, table
from landsync.llm.registry import query


@dataclass(frozen=True)
class SiteRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]


#: The site rules of the contract (fixed values).
SITE_RULES = (
    SiteRule("allow", "com", "/"),
    SiteRule("block", "example.com", "/en/"),
    SiteRule("allow", "www.example.com", "/en/"),
    SiteRule("block", "net", "/es/"),
    SiteRule("block", "net", "/fr/"),
)

#: Pattern rules used where no site rule fits. A token is a run of a-z and 0-9.
PATTERN_RULES = (
    PatternRule("casino", "block", r"://([^/?#]*[.-])?casino[.-]", ("casino",)),
    PatternRule("casino-win", "block", r"://([^/?#]*[.])?casino-win[.]", ("casino", "win")),
    PatternRule("bets", "block", r"://([^/?#]*[.-])?(free|best|live)-bets[.]", ("bets",)),
    PatternRule("adult", "block", r"://([^/?#]*[.-])?adult[.-]", ("adult",)),
    PatternRule("spam-farm", "block", r"://([^/?#]*[.])?spam-farm[.]", ("spam", "farm")),
    PatternRule("porn", "block", r"://([^/?#]*[.-])?porn[.-]", ("porn",)),
    PatternRule("cheap-pills", "block", r"://([^/?#]*[.-])?cheap-pills[.-]", ("cheap", "pills")),
    PatternRule("login", "block", r"://[^?#]*/login([/?#.]|$)", ("login",)),
    PatternRule("cart", "block", r"://[^?#]*/cart([/?#.]|$)", ("cart",)),
)


def url_host(url: Column) -> Column:
    return fold_case(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def url_tokens(url: Column) -> Column:
    """The distinct runs of a-z and 0-9 of the lower-cased URL."""
    return F.array_distinct(F.array_remove(F.split(fold_case(url), "[^a-z0-9]+"), ""))


def site_rule(host: Column, path: Column, rules: Sequence[SiteRule]) -> Column:
    """The longest fitting rule as a struct (rule, verdict), else null. The rules are
    a short list; a host has few suffixes, so a map from host to rules would also do."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))
                     ).otherwise(out)
    return out


def filed_rules(urls: DataFrame, url: str, rules: Sequence[PatternRule]) -> DataFrame:
    """Rules as (token, name, verdict, pattern), each under its rarest token."""
    for r in rules:
        if not r.tokens:
            raise ValueError(f"pattern rule without a literal token: {r.name}")
    spark = urls.sparkSession
    listed = spark.createDataFrame(
        [(r.name, r.verdict, r.pattern, t) for r in rules for t in dict.fromkeys(r.tokens)],
        "name string, verdict string, pattern string, token string")
    wanted = F.array(*[F.lit(t) for t in sorted({t for r in rules for t in r.tokens})])
    counts = (urls.select(F.explode(F.array_intersect(url_tokens(F.col(url)), wanted)).alias("token"))
              .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    return (listed.join(counts, "token", "left")
            .groupBy("name", "verdict", "pattern")
            .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("best"))
            .select(F.col("best.token").alias("token"), "name", "verdict", "pattern"))


def judge_urls(pages: DataFrame, url: str = "url", site_rules: Sequence[SiteRule] = SITE_RULES,
               pattern_rules: Sequence[PatternRule] = PATTERN_RULES) -> DataFrame:
    """``pages`` with host, path, rule, verdict and ``patterns``, the names of the
    pattern rules that match (empty where none does)."""
    taken = {"host", "path", "rule", "verdict", "patterns"} & set(pages.columns)
    pages = pages.drop(*taken)
    if not pattern_rules:
        found = F.array().cast("array<struct<name:string,verdict:string>>")
        judged = pages.withColumn("__hits", found)
    else:
        filed = filed_rules(pages, url, pattern_rules)
        filed = F.broadcast(filed) if len(pattern_rules) <= BROADCAST_ROWS else filed
        keys = pages.select(F.col(url).alias("__url")).where(F.col("__url").isNotNull()).distinct()
        hits = (keys.withColumn("token", F.explode(url_tokens(F.col("__url"))))
                .join(filed, "token")
                .where(F.expr("lower(__url) rlike pattern"))
                .groupBy("__url").agg(F.sort_array(F.collect_set(F.struct("name", "verdict"))).alias("__hits")))
        judged = pages.join(hits, pages[url] == hits["__url"], "left").drop("__url")
    fitting = site_rule(F.col("host"), F.col("path"), site_rules)
    names = F.coalesce(F.transform("__hits", lambda x: x["name"]), F.array().cast("array<string>"))
    verdicts = F.transform("__hits", lambda x: x["verdict"])
    by_pattern = (F.when(F.array_contains(verdicts, "allow"), "allow")
                  .when(F.size("__hits") > 0, "block").otherwise("allow"))
    return (judged.withColumn("host", url_host(F.col(url))).withColumn("path", url_path(F.col(url)))
            .withColumn("__site", fitting)
            .withColumn("rule", F.col("__site.rule"))
            .withColumn("verdict", F.coalesce(F.col("__site.verdict"), by_pattern))
            .withColumn("patterns", names).drop("__site", "__hits"))


def _sql(site: Sequence[SiteRule], patterns: Sequence[PatternRule]) -> str:
    """Every rule tried on every URL."""
    fits = {r: f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))"
            for r in site}
    longest = sorted(site, key=lambda r: -len(r.name))
    rule = "CASE " + " ".join(f"WHEN {fits[r]} THEN '{r.name}'" for r in longest) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits[r]} THEN '{r.verdict}'" for r in longest)
    names = ", ".join(f"CASE WHEN regexp_matches(lower(url), '{r.pattern}') THEN '{r.name}' END"
                      for r in patterns)
    return f"""
SELECT page_id, host, path, {rule} AS rule,
  {verdict} WHEN len(patterns) > 0 THEN 'block' ELSE 'allow' END AS verdict,
  array_to_string(patterns, ' ') AS patterns
FROM (SELECT *, list_sort(list_filter([{names}], lambda x: x IS NOT NULL)) AS patterns
  FROM (SELECT page_id, url,
    lower(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1)) AS host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages))"""


@query(_sql(SITE_RULES, PATTERN_RULES))
def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by site rules, else by pattern rules."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict",
                                    F.array_join("patterns", " ").alias("patterns"))
