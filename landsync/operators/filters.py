"""Predicates and row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landsync import rules
from landsync.functions.text import col, contains_any, literal_pattern, utrim


def is_plan_name(name: Column | str) -> Column:
    """Does a text look like the name of a plan? False for null."""
    name = col(name)
    low = utrim(F.lower(name))
    known = low.rlike(f"^(?:{literal_pattern(rules.KNOWN_NAME_PREFIXES)})")
    good = (F.length(name).between(4, 80)
            & name.rlike(r"^\p{L}")
            & (F.length(F.regexp_replace(name, r"\P{L}", "")) >= 3)
            & ((F.length(name) >= 12) | known)
            & ~low.rlike(literal_pattern(rules.BLOCKED_NAME_PARTS)))
    return F.coalesce(good, F.lit(False))


def false_name(provider_key: Column | str, name: Column | str,
               table: dict[str, list[tuple[str, int | None]]] | None = None) -> Column:
    """Is a name found in running text a known false hit of its provider?"""
    provider_key, name = col(provider_key), col(name)
    hit = F.lit(False)
    for key, parts in (rules.FALSE_NAMES if table is None else table).items():
        for part, below in parts:
            test = F.contains(name, F.lit(part))
            if below is not None:
                test = test & (F.length(name) < below)
            hit = hit | ((provider_key == key) & test)
    return F.coalesce(hit, F.lit(False))


def pending(facilities: DataFrame) -> DataFrame:
    """Active facilities never looked up, with the columns a lookup needs."""
    return (facilities.filter(F.col("latitude").isNull() & F.col("is_active"))
            .select("id", "name", "address", "city", "state", "postcode", "facility_type"))


def enrichment_state(latitude: Column | str = "latitude") -> Column:
    """``pending``, ``failed`` or ``done``, as the latitude column encodes it."""
    lat = col(latitude)
    return F.when(lat.isNull(), "pending").when(lat == 0.0, "failed").otherwise("done")


def active_plans(plans: DataFrame, provider_name: str | None = None) -> DataFrame:
    """Active plans, of one provider if named. Both tests reach the scan."""
    out = plans.filter(F.col("is_active"))
    return out if provider_name is None else out.filter(F.col("provider_name") == provider_name)


def link_allowed(link: Column, rule: rules.LinkRule) -> Column:
    """Does a link pass the conditions of the rule that found it?"""
    test = F.length(link) > 0
    low = F.lower(link)
    for part in rule.needs:
        test = test & F.contains(link, F.lit(part))
    for part in rule.needs_any_case:
        test = test & F.contains(low, F.lit(part))
    if rule.skip:
        test = test & ~contains_any(low if rule.skip_any_case else link, list(rule.skip))
    if rule.query == "drop":
        test = test & ~F.contains(link, F.lit("?"))
    elif rule.query == "category":
        test = test & (~F.contains(link, F.lit("?")) | F.contains(link, F.lit("category=")))
    return test


def long_enough(text: Column | str, more_than: int = 500) -> Column:
    """Gate for page text before analysis."""
    return F.coalesce(F.length(col(text)) > more_than, F.lit(False))


def document_long_enough(text: Column | str, at_least: int = 100) -> Column:
    """Gate for document text before analysis, counted after trimming."""
    return F.coalesce(F.length(utrim(col(text))) >= at_least, F.lit(False))


def blocked_page(html: Column | str) -> Column:
    """Is a page the site's notice for unwanted traffic?"""
    return contains_any(F.lower(col(html)), ["unusual traffic", "captcha"])


def mark_blocked(results: DataFrame, html: str = "html") -> DataFrame:
    """Set ``scrape_success`` and ``scrape_error`` from the page text."""
    hit = F.coalesce(blocked_page(html), F.lit(False))
    return results.withColumns({
        "scrape_success": ~hit,
        "scrape_error": F.when(hit, F.lit("CAPTCHA detected")),
    })


def is_medical(reply: Column | str) -> Column:
    """Read a class reply; no reply keeps the plan."""
    up = utrim(F.upper(col(reply)))
    medical = F.contains(up, F.lit("MEDICAL")) & ~F.contains(up, F.lit("CRITICAL"))
    return F.coalesce(medical, F.lit(True))


def is_medical_by_name(name: Column | str) -> Column:
    """Decide from the name alone; undecided names stay in."""
    name = col(name)
    return (F.when(contains_any(name, rules.CRITICAL_ILLNESS_NAMES), F.lit(False))
            .when(contains_any(name, rules.MEDICAL_NAMES), F.lit(True))
            .otherwise(F.lit(True)))


def split_identified(results: DataFrame, key: str = "clinic_id") -> tuple[DataFrame, DataFrame]:
    """Results with and without a facility id."""
    has = F.col(key).isNotNull() & (F.col(key) != "")
    return results.filter(has), results.filter(~F.coalesce(has, F.lit(False)))
