"""Fast plan path: names from listing pages and the first product pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landsync import rules, schemas
from landsync.operators.dedup import first_links, unique_names
from landsync.operators.extract import listing_candidates, listing_links, title_candidates
from landsync.operators.filters import false_name, is_plan_name
from landsync.operators.records import DEFAULT_COVERAGE, DEFAULT_PLAN_TYPE, plan_records


def visited_links(listing_pages: DataFrame, providers: DataFrame | None = None,
                  cap: int | None = None, table: rules.RuleTable | None = None) -> DataFrame:
    """Product links of the fast path. Landed pages cost no visit, so all are taken;
    ``cap`` (``rules.LISTING_VISIT_CAP``) keeps the first ones of each provider."""
    return first_links(listing_links(listing_pages, providers, (table or rules.RuleTable()).listing_links), cap)


def name_candidates(listing_pages: DataFrame, product_pages: DataFrame,
                    table: rules.RuleTable | None = None) -> DataFrame:
    """Valid names of all three strategies, false hits in running text removed.
    Names from product pages bring the facts of their page along."""
    table = table or rules.RuleTable()
    listed = listing_candidates(listing_pages, table.headings, table.body_names)
    false_hit = (F.col("strategy") == 1) & false_name("provider_key", "name", table.false_names)
    good = listed.filter(~false_hit & is_plan_name("name"))
    return good.unionByName(title_candidates(product_pages, facts=True),
                            allowMissingColumns=True)


def listing_plans(listing_pages: DataFrame, product_pages: DataFrame, providers: DataFrame,
                  table: rules.RuleTable | None = None) -> DataFrame:
    """Normalised plans of the fast path, with ``seq`` columns strategy, rank, pos.

    ``product_pages`` carries ``link_rank`` (see ``landed_products``). Every page is
    read once; only names and facts are shuffled.
    """
    names = unique_names(name_candidates(listing_pages, product_pages, table)).alias("n")
    # A name from the listing leads to the listing, one from a product page to that.
    site = providers.select(F.col("provider_key").alias("_key"), "products_url")
    joined = names.join(site, F.col("n.provider_key") == F.col("_key"), "left")
    website = F.when(F.col("strategy") == 2, F.col("url")).otherwise(F.col("products_url"))
    raw = joined.select(
        "provider_key", "strategy", "rank", "pos",
        F.col("name").alias("plan_name"), F.lit(DEFAULT_PLAN_TYPE).alias("plan_type"),
        F.lit(DEFAULT_COVERAGE).alias("coverage_type"), website.alias("website"),
        *schemas.COVERAGE_FIELDS, *schemas.LIMIT_FIELDS)
    return plan_records(raw, providers, keep=("strategy", "rank", "pos"))
