"""Detailed plan path: product pages, brochures and model replies to plans.

The steps wait for replies in between. Write ``named_pages`` and
``accepted_pages`` out as tables, so that no page is read twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landsync import rules
from landsync.operators.dedup import first_links, keep_first
from landsync.operators.extract import product_links, product_page_facts
from landsync.operators.filters import is_medical
from landsync.operators.inference import analysis_input, class_prompts, prompts
from landsync.operators.records import merge_facts, plan_records


def detail_links(listing_pages: DataFrame, providers: DataFrame | None = None,
                 table: rules.RuleTable | None = None,
                 caps: dict[str, int] | None = None) -> DataFrame:
    """Product links of the detailed path; ``caps`` (``rules.DETAIL_LINK_CAPS``) keeps the
    first ones of each provider."""
    table = table or rules.RuleTable()
    return first_links(product_links(listing_pages, table.detail_links, providers=providers), caps)


def named_pages(product_pages: DataFrame, providers: DataFrame | None = None,
                table: rules.RuleTable | None = None) -> DataFrame:
    """Facts of product pages that carry a plan name. ``product_pages`` has
    ``link_rank``."""
    return product_page_facts(product_pages, providers, table)


def classification_prompts(named: DataFrame, table: rules.RuleTable | None = None) -> DataFrame:
    """Prompts for the providers whose plans are classified first."""
    table = table or rules.RuleTable()
    return class_prompts(named.filter(F.col("provider_key").isin(table.classified))).select(
        "provider_key", "url", "prompt")


def accepted_pages(named: DataFrame, class_replies: DataFrame,
                   table: rules.RuleTable | None = None) -> DataFrame:
    """Drop critical-illness plans, then keep one page per name. The drop comes
    first, so a rejected page does not use up its name."""
    table = table or rules.RuleTable()
    judged = named.join(class_replies.select("url", F.col("reply").alias("_class")), "url", "left")
    kept = judged.filter(~F.col("provider_key").isin(table.classified) | is_medical("_class"))
    keyed = kept.drop("_class").withColumn("_name", F.lower("plan_name"))
    return keep_first(keyed, ["provider_key", "_name"], ["link_rank", "url"]).drop("_name")


def analysis_prompts(accepted: DataFrame, brochures: DataFrame,
                     providers: DataFrame) -> DataFrame:
    """Prompts for accepted pages with something to analyse."""
    named = accepted.join(
        providers.select("provider_key", F.col("name").alias("provider_name")),
        "provider_key", "left")
    return prompts(analysis_input(named, brochures)).select("provider_key", "url", "prompt")


def detailed_plans(accepted: DataFrame, replies: DataFrame, providers: DataFrame,
                   table: rules.RuleTable | None = None) -> DataFrame:
    """Normalised plans; ``replies`` has the typed fields of ``parse_replies``."""
    pages = accepted.drop("page_text", "description", "benefits", "brochure_url", "eligible_age")
    merged = merge_facts(pages, replies).withColumn("website", F.col("url"))
    order = {k: i for i, k in enumerate((table or rules.RuleTable()).visited)}
    rank = F.coalesce(*[F.when(F.col("provider_key") == k, F.lit(i)) for k, i in order.items()],
                      F.lit(len(order)))
    ranked = merged.withColumn("provider_rank", rank)
    return plan_records(ranked, providers, keep=("provider_rank", "link_rank"))
