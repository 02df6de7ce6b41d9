"""Lookup of pending facilities: pick a batch, read landed map pages, apply results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landsync.functions.text import (coordinates, emergency_flag, parse_rating, pick_hours,
                                     pick_phone, pick_services, pick_specialties, place_id)
from landsync.operators.dedup import work_batch
from landsync.operators.filters import blocked_page, pending
from landsync.operators.merge import apply_results, fold_results
from landsync.operators.records import completeness, search_query
from landsync.session import settle
from landsync.sources.log_table import append_log, read_ids
from landsync.sources.store import prefixes_of, read_folders, replace_folders


def next_batch(facilities: DataFrame, n: int = 50) -> DataFrame:
    """The next facilities to look up, with their search query."""
    return work_batch(pending(facilities), n).withColumn("query", search_query())


def lookup_results(pages: DataFrame) -> DataFrame:
    """Lookup results from landed map pages.

    ``pages``: clinic_id, url, html, rating_texts, phone_attribute, phone_label,
    phone_tooltips, panel_texts, hours_groups, hours_label, categories,
    service_groups, website (see the column functions for their shapes).
    """
    blocked = F.coalesce(blocked_page("html"), F.lit(False))
    point = coordinates("url")
    ratings = F.transform(F.filter("rating_texts", lambda t: t != ""), parse_rating)
    usable = F.filter(ratings, lambda r: r.isNotNull() & (r != 0))
    facts = {
        "latitude": point["latitude"],
        "longitude": point["longitude"],
        "google_place_id": place_id("url"),
        # Without a usable rating the last one read stands, be it 0 or nothing.
        "google_rating": F.coalesce(F.get(usable, F.lit(0)),
                                    F.try_element_at(ratings, F.lit(-1))),
        "phone": pick_phone("phone_attribute", "phone_label", "phone_tooltips", "panel_texts"),
        "operating_hours": pick_hours("hours_groups", "hours_label"),
        "services": pick_services("service_groups"),
        "specialties": pick_specialties("categories"),
        "website": F.col("website"),
        "has_emergency": emergency_flag("html"),
    }
    out = pages.select(
        "clinic_id", *[F.when(~blocked, v).alias(k) for k, v in facts.items()],
        (~blocked).alias("scrape_success"),
        F.when(blocked, F.lit("CAPTCHA detected")).alias("scrape_error"))
    return out.withColumn("filled", completeness(out))


def enrich(facilities: DataFrame, results: DataFrame, run_ts: Column | None = None,
           seq: tuple[str, ...] = ("seq",)) -> DataFrame:
    """The facility table after a run of lookup results."""
    return apply_results(facilities, fold_results(results, seq), run_ts)


def enrich_in_place(results: DataFrame, root: str, run_ts: Column | None = None,
                    seq: tuple[str, ...] = ("seq",), digits: int = 2) -> None:
    """As above for a table kept in id-prefix folders: a run of 50 results reads
    and writes at most 50 folders, whatever the size of the table."""
    apply_in_place(settle(fold_results(results, seq)), root, run_ts, digits)


def apply_in_place(folded: DataFrame, root: str, run_ts: Column | None = None,
                   digits: int = 2) -> None:
    """Folded results (a stored table) onto the folders they fall into."""
    hit = prefixes_of(folded.withColumnRenamed("clinic_id", "id"), digits)
    part = read_folders(folded.sparkSession, root, hit, digits)
    replace_folders(apply_results(part, folded, run_ts), root, digits, hit)


def apply_log(folded: DataFrame, root: str, run_ts: Column | None = None) -> int:
    """Folded results (a stored table) onto a facility table kept as a log; returns the rows written."""
    ids = folded.select(F.col("clinic_id").alias("id"))
    part = read_ids(folded.sparkSession, root, ids, folded.count())
    return append_log(apply_results(part, folded, run_ts).withColumn("_net", F.lit(0)), root)
