"""Record building: sheet rows to facilities, raw plans to plan records, search
queries, lookup responses, completeness."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landsync import schemas
from landsync.functions.text import (blank_to_null, col, deterministic_id, is_open_24_hours,
                                     parse_int, parse_money, parse_percentage, truthy,
                                     truthy_coalesce)

# Raw sheet column -> facility column.
SHEET_TO_FACILITY = {
    "nama_penuh_fasiliti": "name",
    "jenis_fasiliti": "facility_type",
    "alamat": "address",
    "poskod": "postcode",
    "bandar": "city",
    "negeri": "state",
}
# Country that ends every search query, defaults of a plan record.
SEARCH_COUNTRY = "Malaysia"
DEFAULT_PLAN_NAME = "Unknown Plan"
DEFAULT_PLAN_TYPE = "Medical"
DEFAULT_COVERAGE = "Individual"


def rename_sheet(rows: DataFrame, keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Sheet columns under their facility names; absent columns become ``''``."""
    def pick(source: str) -> Column:
        return F.col(source) if source in rows.columns else F.lit("")

    extra = [F.col(c) for c in keep if c in rows.columns]
    return rows.select(*extra, *[pick(s).alias(t) for s, t in SHEET_TO_FACILITY.items()])


def facility_records(rows: DataFrame, run_ts: Column | None = None,
                     protect_enrichment: bool = False,
                     keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Facility records ready to upsert.

    Looked-up columns appear only if the input has them, except ``email`` and
    ``has_emergency``, which are written as null; ``protect_enrichment`` leaves
    those two out as well. Rows without a name have no id.
    """
    def text(name: str) -> Column:
        return F.col(name) if name in rows.columns else F.lit("")

    now = F.current_timestamp() if run_ts is None else run_ts
    out = {
        "id": deterministic_id(text("name"), text("address")),
        "updated_at": now,
        "name": text("name"),
        "facility_type": text("facility_type"),
        **{c: blank_to_null(text(c)) for c in ("address", "city", "state", "postcode")},
        "is_24_hours": F.coalesce(is_open_24_hours(text("name")), F.lit(False)),
        "is_government": F.lit(False),
        "is_active": F.lit(True),
    }
    if not protect_enrichment:
        out["email"] = F.lit(None).cast("string")
        out["has_emergency"] = F.lit(None).cast("boolean")
    out.update({c: F.col(c) for c in schemas.ENRICHMENT_COLUMNS if c in rows.columns})
    extra = [F.col(c) for c in keep if c in rows.columns]
    return rows.select(*extra, *[v.alias(k) for k, v in out.items()])


def search_query(name: str = "name", address: str = "address", city: str = "city",
                 state: str = "state") -> Column:
    """The text to look a facility up with; empty parts are left out."""
    parts = [blank_to_null(F.col(c)) for c in (name, address, city, state)]
    return F.concat_ws(", ", *parts, F.lit(SEARCH_COUNTRY))


def completeness(df: DataFrame, fields: list[str] | None = None) -> Column:
    """How many of the compulsory fields hold something (0, '' and [] do not)."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    fields = [f for f in (fields or schemas.COMPULSORY_FIELDS) if f in kinds]
    return reduce(lambda a, b: a + b,
                  [truthy(F.col(f), kinds[f]).cast("int") for f in fields], F.lit(0))


def parse_search(response: Column | str) -> Column:
    return F.from_json(col(response), schemas.PLACE_SEARCH)


def parse_details(response: Column | str) -> Column:
    return F.from_json(col(response), schemas.PLACE_DETAILS)


def flatten_places(df: DataFrame, search: str = "search_json",
                   details: str = "details_json") -> DataFrame:
    """Eight lookup columns from the landed search and details responses.

    The first hit counts; details are read only where it has a place id.
    """
    hit = F.get(F.col("_search.results"), F.lit(0))
    found = df.withColumn("_search", parse_search(search)) \
              .withColumn("_details", parse_details(details)["result"])
    has_place = truthy(hit["place_id"], "string")
    opening = F.col("_details.opening_hours")
    has_hours = (opening["weekday_text"].isNotNull() | opening["periods"].isNotNull()
                 | opening["open_now"].isNotNull())
    hours = F.struct(
        F.coalesce(opening["weekday_text"], F.array().cast("array<string>")).alias("weekday_text"),
        F.coalesce(opening["periods"], F.parse_json(F.lit("[]"))).alias("periods"))
    phone = F.coalesce(blank_to_null(F.col("_details.formatted_phone_number")),
                       F.col("_details.international_phone_number"))
    return found.withColumns({
        "latitude": hit["geometry"]["location"]["lat"],
        "longitude": hit["geometry"]["location"]["lng"],
        "phone": F.when(has_place, phone),
        "website": F.when(has_place, F.col("_details.website")),
        "operating_hours": F.when(has_place & has_hours, hours),
        "google_place_id": blank_to_null(hit["place_id"]),
        "google_rating": hit["rating"],
        "google_reviews_count": hit["user_ratings_total"],
    }).drop("_search", "_details")


def plan_records(raw: DataFrame, providers: DataFrame,
                 keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """The 26 columns of a plan from raw facts and the provider dimension.

    ``raw`` needs ``provider_key``; every other fact may be absent. Money,
    percentage and age columns are parsed if they are text and cast if they are
    numbers. An unknown provider goes by its key.
    """
    kinds = {f.name: f.dataType.simpleString() for f in raw.schema}

    def fact(name: str, kind: str = "string", default: str | None = None) -> Column:
        if name in kinds:
            return F.col(f"raw.{name}").try_cast(kind)
        return F.lit(default).cast(kind)

    def number(name: str, parse, kind: str) -> Column:
        if name not in kinds:
            return F.lit(None).cast(kind)
        value = F.col(f"raw.{name}")
        return parse(value) if kinds[name] == "string" else value.try_cast(kind)

    dim = providers.select("provider_key", F.col("name").alias("_name"),
                           F.col("contact_phone").alias("_phone"),
                           F.col("website").alias("_site")).alias("dim")
    joined = raw.alias("raw").join(
        dim, F.col("raw.provider_key") == F.col("dim.provider_key"), "left")
    provider_name = F.coalesce(F.col("_name"), F.col("raw.provider_key"))
    plan_name = fact("plan_name", default=DEFAULT_PLAN_NAME)
    out = {
        "id": deterministic_id(provider_name, plan_name),
        "provider_name": provider_name,
        "plan_name": plan_name,
        "plan_type": fact("plan_type", default=DEFAULT_PLAN_TYPE),
        "coverage_type": fact("coverage_type"),
    }
    out.update({f: number(f, parse_money, "double") for f in schemas.LIMIT_FIELDS})
    out.update({f: fact(f, "boolean") for f in schemas.COVERAGE_FIELDS})
    out.update({f: fact(f, "array<string>")
                for f in (*schemas.LIST_FIELDS, "panel_hospitals")})
    out.update({f: number(f, parse_money, "double")
                for f in ("monthly_premium_min", "monthly_premium_max", "deductible")})
    out["co_payment_percentage"] = number("co_payment_percentage", parse_percentage, "double")
    out.update({f: number(f, parse_int, "int") for f in schemas.AGE_FIELDS})
    out["claim_process"] = fact("claim_process")
    out["contact_phone"] = F.col("_phone")
    out["website"] = F.coalesce(blank_to_null(fact("website")), F.col("_site"))
    out["is_active"] = F.lit(True)
    extra = [F.col(f"raw.{c}") for c in keep if c in kinds]
    return joined.select(*extra, *[v.alias(k) for k, v in out.items()])


def merge_facts(pages: DataFrame, replies: DataFrame, key: str = "url") -> DataFrame:
    """Page facts completed by reply facts of the same page, the reply first.

    Texts and limits fall back where the reply has nothing (null, '' or 0),
    flags only where it is null; the remaining fields come from the reply alone.
    """
    joined = pages.alias("page").join(replies.alias("reply"), key, "left")
    page_kind = {f.name: f.dataType.simpleString() for f in pages.schema}
    reply_kind = {f.name: f.dataType.simpleString() for f in replies.schema}
    out = [F.col(f"page.{c}") for c in pages.columns
           if c not in (*schemas.TEXT_FIELDS, *schemas.LIMIT_FIELDS, *schemas.COVERAGE_FIELDS)]

    def reply_then(name: str, fallback: Column, kind: str) -> Column:
        """Reply value if true, else the fallback; limits compare as text, since a
        page gives them unparsed."""
        if name not in reply_kind:
            return fallback
        value = F.col(f"reply.{name}")
        return truthy_coalesce_mixed(value, reply_kind[name], fallback, kind)

    defaults = {"plan_type": F.lit(DEFAULT_PLAN_TYPE), "coverage_type": F.lit(DEFAULT_COVERAGE)}
    for name in ("plan_name", "plan_type", "coverage_type", *schemas.LIMIT_FIELDS):
        fallback = defaults.get(name)
        if fallback is None:
            fallback = F.col(f"page.{name}") if name in page_kind else F.lit(None)
        kind = page_kind.get(name, reply_kind.get(name, "string"))
        out.append(reply_then(name, fallback, kind).alias(name))
    for name in schemas.COVERAGE_FIELDS:
        sides = [F.col(f"{side}.{name}") for side, kinds in
                 (("reply", reply_kind), ("page", page_kind)) if name in kinds]
        if sides:
            out.append(F.coalesce(*sides).alias(name))
    rest = (*schemas.LIST_FIELDS, "monthly_premium_min", "monthly_premium_max", "deductible",
            "co_payment_percentage", *schemas.AGE_FIELDS, "claim_process")
    out.extend(F.col(f"reply.{c}") for c in rest if c in reply_kind)
    return joined.select(*out)


def truthy_coalesce_mixed(value: Column, value_kind: str, fallback: Column,
                          fallback_kind: str) -> Column:
    """Like ``truthy_coalesce`` for sides of different type: a page limit is text
    while a reply limit is a number, so the text is parsed first."""
    if value_kind == "double" and fallback_kind == "string":
        return F.coalesce(F.when(truthy(value, value_kind), value), parse_money(fallback))
    return truthy_coalesce(value_kind, value, fallback)
