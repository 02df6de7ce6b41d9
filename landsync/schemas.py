"""Schemas of the two kept tables and of the landed inputs."""

from __future__ import annotations

from pyspark.sql import types as T

HOURS = T.StructType([
    T.StructField("weekday_text", T.ArrayType(T.StringType())),
    T.StructField("periods", T.VariantType()),
])

# Sheet header -> column of the raw sheet table.
SHEET_COLUMNS = {
    "BIL": "bil",
    "JENIS_FASILITI": "jenis_fasiliti",
    "NAMA_PENUH_FASILITI": "nama_penuh_fasiliti",
    "ALAMAT": "alamat",
    "POSKOD": "poskod",
    "BANDAR": "bandar",
    "NEGERI": "negeri",
}

# Facility columns that only lookups may fill.
ENRICHMENT_COLUMNS = [
    "latitude", "longitude", "phone", "website", "operating_hours", "services",
    "specialties", "accepted_insurance", "has_emergency", "google_place_id",
    "google_rating", "email",
]

# The eight fields a complete lookup fills.
COMPULSORY_FIELDS = [
    "latitude", "longitude", "phone", "operating_hours", "services",
    "specialties", "google_place_id", "google_rating",
]

# Plan fields whose change makes a plan "updated".
PLAN_COMPARE_FIELDS = [
    "plan_name", "plan_type", "coverage_type", "annual_limit", "lifetime_limit",
    "room_board_limit", "outpatient_covered", "maternity_covered",
    "dental_covered", "optical_covered", "mental_health_covered",
    "monthly_premium_min", "monthly_premium_max", "deductible",
    "co_payment_percentage", "min_age", "max_age", "panel_hospitals",
    "covered_conditions", "excluded_conditions", "claim_process",
    "contact_phone", "website",
]

# Field groups of a plan record.
MONEY_FIELDS = ["annual_limit", "lifetime_limit", "room_board_limit",
                "monthly_premium_min", "monthly_premium_max", "deductible"]
COVERAGE_FIELDS = ["outpatient_covered", "maternity_covered", "dental_covered",
                   "optical_covered", "mental_health_covered"]
LIMIT_FIELDS = ["annual_limit", "lifetime_limit", "room_board_limit"]
AGE_FIELDS = ["min_age", "max_age"]
TEXT_FIELDS = ["plan_name", "plan_type", "coverage_type", "claim_process"]
LIST_FIELDS = ["covered_conditions", "excluded_conditions"]


def _fields(names: list[str], kind: T.DataType) -> list[T.StructField]:
    return [T.StructField(n, kind) for n in names]


_STRINGS = T.ArrayType(T.StringType())

FACILITY = T.StructType(
    _fields(["id"], T.StringType()) + _fields(["updated_at"], T.TimestampType())
    + _fields(["name", "facility_type", "address", "city", "state", "postcode", "email"],
              T.StringType())
    + _fields(["is_24_hours", "has_emergency", "is_government", "is_active"], T.BooleanType())
    + _fields(["latitude", "longitude"], T.DoubleType())
    + _fields(["phone", "website"], T.StringType())
    + _fields(["operating_hours"], HOURS)
    + _fields(["services", "specialties", "accepted_insurance"], _STRINGS)
    + _fields(["google_place_id"], T.StringType())
    + _fields(["google_rating"], T.DoubleType())
)

PLAN = T.StructType(
    _fields(["id", "provider_name", "plan_name", "plan_type", "coverage_type"], T.StringType())
    + _fields(LIMIT_FIELDS, T.DoubleType())
    + _fields(COVERAGE_FIELDS, T.BooleanType())
    + _fields(["covered_conditions", "excluded_conditions", "panel_hospitals"], _STRINGS)
    + _fields(["monthly_premium_min", "monthly_premium_max", "deductible",
               "co_payment_percentage"], T.DoubleType())
    + _fields(AGE_FIELDS, T.IntegerType())
    + _fields(["claim_process", "contact_phone", "website"], T.StringType())
    + _fields(["is_active"], T.BooleanType())
    + _fields(["created_at", "updated_at"], T.TimestampType())
)

ENRICHMENT_RESULT = T.StructType(
    _fields(["clinic_id", "name"], T.StringType())
    + _fields(["latitude", "longitude"], T.DoubleType())
    + _fields(["phone"], T.StringType())
    + _fields(["operating_hours"], HOURS)
    + _fields(["services", "specialties"], _STRINGS)
    + _fields(["google_place_id"], T.StringType())
    + _fields(["google_rating"], T.DoubleType())
    + _fields(["website", "email"], T.StringType())
    + _fields(["has_emergency", "scrape_success"], T.BooleanType())
    + _fields(["scrape_error"], T.StringType())
)

PLACE_SEARCH = T.StructType([T.StructField("results", T.ArrayType(T.StructType([
    T.StructField("place_id", T.StringType()),
    T.StructField("geometry", T.StructType([T.StructField("location", T.StructType(
        _fields(["lat", "lng"], T.DoubleType())))])),
    T.StructField("rating", T.DoubleType()),
    T.StructField("user_ratings_total", T.IntegerType()),
])))])

PLACE_DETAILS = T.StructType([T.StructField("result", T.StructType(
    _fields(["formatted_phone_number", "international_phone_number", "website"], T.StringType())
    + _fields(["opening_hours"], T.StructType(
        [*HOURS.fields, T.StructField("open_now", T.BooleanType())]))))])
