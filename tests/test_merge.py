"""Golden rows and properties of upserts, diff, lookup results and soft delete."""

import itertools
import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from landsync import schemas
from landsync.operators import merge, records
from landsync.operators.dedup import unique_plans
from landsync.operators.stats import sync_report, sync_stats

PLAN = ("id string, provider_name string, plan_name string, annual_limit double, "
        "min_age int, covered_conditions array<string>, dental_covered boolean, "
        "claim_process string, is_active boolean, created_at timestamp, updated_at timestamp")
NEW = ("seq long, id string, provider_name string, plan_name string, annual_limit double, "
       "min_age int, covered_conditions array<string>, dental_covered boolean")


def run(spark):
    return F.lit("2026-01-01").cast("timestamp")


@pytest.fixture
def existing(spark):
    old = spark.sql("select timestamp'2020-01-01'").first()[0]
    rows = [(k, "P", "n", v, 1, ["a", "b"], None, "text", act, old, old)
            for k, v, act in [("same", 100.0, True), ("near", 100.0, True), ("far", 100.0, True),
                              ("null", 100.0, True), ("fill", None, True), ("list", 100.0, True),
                              ("nan", 1.0, True), ("off", 100.0, False), ("gone", 1.0, True),
                              ("other", 100.0, True), ("age", 100.0, True), ("flag", 1.0, True)]]
    return spark.createDataFrame(rows, PLAN)


@pytest.fixture
def incoming(spark):
    def row(i, k, v=100.0, age=1, lst=("a", "b"), flag=None, prov="P"):
        return (i, k, prov, "n", v, age, list(lst) if lst else None, flag)

    return spark.createDataFrame([
        row(0, "same"), row(1, "near", 100.005), row(2, "far", 100.02), row(3, "null", None),
        row(4, "fill", 5.0), row(5, "list", lst=("b", "a")), row(6, "nan", math.nan),
        row(7, "off"), row(8, "new"), row(9, "other", prov="Q"), row(10, "age", age=2),
        row(11, "flag", 1.0, flag=True)], NEW)


WANT = {"same": "unchanged", "near": "unchanged", "far": "updated", "null": "unchanged",
        "fill": "updated", "list": "updated", "nan": "unchanged", "off": "conflict",
        "new": "new", "other": "conflict", "age": "updated", "flag": "updated"}


def test_diff(existing, incoming):
    got = {r.id: r.status for r in merge.diff_plans(existing, incoming).collect()}
    assert got == WANT


def test_sync(spark, existing, incoming):
    out = {r.id: r for r in merge.sync_plans(existing, incoming, run(spark)).collect()}
    assert {k: r.sync_status for k, r in out.items()} == {**WANT, "gone": "kept"}
    assert out["far"].annual_limit == 100.02 and out["far"].created_at.year == 2020
    assert out["far"].updated_at.year == 2026 and out["near"].annual_limit == 100.0
    assert out["new"].created_at.year == out["new"].updated_at.year == 2026
    assert out["off"].is_active is False and out["gone"].updated_at.year == 2020
    assert out["far"].claim_process == "text"  # not in the batch, so untouched


def test_null_policy_and_reactivation(spark, existing):
    batch = spark.createDataFrame([
        (0, "far", "P", "changed", None, None, None, None),
        (1, "off", "P", "n", 100.0, 1, ["a", "b"], None)], NEW)
    over = {r.id: r for r in merge.sync_plans(existing, batch, run(spark)).collect()}
    keep = {r.id: r for r in merge.sync_plans(
        existing, batch, run(spark), "preserve", reactivate=True).collect()}
    assert over["far"].annual_limit is None and keep["far"].annual_limit == 100.0
    assert over["off"].sync_status == "conflict" and keep["off"].sync_status == "updated"
    with pytest.raises(ValueError):
        merge.sync_plans(existing, batch, null_policy="other")


def test_sync_twice_changes_nothing(spark, existing, incoming):
    clean = incoming.filter(~F.col("id").isin("off", "other"))
    once = merge.sync_plans(existing, clean, run(spark)).drop("sync_status")
    # New rows of a batch without the column have no is_active; real records bring it.
    once = once.withColumn("is_active", F.coalesce("is_active", F.lit(True)))
    again = merge.diff_plans(once, clean)
    assert {r.status for r in again.collect()} <= {"unchanged"}


def test_counts_add_up(spark, existing, incoming):
    doubled = incoming.unionByName(incoming.withColumn("seq", F.col("seq") + 100))
    nameless = incoming.limit(2).withColumn("id", F.lit(""))
    unique = unique_plans(doubled.unionByName(nameless))
    stats = sync_stats(merge.diff_plans(existing, unique)).first()
    assert sum(stats) == len(WANT)
    report = sync_report(merge.diff_plans(existing, unique)).first()
    assert report.processed == report.new + report.updated + report.unchanged
    assert (report.success, report.errors) == (report.new + report.updated, 2)


def test_fast_and_detailed_runs_fight(spark):
    """A listing run blanks what a detailed run stored, unless nulls are kept."""
    old = spark.createDataFrame([], PLAN + ", website string")
    detailed = spark.createDataFrame(
        [("a", "P", "n", 5.0, "https://product", True)],
        "id string, provider_name string, plan_name string, annual_limit double, website string, "
        "is_active boolean")
    listing = detailed.withColumns({"annual_limit": F.lit(None).cast("double"),
                                    "website": F.lit("https://listing")})
    for policy, limit in (("overwrite", None), ("preserve", 5.0)):
        one = merge.sync_plans(old, detailed, run(spark), policy).drop("sync_status")
        two = merge.sync_plans(one, listing, run(spark), policy).first()
        assert (two.sync_status, two.annual_limit) == ("updated", limit)


def test_upsert_columns(spark):
    target = spark.createDataFrame(
        [("a", "A", "1", 3.5), ("b", "B", "2", None)],
        "id string, name string, phone string, latitude double")
    batch = spark.createDataFrame([("a", "A2", None), ("c", "C", "9")],
                                  "id string, name string, phone string")
    got = {r.id: tuple(r) for r in merge.upsert(target, batch).collect()}
    assert got == {"a": ("a", "A2", None, 3.5), "b": ("b", "B", "2", None),
                   "c": ("c", "C", "9", None)}


def test_facility_record_and_protection(spark):
    rows = spark.createDataFrame([(1, "Klinik 24 Jam", ""), (2, None, "x")],
                                 "seq long, name string, address string")
    out = records.facility_records(rows, run(spark))
    assert {"email", "has_emergency"} <= set(out.columns)
    first, second = out.orderBy("seq").collect()
    assert first.is_24_hours and first.address is None and first.id
    assert second.id is None
    kept = records.facility_records(rows, run(spark), protect_enrichment=True)
    assert not {"email", "has_emergency"} & set(kept.columns)
    stored = spark.createDataFrame(
        [Row(id=first.id, name="old", email="e@x", has_emergency=True, latitude=1.0)])
    wiped = merge.upsert(stored, out.filter("seq = 1").drop("seq")).first()
    safe = merge.upsert(stored, kept.filter("seq = 1").drop("seq")).first()
    assert (wiped.email, wiped.has_emergency, wiped.latitude) == (None, None, 1.0)
    assert (safe.email, safe.has_emergency, safe.name) == ("e@x", True, "Klinik 24 Jam")


RESULT = ("seq long, clinic_id string, scrape_success boolean, latitude double, longitude double, "
          "phone string, services array<string>")


def test_results(spark):
    facilities = spark.createDataFrame(
        [(k, None, None, "old", ["s"]) for k in "abcd"],
        "id string, latitude double, longitude double, phone string, services array<string>")
    found = spark.createDataFrame([
        (1, "a", True, 3.0, 101.0, None, []), (2, "b", True, None, None, "new", ["x"]),
        (3, "c", False, 9.0, 9.0, "bad", None), (4, None, True, 1.0, 1.0, "z", None),
        (5, "", True, 1.0, 1.0, "z", None)], RESULT)
    got = {r.id: tuple(r)[1:] for r in
           merge.apply_results(facilities, merge.fold_results(found)).collect()}
    assert got == {"a": (3.0, 101.0, "old", ["s"]), "b": (None, None, "new", ["x"]),
                   "c": (0.0, 0.0, "old", ["s"]), "d": (None, None, "old", ["s"])}


def test_fold_in_parts_equals_fold_at_once(spark):
    facilities = spark.createDataFrame(
        [("a", None, None, None, None)],
        "id string, latitude double, longitude double, phone string, services array<string>")
    events = [(1, "a", True, 1.0, 1.0, "p1", ["x"]), (2, "a", False, None, None, "no", None),
              (3, "a", True, None, 5.0, None, []), (4, "a", True, 7.0, 7.0, "", ["y"])]
    for cut in range(len(events) + 1):
        table = facilities
        for part in (events[:cut], events[cut:]):
            batch = spark.createDataFrame(part, RESULT)
            table = merge.apply_results(table, merge.fold_results(batch))
        assert tuple(table.first()) == ("a", 7.0, 7.0, "", ["y"])


def test_deactivate(spark, existing):
    active = spark.createDataFrame([("same", "P"), ("other", "Q")], "id string, provider_name string")
    hit = {r.id for r in merge.deactivate_missing(existing, active, run_ts=run(spark))
           .filter("deactivated").collect()}
    every = {r.id for r in existing.filter("is_active").collect()}
    assert hit == every - {"same"}
    assert {r.id for r in merge.missing_plans(existing, active).collect()} == hit
    none = spark.createDataFrame([], active.schema)
    only = spark.createDataFrame([("P",)], "provider_name string")
    assert {r.id for r in merge.missing_plans(existing, none, only).collect()} == every
    guarded = merge.deactivate_missing(existing, none, only, min_active=1)
    assert guarded.filter("deactivated").count() == 0
    other = spark.createDataFrame([("Q",)], "provider_name string")
    assert merge.missing_plans(existing, none, other).count() == 0


def test_direct_upsert(spark, existing):
    batch = spark.createDataFrame([("same", "P", 1.0), ("fresh", "P", 2.0)],
                                  "id string, provider_name string, annual_limit double")
    out = {r.id: r for r in merge.direct_upsert_plans(existing, batch, run(spark)).collect()}
    assert out["same"].annual_limit == 1.0 and out["same"].created_at.year == 2026
    own = batch.withColumn("created_at", F.lit("2021-01-01").cast("timestamp"))
    out = {r.id: r for r in merge.direct_upsert_plans(existing, own, run(spark)).collect()}
    assert out["fresh"].created_at.year == 2021 and out["fresh"].updated_at.year == 2026


def test_compare_fields_are_plan_columns():
    assert len(schemas.PLAN_COMPARE_FIELDS) == 23
    names = {f.name for f in schemas.PLAN}
    assert set(schemas.PLAN_COMPARE_FIELDS) <= names and len(names) == 28
    assert len({f.name for f in schemas.FACILITY}) == 23
    groups = [schemas.MONEY_FIELDS, schemas.COVERAGE_FIELDS, schemas.AGE_FIELDS,
              schemas.TEXT_FIELDS, schemas.LIST_FIELDS]
    assert len(set(itertools.chain(*groups)) | {"co_payment_percentage"}) == 20
