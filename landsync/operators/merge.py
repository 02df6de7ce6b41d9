"""Upserts, snapshot diff, lookup results and soft deletes as joins on ``id``.

Ids are hashes and unique per table, so the join keys are spread evenly. Joins
use ``id`` alone: the de-duplicated input is already partitioned by it, and the
provider test is a plain condition on the joined row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landsync.schemas import PLAN_COMPARE_FIELDS

TOLERANCE = 0.01


def _now(run_ts: Column | None) -> Column:
    return F.current_timestamp() if run_ts is None else run_ts


def _fill(df: DataFrame, like: T.StructType) -> list[Column]:
    """Columns of ``like`` that ``df`` lacks, as typed nulls."""
    return [F.lit(None).cast(f.dataType).alias(f.name) for f in like if f.name not in df.columns]


def upsert(target: DataFrame, batch: DataFrame, key: str = "id") -> DataFrame:
    """Insert new keys; for known keys overwrite the columns the batch has (its
    nulls too) and keep the others. Columns unknown to the target are left out."""
    old, new = target.alias("old"), batch.withColumn("_in", F.lit(True)).alias("new")
    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    here = F.col("new._in").isNotNull()
    out = [F.coalesce(F.col(f"new.{key}"), F.col(f"old.{key}")).alias(key)]
    for field in target.schema:
        if field.name == key:
            continue
        name, kept = field.name, F.col(f"old.{field.name}")
        if name in batch.columns:
            value = F.col(f"new.{name}").cast(field.dataType)
            kept = F.when(here, value).otherwise(kept)
        out.append(kept.alias(name))
    return joined.select(*out)


def plan_changed(fields: Sequence[T.StructField], old: str = "old", new: str = "new") -> Column:
    """True if any non-null new value differs from the stored one.

    Doubles may differ by the tolerance, and a not-a-number difference is none;
    lists compare in order; everything else compares exactly.
    """
    def differs(field: T.StructField) -> Column:
        was, now = F.col(f"{old}.{field.name}"), F.col(f"{new}.{field.name}")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            gap = now - was
            far = ~F.isnan(gap) & (F.abs(gap) > TOLERANCE)
            changed = F.when(was.isNull(), F.lit(True)).otherwise(far)
        else:
            changed = ~now.eqNullSafe(was)
        return now.isNotNull() & changed

    return reduce(lambda a, b: a | b, [differs(f) for f in fields], F.lit(False))


def diff_plans(existing: DataFrame, incoming: DataFrame,
               compare: Sequence[str] = tuple(PLAN_COMPARE_FIELDS),
               reactivate: bool = False) -> DataFrame:
    """Incoming plans (unique by id) with a ``status``.

    ``new``: id unknown. ``updated`` / ``unchanged``: an active row of the same
    provider has the id. ``conflict``: the id is taken by an inactive row or by
    another provider; ``reactivate`` turns the inactive ones into ``updated``.
    """
    joined = _joined(existing, incoming, "right")
    return joined.select(
        "new.*", _status(existing, incoming, compare, reactivate).alias("status"))


def _joined(existing: DataFrame, incoming: DataFrame, how: str) -> DataFrame:
    old = existing.withColumn("_stored", F.lit(True)).alias("old")
    new = incoming.withColumn("_in", F.lit(True)).alias("new")
    joined = old.join(new, F.col("old.id") == F.col("new.id"), how)
    return joined.drop(F.col("new._in")) if how == "right" else joined


def _status(existing: DataFrame, incoming: DataFrame, compare: Sequence[str],
            reactivate: bool) -> Column:
    fields = [f for f in incoming.schema if f.name in compare and f.name in existing.columns]
    same_owner = F.col("old.provider_name").eqNullSafe(F.col("new.provider_name"))
    active = F.coalesce(F.col("old.is_active"), F.lit(False))
    status = F.when(F.col("old._stored").isNull(), "new")
    status = status.when(same_owner & active,
                         F.when(plan_changed(fields), "updated").otherwise("unchanged"))
    if reactivate:
        status = status.when(same_owner, "updated")
    return status.otherwise("conflict")


def sync_plans(existing: DataFrame, incoming: DataFrame, run_ts: Column | None = None,
               null_policy: str = "overwrite", reactivate: bool = False,
               compare: Sequence[str] = tuple(PLAN_COMPARE_FIELDS)) -> DataFrame:
    """The next plan table, with ``sync_status`` telling what became of each row.

    One full outer join gives statistics and content together. A plan that is
    updated is written whole: with ``null_policy="overwrite"`` its nulls replace
    stored values, with ``"preserve"`` they do not. ``created_at`` is kept.
    Rows not in the input have status ``kept``.
    """
    if null_policy not in ("overwrite", "preserve"):
        raise ValueError(f"unknown null_policy: {null_policy}")
    now = _now(run_ts)
    joined = _joined(existing, incoming, "full_outer")
    status = (F.when(F.col("new._in").isNull(), "kept")
              .otherwise(_status(existing, incoming, compare, reactivate)))
    tagged = joined.withColumn("_status", status)
    take = F.col("_status").isin("new", "updated")
    out = [F.coalesce(F.col("old.id"), F.col("new.id")).alias("id")]
    for field in existing.schema:
        name, was = field.name, F.col(f"old.{field.name}")
        if name == "id":
            continue
        if name == "created_at":
            value = F.when(F.col("_status") == "new", now).otherwise(was)
        elif name == "updated_at":
            value = F.when(take, now).otherwise(was)
        elif name in incoming.columns:
            fresh = F.col(f"new.{name}").cast(field.dataType)
            if null_policy == "preserve":
                fresh = F.coalesce(fresh, was)
            value = F.when(take, fresh).otherwise(was)
        else:
            value = was
        out.append(value.alias(name))
    return tagged.select(*out, F.col("_status").alias("sync_status"))


#: Providers up to which a scope becomes a plain condition on the stored rows.
SCOPE = 10_000


def in_scope(existing: DataFrame, scope: DataFrame | Sequence[str]) -> DataFrame:
    """Stored plans of some providers. A scope that was counted, or is given as names, becomes a condition,
    which reaches the scan; the stored side is not shuffled by its few provider names."""
    if isinstance(scope, DataFrame):
        names = [r[0] for r in scope.select("provider_name").distinct().limit(SCOPE + 1).collect()]
        if len(names) > SCOPE:
            return existing.join(scope.select("provider_name").distinct(), "provider_name", "left_semi")
    else:
        names = list(scope)
    return existing.filter(F.col("provider_name").isin([n for n in names if n is not None]))


def _unlisted() -> Column:
    """Of a row of ``_with_listed``: its own provider does not list it."""
    return ~F.coalesce(F.array_contains("_listed", F.col("provider_name")), F.lit(False))


def _with_listed(existing: DataFrame, active: DataFrame) -> DataFrame:
    """``existing`` with ``_listed``, the providers that list its id; joined on the id alone."""
    listed = active.filter(F.col("id").isNotNull()).groupBy("id").agg(F.collect_set("provider_name").alias("_listed"))
    return existing.join(listed, "id", "left")


def missing_plans(existing: DataFrame, active: DataFrame,
                  providers: DataFrame | Sequence[str] | None = None) -> DataFrame:
    """Ids of active stored plans that the current id list of their provider lacks.

    ``active`` has ``provider_name`` and ``id``. Only providers in ``providers``
    (default: those in ``active``) are looked at; naming one with no active id
    gives all its plans. Pass ``providers`` where ``active`` is costly to compute.
    """
    stored = in_scope(existing.filter(F.col("is_active")), active if providers is None else providers)
    return (_with_listed(stored.select("id", "provider_name"), active)
            .filter(_unlisted()).select("id", "provider_name"))


def deactivate_missing(existing: DataFrame, active: DataFrame,
                       providers: DataFrame | Sequence[str] | None = None, run_ts: Column | None = None,
                       min_active: int = 0) -> DataFrame:
    """The plan table after the soft delete; ``deactivated`` marks the rows hit.

    With ``min_active`` a provider whose list is shorter than that is left alone.
    """
    scope = active if providers is None else providers
    if min_active > 0:
        scope = long_enough(active, scope, min_active)
    hit = in_scope(existing.filter(F.col("is_active")), scope)
    hit = (_with_listed(hit.select("id", "provider_name"), active).filter(_unlisted())
           .select("id", F.lit(True).alias("_hit")))
    marked = existing.join(hit, "id", "left").withColumn("deactivated", F.coalesce("_hit", F.lit(False)))
    changed = {"is_active": F.when(F.col("deactivated"), F.lit(False))
               .otherwise(F.col("is_active"))}
    if "updated_at" in existing.columns:
        changed["updated_at"] = (F.when(F.col("deactivated"), _now(run_ts))
                                 .otherwise(F.col("updated_at")))
    return (marked.withColumns(changed)
            .select(*existing.columns, "deactivated"))


def long_enough(active: DataFrame, scope: DataFrame | Sequence[str], min_active: int) -> DataFrame:
    """The providers of a scope that list ``min_active`` ids or more."""
    sizes = active.select("provider_name", "id").distinct().groupBy("provider_name").agg(F.count(F.lit(1)).alias("_n"))
    return in_scope(sizes.filter(F.col("_n") >= min_active), scope).select("provider_name")


LOOKUP_FIELDS = ["phone", "website", "operating_hours", "google_place_id", "google_rating"]
LOOKUP_LISTS = ["services", "specialties"]


def fold_results(results: DataFrame, seq: Sequence[str] = ("seq",)) -> DataFrame:
    """One row per facility with the joint effect of its lookup results in order.

    The last result decides the coordinates (0, 0 if it failed); every other
    field takes its last non-null value of a successful result. This is an
    aggregate that combines in the map tasks, and folding batch by batch gives
    the same table as folding at once.
    """
    order = F.struct(*[F.col(c) for c in seq])
    good = F.coalesce(F.col("scrape_success"), F.lit(False))
    aggs = [
        F.max_by(F.when(good, F.col(c)).otherwise(F.lit(0.0)), order).alias(c)
        for c in ("latitude", "longitude")
    ]
    for c in LOOKUP_FIELDS + LOOKUP_LISTS:
        if c not in results.columns:
            continue
        present = F.col(c).isNotNull()
        if c in LOOKUP_LISTS:
            present = present & (F.size(F.col(c)) > 0)
        aggs.append(F.max_by(F.col(c), F.when(good & present, order)).alias(c))
    aggs.append(F.max_by(good, order).alias("scrape_success"))
    known = results.filter(F.col("clinic_id").isNotNull() & (F.col("clinic_id") != ""))
    return known.groupBy("clinic_id").agg(*aggs)


def fold_state(results: DataFrame, seq: Sequence[str] = ("seq",)) -> DataFrame:
    """As ``fold_results``, with the order value that decided each field, so that states of
    several batches merge to the same in any order. ``id`` is the facility."""
    order = F.struct(*[F.col(c) for c in seq])
    good = F.coalesce(F.col("scrape_success"), F.lit(False))
    point = F.struct(order.alias("o"), *[F.when(good, F.col(c)).otherwise(F.lit(0.0)).alias(c)
                                         for c in ("latitude", "longitude")],
                     good.alias("scrape_success"))
    aggs = [F.max_by(point, order).alias("_point")]
    for c in LOOKUP_FIELDS + LOOKUP_LISTS:
        if c not in results.columns:
            continue
        present = good & F.col(c).isNotNull()
        if c in LOOKUP_LISTS:
            present = present & (F.size(F.col(c)) > 0)
        value = F.struct(order.alias("o"), F.col(c).alias("v"))
        aggs.append(F.max_by(F.when(present, value), F.when(present, order)).alias(c))
    known = results.filter(F.col("clinic_id").isNotNull() & (F.col("clinic_id") != ""))
    return known.groupBy(F.col("clinic_id").alias("id")).agg(*aggs)


def merge_states(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """One state per facility; of equal order values the stored one stays."""
    old, new = stored.alias("old"), fresh.alias("new")
    joined = old.join(new, F.col("old.id") == F.col("new.id"), "full_outer")
    out = [F.coalesce(F.col("old.id"), F.col("new.id")).alias("id")]
    for c in stored.columns:
        if c != "id":
            was, now = F.col(f"old.{c}"), F.col(f"new.{c}")
            later = was.isNull() | (now.isNotNull() & (now["o"] > was["o"]))
            out.append(F.when(later, now).otherwise(was).alias(c))
    return joined.select(*out)


def folded_of(state: DataFrame) -> DataFrame:
    """The folded results that a state stands for."""
    fields = [c for c in state.columns if c not in ("id", "_point")]
    return state.select(F.col("id").alias("clinic_id"), "_point.latitude", "_point.longitude",
                        *[F.col(f"{c}.v").alias(c) for c in fields], "_point.scrape_success")


def apply_results(facilities: DataFrame, folded: DataFrame,
                  run_ts: Column | None = None) -> DataFrame:
    """The facility table after lookup results (one row per facility, see
    ``fold_results``). Coordinates are always written, other fields only where
    the result has a value."""
    new = folded.withColumn("_in", F.lit(True)).alias("new")
    joined = facilities.alias("old").join(
        new, F.col("old.id") == F.col("new.clinic_id"), "left")
    here = F.col("new._in").isNotNull()
    out = []
    for field in facilities.schema:
        name, was = field.name, F.col(f"old.{field.name}")
        if name in ("latitude", "longitude"):
            was = F.when(here, F.col(f"new.{name}")).otherwise(was)
        elif name == "updated_at":
            was = F.when(here, _now(run_ts)).otherwise(was)
        elif name in LOOKUP_FIELDS + LOOKUP_LISTS and name in folded.columns:
            was = F.coalesce(F.col(f"new.{name}").cast(field.dataType), was)
        out.append(was.alias(name))
    return joined.select(*out)


def align(batch: DataFrame, schema: T.StructType) -> DataFrame:
    """``batch`` with every column of ``schema``, missing ones null."""
    have = [F.col(f.name).cast(f.dataType).alias(f.name)
            for f in schema if f.name in batch.columns]
    full = batch.select(*have, *_fill(batch, schema))
    return full.select(*[f.name for f in schema])


def direct_upsert_plans(existing: DataFrame, plans: DataFrame,
                        run_ts: Column | None = None) -> DataFrame:
    """Upsert plans without comparing. ``updated_at`` becomes the run time, and so
    does ``created_at`` unless the batch brings its own."""
    now = _now(run_ts)
    stamped = plans.withColumn("updated_at", now)
    if "created_at" not in plans.columns:
        stamped = stamped.withColumn("created_at", now)
    return upsert(existing, stamped)
