"""Mixing of sources by schedules that change over the training.

A source has a schedule: a rate that goes in straight lines between knots, from time 0 to 1.
The integral of its schedule is its weight, and sources share the words of all documents by
weight. A source gives at most MOST times its own words; what it can't give is shared anew among
the others, until none is asked for more than that.

A source's documents stand in a fixed shuffled order, pass after pass, until its words are
taken; the last one is cut. The schedule up to a time is the share of the source's demand that is
used by then, a quadratic in each piece, so the number of words before a document inverts to
the time at which the training reaches it: the document's position. Documents sorted by ranges
of positions are the curriculum.

The words before a document come from sums over ranges of (source, order), so that a source of
any size is spread over tasks. Only the table of sources is looked at as a whole.

Cases: a null or empty text has no words and takes no part. A null source is the last of the
sources. Rows that repeat an id each count and each get a place. Empty tables give no rows; extra
columns are not read. Reruns give the same rows, as the order comes from the md5 of the id.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landsync.llm.common import settled, small, table, words
from landsync.llm.registry import query
from landsync.operators.dedup import running_total

#: Times that a source may be passed through.
MOST = 3


@dataclass(frozen=True)
class Schedule:
    """Rates at times from 0 to 1, positive, in straight lines between them."""

    knots: tuple[tuple[float, float], ...]

    def __post_init__(self):
        times, rates = zip(*self.knots)
        if times[0] != 0 or times[-1] != 1 or list(times) != sorted(set(times)) or min(rates) <= 0:
            raise ValueError(f"a schedule needs rising times from 0 to 1 and positive rates: {self.knots}")

    def areas(self) -> list[float]:
        """The integral up to each knot."""
        out = [0.0]
        for (t0, r0), (t1, r1) in zip(self.knots, self.knots[1:]):
            out.append(out[-1] + (t1 - t0) * (r0 + r1) / 2)
        return out

    @property
    def weight(self) -> float:
        return self.areas()[-1]

    def pieces(self) -> list[tuple[float, float, float, float]]:
        """(time, rate and integral at the start, slope) of each straight piece."""
        return [(t0, r0, a, (r1 - r0) / (t1 - t0))
                for (t0, r0), (t1, r1), a in zip(self.knots, self.knots[1:], self.areas())]

    def time_of(self, share: Column) -> Column:
        """The time at which this share of the integral is used."""
        out, area = None, share * F.lit(self.weight)
        for t0, r0, a, slope in self.pieces():
            y = area - F.lit(a)
            at = F.lit(t0) + F.lit(2.0) * y / (F.lit(r0) + F.sqrt(F.greatest(F.lit(r0 * r0) + F.lit(2.0 * slope) * y, F.lit(0.0))))
            out = at if out is None else F.when(area >= a, at).otherwise(out)
        return out


#: Dealt to the sources in turn: steady, falling and rising, of weight 1, 2 and 3.
SCHEDULES = (Schedule(((0.0, 1.0), (1.0, 1.0))), Schedule(((0.0, 3.0), (1.0, 1.0))),
             Schedule(((0.0, 1.0), (0.5, 3.0), (1.0, 5.0))))


def _dealt(schedules: Sequence[Schedule], value) -> Column:
    """What the schedule numbered in column ``schedule`` gives."""
    return reduce(lambda out, k: F.when(F.col("schedule") == k, value(schedules[k])).otherwise(out),
                  range(len(schedules)), F.lit(None).cast("double"))


def targets(sources: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, most: int = MOST) -> DataFrame:
    """``sources`` (source, source_size) with schedule, weight and target.

    Taken in the order in which sources reach their limit as the words to a unit of weight rise, each
    one's level is what is left over to a unit of the weight left over. Levels rise while the source
    before is at its limit and fall after that, so the highest is the level that all the others share.
    """
    ranked = sources.withColumn("schedule", (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1) % len(schedules))
    ranked = ranked.withColumn("weight", _dealt(schedules, lambda s: F.lit(s.weight)))
    ranked = ranked.withColumn("limit", F.col("source_size") * most)
    full = Window.orderBy(F.col("limit") / F.col("weight"), F.asc_nulls_last("source"))
    before, everywhere = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    rest = lambda c, over: F.sum(c).over(everywhere) - F.coalesce(F.sum(over).over(before), F.lit(0))
    level = ranked.withColumn("level", rest("source_size", "limit") / rest("weight", "weight"))
    return level.withColumn("target", F.least(F.max("level").over(everywhere) * F.col("weight"), F.col("limit").cast("double"))
                            ).drop("level", "limit")


def placed(docs: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, most: int = MOST, text: str = "text",
           key: str = "doc_id", source: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, takes): ``takes`` lists the passes that take words
    of the document as structs of position, pass and words."""
    sized = settled(docs.select(F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"),
                                F.size(words(F.col(text))).cast("long").alias("size"))
                    .withColumn("place", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))), "sizes")
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), schedules, most)
    sources = small(settled(sources.withColumnRenamed("source", "of"), "sources"))
    ordered = running_total(sized, ["source"], ["place", "doc_id", "size"], F.col("size"))
    known = ordered.join(sources, F.col("source").eqNullSafe(F.col("of")))
    asked = F.floor(F.col("target") + 0.5).cast("long")
    known = known.withColumn("asked", asked).withColumn(
        "whole", F.when(F.col("source_size") > 0, F.expr("asked DIV source_size")).otherwise(F.lit(0)).cast("long"))
    known = known.withColumn("rest", F.greatest(F.lit(0), F.least(
        "size", F.col("asked") - F.col("whole") * F.col("source_size") - F.col("before"))).cast("long"))
    share = lambda n: (n * F.col("source_size") + F.col("before")) / F.col("asked")
    takes = F.filter(F.transform(F.sequence(F.lit(0).cast("long"), "whole"), lambda n: F.struct(
        F.when(F.col("asked") > 0, _dealt(schedules, lambda s: s.time_of(share(n)))).alias("position"), n.alias("pass"),
        F.when(n < F.col("whole"), F.col("size")).otherwise(F.col("rest")).alias("words"))), lambda t: t["words"] > 0)
    return known.select("doc_id", "source", "size", "source_size", "target",
                        (F.col("whole") * F.col("size") + F.col("rest")).alias("taken"), takes.alias("takes"))


def by_position(rows: DataFrame) -> DataFrame:
    """Rows dealt to tasks by ranges of position and sorted there; those without one first."""
    rows = settled(rows, "positions")
    return rows.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


def training_order(places: DataFrame) -> DataFrame:
    """(position, doc_id, source, pass, words): every document as often as it is taken, in the order of training."""
    return by_position(places.select("doc_id", "source", F.explode("takes").alias("t")).select(
        "t.position", "doc_id", "source", "t.pass", "t.words"))


def _time_sql(schedule: Schedule) -> str:
    area, cases = f"(share * {schedule.weight!r})", ""
    for t0, r0, a, slope in schedule.pieces():
        y = f"({area} - {a!r})"
        at = f"{t0!r}::DOUBLE + 2.0::DOUBLE * {y} / ({r0!r}::DOUBLE + sqrt(greatest({r0 * r0!r}::DOUBLE + {2.0 * slope!r}::DOUBLE * {y}, 0.0::DOUBLE)))"
        cases = f"WHEN {area} >= {a!r} THEN {at} " + cases
    return f"CASE {cases} END"


def _sql(schedules: Sequence[Schedule], most: int) -> str:
    weight = " ".join(f"WHEN {k} THEN {s.weight!r}" for k, s in enumerate(schedules))
    time = " ".join(f"WHEN {k} THEN {_time_sql(s)}" for k, s in enumerate(schedules))
    return f"""
WITH sized AS (SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS place,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
ranked AS (SELECT source, sum(size)::BIGINT AS source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(schedules)} AS schedule FROM sized GROUP BY source),
weighed AS (SELECT *, (CASE schedule {weight} END)::DOUBLE AS weight, source_size * {most} AS cap FROM ranked),
levels AS (SELECT *, ((sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::DOUBLE
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))) AS level FROM weighed
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
aims AS (SELECT source, source_size, schedule, least(max(level) OVER () * weight, cap::DOUBLE) AS target FROM levels),
asks AS (SELECT *, floor(target + 0.5)::BIGINT AS asked FROM aims),
known AS (SELECT doc_id, size, source_size, target, asked, schedule,
    CASE WHEN source_size > 0 THEN asked // source_size ELSE 0 END AS passes,
    coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY place, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN asks a ON s.source IS NOT DISTINCT FROM a.source),
done AS (SELECT *, (passes * size + greatest(0, least(size, asked - passes * source_size - before)))::BIGINT AS taken,
    CASE WHEN asked > 0 THEN before::DOUBLE / asked END AS share FROM known)
SELECT doc_id, size, source_size, target, taken,
  CASE WHEN taken > 0 THEN CASE schedule {time} END END AS position FROM done"""


@query(_sql(SCHEDULES, MOST))
def op11_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, sorted by the first position in the training."""
    places = placed(table(spark, sf_dir, "documents"))
    first = F.get("takes", F.lit(0))["position"]
    return by_position(places.select("doc_id", "size", "source_size", "target", "taken", first.alias("position")))
