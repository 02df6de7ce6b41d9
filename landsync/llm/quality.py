"""Quality rules: base counts, then robust multivariate outliers.

A text's counts become a vector of transformed statistics. For each language and
source the location and scatter of the vectors are estimated by the minimum
covariance determinant: C-steps take the HALF share of rows that lie nearest by
Mahalanobis distance and work out mean and covariance from these alone, so that junk
can't hide by moving the estimate. Each group sets out from three starts (medians with
the floors as scatter, medians with the quartiles' distance, mean and covariance of all
rows); a start goes on until its determinant falls no more, and the least determinant
of the group's starts wins. A row is rejected if its distance is beyond the CUT
quantile that a normal distribution would have.

A group with fewer than LEAST rows takes the estimate of its language, a language
with fewer that of all rows. The scatter's diagonal gets a floor for each statistic:
in clean text most shares are zero, and a scatter of zero would reject all else.

Nothing but DataFrame functions is used. A C-step is one pass for all groups and starts
that still fall: moments are summed by group, start and bin of distance, and running totals over the bins give the moments of
the nearest share. So a group of any size is summed in every task before a shuffle.

Cases: a null or empty text has no words and fails the base rules. Null language or
source counts as empty. Rows may repeat; each counts. Rows that fail the base rules
take no part in the estimates. Equal distances fall into one bin and are taken
together. An empty table gives no rows.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landsync.llm.common import SPACE, UPPER, bind, settled, small, table, words
from landsync.llm.registry import query

SYMBOLS = "#*$%&|<>"
#: Statistics in order, and the floor of each one's standard deviation.
FLOORS = {"length": 0.08, "symbols": 0.06, "lines": 0.25, "repeats": 0.2, "capitals": 0.08}
P = len(FLOORS)
HALF, LEAST = 0.75, 50
#: Fall of a determinant's logarithm below which a start is at its end. The floors bound determinants from below.
FALL = 1e-3
#: Bins of log2(1 + squared distance) to the unit; steps to which statistics are rounded, so that sums are exact.
BINS, GRID = 64, 1024
#: Standard normal quantile of 0.999, for the chi-square quantile by Wilson and Hilferty.
Z_CUT, Z_HALF = 3.0902, 0.6745
#: Distance of the quartiles of a normal distribution, in standard deviations.
QUARTILES = 1.349


def _chi2_quantile(z: float) -> float:
    return P * (1 - 2 / (9 * P) + z * math.sqrt(2 / (9 * P))) ** 3


def _chi2_share(x: float, k: int) -> float:
    """Share of a chi-square distribution with k degrees of freedom below x."""
    a, x = k / 2, x / 2
    term = total = 1 / a
    for n in range(1, 200):
        term *= x / (a + n)
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


CUT = _chi2_quantile(Z_CUT)
#: Makes the scatter of the nearest share that of the whole, for normal data.
CONSISTENT = HALF / _chi2_share(_chi2_quantile(Z_HALF), P + 2)


def repeat_words(w: Column) -> Column:
    """Words that lie in a window of three words found twice or more."""
    windows = F.when(F.size(w) >= 3, F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(w) - 3, F.lit(0))),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))).otherwise(F.array().cast("array<bigint>"))

    def places(s: Column) -> Column:
        same = lambda x, k: F.coalesce(x["h"] == F.get(s, k)["h"], F.lit(False))
        return F.array_sort(F.array_compact(F.transform(
            s, lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["i"]))))

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        total = F.aggregate(
            bind(ordered, places), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda acc, i: F.struct((acc["n"] + i + 3 - F.greatest(acc["end"], i)).alias("n"), (i + 3).alias("end")),
            lambda acc: acc["n"])
        return F.when(F.size(F.array_distinct(h)) < F.size(h), total).otherwise(F.lit(0))

    return bind(windows, covered)


def text_counts(text: Column) -> Column:
    """The base counts and those the statistics need, as a struct."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.length(F.regexp_replace(x, SPACE, "")) > 0)
    without = lambda chars: F.length(whole) - F.length(F.translate(whole, chars, ""))
    return F.struct(
        bind(words(text), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeat_words(w).cast("long").alias("n_repeat_words"))).alias("w"),
        without(SYMBOLS).cast("long").alias("n_symbols"), without(UPPER).cast("long").alias("n_capitals"),
        bind(lines, lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("l"))


def _vector() -> dict[str, Column]:
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    raw = {"length": F.ln(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))),
           "symbols": share("n_symbols", "word_chars"), "lines": share("n_dup_lines", "n_lines"),
           "repeats": share("n_repeat_words", "n_words"), "capitals": share("n_capitals", "word_chars")}
    return {k: F.round(v * GRID) / GRID for k, v in raw.items()}


def counted(docs: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang", source: str = "source"
            ) -> DataFrame:
    """(doc_id, lang, source, the base counts, base_failed, the statistics)"""
    return (docs.select(F.col(key).alias("doc_id"), F.coalesce(lang, F.lit("")).alias("lang"),
                        F.coalesce(source, F.lit("")).alias("source"), text_counts(F.col(text)).alias("c"))
            .select("doc_id", "lang", "source", "c.w.*", "c.n_symbols", "c.n_capitals", "c.l.*")
            .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
            .withColumns(_vector()))


def _groups(good: DataFrame) -> DataFrame:
    """By language and source: ``own``, the group that judges its rows, and ``groups``, those they count in."""
    sizes = settled(good.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")), "quality-sizes")
    langs = sizes.groupBy("lang").agg(F.sum("n").alias("n_lang"), F.min("n").alias("least"))
    smallest = settled(langs, "quality-languages")
    alone = smallest.agg(F.coalesce(F.min("n_lang") < LEAST, F.lit(False))).first()[0]
    name = lambda *parts: F.to_json(F.array(*parts))
    own, of_lang, of_all = name("lang", "source"), name("lang"), F.lit("[]")
    level = F.when(F.col("n") >= LEAST, own).when(F.col("n_lang") >= LEAST, of_lang).otherwise(of_all)
    counts_in = F.array_compact(F.array(
        F.when(F.col("n") >= LEAST, own),
        F.when((F.col("least") < LEAST) & (F.col("n_lang") >= LEAST), of_lang),
        F.when(F.lit(alone), of_all)))
    return settled(sizes.join(smallest, "lang").select(
        "lang", "source", level.alias("own"), counts_in.alias("groups")), "quality-groups")


_PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]
_ESTIMATE = [*(f"m{i}" for i in range(P)), *(f"w{i}{j}" for i, j in _PAIRS)]


def _distance() -> Column:
    """Squared distance of the statistics from m0.., by the inverse factor w_ij of the scatter."""
    away = [F.col(name) - F.col(f"m{i}") for i, name in enumerate(FLOORS)]
    rows = [reduce(add, (F.col(f"w{i}{j}") * away[j] for j in range(i + 1))) for i in range(P)]
    return reduce(add, (r * r for r in rows))


def _factor(moments: DataFrame) -> DataFrame:
    """Mean, inverse Cholesky factor and determinant by group and start, from counts, sums s_i and sums of products s_ij."""
    floors = list(FLOORS.values())
    df = moments.withColumns({f"m{i}": F.col(f"s{i}") / F.col("n") for i in range(P)})
    df = df.withColumns({f"c{i}{j}": CONSISTENT * (F.col(f"s{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}"))
                         + (floors[i] ** 2 if i == j else 0.0) for i, j in _PAIRS})
    for i, j in _PAIRS:
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        df = df.withColumn(f"l{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"l{j}{j}"))
    for i in range(P):
        for j in range(i, -1, -1):
            if i == j:
                df = df.withColumn(f"w{i}{j}", 1 / F.col(f"l{i}{i}"))
            else:
                total = reduce(add, (F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)))
                df = df.withColumn(f"w{i}{j}", -total / F.col(f"l{i}{i}"))
    log_det = -2 * reduce(add, (F.ln(f"w{i}{i}") for i in range(P)))
    return df.select("group", "start", *_ESTIMATE, log_det.alias("log_det"))


def _starts(members: DataFrame, moments: list[Column]) -> DataFrame:
    """(group, start, m_i, w_ij, log_det) from which C-steps set out; no determinant is known yet."""
    quartiles = [F.percentile_approx(name, [0.25, 0.5, 0.75], 10_000).alias(f"q{i}") for i, name in enumerate(FLOORS)]
    of_all = settled(members.groupBy("group").agg(*quartiles, *moments), "quality-starts")

    def by_median(start: int, scale) -> DataFrame:
        return of_all.select("group", F.lit(start).alias("start"), *(F.col(f"q{i}")[1].alias(f"m{i}") for i in range(P)),
                             *((1 / scale(i) if i == j else F.lit(0.0)).alias(f"w{i}{j}") for i, j in _PAIRS))

    floors = list(FLOORS.values())
    starts = (by_median(0, lambda i: F.lit(floors[i]))
              .union(by_median(1, lambda i: F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / QUARTILES, F.lit(floors[i]))))
              .union(_factor(of_all.withColumn("start", F.lit(2))).drop("log_det")))
    return starts.withColumn("log_det", F.lit(float("inf")))


def estimates(members: DataFrame) -> DataFrame:
    """(group, m_i, w_ij) of the least determinant by C-steps. ``members`` holds the statistics by group."""
    names = list(FLOORS)
    moments = [F.count(F.lit(1)).alias("n"), *(F.sum(c).alias(f"s{i}") for i, c in enumerate(names)),
               *(F.sum(F.col(names[i]) * F.col(names[j])).alias(f"s{i}{j}") for i, j in _PAIRS)]
    summed = ["n", *(f"s{i}" for i in range(P)), *(f"s{i}{j}" for i, j in _PAIRS)]
    of = ["group", "start"]
    every = Window.partitionBy(*of)
    upto = every.orderBy("bin")
    now, ended = settled(_starts(members, moments), "mcd"), []
    while not now.isEmpty():
        bins = (members.join(small(now), "group")
                .withColumn("bin", F.floor(F.log2(1 + _distance()) * BINS))
                .groupBy(*of, "bin").agg(*moments))
        running = bins.select(*of, "bin", F.sum("n").over(every).alias("all"),
                              *(F.sum(c).over(upto).alias(c) for c in summed))
        nearest = running.where(F.col("n") >= HALF * F.col("all")).groupBy(*of).agg(
            F.min_by(F.struct(*summed), "bin").alias("x")).select(*of, "x.*")
        before = now.select(*of, F.col("log_det").alias("before"))
        step = settled(_factor(nearest).join(small(before), of), "mcd")
        falls = F.col("log_det") < F.col("before") - FALL
        ended.append(now.join(small(step.where(~falls).select(*of)), of, "left_semi"))
        now = step.where(falls).drop("before")
    if not ended:
        return now.drop("start", "log_det")
    return reduce(DataFrame.union, ended).groupBy("group").agg(
        F.min_by(F.struct(*_ESTIMATE), F.struct("log_det", "start")).alias("x")).select("group", "x.*")


def judge(docs: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang", source: str = "source"
          ) -> DataFrame:
    """Per row: doc_id, counts, base_failed, distance (null where base_failed) and kept."""
    rows = settled(counted(docs, text, key, lang, source), "quality")
    good = rows.where(~F.col("base_failed"))
    groups = _groups(good)
    members = (good.join(small(groups), ["lang", "source"])
               .select(F.explode("groups").alias("group"), *FLOORS))
    of_group = settled(groups.join(estimates(members), groups["own"] == F.col("group")).drop("own", "groups", "group"),
                       "quality-estimates")
    judged = rows.join(small(of_group), ["lang", "source"], "left")
    distance = F.when(~F.col("base_failed"), F.sqrt(_distance()))
    return judged.withColumn("distance", distance).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= math.sqrt(CUT), F.lit(True)))


@query()
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")
