"""Order, caps and positions do not depend on partitioning, hot keys included."""

from pyspark.sql import functions as F

from landsync.operators import dedup
from landsync.operators.stats import batch_accounting, group_by_provider, plans_per_provider


def hot(spark, n=9000):
    """A third of all rows share one id."""
    return spark.range(n).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 500).cast("string"))
        .alias("id"))


def brute_first(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r.seq):
        out.setdefault(r.id, r.seq)
    return out


def test_keep_first(spark):
    df = hot(spark)
    want = brute_first(df.collect())
    for parts in (1, 7):
        got = {r.id: r.seq for r in dedup.unique_facilities(df.repartition(parts, "seq")).collect()}
        assert got == want


def test_unique_plans_drop_missing_ids(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a"), (4, "a")], "seq long, id string")
    assert [r.seq for r in dedup.unique_plans(df).collect()] == [3]


def test_unique_names(spark):
    df = spark.createDataFrame([
        ("k", "Plan A", 1, 0, 0, "u"), ("k", "PLAN A", 0, 2, 5, "u"), ("k", "plan a", 0, 2, 4, "v"),
        ("k", "PLAN a", 0, 2, 4, "w"), ("k", "Plan a", 0, 2, 4, "w"), ("j", "Plan A", 2, 0, 0, "u")],
        "provider_key string, name string, strategy int, rank int, pos int, url string").repartition(5)
    got = {(r.provider_key, r.name) for r in dedup.unique_names(df).collect()}
    assert got == {("k", "plan a"), ("j", "Plan A")}


def test_first_links(spark):
    rows = [("a", f"u{i % 40}", 0, i) for i in range(200)] + [("b", f"v{i}", 1, i) for i in range(9)]
    df = spark.createDataFrame(rows, "provider_key string, url string, rank int, pos int")
    got = dedup.first_links(df.repartition(5), {"a": 3, "b": 20}).collect()
    assert sorted((r.provider_key, r.link_rank, r.url) for r in got if r.provider_key == "a") == [
        ("a", 1, "u0"), ("a", 2, "u1"), ("a", 3, "u2")]
    assert sum(r.provider_key == "b" for r in got) == 9
    assert dedup.first_links(df, 2).count() == 4


def test_report_and_positions(spark):
    df = hot(spark)
    report = dedup.duplicate_report(df).first()
    assert (report.rows_in, report.unique_rows, report.removed) == (9000, 501, 8499)
    empty = dedup.duplicate_report(df.filter("false")).first()
    assert tuple(empty) == (0, 0, 0)
    gaps = df.select((F.col("seq") * 7).alias("seq")).repartition(6)
    got = dedup.global_position(gaps, "seq", blocks=9).orderBy("seq").collect()
    assert [r.position for r in got] == list(range(9000))


def test_batches(spark):
    df = spark.range(1201).withColumnRenamed("id", "seq")
    rows = {r.batch: tuple(r)[1:] for r in
            batch_accounting(df, failed=F.col("seq") == 600).collect()}
    assert rows == {1: (500, 500, 0), 2: (500, 0, 500), 3: (201, 201, 0)}


def test_provider_counts(spark):
    plans = spark.createDataFrame([("a", "1"), ("a", "1"), (None, "2")],
                                  "provider_name string, id string")
    got = {r.provider_name: (r.plans, r.unique_ids) for r in group_by_provider(plans).collect()}
    assert got == {"a": (2, 1), "Unknown": (1, 1)}
    dim = spark.createDataFrame([("a",), ("b",)], "provider_key string")
    counted = plans_per_provider(dim, plans.withColumnRenamed("provider_name", "provider_key"))
    assert {r.provider_key: r.plans for r in counted.collect()} == {"a": 2, "b": 0}


def test_work_batch(spark):
    df = spark.createDataFrame([(str(i),) for i in range(30)], "id string").repartition(5)
    assert [r.id for r in dedup.work_batch(df, 3).collect()] == ["0", "1", "10"]


def test_running_total_of_a_hot_group_is_spread(spark):
    rows = [("hot" if i % 3 else None if i % 2 else f"g{i % 11}", i, i % 5, "x") for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, seq int, v int, before string").drop("before")
    got = dedup.running_total(df.repartition(7), ["g"], ["seq"], F.col("v"), blocks=16)
    total, want = {}, {}
    for g, seq, v, _ in rows:
        want[seq] = total.get(g, 0)
        total[g] = want[seq] + v
    assert {r["seq"]: r["before"] for r in got.collect()} == want
    places = dedup.running_total(df, [], ["seq"], blocks=8).collect()
    assert all(r["before"] == r["seq"] for r in places)
    assert dedup.running_total(df.filter("false"), ["g"], ["seq"]).count() == 0


def test_no_task_ranks_a_whole_provider(spark):
    links = spark.range(4000).select(
        F.when(F.col("id") % 40 == 0, "small").otherwise("hot").alias("provider_key"),
        F.concat(F.lit("u"), F.col("id")).alias("url"), F.lit(0).alias("rank"), F.col("id").alias("pos"))
    ranked = dedup.first_links(links)
    assert "_block" in ranked._jdf.queryExecution().optimizedPlan().toString()
    got = ranked.filter("provider_key = 'hot'").orderBy("pos").collect()
    assert [r["link_rank"] for r in got] == list(range(1, 3901))
