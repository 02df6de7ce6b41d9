"""Streams: many batches give the table of one batch, and restarts are safe."""

import time

import pytest
from pyspark.sql import functions as F

from landsync.operators.merge import apply_results, fold_results
from landsync.sources.store import (read_folders, read_snapshot, replace_folders,
                                    write_snapshot)
from landsync.streaming import jobs

RESULT = ("seq long, ts timestamp, clinic_id string, scrape_success boolean, latitude double, "
          "longitude double, phone string")
TABLE = "id string, latitude double, longitude double, phone string, is_active boolean"


@pytest.fixture(scope="module")
def results(spark):
    n = F.col("id")
    return spark.range(600).select(
        n.alias("seq"), F.timestamp_seconds(1_700_000_000 + n * 60).alias("ts"),
        (n % 7).cast("string").alias("clinic_id"), (n % 5 != 0).alias("scrape_success"),
        F.when(n % 3 != 0, n.cast("double")).alias("latitude"), n.cast("double").alias("longitude"),
        F.when(n % 4 == 0, n.cast("string")).alias("phone"))


def land(df, path, parts, backwards=False):
    """Write ``parts`` files in order of ``seq``, or the last first, each newer than the one before."""
    size = 600 // parts
    for i in (reversed(range(parts)) if backwards else range(parts)):
        (df.filter(F.floor(F.col("seq") / size) == i).coalesce(1)
         .write.mode("append").parquet(path))
        time.sleep(1.1)


def facilities(spark):
    return spark.createDataFrame([(str(k), None, None, "old", True) for k in range(9)], TABLE)


@pytest.mark.parametrize("parts,backwards", [(1, False), (3, False), (3, True)])
def test_results_stream(spark, results, tmp_path, parts, backwards):
    root, inbox = str(tmp_path / "t"), str(tmp_path / "in")
    write_snapshot(facilities(spark), root)
    land(results, inbox, parts, backwards)
    jobs.stream_results(jobs.landed(spark, inbox, results.schema, files_per_batch=1), root,
                        str(tmp_path / "c")).awaitTermination()
    want = apply_results(facilities(spark), fold_results(results))
    got = read_snapshot(spark, root)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_results_stream_in_place(spark, results, tmp_path):
    path, inbox = str(tmp_path / "t"), str(tmp_path / "in")
    replace_folders(facilities(spark), path)
    land(results, inbox, 3)
    jobs.stream_results(jobs.landed(spark, inbox, results.schema, files_per_batch=1), path,
                        str(tmp_path / "c"), in_place=True).awaitTermination()
    want = apply_results(facilities(spark), fold_results(results))
    got = read_folders(spark, path).select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_restart_and_replay(spark, results, tmp_path):
    root, inbox, mark = (str(tmp_path / n) for n in ("t", "in", "c"))
    write_snapshot(facilities(spark), root)

    def run():
        stream = jobs.landed(spark, inbox, results.schema)
        jobs.stream_results(stream, root, mark, dedup="seq").awaitTermination()

    results.filter("seq < 300").coalesce(1).write.parquet(inbox)
    run()
    # The same results land again, with new ones; nothing old is applied twice.
    results.filter("seq >= 290").coalesce(1).write.mode("append").parquet(inbox)
    changed = results.filter("seq < 7").withColumn("phone", F.lit("replayed"))
    changed.coalesce(1).write.mode("append").parquet(inbox)
    run()
    run()
    want = apply_results(facilities(spark), fold_results(results))
    got = read_snapshot(spark, root)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


@pytest.mark.parametrize("parts,backwards", [(1, False), (3, True)])
def test_counts_stream(spark, results, tmp_path, parts, backwards):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    land(results, inbox, parts, backwards)
    stream = jobs.landed(spark, inbox, results.schema, files_per_batch=1)
    jobs.stream_counts(stream, out, str(tmp_path / "c")).awaitTermination()
    got = jobs.read_counts(spark, out)
    want = jobs.hourly_counts(results)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_facility_stream(spark, tmp_path):
    inbox, root = str(tmp_path / "in"), str(tmp_path / "t")
    rows = spark.createDataFrame(
        [(1, "A", "x"), (2, " a", "X"), (3, "B", "y"), (4, None, "z")],
        "seq long, name string, address string")
    rows.coalesce(1).write.parquet(inbox)
    for _ in range(2):
        jobs.stream_facilities(jobs.landed(spark, inbox, rows.schema), root,
                               str(tmp_path / "c")).awaitTermination()
    assert sorted(r.name for r in read_snapshot(spark, root).collect()) == ["A", "B"]


@pytest.mark.parametrize("in_place", [False, True])
def test_facility_stream_in_any_order(spark, tmp_path, in_place):
    rows = [(1, 0, "A", "x", "first"), (2, 0, "a", "x", "later row"), (3, 1, "B", "y", "old"),
            (0, 2, "b", "y", "newer load"), (1, 2, "b", "Y", "its second row"), (9, 0, "C", "z", "alone")]
    made = spark.createDataFrame(rows, "seq long, load long, name string, address string, facility_type string")
    tables = []
    for n, order in enumerate(([0, 1, 2, 3, 4, 5], [5, 4, 3, 2, 1, 0], [[0, 1, 2, 3, 4, 5]])):
        inbox, root = str(tmp_path / f"in{n}"), str(tmp_path / f"t{n}")
        for k in order:
            part = [rows[i] for i in (k if isinstance(k, list) else [k])]
            spark.createDataFrame(part, made.schema).coalesce(1).write.mode("append").parquet(inbox)
            time.sleep(1.1)
        jobs.stream_facilities(jobs.landed(spark, inbox, made.schema, files_per_batch=1), root, str(tmp_path / f"c{n}"),
                               load="load", in_place=in_place).awaitTermination()
        table = read_folders(spark, root) if in_place else read_snapshot(spark, root)
        tables.append(sorted((r.name, r.facility_type) for r in table.collect()))
    assert tables == [[("A", "first"), ("C", "alone"), ("b", "newer load")]] * 3
