"""Sheet exports, landed readers, versioned store and source state."""

import csv
import io
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from landsync.operators import merge
from landsync.operators.dedup import unique_plans
from landsync.plans import plan_sync
from landsync.sources import landed, sheet, state, store

HEADER = 'BIL, jenis_fasiliti ,POSKOD,NAMA_PENUH_FASILITI,ALAMAT,Other,poskod'


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("multi_line", [None, True, False])
def test_sheet(spark, tmp_path, multi_line):
    path = write(tmp_path, "s.csv", "\n".join([
        "TARIKH KEMASKINI: 1/1/2025,,,,,,", HEADER,
        '1,Klinik, 00000 , Klinik A ,"12, ""Jalan"" 1",x,50000',
        "2,Klinik,1,Klinik B", ",,,,,,", "3,Klinik,1,  ,addr,x,1", "4,,,Klinik C,,,"]) + "\n")
    rows = sheet.read_sheet(spark, path, multi_line=multi_line).orderBy("seq").collect()
    assert [(r.nama_penuh_fasiliti, r.poskod, r.alamat, r.jenis_fasiliti) for r in rows] == [
        ("Klinik A", "50000", '12, "Jalan" 1', "Klinik"), ("Klinik B", "", "", "Klinik"),
        ("Klinik C", "", "", "")]
    assert "bandar" not in rows[0]


def test_wide_sheet(spark, tmp_path):
    header = [f"c{i}" for i in range(28)] + ["NAMA_PENUH_FASILITI", "x"]
    path = write(tmp_path, "w.csv", "title\n" + ",".join(header) + "\n" + ",".join(["v"] * 28 + ["Klinik W", ""]) + "\n")
    assert [r.nama_penuh_fasiliti for r in sheet.read_sheet(spark, path).collect()] == ["Klinik W"]
    long = write(tmp_path, "l.csv", '"title\nof many\nlines",\nNAMA_PENUH_FASILITI,"a\nb"\nKlinik L,1\n')
    assert [r.nama_penuh_fasiliti for r in sheet.read_sheet(spark, long).collect()] == ["Klinik L"]


def test_sheet_line_breaks_and_many(spark, tmp_path):
    one = write(tmp_path, "a.csv", f't,,,,,,\n{HEADER}\n1,K,,Klinik A,"line 1\nline 2",,1\n')
    two = write(tmp_path, "b.csv", "t,\nNAMA_PENUH_FASILITI,NEGERI\nKlinik B,Johor\n")
    assert sheet.read_sheet(spark, one).first().alamat == "line 1\nline 2"
    both = sheet.read_sheets(spark, [one, two]).orderBy("sheet").collect()
    assert [(r.sheet, r.nama_penuh_fasiliti, r.negeri) for r in both] == [
        (0, "Klinik A", None), (1, "Klinik B", "Johor")]


@pytest.mark.parametrize("size", ["64", "300", "4k", "128m"])
def test_cells_with_line_breaks_at_the_borders_of_splits(spark, tmp_path, size):
    rng = random.Random(6)
    rows = [["Title, \"quoted\"", ""], ["BIL", "NAMA_PENUH_FASILITI", "ALAMAT"]]
    for k in range(150):
        address = "".join(rng.choice(["\n", "Road", ", ", '"', "é", "\n\n", "x" * 30]) for _ in range(rng.randint(0, 9)))
        rows.append([str(k), f"Klinik {k}", address])
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows(rows)
    path = write(tmp_path, "b.csv", "\ufeff" + text.getvalue())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        found = sheet.read_sheet(spark, path)
        if size == "300":
            assert spark.read.text(path).rdd.getNumPartitions() > 20
        got = [(r["bil"], r["nama_penuh_fasiliti"], r["alamat"]) for r in found.orderBy("seq").collect()]
    finally:
        for key, value in zip(("maxPartitionBytes", "openCostInBytes"), before):
            spark.conf.set(f"spark.sql.files.{key}", value)
    assert got == [(a, b, c.strip()) for a, b, c in rows[2:]]
    whole = sheet.read_sheet(spark, path, multi_line=True).orderBy("seq").collect()
    assert [(r["bil"], r["nama_penuh_fasiliti"], r["alamat"]) for r in whole] == got


@pytest.mark.parametrize("last, said", [('1,"never closed', "never closed"), ('1,5" pipe,"a"",",2" x', "without quotes")])
def test_quotes_out_of_place_fail_the_job(spark, tmp_path, last, said):
    path = write(tmp_path, "q.csv", "t\nBIL,NAMA_PENUH_FASILITI\n0,a\n" + last + "\n")
    with pytest.raises(Exception, match=said):
        sheet.read_sheet(spark, path).collect()


def test_an_open_quote_at_the_top_does_not_bring_the_file_to_the_driver(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sheet, "TOP_LINES", 512)
    path = write(tmp_path, "o.csv", 't,"\n' + "a,b\n" * 2000)
    with pytest.raises(ValueError, match="quote"):
        sheet.read_sheet(spark, path)


def test_sheet_without_data_or_name(spark, tmp_path):
    assert sheet.read_sheet(spark, write(tmp_path, "e.csv", "title\n")).count() == 0
    assert sheet.read_sheet(spark, write(tmp_path, "n.csv", "t,\nALAMAT,\nx,\n")).count() == 0


def test_sheet_in_many_splits(spark, tmp_path):
    lines = ["title,,,,,,", HEADER] + [f"{i},K,,Klinik {i:05d},a,,1" for i in range(20000)]
    path = write(tmp_path, "big.csv", "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = sheet.read_sheet(spark, path, multi_line=False)
        assert df.rdd.getNumPartitions() > 3
        names = [r.nama_penuh_fasiliti for r in df.orderBy("seq").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert names == [f"Klinik {i:05d}" for i in range(20000)]


def test_header_index():
    assert sheet.header_columns(["poskod", None, " POSKOD "]) == {"poskod": 2}


def test_landed_readers(spark, tmp_path):
    pages = spark.createDataFrame([(1, "https://www.etiqa.com.my/health", "<p>x</p>"),
                                   (2, "https://elsewhere/x", "")],
                                  "page_id long, url string, html string")
    pages.write.parquet(str(tmp_path / "pages"))
    got = {r.page_id: r.provider_key for r in
           landed.read_pages(spark, str(tmp_path / "pages")).collect()}
    assert got == {1: "Etiqa", 2: None}
    place = {"clinic_id": "a", "search_json": json.dumps({"results": [
        {"place_id": "p", "geometry": {"location": {"lat": 1.5, "lng": 2}}, "rating": 4}]}),
        "details_json": json.dumps({"result": {"formatted_phone_number": "",
                                               "international_phone_number": "+60",
                                               "opening_hours": {"periods": [{"open": 1}]}}})}
    (tmp_path / "places").mkdir()
    write(tmp_path / "places", "x.json", json.dumps(place) + "\n"
          + json.dumps({"clinic_id": "b", "search_json": '{"results": []}'}) + "\n")
    rows = {r.clinic_id: r for r in landed.read_places(spark, str(tmp_path / "places")).select(
        "*", F.to_json("operating_hours.periods").alias("p")).collect()}
    assert (rows["a"].latitude, rows["a"].longitude, rows["a"].phone) == (1.5, 2.0, "+60")
    assert rows["a"].operating_hours.weekday_text == [] and rows["a"].p == '[{"open":1}]'
    assert rows["b"].latitude is None and rows["b"].operating_hours is None
    spark.createDataFrame([("u", '{"plan_name": "X", "min_age": 0}'), ("v", "not json")],
                          "url string, reply string").write.parquet(str(tmp_path / "replies"))
    replies = {r.url: r for r in landed.read_replies(spark, str(tmp_path / "replies")).collect()}
    assert (replies["u"].plan_name, replies["u"].min_age, replies["v"].plan_name) == ("X", 0, None)
    spark.createDataFrame([("b", 2, "two"), ("b", 1, "one"), ("b", 3, "")],
                          "brochure_url string, page_no int, text string"
                          ).write.parquet(str(tmp_path / "brochures"))
    text = landed.read_brochures(spark, str(tmp_path / "brochures")).first().text
    assert text == "one\n\ntwo"
    assert landed.read_since(spark, str(tmp_path / "brochures"), None).count() == 3
    assert landed.read_since(spark, str(tmp_path / "brochures"), "2020-01-01T00:00:00").count() == 3


def test_versions(spark, tmp_path):
    root = str(tmp_path / "t")
    assert store.versions(spark, root) == []
    assert store.read_snapshot(spark, root, "id string").count() == 0
    with pytest.raises(FileNotFoundError):
        store.read_snapshot(spark, root)
    seen = store.write_snapshot(spark.range(3).withColumn("id", F.col("id").cast("string")), root,
                                observe={"n": F.count(F.lit(1))})
    assert seen == {"n": 3}
    # A table may be rewritten from itself.
    store.write_snapshot(store.read_snapshot(spark, root).filter("id <> '0'"), root)
    assert store.read_snapshot(spark, root).count() == 2
    # An unfinished version does not count and is replaced.
    store.write_snapshot(spark.range(9), root)
    os.remove(f"{root}/v=2/_SUCCESS")
    assert store.versions(spark, root) == [0, 1]
    assert store.read_snapshot(spark, root).count() == 2
    store.write_snapshot(spark.range(4), root)
    assert store.versions(spark, root) == [0, 1, 2]
    assert store.read_snapshot(spark, root).count() == 4
    assert store.expire(spark, root, keep=1) == [0, 1]
    assert store.versions(spark, root) == [2]


def test_folders(spark, tmp_path):
    path = str(tmp_path / "p")
    base = spark.range(2000).select(F.md5(F.col("id").cast("string")).alias("id"),
                                    F.col("id").alias("v"))
    assert store.read_folders(spark, path, schema=base.schema).count() == 0
    with pytest.raises(FileNotFoundError):
        store.read_folders(spark, path)
    assert store.replace_folders(base, path, observe={"n": F.count(F.lit(1))}) == {"n": 2000}
    before, _ = store._manifest(spark, path, 2)
    assert len(before) > 240
    batch = base.filter("v < 3").withColumn("v", -F.col("v") - 1)
    hit = store.prefixes_of(batch)
    part = store.read_folders(spark, path, hit, 2)
    assert 3 <= part.count() < 60
    merged = (part.alias("o").join(batch.alias("n"), "id", "left")
              .select("id", F.coalesce("n.v", "o.v").alias("v")))
    store.replace_folders(merged, path, 2, hit)
    after, _ = store._manifest(spark, path, 2)
    assert {p for p in before if before[p] != after[p]} == set(hit)
    now = store.read_folders(spark, path)
    assert now.count() == 2000
    assert sorted(r.v for r in now.filter("v < 0").collect()) == [-3, -2, -1]
    # Another prefix length is refused; a folder whose rows are all gone goes too.
    for wrong in (lambda: store.replace_folders(base, path, 3), lambda: store.read_folders(spark, path, digits=1)):
        with pytest.raises(ValueError):
            wrong()
    with pytest.raises(ValueError):
        store.prefixes_of(spark.range(300).select(F.char(F.col("id") + 1).alias("id")), 1)
    store.replace_folders(now.filter(F.lit(False)), path, 2, hit[:1])
    left = store.read_folders(spark, path)
    assert left.filter(F.substring("id", 1, 2) == hit[0]).count() == 0 and left.count() > 1900
    count = left.count()
    assert store.expire_folders(spark, path) > 0 and store.read_folders(spark, path).count() == count


def test_a_write_cut_off_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "p")
    base = spark.range(50).select(F.md5(F.col("id").cast("string")).alias("id"), F.col("id").alias("v"))
    store.replace_folders(base, path, 1)

    def fail(*_args, **_options):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(store, "write_snapshot", fail)
    with pytest.raises(RuntimeError):
        store.replace_folders(base.withColumn("v", F.lit(-1)), path, 1)
    monkeypatch.undo()
    assert sorted(r.v for r in store.read_folders(spark, path).collect()) == list(range(50))
    store.replace_folders(base.withColumn("v", F.lit(-1)), path, 1)
    assert {r.v for r in store.read_folders(spark, path).collect()} == {-1}


def test_state(spark, tmp_path):
    root = str(tmp_path / "s")
    t = "2025-01-0{}T00:00:00Z"
    first = spark.createDataFrame([("a", t.format(1)), ("b", None)],
                                  "source_id string, modified_time string")
    checked = state.changed_sources(first, state.read_state(spark, root))
    assert all(r.changed for r in checked.collect())
    state.commit_state(checked, root)
    again = spark.createDataFrame([("a", t.format(1)), ("b", t.format(2)), ("c", "bad")],
                                  "source_id string, modified_time string")
    checked = state.changed_sources(again, state.read_state(spark, root))
    assert {r.source_id: r.changed for r in checked.collect()} == {"a": False, "b": True, "c": True}
    later = spark.createDataFrame([("a", "2025-01-01T08:00:01+08:00")],
                                  "source_id string, modified_time string")
    assert state.changed_sources(later, state.read_state(spark, root)).first().changed


def test_buckets_spare_the_shuffle(spark, tmp_path):
    root = str(tmp_path / "b")
    plans = spark.range(200).select(
        F.col("id").alias("seq"), F.md5(F.col("id").cast("string")).alias("id"),
        F.lit("P").alias("provider_name"), F.col("id").cast("double").alias("annual_limit"),
        F.lit(True).alias("is_active"))
    first = plan_sync.sync_stored_plans(plans, root, ("seq",), buckets=4)
    assert first["new"] == 200
    more = plans.withColumn("annual_limit", F.col("annual_limit") + (F.col("seq") < 5).cast("int"))
    second = plan_sync.sync_stored_plans(more, root, ("seq",), buckets=4)
    assert (second["updated"], second["unchanged"]) == (5, 195)
    files = [f for f in os.listdir(f"{root}/v=1") if f.endswith(".parquet")]
    assert len(files) == 4  # one per bucket: the join result is written as it lies
    stored = store.read_snapshot(spark, root, buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        nexts = merge.sync_plans(stored.drop("sync_status"), unique_plans(more))
        got = nexts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in got
    # Another session knows nothing of the table and registers it anew.
    other = spark.newSession()
    other.sql(f"DROP TABLE {store._bucketed_table(root, 1)}")
    again = store.read_snapshot(other, root, buckets=4)
    assert again.count() == 200 and again.filter("annual_limit = 5").count() == 2
    assert store.expire(spark, root, keep=1) == [0]
