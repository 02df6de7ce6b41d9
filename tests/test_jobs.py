"""Whole jobs on small landed data."""

import json

import pytest
from pyspark.sql import functions as F

from landsync import rules, schemas
from landsync.operators import inference
from landsync.operators.extract import landed_products
from landsync.operators.stats import sync_report
from landsync.plans import (enrichment, facility_sync, plan_detail, plan_listing, plan_sync)
from landsync.sources import store

RUN = "2026-01-01"


def run_ts():
    return F.lit(RUN).cast("timestamp")


# --- facilities --------------------------------------------------------------
def sheet(spark, rows):
    return spark.createDataFrame(
        rows, "seq long, nama_penuh_fasiliti string, alamat string, jenis_fasiliti string")


def test_facility_round_trip(spark, tmp_path):
    root = str(tmp_path / "f")
    counts = facility_sync.sync_facilities(sheet(spark, [
        (1, "Klinik A", "Jalan 1", "K"), (2, "klinik a ", "jalan 1", "K2"),
        (3, "Klinik B 24jam", "", "K")]), root, run_ts())
    assert counts == {"rows": 2, "pending": 2}
    table = store.read_snapshot(spark, root)
    assert set(table.columns) == {f.name for f in schemas.FACILITY}
    todo = enrichment.next_batch(table).collect()
    assert {r.query for r in todo} == {"Klinik A, Jalan 1, Malaysia", "Klinik B 24jam, Malaysia"}

    ids = {r.name: r.id for r in todo}
    pages = spark.createDataFrame([
        (ids["Klinik A"], "https://maps/@3.1,101.6,17z!1s0x1:0x2", "open 24 hours",
         ["new", "4,5"], "phone:tel:03-1", None, None, None, [["Mon\t9-5"]], None,
         ["Clinic"], [["X-ray scans"]], "https://a"),
        (ids["Klinik B 24jam"], "https://maps/", "please solve the CAPTCHA", [], None, None,
         None, None, None, None, None, None, None)],
        "clinic_id string, url string, html string, rating_texts array<string>, "
        "phone_attribute string, phone_label string, phone_tooltips array<string>, "
        "panel_texts array<string>, hours_groups array<array<string>>, hours_label string, "
        "categories array<string>, service_groups array<array<string>>, website string")
    results = enrichment.lookup_results(pages).withColumn("seq", F.monotonically_increasing_id())
    a = results.filter("scrape_success").first()
    assert (a.latitude, a.google_rating, a.phone, a.filled) == (3.1, 4.5, "03-1", 8)
    assert a.has_emergency and a.specialties == ["Clinic"]
    # Captured hours carry no periods; the stored struct has both parts.
    shaped = results.withColumn("operating_hours", F.when(
        F.col("operating_hours").isNotNull(), F.struct(
            F.col("operating_hours.weekday_text").alias("weekday_text"),
            F.lit(None).cast("variant").alias("periods"))))
    done = enrichment.enrich(table, shaped, run_ts())
    store.write_snapshot(done, root)
    again = facility_sync.sync_facilities(sheet(spark, [(1, "Klinik A", "Jalan 1", "New")]),
                                          root, run_ts())
    assert again == {"rows": 2, "pending": 0}
    rows = {r.name: r for r in store.read_snapshot(spark, root).collect()}
    kept = rows["Klinik A"]
    assert (kept.facility_type, kept.latitude, kept.services) == ("New", 3.1, ["X-ray scans"])
    assert kept.operating_hours.weekday_text == ["Mon 9-5"]
    assert rows["Klinik B 24jam"].latitude == 0.0 and rows["Klinik B 24jam"].is_24_hours


def test_in_place_jobs(spark, tmp_path):
    root, path = str(tmp_path / "v"), str(tmp_path / "p")
    rows = [(i, f"Klinik {i}", "x", "K") for i in range(300)]
    facility_sync.sync_facilities(sheet(spark, rows), root, run_ts())
    store.replace_folders(store.read_snapshot(spark, root), path)
    more = sheet(spark, [(0, "Klinik 5", "x", "New"), (1, "Klinik 900", "x", "K")])
    facility_sync.sync_facilities(more, root, run_ts())
    facility_sync.sync_facilities_in_place(more, path, run_ts())
    some = store.read_snapshot(spark, root).limit(20).select(
        F.monotonically_increasing_id().alias("seq"), F.col("id").alias("clinic_id"),
        F.lit(True).alias("scrape_success"), F.lit(1.0).alias("latitude"),
        F.lit(2.0).alias("longitude"), F.lit("9").alias("phone"))
    some = spark.createDataFrame(some.collect(), some.schema)
    store.write_snapshot(enrichment.enrich(store.read_snapshot(spark, root), some, run_ts()), root)
    enrichment.enrich_in_place(some, path, run_ts())
    want = store.read_snapshot(spark, root).drop("operating_hours")
    got = store.read_folders(spark, path).select(*want.columns)
    assert want.count() == 301
    assert want.exceptAll(got).count() == got.exceptAll(want).count() == 0


# --- plans -------------------------------------------------------------------
LISTING = {
    "AIA": """<div class="product-card"><h2>AIA Med Care</h2><a href="/p/health-one.html">x</a></div>
<div class="product-card"><h3>Read more now</h3></div>
A-Plus Health Gold and AIA Voluntary Cover<br>
<a href="/en/our-products/health-protection/med-insure.html">q</a>
<a href="/en/our-products/health-protection/overview.html">q</a>
<a href="/en/our-products/life-protection/a-life.html?x=1">q</a>""",
    "GreatEastern": """<h2>Nothing</h2> SmartMedic Shield. Great Eastern Life. great protector
<a href="/my/en/personal-insurance/our-products/health-insurance/great-health-direct.html">q</a>
<a href="/my/en/personal-insurance/our-products/health-insurance/great-cancer.html">q</a>
<a href="/my/en/personal-insurance/our-products/health-insurance.html">q</a>""",
    "Prudential": """<div class="card"><a href="/products-riders/prumillion-med/">a</a>
<a href="/products-riders/life/">b</a><a href="/claims-and-support/products-riders/med">c</a></div>
Prudential plc PRUMillion Med Active""",
}


def listing_pages(spark):
    urls = {p[0]: p[3] for p in rules.PROVIDERS}
    return spark.createDataFrame(
        [(k, urls[k], f"<html><body>{v}</body></html>") for k, v in LISTING.items()],
        "provider_key string, url string, html string")


def test_links(spark):
    got = {}
    for r in plan_detail.detail_links(listing_pages(spark)).collect():
        got.setdefault(r.provider_key, []).append((r.link_rank, r.url))
    base = {p[0]: p[2] for p in rules.PROVIDERS}
    section = "/my/en/personal-insurance/our-products/health-insurance/"
    assert {k: [u for _, u in sorted(v)] for k, v in got.items()} == {
        "AIA": [base["AIA"] + "/en/our-products/health-protection/med-insure.html"],
        "GreatEastern": [base["GreatEastern"] + section + "great-health-direct.html",
                         base["GreatEastern"] + section + "great-cancer.html"],
        "Prudential": [base["Prudential"] + "/products-riders/prumillion-med/"]}
    seen = plan_listing.visited_links(listing_pages(spark)).filter("provider_key = 'AIA'")
    urls = [r.url for r in seen.orderBy("link_rank").collect()]
    assert urls == [base["AIA"] + u for u in (
        "/en/our-products/health-protection/med-insure.html",
        "/en/our-products/health-protection/overview.html",
        "/en/our-products/life-protection/a-life.html?x=1", "/p/health-one.html")]


def test_landed_products(spark):
    links = plan_detail.detail_links(listing_pages(spark))
    pages = spark.createDataFrame([
        ("https://www.prudential.com.my/products-riders/prumillion-med/", "<h1>a</h1>"),
        ("https://www.prudential.com.my/elsewhere", "<h1>b</h1>")], "url string, html string")
    got = landed_products(links, pages).collect()
    assert [(r.provider_key, r.link_rank, r.html) for r in got] == [
        ("Prudential", 1, "<h1>a</h1>")]


def test_fast_path(spark, tmp_path):
    products = spark.createDataFrame([
        ("AIA", "https://www.aia.com.my/p/1", 1,
         "<h1>AIA Health Shield</h1> Annual limit: RM 1.5 million. Dental care. Clinic visit "
         "is not covered"),
        ("AIA", "https://www.aia.com.my/p/2", 2, "<h1>aia med care</h1>")],
        "provider_key string, url string, link_rank int, html string")
    providers = rules.provider_table(spark)
    plans = plan_listing.listing_plans(listing_pages(spark), products, providers)
    got = {(r.provider_name, r.plan_name): r for r in plans.collect()}
    assert {k for k in got if k[0] == "AIA Malaysia"} == {
        ("AIA Malaysia", n) for n in ("AIA Med Care", "A-Plus Health Gold",
                                      "AIA Voluntary Cover", "AIA Health Shield")}
    assert {k[1] for k in got if k[0] == "Great Eastern Life"} == {
        "SmartMedic Shield", "great protector"}
    assert {k[1] for k in got if k[0] == "Prudential Malaysia"} == {"PRUMillion Med Active"}
    shield = got["AIA Malaysia", "AIA Health Shield"]
    assert (shield.annual_limit, shield.dental_covered, shield.outpatient_covered) == (
        1.5e6, True, False)
    assert shield.website == "https://www.aia.com.my/p/1" and shield.coverage_type == "Individual"
    listed = got["AIA Malaysia", "AIA Med Care"]
    assert listed.dental_covered is None and listed.website.endswith("medical-protection.html")

    root = str(tmp_path / "plans")
    order = ("provider_name", "strategy", "rank", "pos")
    first = plan_sync.sync_stored_plans(plans, root, order, run_ts())
    assert first == {"new": 7, "updated": 0, "unchanged": 0, "errors": 0, "processed": 7,
                     "success": 7}
    second = plan_sync.sync_stored_plans(plans, root, order, run_ts())
    assert (second["unchanged"], second["success"]) == (7, 0)


def test_detailed_path(spark):
    long = "Words about the plan. " * 30
    ge = "https://www.greateasternlife.com/h/"
    pages = spark.createDataFrame([
        ("AIA", "https://www.aia.com.my/m/med-insure.html", 1,
         f"<body><h1>Home</h1><main><p>{'d' * 40}</p></main>Eligible Age: 15 days - 70 years\n"
         "<a href='/content/a.pdf'>Product brochure</a> dental</body>"),
        ("AIA", "https://www.aia.com.my/m/abc.html", 2, "<body><h1>Menu</h1></body>"),
        ("GreatEastern", ge + "1", 1, "<body><h1>Great Health Direct | x | y</h1>"
         f"<div class='product-benefits'>Pays bills</div><article><p>{long}</p></article></body>"),
        ("GreatEastern", ge + "2", 2, "<body><h1>Great Total Cover</h1></body>"),
        ("GreatEastern", ge + "3", 3, "<body><h1>GREAT TOTAL COVER</h1>"
         "<a href='x.doc'>Download</a><a href='y.PDF'>Product Summary</a></body>")],
        "provider_key string, url string, link_rank int, html string")
    named = plan_detail.named_pages(pages)
    rows = {r.url.rsplit("/", 1)[1]: r for r in named.collect()}
    assert {k: r.plan_name for k, r in rows.items()} == {
        "med-insure.html": "Med Insure", "1": "Great Health Direct", "2": "Great Total Cover",
        "3": "GREAT TOTAL COVER"}
    assert rows["med-insure.html"].brochure_url == "https://www.aia.com.my/content/a.pdf"
    assert rows["med-insure.html"].eligible_age == "15 days - 70 years"
    assert rows["med-insure.html"].description == "d" * 40
    assert rows["3"].brochure_url == "https://www.greateasternlife.com/y.PDF"

    asked = plan_detail.classification_prompts(named)
    assert asked.count() == 3
    classes = spark.createDataFrame([(ge + "2", "CRITICAL_ILLNESS"), (ge + "1", "MEDICAL")],
                                    "url string, reply string")
    accepted = plan_detail.accepted_pages(named, classes)
    # The rejected page leaves its name free for the next one.
    assert {r.url for r in accepted.collect()} == {
        "https://www.aia.com.my/m/med-insure.html", ge + "1", ge + "3"}

    providers = rules.provider_table(spark)
    brochures = spark.createDataFrame([("https://www.aia.com.my/content/a.pdf", "b" * 200)],
                                      "brochure_url string, text string")
    todo = {r.url: r.prompt for r in
            plan_detail.analysis_prompts(accepted, brochures, providers).collect()}
    # The third page names a brochure that did not land, so its page text is not used.
    assert set(todo) == {"https://www.aia.com.my/m/med-insure.html", ge + "1"}
    assert "b" * 200 in todo["https://www.aia.com.my/m/med-insure.html"]
    assert "- Provider: Great Eastern Life" in todo[ge + "1"]

    replies = inference.parse_replies(spark.createDataFrame([
        (ge + "1", json.dumps({"plan_name": "", "annual_limit": "RM 150,000", "min_age": 0,
                               "dental_covered": "no", "covered_conditions": ["a", ""],
                               "co_payment_percentage": 0})),
        ("https://www.aia.com.my/m/med-insure.html", "broken {")],
        "url string, reply string")).drop("reply")
    plans = {r.plan_name: r for r in
             plan_detail.detailed_plans(accepted, replies, providers).collect()}
    great = plans["Great Health Direct"]
    assert (great.annual_limit, great.min_age, great.dental_covered) == (150000.0, 0, False)
    assert great.covered_conditions == ["a"] and great.co_payment_percentage is None
    assert (great.provider_rank, great.plan_type, great.website) == (2, "Medical", ge + "1")
    med = plans["Med Insure"]
    assert (med.dental_covered, med.annual_limit, med.provider_rank) == (True, None, 0)


def test_union_and_report(spark):
    a = spark.createDataFrame([("1",)], "id string")
    b = spark.createDataFrame([("2", "x")], "id string, plan_name string")
    rows = plan_sync.union_providers([a, b]).orderBy("provider_rank").collect()
    assert [(r.id, r.plan_name, r.provider_rank) for r in rows] == [("1", None, 0), ("2", "x", 1)]
    empty = spark.createDataFrame([], "status string")
    assert tuple(sync_report(empty).first()) == (0, 0, 0, 0, 0, 0)


def test_plans_in_place(spark, tmp_path):
    root, path = str(tmp_path / "v"), str(tmp_path / "p")
    plans = spark.range(120).select(
        F.col("id").alias("seq"), F.md5(F.col("id").cast("string")).alias("id"),
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("provider_name"),
        F.col("id").cast("double").alias("annual_limit"), F.lit(True).alias("is_active"))
    change = plans.filter("seq < 4").withColumn("annual_limit", F.col("annual_limit") + 9)
    for batch in (plans, change):
        a = plan_sync.sync_stored_plans(batch, root, ("seq",), run_ts())
        b = plan_sync.sync_plans_in_place(batch, path, ("seq",), run_ts())
        assert a == b
    assert (b["updated"], b["new"]) == (4, 0)
    one, two = (df.select("id", "annual_limit", "is_active") for df in (
        store.read_snapshot(spark, root), store.read_folders(spark, path)))
    assert one.exceptAll(two).count() == two.exceptAll(one).count() == 0
    before, _ = store._manifest(spark, path, 2)
    active = plans.filter("seq > 5").select("id", "provider_name")
    only_a = spark.createDataFrame([("A",)], "provider_name string")
    assert plan_sync.deactivate_in_place(path, active, only_a, run_ts()) == 3
    gone = {r.id for r in store.read_folders(spark, path).filter("not is_active").collect()}
    assert gone == {r.id for r in plans.filter("seq in (0, 2, 4)").collect()}
    after, _ = store._manifest(spark, path, 2)
    assert {p for p in before if before[p] != after[p]} == {i[:2] for i in gone}
    assert plan_sync.deactivate_in_place(path, active, only_a, run_ts()) == 0


def test_an_added_provider_is_rows_alone(spark):
    page = "<div class='product-card'><h2>Nova Medical Plan</h2><a href='/product/a'>x</a></div>"
    providers = rules.provider_table(spark, [*rules.PROVIDERS, (
        "Nova", "Nova Health", "https://nova.test", "https://nova.test/all", "1", "https://nova.test")])
    table = rules.RuleTable(
        headings={**rules.HEADING_SELECTORS, "Nova": [".product-card h2"]},
        body_names={**rules.BODY_NAME_PATTERNS, "Nova": []},
        detail_links={**rules.DETAIL_LINK_RULES, "Nova": [rules.LinkRule(css=".product-card a")]})
    pages = spark.createDataFrame([("Nova", "https://nova.test/all", page)], "provider_key string, url string, html string")
    links = plan_detail.detail_links(pages, providers, table)
    assert [r.url for r in links.collect()] == ["https://nova.test/product/a"]
    landed = landed_products(links, spark.createDataFrame(
        [("https://nova.test/product/a", "<h1>Nova Medical Gold</h1>")], "url string, html string"))
    got = plan_listing.listing_plans(pages, landed, providers, table)
    assert {(r.provider_name, r.plan_name) for r in got.collect()} == {
        ("Nova Health", "Nova Medical Plan"), ("Nova Health", "Nova Medical Gold")}
    with pytest.raises(Exception, match="no base URL"):
        plan_detail.detail_links(pages, None, table).collect()


def test_rules_as_rows_read_back_as_they_were(spark, tmp_path):
    rules.rule_rows(spark).repartition(3).write.parquet(str(tmp_path / "r"))
    assert rules.read_rules(spark.read.parquet(str(tmp_path / "r"))) == rules.RuleTable()
    odd = spark.createDataFrame([("x", "no such kind", 0, "", None)], rules.RULE_COLUMNS)
    with pytest.raises(ValueError):
        rules.read_rules(odd)


def test_a_sixth_provider_by_rows_passes_both_paths(spark):
    more = [("Nova", "headings", 0, ".product-card h2", None), ("Nova", "body_names", 0, "Nova Extra [A-Z][a-z]+", None),
            ("Nova", "false_names", 0, "Nova Extra Help", '{"below": 40}'),
            ("Nova", "detail_links", 0, ".product-card a", '{"by": "css", "skip": ["/contact"], "complete": "all"}'),
            ("Nova", "titles", 0, ".name", None), ("Nova", "bar_titles", 9, None, None), ("Nova", "classified", 9, None, None),
            ("Nova", "visited", 0, None, None), ("Nova", "descriptions", 0, ".about", None),
            ("Nova", "brochures", 0, "leaflet", '{"in": "text"}'), ("Nova", "any_brochure", 9, None, None),
            ("Nova", "ages", 0, "ages ([0-9]+ to [0-9]+)", None)]
    table = rules.read_rules(rules.rule_rows(spark).union(spark.createDataFrame(more, rules.RULE_COLUMNS)))
    providers = rules.provider_table(spark, [*rules.PROVIDERS, (
        "Nova", "Nova Health", "https://nova.test", "https://nova.test/all", "1", "https://nova.test")])
    listing = ("<div class='product-card'><h2>Nova Medical Plan</h2><a href='product/a'>x</a><a href='/contact'>c</a></div>"
               "Nova Extra Care and Nova Extra Help")
    pages = spark.createDataFrame([("Nova", "https://nova.test/all", listing)], "provider_key string, url string, html string")
    links = plan_detail.detail_links(pages, providers, table)
    assert [r.url for r in links.collect()] == ["https://nova.test/product/a"]
    product = ("<h1>Home</h1><p class=name>Nova Medical Gold | Health</p><div class=about>Good <b>cover</b></div>"
               "<a href='/l/1'>The Leaflet</a> for ages 1 to 70")
    landed = landed_products(links, spark.createDataFrame([("https://nova.test/product/a", product)], "url string, html string"))
    fast = plan_listing.listing_plans(pages, landed, providers, table)
    assert {r.plan_name for r in fast.collect()} == {"Nova Medical Plan", "Nova Extra Care"}
    named = plan_detail.named_pages(landed, providers, table)
    row = named.first()
    assert (row.plan_name, row.description, row.brochure_url, row.eligible_age) == (
        "Nova Medical Gold", "Good cover", "https://nova.test/l/1", "1 to 70")
    assert plan_detail.classification_prompts(named, table).count() == 1
    replies = spark.createDataFrame([("https://nova.test/product/a", "MEDICAL")], "url string, reply string")
    assert plan_detail.accepted_pages(named, replies, table).count() == 1


def test_parts_cover_a_document_and_borders_are_whole(spark):
    texts = ["", None, "a", "abcdefgh", "abcdefghi", "".join(chr(0x4E00 + k) for k in range(100))]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, part string")
    parts = inference.document_parts(docs, part_chars=8, overlap=3).collect()
    for k, t in enumerate(texts):
        own = sorted((r.part, r.text) for r in parts if r.doc_id == k)
        assert {r.n_parts for r in parts if r.doc_id == k} == {len(own)} and [p for p, _ in own] == list(range(len(own)))
        if not t:
            assert own == [(0, t)]
            continue
        assert own[0][1] + "".join(p[3:] for _, p in own[1:]) == t and all(0 < len(p) <= 8 for _, p in own)
        assert all(any(t[i:i + 4] in p for _, p in own) for i in range(len(t) - 3))
    with pytest.raises(ValueError):
        inference.document_parts(docs, part_chars=3, overlap=3)


def test_folded_replies_in_any_order(spark):
    replies = [(1, 2, '{"plan_name": "Late", "annual_limit": 5, "dental_covered": true, "covered_conditions": ["b", "a"]}'),
               (1, 0, '{"plan_name": "", "min_age": 0, "dental_covered": false, "maternity_covered": "no"}'),
               (1, 1, '{"plan_name": "First", "covered_conditions": ["a", "c"], "min_age": 7}'),
               (1, 1, '{"plan_name": "First"}'), (2, 0, "no json"), (3, 0, '{"covered_conditions": []}'),
               (None, 0, '{"plan_name": "x"}')]
    want = {1: (4, "First", 5.0, 0, True, False, ["a", "c", "b"]), 2: (1, None, None, None, None, None, None),
            3: (1, None, None, None, None, None, [])}
    for rows in (replies, replies[::-1]):
        parsed = inference.parse_replies(spark.createDataFrame(rows, "doc_id long, part int, reply string").repartition(3))
        got = {r.doc_id: (r.n_replies, r.plan_name, r.annual_limit, r.min_age, r.dental_covered, r.maternity_covered,
                          r.covered_conditions) for r in inference.fold_replies(parsed).collect()}
        assert got == want
    assert inference.fold_replies(parsed.limit(0)).count() == 0
