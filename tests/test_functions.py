"""Golden values of the column expressions."""

import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from landsync.functions import html as H
from landsync.functions import text as X
from landsync.operators.extract import coverage_flags, eligible_age, limit_texts
from landsync.operators.filters import is_medical, is_medical_by_name, is_plan_name


def values(spark, rows, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {kind}")
    return [r.out for r in df.select("i", expr(F.col("v")).alias("out")).orderBy("i").collect()]


def test_money(spark):
    got = values(spark, ["RM 1,000", "1.5 million", "RM500/day", "", ",", None, "1e3", "12d",
                         "0x1p3", "RM 1 million", "$ 2,5", "1_000", "5 000"], X.parse_money)
    assert got == [1000.0, 1500000.0, None, None, None, None, 1000.0, None, None, 1e6, 25.0,
                   1000.0, 5000.0]


def test_reply_money(spark):
    got = values(spark, ["RM 1 million", "1.2.3", "RM 500", "none", "."], X.parse_reply_money)
    assert got == [1.0, None, 500.0, None, None]


def test_percent_and_int(spark):
    assert values(spark, ["10% co-pay", "none", "7.5 to 10"], X.parse_percentage) == [10.0, None, 7.5]
    assert values(spark, ["15 days", "n/a", "99999999999"], X.parse_int) == [15, None, None]


def test_rating_and_reviews(spark):
    assert values(spark, ["4,9", "new", "", "5. stars"], X.parse_rating) == [4.9, None, None, 5.0]
    assert values(spark, ["(1,287)", "no", "1 234 reviews"], X.parse_review_count) == [1287, None, 1234]


def test_coordinates(spark):
    got = values(spark, ["https://x/@3.1,101.6,17z", "https://x/@95.0,10.0!3d3.2!4d101.7", "none",
                         "!3d-3!4d181"], X.coordinates)
    assert [tuple(r) for r in got] == [(3.1, 101.6), (3.2, 101.7), (None, None), (None, None)]


def test_place_id(spark):
    got = values(spark, ["!1s0x31cc:0xab9!x", "q=ChIJabc_-9&x", "place_id=zz-1", "no",
                         "ChIJq!1s0xa:0xb"], X.place_id)
    # the hex form ends before the second x
    assert got == ["0x31cc:0", "ChIJabc_-9", "zz-1", None, "0xa:0"]


def test_phone(spark):
    got = values(spark, ["phone:tel:+603-1234", "abc", "", None, "Phone: (03) 12 x"], X.clean_phone)
    assert got == ["+603-1234", None, None, None, "(03) 12 "]


def test_pick_phone(spark):
    df = spark.createDataFrame([
        (1, None, "Phone: 03-1234 5678", [], []),
        (2, "phone:tel:0123", "Phone: 03-1234 5678", [], []),
        (3, None, None, ["Copy", "call 12"], ["03-1234 5678"]),
        (4, None, None, ["Copy"], ["x", " 03-1234 5678 "]),
        (5, None, None, None, None),
    ], "i int, a string, l string, t array<string>, p array<string>")
    got = [r.o for r in df.select("i", X.pick_phone("a", "l", "t", "p").alias("o"))
           .orderBy("i").collect()]
    assert got[0].strip() == "03-1234 5678"
    assert got[1:] == ["0123", " 12", "03-1234 5678", None]


def test_hours_and_services(spark):
    df = spark.createDataFrame([
        (1, [["", "x"], ["Mon\t9-5", "Tue"], ["Sun closed"]], "label of the hours"),
        (2, [[]], "open all day long"), (3, [[]], "short"),
    ], "i int, g array<array<string>>, l string")
    rows = df.select("i", X.pick_hours("g", "l").alias("h")).orderBy("i").collect()
    assert rows[0].h.weekday_text == ["Mon 9-5"]
    assert rows[1].h.weekday_text == ["open all day long"]
    assert rows[2].h is None
    df = spark.createDataFrame([
        (1, [["abc"], [" abcd ", "abcd", "efgh"] + [f"item {k}" for k in range(20)]]),
        (2, [["a"]])], "i int, g array<array<string>>")
    rows = df.select("i", X.pick_services("g").alias("s")).orderBy("i").collect()
    assert rows[0].s == ["abcd", "efgh"] + [f"item {k}" for k in range(20)]
    assert rows[1].s is None
    df = spark.createDataFrame([(["", "x" * 100, "Clinic", "Other"],), ([],)], "c array<string>")
    assert [r.s for r in df.select(X.pick_specialties("c").alias("s")).collect()] == [["Clinic"], None]


def test_id(spark):
    df = spark.createDataFrame([
        (" Klinik A ", "JALAN 1"), ("klinik a", "jalan 1"), (" Klinik A ", "jalan 1"),
        (None, "x")], "a string, b string")
    got = [r.i for r in df.select(X.deterministic_id("a", "b").alias("i")).collect()]
    h = hashlib.sha256(b"klinik a|jalan 1").hexdigest()
    want = f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:32]}"
    assert got == [want, want, want, None]


def test_plan_names(spark):
    got = values(spark, ["Med", "AIA Med", "Plan Ten", "Read More Now", "1 Medical Plan X",
                         "Family Care Gold", "PRUMillion", None, "x" * 81, "A1-----------",
                         "Smart Plan"], is_plan_name)
    assert got == [False, True, False, False, False, True, True, False, False, False, True]


def test_classification(spark):
    assert values(spark, ["MEDICAL", "critical_illness", None, " medical ", "other"], is_medical) == [
        True, False, True, True, False]
    assert values(spark, ["Great Critical Care", "MediCard", "Foo"], is_medical_by_name) == [
        False, True, True]


def test_flags(spark):
    assert values(spark, ["Klinik 24 jam", "24JAM x", "Klinik"], X.is_open_24_hours) == [
        True, True, False]
    assert values(spark, ["Open 24 Hours", "EMERGENCY", "x"], X.emergency_flag) == [
        True, True, None]


PAGE = """<html><head><title>T</title><script>var a="<h2>no</h2>";</script></head><body>
<div class="product-card big"><div class="img"></div><h2>Alpha &amp; One</h2><a href="/p/one.html">x</a></div>
<div class="product-card"><h2 class="title">Beta <b>Two</b></h2><h3>Sub</h3></div></main>
<article class='x'><h2>Gamma</h2></article><h2>Delta</h2>
<a href="https://x.y/health/a"><span>Health A</span></a>
<div data-product="1"><h3>Eps</h3></div>
<a class="d" href="files/b.pdf">Download Brochure</a></body></html>"""


@pytest.mark.parametrize("css,want", [
    (".product-card h2", ["Alpha & One", "Beta Two"]),
    (".product-card .title", ["Beta Two"]),
    ("article h2", ["Gamma"]),
    ("h2.title", ["Beta Two"]),
    ("[class*='product'] h3", ["Sub"]),
    ("a[href*='health'] span", ["Health A"]),
    ("[data-product] h3", ["Eps"]),
    (".card h3", []),
])
def test_selectors(spark, css, want):
    assert values(spark, [PAGE], lambda c: H.all_texts(c, css)) == [want]


def test_elements_as_intervals(spark):
    cases = {
        "<div class=c>a<div class=c>b</div>c</div>d<div class=c>e": ["abc", "b", "e"],
        "</div></div><div class=c>x<div>y</div>z</div></div><p class=c>p<b>q</b></p>t": ["xyz", "pq"],
        "<DIV class='c d'>x<br>y</DIV></div><my-card class=c>k</my-card>l": ["xy", "k"],
        "<div class=c>open <span class=c>in</span> <div class=c>late</div>": ["open", "in", "late"],
        "<p>none</p>": [],
    }
    got = values(spark, list(cases), lambda c: H.all_texts(c, ".c"))
    assert got == list(cases.values())
    assert values(spark, list(cases), lambda c: H.first_text(c, ".c")) == [v[0] if v else None for v in cases.values()]


def test_deeply_nested_elements_take_no_longer_than_flat_ones(spark):
    n = 20_000
    page = "<div>x" * n + "<div class=c>hit<i>y</i></div>" + "</div>" * n
    begun = time.perf_counter()
    assert values(spark, [page], lambda c: H.all_texts(c, ".c")) == [["hity"]]
    deep = "<div class=c>a" * n + "</div>" * n
    assert values(spark, [deep], lambda c: F.length(H.first_text(c, ".c"))) == [n]
    assert time.perf_counter() - begun < 60  # the square of the tags would take many minutes


def test_extent_of_elements(spark):
    card = ("<div class='product-card'><div><div>x</div></div><h2>In</h2></div>"
            "<div class='other'><h2>Customer Stories Galore</h2></div>")
    assert values(spark, [card], lambda c: H.all_texts(c, ".product-card h2")) == [["In"]]
    nested = ("<div class='product-description'><div>First part.</div> <div>Second part.</div></div> after"
              "<ul class='benefits'>a<ul class='benefit-list'><li>b</li></ul>c</ul>")
    assert values(spark, [nested], lambda c: H.first_text(c, ".product-description")) == [
        "First part. Second part."]
    assert values(spark, [nested], lambda c: H.first_text(c, "[class*='benefit']")) == ["abc"]
    bare = "<!-- <h2>no</h2> --><script>'<h2>no</h2>'</script><div class=product-card><h2>Yes</h2></div>"
    assert values(spark, [bare], lambda c: H.all_texts(H.markup(c), ".product-card h2")) == [["Yes"]]
    assert values(spark, [bare], lambda c: H.all_texts(H.markup(c), "h2")) == [["Yes"]]
    link = "<a href=/p/health class=x>A</a>"
    assert values(spark, [link], lambda c: H.all_hrefs(c, "a[href*='health']")) == [["/p/health"]]


def test_unescape(spark):
    assert values(spark, ["Caf&eacute; &#8211;&#x41;&rsquo;&amp;lt; & &bogus; &amp", "plain", None], H.unescape) == [
        "Caf\u00e9 \u2013A\u2019&lt; & &bogus; &amp", "plain", None]


def test_long_digits(spark):
    digits = "1" * 1_000_000
    assert values(spark, [digits, "RM " + digits, digits + "x"], X.parse_money) == [float("inf"), float("inf"), None]
    assert values(spark, ["4." + digits], X.parse_rating)[0] > 4
    assert values(spark, ["1_000", "_1", "1__0", "1_", "1e1_0", "1_000.5"], X.to_double) == [
        1000.0, None, None, None, 1e10, 1000.5]


def test_hrefs_and_text(spark):
    assert values(spark, [PAGE], lambda c: H.all_hrefs(c, ".product-card a")) == [["/p/one.html"]]
    assert values(spark, [PAGE], lambda c: H.all_hrefs(c, "a[href*='health']")) == [
        ["https://x.y/health/a"]]
    assert values(spark, [PAGE], lambda c: H.all_hrefs(c, "a[href$='.pdf']")) == [["files/b.pdf"]]
    text = values(spark, [PAGE], H.body_text)[0]
    assert "no" not in text.split() and text.startswith("Alpha & One\n")
    links = values(spark, [PAGE], H.anchors)[0]
    assert (links[-1].href, links[-1].text) == ("files/b.pdf", "Download Brochure")
    got = values(spark, ["/a", "b", "http://c"], lambda c: H.absolute(c, "https://h"))
    assert got == ["https://h/a", "https://h/b", "http://c"]


def test_unclosed_tags(spark):
    page = "<h2>One<h2>Two</h2><a href='/1'>x<a href='/2'>y</a><p>first<p>second</div>z"
    assert values(spark, [page], lambda c: H.all_texts(c, "h2")) == [["One", "Two"]]
    assert values(spark, [page], lambda c: H.all_texts(c, "p")) == [["first", "second"]]
    links = values(spark, [page], H.anchors)[0]
    assert [(a.href, a.text) for a in links] == [("/1", "x"), ("/2", "y")]


def test_large_page_with_unclosed_tags(spark):
    """Three megabytes of tags that never close take no time to speak of."""
    df = spark.range(1).select(F.concat(
        F.repeat(F.lit("<a href='/x'>t <h2>"), 100_000), F.repeat(F.lit("word "), 200_000))
        .alias("v"))
    start = time.time()
    row = df.select(F.size(H.anchors("v")).alias("a"), F.size(H.all_texts("v", "h2")).alias("h"),
                    F.length(H.body_text("v")).alias("n")).first()
    assert row.a == 100_000 and row.h >= 1 and row.n > 1_000_000
    assert time.time() - start < 60


def test_trim_agrees_with_python(spark):
    """Every character of the basic plane that Python strips goes, and no other."""
    chars = [chr(c) for c in range(1, 0x10000) if not 0xD800 <= c <= 0xDFFF]
    texts = [f"{c}a{c}b{c}" for c in chars]
    df = spark.createDataFrame(list(zip(chars, texts)), "c string, v string")
    got = {r.c: r.t for r in df.select("c", X.utrim("v").alias("t")).collect()}
    assert [c for c, v in zip(chars, texts) if got[c] != v.strip()] == []


def test_numbers_agree_with_python(spark):
    rng = random.Random(7)
    pieces = ["0", "7", "12", ".", ",", "+", "-", "e", "E5", "_", "d", "f", "nan", "inf", "x"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 5))) for _ in range(3000)]

    def number(v):
        try:
            return float(v)
        except ValueError:
            return None

    got = values(spark, texts, X.to_double)
    want = [number(t) for t in texts]
    differ = [(t, g, w) for t, g, w in zip(texts, got, want) if repr(g) != repr(w)]
    # A sign on nan has no effect, but Spark reads no sign there.
    assert [d for d in differ if "nan" not in d[0]] == []


def test_first_text(spark):
    page = ("<article><h1>T</h1></article><article><p></p><p>second</p></article>"
            "<div class='Lead'>no</div><DIV CLASS='lead x'>yes</DIV>")
    for css, want in (("article p", None), ("article h1", "T"), (".lead", "yes"),
                      ("h1", "T"), ("main p", None)):
        assert values(spark, [page, None], lambda c: H.first_text(c, css)) == [want, None]


def test_coverage(spark):
    texts = ["outpatient not covered", "clinic visit not covered", "none", "eyelets", "an eye."]

    def flag(name, **options):
        return values(spark, texts, lambda c: coverage_flags(c, **options)[name])

    assert flag("outpatient_covered") == [True, False, None, None, None]
    assert flag("optical_covered") == [None, None, None, True, True]
    assert flag("optical_covered", whole_words=True) == [None, None, None, None, True]


def test_limits_and_ages(spark):
    got = values(spark, ["annual limit: rm 1.5 million", "yearly limit: 5 annual limit: 7",
                         "per year\u00a0rm 9,000", "nothing"],
                 lambda c: limit_texts(c)["annual_limit"])
    assert got == ["1.5 million", "7", "9,000", None]
    rooms = values(spark, ["room & board: rm 250", "room board 9", "daily room: 80."],
                   lambda c: limit_texts(c)["room_board_limit"])
    assert rooms == ["250", "9", "80."]
    df = spark.createDataFrame([
        ("AIA", "Entry Age: 1\nEligible age: 15 days - 70 years \n"),
        ("AIA", "from 15 days – 70 years old"), ("Etiqa", "Age: 18 to 60. More"),
        ("Allianz", "no"), ("Else", "Entry age: 5")], "provider_key string, text string")
    got = [r.a for r in df.select(eligible_age().alias("a")).collect()]
    assert got == ["15 days - 70 years", "15 days – 70 years old", "18 to 60", None, None]
