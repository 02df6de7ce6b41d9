"""Row-wise operators: language, toxicity, URL rules, main text, quality."""

import math
import re
import zlib
from collections import Counter
from random import Random

import numpy as np
import pytest
from pyspark.sql import functions as F

from landsync.llm import extract, language, quality, toxicity, url_rules
from landsync.llm.dom import Page
from landsync.llm.layouts import MARK, Layout
from landsync.llm.trees import boost

EN = "the house and the garden with that water when they were thinking about this weather"
DE = "das haus und der garten mit dem wasser wenn sie nicht über das wetter nachgedacht haben"
DOCS = "doc_id long, text string, lang string, source string, row string, kept string, lang_pred string"


def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeats, and columns with clashing names."""
    rows = [(1, EN, "en", "a", "x", "y", "z"), (1, EN, "en", "a", "x", "y", "z"), (2, DE, "de", None, None, None, None),
            (3, None, None, None, None, None, None), (4, "", "en", "a", "x", "y", "z"), (None, EN, "en", "b", "", "", ""),
            (5, (EN + "\n") * 3000, "en", "a", "x", "y", "z"), (6, "12 34 !!", "de", "a", "x", "y", "z"), (7, "a", None, "", "", "", "")]
    return spark.createDataFrame(rows, DOCS)


def test_language(spark):
    docs = odd_docs(spark)
    learned = language.language_dictionaries(docs)
    assert sorted(learned) == ["de", "en"]
    got = [(r.doc_id, r.lang_pred, r.lang_accepted, r.lang_score) for r in language.identify(docs, learned).collect()]
    by = {g[0]: g[1:] for g in got}
    assert len(got) == 9 and by[1][:2] == ("en", True) and by[2][:2] == ("de", True) and by[5][0] == "en"
    assert by[3] == by[4] == by[6] == ("und", False, 0.0)
    assert all(0 <= g[3] <= 1 for g in got)
    assert language.identify(docs, {}).where("lang_pred <> 'und'").count() == 0
    assert language.identify(docs.limit(0), learned).count() == 0
    for text in ("½ ²", "①②", "Ⅷ", "12 _ !", "", None):
        assert language.Classifier(learned).classify(text) == ("und", 0.0, False)
    assert language.Classifier(learned).classify("½ ab")[0] != "und"
    assert language.language_dictionaries(docs.limit(0)) == {}


def test_language_is_smallest_output():
    judge = language.Classifier({"de": DE.encode(), "en": EN.encode()})
    assert judge.classify(EN)[0] == "en" and judge.classify(DE)[0] == "de"
    assert language.Classifier({"en": EN.encode()}).classify("word")[1:] == (1.0, True)
    same = language.Classifier({"a": EN.encode(), "b": EN.encode()}).classify(EN)
    assert same == ("a", 0.0, False)


def test_fold():
    assert toxicity.fold("1d10t") == "idiot" and toxicity.fold("Тr@sh!!") == "trash  "
    assert toxicity.fold("108.51 $5 abc") == "108.51 $5 abc"
    assert toxicity.fold(None) == ""


def test_toxicity_hits():
    lex = toxicity.Lexicon((("idiot$", 5.0), ("low", 3.0)), ("idiot proof",), 1.0, -2.0)
    m = toxicity.Matcher(lex)
    assert m.strength("an idiot here") == pytest.approx(5 / 3 ** toxicity.LENGTH_POWER)
    assert m.strength("an idiotic thing") == 0 and m.strength("lowly slow") == pytest.approx(3 / 2 ** toxicity.LENGTH_POWER)
    assert m.strength("it is idiot proof") == 0 and m.strength("idiot proof idiot") > 0
    assert m.strength(None) == m.strength("") == 0 and 0 < m.score("") < 0.5 < m.score("idiot")
    assert toxicity.Matcher(toxicity.Lexicon(())).score("idiot") == 0


def test_toxicity_learns_words_and_stems(spark):
    rng = Random(1)
    rows = []
    for i in range(300):
        words = [rng.choice("alpha beta gamma delta house river".split()) for _ in range(30)]
        if i % 5 == 0:
            words[3:6] = ["vermin", "schlimm" + rng.choice(["en", "es", "er"]), "b4d0ne"]
        rows.append((i, " ".join(words), 1 if i % 5 == 0 else 0))
    docs = spark.createDataFrame([*rows, (999, None, 0), (1000, "x", None)], "doc_id long, text string, toxic int")
    lex = toxicity.learn(docs)
    assert {w for w, _ in lex.weights} == {"vermin$", "schlimme", "badone$"}
    got = {r.doc_id: r.score for r in toxicity.strengths(docs, lex, "text", "doc_id").collect()}
    assert all((got[i] >= toxicity.TOXIC_FROM) == (t == 1) for i, _, t in rows)
    labels = docs.select("doc_id", "toxic").union(docs.select("doc_id", "toxic"))
    assert toxicity.learn(toxicity.labelled_texts(docs.drop("toxic"), labels)) == lex
    assert not toxicity.learn(docs.where("toxic = 0")).weights and not toxicity.learn(docs.limit(0)).weights


def test_url_rules_against_all_rules(spark):
    urls = ["https://www.example.com/en/1", "http://sub.example.com/en/", "http://a.example.com/fr/?x=/en/", "http://x.net/es/1",
            "http://EXAMPLE.com", "http://notexample.com/en/", "https://m.casino-win.org/en", "https://free-bets.org", None, "",
            "no scheme", "ftp://a.b/login#x", "http://u.org/a?casino=1", "http://best-bets.org/casino-/", "https://adult.io/x",
            "http://x.org/\ncart/", "http://x.net/ES/1", "http://a.com:80/x"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate([*urls, *urls])], "page_id long, url string, rule string")
    got = {}
    for r in url_rules.judge_urls(pages).collect():
        got.setdefault(r.url, set()).add((r.host, r.path, r.rule, r.verdict, tuple(r.patterns)))
    for u, found in got.items():
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (m[1].translate({i: i + 32 for i in range(65, 91)}), m[2]) if m else ("", "")
        fits = [r for r in url_rules.SITE_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        hits = tuple(sorted(r.name for r in url_rules.PATTERN_RULES if re.search(r.pattern, (u or "").lower())))
        assert found == {(host, path, best and best.name, best.verdict if best else "block" if hits else "allow", hits)}, u
    assert url_rules.judge_urls(pages.limit(0)).count() == 0
    assert {r.verdict for r in url_rules.judge_urls(pages, pattern_rules=(), site_rules=()).collect()} == {"allow"}
    with pytest.raises(ValueError):
        url_rules.judge_urls(pages, pattern_rules=(url_rules.PatternRule("x", "block", "x", ()),))


def test_url_rules_are_filed_under_their_rarest_token(spark):
    pages = spark.createDataFrame([("http://casino.org/win",), ("http://a.org/win",)], "url string")
    filed = {r.name: r.token for r in url_rules.filed_rules(pages, "url", url_rules.PATTERN_RULES).collect()}
    assert filed["casino-win"] == "casino" and filed["cheap-pills"] == "cheap"


def test_page_tree():
    page = Page("<head><title>t</title></head><body><nav><a href=x>menu</a></nav><!-- c --><p>One &amp; <b>two<br>three"
                "<p>four</b><ul><li>a<li>b</ul><script>if (a<b) x='</p>'</script> tail <div class=\"ad 'x\">q")
    assert [t for t in page.text if t] == ["menu", "One & two three", "four", "a", "b", "tail", "q"]
    assert Page(None).text == Page("").text == [""]
    assert [t for t in Page("a < b <3 </div></p></b><p").text if t] == ["a < b <3", "<p"]


def test_decoding_is_consistent():
    page = Page("<div><p>a</p><p>b</p></div><nav>c</nav>")
    odds = np.array([5 if t == "#root" else 4 if t == "p" else -1 if t == "div" else -9 if t == "nav" else 2 for t in page.tag], float)
    assert page.decode(odds) == ["a", "b"]  # the container is kept for what it holds
    odds[[k for k, t in enumerate(page.tag) if t == "div"]] = -30
    assert page.decode(odds) == []
    odds = np.array([5 if t in ("#root", "p") else -1 if x == "a" else -9 for t, x in zip(page.tag, page.text)], float)
    odds[1] = 9
    assert page.decode(odds) == ["a"]  # a kept paragraph keeps its text


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    forest = boost(x[:2000], y[:2000], np.ones(2000), trees=30)
    assert ((forest.log_odds(x[2000:]) > 0) == (y[2000:] > 0)).mean() > 0.97


def _pages(spark, n=60):
    rng = Random(3)
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9)))
    texts = [[" ".join(word() for _ in range(rng.randint(8, 60))) + "." for _ in range(rng.randint(2, 8))] for _ in range(n)]
    html = ["<html><body><nav><ul>" + "".join(f"<li><a href='/'>{word()}</a></li>" for _ in range(6)) + "</ul></nav><div class='ad'>"
            + word() + "</div><article>" + "".join(f"<p>{b}</p>" for b in t) + f"</article><footer>&copy; {word()}</footer></body></html>"
            for t in texts]
    return texts, html, spark.createDataFrame([(k, f"u{k}", h, "old") for k, h in enumerate(html)],
                                              "page_id long, url string, html string, text string")


def test_main_text(spark):
    texts, html, pages = _pages(spark)
    model = extract.learn(pages)
    odd = spark.createDataFrame([(-1, None, None, None), (-2, "", "", ""), (None, "", "<nav><a>x</a></nav>", "")], pages.schema)
    got = {r.page_id: r.text for r in extract.main_text(pages.union(odd).union(pages.limit(1)), model).collect()}
    assert all(got[k] == "\n".join(t) for k, t in enumerate(texts))
    assert got[-1] == got[-2] == got[None] == ""
    assert extract.main_text(pages.limit(0), model).count() == 0
    assert extract.learn(pages.limit(0)).texts(["<p>a</p><p>b</p>"]) == ["a\nb"]


def test_main_text_of_unseen_layouts(spark):
    texts, html, _ = _pages(spark, 120)
    model = extract.train(html[:60])
    rng, right, found, wanted = Random(9), 0, 0, 0
    for t in texts[60:]:
        got = Counter(model.texts([Layout(rng, t, [b for x in texts for b in x]).page().replace(MARK, "")])[0].split("\n"))
        want = Counter(t)
        right += sum((got & want).values())
        found += sum(got.values())
        wanted += sum(want.values())
    assert right / found > 0.9 and right / wanted > 0.9


def counts_of(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = list(zip(w, w[1:], w[2:]))
    many = Counter(grams)
    covered = {k + d for k, g in enumerate(grams) if many[g] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed)


def test_quality_counts(spark):
    texts = [None, "", " \n\t", "a b c a b c x a b c", "a a a a a", "x\ny\nx\n\n\nx y", "é|| <b> $5\r\nü\x0b\x0cö x", "a b a b a b c",
             "\n".join(["same line of words"] * 40), " ".join(f"w{k}" for k in range(70)), "w " * 20_000]
    docs = spark.createDataFrame([(k, t, None, None, "n") for k, t in enumerate([*texts, *texts])],
                                 "doc_id long, text string, lang string, source string, n_words string")
    rows = quality.judge(docs).collect()
    assert len(rows) == 2 * len(texts)
    for r in rows:
        want = counts_of(texts[r.doc_id % len(texts)])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want, r.doc_id
        assert not (r.base_failed and r.kept)
    assert quality.judge(docs.limit(0)).count() == 0


def brute_estimate(x):
    """The same starts and C-steps over plain arrays."""
    floors = np.array(list(quality.FLOORS.values()))
    quantile = lambda q: np.array([np.sort(c)[max(0, math.ceil(len(c) * q) - 1)] for c in x.T])

    def moments(near):
        mean = near.mean(axis=0)
        return mean, quality.CONSISTENT * (near.T @ near / len(near) - np.outer(mean, mean)) + np.diag(floors ** 2)

    wide = np.maximum(floors, (quantile(0.75) - quantile(0.25)) / quality.QUARTILES)
    best = math.inf, None, None
    for mean, cov in ((quantile(0.5), np.diag(floors ** 2)), (quantile(0.5), np.diag(wide ** 2)), moments(x)):
        least = math.inf
        while True:
            away = x - mean
            bins = np.floor(np.log2(1 + np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away)) * quality.BINS)
            step = moments(x[bins <= np.sort(bins)[math.ceil(quality.HALF * len(x)) - 1]])
            log_det = np.linalg.slogdet(step[1])[1]
            if log_det >= least - quality.FALL:
                break
            (mean, cov), least = step, log_det
        best = min(best, (least, mean, cov), key=lambda b: b[0])
    mean, inverse = best[1], np.linalg.inv(best[2])
    return lambda y: np.sqrt(np.einsum("ij,jk,ik->i", y - mean, inverse, y - mean))


def test_quality_estimates(spark):
    rng = Random(5)
    rows = []
    for k in range(400):
        source = "a" if k % 3 else "b" if k % 2 else f"rare{k % 40}"
        words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(60, 200))]
        if k % 11 == 0:
            words = [w + "###$$$" for w in words]
        rows.append((k, " ".join(words), "en" if k % 5 else "de", source))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert all(got[k].kept == bool(k % 11) for k in range(400))
    good = [got[k] for k in range(400) if not got[k].base_failed]
    vector = lambda rs: np.array([[r[n] for n in quality.FLOORS] for r in rs])
    sizes = Counter((r.lang, r.source) for r in good)
    langs = Counter(r.lang for r in good)
    for group in sizes:
        own = [r for r in good if (r.lang, r.source) == group]
        pool = own if sizes[group] >= quality.LEAST else [r for r in good if r.lang == group[0]] if langs[
            group[0]] >= quality.LEAST else good
        assert np.allclose([r.distance for r in own], brute_estimate(vector(pool))(vector(own)), rtol=1e-3), group


def test_chi_square():
    assert quality.CUT == pytest.approx(20.515, rel=0.02)
    assert quality._chi2_share(11.0705, 5) == pytest.approx(0.95, abs=1e-4)


def test_remainders(spark):
    ids = spark.range(50).select(F.col("id").alias("doc_id"))
    held = {r.doc_id for r in ids.where(language.is_held_out()).collect()}
    assert held == {i for i in range(50) if zlib.crc32(str(i).encode()) % 4 == 2}
