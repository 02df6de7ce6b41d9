"""Spelling variants against brute force over all words."""

import re
import zlib
from collections import Counter
from random import Random

import pytest

from landsync.llm import spelling as s

SCHEMA = "doc_id long, text string, word string, n long, gram string, p int"


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plainly(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 6 and k >= 5}
    near = {w: [v for v in n if v != w and one_edit(v, w)] for w in n}
    form = {w: min(near[w], key=lambda v: (-n[v], v)) for w in n if near[w]}
    form = {w: v for w, v in form.items() if n[v] >= 5 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {w: (form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n}


def texts(seed=0):
    """Chains of variants whose counts fall by five or more, ties, and words that only their ends tell apart."""
    rng, words = Random(seed), []
    for _ in range(14):
        word = "".join(rng.choice("abcdeé") for _ in range(rng.randint(6, 12)))
        for n in (220, 36, 36, 6, 5, 4):
            words += [word] * n
            at = rng.randrange(len(word) + 1)
            word = rng.choice([word[:at] + "é" + word[at:], word[:at] + "b" + word[at + 1:], word[:at] + word[at + 1:]])
    words += [f"prefix{c}tail" for c in "abcdefghijklmnop" for _ in range(5)] + ["ab" * 3000] * 5 + ["ab" * 2999 + "a"] * 5
    rng.shuffle(words)
    size = len(words) // 300 + 1
    found = [rng.choice([" ", ", ", "×1-"]).join(words[i:i + size]) for i in range(0, len(words), size)]
    return [(i, t.upper() if i % 5 == 0 and t.isascii() else t) for i, t in enumerate(found)]


def rows_of(seed=0):
    return [(k, t, "x", 1, "y", 2) for k, t in texts(seed)] + [
        (None, None, None, None, None, None), (None, "letters " * 7 + "Letterz " * 40, "", 0, "", 0), (3, "", "", 0, "", 0)]


def found(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


@pytest.mark.parametrize("hot, fit", [(64, {}), (2, {"extended": 1 << 30, "kept": 2}), (2, {"longest": 6, "kept": 1, "sampled": 40})])
def test_variants_equal_brute_force(spark, hot, fit):
    rows = rows_of()
    got = found(s.spelling_variants(spark.createDataFrame(rows, SCHEMA), hot=hot, **fit))
    want = plainly(rows)
    assert got == want and sum(x[0] is not None for x in want.values()) > 10 and any(
        x[0] and x[1] != x[0] for x in want.values())


def test_no_words(spark):
    assert s.spelling_variants(spark.createDataFrame([(1, "a bc", "", 0, "", 0), (2, None, "", 0, "", 0)], SCHEMA)).collect() == []
    assert s.spelling_variants(spark.createDataFrame([], SCHEMA)).collect() == []


def placed(word, grams):
    return {(g, p, len(word) - p - len(g)) for g, p in grams}


def shared(a, b, grams_a, grams_b):
    """Grams of both words at places that one edit can bring together."""
    if len(a) > len(b):
        a, b, grams_a, grams_b = b, a, grams_b, grams_a
    one, two = placed(a, grams_a), placed(b, grams_b)
    if len(a) == len(b):
        return len(one & two)
    return len({x for x in one if (x[0], x[1] + 1, x[2]) in two or (x[0], x[1], x[2] + 1) in two})


@pytest.mark.parametrize("seed", range(6))
def test_no_edit_affects_more_grams_than_the_bound(seed):
    rng = Random(seed)
    letters = "abc" if seed % 2 else "ab"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(6, 11)))
    frequency = {}
    for _ in range(60):
        w = word()
        for q in range(2, 6):
            for p in range(len(w) - q + 1):
                frequency[w[p:p + q]] = rng.choice([1, 5, 50])
    grams = s.Dictionary.of(frequency, 4)
    for _ in range(60):
        w = word()
        own = grams.decompose(w)
        spared = len(own) - grams.affected(w, own)
        edits = {w[:i] + c + w[i + k:] for i in range(len(w) + 1) for c in [*letters, ""] for k in (0, 1)} - {w}
        for other in edits:
            if one_edit(w, other):
                assert shared(w, other, own, grams.decompose(other)) >= spared
                if len(other) >= 6:  # they meet in a list
                    marked = [placed(x, [(g.lstrip(s.WEAK), p) for g, p in grams.filed(x) if g[0] != s.WEAK]) for x in (w, other)]
                    weak = [[(g[1:], p) for g, p in grams.filed(x) if g[0] == s.WEAK] for x in (w, other)]
                    strong = shared(w, other, [(g, p) for g, p, _ in marked[0]], [(g, p) for g, p, _ in marked[1]])
                    assert strong or shared(w, other, *weak)
