"""Main text: parts inside an article, pages without one, stray quotes, and time on nested or broken markup."""

import time
from random import Random

from landsync.llm import extract
from landsync.llm.dom import Page


def sentence(rng, n=22):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n)).capitalize() + "."


def made(wrap, seed, n=60):
    """(html, main text) of pages with menu, advert, comments and footer, the article within ``wrap``."""
    rng, out = Random(seed), []
    for _ in range(n):
        blocks = [sentence(rng) for _ in range(rng.randint(3, 7))]
        said = "".join(f"<div class=comment><p>{sentence(rng, 6)}</p></div>" for _ in range(3))
        body = "".join(f"<p>{b}</p>" for b in blocks[:2]) + f"<div class=ad>Buy {sentence(rng, 5)}</div>"
        body += "".join(f"<p>{b}</p>" for b in blocks[2:]) + f"<section class=comments><h3>Comments</h3>{said}</section>"
        top = "<nav><ul><li><a href=/>Home</a><li><a href=/a>About</a><li><a href=/c>Contact</a></ul></nav>"
        out.append((f"<html><body>{top}<{wrap}>{body}</{wrap.split()[0]}><footer>Copyright 2026 by us</footer></body></html>",
                    "\n".join(blocks)))
    return out


def test_adverts_and_comments_inside_an_article_go():
    pages = made("article", 1)
    model = extract.train([h for h, _ in pages[:50]])
    right = sum(got == want for got, (_, want) in zip(model.texts([h for h, _ in pages]), pages))
    assert right >= 54


def test_pages_without_an_article_train_a_model():
    pages = made("div class=content", 2)
    model = extract.train([h for h, _ in pages[:50]])
    assert model.forest is not None
    found = model.texts([h for h, _ in pages])
    assert not any("Copyright" in t or "About" in t for t in found)
    assert sum(got == want for got, (_, want) in zip(found, pages)) >= 48


def test_a_quote_counts_after_an_equals_sign_alone():
    page = Page("<p title=don't>Hello world</p><p>it's fine</p><p class='a>b' id=\"x>y\">end</p>")
    assert [t for t in page.text if t] == ["Hello world", "it's fine", "end"]


def test_long_and_odd_markup_takes_seconds():
    n = 20_000
    odd = ["<div>" * n + "x" + "</div>" * n, "<div>" * n + "</p>" * n + "x", '<x "' * n, "<x '" * n + ">x", "<li>" * n + "x",
           "<b>" * n + "<p>x" * 50, "<a href=\"" * n, "<p>x" * (250_000), "<!--" * n, "<svg>" * n + "x", "</" * n]
    for source in odd:
        begun = time.perf_counter()
        extract.Model().texts([source])
        assert time.perf_counter() - begun < 20, source[:20]


def test_nothing_to_train_on():
    assert extract.train([]).forest is None and extract.train(["", "<nav><a href=/>x</a></nav>"]).forest is None
