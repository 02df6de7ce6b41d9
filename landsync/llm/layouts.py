"""Page layouts with known main text, to train on.

The pages at hand give the text; a layout drawn at random puts it between menus,
adverts, notices, forms, comments and the like, under the names that sites use for
such parts, under names that say nothing, or under none.
"""

from __future__ import annotations

import html
import re
from random import Random

#: Mark put before what belongs to the main text; it is taken off before a page is read.
MARK = "\x02"

WRAPPERS = [("article", ""), ("main", ""), ("div", "content"), ("div", "post-content"), ("div", "entry-content"),
            ("div", "article-body"), ("section", "story"), ("div", "main"), ("div", "text"), ("div", "page"),
            ("section", ""), ("div", ""), ("td", ""), ("div", "body-copy"), ("div", "post"), ("div", "single")]
MENUS = [("nav", ""), ("nav", "navbar"), ("div", "menu"), ("div", "nav"), ("ul", "breadcrumb"), ("div", "navigation"),
         ("div", "topbar"), ("ul", "menu-list"), ("div", "tabs"), ("div", "")]
LISTS = [("aside", ""), ("aside", "sidebar"), ("div", "sidebar"), ("div", "related"), ("section", "recommended"),
         ("div", "widget"), ("div", "popular"), ("div", "links"), ("div", "tags"), ("div", "share social"), ("div", "pager"),
         ("div", "")]
BOXES = [("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "banner"), ("div", "promo"), ("div", "sponsored"),
         ("aside", "ad-box"), ("div", "cookie-notice"), ("div", "cookie consent"), ("div", "notice"), ("div", "alert"),
         ("div", "popup modal"), ("div", "subscribe newsletter"), ("div", "disclaimer"), ("div", "advertisement"),
         ("section", "gdpr banner")]
FORMS = [("form", ""), ("form", "search"), ("form", "newsletter"), ("form", "login"), ("form", "comment-form"),
         ("div", "signup form")]
HEADERS = [("header", ""), ("div", "header"), ("header", "site-header"), ("div", "masthead"), ("div", "logo")]
FOOTERS = [("footer", ""), ("div", "footer"), ("footer", "site-footer"), ("div", "copyright"), ("div", "bottom legal")]
COMMENTS = [("section", "comments"), ("div", "comments"), ("div", "comment-list"), ("div", "disqus thread"),
            ("ol", "commentlist"), ("div", "responses"), ("div", "reviews")]
#: Names of parts that are no main text, wherever they stand.
NOISE = frozenset(w for kind in (MENUS, LISTS, BOXES, FORMS, FOOTERS, COMMENTS) for _, names in kind
                  for w in re.findall("[a-z]+", names)) - frozenset("links list box tags form site bottom legal".split())


class Layout:
    def __init__(self, rng: Random, blocks: list[str], other: list[str]) -> None:
        self.rng, self.blocks, self.other = rng, blocks, other
        self.naming = rng.choice(("plain", "plain", "plain", "hashed", "none"))

    def element(self, kind: tuple[str, str], inside: str, also: str = "") -> str:
        tag, name = kind
        if self.naming == "hashed" and name:
            name = "".join(self.rng.choices("bcdfghjkmnpqrstvwxz", k=6))
        elif self.naming == "none":
            name = ""
            if self.rng.random() < 0.5:
                tag = "div"
        names = " ".join(x for x in (name, also) if x)
        how = self.rng.choice(("class", "class", "id"))
        return f"<{tag}{f' {how}={chr(34)}{names}{chr(34)}' if names else ''}>{inside}</{tag}>"

    def phrase(self, low: int, high: int) -> str:
        words = self.rng.choice(self.other).split()
        n = self.rng.randint(low, high)
        at = self.rng.randrange(max(1, len(words) - n + 1))
        return html.escape(" ".join(words[at:at + n]), quote=False)

    def links(self, low: int, high: int, words: int) -> str:
        items = [f"<a href='/{k}'>{self.phrase(1, words)}</a>" for k in range(self.rng.randint(low, high))]
        return ("<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>") if self.rng.random() < 0.7 else " | ".join(items)

    def noise(self, kind: str) -> str:
        r = self.rng
        if kind == "menu":
            return self.element(r.choice(MENUS), self.links(3, 10, 2))
        if kind == "list":
            head = f"<h3>{self.phrase(1, 3)}</h3>" if r.random() < 0.5 else ""
            return self.element(r.choice(LISTS), head + self.links(3, 8, 8))
        if kind == "box":
            inside = self.phrase(4, 30)
            inside = f"<p>{inside}</p>" if r.random() < 0.6 else inside
            return self.element(r.choice(BOXES), inside + (f"<a href='#'>{self.phrase(1, 3)}</a>" if r.random() < 0.4 else "")
                                + (f"<button>{self.phrase(1, 2)}</button>" if r.random() < 0.3 else ""))
        if kind == "form":
            return self.element(r.choice(FORMS), f"<label>{self.phrase(1, 4)}</label><input name='q'>"
                                f"<button>{self.phrase(1, 2)}</button>" + (f"<p>{self.phrase(3, 12)}</p>" if r.random() < 0.4 else ""))
        if kind == "header":
            return self.element(r.choice(HEADERS), f"<h1>{self.phrase(1, 4)}</h1>" if r.random() < 0.4 else self.phrase(1, 6))
        if kind == "footer":
            return self.element(r.choice(FOOTERS), ("<p>&copy; " + self.phrase(2, 25) + "</p>" if r.random() < 0.5
                                                    else "&copy; " + self.phrase(2, 25)) + (self.links(1, 5, 2) if r.random() < 0.5 else ""))
        said = "".join(self.element(("div" if r.random() < 0.6 else "li", "comment"), (
            f"<span class='author'>{self.phrase(1, 2)}</span> " if r.random() < 0.6 else "")
            + f"<p>{self.phrase(4, 40)}</p>") for _ in range(r.randint(1, 6)))
        return self.element(r.choice(COMMENTS), (f"<h3>{self.phrase(1, 3)}</h3>" if r.random() < 0.7 else "") + said)

    def some(self, kinds: str, chance: float) -> str:
        return "".join(self.noise(k) for k in kinds.split() if self.rng.random() < chance)

    def main(self) -> str:
        r, out = self.rng, []
        for k, b in enumerate(self.blocks):
            text = html.escape(MARK + b, quote=False)
            tag = r.choice(("h1", "h1", "h2", "p")) if k == 0 else r.choice(("p",) * 12 + ("h2", "blockquote", "li", "div"))
            out.append(f"<{tag}>{text}</{tag}>" if tag != "li" else f"<ul><li>{text}</li></ul>")
            if r.random() < 0.06:
                out.append(self.noise(r.choice(("box", "list"))))
        inside = "".join(out) + self.some("list box", 0.12) + (self.noise("comments") if r.random() < 0.2 else "")
        if r.random() < 0.15:
            inside = self.some("list", 1) + inside
        for _ in range(r.randint(1, 2)):
            inside = self.element(r.choice(WRAPPERS), inside)
        return inside

    def page(self) -> str:
        r = self.rng
        top = self.some("box header menu box form", 0.5)
        middle = self.some("list box", 0.3) + self.main() + self.some("comments list box form", 0.35)
        if r.random() < 0.4:
            middle = self.element(r.choice((("div", "wrapper"), ("div", "container"), ("div", ""), ("div", "row"))), middle)
        return f"<html><head><title>x</title></head><body>{top}{middle}{self.some('list menu box footer', 0.5)}</body></html>"
