"""Column expressions over raw HTML.

A page row is read once and turned into narrow columns in the same stage; no
HTML goes through a shuffle. A selector such as ``.product-card h2`` is turned
into regular expressions: the page is split at each opening tag of the outer
part, each piece is cut where a counter of open tags comes to zero, and inner tags
are looked up in the pieces. Elements that may hold others are found as intervals of the
page's tags, in a time that hardly grows faster than the page. Pass ``markup(html)`` where comments and scripts may
hold tags; it is worth a column of its own, so that a page is cleaned once.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from landsync.functions.text import bind, col, only_if, squeeze, utrim

_SIMPLE = re.compile(r"(?P<tag>\w+)?(?:\.(?P<cls>[\w-]+))?(?P<attrs>(?:\[[^\]]+\])*)$")
_ATTR = re.compile(r"\[(?P<name>[\w-]+)(?:(?P<op>[*^$]?=)'(?P<value>[^']*)')?\]")
# Browsers end these elements at the next one of their kind. Stopping there also
# keeps a page full of unclosed tags from being scanned to its end for each.
_ANCHOR_END = r"(?=</a\s*>|<a\b|\z)"
_HEADING_END = r"(?=</?h[1-6]\b|\z)"
# A paragraph may be left open; the next block ends it.
_PARAGRAPH_END = (r"(?=</?(?:p|div|ul|ol|h[1-6]|table|section|article|main|footer|header|nav|form)\b"
                  r"|</body|\z)")

# Code points by name, as text that Spark reads once while it plans.
_ENTITIES = json.dumps(name2codepoint | {"apos": 39})


@dataclass(frozen=True)
class Selector:
    """Regex form of one selector; ``scope`` is None for a bare target.

    ``element`` is None where only counting tags tells where the target ends.
    ``needs`` are texts that a page must hold for the selector to find anything;
    looking for them first is much cheaper than the search.
    """

    scope: str | None
    opening: str
    element: str | None
    href: str
    needs: tuple[str, ...]
    tag: str | None = None


def _attr_test(name: str, op: str | None, value: str | None) -> str:
    if op is None:
        return rf"(?=[^>]*\s(?i:{name})\b)"
    value = rf"\Q{value}\E"
    quoted = {"*=": rf"[^\"']*{value}", "^=": value, "$=": rf"[^\"']*{value}[\"']",
              "=": rf"{value}[\"']"}[op]
    bare = {"*=": rf"[^\"'\s>]*{value}", "^=": value, "$=": rf"[^\"'\s>]*{value}(?=[\s>])",
            "=": rf"{value}(?=[\s>])"}[op]
    return rf"(?=[^>]*\s(?i:{name})\s*=\s*(?:[\"']{quoted}|{bare}))"


def _opening(simple: str) -> tuple[str, str | None, list[str]]:
    """Pattern of an opening tag (group 1 is its name), the tag and the texts it
    needs. Tag and attribute names ignore case, classes and values do not."""
    found = _SIMPLE.match(simple)
    if not found:
        raise ValueError(f"unsupported selector part: {simple}")
    tag, cls = found["tag"], found["cls"]
    attrs = list(_ATTR.finditer(found["attrs"]))
    tests = "".join(_attr_test(a["name"], a["op"], a["value"]) for a in attrs)
    needs = [a["value"] for a in attrs if a["value"]]
    if cls:
        tests += (rf"(?=[^>]*\s(?i:class)\s*=\s*"
                  rf"(?:[\"'][^\"']*(?<![\w-]){cls}(?![\w-])|{cls}(?=[\s>])))")
        needs.append(cls)
    return rf"<((?i:{tag or '[a-z][a-z0-9]*'}))\b{tests}", tag, needs


def selector(css: str) -> Selector:
    """Compile ``target`` or ``scope target``."""
    *outer, target = css.split()
    opening, tag, needs = _opening(target)
    ends = {"p": _PARAGRAPH_END, "a": _ANCHOR_END,
            **{f"h{i}": _HEADING_END for i in range(1, 7)}}
    element = rf"(?s){opening}[^>]*>(.*?){ends[tag]}" if tag in ends else None
    scope = None
    if outer:
        scope, _, scope_needs = _opening(outer[-1])
        needs = scope_needs + needs
    href = rf"{opening}[^>]*?\s(?i:href)\s*=\s*[\"']?((?<=[\"'])[^\"']*|[^\"'\s>]+)"
    return Selector(scope, opening, element, href, tuple(needs), tag)


def markup(html: Column | str) -> Column:
    """A page without comments, scripts and styles, as selectors see it."""
    return F.regexp_replace(
        col(html), r"(?is)<!--.*?(?:-->|\z)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|\z)", "")


def _holds(html: Column, sel: Selector) -> Column:
    return reduce(lambda a, b: a & b, [F.contains(html, F.lit(n)) for n in sel.needs],
                  F.lit(True))


def _until_closed(inner: Column, tag: Column) -> Column:
    """What stands before the closing tag that matches; null if there is none. Tags of this
    name that open on the way must close first."""
    def cut(parts: Column) -> Column:
        # Every part but the first begins with a tag of this name.
        end = F.aggregate(
            F.slice(parts, 2, F.size(parts)),
            F.struct(F.lit(1).alias("open"), F.lit(1).alias("parts")),
            lambda x, part: F.when(x["open"] == 0, x).otherwise(F.struct(
                F.when(part.startswith("</"), x["open"] - 1).otherwise(x["open"] + 1).alias("open"),
                F.when(part.startswith("</") & (x["open"] == 1), x["parts"])
                .otherwise(x["parts"] + 1).alias("parts"))))
        return bind(end, lambda x: F.when(
            x["open"] == 0, F.array_join(F.slice(parts, 1, x["parts"]), "")))

    pattern = F.concat(F.lit(r"(?i)(?=</?"), tag, F.lit(r"(?=[\s/>]))"))
    # A split gives no empty first part, so a blank is put there.
    return bind(F.split(F.concat(F.lit(" "), inner), pattern), cut)


def _inner(part: Column) -> Column:
    """What follows the opening tag that the part begins with."""
    return F.regexp_replace(part, r"(?s)^<[^>]*>", "")


def _tag_of(part: Column) -> Column:
    return F.regexp_extract(part, r"^</?([a-zA-Z][^\s/>]*)", 1)


def _pieces(html: Column, opening: str) -> Column:
    """Inner HTML of every element with this opening tag, in page order. One that holds another of its kind
    reaches to where that begins, so that nothing is found twice; so does one that is never closed."""
    def each(parts: Column) -> Column:
        found = F.transform(parts, lambda part, i: F.when(
            i > 0, F.coalesce(_until_closed(_inner(part), _tag_of(part)), _inner(part))))
        return F.filter(found, lambda x: x.isNotNull())

    return bind(F.split(F.concat(F.lit(" "), html), rf"(?={opening})", -1), each)


def _depths(events: Column) -> Column:
    """How many elements are open after each tag; a closing tag without an open element counts for nothing.

    The tags up to some place turn a depth d into max(m, d + s), so tags are taken in blocks of the root of their
    number: (s, m) of each tag within its block, then the depth at which each block begins. No array longer than
    a block or the list of blocks is copied from tag to tag.
    """
    step = "struct<s:int,m:int>"
    size = F.ceil(F.sqrt(F.size(events))).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), ((F.size(events) - 1) / size).cast("int")),
                         lambda b: F.slice(events, b * size + 1, size))

    def after(last: Column, tag: Column) -> Column:
        s, m = F.coalesce(last["s"], F.lit(0)), F.coalesce(last["m"], F.lit(0))
        return F.when(tag["shut"], F.struct((s - 1).alias("s"), F.greatest(m - 1, F.lit(0)).alias("m"))).otherwise(
            F.struct((s + 1).alias("s"), (m + 1).alias("m")))

    def within(block: Column) -> Column:
        return F.aggregate(block, F.array().cast(f"array<{step}>"), lambda acc, tag: F.concat(
            acc, F.array(after(F.get(acc, F.size(acc) - 1), tag))))

    def depths(steps: Column) -> Column:
        starts = F.aggregate(steps, F.array(F.lit(0)), lambda acc, block: F.concat(acc, F.array(F.greatest(
            F.element_at(block, -1)["m"], F.element_at(acc, -1) + F.element_at(block, -1)["s"]))))
        return bind(starts, lambda at: F.flatten(F.transform(steps, lambda block, b: F.transform(
            block, lambda x: F.greatest(x["m"], F.get(at, b) + x["s"])))))

    return bind(F.transform(blocks, within), depths)


def _intervals(tags: Column) -> Column:
    """(at, end) of the wanted elements among the tags of one name, in no order; ``end`` is null for those never closed.

    An element's tags are the neighbours among the tags of its depth.
    """
    def paired(depths: Column) -> Column:
        placed = F.transform(tags, lambda t, i: F.struct(
            (F.get(depths, i) + t["shut"].cast("int")).alias("depth"), t["at"].alias("at"), t["shut"].alias("shut"),
            t["hit"].alias("hit"),
            (t["shut"] & (F.coalesce(F.get(depths, i - 1), F.lit(0)) == 0)).alias("stray")))
        ordered = F.sort_array(F.filter(placed, lambda t: ~t["stray"]))
        return bind(ordered, lambda all_: F.filter(F.transform(all_, lambda t, i: F.when(t["hit"], F.struct(
            t["at"].alias("at"), F.when(
                (F.get(all_, i + 1)["depth"] == t["depth"]) & F.get(all_, i + 1)["shut"],
                F.get(all_, i + 1)["at"]).alias("end")))), lambda x: x.isNotNull()))

    return bind(_depths(tags), paired)


def _elements(html: Column, opening: str, tag: str | None) -> Column:
    """Inner HTML of every element with this opening tag, in page order, each whole.

    The page's tags are read once, each element's interval is found by the depth of its tags, and the inner
    HTML is what stands between. One that is never closed reaches to the next opening, or to the end.
    """
    name = rf"(?i:{tag})" if tag else r"[a-zA-Z][^\s/>]*"

    def read(parts: Column) -> Column:
        tags = F.slice(F.transform(parts, lambda part, i: F.struct(
            i.alias("at"), F.lower(_tag_of(part)).alias("name"), part.startswith("</").alias("shut"),
            part.rlike(rf"^{opening}").alias("hit"))), 2, F.size(parts))

        def spans(tags: Column) -> Column:
            wanted = F.array_distinct(F.transform(F.filter(tags, lambda t: t["hit"]), lambda t: t["name"]))
            return F.sort_array(F.flatten(F.transform(wanted, lambda w: bind(
                F.filter(tags, lambda t: t["name"] == w), _intervals))))

        def inner(found: Column) -> Column:
            return F.transform(found, lambda x, i: _inner(F.array_join(F.slice(
                parts, x["at"] + 1, F.coalesce(x["end"], F.get(found, i + 1)["at"], F.size(parts)) - x["at"]), "")))

        return bind(bind(tags, spans), inner)

    return bind(F.split(F.concat(F.lit(" "), html), rf"(?=</?{name}(?=[\s/>]))", -1), read)


def _first_element(html: Column, opening: str) -> Column:
    """The first of ``_elements``, null if there is none; tags before it are not looked at."""
    def read(rest: Column) -> Column:
        return F.when(rest.isNotNull(), F.coalesce(
            _until_closed(_inner(rest), _tag_of(rest)),
            _inner(F.get(F.split(F.concat(F.lit(" "), rest), rf"(?={opening})", 3), F.lit(1)))))

    return bind(F.get(F.split(F.concat(F.lit(" "), html), rf"(?={opening})", 2), F.lit(1)), read)


def _in_scope(html: Column, sel: Selector, find: Callable[[Column], Column]) -> Column:
    found = (find(html) if sel.scope is None
             else F.flatten(F.transform(_pieces(html, sel.scope), find)))
    if not sel.needs:
        return found
    return F.when(_holds(html, sel), found).otherwise(F.array().cast("array<string>"))


def _all_inner(html: Column, sel: Selector) -> Column:
    if sel.element is None:
        return _in_scope(html, sel, lambda part: _elements(part, sel.opening, sel.tag))
    return _in_scope(html, sel, lambda part: F.regexp_extract_all(part, F.lit(sel.element), F.lit(2)))


def _first_inner(html: Column, sel: Selector) -> Column:
    """Inner HTML of the first element, looking no further than needed."""
    if sel.scope is None:
        return F.when(_holds(html, sel), F.regexp_extract(html, sel.element, 2) if sel.element is not None
                      else _first_element(html, sel.opening))
    if sel.element is not None:
        return F.get(_all_inner(html, sel), F.lit(0))
    firsts = F.transform(_pieces(html, sel.scope), lambda part: _first_element(part, sel.opening))
    return F.when(_holds(html, sel), F.get(F.filter(firsts, lambda x: x.isNotNull()), F.lit(0)))


def unescape(c: Column | str) -> Column:
    """Resolve character references: numbers, and the names of HTML 4."""
    def resolve(part: Column, i: Column) -> Column:
        name = F.regexp_extract(part, r"^(#?\w+);", 1)
        number = F.when(F.lower(name).startswith("#x"), F.conv(F.substring(name, 3, 8), 16, 10)).when(
            name.startswith("#"), F.substring(name, 2, 9)).try_cast("int")
        point = F.coalesce(number, F.element_at(F.from_json(F.lit(_ENTITIES), "map<string,int>"), name))
        char = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
        rest = F.regexp_replace(part, r"^#?\w+;", "")
        valid = (point > 0) & (point < 0x110000) & ~point.between(0xD800, 0xDFFF)
        return F.when(i == 0, part).when(valid, F.concat(char, rest)).otherwise(F.concat(F.lit("&"), part))

    def read(text: Column) -> Column:
        parts = F.split(text, r"&(?=#\d{1,7};|#[xX][0-9a-fA-F]{1,6};|[a-zA-Z]\w{1,7};)", -1)
        return F.when(F.contains(text, F.lit("&")),
                      F.array_join(F.transform(parts, resolve), "")).otherwise(text)

    return bind(col(c), read)


def text_of(fragment: Column | str) -> Column:
    """Visible text of a small fragment on one line."""
    return squeeze(unescape(F.regexp_replace(col(fragment), r"<[^>]*>", "")))


def body_text(html: Column | str) -> Column:
    """Visible text of a page, one line per block."""
    bare = F.regexp_replace(
        col(html), r"(?is)<(head|script|style|noscript|template)\b.*?</\1\s*>|<!--.*?-->", "")
    lines = F.regexp_replace(
        bare, r"(?i)<(?:br|/p|/div|/li|/tr|/h[1-6]|/ul|/ol|/table|/section|/article)\b[^>]*>", "\n")
    text = unescape(F.regexp_replace(lines, r"<[^>]*>", ""))
    return utrim(F.regexp_replace(text, r"[ \t]*\n[ \t\r\n]*", "\n"))


def every_text(html: Column | str, css: str) -> Column:
    """Texts of every element a selector finds, in page order, empty ones too."""
    return F.transform(_all_inner(col(html), selector(css)), text_of)


def all_texts(html: Column | str, css: str) -> Column:
    """Non-empty texts of every element a selector finds, in page order."""
    return F.filter(every_text(html, css), lambda t: F.length(t) > 0)


def first_text(html: Column | str, css: str) -> Column:
    """Text of the first element a selector finds, null where it is empty."""
    raw = _first_inner(col(html), selector(css))
    return only_if(text_of(raw), lambda t: t != "")


def all_hrefs(html: Column | str, css: str) -> Column:
    """``href`` values of every anchor a selector finds, in page order."""
    sel = selector(css)
    found = _in_scope(col(html), sel,
                      lambda part: F.regexp_extract_all(part, F.lit(sel.href), F.lit(2)))
    return F.filter(found, lambda h: F.length(h) > 0)


def anchors(html: Column | str) -> Column:
    """All anchors of a page as ``array<struct<href, text>>``."""
    blocks = F.regexp_extract_all(col(html), F.lit(rf"(?is)<a\b[^>]*>.*?{_ANCHOR_END}"), F.lit(0))
    return F.transform(blocks, lambda b: F.struct(
        F.regexp_extract(b, r"(?is)^<a\b[^>]*?\shref\s*=\s*[\"']([^\"']*)[\"']", 1).alias("href"),
        text_of(b).alias("text")))


def absolute(href: Column, base_url: Column | str, bare_too: bool = True) -> Column:
    """Absolute form of a link. ``bare_too`` also completes links that start
    with neither a slash nor ``http``."""
    base = F.lit(base_url) if isinstance(base_url, str) else base_url
    full = F.when(href.startswith("/"), F.concat(base, href))
    if bare_too:
        full = full.when(~href.startswith("http"), F.concat(base, F.lit("/"), href))
    return full.otherwise(href)
