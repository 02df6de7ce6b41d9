"""A page as a tree of blocks, with the numbers a classifier looks at."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Mapping

import numpy as np

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<attrs>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>"  # a quote counts after = alone
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][\w:-]*)(?P<attrs2>[^>]*)>", re.S | re.I)
#: Elements that are dropped with what is in them; where the end tag is missing the tag alone is, but for code, which
#: runs to the end of the page as it does in a browser.
RAW = frozenset("script style noscript template title svg iframe object".split())
CODE = frozenset("script style".split())
_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}
#: Start tags that leave a head open; any other, or text, ends it.
HEAD_ONLY = frozenset("head html base basefont bgsound link meta noframes noscript script style template title".split())
_NAMES = re.compile(r"(?<![\w-])(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span
strike strong sub sup time tt u var wbr""".split())
#: Elements that end an open paragraph, and elements that end an open one of their own kind.
ENDS_P = frozenset("""address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr
main menu nav ol p pre section table ul""".split())
ENDS_OWN = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
            "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table tr article section div body nav aside main form".split())

FEATURES = ("depth chars link_share leaves elements chars_per_leaf density siblings place_among same_tag "
            "to_siblings share_of_page begins ends tag_score names_score names_least names_most path_tag path_names "
            "path_names_most is_leaf marks_per_word share_of_parent link_share_before link_share_after").split()


class Page:
    """Nodes in page order, parents first. Node 0 is the root; a node with text is a leaf, a block of text."""

    def __init__(self, source: str | None) -> None:
        self.tag, self.parent, self.names, self.text, self.link = ["#root"], [-1], [[]], [""], [0]
        stack: list[tuple[str, int]] = [("#root", 0)]  # open elements; inline ones have the node they stand in
        pieces: list[str] = []
        state = {"leaf": -1, "links": 0}
        opened: Counter = Counter()  # open elements by name, so that no stack is walked in vain

        def end_leaf() -> None:
            if state["leaf"] >= 0:
                self.text[state["leaf"]] = " ".join(html.unescape("".join(pieces)).split())
                pieces.clear()
                state["leaf"] = -1

        def add(tag: str, names: list[str]) -> int:
            self.tag.append(tag)
            self.parent.append(stack[-1][1])
            self.names.append(names)
            self.text.append("")
            self.link.append(0)
            return len(self.tag) - 1

        def put(piece: str) -> None:
            if state["leaf"] < 0:
                if not piece.strip():
                    return
                state["leaf"] = add("#text", [])
            pieces.append(piece)
            if state["links"]:
                self.link[state["leaf"]] += len(piece.strip())

        def pop_to(depth: int) -> None:
            for name, _ in stack[depth:]:
                opened[name] -= 1
                state["links"] -= name == "a"
                if name not in INLINE:
                    end_leaf()
            del stack[depth:]

        source, at = source or "", 0
        head, unclosed, last = False, set(), source.rfind(">")
        while at <= last and (m := _TOKEN.search(source, at)):
            if m.start() > at:
                put(source[at:m.start()])
                head = head and not source[at:m.start()].strip()
            at = m.end()
            tag = (m["tag"] or m["tag2"] or "").lower()
            if not tag:
                continue
            closes, attrs = m["close"] or m["close2"], m["attrs"] or m["attrs2"] or ""
            if tag == "head":
                head = not closes
                continue
            head = head and (tag not in ("body", "html") if closes else tag in HEAD_ONLY)
            if tag in RAW and not closes:
                if tag == "svg" and attrs.endswith("/"):
                    continue
                end = None if tag in unclosed else _END[tag].search(source, at)
                if end:
                    at = end.end()
                elif tag in CODE:
                    at = len(source)
                else:
                    unclosed.add(tag)
                continue
            if head:
                continue
            if closes:
                if opened[tag] > 0:
                    pop_to(next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag))
                elif tag not in INLINE:
                    end_leaf()
                continue
            found = [w for g in _NAMES.findall(attrs) for w in _NAME.findall("".join(g).lower())]
            if tag in INLINE:
                if tag == "br":
                    put(" ")
                elif tag not in VOID:
                    state["links"] += tag == "a"
                    opened[tag] += 1
                    stack.append((tag, stack[-1][1]))
                continue
            end_leaf()
            if tag in ENDS_P and opened["p"] > 0:
                pop_to(next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == "p"))
            if any(opened[t] > 0 for t in ENDS_OWN.get(tag, ())):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in ENDS_OWN[tag]:
                        pop_to(k)
                        break
                    if stack[k][0] in SCOPES:
                        break
            if tag not in VOID:
                opened[tag] += 1
                stack.append((tag, add(tag, found)))
        if at < len(source):
            put(source[at:])
        end_leaf()

    def table(self, tag_scores: Mapping[str, float], name_scores: Mapping[str, float]) -> np.ndarray:
        """A row of FEATURES per node."""
        n = len(self.tag)
        parent = np.array(self.parent)
        own = np.array([len(t) for t in self.text], float)
        leaf = np.array([t == "#text" for t in self.tag], float)
        words = np.array([t.count(" ") + 1 if t else 0 for t in self.text], float)
        marks = np.array([sum(map(t.count, ".,;:!?")) for t in self.text], float)
        link = np.minimum(np.array(self.link, float), own)
        before = np.cumsum(own) - own
        sums = np.stack([own, link, leaf, 1 - leaf, words, marks])
        last = before + own
        for k in range(n - 1, 0, -1):  # children come after their parents
            sums[:, parent[k]] += sums[:, k]
            last[parent[k]] = max(last[parent[k]], last[k])
        chars, links, leaves, elements, words, marks = sums
        total = max(chars[0], 1.0)
        depth, path_tag, path_least, path_most = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
        tag_score = np.array([tag_scores.get(t, 0.0) for t in self.tag])
        scores = [[name_scores.get(w, 0.0) for w in names] for names in self.names]
        names_sum = np.array([sum(s) for s in scores], float)
        names_least = np.array([min(s, default=0.0) for s in scores])
        names_most = np.array([max(s, default=0.0) for s in scores])
        children: list[list[int]] = [[] for _ in range(n)]
        for k in range(1, n):
            p = parent[k]
            children[p].append(k)
            depth[k] = depth[p] + 1
            path_tag[k] = min(path_tag[p], tag_score[k])
            path_least[k] = min(path_least[p], names_least[k])
            path_most[k] = max(path_most[p], names_most[k])
        share = links / np.maximum(chars, 1.0)
        siblings, place, same, to_mean = np.ones(n), np.zeros(n), np.ones(n), np.zeros(n)
        link_before, link_after = np.full(n, -1.0), np.full(n, -1.0)
        for kids in children:
            if not kids:
                continue
            tags = [self.tag[k] for k in kids]
            mean = sum(chars[k] for k in kids) / len(kids)
            counts = {t: tags.count(t) for t in set(tags)}
            for i, k in enumerate(kids):
                siblings[k], place[k], same[k] = len(kids), i / len(kids), counts[tags[i]] / len(kids)
                to_mean[k] = np.log((chars[k] + 1) / (mean + 1))
                if i:
                    link_before[k], link_after[kids[i - 1]] = share[kids[i - 1]], share[k]
        return np.stack([
            depth, np.log1p(chars), share, np.log1p(leaves), np.log1p(elements),
            np.log1p(chars / np.maximum(leaves, 1)), np.log1p(chars / (elements + 1)), np.log1p(siblings), place, same,
            to_mean, chars / total, before / total, last / total, tag_score, names_sum, names_least, names_most, path_tag,
            path_least, path_most, leaf, marks / np.maximum(words, 1), chars / np.maximum(chars[np.maximum(parent, 0)], 1),
            link_before, link_after], axis=1)

    def decode(self, log_odds: np.ndarray) -> list[str]:
        """The blocks of the best choice in which nothing is kept below what is dropped, and what is
        kept holds a block that is. Choices are compared by the sum of their log-probabilities."""
        n, parent = len(self.tag), self.parent
        best, gone = (-np.logaddexp(0, -log_odds)).tolist(), (-np.logaddexp(0, log_odds)).tolist()
        gain = [float("-inf")] * n  # the most that keeping rather than dropping a child brings
        nearest = [-1] * n
        for k in range(n - 1, -1, -1):
            if self.tag[k] != "#text":
                best[k] += min(gain[k], 0.0)  # if no child is worth it, the least bad one is kept
            p = parent[k]
            if p >= 0:
                more = best[k] - gone[k]
                best[p] += max(best[k], gone[k])
                gone[p] += gone[k]
                if more >= gain[p]:
                    gain[p], nearest[p] = more, k
        kept = [False] * n
        kept[0] = n > 1 and best[0] >= gone[0]
        for k in range(1, n):
            kept[k] = kept[parent[k]] and (best[k] >= gone[k] or nearest[parent[k]] == k and gain[parent[k]] < 0)
        return [t for k, t in zip(kept, self.text) if k and t]
