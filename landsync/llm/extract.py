"""Main text of HTML pages by gradient-boosted trees over DOM nodes.

A page becomes a tree of elements and of blocks of text. Each node is described by
the text and link density of its subtree, its depth, its place among its siblings
and theirs, and by how tags and attribute tokens, its own and those above it, spread
over main text and the rest in training. Boosted trees give each node the odds that
it holds main text; decoding takes the most likely choice in which nothing is kept
below a dropped node.

Trained on a bounded sample of the pages at hand. Pages bear no labels, so in the
sample what stands in an ``article`` or ``main`` element counts as main text, but for forms,
asides, menus, lists of links and parts that bear a name of such. Its blocks are also set into
random layouts whose main text is known (see ``layouts``); pages without such elements give
their long blocks with few links to these layouts, so there is a model wherever there is text.

Cases: null or empty html, and pages where nothing is kept, give an empty text. Tags
that are not closed, closed twice or cut off don't stop a page, but for a script, a
style sheet or a comment without its end, which runs to the end of the page. A head
ends at its end tag or at the first tag or text that can't stand in it. Repeated rows are
read each for itself. With no text to train on, all text is kept. The time for a page grows with
its length, however its tags nest.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landsync.llm.common import hashed_sample, table
from landsync.llm.dom import Page
from landsync.llm.layouts import MARK, NOISE, Layout
from landsync.llm.registry import query
from landsync.llm.trees import Forest, boost

#: Bounds of training: pages, bytes of the html of a page that is taken, layouts made of each page, blocks of a layout.
PAGES, PAGE_BYTES, LAYOUTS, BLOCKS = 300, 200_000, 3, 25
#: Characters that a block needs, and the share of them in links that it may have, to pass for main text where no element tells.
LONG, LINKED = 60, 0.3
SEED = 2


@dataclass
class Model:
    forest: Forest | None = None
    tag_scores: dict[str, float] = field(default_factory=dict)
    name_scores: dict[str, float] = field(default_factory=dict)

    def texts(self, sources: list[str | None]) -> list[str]:
        pages = [Page(s) for s in sources]
        if self.forest is None:
            return ["\n".join(t for t in p.text if t) for p in pages]
        tables = [p.table(self.tag_scores, self.name_scores) for p in pages]
        odds = self.forest.log_odds(np.concatenate(tables)) if tables else np.zeros(0)
        out, at = [], 0
        for p, t in zip(pages, tables):
            out.append("\n".join(p.decode(odds[at:at + len(t)])))
            at += len(t)
        return out


_MAIN, _ASIDE = frozenset({"article", "main"}), frozenset("aside nav form footer menu button select".split())


def _noise(page: Page) -> np.ndarray:
    """Whether each node stands in a part that tag, name or links mark as something else than main text."""
    n = len(page.tag)
    chars, links, many = [float(len(t)) for t in page.text], [float(x) for x in page.link], [float(bool(t)) for t in page.text]
    for k in range(n - 1, 0, -1):
        for sums in (chars, links, many):
            sums[page.parent[k]] += sums[k]
    out = np.zeros(n, bool)
    for k in range(1, n):
        named = page.tag[k] in _ASIDE or page.tag[k] not in _MAIN and not NOISE.isdisjoint(page.names[k])
        listed = page.tag[k] in ("ul", "ol", "div", "section", "p") and many[k] >= 3 and links[k] > 0.8 * chars[k]
        out[k] = out[page.parent[k]] or named or listed
    return out


def _main(page: Page) -> np.ndarray:
    """Whether each node stands in an ``article`` or ``main`` element, and in no part of it that is something else."""
    inside = np.zeros(len(page.tag), bool)
    for k in range(1, len(page.tag)):
        inside[k] = inside[page.parent[k]] or page.tag[k] in _MAIN
    return inside & ~_noise(page)


def _passing(page: Page) -> np.ndarray:
    """Blocks that pass for main text on a page without such an element."""
    own = np.array([len(t) for t in page.text])
    return (own >= LONG) & (np.array(page.link) <= LINKED * own) & ~_noise(page)


def _holding(page: Page, main: np.ndarray) -> np.ndarray:
    """Whether a node is or holds a block of main text."""
    holds = main & np.array([bool(t) for t in page.text])
    for k in range(len(page.tag) - 1, 0, -1):
        holds[page.parent[k]] |= holds[k]
    return holds


def _scores(counts: dict[bool, Counter]) -> dict[str, float]:
    return {k: float(np.log((counts[True][k] + 1) / (counts[False][k] + 1)))
            for k in counts[True] | counts[False] if counts[True][k] + counts[False][k] >= 5}


def train(sources: list[str]) -> Model:
    rng = Random(SEED)
    labelled: list[tuple[Page, np.ndarray]] = []
    texts: list[list[str]] = []
    for s in sources:
        page = Page(s)
        main = _main(page)
        if main.any():
            labelled.append((page, _holding(page, main)))
        else:
            main = _passing(page)
        blocks = [t for m, t in zip(main, page.text) if m and t]
        at = rng.randrange(max(1, len(blocks) - BLOCKS + 1))
        texts.append(blocks[at:at + BLOCKS])
    other = [t for blocks in texts for t in blocks]
    for blocks in texts:
        for _ in range(LAYOUTS if blocks else 0):
            page = Page(Layout(rng, blocks, other).page())
            main = np.array([MARK in t for t in page.text])
            page.text = [t.replace(MARK, "") for t in page.text]
            labelled.append((page, _holding(page, main)))
    if not labelled:
        return Model()
    tags, names = {True: Counter(), False: Counter()}, {True: Counter(), False: Counter()}
    for page, holds in labelled:
        for t, w, h in zip(page.tag, page.names, holds):
            tags[bool(h)][t] += 1
            names[bool(h)].update(set(w))
    model = Model(None, _scores(tags), _scores(names))
    x = np.concatenate([p.table(model.tag_scores, model.name_scores) for p, _ in labelled])
    y = np.concatenate([h for _, h in labelled]).astype(float)
    weight = np.concatenate([np.full(len(h), 1 / np.sqrt(len(h))) for _, h in labelled])
    model.forest = boost(x, y, weight / weight.mean())
    return model


def learn(pages: DataFrame, source: str = "html", key: str = "page_id") -> Model:
    """A model from a bounded number of pages, chosen by a hash of id and html; copies count once."""
    some = pages.where(F.octet_length(source) <= PAGE_BYTES).select(key, source)
    rows = (hashed_sample(some, some.count(), PAGES, key, source)
            .select(F.xxhash64(F.col(source)).alias("h"), F.col(source).alias("html")).distinct().collect())
    return train([h for _, h in sorted(tuple(r) for r in rows)])


def main_text(pages: DataFrame, model: Model, source: str = "html") -> DataFrame:
    """``pages`` with ``text`` in place of the html column; no shuffle."""
    rest = [c for c in pages.columns if c not in (source, "text")]
    schema = pages.select(*rest).withColumn("text", F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = batch.column(source).to_pylist()
            texts = [t for k in range(0, len(sources), 500) for t in model.texts(sources[k:k + 500])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(texts, pa.string())], [*rest, "text"])

    return pages.select(*rest, source).mapInArrow(run, schema)


@query()
def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return main_text(pages, learn(pages)).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
