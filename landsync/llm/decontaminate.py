"""Benchmark passages found by spaced seeds.

A text's tokens are runs of letters and digits, lower-cased; in scripts that are written without
spaces each letter is a token. A mask looks at some of
the tokens in its span and ignores the others; the tokens it looks at, hashed, are a
seed. Seeds of the benchmark items are joined with seeds at every token of every
text. A hit gives a diagonal: where in the text the item would begin. Along it item
and text are compared token by token, and the item counts as found if some WINDOW
tokens of it (or all, if it has fewer) agree in at least SHARE of them. The masks
leave no pattern of substitutions out: whichever tokens of such a window differ, one
mask still fits on equal tokens (the tests try all patterns).

Cases: null and empty texts hold nothing. Items of 5 to 7 tokens must agree whole;
shorter ones can't be told from chance and are skipped. Of equal matches of an item
in a text the earliest is returned. Repeated rows, and rows with a null id, are
judged each for itself; items that repeat a text are found each. No benchmark, or
no documents: no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landsync.llm.common import BROADCAST_ROWS, bind, settled, table
from landsync.llm.registry import query

#: 1: the token counts, 0: it is ignored. Found by search, so that every case above is covered.
MASKS = ("110111", "11010011", "11111")
WINDOW, SHARE = 20, 0.8
SHORTEST, SHORTEST_INEXACT = 5, 8
#: Masks of items under SHORTEST tokens, whole.
SHORT_MASKS = ("11", "111", "1111")
#: Scripts written without spaces between words.
#: Code points among which theirs are, for a quick look.
FAR = r"[\u0E00-\u1FFF\u2E80-\x{10FFFF}]"
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
#: Slots to a seed in the table that the scan looks seeds up in.
SLOTS = 16


def tokens(text: Column) -> Column:
    whole = F.lower(F.coalesce(text, F.lit("")))
    spaced = F.when(whole.rlike(FAR), F.regexp_replace(whole, f"({UNSPACED})", " $1 ")).otherwise(whole)
    return F.array_remove(F.split(spaced, r"[^\p{L}\p{N}]+"), "")


def _seeds(hashes: Column, mask: str) -> Column:
    """The seed at each token from which the mask fits."""
    looks = [k for k, c in enumerate(mask) if c == "1"]
    last = F.size(hashes) - len(mask)
    return F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.xxhash64(F.lit(mask), *(F.get(hashes, i + k) for k in looks)))
    ).otherwise(F.array().cast("array<bigint>"))


def seeds(words: Column, masks: Sequence[str] = MASKS) -> Column:
    """The seeds of all masks, one mask after the other."""
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return bind(hashed, lambda h: F.concat(*(_seeds(h, m) for m in masks)))


def _item_seeds(listed: DataFrame, masks: Sequence[str]) -> DataFrame:
    return (listed.select("item_id", "m", F.posexplode(seeds(F.col("item"), masks)).alias("j", "seed"))
            .select("item_id", "m", "seed", _place("j", "m", masks).alias("j")))


def _begins(hashes: Column) -> Column:
    """For each token, hashes of the three at which every mask looks first."""
    first = [k for k in range(min(map(len, MASKS))) if all(m[k] == "1" for m in MASKS)]
    return F.transform(hashes, lambda h, i: F.xxhash64(*(F.get(hashes, i + k) for k in first)))


def _looked_up(known: Sequence[int]) -> Callable[[Column], Column]:
    """A test that holds for every known hash, and by chance for one in SLOTS others: a table of its last bits."""
    slots = 1 << max(10, (SLOTS * len(known) - 1).bit_length())
    held = np.zeros(slots, np.uint8)
    held[np.array(known, np.int64) & (slots - 1)] = 1
    table_, one = bytearray(held.tobytes()), bytearray(b"\x01")
    return lambda h: F.substring(F.lit(table_), h.bitwiseAND(F.lit(slots - 1)).cast("int") + 1, F.lit(1)) == F.lit(one)


def _placed(words: Column, masks: Sequence[str], known: tuple[Sequence[int], Sequence[int]] | None) -> Column:
    """Seeds as structs of place and seed. With the ``known`` beginnings and seeds of the benchmark only those that may
    be one of them: a beginning is looked up at every token, and the masks are tried where it may be known."""
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    struct = lambda i, s: F.struct(i.alias("place"), s.alias("seed"))
    if known is None:
        return bind(hashed, lambda h: F.concat(*(F.transform(_seeds(h, m), lambda s, i: struct(i, s)) for m in masks)))
    begin, seed = map(_looked_up, known)

    def tried(h: Column, i: Column) -> Column:
        found = F.array(*(F.when(i + len(m) <= F.size(h), struct(i, F.xxhash64(
            F.lit(m), *(F.get(h, i + k) for k, c in enumerate(m) if c == "1")))) for m in MASKS))
        return F.filter(found, lambda x: x.isNotNull() & seed(x["seed"]))

    def likely(h: Column) -> Column:
        places = bind(_begins(h), lambda three: F.filter(
            F.sequence(F.lit(0), F.size(three) - 1), lambda i: begin(F.get(three, i))))
        short = [F.filter(F.transform(_seeds(h, m), lambda s, i: struct(i, s)), lambda x: seed(x["seed"]))
                 for m in masks if m not in MASKS]
        return F.when(F.size(h) > 0, F.concat(F.flatten(F.transform(places, lambda i: tried(h, i))), *short))

    return bind(hashed, likely)


def _place(k: str, n: str, masks: Sequence[str]) -> Column:
    """The token at which the k-th of the seeds of n tokens stands."""
    out, before = None, F.lit(0)
    for m in masks:
        many = F.greatest(F.col(n) - (len(m) - 1), F.lit(0))
        here = F.when(F.col(k) < before + many, F.col(k) - before)
        out = here if out is None else F.coalesce(out, here)
        before = before + many
    return out


def needed(n: Column) -> tuple[Column, Column]:
    """Length of the window of an item of n tokens, and how many of it must agree."""
    window = F.least(n, F.lit(WINDOW))
    may_differ = F.when(n >= SHORTEST_INEXACT, F.floor(window * (1 - SHARE) + 1e-9)).otherwise(0)
    return window, (window - may_differ).cast("int")


def find_items(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id",
               item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, doc_start, item_start, n_tokens, n_matched): per document and item that
    it holds, the longest stretch of agreeing windows, in tokens."""
    listed = (items.select(F.col(item_key).alias("item_id"), tokens(F.col(item_text)).alias("item"))
              .withColumn("m", F.size("item")).where(F.col("m") >= len(SHORT_MASKS[0])))
    listed = settled(listed, "items")
    short = [r["m"] for r in listed.where(F.col("m") < SHORTEST).select("m").distinct().collect()]
    masks = [*MASKS, *(k for k in SHORT_MASKS if len(k) in short)]
    parts = [_item_seeds(listed.where(F.col("m") >= SHORTEST), MASKS),
             *(_item_seeds(listed.where(F.col("m") == len(k)), [k]) for k in masks[len(MASKS):])]
    item_seeds = settled(reduce(DataFrame.union, parts), "item-seeds")
    few = item_seeds.count() <= BROADCAST_ROWS
    known = None
    if few:
        begins = listed.select(F.explode(bind(F.transform("item", lambda w: F.xxhash64(w)), _begins)).alias("seed"))
        known = tuple([r["seed"] for r in hashes.select("seed").distinct().collect()] for hashes in (begins, item_seeds))

    row = F.xxhash64(F.col(key).cast("string"), F.col(text))
    each = docs.select(row.alias("row"), tokens(F.col(text)).alias("words"))
    spread = each.select("row", F.explode(_placed(F.col("words"), masks, known)).alias("x")).select("row", "x.place", "x.seed")
    hits = (spread.join(F.broadcast(item_seeds) if few else item_seeds, "seed")
            .select("row", "item_id", "m", (F.col("place") - F.col("j")).alias("diagonal")).distinct())
    rows = settled(hits.groupBy("row").agg(F.collect_list(F.struct("item_id", "m", "diagonal")).alias("hits")), "hits")
    found = rows.agg(F.coalesce(F.sum(F.size("hits")), F.lit(0))).first()[0] if few else None

    again = docs.select(F.col(key).alias("doc_id"), row.alias("row"), F.col(text).alias("text"))
    again = again.join(F.broadcast(rows) if few and found <= BROADCAST_ROWS else rows, "row")
    beside = bind(tokens(F.col("text")), lambda w: F.transform("hits", lambda h: F.struct(
        h["item_id"].alias("item_id"), h["diagonal"].alias("diagonal"),
        F.transform(F.sequence(F.lit(0), h["m"] - 1), lambda j: F.get(w, h["diagonal"] + j)).alias("words"))))
    pairs = again.select("doc_id", "row", F.explode(beside).alias("x")).select("doc_id", "row", "x.*")
    window, must = needed(F.col("m"))
    agree = F.zip_with("words", "item", lambda a, b: F.when(a == b, 1).otherwise(0))
    windows = F.filter(F.sequence(F.lit(1), F.col("m") - F.col("window") + 1), lambda s: F.aggregate(
        F.slice("agree", s, F.col("window")), F.lit(0), lambda x, y: x + y) >= F.col("must"))
    checked = (pairs.join(F.broadcast(listed) if few else listed, "item_id")
               .withColumn("agree", agree).withColumn("window", window).withColumn("must", must)
               .withColumn("windows", windows).where(F.size("windows") > 0)
               .withColumn("item_start", F.col("windows")[0] - 1)
               .withColumn("n_tokens", F.element_at("windows", -1) - F.col("windows")[0] + F.col("window"))
               .withColumn("n_matched", F.aggregate(
                   F.slice("agree", F.col("item_start") + 1, F.col("n_tokens")), F.lit(0), lambda x, y: x + y)))
    best = F.max_by(F.struct(F.col("diagonal"), "item_start", "n_tokens", "n_matched"),
                    F.struct("n_matched", -F.col("diagonal")))
    return (checked.groupBy("doc_id", "row", "item_id").agg(best.alias("x"))
            .select("doc_id", "item_id", (F.col("x.diagonal") + F.col("x.item_start")).alias("doc_start"),
                    F.col("x.item_start").alias("item_start"), F.col("x.n_tokens").alias("n_tokens"),
                    F.col("x.n_matched").alias("n_matched")))


_SPACED = (r"regexp_replace(lower(coalesce(text, '')), '([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])', "
           r"' \1 ', 'g')")
_TOKENS = rf"list_filter(regexp_split_to_array({_SPACED}, '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"

#: Every token of every text against every equal token of every item.
_SQL = rf"""
WITH i AS (SELECT item_id, len(w) AS m, w FROM (SELECT item_id, {_TOKENS} AS w FROM benchmark) WHERE len(w) >= 2),
n AS (SELECT *, least(m, {WINDOW}) AS wlen,
  least(m, {WINDOW}) - CASE WHEN m >= {SHORTEST_INEXACT} THEN CAST(floor(least(m, {WINDOW}) * 0.2 + 1e-9) AS INT) ELSE 0 END AS must FROM i),
it AS (SELECT item_id, m, wlen, must, unnest(w) AS t, generate_subscripts(w, 1) - 1 AS j FROM n),
dt AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) - 1 AS p FROM (SELECT doc_id, {_TOKENS} AS w FROM documents)),
c AS (SELECT doc_id, item_id, any_value(m) AS m, any_value(wlen) AS wlen, any_value(must) AS must, p - j AS diag, list(j) AS js
  FROM dt JOIN it USING (t) GROUP BY doc_id, item_id, p - j HAVING count(*) >= any_value(must)),
s AS (SELECT *, list_filter(range(0, m - wlen + 1), lambda s: len(list_filter(js, lambda j: j >= s AND j < s + wlen)) >= must) AS ss FROM c),
r AS (SELECT doc_id, item_id, diag, ss[1] AS item_start, ss[-1] - ss[1] + wlen AS n_tokens,
  len(list_filter(js, lambda j: j >= ss[1] AND j < ss[-1] + wlen)) AS n_matched FROM s WHERE len(ss) > 0)
SELECT doc_id, item_id, CAST(diag + item_start AS INT) AS doc_start, CAST(item_start AS INT) AS item_start,
  CAST(n_tokens AS INT) AS n_tokens, CAST(n_matched AS INT) AS n_matched
FROM r QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_matched DESC, diag) = 1"""


@query(_SQL)
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
