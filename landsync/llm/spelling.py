"""Spelling variants by a variable-length gram index.

The words of all texts are counted, and words one edit apart are linked. The index is made
of grams of two to LONGEST code points. Its dictionary comes from a bounded sample of the
words: a gram that is frequent there is extended by its frequent longer forms, a rare
one is not, so that short lists stay short and long lists are split. A word is decomposed
by taking the longest gram at each position, and dropping those that lie inside an earlier
one. The dictionary decides only how fast the index is, never what it finds.

An edit affects the grams that contain it, and those next to it that a longer gram could
now swallow: the dictionary's prefixes and suffixes tell which. The most grams that any
single edit affects is a word's bound. Two words one edit apart share all grams but those, so
each needs to send only its ``bound + 1`` rarest grams to the lists, and the pair meets in one.
A gram is filed with its distances from both ends of the word; the longer of two words has
one of them larger by one, so it is filed for either. Words whose bound leaves no gram over are
also filed among themselves by their three rarest pairs of letters; of a word's L - 1 pairs an
edit spares all but two.

A list of more than HOT words is dealt again by half words: the one edit leaves the first or
the last half as it is. What meets in a list is verified by its edit distance.

Cases: a null text has no words; a null id is empty in the key of the damage. Rows that repeat
an id are damaged alike and each counts. Of near words with equal counts the first in code-point
order is the form. Texts without words and empty tables give no rows; extra columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landsync.llm.common import hashed_sample, settled, small, table
from landsync.llm.registry import query

#: Code points and occurrences that a word needs, one run in so many is damaged, and how much more frequent a form is.
LETTERS, LEAST, DAMAGED, TIMES = 6, 5, 199, 5
#: Lengths of grams; words sampled for the dictionary; a gram in more than one in EXTENDED sampled words is extended
#: by those longer forms that stand in KEPT words or more.
SHORTEST, LONGEST, SAMPLED, EXTENDED, KEPT = 2, 4, 200_000, 200, 20
#: Words a list may have before it is dealt by half words; distinct words that a task counts before it sends them on.
HOT, HELD = 64, 500_000
#: Marks the pairs of letters of words that the bound leaves no gram.
WEAK = "\x00"

_RUN = re.compile(f"[a-zÀ-ÿ]{{{LETTERS},}}")


# ---- words

def _runs(text: str) -> Iterable[str]:
    folded = text.encode().lower().decode()  # bytes: A-Z alone
    return _RUN.findall(folded) if len(folded) < 1 << 20 else (m.group() for m in _RUN.finditer(folded))


def words_of(doc_id, text: str | None) -> Iterator[tuple[str, int]]:
    """The words of a text after the contract's damage, with their counts; a word may come twice."""
    begun = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(_runs(text or "")).items():
        h = zlib.crc32(run.encode(), begun)
        if h % DAMAGED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= LETTERS:
            yield run, n


def vocabulary(docs: DataFrame, text: str = "text", key: str = "doc_id", least: int = LEAST) -> DataFrame:
    """(word, n) of all words with at least ``least`` occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                              ["word", "n"])

        for batch in batches:
            for doc_id, said in zip(*(c.to_pylist() for c in batch.columns)):
                for word, n in words_of(doc_id, said):
                    held[word] += n
                if len(held) >= HELD:
                    yield sent()
                    held.clear()
        yield sent()

    counted = docs.select(F.col(key), F.col(text)).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# ---- the dictionary and a word's grams

@dataclass(frozen=True)
class Dictionary:
    """Grams of more than two code points, frequencies of grams, and the proper prefixes and suffixes of the former."""

    longer: frozenset[str]
    frequency: dict[str, int]
    prefixes: frozenset[str]
    suffixes: frozenset[str]
    longest: int

    @classmethod
    def of(cls, frequency: dict[str, int], extended: int) -> Dictionary:
        """The dictionary of gram counts: a longer gram is kept where the gram it extends is too frequent."""
        longer: set[str] = set()
        for gram in sorted(frequency, key=len):
            if len(gram) > SHORTEST and frequency.get(gram[:-1], 0) > extended and (
                    len(gram) == SHORTEST + 1 or gram[:-1] in longer):
                longer.add(gram)
        kept = {g: n for g, n in frequency.items() if len(g) == SHORTEST or g in longer}
        return cls(frozenset(longer), kept, frozenset(g[:k] for g in longer for k in range(1, len(g))),
                   frozenset(g[k:] for g in longer for k in range(1, len(g))), max(map(len, longer), default=SHORTEST))

    def decompose(self, word: str) -> list[tuple[str, int]]:
        """(gram, position), longest at each position, none inside an earlier one."""
        out, end, n = [], 0, len(word)
        for p in range(n - SHORTEST + 1):
            q = min(self.longest, n - p)
            while q > SHORTEST and word[p:p + q] not in self.longer:
                q -= 1
            if p + q > end:
                end = p + q
                out.append((word[p:end], p))
        return out

    def affected(self, word: str, grams: list[tuple[str, int]]) -> int:
        """The most grams of the word that one inserted, deleted or replaced code point can affect."""
        starts, ends, most, n = [p for _, p in grams], [p + len(g) for g, p in grams], 0, len(word)
        left, right = [], []
        for i in range(n + 1):
            reach = [p for p in range(max(0, i - self.longest + 1), i) if word[p:i] in self.prefixes]
            left.append(reach[0] if reach else i)
            reach = [e for e in range(i + 1, min(n, i + self.longest - 1) + 1) if word[i:e] in self.suffixes]
            right.append(reach[-1] if reach else i)
        for i in range(n + 1):
            before = bisect_right(ends, i)  # grams that end before code point i
            grown = max(0, before - bisect_left(starts, left[i]))
            inside = bisect_left(starts, i) - before  # those with code points on both sides of a gap before i
            swallowed = max(0, bisect_right(ends, right[i]) - bisect_left(starts, i))
            most = max(most, grown + inside + swallowed)
            if i < n:
                inside = bisect_right(starts, i) - before
                swallowed = max(0, bisect_right(ends, right[i + 1]) - bisect_left(starts, i + 1))
                most = max(most, grown + inside + swallowed)
        return most

    def filed(self, word: str) -> list[tuple[str, int]]:
        """The grams that the word sends to the lists, with their positions."""
        rarest = lambda gp: (self.frequency.get(gp[0], 0), gp)
        grams = self.decompose(word)
        bound = self.affected(word, grams)
        out = sorted(grams, key=rarest)[:bound + 1]
        if bound >= len(grams):
            pairs = sorted(((word[p:p + 2], p) for p in range(len(word) - 1)), key=rarest)
            out += [(WEAK + g, p) for g, p in pairs[:3]]
        return out


def dictionary(words: DataFrame, n: int, longest: int = LONGEST, sampled: int = SAMPLED, extended: int = EXTENDED,
               kept: int = KEPT) -> Dictionary:
    """Grams of a hashed sample of the words. What the driver gets is bounded by the sample: grams in ``kept`` words or more."""
    sample = hashed_sample(words, n, sampled, "word")
    lengths = F.sequence(F.lit(SHORTEST), F.least(F.lit(longest), F.length("word")))
    grams = F.flatten(F.transform(lengths, lambda q: F.transform(
        F.sequence(F.lit(1), F.length("word") - q + 1), lambda p: F.substring(F.col("word"), p, q))))
    counts = (sample.select(F.explode(F.array_distinct(grams)).alias("gram")).groupBy("gram")
              .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= kept).collect())
    return Dictionary.of({r["gram"]: r["n"] for r in counts}, max(kept, min(n, sampled) // extended))


# ---- lists and links

def filed_grams(words: DataFrame, grams: Dictionary) -> DataFrame:
    """(gram, p, r, long, word, n): the lists' rows. p and r are a gram's distances from the word's ends; as the longer
    word of a pair it is filed with either one less."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k, word in enumerate(batch.column(0).to_pylist()):
                for gram, p in grams.filed(word):
                    r = len(word) - p - len(gram.lstrip(WEAK))
                    out.append((gram, p, r, False, k))
                    if p:
                        out.append((gram, p - 1, r, True, k))
                    if r:
                        out.append((gram, p, r - 1, True, k))
            columns = list(zip(*out)) or [[]] * 5
            at = pa.array(columns[4], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()),
                 pa.array(columns[3], pa.bool_()), batch.column(0).take(at), batch.column(1).take(at)],
                ["gram", "p", "r", "long", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "gram string, p int, r int, long boolean, word string, n long")


def near_words(words: DataFrame, grams: Dictionary, hot: int = HOT) -> DataFrame:
    """(a, a_n, b, b_n): each pair of words one edit apart, once."""
    rows = settled(filed_grams(words, grams), "grams")
    lists = ["gram", "p", "r"]
    counts = rows.groupBy(*lists).agg(F.count(F.lit(1)).alias("size"), F.min("long").alias("no_short"))
    counts = settled(counts.where("size > 1 and not no_short"), "lists")
    hot_lists = counts.where(F.col("size") > hot).select(*lists, F.lit(True).alias("hot"))
    cold = rows.join(counts.where(F.col("size") <= hot).select(*lists), lists)
    # the shorter word's length m tells where to halve both words
    m = F.col("p") + F.length(F.translate("gram", WEAK, "")) + F.col("r")
    halves = F.array(F.struct(F.lit("<").alias("side"), F.substring(F.col("word"), F.lit(1), F.floor(m / 2).cast("int")).alias("half")),
                     F.struct(F.lit(">").alias("side"), F.expr("right(word, CAST(ceil(m / 2) AS INT))").alias("half")))
    split = (rows.join(small(hot_lists), lists).withColumn("m", m).withColumn("h", F.explode(halves))
             .select(*lists, "long", "word", "n", "h.side", "h.half"))
    cold = cold.select(*lists, "long", "word", "n", F.lit("").alias("side"), F.lit("").alias("half"))
    keyed = cold.union(split)
    keys = [*lists, "side", "half"]
    short = keyed.where("not long").select(*keys, F.col("word").alias("a"), F.col("n").alias("a_n"))
    other = keyed.select(*keys, F.col("word").alias("b"), F.col("n").alias("b_n"), "long")
    met = short.join(other, keys).where("long or a < b").where(F.levenshtein("a", "b", 1) == 1)
    return met.select("a", "a_n", "b", "b_n").distinct()


# ---- forms and roots

def variants(words: DataFrame, links: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n, root) from the links of near words."""
    both = links.select(F.col("a").alias("word"), "a_n", F.col("b").alias("near"), F.col("b_n").alias("near_n")).union(
        links.select("b", "b_n", "a", "a_n"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    formed = settled(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= times * F.col("n"), F.col("best.near")).alias("form"),
        F.when(-F.col("best.less") >= times * F.col("n"), -F.col("best.less")).alias("form_n")), "forms")
    roots = formed.where("form is not null").select("word", F.col("form").alias("root"))
    # each form is TIMES as frequent as its word, which bounds the steps; a join doubles those that are done
    most = formed.agg(F.max("n")).first()[0] or 1
    steps = max(1, int(math.log(most, times)) + 1)
    for k in range(math.ceil(math.log2(steps))):
        roots = settled(roots, f"roots-{k}")
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = roots.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, text: str = "text", key: str = "doc_id", hot: int = HOT, **fit) -> DataFrame:
    """Every word of the texts with its near words, form and root; ``fit`` goes to ``dictionary``."""
    words = settled(vocabulary(docs, text, key), "words")
    grams = dictionary(words, words.count(), **fit)
    return variants(words, near_words(words, grams, hot))


@query()
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, their near words, forms and roots."""
    return spelling_variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")
