"""Toxicity by a weighted lexicon.

Texts are folded first: letters that look alike become plain Latin ones, digits and
signs that stand for letters become these, capitals small. The lexicon is learned
from labelled texts: folded words and stems (beginnings of words) that hardly any but
toxic texts hold get the logarithm of the ratio of shares as weight. An Aho-Corasick
automaton finds the entries in the whole text; a hit counts only as a whole word, or
for a stem at the beginning of one, and not within an exception phrase. A text's weights, summed and divided by a root of its length, go
through a logistic function fitted to the labelled texts.

Cases: a null text counts as empty; an empty text, or one without hits, gets the
score of no hits. Labels that are null teach nothing. Without labelled toxic texts
the lexicon is empty and all scores are 0. Repeated rows are scored each for itself,
and labels that repeat count once for an id each.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landsync.llm.common import hashed_sample, id_remainder, settled, table
from landsync.llm.registry import query

#: Letters of other scripts by the Latin letter they look like, then digits and signs used for letters (fixed values).
HOMOGLYPHS = {
    "a": "аαɑａ", "b": "Ьвｂ", "c": "сϲｃ", "d": "ԁｄ", "e": "еєεｅ", "f": "ｆ", "g": "ɡｇ", "h": "һｈ", "i": "іιıｉ", "j": "јｊ",
    "k": "кκｋ", "l": "ӏⅼｌ", "m": "мｍ", "n": "пηｎ", "o": "оοσｏ", "p": "рρｐ", "r": "гｒ", "s": "ѕｓ", "t": "тτｔ", "u": "υｕ",
    "v": "ѵνｖ", "w": "ԝωｗ", "x": "хχｘ", "y": "уγｙ", "z": "ｚ",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}

#: Phrases in which an entry is harmless, given in folded form.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "pond scum", "idiot proof", "stupid simple", "sore loser")

#: Letters of a stem. An entry must be in so many toxic texts, and so large a share of the texts that hold it
#: must be toxic.
STEMS, LEAST_TEXTS, PURE = range(3, 11), 3, 0.9
#: A stem gives way to a longer one, or to the word, that keeps this share of its toxic texts.
KEEPS = 0.9
#: Power of a text's word count by which the sum of weights is divided.
LENGTH_POWER = 0.1
#: Labelled texts that are learned from, and of these the ones the logistic is fitted to; chosen by hashed id.
LABELLED, FITTED = 200_000, 50_000
TOXIC_FROM = 0.7

_FOLD = str.maketrans({c: k for k, v in HOMOGLYPHS.items() for c in v + v.upper() if len(c) == 1})
_CODED = re.compile(r"[a-z0134578@$!]*[a-z][a-z0134578@$!]*")
_DECODE = str.maketrans(DIGITS)
_WORD = re.compile(r"[^\W\d_]+")


def _decode(match: re.Match) -> str:
    word = match.group()
    if word.isalpha():
        return word
    body = word.rstrip("!$@")  # signs at the end of a word are punctuation
    return body.translate(_DECODE) + " " * (len(word) - len(body))


def fold(text: str | None) -> str:
    """Small Latin letters where a letter, digit or sign stands for one; as long as the text,
    but for letters whose small form is longer."""
    if not text:
        return ""
    return _CODED.sub(_decode, text.translate(_FOLD).lower())


@dataclass(frozen=True)
class Lexicon:
    """Entries that end in ``$`` are whole words, others stems."""

    weights: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...] = EXCEPTIONS
    slope: float = 1.0
    offset: float = 0.0


class Matcher:
    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon, self.automaton = lexicon, ahocorasick.Automaton()
        for phrase in lexicon.exceptions:
            self.automaton.add_word(phrase, (len(phrase), None, True))
        for entry, weight in lexicon.weights:
            word = entry.rstrip("$")
            self.automaton.add_word(word, (len(word), weight, entry != word))
        if len(self.automaton):
            self.automaton.make_automaton()

    def strength(self, text: str | None) -> float:
        """Weights of the hits over a root of the number of words."""
        folded = fold(text)
        if not folded or not len(self.automaton) or not self.lexicon.weights:
            return 0.0
        hits, free = [], []
        for end, (n, weight, whole) in self.automaton.iter(folded):
            start = end - n + 1
            if (start and folded[start - 1].isalpha()) or (whole and folded[end + 1:end + 2].isalpha()):
                continue
            if weight is None:
                free.append((start, end))
            else:
                hits.append((start, end, weight))
        if not hits:
            return 0.0
        total, k = 0.0, 0
        free.sort()
        for start, end, weight in hits:  # hits come by end; phrases are few and don't nest
            while k < len(free) and free[k][1] < end:
                k += 1
            if not (k < len(free) and free[k][0] <= start):
                total += weight
        return total / max(1, len(folded.split())) ** LENGTH_POWER

    def score(self, text: str | None) -> float:
        if not self.lexicon.weights:
            return 0.0
        z = self.lexicon.slope * self.strength(text) + self.lexicon.offset
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton's method, with a slight pull towards zero."""
    design = np.stack([x, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -40, 40)))
        gradient = design.T @ (p - y) + 1e-2 * w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def entries_of(text: str | None) -> set[str]:
    """Every word and stem of the folded text."""
    found = set(_WORD.findall(fold(text)))
    return {w[:n] for w in found for n in STEMS if n <= len(w)} | {w + "$" for w in found if len(w) >= STEMS[0]}


def count_entries(rows: DataFrame) -> DataFrame:
    """(entry, bad, good): in how many toxic and other texts it stands, if in LEAST_TEXTS toxic ones or more.
    Counts are summed in each task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter[str], Counter[str]] = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            entries = list(counts[1] | counts[0])
            out = pa.RecordBatch.from_arrays(
                [pa.array(entries, pa.string()), *(pa.array([counts[k][e] for e in entries], pa.int64()) for k in (1, 0))],
                ["entry", "bad", "good"])
            for c in counts:
                c.clear()
            return out

        for batch in batches:
            for t, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[toxic].update(entries_of(t))
                if len(counts[0]) + len(counts[1]) > 500_000:
                    yield flush()
        yield flush()

    summed = rows.select("text", "toxic").mapInArrow(run, "entry string, bad long, good long")
    return summed.groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).where(
        F.col("bad") >= LEAST_TEXTS)


def choose(bad: dict[str, int], good: dict[str, int], n_bad: int, n_good: int) -> list[tuple[str, float]]:
    """From the counts of toxic and other texts: the shortest pure entries, each made as long as it
    can be without losing toxic texts; what begins with one of them is left out."""
    ratio = {e: ((n + 0.01) / n_bad) / ((good.get(e, 0) + 0.5) / n_good) for e, n in bad.items()}
    children: dict[str, list[str]] = defaultdict(list)
    for e in bad:
        children[e[:-1]].append(e)
    out, covered = [], set()
    for e in sorted(bad, key=lambda e: (len(e.rstrip("$")), e)):
        if bad[e] < PURE * (bad[e] + good.get(e, 0)) or any(e[:k] in covered for k in range(STEMS[0], len(e))):
            continue
        covered.add(e)
        while longer := [c for c in children[e] if bad[c] >= KEEPS * bad[e]]:
            e = max(longer, key=lambda c: (bad[c], c))
        out.append((e, math.log(max(ratio[e], 1.0))))
    return out


def chosen(rows: DataFrame, n_bad: int, n_good: int) -> list[tuple[str, float]]:
    """What ``choose`` takes. Entries with the same beginning are chosen among in one task, so that only
    what enters the lexicon is collected."""
    # a pure entry's longer forms lose KEEPS of its toxic texts a letter at most, and gain no other texts
    purest = PURE * KEEPS ** (len(STEMS) + 1) / (1 - PURE)

    def run(part: pd.DataFrame) -> pd.DataFrame:
        bad, good = (dict(zip(part["entry"], part[c].tolist())) for c in ("bad", "good"))
        return pd.DataFrame(choose(bad, good, n_bad, n_good), columns=["entry", "weight"]).astype({"weight": float})

    counted = count_entries(rows).where(F.col("bad") >= F.col("good") * F.lit(purest))
    kept = counted.groupBy(F.substring("entry", 1, STEMS[0]).alias("begin")).applyInPandas(run, "entry string, weight double")
    return sorted((r["entry"], r["weight"]) for r in kept.collect())


def labelled_texts(docs: DataFrame, labels: DataFrame, text: str = "text", toxic: str = "toxic", key: str = "doc_id"
                   ) -> DataFrame:
    """(doc_id, text, toxic) of at most about LABELLED documents. Their labels are few enough to be
    broadcast, so no text is shuffled."""
    once = settled(labels.where(F.col(toxic).isNotNull() & F.col(key).isNotNull())
                   .groupBy(F.col(key).alias("doc_id")).agg(F.max(toxic).alias("toxic")), "labels")
    few = hashed_sample(once, once.count(), LABELLED, "doc_id")
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(few), "doc_id")


def learn(labelled: DataFrame, text: str = "text", toxic: str = "toxic", key: str = "doc_id",
          exceptions: Sequence[str] = EXCEPTIONS) -> Lexicon:
    """The lexicon from all texts of ``labelled``; the logistic from a bounded number of them."""
    rows = settled(labelled.where(F.col(toxic).isNotNull()).select(
        F.col(key).alias("doc_id"), F.col(text).alias("text"), (F.col(toxic) > 0).cast("int").alias("toxic")), "labelled")
    total, n_bad = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n_bad or n_bad == total:
        return Lexicon((), tuple(exceptions))
    lexicon = Lexicon(tuple(chosen(rows, n_bad, total - n_bad)), tuple(exceptions))
    sample = hashed_sample(rows, total, FITTED, "doc_id")
    seen = strengths(sample, lexicon, "text", "toxic").select("toxic", "strength").toPandas()
    slope, offset = fit_logistic(seen["strength"].to_numpy(float), seen["toxic"].to_numpy(float))
    return Lexicon(lexicon.weights, lexicon.exceptions, slope, offset)


def strengths(docs: DataFrame, lexicon: Lexicon, text: str, *keep: str) -> DataFrame:
    """``keep``, strength and score per row; no shuffle."""
    schema = docs.select(*keep).withColumns({"strength": F.lit(0.0), "score": F.lit(0.0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch in batches:
            texts = batch.column(text).to_pylist()
            found = [matcher.strength(t) for t in texts]
            z = np.clip(np.array(found) * lexicon.slope + lexicon.offset, -40, 40)
            score = 1 / (1 + np.exp(-z)) if lexicon.weights else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(found, pa.float64()),
                                              pa.array(score, pa.float64())], [*keep, "strength", "score"])

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


@query()
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(False))
    lexicon = learn(labelled_texts(docs, labels.where(~held_out)))
    return strengths(docs, lexicon, "text", "doc_id").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))
