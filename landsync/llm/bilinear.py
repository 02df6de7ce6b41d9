"""A log-bilinear language model trained by noise-contrastive estimation.

Training counts every word of the training texts. The most frequent ones, and classes
of the others, are the model's symbols; a class holds words with equally hashed
endings, and within it a word has its share of the class's counts, plus one. From the
two symbols before, a vector is predicted, as the sum of their vectors scaled by
position; its products with all symbols' vectors, plus a bias each, give the odds of
the next symbol.

Noise-contrastive estimation learns the vectors: each symbol is told from noise drawn
by frequency, so no sum over all symbols is needed. After a start on a bounded sample
every task trains on all texts of its own, and the tasks' vectors are averaged by
their numbers of tokens. Scores are normalised. A context's odds are products of one
factor for each of its two symbols, so the sums over all symbols, for every pair of
symbols as context, are one matrix product; a token's score is looked up.

Words are split and told apart by Arrow; Python looks at each distinct one of a piece once.

Counts of the FREQUENT most frequent words travel to the tasks; words beyond these
are joined with the count table, by a shuffle.

Cases: a null or empty text is its end alone. Repeated rows are scored, and if they
are for training counted, each for itself. Without training texts the counts are zero
and all symbols are equally likely.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landsync.llm.common import hashed_sample, id_remainder, settled, table
from landsync.llm.registry import query

#: Stands for the end of a text; white space can't be a word.
END = b"\n"
FREQUENT, SYMBOLS, CLASSES, ENDING = 200_000, 1_000, 64, 2
WIDTH, CONTEXT = 24, 2
#: Noise symbols to a batch, tokens of a batch, texts of the first sample and characters of one.
NOISE, BATCH, SAMPLE, SAMPLE_CHARS = 64, 4_096, 3_000, 10_000
#: Step sizes of the first sample and of all texts, and passes over the first sample.
FIRST_RATE, RATE, FIRST_PASSES = 0.05, 0.03, 2
#: Characters of text that are read at once, and symbols whose contexts are multiplied at once.
AT_ONCE, PRODUCTS = 2_000_000, 128
LOG10 = float(np.log(10))


def tokens(text: str | None) -> list[bytes]:
    """A-Z lower-cased; bytes split at U+0020 and U+0009 to U+000D; the end."""
    return [*(text or "").encode("utf-8", "replace").lower().split(), END]


def read_tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(place of each token among the distinct ones, end of each text, distinct tokens), the tokens being
    those of ``tokens``. White space at a text's ends leaves an empty word, which no place names."""
    own = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    found = own.flatten()
    coded, full = found.dictionary_encode(), pc.binary_length(found).to_numpy() > 0
    cuts = np.cumsum(pc.list_value_length(own).to_numpy())
    ends = np.append(0, np.cumsum(full))[cuts] + np.arange(1, len(texts) + 1)
    place = np.full(int(full.sum()) + len(texts), len(coded.dictionary), np.int64)
    inside = np.ones(len(place), bool)
    inside[ends - 1] = False
    place[inside] = coded.indices.to_numpy()[full]
    return place, ends, pa.concat_arrays([coded.dictionary.cast(pa.binary()), pa.array([END], pa.binary())])


def count_tokens(texts: DataFrame) -> DataFrame:
    """(token, c) over all texts, the end counted as a token. Counts are summed in each task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = [], 0
        for batch in batches:
            for texts in _pieces(batch.column(0)):
                place, _, distinct = read_tokens(texts)
                n = np.bincount(place, minlength=len(distinct))
                counts.append(pa.table([distinct.filter(pa.array(n > 0)), pa.array(n[n > 0])], ["token", "c"]))
                rows += len(distinct)
                if rows > 800_000:
                    summed = _summed(counts)
                    counts, rows = [summed], len(summed)
                    if rows > 400_000:
                        yield from summed.to_batches()
                        counts, rows = [], 0
        if counts:
            yield from _summed(counts).to_batches()

    return texts.mapInArrow(run, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


def _summed(counts: list[pa.Table]) -> pa.Table:
    by = pa.concat_tables(counts).group_by("token", use_threads=False).aggregate([("c", "sum")])
    return by.select(["token", "c_sum"]).rename_columns(["token", "c"])


def _class_of(token: bytes) -> int:
    return zlib.crc32(token[-ENDING:]) % CLASSES


@dataclass
class Words:
    """The frequent words with their counts, and what holds for all others."""

    ranked: pa.Array  # binary, by index
    count: np.ndarray  # by index
    symbol: np.ndarray  # by index
    symbols: int  # words that are symbols of their own; the classes come after them
    log_class: np.ndarray  # by class: log10 of counts in it, plus one for each word and one
    total: int
    distinct: int

    @property
    def size(self) -> int:
        return self.symbols + CLASSES

    @property
    def index(self) -> dict[bytes, int]:
        return {w: k for k, w in enumerate(self.ranked.to_pylist())}

    def look_up(self, place: np.ndarray, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(index or -1, symbol) of each token"""
        index = pc.index_in(distinct, self.ranked).fill_null(-1).to_numpy().astype(np.int64)
        symbol = self.symbol[index]
        rare = index < 0
        endings = pc.binary_slice(distinct.filter(pa.array(rare)), -ENDING).dictionary_encode()
        classes = np.array([_class_of(w) for w in endings.dictionary.to_pylist()], np.int64)
        symbol[rare] = self.symbols + classes[endings.indices.to_numpy()]
        return index[place], symbol[place]


def gather(counts: DataFrame) -> Words:
    """From the stored count table: totals, sums by class, and the bounded list of frequent words."""
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    # few bins tell from which count on words are few enough; only these are collected
    bins = counts.groupBy(F.floor(F.log2("c") * 64).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, seen = 1 << 30, 0
    for r in sorted(bins, key=lambda r: -r["bin"]):
        seen += r["n"]
        if seen > FREQUENT:
            break
        least = r["bin"]
    top = counts.where(F.floor(F.log2("c") * 64) >= least).collect()
    top.sort(key=lambda r: (-r["c"], bytes(r["token"])))
    ranked = [END, *(w for w in (bytes(r["token"]) for r in top) if w != END)]
    by = {bytes(r["token"]): r["c"] for r in top}
    count = np.array([by.get(w, 0) for w in ranked], np.int64)
    symbols = min(SYMBOLS, len(ranked))
    own = set(ranked[:symbols])
    ending = F.expr(f"crc32(substring(token, -{ENDING}, {ENDING})) % {CLASSES}")
    sums = {r["k"]: (r["c"], r["n"]) for r in counts.groupBy(ending.alias("k")).agg(
        F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect()}
    mass = np.array([sum(sums.get(k, (0, 0))) for k in range(CLASSES)], float)
    for w in own:
        if w in by:
            mass[_class_of(w)] -= by[w] + 1
    symbol = np.array([k if k < symbols else symbols + _class_of(w) for k, w in enumerate(ranked)], np.int64)
    return Words(pa.array(ranked, pa.binary()), count, symbol, symbols, np.log10(mass + 1), total, distinct)


class Model:
    """Vectors of symbols as next ones (out) and as context (into; the last row stands for the start)."""

    def __init__(self, prior: np.ndarray) -> None:
        rng = np.random.default_rng(4)
        n = len(prior)
        self.noise = (prior + 1) / (prior + 1).sum()
        self.out = rng.normal(0, 0.05, (n, WIDTH)).astype(np.float32)
        self.into = rng.normal(0, 0.3, (n + 1, WIDTH)).astype(np.float32)
        self.scale = np.full((CONTEXT, WIDTH), 0.5, np.float32)
        self.bias = np.log(self.noise).astype(np.float32)
        self.past = [np.zeros(x.shape) for x in self.parts()]
        self.tables: tuple[np.ndarray, np.ndarray] | None = None  # of the vectors as they are

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.out, self.into, self.scale, self.bias

    def values(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parts()])

    def load(self, values: np.ndarray) -> Model:
        at = 0
        for x in self.parts():
            x[...] = values[at:at + x.size].reshape(x.shape)
            at += x.size
        self.tables = None
        return self

    def contexts(self, symbol: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The CONTEXT symbols before each one, a row each, the nearest first; the start before a text begins."""
        begin = np.append(0, ends[:-1])
        out = np.full((CONTEXT, len(symbol)), len(self.out), np.int64)
        for k in range(CONTEXT):
            out[k, k + 1:] = symbol[:-k - 1]
            for first in (begin + j for j in range(k + 1)):
                out[k, first[first < ends]] = len(self.out)
        return out

    def learn(self, symbol: np.ndarray, ends: np.ndarray, rate: float, rng: np.random.Generator) -> None:
        """One pass of noise-contrastive estimation; a batch shares its noise."""
        shuffled = rng.permutation(len(symbol))
        # symbols are few: as short numbers they stay in the cache while they are mixed
        w_all = symbol.astype(np.int32)[shuffled]
        c_all = self.contexts(symbol, ends).astype(np.int32)[:, shuffled]
        log_noise = np.log(NOISE * self.noise).astype(np.float32)
        draw = self.noise.cumsum()
        n = len(self.out)
        self.tables = None
        for lo in range(0, len(symbol), BATCH):
            w, c = w_all[lo:lo + BATCH].astype(np.int64), c_all[:, lo:lo + BATCH].astype(np.int64)
            noise = np.minimum(draw.searchsorted(rng.random(NOISE)), len(draw) - 1)
            offset = self.bias - log_noise
            # the last column, of ones, carries the bias
            q = np.ones((len(w), WIDTH + 1), np.float32)
            q[:, :WIDTH] = sum(np.take(self.into * s, at, axis=0) for s, at in zip(self.scale, c))
            r, rn = np.take(self.out, w, axis=0), self.out[noise]
            up = _sigmoid_of_minus(np.einsum("ij,ij->i", q[:, :WIDTH], r) + offset[w])
            down = _sigmoid_of_minus(q @ -np.column_stack([rn, offset[noise]]).T)
            dq = up[:, None] * r
            dq -= down @ rn
            out = _sums(w, up[:, None] * q, n) - _sums(noise, down.T @ q, n)
            # a vector of context moves by the same change in each position, but for the position's scale
            into = [_sums(at, dq, n + 1) for at in c]
            scale = np.stack([np.einsum("ij,ij->j", x, self.into) for x in into])
            self._step(0, out[:, :WIDTH], rate)
            self._step(1, sum(x * s for x, s in zip(into, self.scale)), rate)
            self._step(2, scale, rate)
            self._step(3, out[:, WIDTH], rate)

    def _step(self, k: int, total: np.ndarray, rate: float) -> None:
        """Adaptive steps: each value moves by its sum of changes over the root of all squared ones so far."""
        to, past = self.parts()[k], self.past[k]
        past += total * total
        to += (rate * total / np.sqrt(past + 1e-8)).astype(np.float32)

    def _tables(self) -> tuple[np.ndarray, np.ndarray]:
        """(odds of the next symbol by position, symbol there and next one; log of a context's sum over all next ones)"""
        if self.tables is None:
            odds = np.stack([(self.into * s) @ self.out.T for s in self.scale])
            second = odds[1].astype(float)
            top = second.max(axis=1)
            factor = np.exp(second - top[:, None]).T
            whole = np.empty((len(self.into), len(self.into)), np.float32)
            for lo in range(0, len(whole), PRODUCTS):
                first = odds[0][lo:lo + PRODUCTS].astype(float) + self.bias
                own = first.max(axis=1)[:, None]
                sums = np.exp(first - own) @ factor
                # where no symbol is likely after both, all products may be too small
                small = np.argwhere(sums < 1e-200)
                sums[small[:, 0], small[:, 1]] = 1
                sums = np.log(sums) + own + top
                for a, b in small:
                    both = first[a] + second[b]
                    sums[a, b] = both.max() + np.log(np.exp(both - both.max()).sum())
                whole[lo:lo + PRODUCTS] = sums
            self.tables = odds, whole
        return self.tables

    def log10(self, symbol: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """log10 of each symbol's normalised probability."""
        odds, whole = self._tables()
        near, far = self.contexts(symbol, ends)
        return (odds[0][near, symbol] + odds[1][far, symbol] + self.bias[symbol] - whole[near, far]).astype(float) / LOG10


def _sigmoid_of_minus(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(x)), in the argument's place."""
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _sums(rows: np.ndarray, change: np.ndarray, size: int) -> np.ndarray:
    """Changes summed by row."""
    width = change.shape[1]
    flat = np.take(np.arange(size * width).reshape(size, width), rows, axis=0)
    return np.bincount(flat.ravel(), change.ravel(), size * width).reshape(size, width)


def _pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of about AT_ONCE characters."""
    lo = size = 0
    for k, n in enumerate(pc.utf8_length(texts).fill_null(0).to_pylist()):
        if k > lo and size + n > AT_ONCE:
            yield texts[lo:k]
            lo, size = k, 0
        size += n
    if lo < len(texts):
        yield texts[lo:]


def train(texts: DataFrame, words: Words) -> Model:
    """First on a bounded sample of distinct texts; then on all, in every task, averaged."""
    spark = texts.sparkSession
    prior = np.bincount(words.symbol, words.count, words.size)
    classes = 10 ** words.log_class - 1
    prior[words.symbols:] = np.maximum(prior[words.symbols:], classes)
    model = Model(prior)
    sample = hashed_sample(texts.select(F.substring("text", 1, SAMPLE_CHARS).alias("text")), int(words.count[0]), SAMPLE, "text")
    first = sorted(r[0] for r in sample.where(F.col("text").isNotNull()).distinct().limit(2 * SAMPLE).collect())
    place, ends, distinct = read_tokens(pa.array(first, pa.string()))
    _, symbol = words.look_up(place, distinct)
    rng = np.random.default_rng(5)
    for _ in range(FIRST_PASSES if first else 0):
        model.learn(symbol, ends, FIRST_RATE, rng)
    start, past, shared = model.values(), model.past, spark.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own, draw, seen = shared.value, Model(prior).load(start), np.random.default_rng(6), 0
        own.past = [x.copy() for x in past]
        for batch in batches:
            for piece in _pieces(batch.column(0)):
                place, ends, distinct = read_tokens(piece)
                _, symbol = known.look_up(place, distinct)
                own.learn(symbol, ends, RATE, draw)
                seen += len(symbol)
        if seen:
            values = own.values().astype(float)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values * seen),
                                              pa.array(np.full(len(values), float(seen)))], ["k", "v", "n"])

    averaged = texts.mapInArrow(run, "k long, v double, n double").groupBy("k").agg(
        (F.sum("v") / F.sum("n")).alias("v")).toPandas()
    if len(averaged):
        start[averaged["k"].to_numpy()] = averaged["v"].to_numpy()
    return model.load(start)


def score(docs: DataFrame, model: Model, words: Words, counts: DataFrame, text: str = "text", key: str = "doc_id"
          ) -> DataFrame:
    """Per row: doc_id, n_tokens, n_known, base_score, score."""
    spark = docs.sparkSession
    shared, known = spark.sparkContext.broadcast(model), spark.sparkContext.broadcast(words)
    log_base = float(np.log10(words.total + words.distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, lbl = known.value, shared.value
        weight = np.log10(of.count + 1.0)
        inside = np.where(of.symbol >= of.symbols, weight - of.log_class[np.maximum(of.symbol - of.symbols, 0)], 0.0)
        for batch in batches:
            lo = 0
            for piece in _pieces(batch.column(2)):
                place, ends, distinct = read_tokens(piece)
                index, symbol = of.look_up(place, distinct)
                n = np.diff(np.append(0, ends))
                doc = np.repeat(np.arange(len(n)), n)
                frequent = index >= 0
                rare = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(~frequent)[ends - 1]), pa.int32()),
                    distinct.take(pa.array(place[~frequent])))
                base = np.bincount(doc, np.where(frequent, weight[index], 0.0), len(n))
                seen = np.bincount(doc, frequent & (of.count[index] > 0), len(n)).astype(np.int64)
                # of other words the class's part is known here, the word's count is not
                within = np.where(frequent, inside[index], -of.log_class[np.maximum(symbol - of.symbols, 0)])
                full = np.bincount(doc, lbl.log10(symbol, ends) + within, len(n))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k)[lo:lo + len(piece)] for k in (0, 1)), pa.array(n), pa.array(seen),
                     pa.array(base - n * log_base), pa.array(full), rare],
                    ["row", "doc_id", "n_tokens", "n_known", "base_score", "score", "rare"])
                lo += len(piece)

    # the row's number is made once, as it is stored with the row's results
    scored = settled(docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"),
                                 F.col(text).alias("text")).mapInArrow(
        run, f"row long, doc_id {dict(docs.dtypes)[key]}, n_tokens long, n_known long, base_score double, score double, "
             "rare array<binary>"), "scored")
    others = (scored.select("row", F.explode("rare").alias("token")).join(counts, "token")
              .groupBy("row").agg(F.count(F.lit(1)).alias("more"), F.sum(F.log10(F.col("c") + 1.0)).alias("log")))
    more, log = F.coalesce("more", F.lit(0)), F.coalesce("log", F.lit(0.0))
    return scored.drop("rare").join(others, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + more).alias("n_known"), (F.col("base_score") + log).alias("base_score"),
        (F.col("score") + log).alias("score"))


def is_held_out(key: str = "doc_id") -> Column:
    return F.coalesce(id_remainder(key, 7) == 2, F.lit(False))


@query()
def op4_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    training = docs.where(~is_held_out()).select("text")
    counts = settled(count_tokens(training), "token-counts")
    words = gather(counts)
    model = train(training, words)
    return score(docs, model, words, counts).select(
        "doc_id", is_held_out().alias("held_out"), "n_tokens", "n_known", F.lit(words.total).cast("long").alias("train_tokens"),
        "base_score", "score")
