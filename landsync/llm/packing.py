"""Packing token sequences by non-negative least squares.

A document is cut at multiples of the window. The lengths of all pieces, rounded up
to a grid, make a histogram of few bins. Combinations of up to three lengths that
fill the window exactly are enumerated, and non-negative least squares solves how
often each is to repeat so that they use up the histogram. The counts are rounded
down, what is left over is packed greedily, largest first, bin by bin; so the plan
is a short list of patterns with repeat counts, whatever the size of the corpus.
Pieces are numbered within their bin, and their number tells pattern and sequence.

Cases: a null or empty text is one piece with the end id alone. Repeated rows are
documents of their own. An empty table gives no pieces. Text that looks like a
special token is ordinary text.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from landsync.llm.common import settled, table
from landsync.llm.registry import query

WINDOW, GRID, PARTS, END_ID = 1024, 8, 3, 0
BINS = WINDOW // GRID
#: Pieces of a bin that are numbered together, and words whose ids a worker keeps.
CHUNK, KEPT_WORDS = 2_000_000, 300_000

_SPACE_IN_SPACE = re.compile(r"\s ")


class Words(dict):
    """Token ids of a word, as little-endian unsigned 32-bit bytes, worked out once."""

    def __init__(self, encode: Callable[[str], list[int]], lead: str) -> None:
        super().__init__()
        self.encode, self.lead = encode, lead

    def __missing__(self, word: str) -> bytes:
        if len(self) >= KEPT_WORDS:
            self.clear()
        ids = array("I", self.encode(self.lead + word)).tobytes()
        if len(word) < 64:
            self[word] = ids
        return ids


class Ids:
    """A space after anything but white space begins a new piece of the tokenizer's
    pattern, so a text can be cut there and its words encoded one by one. A text
    with a space after other white space is encoded whole, and one that holds an added
    token of the tokenizer's file by the tokenizer itself."""

    def __init__(self, ranks: str, tokenizer: str) -> None:
        self.tokenizer, self.loaded = tokenizer, None
        with open(tokenizer, encoding="utf-8") as f:
            self.added = [t["content"] for t in json.load(f)["added_tokens"]]
        with open(ranks, "rb") as f:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges,
                                        special_tokens={}).encode_ordinary
        self.spaced = Words(self.encode, " ")

    def of(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(t in text for t in self.added):
            self.loaded = self.loaded or Tokenizer.from_file(self.tokenizer)
            return array("I", self.loaded.encode(text, add_special_tokens=False).ids).tobytes()
        if _SPACE_IN_SPACE.search(text):
            return array("I", self.encode(text)).tobytes()
        first, *rest = text.split(" ")
        return array("I", self.encode(first)).tobytes() + b"".join(map(self.spaced.__getitem__, rest))


def cut(docs: DataFrame, text: str = "text", key: str = "doc_id", ranks: str | None = None,
        tokenizer: str | None = None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) per piece. ``ranks`` and ``tokenizer`` are the vocabulary's files."""
    ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Ids(ranks, tokenizer)
        for batch in batches:
            rows: list[tuple] = []
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = tokens.of(t) + end
                n = len(ids) // 4
                for s in range(0, n, WINDOW):
                    piece = ids[4 * s:4 * (s + WINDOW)]
                    rows.append((doc, s, len(piece) // 4, zlib.crc32(piece), n))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            columns = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises |ax - b|, by the active set method of Lawson and Hanson
    on the normal equations; a trace on their diagonal keeps them solvable."""
    gram, right = a.T @ a + 1e-9 * np.eye(a.shape[1]), a.T @ b
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(3 * a.shape[0]):
        pull = np.where(active, -np.inf, right - gram[:, active] @ x[active])
        if pull.max() <= 1e-9:
            break
        active[pull.argmax()] = True
        while active.any():
            s = np.linalg.solve(gram[np.ix_(active, active)], right[active])
            if s.min() > 0:
                x[active] = s
                break
            old = x[active]
            down = s <= 0
            step = (old[down] / np.maximum(old[down] - s[down], 1e-300)).min()
            x[active] = old + step * (s - old)
            gone = active & (x <= 1e-12)
            x[gone], active[gone] = 0, False
    return x


def combinations() -> np.ndarray:
    """Columns count the bins of each combination of up to PARTS that fills the window exactly."""
    out = []

    def grow(taken: tuple[int, ...], room: int) -> None:
        if room == 0:
            out.append(np.bincount(taken, minlength=BINS + 1))
        elif len(taken) < PARTS:
            for b in range(taken[-1] if taken else 1, room + 1):
                grow((*taken, b), room - b)

    grow((), BINS)
    return np.array(out).T


def plan(histogram: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Patterns (pieces of each bin) with repeat counts that use up the histogram; index = bin."""
    left = histogram.astype(np.int64).copy()
    out: list[tuple[np.ndarray, int]] = []
    if left.sum() == 0:
        return out
    ways = combinations()
    times = nnls(ways[1:].astype(float), left[1:] / left.sum()) * left.sum()
    for k in np.argsort(-times, kind="stable"):
        used = ways[:, k] > 0
        if (n := min(int(times[k] + 1e-6), int((left[used] // ways[used, k]).min()))) > 0:
            out.append((ways[:, k], n))
            left -= n * ways[:, k]
    while left.any():  # each turn uses up a bin, or leaves it less than a pattern takes
        pattern, room = np.zeros_like(left), BINS
        for b in range(BINS, 0, -1):
            pattern[b] = min(left[b], room // b)
            room -= pattern[b] * b
        used = pattern > 0
        n = int((left[used] // pattern[used]).min())
        out.append((pattern, n))
        left -= n * pattern
    return out


class Slots:
    """From bin and number within it to the sequence."""

    def __init__(self, patterns: list[tuple[np.ndarray, int]]) -> None:
        self.of: list[tuple[list[int], list[int], list[int]]] = [([], [], []) for _ in range(BINS + 1)]
        used, sequence = np.zeros(BINS + 1, np.int64), 0
        for pattern, n in patterns:
            for b in np.nonzero(pattern)[0]:
                first, of, each = self.of[b]
                first.append(int(used[b]))
                of.append(sequence)
                each.append(int(pattern[b]))
            used += n * pattern
            sequence += n

    def sequences(self, bins: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        out = np.zeros(len(bins), np.int64)
        for b in np.unique(bins):
            first, of, each = (np.array(x, np.int64) for x in self.of[b])
            here = bins == b
            k = np.searchsorted(first, numbers[here], side="right") - 1
            out[here] = of[k] + (numbers[here] - first[k]) // each[k]
        return out


def pack(docs: DataFrame, text: str = "text", key: str = "doc_id", ranks: str | None = None) -> DataFrame:
    """The pieces with sequence_id and offset."""
    pieces = settled(cut(docs, text, key, ranks).withColumn("bin", F.ceil(F.col("length") / GRID).cast("int")), "pieces")
    counts = {r["bin"]: r["n"] for r in pieces.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = Slots(plan(np.array([counts.get(b, 0) for b in range(BINS + 1)])))
    chunks = max(1, -(-sum(counts.values()) // CHUNK))
    dealt = pieces.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "start"), F.lit(chunks)))
    before = Window.partitionBy("bin").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy("bin", "chunk").agg(F.count(F.lit(1)).alias("n"))
               .select("bin", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    within = Window.partitionBy("bin", "chunk").orderBy("doc_id", "start", "length", "ids_crc32")
    numbered = dealt.withColumn("n", F.row_number().over(within)).join(offsets, ["bin", "chunk"]).select(
        *pieces.columns, (F.col("before") + F.col("n") - 1).alias("number"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, numbers = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("bin", "number"))
            yield batch.append_column("sequence_id", pa.array(slots.sequences(bins, numbers)))

    placed = numbered.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, bin int, number long, "
        "sequence_id long")
    order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "number")
    so_far = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return placed.withColumn("offset", F.coalesce(so_far, F.lit(0))).drop("bin", "number")


@query()
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
