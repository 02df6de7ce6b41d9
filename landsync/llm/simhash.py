"""SimHash near-duplicates by vantage-point trees.

Each text gets a 64-bit fingerprint of its word shingles. Equal fingerprints are
folded into one class. A vantage-point tree, made from a bounded sample of the
classes, cuts the space into shards: at each node, what lies within the radius of
the vantage point goes inside, the rest outside. Two fingerprints within ``bits``
of each other that fall on different sides both lie within ``bits`` of the border
(triangle inequality), so the outer one is also sent inside. Every pair thus meets
in a shard, where a tree of the shard's own finds the pairs exactly. A shard
returns a spanning forest of its links, never its pairs; components follow by
alternating stars.

Cases: a null text counts as empty; texts without words have fingerprint zero and
are linked like any other. With fewer words than a shingle has, the whole sequence
is the only shingle. Rows that repeat an id are judged row by row. Rows with a null
id take part; a component of null ids only has a null id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from landsync.llm.common import hashed_sample, settled, table
from landsync.llm.components import components
from landsync.llm.registry import query

SHINGLE, BITS, SEED = 3, 2, 42
#: Classes a shard should get, sampled classes to a shard, and the most shards of the tree.
SHARD, SAMPLED, MAX_SHARDS = 4_096, 16, 16_384
#: Classes up to which a shard's own tree compares all.
LEAF = 512

_ONES = np.uint64(0x0101010101010101)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    w = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and U+0009-U+000D, U+0020 alone
    if not w:
        return 0
    grams = map(b" ".join, zip(*(w[i:] for i in range(shingle)))) if len(w) >= shingle else [b" ".join(w)]
    h = np.array([xxh64_intdigest(g, SEED) for g in grams], np.uint64)
    n = len(h)
    h = np.concatenate([h, np.zeros(-n % 255, np.uint64)]).reshape(-1, 255)
    # a byte of (h >> b) & ONES counts one bit; 255 of them can't overflow it
    sums = np.stack([((h >> np.uint64(b)) & _ONES).sum(axis=1, dtype=np.uint64) for b in range(8)])
    counts = sums.view(np.uint8).reshape(8, -1, 8).sum(axis=1, dtype=np.int64)  # [bit of byte, byte]
    on = (counts.T.ravel() * 2 > n).astype(np.uint64)
    return int((on << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, fp long")


@dataclass
class Tree:
    """Node i has the children 2i+1 (inside) and 2i+2 (outside); the last level's are the shards."""

    depth: int
    vantage: np.ndarray
    radius: np.ndarray

    def deal(self, fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(index into fp, shard) of each fingerprint in its own shard and in those it borders."""
        index, node = np.arange(len(fp)), np.zeros(len(fp), np.int64)
        for _ in range(self.depth):
            far = np.bitwise_count(fp[index] ^ self.vantage[node]).astype(np.int64) - self.radius[node]
            border = (far > 0) & (far <= bits)
            node = np.concatenate([np.where(far > 0, 2 * node + 2, 2 * node + 1), 2 * node[border] + 1])
            index = np.concatenate([index, index[border]])
        return index, node - (2 ** self.depth - 1)


def _vantage(fp: np.ndarray, bits: int, rng: np.random.Generator) -> tuple[np.uint64, int]:
    """Of a few candidates the one with the fewest fingerprints on its border; the radius is the median."""
    best = None
    for v in fp[rng.integers(len(fp), size=8)]:
        d = np.bitwise_count(fp ^ v)
        r = int(np.median(d))
        cost = int(((d > r) & (d <= r + bits)).sum()) + abs(int((d <= r).sum()) * 2 - len(fp))
        if best is None or cost < best[0]:
            best = (cost, v, r)
    return best[1], best[2]


def plant(sample: np.ndarray, depth: int, bits: int) -> Tree:
    vantage, radius = np.zeros(2 ** depth - 1, np.uint64), np.full(2 ** depth - 1, 64, np.int64)
    rng = np.random.default_rng(SEED)
    parts = {0: sample}
    for node in range(2 ** depth - 1):
        part = parts.pop(node, np.zeros(0, np.uint64))
        if len(part) > 1:
            vantage[node], radius[node] = _vantage(part, bits, rng)
        inside = np.bitwise_count(part ^ vantage[node]) <= radius[node]
        parts[2 * node + 1], parts[2 * node + 2] = part[inside], part[~inside]
    return Tree(depth, vantage, radius)


def _near(fp: np.ndarray, index: np.ndarray, bits: int, rng: np.random.Generator) -> Iterator[np.ndarray]:
    """Blocks of pairs of indexes within ``bits``; a pair may come more than once."""
    n = len(index)
    if n > LEAF:
        v, r = _vantage(fp[index], bits, rng)
        far = np.bitwise_count(fp[index] ^ v).astype(np.int64) - r
        inside, outside = index[far <= bits], index[far > 0]
        if max(len(inside), len(outside)) <= 0.9 * n:
            yield from _near(fp, inside, bits, rng)
            yield from _near(fp, outside, bits, rng)
            return
    own = fp[index]
    for i in range(0, n, 256):
        a, b = np.nonzero(np.bitwise_count(own[i:i + 256, None] ^ own[None, :]) <= bits)
        a += i
        keep = a < b
        yield np.stack([index[a[keep]], index[b[keep]]])


def forest(fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For every fingerprint linked to another one, itself and the root of its tree."""
    root = list(range(len(fp)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for block in _near(fp, np.arange(len(fp)), bits, np.random.default_rng(SEED)):
        for a, b in block.T.tolist():
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    roots = np.array([find(x) for x in range(len(fp))], np.int64)
    moved = roots != np.arange(len(fp))
    return fp[moved], fp[roots[moved]]


def near_links(classes: DataFrame, n: int, bits: int = BITS) -> DataFrame:
    """(a, b) links between the distinct fingerprints ``fp``, enough to connect all within ``bits``."""
    shards = min(MAX_SHARDS, max(1, -(-n // SHARD)))
    depth = (shards - 1).bit_length()
    sample = hashed_sample(classes, n, SAMPLED << depth, "fp").select("fp").toPandas()["fp"]
    tree = plant(np.sort(sample.to_numpy(np.int64).view(np.uint64)), depth, bits)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            index, shard = tree.deal(fp, bits)
            yield pa.RecordBatch.from_arrays([pa.array(fp[index].view(np.int64)), pa.array(shard)], ["fp", "shard"])

    def link(part: pd.DataFrame) -> pd.DataFrame:
        a, b = forest(np.sort(part["fp"].to_numpy(np.int64).view(np.uint64)), bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return (classes.select("fp").mapInArrow(deal, "fp long, shard long")
            .groupBy("shard").applyInPandas(link, "a long, b long"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE,
                    bits: int = BITS) -> DataFrame:
    """(doc_id, fp, component_id) per row of ``docs``; component_id is the smallest id that links reach."""
    prints = settled(fingerprints(docs, text, key, shingle), "fingerprints")
    classes = settled(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(near_links(classes, classes.count(), bits))
    rooted = classes.join(roots, classes["fp"] == roots["a"], "left").select(
        "fp", "least", F.coalesce("b", "fp").alias("root"))
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.join(of_root, "root").select("fp", "component_id"), "fp")


@query()
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
