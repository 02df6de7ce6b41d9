"""Repeated substrings removed across documents, by blockwise suffix sorting.

Every string of ``DEPTH`` bytes that starts in a document with a smaller id is
removed wherever it stands later. Suffixes are put into buckets by the least hash
among the GRAM-byte strings of their first DEPTH bytes: equal strings have equal
buckets, and suffixes of one bucket stand in runs, so a run of windows (its
*context*) goes into the bucket as one piece of text.

1. Texts that repeat whole are folded: only the copy with the least id goes on.
2. Documents are dealt over blocks by id. Each block sends the keys of its buckets,
   each key once, and learns which of them other texts have too.
3. For these, each block sends each of its contexts once with the least id that has
   it, compressed; the hash is worked out again from the bytes. A task takes one bucket after the other, sorts its suffixes (see ``suffixes``;
   long ties are settled by ranks of a difference cover), and returns for every
   window the least id with the same bytes.
4. A block marks what is covered by windows with an earlier owner.

A key that very many blocks have would gather contexts without bound. Its windows go
one by one, each to the bucket of its own bytes, where equal ones count once a block.

Cases: a null text counts as empty. A document with a null id is left whole, and none
counts as later than it; such rows are in no block. Rows that repeat an id don't remove
from each other; they are dealt by id and text, so one id's texts spread over blocks.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landsync.llm.common import table
from landsync.llm.registry import query
from landsync.llm.suffixes import least_owner

DEPTH, GRAM = 50, 24
#: Bytes of text of a block, of what is hashed at a time, and of keys (one in 14 bytes) of a bucket.
BLOCK, STEP, BUCKET_TEXT = 4 << 20, 1 << 17, 12 << 20
#: Windows of a context at most; blocks from which on a key's windows go one by one.
LONGEST, HOT_BLOCKS = 64, 64
#: In place of a length: a single window of such a key.
ALONE = 255

ADDED = ("kept", "n_bytes", "n_removed", "n_spans")

_RNG = np.random.default_rng(50)
_BYTE = _RNG.integers(1 << 63, size=256, dtype=np.uint64)
_ODD = _RNG.integers(1 << 63, size=6, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _hashes(data: np.ndarray) -> np.ndarray:
    """The hash of the GRAM bytes at each place."""
    h = _BYTE[data]
    h = h[:-1] * _ODD[0] + h[1:]
    h = h[:-2] * _ODD[1] + h[2:]
    h8 = h[:-4] * _ODD[2] + h[4:]
    h = h8[:-8] * _ODD[3] + h8[8:]
    h = h[:-8] * _ODD[4] + h8[16:]
    h = (h ^ (h >> np.uint64(32))) * _ODD[5]
    h ^= h >> np.uint64(29)
    return h


def _least_hashes(data: np.ndarray) -> np.ndarray:
    """By window of DEPTH bytes: the least hash of its GRAM-byte strings."""
    h = _hashes(data)
    for step in (1, 2, 4, 8):
        h = np.minimum(h[:-step], h[step:])
    span = DEPTH - GRAM + 1 - 16
    return np.minimum(h[:-span], h[span:])


def _runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, hash) of each run; no run crosses the end of a document."""
    if len(data) < DEPTH:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = _least_hashes(data)
    # a window fits if none of the places after its first one, to its last, begins a document
    fits = np.ones(len(h), bool)
    for e in ends[:-1]:
        fits[max(0, e - DEPTH + 1):e] = False
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (fits[1:] != fits[:-1])
    new[ends[ends < len(h)]] = True
    begin = np.flatnonzero(new & fits)
    last = np.ones(len(h), bool)
    last[:-1] = new[1:]
    stop = np.flatnonzero(last & fits) + 1
    parts = -(-(stop - begin) // LONGEST)  # periodic text makes long runs
    of = np.repeat(np.arange(len(begin)), parts)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = begin[of] + nth * LONGEST
    return begin, np.minimum(stop[of] - begin, LONGEST), h[begin]


def _steps(docs: list[tuple[int, bytes]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Documents joined to pieces of about STEP bytes: (index of the first, bytes, ends)."""
    at = 0
    while at < len(docs):
        size, hi = 0, at
        while hi < len(docs) and (hi == at or size + len(docs[hi][1]) <= STEP):
            size += len(docs[hi][1])
            hi += 1
        part = docs[at:hi]
        yield (at, np.frombuffer(b"".join(d for _, d in part), np.uint8), np.cumsum([len(d) for _, d in part]))
        at = hi


def _packed(a: np.ndarray) -> bytes:
    return zstandard.compress(a.tobytes(), 1)


def _unpacked(b: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(b), kind)


def _table(rows: list[tuple], names: str, *kinds: pa.DataType) -> pa.Table:
    columns = list(zip(*rows)) or [[]] * len(kinds)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names.split())


_ABOUT = "block bucket doc flags owners"


def _about(part: pa.Table, flags: list | None, owners: list | None) -> pa.Table:
    """Rows that go back to the blocks: what is known of a bucket."""
    blank = [None] * len(part)
    return pa.Table.from_arrays([
        part.column("block"), part.column("bucket"), pa.array(blank, pa.int64()), pa.array(flags or blank, pa.binary()),
        pa.array(owners or blank, pa.binary())], _ABOUT.split())


class Block:
    """The first copies among a block's documents, their runs and keys, in an order that is the same each time."""

    def __init__(self, left: pa.Table, right: pa.Table, text: str, key: str, buckets: int) -> None:
        self.buckets = buckets
        self.ids = left.column(key).to_pylist()
        self.texts = [(t or "").encode("utf-8", "replace") for t in left.column(text).to_pylist()]
        rows = right.filter(pc.equal(right.column("bucket"), -1)) if len(right) else right
        firsts = set(rows.column("doc").to_pylist())
        self.docs = sorted((i, t) for i, t in zip(self.ids, self.texts) if i in firsts and i is not None)
        #: Of each run: its document, its place there, its windows, its hash and its key.
        found = []
        for first, data, ends in _steps(self.docs):
            begin, windows, h = _runs(data, ends)
            doc = np.searchsorted(ends, begin, side="right")
            found.append((doc + first, begin - np.append(0, ends)[doc], windows, h))
        whole = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)]
        self.doc, self.place, self.windows, self.hash = whole
        # the bucket in the high half, 32 bits of the hash in the low one
        self.key = ((self.hash >> np.uint64(33)) % np.uint64(buckets) << np.uint64(32)) | (self.hash & np.uint64(0xFFFFFFFF))
        order = np.argsort(self.key, kind="stable")  # documents stay in order
        k, doc = self.key[order], self.doc[order]
        new = np.ones(len(k), bool)
        new[1:] = k[1:] != k[:-1]
        self.keys = k[new]
        self.group = np.empty(len(k), np.int64)  # of each run: the number of its key
        self.group[order] = np.cumsum(new) - 1
        starts = np.flatnonzero(new)
        #: Whether two of the block's documents have the key.
        self.twice = doc[starts] != doc[np.append(starts[1:], len(k)) - 1] if len(k) else np.zeros(0, bool)

    def bounds(self) -> np.ndarray:
        return np.searchsorted(self.keys, np.arange(self.buckets + 1, dtype=np.uint64) << np.uint64(32))

    def contexts(self, right: pa.Table) -> Iterator[tuple[int, int, int, bytes]]:
        """(document, place, bucket's hash, bytes) of each run that other texts share."""
        shared, hot, bounds = np.zeros(len(self.keys), bool), np.zeros(len(self.keys), bool), self.bounds()
        for b, flags in zip(right.column("bucket").to_pylist(), right.column("flags").to_pylist()):
            if flags is not None:
                lo, hi = bounds[b], bounds[b + 1]
                both = np.unpackbits(_unpacked(flags, np.uint8), count=2 * int(hi - lo)).astype(bool)
                shared[lo:hi], hot[lo:hi] = both[:hi - lo], both[hi - lo:]
        take = np.flatnonzero(shared[self.group])
        ends = (self.place[take] + self.windows[take] + DEPTH - 1).tolist()
        texts = [t for _, t in self.docs]
        for d, s, e, h, one in zip(self.doc[take].tolist(), self.place[take].tolist(), ends, self.hash[take].tolist(),
                                   hot[self.group[take]].tolist()):
            if not one:
                yield d, s, h, texts[d][s:e]
                continue
            for p in range(s, e - DEPTH + 1):
                window = texts[d][p:p + DEPTH]
                yield d, p, xxhash.xxh64_intdigest(window), window

    def distinct(self, contexts: Iterable[tuple[int, int, int, bytes]]) -> dict[tuple[int, bytes], int]:
        """The least id by (hash, bytes), in the order of first places. Documents come by rising id."""
        least: dict[tuple[int, bytes], int] = {}
        for d, _, h, c in contexts:
            if (h, c) not in least:
                least[h, c] = self.docs[d][0]
        return least

    def bucket(self, h: int) -> int:
        return (h >> 33) % self.buckets


def send_keys(left: pa.Table, right: pa.Table, text: str, key: str, buckets: int) -> pa.Table:
    """A block's keys, bucket by bucket."""
    rows = []
    if len(left):
        block, name = Block(left, right, text, key, buckets), left.column("__block")[0].as_py()
        bounds = block.bounds()
        for b in range(buckets):
            lo, hi = bounds[b], bounds[b + 1]
            if lo < hi:
                low = block.keys[lo:hi].astype(np.uint32)
                rows.append((name, b, _packed(np.diff(low, prepend=np.uint32(0))), _packed(np.packbits(block.twice[lo:hi]))))
    return _table(rows, "block bucket keys twice", pa.int32(), pa.int32(), pa.binary(), pa.binary())


def compare_keys(part: pa.Table) -> pa.Table:
    """For each block, which of its keys of this bucket other texts have, and which very many have."""
    lists = [np.cumsum(_unpacked(k, np.uint32), dtype=np.uint32) for k in part.column("keys").to_pylist()]
    twice = [np.unpackbits(_unpacked(t, np.uint8), count=len(k)).astype(bool)
             for t, k in zip(part.column("twice").to_pylist(), lists)]
    every, inverse, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    shared = counts > 1
    shared |= np.bincount(inverse, weights=np.concatenate(twice), minlength=len(every)) > 0
    hot, flags, at = counts >= HOT_BLOCKS, [], 0
    for k in lists:
        own = inverse[at:at + len(k)]
        flags.append(_packed(np.packbits(np.concatenate([shared[own], hot[own]]))))
        at += len(k)
    return _about(part, flags, None)


def send_contexts(left: pa.Table, right: pa.Table, text: str, key: str, buckets: int) -> pa.Table:
    """A block's distinct contexts, bucket by bucket, with the least id that has each."""
    by: dict[int, list[tuple]] = defaultdict(list)
    name = left.column("__block")[0].as_py() if len(left) else -1
    if len(left) and len(right):
        block = Block(left, right, text, key, buckets)
        for (h, c), i in block.distinct(block.contexts(right)).items():
            by[block.bucket(h)].append((i, c, len(c) == DEPTH and h == xxhash.xxh64_intdigest(c)))
    rows = [(name, b, len(x), pack_contexts(x)) for b, x in by.items()]
    return _table(rows, "block bucket count contexts", pa.int32(), pa.int32(), pa.int32(), pa.binary())


def pack_contexts(contexts: list[tuple[int, bytes, bool]]) -> bytes:
    """One compressed value of (id, bytes, whether a single window of a very common key): lengths,
    steps between ids (which rise in a block), bytes."""
    ids = np.array([i for i, _, _ in contexts], np.int64)
    lengths = np.array([ALONE if alone else len(c) - DEPTH for _, c, alone in contexts], np.uint8)
    steps = np.diff(ids, prepend=np.int64(0)).view(np.uint8).reshape(-1, 8).T  # by byte: the high ones are zeros
    return zstandard.compress(lengths.tobytes() + steps.tobytes() + b"".join(c for _, c, _ in contexts), 3)


def unpack_contexts(packed: bytes, count: int) -> Iterator[tuple[int, bytes, bool]]:
    data = zstandard.decompress(packed)
    lengths = np.frombuffer(data, np.uint8, count).astype(np.int64)
    alone = lengths == ALONE
    ends = np.cumsum(np.where(alone, 0, lengths) + DEPTH) + 9 * count
    steps = np.frombuffer(data, np.uint8, 8 * count, count).reshape(8, count).T
    at = 9 * count
    ids = np.cumsum(np.ascontiguousarray(steps).view(np.int64).ravel())
    for i, end, one in zip(ids.tolist(), ends.tolist(), alone.tolist()):
        yield i, data[at:end], one
        at = end


def _anchors(contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The least hash of the GRAM-byte strings of each context, and where it first stands."""
    anchors, hashes = np.zeros(len(contexts), np.int64), np.zeros(len(contexts), np.uint64)
    sizes = np.array([len(c) for c in contexts])
    for lo in range(0, len(contexts), 10_000):
        n = sizes[lo:lo + 10_000]
        ends = np.cumsum(n)
        h = _hashes(np.frombuffer(b"".join(contexts[lo:lo + 10_000]), np.uint8))
        of = np.repeat(np.arange(len(n)), n)[:len(h)]
        h[np.arange(len(h)) + GRAM > ends[of]] = np.iinfo(np.uint64).max  # runs over the end of its context
        least = np.minimum.reduceat(h, ends - n)
        places = np.flatnonzero(h == least[of])
        which, first = np.unique(of[places], return_index=True)
        anchors[lo + which] = places[first] - (ends - n)[which]
        hashes[lo:lo + len(n)] = least
    return anchors, hashes


def sort_bucket(part: pa.Table) -> pa.Table:
    """For each block and window of its contexts in this bucket, the least id with the same bytes."""
    index: dict[bytes, int] = {}
    owner: list[int] = []
    alone: list[bool] = []
    places: list[np.ndarray] = []
    for packed, count in zip(part.column("contexts").to_pylist(), part.column("count").to_pylist()):
        own = []
        for i, c, one in unpack_contexts(packed, count):
            k = index.setdefault(c, len(owner))
            if k == len(owner):
                owner.append(i)
                alone.append(one)
            elif i < owner[k]:
                owner[k] = i
            own.append(k)
        places.append(np.array(own))
    windows = np.array([len(c) - DEPTH + 1 for c in index])
    least, sorts = np.repeat(owner, windows), ~np.array(alone)
    contexts = [c for c, one in zip(index, alone) if not one]  # single windows are settled: equal ones met in the index
    if contexts:
        anchors, hashes = _anchors(contexts)
        least[np.repeat(sorts, windows)] = least_owner(contexts, anchors, hashes, np.array(owner)[sorts], DEPTH)
    ends = np.cumsum(windows)
    owners = []
    for own in places:
        n = windows[own]
        take = np.repeat(ends[own] - n - (np.cumsum(n) - n), n) + np.arange(n.sum())
        owners.append(_packed(least[take]))
    return _about(part, None, owners)


def remove(left: pa.Table, right: pa.Table, text: str, key: str, buckets: int, whole_characters: bool) -> pa.Table:
    """The block's rows with what is left of their texts."""
    block = Block(left, right, text, key, buckets)
    lists = {b: _unpacked(o, np.int64) for b, o in zip(*(right.column(c).to_pylist() for c in ("bucket", "owners")))
             if o is not None}
    cover = {k: np.zeros(len(t) + 1, np.int32) for k, (_, t) in enumerate(block.docs)}
    if lists:
        found = list(block.contexts(right))
        by: dict[int, list[tuple[int, bytes]]] = defaultdict(list)
        for h, c in block.distinct(found):
            by[block.bucket(h)].append((h, c))
        where: dict[tuple[int, bytes], tuple[int, int, np.ndarray, int]] = {}
        for b, contexts in by.items():
            sizes = np.array([len(c) - DEPTH + 1 for _, c in contexts])
            starts = np.cumsum(sizes) - sizes
            low, high = np.minimum.reduceat(lists[b], starts), np.maximum.reduceat(lists[b], starts)
            for x, a, z, s in zip(contexts, low.tolist(), high.tolist(), starts.tolist()):
                where[x] = a, z, lists[b], s
        for d, place, h, c in found:
            (low, high, least, s), own = where[h, c], block.docs[d][0]
            if high < own:  # all windows are later copies
                cover[d][place] += 1
                cover[d][place + len(c)] -= 1
            elif low < own:
                for p in np.flatnonzero(least[s:s + len(c) - DEPTH + 1] < own).tolist():
                    cover[d][place + p] += 1
                    cover[d][place + p + DEPTH] -= 1
    covers = {doc: np.cumsum(cover[k][:-1]) > 0 for k, doc in enumerate(block.docs)}
    kept, removed, spans = [], [], []
    for i, t in zip(block.ids, block.texts):
        gone = covers.get((i, t))
        if gone is None:  # a copy of an earlier text, too short to hold a window, or without an id
            gone = np.full(len(t), len(t) >= DEPTH and i is not None)
        if whole_characters and gone.any():
            lead = np.flatnonzero((np.frombuffer(t, np.uint8) & 0xC0) != 0x80)
            gone = np.repeat(np.logical_and.reduceat(gone, lead), np.diff(np.append(lead, len(t))))
        kept.append(np.frombuffer(t, np.uint8)[~gone].tobytes() if gone.any() else t)
        removed.append(int(gone.sum()))
        spans.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
    out = left.drop_columns(["__block"])
    for name, column in zip(ADDED, (pa.array(kept, pa.binary()), pa.array([len(t) for t in block.texts], pa.int64()),
                                    pa.array(removed, pa.int64()), pa.array(spans, pa.int64()))):
        out = out.append_column(name, column)
    return out


def sweep(docs: DataFrame, text: str = "text", key: str = "doc_id", whole_characters: bool = False) -> DataFrame:
    """``docs`` with ``kept`` (what is left, as bytes), n_bytes, n_removed and n_spans; columns of
    these names are replaced. With ``whole_characters`` a character goes only if all its bytes do."""
    docs = docs.drop(*ADDED)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks, buckets = max(1, -(-size // BLOCK)), max(1, -(-size // BUCKET_TEXT))
    of = {"text": text, "key": key, "buckets": buckets}
    dealt = lambda i, h: F.pmod(F.xxhash64(i, h), F.lit(blocks)).cast("int")
    digest = F.xxhash64(F.col(text).cast("binary"))
    of_block = (docs.where(F.col(key).isNotNull())
                .withColumn("__block", dealt(F.col(key).cast("long"), digest)).groupBy("__block"))
    about = "block int, bucket int, doc long, flags binary, owners binary"
    firsts = (docs.where(F.col(key).isNotNull() & (F.octet_length(text) >= DEPTH))
              .groupBy(F.sha2(F.col(text).cast("binary"), 256).alias("digest"), digest.alias("h"))
              .agg(F.min(key).cast("long").alias("doc"))
              .select(dealt(F.col("doc"), F.col("h")).alias("block"), F.lit(-1).alias("bucket"), "doc", F.lit(None).cast("binary").alias("flags"), F.lit(None).cast("binary").alias("owners")))
    flags = (of_block.cogroup(firsts.groupBy("block"))
             .applyInArrow(lambda a, b: send_keys(a, b, **of), "block int, bucket int, keys binary, twice binary")
             .groupBy("bucket").applyInArrow(compare_keys, about))
    known = firsts.union(flags)
    owners = (of_block.cogroup(known.groupBy("block"))
              .applyInArrow(lambda a, b: send_contexts(a, b, **of),
                            "block int, bucket int, count int, contexts binary")
              .groupBy("bucket").applyInArrow(sort_bucket, about))
    schema = T.StructType([*docs.schema.fields, T.StructField("kept", T.BinaryType()),
                           *(T.StructField(n, T.LongType()) for n in ADDED[1:])])
    swept = of_block.cogroup(known.union(owners).groupBy("block")).applyInArrow(
        lambda a, b: remove(a, b, **of, whole_characters=whole_characters), schema)
    whole = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    return swept.union(docs.where(F.col(key).isNull()).withColumns(
        {"kept": whole, "n_bytes": F.octet_length(whole).cast("long"), "n_removed": F.lit(0).cast("long"),
         "n_spans": F.lit(0).cast("long")}))


@query()
def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sweep(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
