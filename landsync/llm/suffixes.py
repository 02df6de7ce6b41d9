"""Sorting suffixes of one bucket after the other, with a difference cover for long ties."""

from __future__ import annotations

from functools import cmp_to_key

import numpy as np

#: A perfect difference set modulo 31 (fixed values): every difference of two residues is one of two members.
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)
#: Windows sorted at a time; a bucket with more is sorted alone.
BATCH = 200_000

_IN_COVER = np.isin(np.arange(PERIOD), COVER)
#: Steps from a residue to the next member, and to a place where two residues both are members.
_STEP = np.array([next(k for k in range(PERIOD) if _IN_COVER[(r + k) % PERIOD]) for r in range(PERIOD)])
_BOTH = np.array([[next(k for k in range(PERIOD) if _IN_COVER[(a + k) % PERIOD] and _IN_COVER[(b + k) % PERIOD])
                   for b in range(PERIOD)] for a in range(PERIOD)])


def _words(text: np.ndarray, at: np.ndarray, n: int) -> list[np.ndarray]:
    """The n bytes at each place as big-endian words, first word first."""
    wide = -(-n // 8) * 8
    rows = np.lib.stride_tricks.sliding_window_view(text, wide)[at]
    rows[:, n:] = 0
    return list(rows.view(">u8").astype(np.uint64).T)


def _starts_run(*keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _sample_ranks(text: np.ndarray) -> np.ndarray:
    """By place: the rank of the suffix there among those at places of the cover, told apart by
    2 * PERIOD bytes; 0 elsewhere. Blocks of PERIOD bytes are named in order, then pairs of names."""
    places = np.flatnonzero(_IN_COVER[np.arange(len(text) - 2 * PERIOD - 8) % PERIOD])
    rank = np.zeros(len(text), np.int64)
    words = _words(text, places, PERIOD)
    order = np.lexsort(words[::-1])
    rank[places[order]] = np.cumsum(_starts_run(*(w[order] for w in words)))
    first, second = rank[places], rank[places + PERIOD]
    order = np.lexsort((second, first))
    out = np.zeros(len(text), np.int64)
    out[places[order]] = np.cumsum(_starts_run(first[order], second[order]))
    return out


def _classes(contexts: list[bytes], anchor: np.ndarray, bucket: np.ndarray, windows: np.ndarray, depth: int
             ) -> tuple[np.ndarray, np.ndarray]:
    """Order of all windows by bucket and text, and where in it a new text of ``depth`` bytes begins.

    Contexts are laid out with their anchors at places of one residue, so that equal windows mostly
    have equal residues too and the same step leads both to the cover.
    """
    lead = -anchor % PERIOD
    sizes = np.array([len(c) for c in contexts])
    slots = -(-(lead + sizes + 2 * PERIOD + 40) // PERIOD) * PERIOD
    offset = np.cumsum(slots) - slots + lead
    text = np.zeros(slots.sum() + 2 * PERIOD + 8, np.uint8)
    text[np.repeat(offset - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())] = np.frombuffer(
        b"".join(contexts), np.uint8)
    first = np.cumsum(windows) - windows
    at = np.repeat(offset - first, windows) + np.arange(windows.sum())
    bucket = np.repeat(bucket, windows)
    rank, residue = _sample_ranks(text), at % PERIOD
    tie, head = rank[at + _STEP[residue]], _words(text, at, PERIOD)
    order = np.lexsort([tie, residue, *head[::-1], bucket])
    group = np.cumsum(_starts_run(bucket[order], *(h[order] for h in head)))  # equal in the first PERIOD bytes
    begins = np.flatnonzero(_starts_run(group, residue[order], tie[order]))
    # runs of a group with other residues are put in order through a place that both have in the cover
    run_group, run_residue = group[begins], residue[order][begins]
    leader = at[order[begins]]
    sequence = np.arange(len(begins))

    def compare(x: int, y: int) -> int:
        k = _BOTH[leader[x] % PERIOD, leader[y] % PERIOD]
        return int(rank[leader[x] + k] - rank[leader[y] + k])

    mixed = np.flatnonzero((run_group[1:] == run_group[:-1]) & (run_residue[1:] != run_residue[:-1]))
    for g in np.unique(run_group[mixed]):
        lo, hi = np.searchsorted(run_group, (g, g + 1))
        sequence[lo:hi] = sorted(range(lo, hi), key=cmp_to_key(compare))
    new = _starts_run(bucket[order[begins[sequence]]], *_words(text, leader[sequence], depth))
    length = np.diff(np.append(begins, len(order)))[sequence]
    ends = np.cumsum(length)
    moved = np.repeat(begins[sequence] - (ends - length), length) + np.arange(len(order))
    return order[moved], (ends - length)[new]


def least_owner(contexts: list[bytes], anchor: np.ndarray, bucket: np.ndarray, owner: np.ndarray, depth: int
                ) -> np.ndarray:
    """For every window (context by context) the least owner of a context of the same bucket that
    holds the same ``depth`` bytes. Windows of other buckets are never equal in the caller's sense.

    Buckets are sorted one at a time, or several small ones together, so memory follows the
    largest bucket alone. ``anchor`` is a place in each context; any choice is right, and one that
    falls on the same byte of equal windows is fast.
    """
    windows = np.array([len(c) - depth + 1 for c in contexts])
    out = np.repeat(owner, windows)
    first = np.cumsum(windows) - windows
    order = np.argsort(bucket, kind="stable")
    ends = np.append(np.flatnonzero(np.diff(bucket[order])) + 1, len(order))
    batch: list[np.ndarray] = []
    size = lo = 0
    for k, hi in enumerate(ends):
        if hi - lo > 1:  # a bucket of one context has nothing to find
            batch.append(order[lo:hi])
            size += int(windows[order[lo:hi]].sum())
        lo = hi
        if batch and (size >= BATCH or k == len(ends) - 1):
            take = np.concatenate(batch)
            sub = windows[take]
            ranked, starts = _classes([contexts[i] for i in take], anchor[take], bucket[take], sub, depth)
            owners = np.repeat(owner[take], sub)[ranked]
            least = np.minimum.reduceat(owners, starts)
            places = np.repeat(first[take] - (np.cumsum(sub) - sub), sub) + np.arange(sub.sum())
            out[places[ranked]] = np.repeat(least, np.diff(np.append(starts, len(ranked))))
            batch, size = [], 0
    return out
