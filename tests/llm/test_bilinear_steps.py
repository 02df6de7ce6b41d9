"""The language model's tokens, training steps and scores against plain forms of them."""

import time
import zlib
from random import Random

import numpy as np
import pyarrow as pa
import pytest

from landsync.llm import bilinear

TEXTS = ["", None, " \t x\n", "ÀÉ A\x0bB\x0cC\rD\x1cE\x85F\u00a0G\u2003h", "  ", "x", "İI ß ẞ", "a  A\n\na"]


def some_symbols(n_symbols, lengths, seed=1):
    ends = np.cumsum(lengths)
    return np.random.default_rng(seed).zipf(1.3, ends[-1]) % n_symbols, ends


def plain_contexts(symbol, ends, start):
    out = []
    for lo, hi in zip([0, *ends[:-1]], ends):
        own = [start] * bilinear.CONTEXT + symbol[lo:hi].tolist()
        out += [own[k + bilinear.CONTEXT - 1::-1][:bilinear.CONTEXT] for k in range(hi - lo)]
    return np.array(out).reshape(-1, bilinear.CONTEXT)


def plain_log10(model, symbol, ends):
    before = plain_contexts(symbol, ends, len(model.out))
    q = (model.into[before].astype(float) * model.scale).sum(axis=1)
    odds = q @ model.out.T.astype(float) + model.bias
    top = odds.max(axis=1)
    whole = top + np.log(np.exp(odds - top[:, None]).sum(axis=1))
    return (odds[np.arange(len(symbol)), symbol] - whole) / np.log(10)


def plain_learn(model, symbol, ends, rate, rng):
    """Every sum written out with np.add.at, in double precision."""
    before = plain_contexts(symbol, ends, len(model.out))
    shuffled = rng.permutation(len(symbol))
    parts, past = [x.astype(float) for x in model.parts()], [x.copy() for x in model.past]
    draw, log_noise = model.noise.cumsum(), np.log(bilinear.NOISE * model.noise)
    for lo in range(0, len(symbol), bilinear.BATCH):
        w, c = symbol[shuffled[lo:lo + bilinear.BATCH]], before[shuffled[lo:lo + bilinear.BATCH]]
        noise = np.minimum(draw.searchsorted(rng.random(bilinear.NOISE)), len(draw) - 1)
        out, into, scale, bias = parts
        total = [np.zeros(x.shape) for x in parts]
        q = (into[c] * scale).sum(axis=1)
        up = 1 / (1 + np.exp((q * out[w]).sum(axis=1) + bias[w] - log_noise[w]))
        down = -1 / (1 + np.exp(-(q @ out[noise].T + bias[noise] - log_noise[noise])))
        dq = up[:, None] * out[w] + down @ out[noise]
        np.add.at(total[0], w, up[:, None] * q)
        np.add.at(total[0], noise, down.T @ q)
        for k in range(bilinear.CONTEXT):
            np.add.at(total[1], c[:, k], dq * scale[k])
            total[2][k] = (dq * into[c[:, k]]).sum(axis=0)
        np.add.at(total[3], w, up)
        np.add.at(total[3], noise, down.sum(axis=0))
        for x, t, p in zip(parts, total, past):
            p += t * t
            x += rate * t / np.sqrt(p + 1e-8)
    return np.concatenate([x.ravel() for x in parts])


@pytest.mark.parametrize("lo, hi", [(0, 8), (1, 4), (0, 1), (1, 2), (4, 8), (3, 3)])
def test_tokens_read_at_once_are_the_plain_ones(lo, hi):
    place, ends, distinct = bilinear.read_tokens(pa.array(TEXTS)[lo:hi])
    want = [bilinear.tokens(t) for t in TEXTS[lo:hi]]
    assert [distinct[int(k)].as_py() for k in place] == [w for own in want for w in own]
    assert ends.tolist() == np.cumsum([len(own) for own in want]).tolist()


def test_looked_up_words_have_their_index_and_class():
    names = [bilinear.END, b"a", b"x", "é".encode(), b"seldom"]
    words = bilinear.Words(pa.array(names, pa.binary()), np.array([9, 8, 7, 6, 5]),
                           np.array([0, 1, 2, 3, 4 + bilinear._class_of(b"seldom")]), 4, np.zeros(bilinear.CLASSES), 35, 5)
    rng = Random(2)
    texts = [" ".join(rng.choice(["a", "X", "É", "é", "seldom", "b", "unseen", "ö", "ﬁ"]) for _ in range(40)) for _ in range(9)]
    place, _, distinct = bilinear.read_tokens(pa.array(texts))
    index, symbol = words.look_up(place, distinct)
    own = [w for t in texts for w in bilinear.tokens(t)]
    assert index.tolist() == [words.index.get(w, -1) for w in own]
    assert symbol.tolist() == [words.symbol[words.index[w]] if w in words.index
                               else 4 + zlib.crc32(w[-bilinear.ENDING:]) % bilinear.CLASSES for w in own]


def test_training_steps_are_the_plain_ones(monkeypatch):
    monkeypatch.setattr(bilinear, "BATCH", 100)
    symbol, ends = some_symbols(30, [1, 2, 3, 1, 400, 77, 1])
    model = bilinear.Model(np.bincount(symbol, minlength=30))
    want = plain_learn(model, symbol, ends, 0.05, np.random.default_rng(3))
    model.learn(symbol, ends, 0.05, np.random.default_rng(3))
    assert np.allclose(model.values(), want, atol=2e-4)


def test_scores_are_the_plain_ones_also_after_further_steps_and_far_apart():
    symbol, ends = some_symbols(40, [1, 2, 3, 200, 50])
    model = bilinear.Model(np.bincount(symbol, minlength=40))
    assert np.allclose(model.log10(symbol, ends), plain_log10(model, symbol, ends), atol=1e-4)
    model.learn(symbol, ends, 0.5, np.random.default_rng(3))
    assert np.allclose(model.log10(symbol, ends), plain_log10(model, symbol, ends), atol=1e-4)
    # odds so far apart that the parts' products vanish in double precision
    far = model.values()
    far[:80 * bilinear.WIDTH] *= 60
    model.load(far)
    want = plain_log10(model, symbol, ends)
    assert want.min() < -400 and np.isfinite(want).all()
    assert np.allclose(model.log10(symbol, ends), want, rtol=1e-3, atol=1e-2)


def test_odds_too_far_apart_for_products_are_summed_as_they_are():
    model = bilinear.Model(np.ones(4))
    model.out[:], model.into[:], model.scale[:], model.bias[:] = 0, 0, 1, 0
    # after symbol 0 only symbol 0 is likely, after symbol 1 only symbol 1
    model.out[0, 0] = model.out[1, 1] = model.into[0, 0] = model.into[1, 1] = 40
    symbol, ends = np.array([0, 1, 2, 1, 0, 0]), np.array([3, 6])
    assert np.allclose(model.log10(symbol, ends), plain_log10(model, symbol, ends), atol=1e-3)


def test_scoring_multiplies_no_context_anew():
    symbol, ends = some_symbols(1000, [500] * 400)
    symbol = np.random.default_rng(4).permutation(np.arange(len(symbol)) % 1000)  # nearly all contexts differ
    model = bilinear.Model(np.ones(1064))
    model.log10(symbol[:500], ends[:1])
    begin = time.process_time()
    model.log10(symbol, ends)
    looked_up = time.process_time() - begin
    some = 20
    begin = time.process_time()
    odds = np.ones((ends[some - 1], bilinear.WIDTH), np.float32) @ model.out.T
    np.log(np.exp(odds).sum(axis=1))
    multiplied = (time.process_time() - begin) * len(ends) / some
    assert looked_up < multiplied / 3
