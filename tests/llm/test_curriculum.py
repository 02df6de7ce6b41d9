"""Mixing of sources: targets, places and positions against plain sums."""

import hashlib
import re
from random import Random

import pytest

from landsync.llm import curriculum as c

SCHEMA = "doc_id long, text string, source string, size long, place string, target double, level string"


def rows_of(sizes, seed=0):
    rng, rows = Random(seed), []
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((len(rows), " ".join(["w"] * rng.choice([0, 1, 3, 10, 60])) + "\n ", source, 9, "x", 0.0, "y"))
    return rows


def plain_targets(sizes):
    """Shares by weight, cut at three times the size, the excess shared anew until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, free, left = dict.fromkeys(names, 0.0), set(names), sum(sizes.values())
    while free:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] > 3 * sizes[s]}
        for s in over or free:
            target[s] = 3.0 * sizes[s] if over else share * weight[s]
        left -= sum(target[s] for s in over)
        free = free - over if over else set()
    return target


@pytest.mark.parametrize("sizes", [{"a": 30, "b": 30, "c": 30}, {"a": 400, "b": 5, "c": 9, "d": 60, None: 3, "é": 1},
                                   {"one": 12}, {"": 7, "z": 300}])
def test_each_source_gives_its_target(spark, sizes):
    rows = rows_of(sizes)
    rows += [(None, "one two", "a", 0, "", 0.0, ""), (None, None, "a", 0, "", 0.0, ""), rows[0], rows[0]]
    size = {}
    for _, text, source, *_ in rows:
        size[source] = size.get(source, 0) + len(re.findall("[^\x20\x09-\x0D]+", text or ""))
    want = plain_targets(size)
    got = c.placed(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for source in want:
        own = [r for r in got if r["source"] == source]
        assert all(r["target"] == pytest.approx(want[source]) and r["source_size"] == size[source] for r in own)
        assert abs(sum(r["taken"] for r in own) - want[source]) <= 0.5
        assert all(r["taken"] <= 3 * r["size"] and r["taken"] == sum(t["words"] for t in r["takes"]) for r in own)


def test_positions_use_up_the_schedule(spark):
    rows = rows_of({"a": 80, "b": 80, "c": 80, "d": 10}, 3)
    order = c.training_order(c.placed(spark.createDataFrame(rows, SCHEMA)))
    parts = order.rdd.glom().map(lambda part: [tuple(r) for r in part]).collect()
    flat = [r for part in parts for r in part]
    assert flat == sorted(flat, key=lambda r: r[:2])
    for k, source in enumerate("abcd"):
        own, schedule = [r for r in flat if r[2] == source], c.SCHEDULES[k % 3]
        total, before = sum(r[4] for r in own), 0
        for position, *_, words in own:  # a sum over small steps gives the share used up to the position
            steps = 4000
            area = 0.0
            for i in range(steps):
                t = position * (i + 0.5) / steps
                (t0, r0), (t1, r1) = next((a, b) for a, b in zip(schedule.knots, schedule.knots[1:]) if t <= b[0])
                area += (r0 + (r1 - r0) * (t - t0) / (t1 - t0)) * position / steps
            assert area / schedule.weight == pytest.approx(before / total, abs=2e-3)
            before += words


def test_order_of_a_source_is_by_digest_and_reruns_agree(spark):
    rows = rows_of({"a": 40}, 5)
    runs = [[tuple(r) for r in c.training_order(c.placed(spark.createDataFrame(x, SCHEMA).repartition(n))).collect()]
            for x, n in ((rows, 3), (rows[::-1], 5))]
    assert runs[0] == runs[1]
    ids = [r[1] for r in runs[0]]
    assert ids == sorted(ids, key=lambda i: hashlib.md5(str(i).encode()).hexdigest())


def test_nothing_to_mix(spark):
    assert c.placed(spark.createDataFrame([], SCHEMA)).collect() == []
    got = c.placed(spark.createDataFrame([(1, None, None, 0, "", 0.0, ""), (2, " ", "b", 0, "", 0.0, "")], SCHEMA)).collect()
    assert [(r["size"], r["target"], r["taken"], r["takes"]) for r in got] == [(0, 0.0, 0, [])] * 2


@pytest.mark.parametrize("knots", [((0.0, 1.0),), ((0.0, 1.0), (0.5, 1.0)), ((0.0, 1.0), (1.0, 0.0)), ((0.0, 1.0), (0.0, 2.0), (1.0, 1.0))])
def test_schedules_are_checked(knots):
    with pytest.raises(ValueError):
        c.Schedule(knots)
