"""Conversation repair against a plain search, with runs of all sizes."""

import hashlib
import re
import zlib
from random import Random

import pytest

from landsync.llm import conversations as c

SCHEMA = "conv_id long, turn long, role string, text string, audit string, copies string, part string"
NEXT = {0: 2, 1: 2, 3: 2, 2: 3}
NAMES = {2: "user", 3: "assistant"}


def cheapest(rows):
    """(cost, audit) of (initial, must go, truncated) rows, from the last row to the first."""
    best = {0: (0, ""), 1: (6, "II"), 2: (3, "I"), 3: (0, "")}
    for initial, gone, cut in reversed(rows):
        more, after, best = 3 * cut, best, {}

        def edits(s):
            yield 4 + after[s][0], "D" + after[s][1]
            if gone:
                return
            if initial == "s" and s == 0:
                yield more + after[1][0], "K" + after[1][1]
            cost, audit = after[NEXT[s]]
            if initial == NAMES[NEXT[s]][0]:
                yield more + cost, "K" + audit
            yield 3 + more + cost, "R" + audit

        for s in range(4):
            at, found = s, []
            for n in range(4):
                found += [(3 * n + cost, "I" * n + audit) for cost, audit in edits(at)]
                at = NEXT[at]
            best[s] = min(found)
    return best[0]


def plainly(rows):
    """Everything the contract asks for, one conversation at a time."""
    said = lambda x: " " if x is None else str(x)
    convs = {}
    for conv, turn, role, text, *_ in rows:
        kept = convs.setdefault(conv, [])
        hit = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        role, text = "user" if hit == 4 else said(role), "" if hit == 1 else said(text)
        text = re.sub("[.!?]", "", text) if hit == 2 else text
        digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
        kept += [(turn is not None, turn or 0, role[:1], digest, turn, role, text)] * {0: 0, 3: 2}.get(hit, 1)
    out = {}
    for conv, kept in convs.items():
        kept.sort(key=lambda r: r[:4])
        seen, marks, faults = set(), [], [0, 0, 0]
        for *_, role, text in kept:
            solid = re.findall("[^\x20\x09-\x0D]", text)
            blank, again = not solid, (role, text) in seen
            cut = not blank and not again and solid[-1] not in ".!?"
            seen.add((role, text))
            faults[0] += blank
            faults[1] += again and not blank
            faults[2] += cut
            marks.append((role[:1], blank or again, cut))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:]))
        turns = [r[4] for r in kept if r[4] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = cheapest(marks)
        lines, state, k = [], 0, 0
        for edit in audit:
            if edit == "I":
                state = NEXT[state]
                lines.append(f"{NAMES[state]}:")
                continue
            role, text = kept[k][5:]
            k += 1
            if edit != "D":
                state = 1 if edit == "K" and state == 0 and role[:1] == "s" else NEXT[state]
                lines.append(f"{role if edit == 'K' else NAMES[state]}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *faults, illegal, cost, audit, digest)
    return out


def talks(seed=0, n=40):
    rng, rows = Random(seed), []
    for conv in range(n):
        for turn in range(rng.choice([0, 1, 2, 5, 9, 40])):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""])
            text = rng.choice(["", " \n", "Yes.", "No", "Why?", f"{turn}!", None, "é" * 3000 + ". "])
            turn = rng.choice([turn, turn, turn, turn + 2, None])
            rows += [(conv if conv else None, turn, role, text, "a", "b", "c")] * rng.choice([1, 1, 1, 2])
    return rows


def named(df):
    return {r["conv_id"]: tuple(r[k] for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                                               "repaired_sha256")) for r in df.collect()}


@pytest.mark.parametrize("size", [1, 3, c.RUN])
def test_repair_equals_plain_search(spark, size):
    rows = talks()
    damaged = c.damaged(spark.createDataFrame(rows, SCHEMA))
    audited = c.repair(damaged, size)
    assert named(c.repaired_digests(damaged, audited)) == plainly(rows)


def test_repaired_rows_follow_the_form_and_carry_what_was_kept(spark):
    rows = talks(1, 25)
    damaged = c.damaged(spark.createDataFrame(rows, SCHEMA))
    audited = c.repair(damaged)
    want, found = plainly(rows), {}
    for r in c.repaired_rows(damaged, audited).collect():
        found.setdefault(r["conv_id"], []).append((r["position"], r["edit"], r["role"], r["text"]))
    for conv, lines in found.items():
        lines.sort()
        assert [p for p, *_ in lines] == list(range(len(lines)))
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for _, _, role, _ in lines))
        assert "".join(e for _, e, *_ in lines) == want[conv][6].replace("D", "")
        text = "\n".join(f"{role}:{text}" for *_, role, text in lines)
        assert hashlib.sha256(text.encode()).hexdigest() == want[conv][7]
    assert all(want[conv][6].strip("D") == "" for conv in set(want) - set(found))


def test_a_long_conversation_of_equal_rows(spark):
    rows = [(7, t, "user" if t % 2 else "assistant", f"{t % 50}.", "", "", "") for t in range(700)]
    damaged = c.damaged(spark.createDataFrame(rows, SCHEMA))
    assert named(c.repaired_digests(damaged, c.repair(damaged, 64))) == plainly(rows)


def test_no_conversations(spark):
    damaged = c.damaged(spark.createDataFrame([], SCHEMA))
    assert c.repaired_digests(damaged, c.repair(damaged)).collect() == []


def test_rules_give_the_matrix_of_what_they_stand_for():
    rng = Random(5)
    sequences = ["".join(rng.choice("xsuaSUAOo") for _ in range(rng.randint(0, 30))) for _ in range(60)]
    grammar = c.Grammar(("ua", chr(c.RULE) * 2, "xx", chr(c.RULE + 1) + "u"))
    matrices = grammar.matrices()
    for s in [*sequences, "ua" * 9 + "u"]:
        plain = c.UNIT
        for symbol in s:
            plain = c.product(plain, c.ROWS[symbol])
        got = c.evaluate(s, grammar, matrices)
        assert [[e and (e[0], str(e[1])) for e in row] for row in got] == [
            [e and (e[0], str(e[1])) for e in row] for row in plain]
        assert c.whole(got) == cheapest([(x.lower() if x in "suaSUA" else "o", x == "x", x.isupper()) for x in s])


def test_pairs_become_rules_by_their_counts(spark):
    grammar = c.re_pair(spark.createDataFrame([("uauaua", 5), ("suxx", 3), ("o", 9), ("", 2)], "symbols string, n long"))
    assert grammar.pairs[0] == "ua" and len(set(grammar.pairs)) == len(grammar.pairs)
    assert all(ord(s) < c.RULE + k for k, pair in enumerate(grammar.pairs) for s in pair)
