"""Conversation structure repair.

The role initials of a conversation should read ``(s?(ua)+)?``. A row is kept (cost 0),
given the role user or assistant (3) or deleted (4); an empty user or assistant row may
be inserted anywhere (3). Blank rows, and rows whose role and text stood earlier, must be
deleted; a row whose text ends without ``.!?`` costs 3 more unless it is deleted. The
audit is the cheapest edits' initials in order, the least in ASCII order among equals.

A row is one symbol: its role's initial and its fault. A symbol is a 4 x 4 matrix over the
states before any row, after s, after u and after a; an entry holds the least cost of
going from one state to the other and the audit that does so, and matrices multiply by
minimum and sum. Inserted rows stand before a row's own edit, so audits over the same rows
are never prefixes of each other, and the least of two stays the least whatever follows.

Sequences of all conversations are compressed together by Re-Pair: the most frequent
pairs of neighbours become rules, round by round, counted on Spark over the distinct
sequences. Each rule's matrix is worked out once, bottom-up, its audits as ropes that share
their parts. A sequence is then a short product of rule matrices, done once for all
conversations that have it.

Long conversations are cut into runs of at most RUN rows, wherever ranges of the data fall.
Costs go backward over the runs, then the edits are chosen forward: a run is one light row
there. Texts are shuffled once, to be replayed under their conversation's audit in order; a
task streams them and holds one audit and one batch.

Cases: a null id is a conversation of its own; a null turn sorts first and has no part in
gaps; a null role or text is one space, and in the key of the damage so are null id and
turn. Rows of one turn lie by role initial, then by digest of role and text; rows equal in
both are duplicates of the first. A conversation without rows is all zeros, with an empty
audit. Empty tables give no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landsync.llm.common import settled, table
from landsync.llm.registry import query

#: Rows to a run, rules of the grammar and rounds of pair counts.
RUN, RULES, ROUNDS = 4_096, 64, 8
#: First code point of the symbols that stand for rules (private use).
RULE = 0xE000
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
WHITE = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")


# ---- audits and matrices

@dataclass(eq=False)
class Rope:
    """Text as two shared parts; joined when it is first read."""

    left: Rope | None = None
    right: Rope | None = None
    text: str | None = None

    def __str__(self) -> str:
        if self.text is None:
            parts, todo = [], [self]
            while todo:
                rope = todo.pop()
                if rope.text is not None:
                    parts.append(rope.text)
                else:
                    todo += [rope.right, rope.left]
            self.text = "".join(parts)
        return self.text


Entry = tuple[int, Rope] | None
Matrix = list[list[Entry]]


def _least(entries: Iterable[Entry]) -> Entry:
    found = [e for e in entries if e is not None]
    if not found:
        return None
    cost = min(e[0] for e in found)
    found = [e for e in found if e[0] == cost]
    return found[0] if len(found) == 1 else min(found, key=lambda e: str(e[1]))


def product(a: Matrix, b: Matrix) -> Matrix:
    def through(i: int, j: int) -> Iterator[Entry]:
        for k in STATES:
            x, y = a[i][k], b[k][j]
            if x is not None and y is not None:
                yield x[0] + y[0], Rope(x[1], y[1])

    return [[_least(through(i, j)) for j in STATES] for i in STATES]


def _inserts() -> dict[tuple[int, int], tuple[int, str]]:
    """Fewest inserted rows from one state to another."""
    out = {(i, i): (0, "") for i in STATES}
    for i, j, n in ((START, USER, 1), (START, ASSISTANT, 2), (SYSTEM, USER, 1), (SYSTEM, ASSISTANT, 2),
                    (USER, ASSISTANT, 1), (ASSISTANT, USER, 1)):
        out[i, j] = INSERT * n, "I" * n
    return out


INSERTS = _inserts()
#: Cost and audit of what must still be inserted at the end of a conversation.
ENDS = {START: (0, ""), **{i: INSERTS[i, ASSISTANT] for i in (SYSTEM, USER, ASSISTANT)}}


def _row_matrix(symbol: str) -> Matrix:
    def edits(i: int) -> Iterator[tuple[int, int, str]]:
        yield i, DELETE, "D"
        if symbol == "x":
            return
        more, initial = TRUNCATED * symbol.isupper(), symbol.lower()
        if initial == "s" and i == START:
            yield SYSTEM, KEEP + more, "K"
        reached = ASSISTANT if i == USER else USER
        yield (reached, KEEP + more, "K") if initial == ROLES[reached][0] else (reached, REROLE + more, "R")

    ways: dict[tuple[int, int], list[Entry]] = {}
    for (i, k), (cost, audit) in INSERTS.items():
        for j, more, edit in edits(k):
            ways.setdefault((i, j), []).append((cost + more, Rope(text=audit + edit)))
    return [[_least(ways.get((i, j), [])) for j in STATES] for i in STATES]


ROWS = {s: _row_matrix(s) for s in "xsuaoSUAO"}
UNIT: Matrix = [[(0, Rope(text="")) if i == j else None for j in STATES] for i in STATES]


@dataclass(frozen=True)
class Grammar:
    """Pairs in the order in which they became rules; rule k is written ``chr(RULE + k)``."""

    pairs: tuple[str, ...]

    def compress(self, symbols: str) -> str:
        for k, pair in enumerate(self.pairs):
            symbols = symbols.replace(pair, chr(RULE + k))
        return symbols

    def matrices(self) -> dict[str, Matrix]:
        """One matrix a symbol, those of rules from their parts."""
        out = dict(ROWS)
        for k, (a, b) in enumerate(self.pairs):
            out[chr(RULE + k)] = product(out[a], out[b])
        return out


def evaluate(symbols: str, grammar: Grammar, matrices: dict[str, Matrix]) -> Matrix:
    """The matrix of a sequence: neighbours are multiplied pair by pair, so that parts stay of like length."""
    level = [matrices[s] for s in grammar.compress(symbols)] or [UNIT]
    while len(level) > 1:
        level = [product(*level[i:i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def whole(matrix: Matrix) -> tuple[int, str]:
    """Cost and audit of a conversation that is one run."""
    return min((e[0] + ENDS[j][0], str(e[1]) + ENDS[j][1])
               for j, e in enumerate(matrix[START]) if e is not None)


def chosen(costs: list[list[list[int | None]]], ranks: list[list[list[int | None]]]) -> tuple[int, list[tuple[int, int]]]:
    """Cost of a conversation of several runs, and (from, to) of each run in its cheapest edits, least audit first.

    ``ranks`` orders the audits of a run that leave the same state.
    """
    rest = [[ENDS[j][0] for j in STATES]]
    for run in reversed(costs):
        rest.append([min((c + r for c, r in zip(row, rest[-1]) if c is not None), default=None) for row in run])
    rest = [[float("inf") if r is None else r for r in row] for row in reversed(rest)]
    state, path = START, []
    for k, run in enumerate(costs):
        _, _, to = min((c + rest[k + 1][j], ranks[k][state][j], j) for j, c in enumerate(run[state]) if c is not None)
        path.append((state, to))
        state = to
    return int(rest[0][START]), path


# ---- rows to runs

def _last(text: Column) -> Column:
    return F.substring(F.rtrim(text, F.lit(WHITE)), -1, 1)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): the contract's damage by the crc32 of ``conv_id:turn``."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role").alias("role"),
                                space("text").alias("text"), hit.alias("hit")).select(
        "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("hit") == 0, 0).when(F.col("hit") == 3, 2).otherwise(1).alias("copies"))


def _keyed(rows: DataFrame) -> DataFrame:
    """With the initial of the role and a digest of role and text."""
    said = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.withColumns({"initial": F.substring("role", 1, 1), "digest": F.unhex(F.sha2(said.cast("binary"), 256))})


ORDER = ["turn", "initial", "digest"]
_SLIM = ["conv_id", *ORDER, "blank", "cut"]


def _faults(rows: DataFrame) -> DataFrame:
    """One row for each conversation, turn and digest, without its text: copies, and whether the first of them is new."""
    slim = (_keyed(rows).withColumns({"last": _last(F.col("text"))})
            .withColumns({"blank": F.col("last") == "", "cut": ~F.col("last").isin(".", "!", "?")})
            .groupBy(*_SLIM).agg(F.sum("copies").cast("long").alias("copies")))
    slim = settled(slim, "turns")
    seen = (slim.where("copies > 0").groupBy("conv_id", "digest")
            .agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"),
                 F.count(F.lit(1)).alias("n")).where("n > 1")
            .select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first.turn", F.lit(True).alias("again")))
    seen = seen.withColumnRenamed("turn", "first_turn")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))
    later = F.coalesce(F.col("again"), F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first_turn"))
    return slim.join(seen, same, "left").select(*_SLIM, "copies", later.alias("later"))


_RUNS = ("part int, place int, conv_id {id}, symbols string, first_initial string, last_initial string, first_turn long, "
         "last_turn long, turns long, blank long, duplicate long, truncated long, illegal long")


class _Run:
    """The rows of one conversation that lie together, up to RUN of them."""

    def __init__(self, conv):
        self.conv, self.symbols, self.rows = conv, [], 0
        self.first = self.last = self.first_turn = self.last_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, initial, blank, cut, again) -> None:
        if self.rows == 0:
            self.first = initial
        else:
            self.illegal += self.last + initial not in LEGAL
        self.last, self.rows = initial, self.rows + 1
        if turn is not None and turn != self.last_turn:
            self.turns, self.last_turn = self.turns + 1, turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
        self.blank += blank
        self.duplicate += again and not blank
        fault = cut and not blank and not again
        self.truncated += fault
        symbol = initial if initial in ("s", "u", "a") else "o"
        self.symbols.append("x" if blank or again else symbol.upper() if fault else symbol)

    def row(self) -> tuple:
        return (self.conv, "".join(self.symbols), self.first, self.last, self.first_turn, self.last_turn, self.turns,
                self.blank, self.duplicate, self.truncated, self.illegal)


def _runs_of(rows: Iterable[tuple], size: int) -> Iterator[_Run]:
    """Runs of (conv_id, turn, initial, blank, cut, copies, later) in order."""
    run, begun = None, False
    for conv, turn, initial, blank, cut, copies, later in rows:
        if not begun or run.conv != conv:
            if begun:
                yield run
            run, begun = _Run(conv), True
        for copy in range(copies):
            if run.rows == size:
                yield run
                run = _Run(conv)
            run.add(turn, initial, blank, cut, later or copy > 0)
    if begun:
        yield run


def runs(rows: DataFrame, size: int = RUN) -> DataFrame:
    """Runs of symbols of ``rows`` (conv_id, turn, role, text, copies), with the counts of their faults."""
    slim = _faults(rows)
    ordered = slim.repartitionByRange("conv_id", *ORDER).sortWithinPartitions("conv_id", *ORDER)
    kind = slim.schema["conv_id"].dataType.simpleString()
    columns = ["conv_id", "turn", "initial", "blank", "cut", "copies", "later"]
    names = [c.split()[0] for c in _RUNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, types = TaskContext.get().partitionId(), None

        def spread() -> Iterator[tuple]:
            nonlocal types
            for batch in batches:
                types = batch.schema.field("conv_id").type
                yield from zip(*(c.to_pylist() for c in batch.columns))

        def packed(found: list[tuple], place: int) -> pa.RecordBatch:
            values = list(zip(*((part, place + k, *r) for k, r in enumerate(found))))
            kinds = [pa.int32(), pa.int32(), types, *[pa.string()] * 3, *[pa.int64()] * 7]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], names)

        found, place, held = [], 0, 0
        for r in _runs_of(spread(), size):
            found.append(r.row())
            held += r.rows
            if len(found) >= 4_096 or held >= 1 << 20:
                yield packed(found, place)
                found, place, held = [], place + len(found), 0
        if found:
            yield packed(found, place)

    return settled(ordered.select(*columns).mapInArrow(run, _RUNS.format(id=kind)), "runs")


# ---- the grammar and the sequences

def re_pair(sequences: DataFrame, rules: int = RULES, rounds: int = ROUNDS) -> Grammar:
    """Rules for the most frequent pairs of (symbols, n).

    A round counts all pairs and takes the most frequent that share no symbol with one taken
    before, so that none changes another's count. The counts that a round sends to the driver are
    at most the square of the symbols in use.
    """
    pairs: list[str] = []
    for _ in range(rounds):
        places = F.sequence(F.lit(1), F.length("symbols") - 1)
        two = F.transform(places, lambda i: F.substring(F.col("symbols"), i, F.lit(2)))
        counted = (sequences.where(F.length("symbols") > 1).select(F.explode(two).alias("pair"), "n")
                   .groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1").collect())
        taken, used = [], set()
        for pair in sorted(counted, key=lambda r: (-r["n"], r["pair"])):
            if not used & set(pair["pair"]) and len(pairs) + len(taken) < rules:
                taken.append(pair["pair"])
                used |= set(pair["pair"])
        if not taken:
            break
        symbols = F.col("symbols")
        for pair in taken:
            symbols = F.replace(symbols, F.lit(pair), F.lit(chr(RULE + len(pairs))))
            pairs.append(pair)
        sequences = sequences.withColumn("symbols", symbols)
    return Grammar(tuple(pairs))


def _judged(sequences: DataFrame, grammar: Grammar) -> DataFrame:
    """Distinct symbols with their matrices: costs and audits from each state to each, and of the whole."""
    matrices = grammar.matrices()
    for m in matrices.values():
        for row in m:
            for e in row:
                str(e[1]) if e else None  # joined here, so that tasks read plain text
                if e:
                    e[1].left = e[1].right = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for symbols in batch.column(0).to_pylist():
                m = evaluate(symbols, grammar, matrices)
                cells = [e for row in m for e in row]
                out.append((symbols, *whole(m), [e and e[0] for e in cells], [e and str(e[1]) for e in cells]))
            kinds = [pa.string(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.string())]
            columns = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds)],
                                             ["symbols", "cost", "audit", "costs", "audits"])

    return sequences.select("symbols").mapInArrow(
        run, "symbols string, cost long, audit string, costs array<long>, audits array<string>")


def _ranks(audits: list[str | None]) -> list[int | None]:
    out: list[int | None] = []
    for i in STATES:
        row = audits[4 * i:4 * i + 4]
        order = {a: k for k, a in enumerate(sorted(a for a in row if a is not None))}
        out += [order.get(a) for a in row]
    return out


def _joined(parts: DataFrame, kind: str) -> DataFrame:
    """(conv_id, cost, audit) of conversations of several runs: the edits of each are chosen on light rows."""
    def choose(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("part", "ascending"), ("place", "ascending")])
        square = lambda flat: [flat[i:i + 4] for i in range(0, 16, 4)]
        cost, path = chosen([square(c) for c in rows["costs"].to_pylist()], [square(r) for r in rows["ranks"].to_pylist()])
        out = rows.select(["conv_id", "part", "place"])
        return (out.append_column("total", pa.array([cost] * len(path), pa.int64()))
                .append_column("state", pa.array([a for a, _ in path], pa.int32()))
                .append_column("to", pa.array([b for _, b in path], pa.int32())))

    ranked = F.udf(_ranks, "array<int>", useArrow=True)
    light = parts.select("conv_id", "part", "place", "costs", ranked("audits").alias("ranks"))
    taken = light.groupBy("conv_id").applyInArrow(
        choose, f"conv_id {kind}, part int, place int, total long, state int, to int").drop("conv_id")
    ends = F.element_at(F.array(*[F.lit(ENDS[j][1]) for j in STATES]), F.col("last_to") + 1)
    return (parts.join(taken, ["part", "place"])
            .select("conv_id", "total", F.struct("part", "place", F.get("audits", F.col("state") * 4 + F.col("to")).alias("audit"),
                                                 "to").alias("piece"))
            .groupBy("conv_id", "total").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
            .withColumn("last_to", F.element_at("pieces", -1)["to"])
            .select("conv_id", F.col("total").alias("cost"),
                    F.concat(F.array_join(F.transform("pieces", lambda p: p["audit"]), ""), ends).alias("audit")))


def audits(found: DataFrame, rules: int = RULES, rounds: int = ROUNDS) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) from the runs of all conversations."""
    by_place = Window.partitionBy("conv_id").orderBy("part", "place")
    pair = F.concat(F.lag("last_initial").over(by_place), "first_initial")
    linked = (found.withColumn("n_runs", F.count(F.lit(1)).over(Window.partitionBy("conv_id")))
              .withColumns({"illegal": F.col("illegal") + F.when(pair.isNull() | pair.isin(*LEGAL), 0).otherwise(1),
                            "turns": F.col("turns") - F.when(F.lag("last_turn").over(by_place) == F.col("first_turn"), 1)
                            .otherwise(0)}))
    linked = settled(linked, "linked-runs")
    counts = linked.groupBy("conv_id").agg(
        F.coalesce(F.max("last_turn") - F.min("first_turn") + 1 - F.sum("turns"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    sequences = settled(linked.groupBy("symbols").agg(F.count(F.lit(1)).alias("n")), "sequences")
    judged = settled(_judged(sequences, re_pair(sequences, rules, rounds)), "judged")
    of_one = linked.where("n_runs = 1").select("conv_id", "symbols").join(
        judged.select("symbols", "cost", "audit"), "symbols").select("conv_id", "cost", "audit")
    parts = linked.where("n_runs > 1").select("conv_id", "symbols", "part", "place").join(
        judged.select("symbols", "costs", "audits"), "symbols")
    of_all = of_one.union(_joined(parts, found.schema["conv_id"].dataType.simpleString()))
    of_all = of_all.select(F.col("conv_id").alias("c"), "cost", "audit")
    return counts.join(of_all, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")


# ---- the repaired rows

_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _in_order(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """Each conversation's audit and then its rows in order, whole in one partition, to be read as a stream."""
    texts = _keyed(rows).where("copies > 0").select(
        "conv_id", F.lit(1).alias("kind"), *ORDER, "role", "text", "copies", F.lit(None).cast("string").alias("audit"),
        *[F.lit(None).cast("long").alias(c) for c in _COUNTS])
    heads = audited.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
                           F.lit(None).cast("string").alias("initial"), F.lit(None).cast("binary").alias("digest"),
                           F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
                           F.lit(0).alias("copies"), "audit", *_COUNTS)
    return (heads.union(texts).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *ORDER)
            .select("conv_id", "kind", "role", "text", "copies", "audit", *_COUNTS))


def replay(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Events of (conv_id, kind, role, text, copies, audit, ...) in order: ("head", the audit's row) where a
    conversation begins, then ("row", edit, role, text) for all rows that stay."""
    edits, state = iter(()), START

    def step(edit: str, role: str, text: str) -> tuple | None:
        nonlocal state
        if edit == "D":
            return None
        if edit == "K" and state == START and role[:1] == "s":
            state = SYSTEM
            return "row", edit, role, text
        state = ASSISTANT if state == USER else USER
        return "row", edit, role if edit == "K" else ROLES[state], "" if edit == "I" else text

    def inserted() -> Iterator[tuple]:
        for edit in edits:  # what is left of an audit is inserted
            yield step(edit, "", "")

    for row in rows:
        _, kind, role, text, copies, audit, *_ = row
        if kind == 0:
            yield from inserted()
            edits, state = iter(audit), START
            yield "head", row
            continue
        for _ in range(copies):
            for edit in edits:
                event = step(edit, role, text)
                if event:
                    yield event
                if edit != "I":
                    break
    yield from inserted()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def repaired_rows(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """(conv_id, position, edit, role, text): the repaired conversations, rows in order."""
    ordered = _in_order(rows, audited)
    kind = ordered.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = None

        def spread() -> Iterator[tuple]:
            nonlocal types
            for batch in batches:
                types = batch.schema.field("conv_id").type
                yield from _rows(iter([batch]))

        def packed(out: list[tuple]) -> pa.RecordBatch:
            kinds = [types, pa.int64(), pa.string(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), kinds)],
                                              ["conv_id", "position", "edit", "role", "text"])

        conv, place, out, held = None, 0, [], 0
        for what, *rest in replay(spread()):
            if what == "head":
                conv, place = rest[0][0], 0
                continue
            out.append((conv, place, *rest))
            place, held = place + 1, held + len(rest[2])
            if len(out) >= 4_096 or held >= 1 << 24:
                yield packed(out)
                out, held = [], 0
        if out:
            yield packed(out)

    return ordered.mapInArrow(run, f"conv_id {kind}, position long, edit string, role string, text string")


def repaired_digests(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """``audited`` with repaired_sha256 of the repaired ``role:text`` rows, joined by newlines."""
    ordered = _in_order(rows, audited)
    kind = ordered.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "audit", *_COUNTS, "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = None

        def spread() -> Iterator[tuple]:
            nonlocal types
            for batch in batches:
                types = batch.schema.field("conv_id").type
                yield from _rows(iter([batch]))

        def packed(out: list[tuple]) -> pa.RecordBatch:
            kinds = [types, pa.string(), *[pa.int64()] * len(_COUNTS), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), kinds)], names)

        out, head, digest, rows_in = [], None, None, 0
        for what, *rest in replay(spread()):
            if what == "head":
                if head is not None:
                    out.append((head[0], *head[5:], digest.hexdigest()))
                    if len(out) >= 1_024:
                        yield packed(out)
                        out = []
                head, digest, rows_in = rest[0], hashlib.sha256(), 0
                continue
            _, role, text = rest
            digest.update(f"{chr(10) if rows_in else ''}{role}:{text}".encode("utf-8", "replace"))
            rows_in += 1
        if head is not None:
            yield packed([*out, (head[0], *head[5:], digest.hexdigest())])

    schema = ", ".join([f"conv_id {kind}", "audit string", *[f"{c} long" for c in _COUNTS], "repaired_sha256 string"])
    return ordered.mapInArrow(run, schema)


def repair(rows: DataFrame, size: int = RUN) -> DataFrame:
    """The audit and fault counts of each conversation of ``rows`` (conv_id, turn, role, text, copies)."""
    return settled(audits(runs(rows, size)), "audits")


@query()
def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations, their faults, the cheapest repair and a digest of its rows."""
    rows = damaged(table(spark, sf_dir, "conversations"))
    return repaired_digests(rows, repair(rows)).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
