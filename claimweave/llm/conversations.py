"""Repair of damaged conversations by a grammar-compressed shortest path.

A conversation's rows become one symbol each: the role's initial (s, u, a or another), whether the text ends
truncated, or that the row must go (blank or duplicate). Re-Pair shortens these sequences: rounds over all distinct
sequences count neighbouring symbols, and the most frequent pairs become rules. Each rule has one min-plus transfer
matrix over the four states of `(s?(ua)+)?`, made from its two parts: the cost of the cheapest edits between two
states, how their audit compares with those to other states, and where the parts meet, by which the audit is read off
as a rope. All conversations share the rules; a conversation is the product of the few symbols left of it.

Ties need no texts: among audits from one state those to different states differ before either ends (a letter and a
state give the next state), so the left part decides wherever the meeting states differ, else the right part.

A long conversation is cut into blocks by a range sort, so that no task holds its sequence; its blocks' matrices are
multiplied within each partition, then over partitions, and the states chosen there go back down to the blocks. Only
the repaired text's digest, a sequential function by definition, runs over a conversation's rows in one task, as a
stream that holds one row.

Order of rows: turn (null first), role, then SHA-256 of the text, so that equal rows are neighbours. Cases: null role
or text counts as one space, and a null conv_id or turn does so in the damage's key only; a null conv_id is a
conversation; a row whose role begins with another letter can be rewritten or deleted, not kept; repeated rows are
duplicates; very long texts are read once per digest; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.common import stored

BLOCK = 512  # symbols of a block at most
ROUNDS, PICKED = 8, 32  # of the grammar: rounds, and rules a round at most
BLANKS = " \t\n\x0b\x0c\r"

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs
START, SYSTEM, USER, ASSISTANT = range(4)  # states, by what was written last
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # what a written turn leads to
ROLE = {USER: "user", ASSISTANT: "assistant"}
INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ENDS = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}  # inserts that end a conversation

#: A matrix: for each state a map from the next state to (cost, place among the row's audits, meeting state or audit).
Matrix = tuple[dict[int, tuple], ...]


# Transfer matrices


def _kept(state: int, symbol: str) -> int | None:
    """The state after a row is kept; None where it can't be."""
    to = INITIAL.get(symbol.lower())
    allowed = to == NEXT[state] or (to == SYSTEM and state == START)
    return to if allowed else None


def terminal(symbol: str) -> Matrix:
    """The matrix of one row: any inserts, then an edit of the row. `x` is a row that must go."""
    rows = []
    for start in range(4):
        best: dict[int, tuple] = {}
        state, inserts = start, 0
        while inserts < 4:  # the states repeat after that
            extra = INSERT * inserts
            options = [(state, extra + DELETE, "D")]
            if symbol != "x":
                late = TRUNCATED if symbol.isupper() else 0
                options.append((NEXT[state], extra + REROLE + late, "R"))
                if (to := _kept(state, symbol)) is not None:
                    options.append((to, extra + KEEP + late, "K"))
            for to, cost, letter in options:
                found = (cost, "I" * inserts + letter)
                if to not in best or found < best[to]:
                    best[to] = found
            state, inserts = NEXT[state], inserts + 1
        order = {to: i for i, to in enumerate(sorted(best, key=lambda to: best[to][1]))}
        rows.append({to: (cost, order[to], audit) for to, (cost, audit) in best.items()})
    return tuple(rows)


def step(row: dict[int, tuple], matrix: Matrix) -> dict[int, tuple]:
    """A row of a matrix times another matrix."""
    best: dict[int, tuple] = {}
    for meet, (cost, place, _) in row.items():
        for to, (more, inner, _) in matrix[meet].items():
            found = (cost + more, place, inner, meet)
            if to not in best or found < best[to]:
                best[to] = found
    order = {to: i for i, to in enumerate(sorted(best, key=lambda to: best[to][1:3]))}
    return {to: (cost, order[to], meet) for to, (cost, _, _, meet) in best.items()}


def product(left: Matrix, right: Matrix) -> Matrix:
    return tuple(step(row, right) for row in left)


IDENTITY: Matrix = tuple({s: (0, 0, s)} for s in range(4))


def cheapest(row: dict[int, tuple]) -> int:
    """The state in which a conversation's edits end, from the row of its start."""
    return min(row, key=lambda s: (row[s][0] + INSERT * len(ENDS[s]), row[s][1]))


class Grammar:
    """Rules, their matrices bottom-up, and audits read off them."""

    def __init__(self, rules: list[tuple[str, str]]):
        self.rules = [(a + b, name(i)) for i, (a, b) in enumerate(rules)]
        self.parts = {name(i): pair for i, pair in enumerate(rules)}
        self.matrices = {s: terminal(s) for s in "suaoSUAOx"}
        for i, (a, b) in enumerate(rules):
            self.matrices[name(i)] = product(self.matrices[a], self.matrices[b])
        self.audits: dict[tuple[str, int, int], str] = {}
        self.rows: dict[str, list[dict]] = {}

    def shorten(self, text: str) -> str:
        for pair, symbol in self.rules:
            text = text.replace(pair, symbol)
        return text

    def rope(self, symbol: str, a: int, b: int) -> str:
        """The audit of a symbol between two states, from those of its parts."""
        if symbol not in self.parts:
            return self.matrices[symbol][a][b][2]
        if (symbol, a, b) not in self.audits:
            left, right = self.parts[symbol]
            meet = self.matrices[symbol][a][b][2]
            self.audits[symbol, a, b] = self.rope(left, a, meet) + self.rope(right, meet, b)
        return self.audits[symbol, a, b]

    def walk(self, sequence: str, start: int) -> list[dict]:
        """The rows from a state after none, one, ... of the symbols of a shortened sequence."""
        rows = [{start: (0, 0, None)}]
        for symbol in sequence:
            rows.append(step(rows[-1], self.matrices[symbol]))
        return rows

    def audit(self, sequence: str, rows: list[dict], end: int) -> str:
        out = []
        for symbol, row in zip(reversed(sequence), reversed(rows), strict=False):
            meet = row[end][2]
            out.append(self.rope(symbol, meet, end))
            end = meet
        return "".join(reversed(out))

    def solved(self, sequence: str, start: int, end: int | None) -> tuple[str, int]:
        """Audit and cost of a block between two states; of a whole conversation, with its last inserts, without end."""
        short = self.shorten(sequence)
        rows = self.walk(short, start)
        last = cheapest(rows[-1]) if end is None else end
        closing = ENDS[last] if end is None else ""
        return self.audit(short, rows, last) + closing, rows[-1][last][0] + INSERT * len(closing)


def name(i: int) -> str:
    return chr(0xE000 + i)


def _pairs(rules: list[tuple[str, str]]):
    """Counts of neighbouring symbols in shortened sequences, each weighted by its blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(rules)
        total: dict[int, int] = {}
        for batch in batches:
            text = grammar.shorten("\n".join(batch.column("symbols").to_pylist()) + "\n")
            codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
            weight = np.repeat(batch.column("blocks").to_numpy(), np.diff(np.flatnonzero(codes == 10), prepend=-1))
            pair = (codes[:-1] << 32) | codes[1:]
            inside = (codes[:-1] != 10) & (codes[1:] != 10)
            found, at = np.unique(pair[inside], return_inverse=True)
            for p, n in zip(found.tolist(), np.bincount(at, weight[:-1][inside]).tolist(), strict=True):
                total[p] = total.get(p, 0) + int(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(total.keys(), pa.int64()), pa.array(total.values(), pa.int64())], names=["pair", "n"]
        )

    return run


def learn(sequences: DataFrame, rounds: int = ROUNDS, picked: int = PICKED) -> list[tuple[str, str]]:
    """Re-Pair rules from symbols and blocks (how many blocks are that sequence); pairs of symbols, oldest first.

    A round counts over all sequences and turns the most frequent pairs into rules, none of which begins with a
    symbol that another ends with, so that their places never overlap. The driver holds the rules, 256 at most.
    """
    rules: list[tuple[str, str]] = []
    for _ in range(rounds):
        counts = sequences.mapInArrow(_pairs(rules), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        top = counts.where("n > 1").orderBy(F.desc("n"), "pair").limit(4 * picked).collect()
        firsts: set[str] = set()
        lasts: set[str] = set()
        new = []
        for row in top:
            a, b = chr(row["pair"] >> 32), chr(row["pair"] & 0xFFFFFFFF)
            if len(new) < picked and a not in lasts and b not in firsts and (a != b or not new):
                new.append((a, b))
                firsts.add(a)
                lasts.add(b)
                if a == b:
                    break
        if not new:
            break
        rules += new
    return rules


# Rows, damage, faults


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies after damage by the crc32 of `conv_id:turn` modulo 20."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    case = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text"), space)
    return conversations.select("conv_id", "turn", "role", "text", case.alias("case")).where("case != 0").select(
        "conv_id",
        "turn",
        F.when(F.col("case") == 4, "user").otherwise(F.coalesce(F.col("role"), space)).alias("role"),
        F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(F.col("case") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def faults(rows: DataFrame) -> DataFrame:
    """Per distinct row: copies, whether its text is blank or ends truncated, and whether it is the first of its kind.

    The first row of a role and text is found by a minimum that combines before the shuffle, and marked by a second
    aggregate over the row's whole key: no key gathers the rows of a conversation or of a repeated text.
    """
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    key = ["conv_id", "turn", "role", "digest"]
    narrow = rows.select(
        "conv_id",
        "turn",
        "role",
        _digest(F.col("text")).alias("digest"),
        "copies",
        (trimmed == "").alias("blank"),
        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    flags = [F.max("blank").alias("blank"), F.max("cut").alias("cut")]
    narrow = narrow.groupBy(*key).agg(F.sum("copies").alias("copies"), *flags)
    early = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("early")
    first = narrow.where("NOT blank").groupBy("conv_id", "role", "digest").agg(early, *flags).select(
        "conv_id", F.col("early.turn").alias("turn"), "role", "digest", F.lit(0).cast("long").alias("copies"), "blank", "cut",
        F.lit(True).alias("first"),
    )
    both = narrow.withColumn("first", F.lit(False)).unionByName(first)
    return both.groupBy(*key).agg(F.sum("copies").alias("copies"), *flags, F.max("first").alias("first"))


# Blocks


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[tuple]]:
    """Blocks of the symbols of sorted rows: conv_id, part, no, whole, symbols, and the key of the first row.

    A block is whole if it is all of a conversation, which the first and the last of a partition may not be.
    """
    part = TaskContext.get().partitionId()
    out: list[tuple] = []
    conv, first, no, length, start, symbols, seen = None, True, 0, 0, None, [], False

    def flush(whole):
        nonlocal no, length, symbols
        out.append((conv, part, no, whole, "".join(symbols), *start))
        no, length, symbols = no + 1, 0, []

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "digest", "copies", "blank", "cut", "first")]
        for c, turn, role, digest, copies, blank, cut, new in zip(*columns, strict=True):
            if not seen or c != conv:
                if seen:
                    flush(not first and no == 0)
                    first = False
                conv, no, seen = c, 0, True
            lead = ""
            if new and not blank:
                lead = role[:1] if role[:1] in INITIAL else "o"
                lead = lead.upper() if cut else lead
            while copies:
                if length == size:
                    flush(False)
                if not length:
                    start = (turn, role, digest)
                take = min(copies, size - length)
                symbols.append(lead + "x" * (take - len(lead)))
                length, copies, lead = length + take, copies - take, ""
        yield out
        out = []
    if seen:
        flush(False)
    yield out


def blocks(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """The stored blocks of all conversations, from a range sort of the narrow rows."""
    narrow = stored(faults(rows), "turns")
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = dict(rows.dtypes)["conv_id"]
    schema = f"conv_id {kind}, part int, no long, whole boolean, symbols string, turn {dict(rows.dtypes)['turn']}, role string, digest binary"
    placed = narrow.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return stored(_streamed(placed, lambda: lambda batches: _blocks(batches, size), schema), "blocks")


def _streamed(df: DataFrame, make, schema: str) -> DataFrame:
    """mapInArrow with a function from batches to lists of row tuples, made in the task."""
    from pyspark.sql.pandas.types import to_arrow_schema

    target = df.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in make()(batches):
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow
                )

    return df.mapInArrow(run, target)


def _runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Rows with equal keys that follow one another, group by group."""
    from itertools import groupby

    rows = (r for b in batches for s in range(0, b.num_rows, 256) for r in b.slice(s, 256).to_pylist())
    return groupby(rows, key=lambda r: tuple(r[k] for k in keys))


# Products over blocks


def _flat(matrix: Matrix) -> tuple[list, list]:
    cells = [row.get(to) for row in matrix for to in range(4)]
    return [c and c[0] for c in cells], [c and c[1] for c in cells]


def _matrix(costs: list, places: list) -> Matrix:
    return tuple(
        {to: (costs[4 * s + to], places[4 * s + to], None) for to in range(4) if costs[4 * s + to] is not None} for s in range(4)
    )


def _totals(batches):
    """The product of the blocks of each conversation and partition."""
    for (conv, part), rows in _runs(batches, "conv_id", "part"):
        total = IDENTITY
        for r in rows:
            total = product(total, _matrix(r["costs"], r["places"]))
        yield [(conv, part, *_flat(total))]


def _states(matrices: list[Matrix], start: int, end: int | None) -> list[int]:
    """The states between matrices on the cheapest way, the first and the last included."""
    rows = [{start: (0, 0, None)}]
    for m in matrices:
        rows.append(step(rows[-1], m))
    state = cheapest(rows[-1]) if end is None else end
    found = [state]
    for row in reversed(rows[1:]):
        state = row[state][2]
        found.append(state)
    return found[::-1]


def _chosen(batches):
    """The states at the ends of each partition's share of a conversation; partitions are few, whatever the rows."""
    for (conv,), rows in _runs(batches, "conv_id"):
        kept = [(r["part"], _matrix(r["costs"], r["places"])) for r in rows]
        states = _states([m for _, m in kept], START, None)
        last = len(kept) - 1
        yield [(conv, part, states[i], states[i + 1], i == last) for i, (part, _) in enumerate(kept)]


def _pieces(rules: list[tuple[str, str]]):
    """Audit and cost of blocks, of each conversation and partition after the row of its chosen states."""

    def run(batches):
        grammar = Grammar(rules)
        for (conv, _), rows in _runs(batches, "conv_id", "part"):
            chosen = next(rows)
            kept = list(rows)  # the blocks of one conversation in one partition of the range sort
            states = _states([_matrix(r["costs"], r["places"]) for r in kept], chosen["a"], chosen["b"])
            out = []
            for i, r in enumerate(kept):
                audit, cost = grammar.solved(r["symbols"], states[i], states[i + 1])
                if chosen["last"] and i == len(kept) - 1:
                    audit, cost = audit + ENDS[states[-1]], cost + INSERT * len(ENDS[states[-1]])
                out.append((conv, r["turn"], r["role"], r["digest"], r["part"], r["no"], r["symbols"], audit, cost))
            yield out

    return run


def _whole(rules: list[tuple[str, str]]):
    """Audit and cost of conversations of one block; equal sequences of a task are solved once."""

    def run(batches):
        grammar = Grammar(rules)
        known: dict[str, tuple[str, int]] = {}
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                found = known.get(r["symbols"])
                if found is None:
                    found = grammar.solved(r["symbols"], START, None)
                    if len(known) >= 50_000:
                        known.clear()
                    known[r["symbols"]] = found
                out.append((r["conv_id"], r["turn"], r["role"], r["digest"], r["part"], r["no"], r["symbols"], *found))
            yield out

    return run


def _measured(rules: list[tuple[str, str]]):
    """Blocks with their matrices."""

    def run(batches):
        grammar = Grammar(rules)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                short = grammar.shorten(r["symbols"])
                out.append((*r.values(), *_flat(tuple(grammar.walk(short, s)[-1] for s in range(4)))))
            yield out

    return run


def pieces(cut: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """conv_id, key of the first row, part, no, symbols, audit, cost of every block."""
    kinds = dict(cut.dtypes)
    conv, key = f"conv_id {kinds['conv_id']}", f"turn {kinds['turn']}, role string, digest binary"
    schema = f"{conv}, {key}, part int, no long, symbols string, audit string, cost long"
    matrix = "costs array<long>, places array<int>"
    plain = cut.drop("whole")
    columns = ["conv_id", "part", "no", "symbols", "turn", "role", "digest"]
    whole = _streamed(plain.where(cut["whole"]).select(*columns), lambda: _whole(rules), schema)
    open_ = plain.where(~cut["whole"]).select(*columns)
    measured = _streamed(open_, lambda: _measured(rules), f"{conv}, part int, no long, symbols string, {key}, {matrix}")
    measured = stored(measured, "open-blocks")

    def grouped(df, *keys, then=()):
        return df.repartition(*keys).sortWithinPartitions(*keys, *then)

    totals = _streamed(grouped(measured, "conv_id", "part", then=["no"]), lambda: _totals, f"{conv}, part int, {matrix}")
    chosen = _streamed(grouped(totals, "conv_id", then=["part"]), lambda: _chosen, f"{conv}, part int, a int, b int, last boolean")
    heads = chosen.withColumn("no", F.lit(-1).cast("long"))
    both = measured.unionByName(heads, allowMissingColumns=True)
    return whole.unionByName(_streamed(grouped(both, "conv_id", "part", then=["no"]), lambda: _pieces(rules), schema))


# Repaired conversations


def _repaired(batches):
    """One row per conversation from its head row, its blocks' audits and its texts in order."""
    out = []
    for (conv,), rows in _runs(batches, "conv_id"):
        digest, audits, cost = hashlib.sha256(), [], 0
        symbols, edits = iter(()), iter(())
        queue: list[tuple[str, str]] = []
        blank = duplicate = truncated = illegal = turns = 0
        low = high = before = None
        state, written, any_turn = START, False, False

        def write(text):
            nonlocal written
            digest.update(("\n" + text if written else text).encode())
            written = True

        def insert():
            nonlocal state
            state = NEXT[state]
            write(ROLE[state] + ":")

        for r in rows:
            if r["kind"] == 0:
                continue
            if r["kind"] == 1:
                queue.append((r["symbols"], r["audit"]))
                audits.append(r["audit"])
                cost += r["cost"]
                continue
            turn, role, text = r["turn"], r["role"], r["text"]
            if turn is not None:
                if not any_turn or turn != high:
                    turns += 1
                low, high, any_turn = (low if any_turn else turn), turn, True
            for _ in range(r["copies"]):
                symbol = next(symbols, None)
                if symbol is None:
                    for e in edits:  # inserts that end a conversation follow its last row only
                        insert()
                    now, audit = queue.pop(0)
                    symbols, edits = iter(now), iter(audit)
                    symbol = next(symbols)
                edit = next(edits)
                while edit == "I":
                    insert()
                    edit = next(edits)
                if symbol == "x":
                    if text.strip(BLANKS):
                        duplicate += 1
                    else:
                        blank += 1
                elif symbol.isupper():
                    truncated += 1
                if edit == "K":
                    state = INITIAL[role[0]]
                    write(f"{role}:{text}")
                elif edit == "R":
                    state = NEXT[state]
                    write(f"{ROLE[state]}:{text}")
                if before is not None and before + role[:1] not in ("su", "ua", "au"):
                    illegal += 1
                before = role[:1]
        for _ in edits:
            insert()
        gaps = high - low + 1 - turns if any_turn else 0
        out.append((conv, gaps, blank, duplicate, truncated, illegal, cost, "".join(audits), digest.hexdigest()))
        if len(out) >= 1024:
            yield out
            out = []
    yield out


def repair(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of every conversation."""
    rows = damaged(conversations)
    cut = blocks(rows, block)
    sequences = stored(cut.groupBy("symbols").agg(F.count("*").alias("blocks")), "sequences")
    found = pieces(cut, learn(sequences))
    heads = conversations.select("conv_id").distinct().withColumn("kind", F.lit(0))
    texts = rows.withColumn("digest", _digest(F.col("text"))).withColumn("kind", F.lit(2))
    stream = heads.unionByName(found.withColumn("kind", F.lit(1)), allowMissingColumns=True).unionByName(
        texts, allowMissingColumns=True
    )
    order = ["conv_id", "turn", "role", "digest", "kind", "part", "no"]
    kind = dict(conversations.dtypes)["conv_id"]
    schema = (
        f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
        "audit string, repaired_sha256 string"
    )
    return _streamed(stream.repartition("conv_id").sortWithinPartitions(*order), lambda: _repaired, schema)
