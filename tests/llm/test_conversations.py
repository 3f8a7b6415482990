"""Conversation repair against a plain search over edits with whole audits."""

import hashlib
import random
import zlib
from collections import Counter

import pytest

from claimweave.llm import conversations as c

COLUMNS = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
SCHEMA = "conv_id long, turn long, role string, text string, kind string, symbols string, cost string"


def damage(rows):
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        case = zlib.crc32(key.encode()) % 20
        if case == 0:
            continue
        text = "" if case == 1 else text.translate(dict.fromkeys(map(ord, ".!?"))) if case == 2 else text
        yield from [(conv, turn, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)


def cheapest(rows):
    """(cost, audit, written) over all edits: best audits per state, row by row."""
    follows = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def better(found, state, option):
        if state not in found or option < found[state]:
            found[state] = option

    def with_inserts(found):
        for _ in range(4):
            for state, (cost, audit, out) in list(found.items()):
                to = follows[state]
                better(found, to, (cost + 2, audit + "I", (*out, name[to] + ":")))
        return found

    best = {"": (0, "", ())}
    for role, text, fault in rows:
        after = {}
        for state, (cost, audit, out) in with_inserts(best).items():
            better(after, state, (cost + 3, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = fault == "truncated"
            to = follows[state]
            better(after, to, (cost + 2 + more, audit + "R", (*out, f"{name[to]}:{text}")))
            if role[:1] == to or (role[:1] == "s" and state == ""):
                better(after, role[:1], (cost + more, audit + "K", (*out, f"{role}:{text}")))
        best = after
    best = with_inserts(best)
    return min(best[s] for s in ("", "a") if s in best)


def brute(rows):
    groups = {r[0]: [] for r in rows}
    for r in damage(rows):
        groups[r[0]].append(r)
    out = Counter()
    for conv, turns in groups.items():
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        seen, faulty, illegal = set(), [], 0
        for i, (_, _, role, text) in enumerate(turns):
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faulty.append((role, text, fault))
            illegal += i > 0 and turns[i - 1][2][:1] + role[:1] not in ("su", "ua", "au")
        known = [t[1] for t in turns if t[1] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        cost, audit, written = cheapest(faulty)
        count = Counter(f for _, _, f in faulty)
        digest = hashlib.sha256("\n".join(written).encode()).hexdigest()
        out[(conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest)] += 1
    return out


def made(df, block=c.BLOCK):
    return Counter(tuple(r) for r in c.repair(df, block).select(*COLUMNS).collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def test_given_conversations(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    want = brute([tuple(r) for r in docs.select("conv_id", "turn", "role", "text").collect()])
    assert made(docs) == want and any(r[6] for r in want)


@pytest.mark.parametrize("block", [3, 512])
def test_odd_rows_and_long_conversations(spark, block):
    rng = random.Random(block)
    roles = ["user", "assistant", "system", "tool", "u", "", None, "agent"]
    texts = ["Yes.", "no", " ", "", None, "a\n", "b!\t\r\n", "é?", "\xa0", "q. "]
    rows = [
        (rng.choice([None, 1, 2, *range(40)]), rng.choice([None, *range(30)]), rng.choice(roles), rng.choice(texts))
        for _ in range(700)
    ]
    rows += [(1000, t, rng.choice(["user", "assistant", "system"]), f"{rng.randrange(900)}.") for t in range(1500)]
    rows += [(1001, 5, "user", "same.")] * 40 + [(1002, t, "user", "one.") for t in range(90)]
    assert made(frame(spark, rows), block) == brute(rows)


def test_conversations_without_rows(spark):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    (row,) = made(frame(spark, [(dropped, 0, "user", "a")]))
    assert row == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert made(frame(spark, [])) == Counter()


def test_rules_give_the_matrix_of_their_rows():
    rng = random.Random(3)
    rules = [("u", "a"), ("U", "A"), (c.name(0), c.name(0)), (c.name(2), "x"), ("s", c.name(0))]
    grammar = c.Grammar(rules)
    plain = c.Grammar([])
    for _ in range(300):
        text = "".join(rng.choice("suaoSUAOxuaua") for _ in range(rng.randrange(40)))
        assert grammar.solved(text, 0, None) == plain.solved(text, 0, None)
        for start in range(4):
            mine, other = (g.walk(g.shorten(text), start)[-1] for g in (grammar, plain))
            assert {k: v[:2] for k, v in mine.items()} == {k: v[:2] for k, v in other.items()}


def test_grammar_takes_frequent_pairs(spark):
    sequences = spark.createDataFrame([("uauaua", 10), ("suaua", 3), ("xx", 1)], "symbols string, blocks long")
    rules = c.learn(sequences)
    assert rules[0] == ("u", "a") and len(c.Grammar(rules).shorten("uauaua")) < 3
