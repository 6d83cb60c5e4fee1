"""Conversation repair against a plain search over edits, row by row."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stayloom.llm import conversations as c
from stayloom.llm.frames import documents

SPACE = " \t\n\x0b\f\r"


def plain(rows):
    """rows: (turn, role, text) after damage, in order.  The result of one conversation."""
    seen, initials, kinds = set(), [], []
    counts = dict(blank=0, duplicate=0, truncated=0)
    for _, role, text in rows:
        bare = text.strip(SPACE)
        kind = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if kind:
            counts[kind] += 1
        kinds.append(kind)
        initials.append(role[:1])
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0

    def nexts(out):
        if out == "":
            return "su"
        return {"s": "u", "u": "a", "a": "u"}[out]

    def least(table, key, value):
        if key not in table or value < table[key]:
            table[key] = value

    # (initial last written) -> (cost, audit, lines)
    state = {"": (0, "", ())}

    def insert(state):
        for _ in range(3):
            more = dict(state)
            for out, (cost, audit, lines) in state.items():
                for r in nexts(out):
                    if r != "s":
                        least(more, r, (cost + 3, audit + "I", (*lines, f"{'user' if r == 'u' else 'assistant'}:")))
            state = more
        return state

    for (_, role, text), kind in zip(rows, kinds, strict=True):
        new = {}
        for out, (cost, audit, lines) in insert(state).items():
            least(new, out, (cost + 4, audit + "D", lines))
            if kind in ("blank", "duplicate"):
                continue
            extra = 3 if kind == "truncated" else 0
            for r in nexts(out):
                if r == role[:1]:
                    least(new, r, (cost + extra, audit + "K", (*lines, f"{role}:{text}")))
                if r != "s":
                    least(new, r, (cost + extra + 3, audit + "R", (*lines, f"{'user' if r == 'u' else 'assistant'}:{text}")))
        state = new
    cost, audit, lines = min(v for k, v in insert(state).items() if k in ("", "a"))
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 1:
            text = ""
        elif fault == 2:
            text = text.translate({ord(x): None for x in ".!?"})
        elif fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def expected(rows):
    by = defaultdict(list)
    for conv, turn, role, text in damage(rows):
        by[conv].append((turn, role, text))
    for held in by.values():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return {conv: plain(by[conv]) for conv in {r[0] for r in rows}}


def got(df):
    rows = df.collect()
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    out = {r["conv_id"]: tuple(r[n] for n in names) for r in rows}
    assert len(out) == len(rows)
    return out


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def made(seed, conversations, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(rng.choice([1, 2, 3, rng.randint(1, longest)])):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "User", "agent"])
            text = rng.choice(["Yes.", "So it is!", "no end", "", None, " \t", "What?\n", "é…"]) if rng.random() < 0.5 else f"{rng.random()}."
            rows.append((conv if conv else None, rng.choice([turn, turn, turn, turn + 5, None]), role, text))
    return rows + rows[:3]


@pytest.mark.parametrize(("chunk", "seed"), [(4096, 1), (3, 2), (1, 3)])
def test_equals_a_plain_search(spark, chunk, seed):
    rows = made(seed, 60, 40)
    assert got(c.digest(spark.createDataFrame(rows, SCHEMA).repartition(5), chunk)) == expected(rows)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in documents(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert got(c.digest(documents(spark, folder, "conversations"))) == expected(rows)


def test_a_conversation_of_many_pieces(spark):
    rng = random.Random(5)
    rows = [(7, i, rng.choice(["user", "assistant"]), f"{i % 900} words{rng.choice(['.', ''])}") for i in range(10_000)]
    rows += [(8, 0, "user", "Hi.")]
    assert got(c.digest(spark.createDataFrame(rows, SCHEMA).repartition(6))) == expected(rows)


def test_pieces_join_wherever_they_are_cut():
    rng = random.Random(4)
    for _ in range(60):
        symbols = [rng.randrange(9) for _ in range(rng.randint(1, 60))]
        grammar = c.Grammar()
        for _ in range(3):
            counts = c.pair_counts(grammar.shorten(symbols))
            grammar.extend(p for p, _ in counts.most_common(4))
        whole, parts = c.Path(), c.Path()
        for s in symbols:
            whole.step(grammar.matrices[s])
        cut = rng.randint(0, len(symbols))
        short = grammar.shorten(symbols[:cut]) + grammar.shorten(symbols[cut:])
        assert len(short) <= len(symbols)
        for s in short:
            parts.step(grammar.matrices[s])
        assert whole.end() == parts.end()


def test_rules_expand_to_what_they_replace():
    grammar, symbols = c.Grammar(), [0, 1, 2, 1, 2, 1, 2, 8, 8, 8, 1, 2]
    while grammar.extend(p for p, n in c.pair_counts(grammar.shorten(symbols)).most_common() if n > 1):
        pass
    pairs = {new: pair for rules in grammar.rounds for pair, new in rules.items()}

    def spelt(s):
        return [s] if s not in pairs else spelt(pairs[s][0]) + spelt(pairs[s][1])

    assert [x for s in grammar.shorten(symbols) for x in spelt(s)] == symbols
    assert c.pair_counts([5, 5, 5])[5, 5] == 1 and c.pair_counts([5, 5, 5, 5])[5, 5] == 2


def test_nothing_left_and_empty(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)
    assert got(c.digest(df)) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert c.digest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_other_columns_do_not_matter(spark):
    rows = made(6, 10, 6)
    plain_rows = spark.createDataFrame(rows, SCHEMA)
    clashing = plain_rows.withColumns({"n": F.lit("x"), "kind": F.lit(1), "place": F.lit(2), "audit": F.lit("K")})
    assert got(c.digest(clashing)) == got(c.digest(plain_rows))
