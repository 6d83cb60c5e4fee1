"""Repair of the structure of conversations by a grammar-compressed dynamic programme.

A row of a conversation is one of nine symbols: its role's initial (s, u, a or another) with or without a
truncated text, or a row that has to go.  A symbol's transfer matrix tells for each pair of states of the
automaton of `(s?(ua)+)?` the least cost of edits that lead from one to the other, with its audit; the
insertions before the row are part of it.  Matrices are joined by min-plus products, ties by the audit.

* Rows are sorted by range of (conversation, turn, role, text), so that a conversation of any length is
  dealt out; each task writes its pieces of conversations as strings of at most CHUNK symbols.
* Re-Pair: over the distinct strings, rounds of counting adjacent pairs in Spark.  The most frequent
  pairs that don't share a symbol become rules, at most RULES a round and ROUNDS rounds; a pair that occurs
  once is no rule.  What the bounds leave unpaired stays as it is and costs a product more.
* A rule's matrix is the product of its two symbols' matrices, made when the rule is, so bottom-up; each
  entry is a cost and a rope that shares its parts.  All conversations use the same matrices.
* Per conversation a vector of four states passes over the symbols of its pieces.  Audits are linked
  ropes.  Two states' audits differ either for good, and then only their order is kept, or by trailing
  insertions, so that no audit is spelt out before the end.
* The pieces of a conversation and after them its rows come to one task in order, which streams the
  repaired rows into SHA-256; no conversation is held but for its audit, one character an edit.

Null role and text are a space.  Rows are ordered by turn (nulls first), role, text; equal rows are one
row with a count until then.  A role without a first letter s, u or a, an empty one too, cannot be kept.
Null conversations are one conversation.  Conversations without rows left have zeros, the empty audit and
the hash of nothing.  Gaps beyond a long are its end.  An empty table gives an empty one; other columns
don't matter, whatever their names.  Duplicates are told by the SHA-256 of their text.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayloom.llm.frames import ready, settle

CHUNK, RULES, ROUNDS = 4096, 512, 8
RENAME, DELETE, INSERT, CUT = 3, 4, 3, 3  # costs; CUT is added to a truncated row that stays
_SPACE = " \t\n\x0b\f\r"
_KEY = ["no_conv", "key_conv"]

# States: 0 nothing yet, 1 after s, 2 after u, 3 after a.  An s only comes first.
_STATES = range(4)
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_ENDS = (0, 3)


class Rope:
    """A text made of two ropes, spelt out when first compared."""

    __slots__ = ("left", "right", "_text")

    def __init__(self, left: Rope | None = None, right: Rope | None = None, text: str | None = None):
        self.left, self.right, self._text = left, right, text

    @property
    def text(self) -> str:
        if self._text is None:
            self._text = self.left.text + self.right.text
        return self._text


Matrix = list[list[tuple[int, Rope] | None]]


def product(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product; of equal costs the least audit.

    Audits of one entry cover the same rows, so that one cannot be the beginning of another at the same
    cost: it would have an insertion more.  Hence the order of joined audits is that of their parts.
    """
    out: Matrix = [[None] * 4 for _ in _STATES]
    for p in _STATES:
        for q in _STATES:
            best: tuple[int, Rope] | None = None
            for m in _STATES:
                if a[p][m] is None or b[m][q] is None:
                    continue
                cost, rope = a[p][m][0] + b[m][q][0], Rope(a[p][m][1], b[m][q][1])
                if best is None or cost < best[0] or (cost == best[0] and rope.text < best[1].text):
                    best = (cost, rope)
            out[p][q] = best
    return out


def _steps(edges: Iterable[tuple[int, int, int, str]]) -> Matrix:
    out: Matrix = [[None] * 4 for _ in _STATES]
    for p, q, cost, text in edges:
        if out[p][q] is None or (cost, text) < (out[p][q][0], out[p][q][1].text):
            out[p][q] = (cost, Rope(text=text))
    return out


def insertions() -> Matrix:
    """Any number of insertions; more than two lead nowhere new."""
    one = [(p, q, INSERT, "I") for (p, letter), q in _NEXT.items() if letter != "s"]
    two = [(p, r, 2 * INSERT, "II") for p, q, _, _ in one for o, r, _, _ in one if o == q]
    return _steps([(p, p, 0, "") for p in _STATES] + one + two)


def symbol(initial: str, truncated: bool, must_go: bool) -> int:
    """0 to 3 by initial, 4 to 7 if truncated, 8 if the row has to go."""
    return 8 if must_go else ("sua".find(initial) % 4 if initial else 3) + 4 * truncated


def leaf(number: int) -> Matrix:
    """Insertions, then one row of the symbol."""
    edges = [(p, p, DELETE, "D") for p in _STATES]
    if number < 8:
        more = CUT * (number >= 4)
        edges += [(p, q, more, "K") for (p, letter), q in _NEXT.items() if letter == "sua."[number % 4]]
        edges += [(p, q, RENAME + more, "R") for (p, letter), q in _NEXT.items() if letter != "s"]
    return product(insertions(), _steps(edges))


# --- the grammar ------------------------------------------------------------------------------


@dataclass
class Grammar:
    """Rules of each round, symbol by symbol, and the matrices of all symbols."""

    rounds: list[dict[tuple[int, int], int]] = field(default_factory=list)
    matrices: list[Matrix] = field(default_factory=lambda: [leaf(i) for i in range(9)])

    def shorten(self, sequence: Sequence[int]) -> list[int]:
        """The sequence with each round's pairs replaced from left to right."""
        out = list(sequence)
        for rules in self.rounds:
            read, out, i = out, [], 0
            while i < len(read):
                new = rules.get((read[i], read[i + 1])) if i + 1 < len(read) else None
                out.append(read[i] if new is None else new)
                i += 1 if new is None else 2
        return out

    def extend(self, pairs: Iterable[tuple[int, int]]) -> int:
        """A round of rules from pairs, the most frequent first; a symbol ends pairs or begins them."""
        rules: dict[tuple[int, int], int] = {}
        begins, ends = set(), set()
        for a, b in pairs:
            if a == b and (a in begins or a in ends) or a != b and (a in ends or b in begins):
                continue
            begins.add(a)
            ends.add(b)
            rules[a, b] = len(self.matrices)
            self.matrices.append(product(self.matrices[a], self.matrices[b]))
        if rules:
            self.rounds.append(rules)
        return len(rules)


def _numbers(symbols: str) -> list[int]:
    return [ord(c) - 97 for c in symbols]


def pair_counts(sequence: Sequence[int]) -> Counter:
    """Adjacent pairs; of a run of one symbol every other pair, as they would be replaced."""
    found, i = Counter(), 0
    while i + 1 < len(sequence):
        pair = sequence[i], sequence[i + 1]
        found[pair] += 1
        i += 2 if pair[0] == pair[1] and sequence[i + 1 : i + 3] == [pair[0]] * 2 else 1
    return found


def build_grammar(strings: DataFrame) -> Grammar:
    """Re-Pair over the distinct strings in column symbols."""
    grammar = Grammar()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def rows() -> pa.RecordBatch:
            keys = list(found)
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
                 pa.array([found[k] for k in keys], pa.int64())], ["a", "b", "n"],
            )

        for batch in batches:
            for s in batch.column(0).to_pylist():
                found += pair_counts(grammar.shorten(_numbers(s)))
            if len(found) > 100_000:
                yield rows()
                found.clear()
        if found:
            yield rows()

    for _ in range(ROUNDS):
        counted = strings.select("symbols").mapInArrow(count, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
        most = counted.where("n > 1").orderBy(F.desc("n"), "a", "b").limit(RULES).collect()
        if not grammar.extend((r["a"], r["b"]) for r in most):
            break
    return grammar


# --- conversations ----------------------------------------------------------------------------


class Path:
    """The cheapest edits up to here for each state, with audits as linked ropes."""

    def __init__(self) -> None:
        self.live: dict[int, tuple[int, tuple | None]] = {0: (0, None)}
        #: For states p < q: -1 or 1 if their audits differ for good, else what each has beyond the other.
        self.order: dict[tuple[int, int], int | tuple[str, str]] = {}

    def _tails(self, p: int, a: str, q: int, b: str) -> int | tuple[str, str]:
        """The order of p's audit with a after it and q's with b."""
        if p != q:
            known = self.order[min(p, q), max(p, q)]
            if isinstance(known, int):
                return known if p < q else -known
            first, second = known if p < q else known[::-1]
            a, b = first + a, second + b
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        a, b = a[n:], b[n:]
        return (-1 if a < b else 1) if a and b else (a, b)

    def step(self, matrix: Matrix) -> None:
        best: dict[int, tuple[int, int, str]] = {}
        for p, (spent, _) in self.live.items():
            for q in _STATES:
                if matrix[p][q] is None:
                    continue
                cost, text = spent + matrix[p][q][0], matrix[p][q][1].text
                if q in best and (best[q][0] < cost or best[q][0] == cost and self._tails(best[q][1], best[q][2], p, text) == -1):
                    continue
                best[q] = (cost, p, text)
        states = sorted(best)
        order = {
            (q, r): self._tails(best[q][1], best[q][2], best[r][1], best[r][2])
            for i, q in enumerate(states) for r in states[i + 1 :]
        }
        self.live = {q: (cost, (self.live[p][1], text)) for q, (cost, p, text) in best.items()}
        self.order = order

    def end(self) -> tuple[int, str]:
        """The least cost and audit of a whole conversation."""
        self.step(_LAST)
        found = [q for q in _ENDS if q in self.live]
        least = min(self.live[q][0] for q in found)
        found = [q for q in found if self.live[q][0] == least]
        if len(found) == 2 and self._tails(found[0], "", found[1], "") == 1:
            found.reverse()
        pieces, node = [], self.live[found[0]][1]
        while node is not None:
            pieces.append(node[1])
            node = node[0]
        return least, "".join(reversed(pieces))


_LAST = insertions()


@dataclass
class Facts:
    """What is known of consecutive rows of a conversation."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str | None = None  # initials
    last: str | None = None
    low: int | None = None  # turns
    high: int | None = None
    turns: int = 0

    def add(self, later: Facts) -> None:
        if self.last is not None and later.first is not None:
            self.illegal += self.last + later.first not in ("su", "ua", "au")
        self.blank, self.duplicate = self.blank + later.blank, self.duplicate + later.duplicate
        self.truncated, self.illegal = self.truncated + later.truncated, self.illegal + later.illegal
        self.first = later.first if self.first is None else self.first
        self.last = self.last if later.last is None else later.last
        if later.low is not None:
            self.turns += later.turns - (self.high == later.low)
            self.low, self.high = later.low if self.low is None else self.low, later.high

    def gaps(self) -> int:
        return 0 if self.low is None else min(self.high - self.low + 1 - self.turns, 2**63 - 1)


_FACTS = "blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, turns long"
_FACT_NAMES = [f.split()[0] for f in _FACTS.split(", ")]
_PIECES = f"no_conv int, key_conv string, place long, symbols string, {_FACTS}"


def _cut(chunk: int):
    """Streams rows in order into strings of at most `chunk` symbols with their facts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 33
        key, letters, facts, out = None, [], Facts(), []

        def close() -> None:
            nonlocal place, letters, facts
            if letters:
                out.append((*key, place, "".join(letters), *[getattr(facts, f) for f in _FACT_NAMES]))
                place += 1
            letters, facts = [], Facts()

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("no_conv", "key_conv", "turn", "initial", "blank", "truncated", "fresh", "n")]
            for no_conv, key_conv, turn, initial, blank, truncated, fresh, n in zip(*columns, strict=True):
                if key != (no_conv, key_conv):
                    close()
                    key = (no_conv, key_conv)
                for copy in range(n):
                    again = not blank and (copy > 0 or not fresh)
                    cut = truncated and not blank and not again
                    one = Facts(int(blank), int(again), int(cut), 0, initial, initial)
                    if turn is not None:
                        one.low, one.high, one.turns = turn, turn, 1
                    facts.add(one)
                    letters.append(chr(97 + symbol(initial, cut, blank or again)))
                    if len(letters) == chunk:
                        close()
                    if len(out) >= 1000:
                        yield _batch(_PIECES, out)
            if out:
                yield _batch(_PIECES, out)
        close()
        if out:
            yield _batch(_PIECES, out)

    return run


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    """The rows as a batch; the list is emptied."""
    fields, kinds = [c.split() for c in schema.split(", ")], {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    columns = [pa.array(v, kinds[kind]) for v, (_, kind) in zip(zip(*rows, strict=True), fields, strict=True)]
    rows.clear()
    return pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])


class Repaired:
    """Rows of one conversation, edited and hashed as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.empty = audit, 0, 0, True
        self.hash = hashlib.sha256()

    def _write(self, role: str, text: str) -> None:
        self.hash.update((("" if self.empty else "\n") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.empty, self.state = False, _NEXT[self.state, role[0]]

    def _wanted(self) -> str:
        return "assistant" if self.state == 2 else "user"

    def _inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._write(self._wanted(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._write(role if edit == "K" else self._wanted(), text)

    def digest(self) -> str:
        self._inserted()
        return self.hash.hexdigest()


_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_ANSWERS = "no_conv int, key_conv string, " + _RESULT


def _repaired(grammar: Grammar):
    """Streams a conversation's mark (kind 0), its pieces (1), its rows (2) into one result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shortened: dict[str, list[int]] = {}
        key, facts, path, rows, answer, out = None, Facts(), Path(), None, (0, ""), []

        def close() -> None:
            if key is None:
                return
            done = rows or Repaired(answer[1])
            counts = (facts.gaps(), facts.blank, facts.duplicate, facts.truncated, facts.illegal)
            out.append((*key, *counts, *answer, done.digest()))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in batch.schema.names]
            for row in zip(*columns, strict=True):
                named = dict(zip(batch.schema.names, row, strict=True))
                if key != (named["no_conv"], named["key_conv"]):
                    close()
                    key, facts, path, rows, answer = (named["no_conv"], named["key_conv"]), Facts(), Path(), None, (0, "")
                if named["kind"] == 1:
                    facts.add(Facts(*[named[f] for f in _FACT_NAMES]))
                    symbols = named["symbols"]
                    if symbols not in shortened:
                        if len(shortened) >= 10_000:
                            shortened.clear()
                        shortened[symbols] = grammar.shorten(_numbers(symbols))
                    for s in shortened[symbols]:
                        path.step(grammar.matrices[s])
                elif named["kind"] == 2:
                    if rows is None:
                        answer = path.end()
                        rows = Repaired(answer[1])
                    for _ in range(named["n"]):
                        rows.row(named["role"], named["text"])
            if out:
                yield _batch(_ANSWERS, out)
        close()
        if out:
            yield _batch(_ANSWERS, out)

    return run


def _keys(conv: Column) -> list[Column]:
    return [conv.isNull().cast("int").alias("no_conv"), F.coalesce(conv.cast("string"), F.lit("")).alias("key_conv")]


def _rows(rows: DataFrame) -> DataFrame:
    """(_KEY, turn, role, text, n): equal rows counted; null role and text are a space."""
    blank = F.lit(" ")
    return rows.select(
        *_keys(F.col("conv_id")), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), F.col("n"),
    ).groupBy(*_KEY, "turn", "role", "text").agg(F.sum("n").alias("n"))


def repair(rows: DataFrame, all_ids: DataFrame | None = None, chunk: int = CHUNK) -> DataFrame:
    """One row per conversation of `rows` (conv_id, turn, role, text and, if there, n: how often the row
    occurs), and of `all_ids` (conv_id): the result columns of `_RESULT`."""
    ready(rows.sparkSession)
    rows = rows if "n" in rows.columns else rows.withColumn("n", F.lit(1).cast("long"))
    ids = (rows if all_ids is None else all_ids).select("conv_id")
    kind = ids.schema["conv_id"].dataType
    counted = settle(_rows(rows))
    bare = F.btrim("text", F.lit(_SPACE))
    marked = counted.withColumns({
        "initial": F.substring("role", 1, 1),
        "blank": bare == "",
        "truncated": ~F.substring(bare, -1, 1).isin(".", "!", "?"),
        "known": F.col("turn").isNotNull().cast("int"),
        "text_id": F.unhex(F.sha2("text", 256)),
    })
    same = [*_KEY, "role", "text_id"]
    firsts = marked.where("NOT blank").groupBy(*same).agg(F.min("known").alias("first_known"), F.min("turn").alias("first_turn"))
    fresh = (F.col("known") == F.col("first_known")) & ((F.col("known") == 0) | (F.col("turn") == F.col("first_turn")))
    order = [*[F.col(c) for c in _KEY], F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    placed = (
        marked.join(firsts, same, "left")
        .withColumn("fresh", F.coalesce(fresh, F.lit(False)))
        .select(*_KEY, "turn", "role", "text", "n", "initial", "blank", "truncated", "fresh")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("role", "text")
    )
    pieces = settle(placed.mapInArrow(_cut(chunk), _PIECES))
    grammar = build_grammar(settle(pieces.select("symbols").distinct()))
    sides = [
        ids.select(*_keys(F.col("conv_id"))).distinct().withColumn("kind", F.lit(0)),
        pieces.withColumn("kind", F.lit(1)),
        counted.withColumn("kind", F.lit(2)),
    ]
    all_rows = sides[0].unionByName(sides[1], True).unionByName(sides[2], True)
    order = [*[F.col(c) for c in _KEY], F.col("kind"), F.col("place"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    streamed = all_rows.repartition(*_KEY).sortWithinPartitions(*order)
    found = streamed.mapInArrow(_repaired(grammar), _ANSWERS)
    return found.select(
        F.when(F.col("no_conv") == 0, F.col("key_conv")).cast(kind).alias("conv_id"), *[c.split()[0] for c in _RESULT.split(", ")]
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults by crc32 of `conv_id:turn` modulo 20: 0 drops a row, 1 empties its text, 2 takes
    its . ! ? away, 3 doubles it, 4 makes it the user's; nulls are a space."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fault, text = F.col("fault"), F.coalesce(F.col("text"), space)
    return rows.withColumn("fault", F.crc32(name.cast("binary")) % 20).where("fault != 0").select(
        "conv_id", "turn",
        F.when(fault == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 3, 2).otherwise(1).cast("long").alias("n"),
    )


def digest(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    rows = conversations.select("conv_id", "turn", "role", "text")
    return repair(damaged(rows), rows, chunk)
