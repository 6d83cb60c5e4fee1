"""Fingerprints of documents by consistent weighted sampling, in DataFrame operations alone.

The terms of a text are its words, weighted by how often they occur.  For each term and each of
SAMPLES samples a hash of both draws r and c from Gamma(2, 1) and b from [0, 1).  With weight S,

    t = floor(ln(S) / r + b),    ln(a) = ln(c) - r * (t - b + 1),

and the term with the least a is the sample; a hash of it and t is one number of the fingerprint.  Two
texts agree in a sample with a probability equal to their generalised Jaccard similarity: the sum of
the lesser weights over the sum of the greater ones.  `likeness` is the share of samples that agree.

* Draws come from one 64-bit hash of term and sample.  Gamma draws are quantiles at STEPS steps; those
  of c are interpolated, with a table of its own for the lowest step, where samples are won.
* The least a of a text of weight W is exponential with rate W.  So rows of (term, sample) with
  a >= REACH / W are left out before the aggregation; that a sample has no other has the probability
  exp(-REACH), 4e-18, which is far below that of two words with one 64-bit hash.
* Each text is shuffled once, by its key, and the beginning of its successor's text once.  Words are
  counted and sampled where the text lies; the aggregations need no further shuffle.

Rows are ordered by falling id; rows without an id come last, rows of one id by the hash of their text.
Rows that agree in id and text are one group: all but the last have a copy as next document.  The groups
are formed before the shuffle, so that repeated rows are one row.  Null texts are empty.  A text without
a word has the empty fingerprint, which is like any other empty one and unlike all others.  A single
document is its own next one.  An empty table gives an empty one.  Columns besides id and text are kept
by `fingerprints`, whatever their names, unless one is called `fingerprint`, which is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayloom.llm.frames import packed, ready, settle, unpacked

SAMPLES, REACH = 64, 40.0
_BITS = 10
STEPS = 1 << _BITS
_KEY = ["no_id", "key_id", "key_text"]
_SPACE = " \t\n\x0b\f\r"
_MASK = 0xFFFFFFFF
#: ln(a) is kept in steps of 2^-24 above -_LOWEST; it lies well within.
_STEP, _LOWEST = float(1 << 24), 64.0


def gamma_quantile(share: float) -> float:
    """The value below which Gamma(2, 1) falls with this probability, 1 - exp(-x) * (1 + x)."""
    low, high = 0.0, 60.0
    for _ in range(80):
        x = (low + high) / 2
        below = -math.expm1(-x) - x * math.exp(-x)
        low, high = (x, high) if below < share else (low, x)
    return (low + high) / 2


def tables() -> tuple[list[float], list[float], list[float]]:
    """Quantiles of r at the middle of each step; of ln(c) at the ends of steps; of ln(c) within the first."""
    r = [gamma_quantile((i + 0.5) / STEPS) for i in range(STEPS)]
    ends = [math.log(gamma_quantile(max(i, 1) / STEPS)) for i in range(STEPS)]
    ends.append(math.log(gamma_quantile(1 - 0.1 / STEPS)))
    lowest = [math.log(gamma_quantile((i + 0.5) / STEPS / STEPS)) for i in range(STEPS)]
    return r, ends, lowest


def _table(values: Sequence[float]) -> Column:
    """A constant array; Catalyst folds the text into one literal."""
    return F.split(F.lit(" ".join(map(repr, values))), " ").cast("array<double>")


def _field(hash_: str, low: int, count: int) -> Column:
    shifted = F.call_function("shiftrightunsigned", F.col(hash_), F.lit(low))
    return shifted.bitwiseAND(F.lit((1 << count) - 1))


def _words(text: Column) -> Column:
    """The words of a text; a text without one has the array of one null."""
    bare = F.btrim(text, F.lit(_SPACE))
    return F.when(bare == "", F.array(F.lit(None).cast("string"))).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def marks(texts: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, mark_0, mark_1, …): for each of the text `columns` its SAMPLES samples as an array of ints.

    `texts` is dealt by a subset of `keys`, which tell its rows apart, so nothing is shuffled again.  Rows
    without a word in any column are not in the result; the array of a text without a word is empty.
    """
    n = len(columns)
    every = range(n)
    words = texts.select(*keys, *[_words(F.col(c)).alias(f"words_{i}") for i, c in enumerate(columns)])
    totals = [F.when(F.col(f"words_{i}")[0].isNotNull(), F.size(f"words_{i}")).otherwise(0).alias(f"total_{i}") for i in every]
    sides = ", ".join(f"{i}, words_{i}" for i in every)
    totalled = words.select(*keys, *totals, *[f"words_{i}" for i in every])
    sided = totalled.select(*keys, *[f"total_{i}" for i in every], F.expr(f"stack({n}, {sides}) AS (side, words)"))
    found = sided.select(*keys, *[f"total_{i}" for i in every], "side", F.explode("words").alias("word")).where("word IS NOT NULL")
    terms = (
        found.withColumn("term", F.xxhash64("word"))
        .groupBy(*keys, *[f"total_{i}" for i in every], "term")
        .agg(*[F.count(F.when(F.col("side") == i, 1)).alias(f"weight_{i}") for i in every])
    )
    base = [*keys, "term", "sample", *[f"log_{i}" for i in every], *[f"reach_{i}" for i in every]]
    drawn = terms.select(
        *keys, "term",
        # Without a weight the logarithm is null, and so is all that follows from it.
        *[F.log(F.when(F.col(f"weight_{i}") > 0, F.col(f"weight_{i}"))).alias(f"log_{i}") for i in every],
        *[F.log(F.lit(REACH) / F.greatest(F.col(f"total_{i}"), F.lit(1))).alias(f"reach_{i}") for i in every],
        F.explode(F.array(*[F.lit(i) for i in range(SAMPLES)])).alias("sample"),
    ).select(*base, F.xxhash64("sample", "term").alias("h"))
    r_table, c_table, low_table = (_table(t) for t in tables())
    drawn = drawn.select(
        *base,
        r_table[_field("h", 64 - _BITS, _BITS).cast("int")].alias("r"),
        _field("h", 64 - 2 * _BITS, _BITS).cast("int").alias("step"),
        _field("h", 64 - 3 * _BITS, _BITS).cast("int").alias("part"),
        (_field("h", 0, 30).cast("double") / F.lit(float(1 << 30))).alias("b"),
    )
    share = F.col("part") / F.lit(float(STEPS))
    between = c_table[F.col("step")] * (F.lit(1.0) - share) + c_table[F.col("step") + 1] * share
    drawn = drawn.select(
        *base, "r", "b",
        F.when(F.col("step") == 0, low_table[F.col("part")]).otherwise(between).alias("log_c"),
        # Most weights are 1, where t is 0.
        *[F.when(F.col(f"log_{i}") == 0, F.lit(0).cast("long"))
          .otherwise(F.floor(F.col(f"log_{i}") / F.col("r") + F.col("b"))).alias(f"t_{i}") for i in every],
    )
    ranked = drawn.select(
        *base, *[f"t_{i}" for i in every],
        *[(F.col("log_c") - F.col("r") * (F.col(f"t_{i}").cast("double") - F.col("b") + 1.0)).alias(f"a_{i}") for i in every],
        # A filter on a column that isn't a function of the row stays above what it is computed from;
        # below it, every use of a column would compute the column again.
        F.spark_partition_id().alias("task"),
    ).where(f"({' OR '.join(f'a_{i} < reach_{i}' for i in every)}) AND task >= 0")

    def least(i: int) -> Column:
        rank = F.call_function("shiftleft", F.floor((F.col(f"a_{i}") + F.lit(_LOWEST)) * F.lit(_STEP)), F.lit(32))
        mark = F.xxhash64("term", f"t_{i}").bitwiseAND(F.lit(_MASK))
        return F.min(F.when(F.col(f"a_{i}") < F.col(f"reach_{i}"), rank.bitwiseOR(mark)))

    sampled = ranked.groupBy(*keys, "sample").agg(*[least(i).alias(f"least_{i}") for i in every])
    number = [(F.col(f"least_{i}").bitwiseAND(F.lit(_MASK)) - F.lit(1 << 31)).cast("int").alias(f"mark_{i}") for i in every]
    gathered = sampled.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("sample", *number))).alias("all"))
    return gathered.select(*keys, *[F.filter(F.col("all")[f"mark_{i}"], lambda x: x.isNotNull()).alias(f"mark_{i}") for i in every])


def rendered(mark: Column) -> Column:
    """A fingerprint as text: eight hexadecimal digits a sample; empty for a text without a word."""
    return F.array_join(F.transform(mark, lambda x: F.lpad(F.lower(F.hex(x.cast("long") + F.lit(1 << 31))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """The share of samples that agree; 1 for two empty fingerprints, 0 for an empty and another one."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1.0).otherwise(0.0)), F.lit(0.0), lambda s, x: s + x)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(same / F.lit(float(SAMPLES)))


def _keyed(docs: DataFrame, text: str, id: str) -> DataFrame:
    """(_KEY, in_text, rest): null ids have a key of their own, and no key is null."""
    return packed(docs, text, id).select(
        F.col("in_id").isNull().cast("int").alias("no_id"),
        F.coalesce("in_id", F.lit(0).cast("long")).alias("key_id"),
        F.xxhash64("in_text").alias("key_text"),
        "in_text", "rest",
    )


def _texts(keyed: DataFrame) -> DataFrame:
    """One row a key; repeated rows are left out before the shuffle."""
    return keyed.groupBy(*_KEY).agg(F.first("in_text").alias("in_text"))


def fingerprints(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """`docs` without its text, with `fingerprint`."""
    ready(docs.sparkSession)
    keyed = _keyed(docs, text, id)
    found = settle(marks(_texts(keyed), _KEY, ["in_text"]).select(*_KEY, rendered(F.col("mark_0")).alias("shown")))
    rows = keyed.select(*_KEY, "rest").join(found, _KEY, "left")
    return unpacked(rows, [c for c in docs.columns if c != text], {"fingerprint": F.coalesce("shown", F.lit(""))})


def successors(keyed: DataFrame) -> DataFrame:
    """(_KEY, n_chars, copy, times, next_*): each key with the next one's, the last with the first one's.

    Of `times` equal rows all but one have a copy of themselves as next; they are a row with `copy` true.
    Only keys are ordered: they are sorted by range, and a range's last key is joined with the first
    key of the next range.
    """
    groups = keyed.groupBy(*_KEY).agg(F.count("*").alias("rows"), F.max(F.char_length("in_text")).cast("long").alias("n_chars"))
    order = [F.col("no_id"), F.col("key_id").desc(), F.col("key_text")]
    placed = settle(
        groups.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    )
    key = F.struct(*_KEY)
    ranged = placed.withColumn("range", F.call_function("shiftright", "place", F.lit(33)))
    firsts = ranged.where(F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) == 0).select("range", key.alias("first"))
    in_turn = Window.orderBy("range")  # one row a range
    whole = in_turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select("range", F.coalesce(F.lead("first").over(in_turn), F.first("first").over(whole)).alias("after"))
    within = Window.partitionBy("range").orderBy("place")
    linked = ranged.withColumn("next", F.lead(key).over(within)).join(after, "range")
    both = F.array(
        F.struct(F.lit(True).alias("copy"), (F.col("rows") - 1).alias("times"), key.alias("next")),
        F.struct(F.lit(False).alias("copy"), F.lit(1).cast("long").alias("times"), F.coalesce("next", "after").alias("next")),
    )
    out = linked.select(*_KEY, "n_chars", F.inline(both)).where("times > 0")
    return out.select(*_KEY, "n_chars", "copy", "times", *[F.col(f"next.{c}").alias(f"next_{c}") for c in _KEY])


def edited(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each row.

    The edited text is the text with its last third of code points replaced by the beginning of the next text.
    """
    ready(docs.sparkSession)
    keyed = _keyed(docs, text, id).drop("rest")
    pairs = settle(successors(keyed))
    texts = _texts(keyed)
    third = F.expr("n_chars div 3")
    named = texts.withColumnsRenamed({c: f"next_{c}" for c in _KEY})
    begun = named.join(pairs, [f"next_{c}" for c in _KEY]).select(
        *_KEY, "copy", "times", "n_chars", F.substr("in_text", F.lit(1), third).alias("begin")
    )
    joined = texts.join(begun, _KEY).select(
        *_KEY, "copy", "times", "n_chars", "in_text",
        F.concat(F.substr("in_text", F.lit(1), F.col("n_chars") - third), F.col("begin")).alias("edited_text"),
    )
    one = [*_KEY, "copy"]
    # Facts and samples of one join are written together, so that its shuffles serve both.
    none = F.lit(None).cast("array<int>")
    facts = joined.select(*one, "times", "n_chars", F.sha2("edited_text", 256).alias("sha"), none.alias("mark_0"), none.alias("mark_1"))
    sampled = marks(joined, one, ["in_text", "edited_text"])
    blank = [F.lit(None).cast("long").alias("times"), F.lit(None).cast("long").alias("n_chars"), F.lit(None).cast("string").alias("sha")]
    both = settle(facts.unionByName(sampled.select(*one, *blank, "mark_0", "mark_1")))
    empty = F.array().cast("array<int>")
    shown = settle(
        both.where("times IS NOT NULL")
        .drop("mark_0", "mark_1")
        .join(both.where("times IS NULL").select(*one, "mark_0", "mark_1"), one, "left")
        .withColumns({m: F.coalesce(m, empty) for m in ("mark_0", "mark_1")})
    )
    own = shown.where("NOT copy").select(*[F.col(c).alias(f"next_{c}") for c in _KEY], F.col("mark_0").alias("next_mark"))
    rows = shown.join(pairs.drop("n_chars", "times"), one).join(own, [f"next_{c}" for c in _KEY])
    return rows.select(
        F.when(F.col("no_id") == 0, F.col("key_id")).alias("doc_id"),
        "n_chars",
        F.col("sha").alias("edited_sha256"),
        rendered(F.col("mark_0")).alias("fingerprint"),
        rendered(F.col("mark_1")).alias("edited_fingerprint"),
        likeness(F.col("mark_0"), F.col("mark_1")).alias("near_edited"),
        likeness(F.col("mark_0"), F.col("next_mark")).alias("near_next"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("turn"),
    ).drop("turn")


def digest(docs: DataFrame) -> DataFrame:
    return edited(docs.select("doc_id", "text"))
