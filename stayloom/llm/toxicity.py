"""Toxicity by the nearest labelled examples: exact weighted TF-IDF cosine over a block-max inverted index.

* Examples: at most `rows` labelled documents.  All their terms are the vocabulary.
* Inverse document frequencies of these terms are counted over all documents.  A term's weight is
  multiplied by 1 + the chi-squared of its example counts with the label, so terms that go with the
  label decide and no term is left out.
* Index: the commonest terms, which stand in most texts, are a matrix; a batch of texts is multiplied
  with it at once.  Each other term has a list of (example, impact), cut into blocks of consecutive
  examples with the greatest impact of each block.  A text's best blocks by the sum of these bounds are
  scored first; blocks whose bound is below the k-th best cosine are left out, which changes no result.
* The k nearest examples vote with weights that fall with distance.  Votes become probabilities by an
  isotonic fit on the examples' own votes, each without itself.  The nearest examples are given as evidence.

Terms are runs of letters, lower-cased.  A text with no term of the vocabulary, an empty or a null one
gets the rate of the label among examples without a term, drawn to the rate of all by one row.  With no examples every score is 0.  Labels,
language, source and id are never inputs.  Equal cosines go to the smaller example number.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayloom.llm import arrays
from stayloom.llm.frames import packed, ready, unpacked
from stayloom.llm.samples import fitted, labelled, share

ROWS = 8192
NEAREST = 9
BLOCK = 1024
FIRST = 4  # blocks scored before the others are held against the k-th best
HEAD = 512  # terms in the matrix
BATCH = 256  # texts multiplied with it at once
SLACK = 1e-5  # for the rounding of its product and of bounds; what is nearer is computed anew
SOFT = 0.1  # added to distances
SHARP = 4  # power of the cosine in a vote
PRIOR = 0.3  # weight of the rate without neighbours in a vote
THRESHOLD = 0.5

_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[128:] = True


def terms(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, rows, term hashes and their rows, by blocks."""
    for first, data, offsets in arrays.blocks(pc.utf8_lower(texts)):
        start, end, bounds = arrays.words(data, offsets, _LETTER)
        yield first, len(offsets) - 1, arrays.word_hashes(data, start, end), arrays.rows_of(bounds)


def known(hashes: np.ndarray, row: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, tf) of the vocabulary's terms, a row's together."""
    if not len(vocabulary):
        return (np.zeros(0, np.int64),) * 3
    words, back = np.unique(hashes, return_inverse=True)
    at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
    hit, at = (vocabulary[at] == words)[back], at[back]
    keys, many = np.unique(row[hit] * len(vocabulary) + at[hit], return_counts=True)
    return keys // len(vocabulary), keys % len(vocabulary), many


@dataclass
class Examples:
    """The vocabulary and the examples' term counts."""

    vocabulary: np.ndarray
    rows: list = field(default_factory=list)  # (terms, counts) of each example
    ids: np.ndarray | None = None
    labels: np.ndarray | None = None
    strength: np.ndarray | None = None  # factor of each term's weight; None is 1

    def flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How many terms each example has, and the terms and counts of one example after the other."""
        if isinstance(self.rows, tuple):
            return self.rows
        parts = [np.concatenate([np.zeros(0, np.int32), *[r[k] for r in self.rows]], dtype=np.int32, casting="unsafe") for k in (0, 1)]
        return np.array([len(t) for t, _ in self.rows], np.int64), *parts

    def __getstate__(self) -> dict:
        """Flat and in 32 bits: the driver gets all of it as one value, and tasks keep it so."""
        return self.__dict__ | {"rows": self.flat()}


def families(texts: pa.ChunkedArray) -> np.ndarray:
    """For each text the least hash of its five-word shingles: copies and most near copies agree in it."""
    out = [np.zeros(0, np.uint64)]
    for _, data, offsets in arrays.blocks(texts):
        start, end, bounds = arrays.words(data, offsets)
        hashes, least = arrays.word_hashes(data, start, end), np.full(len(offsets) - 1, np.iinfo(np.uint64).max)
        row = arrays.rows_of(bounds)
        inner = np.flatnonzero(row[4:] == row[:-4]) if len(row) > 4 else np.zeros(0, np.int64)
        np.minimum.at(least, row[inner], arrays.windows(hashes, 5)[inner])
        out.append(least)
    return np.concatenate(out)


def choose(ids: np.ndarray, texts: pa.ChunkedArray, labels: np.ndarray) -> Examples:
    """All terms, and how they go with the label. Copies of one text count once, else all its words would seem to."""
    kind = np.unique(families(texts), return_inverse=True)[1]
    pairs = [np.stack([h, (r + first).astype(np.uint64)]) for first, _, h, r in terms(texts)]
    pairs = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.uint64)
    words, back = np.unique(pairs[0], return_inverse=True)
    row = pairs[1].astype(np.int64)
    made = Examples(words, [(np.zeros(0, np.int64),) * 2 for _ in ids], ids, labels)
    keys, many = np.unique(row * max(1, len(words)) + back, return_counts=True)
    at, term = keys // max(1, len(words)), keys % max(1, len(words))
    cuts = np.flatnonzero(np.diff(at, prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(at)]):
        made.rows[at[a]] = (term[a:b], many[a:b])
    family = kind[row] * 2 + labels[row] if len(row) else row
    once = np.unique(back * (2 * len(kind) + 2) + family)
    back, toxic_one = once // (2 * len(kind) + 2), once % 2
    toxic = np.bincount(back, weights=toxic_one, minlength=len(words))
    every = np.unique(kind * 2 + labels) if len(kind) else kind
    some, n, positive = np.bincount(back, minlength=len(words)), len(every), (every % 2).sum()
    expected = some * positive / max(1, n)
    spread = expected * (1 - positive / max(1, n)) * (1 - some / max(1, n))
    off = np.maximum(0, np.abs(toxic - expected) - 0.5)
    made.strength = 1 + np.where((spread > 0) & (some > 1), off**2 / np.maximum(spread, 1e-9), 0)
    return made


class Index:
    """The commonest terms as a matrix, the others in inverted lists with blocks of examples.

    `column` is a term's column in the matrix `head` or -1.  `first` has each other term's entries, one
    for each block it stands in; an entry has its block, its greatest impact and where its part of the
    list (`example`, `impact`) begins.
    """

    def __init__(self, examples: Examples, frequency: np.ndarray, documents: int, steps: tuple | None = None):
        self.vocabulary, self.ids, self.labels = examples.vocabulary, examples.ids, examples.labels
        self.scale = np.log((1 + documents) / (1 + frequency)) + 1
        if examples.strength is not None:
            self.scale = self.scale * examples.strength
        self.blocks = -(-len(self.ids) // BLOCK)
        size, term, many = examples.flat()
        ends = np.cumsum(size)
        impact = (1 + np.log(many)) * self.scale[term]
        for z, n in zip(ends.tolist(), size.tolist()):
            if n:
                impact[z - n : z] /= np.sqrt((impact[z - n : z] ** 2).sum())
        own = np.repeat(np.arange(len(size), dtype=np.int32), size)
        # Only the fit of the probabilities needs the examples as texts.
        self.vectors = None if steps is not None else [(term[z - n : z], impact[z - n : z]) for z, n in zip(ends.tolist(), size.tolist())]
        common = np.argsort(-np.bincount(term, minlength=len(self.vocabulary)), kind="stable")[:HEAD]
        self.column = np.full(len(self.vocabulary), -1, np.int32)
        self.column[common] = np.arange(len(common))
        in_head = self.column[term] >= 0
        # The matrix's exact values by example, and rounded ones as a matrix to multiply with.
        row, self.head_column, self.head_impact = own[in_head], self.column[term[in_head]], impact[in_head]
        self.head_begin = np.searchsorted(row, np.arange(len(size) + 1))
        self.rounded = np.zeros((len(common), len(size)), np.float32)
        self.rounded[self.head_column, row] = self.head_impact
        own, term, impact = own[~in_head], term[~in_head], impact[~in_head]
        del many, in_head, row
        order = np.argsort(term, kind="stable")
        self.example, self.impact, term = own[order], impact[order], term[order]
        del own, impact, order
        entry = term.astype(np.int64) * max(1, self.blocks) + self.example // BLOCK
        begin = np.flatnonzero(np.diff(entry, prepend=-1))
        self.begin = np.append(begin, len(entry))
        self.block = (self.example[begin] // BLOCK).astype(np.int32)
        self.most = np.maximum.reduceat(self.impact, begin) if len(begin) else np.zeros(0)
        self.first = np.searchsorted(term[begin], np.arange(len(self.vocabulary) + 1))
        none = size == 0
        rate = (self.labels.sum() + 0.5) / (len(self.ids) + 1)
        self.base = (self.labels[none].sum() + rate) / (none.sum() + 1) if len(self.ids) else 0.0
        self.steps = (np.zeros(0), np.zeros(0)) if steps is None else steps
        if self.vectors is None:
            return
        some = np.flatnonzero(~none)
        sides = self.products([self.vectors[k] for k in some])
        votes = np.array([self.vote(*self.vectors[k], k, side)[0] for k, side in zip(some, sides)])
        self.steps = isotonic(votes, self.labels[some]) if len(some) else self.steps

    def unit(self, term: np.ndarray, many: np.ndarray) -> np.ndarray:
        weight = (1 + np.log(many)) * self.scale[term]
        return weight / np.sqrt((weight**2).sum()) if len(weight) else weight

    def products(self, vectors: list) -> Iterator[np.ndarray]:
        """For each vector its rounded product with the matrix, one number for each example."""
        for k in range(0, len(vectors), BATCH):
            some = np.zeros((len(vectors[k : k + BATCH]), len(self.rounded)), np.float32)
            for one, (term, weight) in zip(some, vectors[k : k + BATCH]):
                at = self.column[term]
                one[at[at >= 0]] = weight[at >= 0]
            yield from some @ self.rounded

    def in_head(self, example: int, own: np.ndarray) -> float:
        """The product of a text's part in the matrix with an example's."""
        a, z = self.head_begin[example], self.head_begin[example + 1]
        return float((self.head_impact[a:z] * own[self.head_column[a:z]]).sum())

    def nearest(
        self, term: np.ndarray, weight: np.ndarray, without: int = -1, side: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """The NEAREST examples with a common term and their cosines, exactly. `side`: what `products` gives."""
        side = next(self.products([(term, weight)])) if side is None else side
        at = self.column[term]
        own = np.zeros(len(self.rounded))
        own[at[at >= 0]] = weight[at >= 0]
        term, weight = term[at < 0], weight[at < 0]
        lo, hi = self.first[term], self.first[term + 1]
        entry, factor = arrays.ranges(lo, hi), np.repeat(weight, hi - lo)
        block = self.block[entry]
        bound = np.maximum.reduceat(side, np.arange(0, len(side), BLOCK)) if len(side) else side
        bound = bound + np.bincount(block, weights=factor * self.most[entry], minlength=self.blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        best, cosine, rest = np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        done, size = 0, FIRST
        while done < len(order):
            open_ = order[done : done + size]
            if len(best) >= NEAREST:
                open_ = open_[bound[open_] >= np.partition(cosine, -NEAREST)[-NEAREST] - SLACK]
                if not len(open_):
                    break
            done, size = done + len(open_), 8 * size
            part = np.zeros(self.blocks, bool)
            part[open_] = True
            scored = np.flatnonzero(np.repeat(part, BLOCK)[: len(side)])
            part = np.flatnonzero(part[block])
            a, z = self.begin[entry[part]], self.begin[entry[part] + 1]
            at = arrays.ranges(a, z)
            total = np.bincount(self.example[at], weights=np.repeat(factor[part], z - a) * self.impact[at], minlength=len(side))
            near = total[scored] + side[scored]
            keep = (near > 0) & (scored != without)
            if keep.sum() > NEAREST:
                keep &= near >= np.partition(near[keep], -NEAREST)[-NEAREST] - SLACK
            best, cosine, rest = (np.append(x, y[keep]) for x, y in ((best, scored), (cosine, near), (rest, total[scored])))
        if len(best) > NEAREST:
            keep = cosine >= np.partition(cosine, -NEAREST)[-NEAREST] - SLACK
            best, rest = best[keep], rest[keep]
        cosine = rest + np.array([self.in_head(k, own) for k in best.tolist()])
        near = np.lexsort((best, -cosine))[:NEAREST]
        return best[near], cosine[near]

    def vote(
        self, term: np.ndarray, weight: np.ndarray, without: int = -1, side: np.ndarray | None = None
    ) -> tuple[float, list]:
        best, cosine = self.nearest(term, weight, without, side)
        if not len(best):
            return float(self.base), []
        pull = cosine**SHARP / (np.maximum(0, 1 - cosine) + SOFT)
        share = float((pull * self.labels[best]).sum() + PRIOR * self.base) / float(pull.sum() + PRIOR)
        return share, list(zip(self.ids[best].tolist(), np.minimum(1, cosine).tolist(), self.labels[best].tolist()))

    def probability(self, vote: float) -> float:
        return float(np.interp(vote, *self.steps)) if len(self.steps[0]) else vote


def isotonic(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A rising line through the mean labels by vote: neighbours that fall are pooled."""
    order = np.argsort(votes, kind="stable")
    pools: list[list[float]] = []  # labels, votes, rows
    for x, y in zip(votes[order], labels[order]):
        pools.append([float(y), float(x), 1.0])
        while len(pools) > 1 and pools[-2][0] * pools[-1][2] >= pools[-1][0] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    total = np.array(pools)
    x, y = total[:, 1] / total[:, 2], (total[:, 0] + 0.5) / (total[:, 2] + 1)
    return np.concatenate([[0.0], x, [1.0]]), np.concatenate([[0.0], np.maximum.accumulate(y), [1.0]])


def frequencies(vocabulary: Broadcast) -> Callable:
    """How many texts of a task hold each term, and (term -1) how many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary.value
        total, rows = np.zeros(len(own), np.int64), 0
        for batch in batches:
            rows += len(batch)
            for _, _, hashes, row in terms(batch.column("in_text")):
                total += np.bincount(known(hashes, row, own)[1], minlength=len(own))
        term = np.append(np.flatnonzero(total), -1)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(np.append(total[term[:-1]], rows))], ["term", "many"])

    return run


class Model:
    """Everything a task needs to build the index, packed: the driver never opens it.

    The index and the fit of the probabilities are made in tasks; a worker builds its index once.
    """

    def __init__(self, packed_examples: bytes, frequency: np.ndarray, documents: int, steps: tuple | None = None):
        self.packed, self.frequency, self.documents, self.steps = packed_examples, frequency, documents, steps
        self.built: Index | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"built": None}

    @property
    def index(self) -> Index:
        if self.built is None:
            examples = pickle.loads(zlib.decompress(self.packed))
            self.built = Index(examples, self.frequency, self.documents, self.steps)
        return self.built


def chosen(ids: np.ndarray, texts: pa.ChunkedArray, labels: np.ndarray) -> tuple[np.ndarray, bytes]:
    """The vocabulary, and the examples packed."""
    made = choose(ids, texts, labels)
    return made.vocabulary, zlib.compress(pickle.dumps(made, 5), 1)


def calibrated(model: Broadcast) -> Callable:
    """The steps from votes to probabilities, (x, y) by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                own = model.value.index
                model.value.built = None  # as built here it holds the examples' vectors too
                yield pa.RecordBatch.from_arrays([pa.array(s) for s in own.steps], ["x", "y"])

    return run


_EVIDENCE = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())]))


def scored(model: Broadcast, shown: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value.index
        for batch in batches:
            for first, rows, hashes, row in terms(batch.column("in_text")):
                score, evidence = np.full(rows, own.base), [[]] * rows
                at, term, many = known(hashes, row, own.vocabulary)
                cuts = np.flatnonzero(np.diff(at, prepend=-1))
                vectors = [(term[a:b], own.unit(term[a:b], many[a:b])) for a, b in zip(cuts, [*cuts[1:], len(at)])]
                for k, vector, side in zip(at[cuts], vectors, own.products(vectors)):
                    vote, near = own.vote(*vector, side=side)
                    score[k] = own.probability(vote)
                    evidence[k] = [{"doc_id": i, "cosine": c, "label": y} for i, c, y in near[:shown]]
                rest = batch.column("rest").slice(first, rows)
                yield pa.RecordBatch.from_arrays([rest, pa.array(score), pa.array(evidence, _EVIDENCE)], ["rest", "score", "evidence"])

    return run


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    label: str = "toxic",
    rows: int = ROWS,
    threshold: float = THRESHOLD,
    shown: int = 3,
    text: str = "text",
    id: str = "doc_id",
    keep_text: bool = False,
) -> DataFrame:
    """`docs` (its text only with `keep_text`) with score, predicted and evidence. `usable` (of in_id)
    says which labels may be learnt."""
    spark = ready(docs.sparkSession)
    source = packed(docs, text, id)
    vocabulary, examples = fitted(labelled(source, labels, label, usable, rows), chosen)
    terms_ = spark.sparkContext.broadcast(vocabulary)
    counts = source.select("in_text").mapInArrow(frequencies(terms_), "term bigint, many bigint").groupBy("term").agg(F.sum("many").alias("many"))
    term, many = (counts.toArrow().column(c).to_numpy() for c in ("term", "many"))
    terms_.destroy()
    frequency = np.zeros(len(vocabulary) + 1)
    frequency[term] = many  # the last one, -1, is the number of documents
    model = Model(examples, frequency[:-1], int(frequency[-1]))
    raw = spark.sparkContext.broadcast(model)
    found = spark.range(1).repartition(1).mapInArrow(calibrated(raw), "x double, y double").toArrow()
    raw.destroy()
    model.steps = tuple(found.column(c).to_numpy() for c in ("x", "y"))
    model = spark.sparkContext.broadcast(model)
    if keep_text:
        source = source.withColumn("rest", F.struct(*[F.col(f"rest.`{c}`") if c != text else F.col("in_text").alias(text) for c in docs.columns]))
    rest = source.schema["rest"].dataType.simpleString()
    found = source.select("rest", "in_text").mapInArrow(
        scored(model, shown), f"rest {rest}, score double, evidence array<struct<doc_id:bigint,cosine:double,label:int>>"
    )
    added = {"score": F.col("score"), "predicted": (F.col("score") >= threshold).cast("int"), "evidence": F.col("evidence")}
    return unpacked(found, [c for c in docs.columns if keep_text or c != text], added)


def usable(parts: int = 5) -> Column:
    return share(F.col("in_id"), parts) != 0


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    done = toxicity(docs.select("doc_id", "text"), labels, usable())
    return done.select("doc_id", (share(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted", "evidence")
