"""Quality classifier: logistic regression on hashed word n-grams, learnt by follow-the-regularised-leader.

Features are words and word pairs, as written and by shape (runs of letters, capitals and digits each
as one sign), and whether a word repeats the one before; all are hashed into `2 ** BITS` places.  A
text is the mean of its features, so its length plays no part.  It is learnt on at most `rows` labelled
documents; scoring is a sparse dot product for every text.

Null and empty texts have one feature of their own and so a score.  With no labelled documents every
score is 0.5; labels of one kind pull all scores that way.  Labels, language, source and id are never
inputs.  Repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayloom.llm import arrays
from stayloom.llm.frames import packed, ready, unpacked
from stayloom.llm.samples import fitted, labelled, share

BITS = 18
ROWS = 8192
EPOCHS = 3
ALPHA, BETA, L1, L2 = 4.0, 1.0, 1e-5, 1e-5
THRESHOLD = 0.7
SCALE = 12.0  # of a text's features together

_SIGN = np.arange(256, dtype=np.uint8)  # signs stand for themselves
_SIGN[ord("0") : ord("9") + 1] = ord("0")
_SIGN[ord("A") : ord("Z") + 1] = ord("A")
_SIGN[ord("a") : ord("z") + 1] = ord("a")
_SIGN[128:] = ord("a")


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all features of a block and the row of each; a text without words has place 0."""
    start, end, bounds = arrays.words(data, offsets)
    row = arrays.rows_of(bounds)
    word = arrays.word_hashes(data, start, end)
    # Shapes: one sign for a run of equal signs, hashed over what is left of each word.
    sign = _SIGN[data]
    first = np.ones(len(sign), bool)
    first[1:] = sign[1:] != sign[:-1]
    first[start] = True
    kept = np.concatenate([[0], np.cumsum(first)])
    shape = arrays.spans(arrays.sums(arrays.BYTES[1][sign[first]]), kept[start], kept[end])
    same = np.flatnonzero(row[1:] == row[:-1])
    pair = lambda x: arrays.mix(x[same] * arrays.SEED + x[same + 1])
    again = (word[same] == word[same + 1]).astype(np.uint64) + np.uint64(1)
    empty = np.flatnonzero(np.diff(bounds) == 0)
    places = np.concatenate([word, shape, pair(word), pair(shape), arrays.mix(again)]) & np.uint64((1 << BITS) - 1)
    rows = np.concatenate([row, row, row[same], row[same], row[same], empty])
    return np.concatenate([places.astype(np.int64), np.zeros(len(empty), np.int64)]), rows


def vectors(texts: pa.ChunkedArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its different places and their weights."""
    for _, data, offsets in arrays.blocks(texts):
        places, rows = features(data, offsets)
        keys, many = np.unique((rows << BITS) | places, return_counts=True)
        cuts = np.searchsorted(keys >> BITS, np.arange(len(offsets)))
        for a, b in zip(cuts, cuts[1:]):
            yield keys[a:b] & ((1 << BITS) - 1), SCALE * many[a:b] / max(1, many[a:b].sum())


def learn(ids: np.ndarray, texts: pa.ChunkedArray, labels: np.ndarray) -> np.ndarray:
    """Weights by place, the last one the bias."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    rows = list(vectors(texts))
    for epoch in range(EPOCHS):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            place, value = np.append(rows[k][0], 1 << BITS), np.append(rows[k][1], 1.0)
            own, seen = z[place], n[place]
            weight = -(own - np.sign(own) * L1) / ((BETA + np.sqrt(seen)) / ALPHA + L2)
            weight[np.abs(own) <= L1] = 0
            step = (1 / (1 + np.exp(-np.clip(weight @ value, -30, 30))) - labels[k]) * value
            z[place] = own + step - (np.sqrt(seen + step**2) - np.sqrt(seen)) / ALPHA * weight
            n[place] = seen + step**2
    weight = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    weight[np.abs(z) <= L1] = 0
    return weight.astype(np.float32)


def scored(model: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = model.value
        for batch in batches:
            for first, data, offsets in arrays.blocks(batch.column("in_text")):
                rows = len(offsets) - 1
                places, row = features(data, offsets)
                many = np.bincount(row, minlength=rows)
                total = np.bincount(row, weights=weight[places], minlength=rows) * SCALE / np.maximum(many, 1) + weight[-1]
                score = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
                yield pa.RecordBatch.from_arrays([batch.column("rest").slice(first, rows), pa.array(score)], ["rest", "score"])

    return run


def quality_classifier(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    label: str = "quality",
    rows: int = ROWS,
    threshold: float = THRESHOLD,
    text: str = "text",
    id: str = "doc_id",
) -> DataFrame:
    """`docs` without its text, with score and predicted. `usable` (of in_id) says which labels may be learnt."""
    spark = ready(docs.sparkSession)
    source = packed(docs, text, id)
    model = fitted(labelled(source, labels, label, usable, rows), learn)
    rest = source.schema["rest"].dataType.simpleString()
    found = source.select("rest", "in_text").mapInArrow(scored(spark.sparkContext.broadcast(model)), f"rest {rest}, score double")
    added = {"score": F.col("score"), "predicted": (F.col("score") >= threshold).cast("int")}
    return unpacked(found, [c for c in docs.columns if c != text], added)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    usable = share(F.col("in_id"), 4) != 2
    done = quality_classifier(docs.select("doc_id", "text"), labels, usable)
    return done.select("doc_id", (share(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")
