"""Substring deduplication over bytes by content-defined triggers and sorted contexts.

Triggers are the least rolling hashes among all places of a 400-byte window, so every window holds
one, and equal windows hold the same one.  There is no prefix-free parse: neither a phrase dictionary
nor a parse is built or sorted.  A stretch of windows that recurs whole is decided by two 64-bit hashes.
Where a trigger has 2 to `group` different contexts, two orders are sorted: the bytes before the trigger,
read backwards, and the bytes from the trigger on.  A 400-byte string with `a` bytes before its trigger is a
class of the first order at depth `a` and of the second at depth 400 - a; both classes together are
its place in corpus order, and a place that several strings share is a repeat; in this case
alone bytes are compared.

A trigger with more than `group` different contexts is not gathered in one task: its strings are
counted in Spark by 128-bit hashes instead.

Null is empty; texts under 400 bytes lose nothing; repeated rows count as separate documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayloom.llm import arrays
from stayloom.llm.repeats import Unit, counted, remove_repeats

LENGTH = 400
GRAM = 24
GROUP = 4096


def contexts(unit: Unit) -> Callable:
    """The bytes of each listed stretch, with its trigger's place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.release()
        for batch in batches:
            for first, data, offsets in arrays.blocks(batch.column("text")):
                out: list[list] = [[], [], [], [], []]
                for k, listed in enumerate(batch.column("listed").slice(first, len(offsets) - 1).to_pylist()):
                    for x in listed:
                        start = offsets[k] + x["lo"]
                        row = (x["anchor"], x["rid"], x["at"], x["size"], data[start : start + x["size"] - 1 + unit.length].tobytes())
                        for column, value in zip(out, row):
                            column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, kinds)], ["anchor", "rid", "at", "size", "bytes"]
                )

    return run


def ordered(sides: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of byte rows within groups, and the common prefix of each with the row before it."""
    tagged = np.concatenate([group.astype(">u4").view(np.uint8).reshape(-1, 4), sides], axis=1)
    order = np.argsort(np.ascontiguousarray(tagged).view(f"S{tagged.shape[1]}").ravel(), kind="stable")
    sides, group = sides[order], group[order]
    differ = sides[1:] != sides[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), sides.shape[1])
    common[group[1:] != group[:-1]] = -1
    return order, np.concatenate([[-1], common])


def shared_places(texts: list[bytes], at: np.ndarray, size: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """For each stretch and each number of bytes before the trigger: whether that window is in another stretch."""
    n, most = len(texts), int(at.max())
    before, after = np.zeros((n, max(most, 1)), np.uint8), np.zeros((n, length), np.uint8)
    for k, (text, a) in enumerate(zip(texts, at)):
        whole = np.frombuffer(text, np.uint8)
        before[k, :a] = whole[:a][::-1]
        right = whole[a : a + length]
        after[k, : len(right)] = right
    left_order, left_common = ordered(before, group)
    right_order, right_common = ordered(after, group)
    left, right = np.empty(n, np.int64), np.empty(n, np.int64)
    found = np.zeros((n, most + 1), bool)
    for a in range(most + 1):
        active = np.flatnonzero((a <= at) & (a > at - size))
        if len(active) < 2:
            continue
        left[left_order] = np.cumsum(left_common < a)
        right[right_order] = np.cumsum(right_common < length - a)
        place = left[active] * (n + 1) + right[active]
        _, back, count = np.unique(place, return_inverse=True, return_counts=True)
        found[active[count[back] > 1], a] = True
    return found


def sorted_contexts(unit: Unit, batch_rows: int = 4 * 1024) -> Callable:
    """Rows come with their triggers together; whole triggers are sorted in batches."""

    def solve(rows: list[dict]) -> pa.RecordBatch:
        at = np.array([r["at"] for r in rows])
        size = np.array([r["size"] for r in rows])
        group = np.unique([r["anchor"] for r in rows], return_inverse=True)[1].astype(np.int64)
        found = shared_places([r["bytes"] for r in rows], at, size, group, unit.length)
        row, a = np.nonzero(found)
        place = (at[row] - a).astype(np.int32)
        order = np.lexsort((place, row))
        row, place = row[order], place[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)
        last = np.append(np.flatnonzero(new)[1:], len(row)) - 1 if len(row) else np.zeros(0, np.int64)
        rid = np.array([r["rid"] for r in rows], np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(rid[row[new]]), pa.array(place[new]), pa.array(place[last])], ["rid", "lo", "hi"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.release()
        held: list[dict] = []
        for batch in batches:
            held += batch.to_pylist()
            if len(held) >= batch_rows:
                edge = len(held)
                while edge and held[edge - 1]["anchor"] == held[-1]["anchor"]:
                    edge -= 1
                if edge:
                    yield solve(held[:edge])
                    held = held[edge:]
        if held:
            yield solve(held)

    return run


def suffix_dedup(
    docs: DataFrame,
    length: int = LENGTH,
    text: str = "text",
    id: str = "doc_id",
    with_text: bool = True,
    group: int = GROUP,
) -> DataFrame:
    """`docs` with n_bytes, n_removed, n_spans and kept_sha256; `text` holds the kept bytes as binary, since
    a cut may fall inside a character.  Without `with_text` the text column goes."""
    unit = Unit(length, min(GRAM, length), False)

    def resolve(unit: Unit, kinds: DataFrame, fetch: Callable[[DataFrame], DataFrame]) -> DataFrame:
        small = fetch(kinds.where(F.col("rivals") <= group)).mapInArrow(
            contexts(unit), "anchor bigint, rid bigint, at int, size int, bytes binary"
        )
        sorted_ = (
            small.repartition("anchor")
            .sortWithinPartitions("anchor")
            .mapInArrow(sorted_contexts(unit), "rid bigint, lo int, hi int")
        )
        return sorted_.unionByName(counted(unit, fetch(kinds.where(F.col("rivals") > group))))

    return remove_repeats(docs, unit, resolve, text, id, with_text, "n_bytes")


def digest(docs: DataFrame) -> DataFrame:
    done = suffix_dedup(docs.select("doc_id", "text"), with_text=False)
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
