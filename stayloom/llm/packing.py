"""Best-fit packing of documents into sequences, planned over a length histogram.

1. Every document is encoded once and ends with id 0; only longer ones are cut, into pieces of the
   sequence length, the first piece taking what is left over.  Pieces are written without their ids,
   each with its number among the pieces of its length in its task.
2. The rank of a piece within its length is the task's start in that length plus that number: the
   starts are running sums over (length, task) counts, so a length that a third of all pieces have
   is never sorted or gathered.
3. The plan is best fit over counts, longest first: a run of equal pieces goes to a run of equally
   filled sequences at once.  Its size depends on the number of lengths, not of documents.
4. Pieces take their planned slots by (length, rank); the plan is broadcast, being so bounded.

Null is the empty text, which makes one piece of one id.  Repeated rows are packed each; null ids
are kept.  An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayloom.llm import arrays
from stayloom.llm.bpe import table, vocabulary
from stayloom.llm.frames import packed, ready, settle, unpacked

LENGTH = 2048
END = 0  # the id that ends a document


def pieces(source: Broadcast, length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.release()
        words, seen = table(source), np.zeros(length + 1, np.int64)
        task = TaskContext.get().partitionId()
        for batch in batches:
            for first, data, offsets in arrays.blocks(batch.column("in_text")):
                ids, bounds, *_ = words.encode(data, offsets)
                row, piece, start, size, crc = [], [], [], [], []
                for k in range(len(offsets) - 1):
                    own = np.append(ids[bounds[k] : bounds[k + 1]], np.uint32(END)).astype("<u4")
                    head = len(own) % length if len(own) > length else len(own)
                    cuts = [0, *([head] if head else []), *range(head + length, len(own) + 1, length)]
                    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        row.append(first + k)
                        piece.append(n)
                        start.append(a)
                        size.append(b - a)
                        crc.append(zlib.crc32(own[a:b].tobytes()))
                size = np.array(size, np.int64)
                order = np.argsort(size, kind="stable")
                fresh = np.concatenate([[True], np.diff(size[order]) > 0])
                begin = np.maximum.accumulate(np.where(fresh, np.arange(len(size)), 0))
                nth = np.empty(len(size), np.int64)
                nth[order] = np.arange(len(size)) - begin
                nth += seen[size]
                seen += np.bincount(size, minlength=length + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("rest").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(size), pa.array(crc, pa.int64()), pa.array(np.full(len(row), task, np.int64)), pa.array(nth),
                    ],
                    ["rest", "piece", "start", "length", "ids_crc32", "task", "nth"],
                )

    return run


def best_fit(histogram: dict[int, int], room: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, how many, first sequence, offset) for runs of equal pieces, longest first.

    Each run goes where the least room is left that still holds the piece, as many times as it holds it.
    """
    plan: list[tuple[int, int, int, int, int]] = []
    free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left: runs of sequences (first, how many)
    rooms: list[int] = []
    opened = 0

    def leave(left: int, first: int, many: int) -> None:
        if many and left:
            if not free[left]:
                bisect.insort(rooms, left)
            free[left].append((first, many))

    for length in sorted(histogram, reverse=True):
        todo, rank = histogram[length], 0
        while todo:
            k = bisect.bisect_left(rooms, length)
            if k < len(rooms):
                space = rooms[k]
                first, many = free[space].pop()
                if not free[space]:
                    rooms.pop(k)
            else:
                space, first, many = room, opened, -(-todo // (room // length))
                opened += many
            each = space // length
            full = min(many, todo // each)
            for n in range(each if full else 0):
                plan.append((length, rank, full, first, room - space + n * length))
                rank += full
            todo -= full * each
            leave(space - each * length, first, full)
            if full < many and todo:  # a sequence that takes the last few
                for n in range(todo):
                    plan.append((length, rank, 1, first + full, room - space + n * length))
                    rank += 1
                leave(space - todo * length, first + full, 1)
                full, todo = full + 1, 0
            leave(space, first + full, many - full)
    return plan


def slots(plan: Broadcast) -> Callable:
    """Each piece's sequence and offset, by (length, rank)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, rank, many, first, offset = plan.value
        keys = (length << 44) + rank
        for batch in batches:
            mine = (batch.column("length").to_numpy() << 44) + batch.column("rank").to_numpy()
            at = np.searchsorted(keys, mine, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(first[at] + mine - keys[at]), pa.array(offset[at])],
                [*batch.schema.names[:5], "sequence_id", "offset"],
            )

    return run


def packing(docs: DataFrame, path: str, length: int = LENGTH, text: str = "text", id: str = "doc_id") -> DataFrame:
    """`docs` without its text, a row per piece, with piece, start, length, ids_crc32, sequence_id, offset."""
    spark = ready(docs.sparkSession)
    source = packed(docs, text, id).select("rest", "in_text")
    rest = source.schema["rest"].dataType.simpleString()
    columns = f"rest {rest}, piece int, start bigint, length bigint, ids_crc32 bigint"
    cut = settle(
        source.mapInArrow(pieces(vocabulary(spark, path), length), f"{columns}, task bigint, nth bigint")
    )
    counts = settle(cut.groupBy("length", "task").agg(F.count("*").alias("many")))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "task", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("base"))
    histogram = {r["length"]: r["many"] for r in counts.groupBy("length").agg(F.sum("many").alias("many")).collect()}
    plan = np.array(sorted(best_fit(histogram, length)), np.int64).reshape(-1, 5).T
    ranked = cut.join(starts, ["length", "task"]).select(
        "rest", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank")
    )
    placed = ranked.mapInArrow(
        slots(spark.sparkContext.broadcast(plan)), f"{columns}, sequence_id bigint, offset bigint"
    )
    names = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return unpacked(placed, [c for c in docs.columns if c != text], {c: F.col(c) for c in names})


def digest(docs: DataFrame, path: str) -> DataFrame:
    return packing(docs.select("doc_id", "text"), path)
