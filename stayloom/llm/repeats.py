"""Stretches of a corpus whose fixed-length windows occur more than once, found without shuffling every window.

Windows of `length` units (bytes or words) are grouped into stretches by their anchor
(`arrays.stretches`).  Equal windows have equal anchors, so:

1. anchors are counted in Spark; windows of an anchor that occurs once cannot be repeated;
2. whole stretches of the other anchors are counted by a 128-bit hash: an equal stretch elsewhere
   repeats all its windows;
3. anchors with several different stretches go to `resolve`, once per different stretch, which
   tells the repeated windows in each;
4. the answers are joined to the stretches, and covered units are cut from the documents.

Each step counts before it shuffles by a hot key (map-side combine) or joins on a key whose large
side adaptive execution can split.  No group is gathered but the stretches of one document and, in
`resolve`, a bounded number of different stretches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayloom.llm import arrays
from stayloom.llm.frames import packed, ready, settle, unpacked

_STRETCH = "array<struct<anchor:bigint,r1:bigint,r2:bigint,lo:int,hi:int,at:int>>"
_KEY = ["anchor", "r1", "r2"]


@dataclass(frozen=True)
class Unit:
    """What a window is made of: bytes, or words."""

    length: int
    gram: int
    words: bool

    def values(self, data: np.ndarray, offsets: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The hash of each unit of a block, and the rows' bounds."""
        if not self.words:
            return arrays.BYTES[seed][data], offsets
        start, end, bounds = arrays.words(data, offsets)
        return arrays.word_hashes(data, start, end, seed), bounds

    def pieces(self, text: bytes) -> list[bytes] | bytes:
        return text.split() if self.words else text

    def joined(self, pieces: list[bytes] | bytes, kept: np.ndarray | None = None) -> bytes:
        """Kept units: words joined by one space, bytes as they are."""
        if not self.words:
            return pieces if kept is None else np.frombuffer(pieces, np.uint8)[kept].tobytes()
        return b" ".join(pieces if kept is None else [w for w, k in zip(pieces, kept) if k])


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def anchors(unit: Unit) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.release()
        for batch in batches:
            ids, hashes = batch.column("in_id"), batch.column("in_hash")
            for first, data, offsets in arrays.blocks(batch.column("in_text")):
                found = arrays.stretches(*unit.values(data, offsets), unit.length, unit.gram)
                rows = pa.array(found["row"] + first)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(rows), hashes.take(rows), pa.array(found["at"].astype(np.int32)), signed(found["anchor"])],
                    ["in_id", "in_hash", "at", "anchor"],
                )

    return run


def touched(unit: Unit, keep_all: bool) -> Callable:
    """Documents with their stretches of repeated anchors; texts of others only if `keep_all`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.release()
        for batch in batches:
            marks = batch.column("marks")
            for first, data, offsets in arrays.blocks(batch.column("in_text")):
                rows = len(offsets) - 1
                mark = marks.slice(first, rows)
                counts = np.zeros(rows, np.int64)
                number = mark.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                values, bounds = unit.values(data, offsets)
                out = [np.zeros(0, np.int64)] * 6
                if number.any():
                    found = arrays.stretches(values, bounds, unit.length, unit.gram)
                    wanted = (np.repeat(np.arange(rows), number) << 32) + mark.flatten().to_numpy().astype(np.int64)
                    hit = np.isin((found["row"] << 32) + found["at"], wanted)
                    row, lo, hi, at = (found[k][hit] for k in ("row", "lo", "hi", "at"))
                    counts = np.bincount(row, minlength=rows)
                    start, end = bounds[row] + lo, bounds[row] + hi + unit.length
                    more, _ = unit.values(data, offsets, 1)
                    out = [
                        found["anchor"][hit],
                        arrays.spans(arrays.sums(values), start, end),
                        arrays.spans(arrays.sums(more), start, end),
                        lo, hi, at - lo,
                    ]
                text, sha = [], []
                for k in range(rows):
                    piece = data[offsets[k] : offsets[k + 1]].tobytes()
                    text.append(piece if keep_all or counts[k] else None)
                    sha.append(None if counts[k] else hashlib.sha256(unit.joined(unit.pieces(piece))).hexdigest())
                stretch = pa.StructArray.from_arrays(
                    [signed(x) for x in out[:3]] + [pa.array(x.astype(np.int32)) for x in out[3:]],
                    ["anchor", "r1", "r2", "lo", "hi", "at"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("rest").slice(first, rows), pa.array(text, pa.binary()), pa.array(sha, pa.string()),
                        pa.array(np.diff(bounds).astype(np.int64)), arrays.lists(counts, stretch),
                    ],
                    ["rest", "text", "whole", "units", "stretches"],
                )

    return run


def cut(unit: Unit, with_text: bool) -> Callable:
    """Documents without the units that repeated windows cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.release()
        for batch in batches:
            columns = {k: batch.column(k).to_pylist() for k in ("text", "whole", "units", "spans")}
            removed, spans, sha, text = [], [], [], []
            for piece, whole, units, ranges in zip(*columns.values()):
                if not ranges:
                    removed.append(0)
                    spans.append(0)
                    sha.append(whole or hashlib.sha256(unit.joined(unit.pieces(piece))).hexdigest())
                    text.append(piece)
                    continue
                edge = np.zeros(units + 1, np.int32)
                np.add.at(edge, [r["lo"] for r in ranges], 1)
                np.add.at(edge, [r["hi"] + unit.length for r in ranges], -1)
                gone = np.cumsum(edge[:-1]) > 0
                removed.append(int(gone.sum()))
                spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                text.append(unit.joined(unit.pieces(piece), ~gone))
                sha.append(hashlib.sha256(text[-1]).hexdigest())
            out = [batch.column("rest"), batch.column("units"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha)]
            names = ["rest", "units", "removed", "spans", "kept_sha256"]
            if with_text:
                out, names = [*out, pa.array(text, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(out, names)

    return run


def each_window(unit: Unit) -> Callable:
    """A row for each window of each listed stretch: its 128-bit hash, the stretch, the window's place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.release()
        for batch in batches:
            listed = batch.column("listed")
            for first, data, offsets in arrays.blocks(batch.column("text")):
                part = listed.slice(first, len(offsets) - 1)
                number = part.value_lengths().to_numpy().astype(np.int64)
                flat = part.flatten()
                rid, lo, size = (flat.field(k).to_numpy() for k in ("rid", "lo", "size"))
                values, bounds = unit.values(data, offsets)
                more, _ = unit.values(data, offsets, 1)
                start = bounds[np.repeat(np.arange(len(number)), number)] + lo
                place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                at = np.repeat(start, size) + place
                yield pa.RecordBatch.from_arrays(
                    [
                        signed(arrays.windows(values, unit.length)[at]), signed(arrays.windows(more, unit.length)[at]),
                        pa.array(np.repeat(rid, size)), pa.array(place.astype(np.int32)),
                    ],
                    ["s1", "s2", "rid", "place"],
                )

    return run


def counted(unit: Unit, listed: DataFrame) -> DataFrame:
    """(rid, lo, hi): the repeated windows of different stretches, by counting each window in Spark."""
    rows = settle(listed.mapInArrow(each_window(unit), "s1 bigint, s2 bigint, rid bigint, place int"))
    # Written, so that both sides of the join are plain exchanges, whose large partitions Spark can split.
    again = settle(rows.groupBy("s1", "s2").count().where("count > 1").select("s1", "s2"))
    return rows.join(again, ["s1", "s2"], "left_semi").select("rid", F.col("place").alias("lo"), F.col("place").alias("hi"))


def remove_repeats(
    docs: DataFrame,
    unit: Unit,
    resolve: Callable[[Unit, DataFrame, Callable[[DataFrame], DataFrame]], DataFrame],
    text: str = "text",
    id: str = "doc_id",
    with_text: bool = True,
    counted_as: str = "n_units",
) -> DataFrame:
    """`docs` (its text cut, if `with_text`) with the number of units, n_removed, n_spans, kept_sha256.

    A column of the same name as an added one is replaced.

    `resolve(unit, stretches, fetch)` gets the different stretches (rid, anchor, rivals, n, row, lo,
    size, at) of anchors with several of them, and `fetch`, which adds the texts they stand in; it
    returns repeated window places (rid, lo, hi) within stretches.
    """
    ready(docs.sparkSession)
    # Row identity is (id, hash of the text): rows that agree in both are repeated in the same places.
    keyed = packed(docs, text, id).withColumn("in_hash", F.xxhash64("in_text")).withColumn(
        "in_id", F.coalesce("in_id", F.lit(-(2**63)))
    )
    found = settle(
        keyed.select("in_id", "in_hash", "in_text").mapInArrow(
            anchors(unit), "in_id bigint, in_hash bigint, at int, anchor bigint"
        )
    )
    # Written, so that both sides of the join are plain exchanges, whose large partitions Spark can split.
    repeated = settle(found.groupBy("anchor").count().where("count > 1").select("anchor"))
    marks = (
        found.join(repeated, "anchor", "left_semi")
        .groupBy("in_id", "in_hash")
        .agg(F.collect_set("at").alias("marks"))  # repeated rows bring the same places
    )
    rest = keyed.schema["rest"].dataType.simpleString()
    corpus = settle(
        keyed.join(marks, ["in_id", "in_hash"], "left")
        .select("rest", "in_text", "marks")
        .mapInArrow(
            touched(unit, with_text), f"rest {rest}, text binary, whole string, units bigint, stretches {_STRETCH}"
        )
        .withColumn("row", F.monotonically_increasing_id())
    )
    stretches = corpus.select("row", F.inline("stretches"))
    kinds = settle(
        stretches.groupBy(*_KEY)
        .agg(
            F.count("*").alias("n"),
            F.min_by("lo", "row").alias("lo"),
            F.min("row").alias("row"),
            F.max(F.col("hi") - F.col("lo")).alias("last"),
            F.max("at").alias("at"),
        )
        .withColumn("rid", F.monotonically_increasing_id())
    )
    rivals = kinds.groupBy("anchor").agg(F.count("*").alias("rivals")).where("rivals > 1")
    open_kinds = kinds.join(rivals, "anchor").select(
        "rid", "anchor", "rivals", "n", "row", "lo", (F.col("last") + 1).alias("size"), "at"
    )

    def fetch(wanted: DataFrame) -> DataFrame:
        listed = wanted.groupBy("row").agg(
            F.collect_list(F.struct("rid", "anchor", "lo", "size", "at")).alias("listed")
        )
        return corpus.select("row", "text").join(listed, "row").select("text", "listed")

    single = resolve(unit, open_kinds, fetch)
    places = single.groupBy("rid").agg(F.collect_list(F.struct("lo", "hi")).alias("inner"))
    whole = F.array(F.struct(F.lit(0).alias("lo"), F.col("last").alias("hi")))
    answers = (
        kinds.join(places, "rid", "left")
        .select(*_KEY, F.when(F.col("n") > 1, whole).otherwise(F.col("inner")).alias("inner"))
        .where("inner is not null")
    )
    spans = (
        stretches.join(answers, _KEY)
        .select("row", F.col("lo").alias("base"), F.explode("inner").alias("part"))
        .select("row", (F.col("base") + F.col("part.lo")).alias("lo"), (F.col("base") + F.col("part.hi")).alias("hi"))
        .groupBy("row")
        .agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    )
    done = corpus.join(spans, "row", "left").select("rest", "text", "whole", "units", "spans").mapInArrow(
        cut(unit, with_text),
        f"rest {rest}, units bigint, removed bigint, spans bigint, kept_sha256 string" + ", kept binary" * with_text,
    )
    added = {counted_as: F.col("units"), "n_removed": F.col("removed"), "n_spans": F.col("spans")}
    added["kept_sha256"] = F.col("kept_sha256")
    if with_text:
        added[text] = F.col("kept") if not unit.words else F.col("kept").cast("string")
    columns = [c for c in docs.columns if with_text or c != text]
    return unpacked(done, columns, added)
