"""Bounded samples of labelled documents, and models fitted on them by one task."""

from __future__ import annotations

import pickle
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_SAMPLE = pa.schema([("in_id", pa.int64()), ("in_text", pa.string()), ("label", pa.int32())])


def share(id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; null for a null id."""
    return F.pmod(F.crc32(id.cast("string").cast("binary")), F.lit(parts))


def labelled(docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int) -> DataFrame:
    """(in_id, in_text, label) of at most `rows` labelled documents, chosen by a hash of the id.

    `usable` tells which ids may be learnt from. Null ids and labels are left out; of repeated labels
    of one id the greatest counts. The chosen ids are at most `rows` numbers, so they are broadcast.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("in_id"), F.col(label).cast("int").alias("label"))
        .where("in_id IS NOT NULL AND label IS NOT NULL")
        .where(usable)
        .groupBy("in_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("in_id"), "in_id")
        .limit(rows)
    )
    texts = docs.select("in_id", "in_text").join(F.broadcast(chosen), "in_id")
    # Repeated ids would make the sample larger than the bound.
    return texts.orderBy(F.xxhash64("in_id"), "in_id", F.xxhash64("in_text")).limit(rows)


def fitted(sample: DataFrame, fit: Callable) -> object:
    """What `fit(ids, texts, labels)` makes of the sample, in one task; the model comes to the driver."""

    def made(table: pa.Table) -> object:
        ids, labels = (table.column(c).to_numpy() for c in ("in_id", "label"))
        return fit(ids, table.column("in_text"), labels)

    def run(batches):
        rows = list(batches)
        if rows:
            model = pickle.dumps(made(pa.Table.from_batches(rows)))
            yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])

    one = sample.select("in_id", "in_text", "label").repartition(1)
    found = one.mapInArrow(run, "model binary").first()
    return pickle.loads(found["model"]) if found else made(_SAMPLE.empty_table())
