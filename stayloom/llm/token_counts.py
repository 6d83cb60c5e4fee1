"""Delta-maintained token counts by source, language and tokenizer version.

A store is a folder with two tables, both of signed rows and written a batch at a time:

* `ledger`: the counts of each document (doc_id, source, lang, tokenizer, n_docs, n_tokens) that a
  batch adds, or with negative signs takes back;
* `deltas`: the same added up by source, language and tokenizer.  Totals are sums of deltas.

A batch inserts or revises documents (their former counts under the same tokenizer are taken back),
or deletes them (under all tokenizers).  Its deltas are written last; Spark's own success marker on
them commits the batch.  A batch id that is committed is not applied again, and what a failed batch
left is not read and is overwritten by its next attempt.

Null texts have no tokens but count as documents.  Null sources and languages are groups of their
own.  Rows without an id are counted but never revised or deleted.  Rows that repeat an id in one
batch all count, and are revised or deleted together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayloom.llm import arrays
from stayloom.llm.bpe import table, vocabulary
from stayloom.llm.frames import packed, ready
from stayloom.sources.folders import is_written

_GROUP = ["source", "lang", "tokenizer"]
_LEDGER = "doc_id bigint, source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"
_DELTAS = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"


def lengths(source: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = table(source)
        for batch in batches:
            for first, data, offsets in arrays.blocks(batch.column("in_text")):
                many = np.diff(words.encode(data, offsets)[1])
                rest = batch.column("rest").slice(first, len(many))
                yield pa.RecordBatch.from_arrays([rest, pa.array(many)], ["rest", "n_tokens"])

    return run


def counted(docs: DataFrame, path: str, version: str) -> DataFrame:
    """(doc_id, source, lang, tokenizer, n_docs, n_tokens) of each document."""
    spark = ready(docs.sparkSession)
    source = packed(docs.select("doc_id", "text", "source", "lang")).select("rest", "in_text")
    rest = source.schema["rest"].dataType.simpleString()
    return source.mapInArrow(lengths(vocabulary(spark, path)), f"rest {rest}, n_tokens bigint").select(
        "rest.doc_id", "rest.source", "rest.lang", F.lit(version).alias("tokenizer"), F.lit(1).cast("long").alias("n_docs"), "n_tokens"
    )


def _standing(ledger: DataFrame) -> DataFrame:
    sums = ledger.groupBy("doc_id", *_GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    return sums.where("n_docs != 0 OR n_tokens != 0")


class Store:
    """The counts kept in one folder; batch ids are listed in the order of their first commit by the caller."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def place(self, kind: str, batch: str) -> str:
        return f"{self.folder}/{kind}/{quote(batch, safe='')}"

    def committed(self) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/deltas")
        system = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(path):
            return []
        names = [s.getPath().getName() for s in system.listStatus(path)]
        return sorted(n for n in names if is_written(self.spark, f"{self.folder}/deltas/{n}"))

    def read(self, kind: str, schema: str) -> DataFrame:
        paths = [f"{self.folder}/{kind}/{n}" for n in self.committed()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def standing(self) -> DataFrame:
        """What the ledger now holds of each document."""
        return _standing(self.read("ledger", _LEDGER))

    def commit(self, batch: str, counts: DataFrame | None = None, deleted: DataFrame | None = None) -> bool:
        """Apply one batch: counts of new or changed documents, ids of deleted ones. False if it was applied before."""
        if is_written(self.spark, self.place("deltas", batch)):
            return False
        ledger = None if counts is None else counts.select("doc_id", *_GROUP, "n_docs", "n_tokens")
        if self.committed():
            gone = None if deleted is None else deleted.select("doc_id", F.lit(None).cast("string").alias("only"))
            if counts is not None:
                changed = counts.select("doc_id", F.col("tokenizer").alias("only"))
                gone = changed if gone is None else gone.unionByName(changed)
            if gone is not None:
                # The rows of the batch's documents are found first: only these are added up.
                rows = self.read("ledger", _LEDGER)
                same = (rows.doc_id == gone.doc_id) & (F.coalesce("only", "tokenizer") == rows.tokenizer)
                taken = _standing(rows.join(gone.distinct(), same, "left_semi")).select("doc_id", *_GROUP, (-F.col("n_docs")).alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens"))
                ledger = taken if ledger is None else taken.unionByName(ledger)
        if ledger is None:
            ledger = self.spark.createDataFrame([], _LEDGER)
        ledger.write.mode("overwrite").parquet(self.place("ledger", batch))
        written = self.spark.read.schema(_LEDGER).parquet(self.place("ledger", batch))
        deltas = written.groupBy(*_GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        deltas.write.mode("overwrite").parquet(self.place("deltas", batch))
        return True

    def totals(self) -> DataFrame:
        sums = self.read("deltas", _DELTAS).groupBy(*_GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.where("n_docs != 0 OR n_tokens != 0")


def history(docs: DataFrame, path: str, version: str) -> list[tuple[str, DataFrame | None, DataFrame | None]]:
    """Batches (name, counts, deleted ids) that end with all of `docs` as they are, by shares of their ids.

    First all documents are inserted, a quarter of them in a former state: the first half of the text, from
    another source.  Then that quarter is revised, another quarter deleted, and what was deleted
    inserted again.  Documents without an id take part in the first batch only.
    """
    share = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4, F.lit(3))
    former = docs.withColumns({
        "text": F.when(share == 0, F.expr("left(text, char_length(text) div 2)")).otherwise(F.col("text")),
        "source": F.when(share == 0, F.concat_ws("/", F.lit("former"), "source")).otherwise(F.col("source")),
    })
    second, third = docs.where(share == 0), docs.where(share == 1)
    return [
        ("1 insert", counted(former, path, version), None),
        ("2 revise", counted(second, path, version), None),
        ("3 delete", None, third.select("doc_id")),
        ("4 restore", counted(third, path, version), None),
    ]


def digest(docs: DataFrame, folder: str, path: str, version: str) -> DataFrame:
    """Totals after a history of inserts, revisions and deletes; each batch is given twice and applied once."""
    ready(docs.sparkSession)
    store = Store(docs.sparkSession, folder)
    for batch in history(docs.select("doc_id", "text", "source", "lang"), path, version):
        store.commit(*batch)
        if store.commit(*batch):
            raise RuntimeError(f"batch {batch[0]} was applied twice")
    return store.totals()
