"""Exact deduplication with an extendible-hash index on shared files, in DataFrame operations alone.

* Entries: one row per document with the 64-bit key of its normalised text (A-Z lower-cased), the
  text's SHA-256 and its row number, written to the shared folder.
* Keys: one row per key with its number of entries, aggregated before the shuffle, so that a key
  that a third of all rows share is one row.
* Directory: a bucket is a prefix of the key.  A bucket with more than `capacity` keys is split and
  the directory doubles until none is; only overfull buckets take part in the next doubling.  The
  directory is a table, never held by the driver.
* Index: keys with their bucket, dealt out by key range and written in bucket order.  It tells the keys
  with several entries; the steps after it are dealt by key, not by bucket.
* Chains: keys with several entries may hold different texts.  Their texts are fetched and grouped
  by their bytes (combined before the shuffle), which is the comparison; each different text is a
  link of the chain, with the row that stays and the number of copies.

Null and empty texts are equal to each other.  The row with the largest doc_id stays; rows without
an id come last, and of rows that agree in id and text one stays.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayloom.llm.frames import packed, ready, settle, survivors, unpacked

CAPACITY = 1 << 14
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """A-Z lower-cased, nothing else; plain ASCII texts take the engine's fast way."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def prefix(key: Column, depth: Column | int) -> Column:
    """The first `depth` bits of a key, as a number; 0 for depth 0."""
    shift = F.lit(63) - (F.lit(depth) if isinstance(depth, int) else depth)
    return F.call_function("shiftrightunsigned", F.call_function("shiftrightunsigned", key, F.lit(1)), shift)


def directory(keys: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(bucket, depth, n_keys): leaf buckets of at most `capacity` keys."""
    total = keys.count()
    depth = max(0, math.ceil(math.log2(max(1, total / capacity))))
    open_keys, leaves = keys.select("key"), None
    while True:
        buckets = settle(
            open_keys.groupBy(prefix(F.col("key"), depth).alias("bucket")).agg(F.count("*").alias("n_keys"))
        )
        fits = buckets.where(F.col("n_keys") <= capacity).select("bucket", F.lit(depth).alias("depth"), "n_keys")
        leaves = fits if leaves is None else leaves.unionByName(fits)
        overfull = buckets.where(F.col("n_keys") > capacity).select("bucket")
        if depth >= 62 or overfull.isEmpty():
            return leaves
        open_keys = settle(
            open_keys.withColumn("bucket", prefix(F.col("key"), depth)).join(overfull, "bucket", "left_semi").select("key")
        )
        depth += 1


def slots(leaves: DataFrame) -> tuple[DataFrame, int]:
    """The doubled directory: one row per prefix of the greatest depth, pointing at its bucket."""
    depth = leaves.agg(F.max("depth")).first()[0] or 0
    width = F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(depth) - F.col("depth"))
    return leaves.select(
        "bucket", "depth", F.explode(F.sequence(F.col("bucket") * width, (F.col("bucket") + 1) * width - 1)).alias("slot")
    ), depth


def build_index(keys: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame]:
    """(directory slots, index): the keys in bucket order, each owner task with a range of them."""
    table, depth = slots(directory(keys, capacity))
    entries = keys.withColumn("slot", prefix(F.col("key"), depth)).join(table, "slot")
    index = settle(
        entries.repartitionByRange("slot", "key").sortWithinPartitions("slot", "key").select("bucket", "depth", "key", "n")
    )
    return table, index


def exact_dedup(
    docs: DataFrame, text: str = "text", id: str = "doc_id", capacity: int = CAPACITY
) -> DataFrame:
    """`docs` without its text, with keep_id, group_size, kept and text_sha256."""
    ready(docs.sparkSession)
    keyed = packed(docs, text, id).withColumn("norm", normalised(F.col("in_text")))
    entries = settle(
        keyed.select(
            "in_id", F.xxhash64("norm").alias("key"), F.unhex(F.sha2("norm", 256)).alias("sha"), "rest",
            F.monotonically_increasing_id().alias("row"),
        )
    )
    _, index = build_index(entries.groupBy("key").agg(F.count("*").alias("n")), capacity)
    chained = settle(index.where("n > 1").select("key"))
    links = (
        keyed.select(F.xxhash64("norm").alias("key"), "norm")
        .join(chained, "key", "left_semi")
        .groupBy("key", "norm")  # the bytes themselves, combined in each task first
        .count()
        .select("key", F.unhex(F.sha2("norm", 256)).alias("sha"))
    )
    unique = links.groupBy("key", "sha").agg(
        F.when(F.count("*") == 1, True).otherwise(F.raise_error(F.lit("two texts with one SHA-256"))).alias("compared")
    )
    least = F.lit(-(2**63))
    groups = settle(
        entries.join(chained, "key", "left_semi")
        .groupBy("key", "sha")
        .agg(
            F.max("in_id").alias("keep_id"),
            F.max_by("row", F.coalesce("in_id", least)).alias("keep_row"),
            F.count("*").alias("size"),
        )
        .join(unique, ["key", "sha"])
        .where("compared")
        .select("key", "sha", "keep_id", "keep_row", "size", F.lit(True).alias("found"))
    )
    answers = entries.join(groups, ["key", "sha"], "left").select(
        "rest", "row",
        F.when(F.col("found"), F.col("keep_id")).otherwise(F.col("in_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        (F.coalesce("keep_row", "row") == F.col("row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
    added = {k: F.col(k) for k in ("keep_id", "group_size", "kept", "text_sha256")}
    return unpacked(answers, [c for c in docs.columns if c != text], added)


def kept_documents(docs: DataFrame, text: str = "text", id: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """One document of each group of equal texts, with all columns."""
    least = F.lit(-(2**63))
    done = exact_dedup(docs.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), capacity=capacity)
    decided = done.select(F.coalesce("doc_id", least).alias("out_id"), F.unhex("text_sha256").alias("out_sha"), "kept")
    keys = {
        "out_id": F.coalesce(F.col(f"`{id}`"), least),
        "out_sha": F.unhex(F.sha2(normalised(F.coalesce(F.col(f"`{text}`"), F.lit(""))), 256)),
    }
    return survivors(docs, keys, decided)


SQL = """
WITH norm AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM norm
"""


def digest(docs: DataFrame) -> DataFrame:
    return exact_dedup(docs.select("doc_id", "text"))
