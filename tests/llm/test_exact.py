"""Exact deduplication against a plain grouping, and the index."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from corpus import empty, table
from stayloom.llm import exact_dedup
from stayloom.llm.frames import settle


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("capacity", [1, 4, 1 << 14])
def test_groups(spark, capacity):
    docs = table(spark)
    groups = defaultdict(list)
    for r in docs.collect():
        groups[lower(r["text"])].append(r["doc_id"])
    got = exact_dedup.exact_dedup(docs, capacity=capacity)
    assert got.columns == [c for c in docs.columns if c != "text"] + ["keep_id", "group_size", "kept", "text_sha256"]
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    rows, kept = got.collect(), defaultdict(list)
    assert len(rows) == docs.count()
    for r in rows:
        ids = by_hash[r["text_sha256"]]
        known = [i for i in ids if i is not None]
        assert r["keep_id"] == (max(known) if known else None) and r["group_size"] == len(ids)
        if r["kept"]:
            kept[r["text_sha256"]].append(r["doc_id"])
            assert r["doc_id"] == r["keep_id"]
    assert {k: len(v) for k, v in kept.items()} == dict.fromkeys(by_hash, 1)


def test_kept_documents(spark):
    docs = table(spark)
    got = exact_dedup.kept_documents(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert sorted(lower(r["text"]) for r in rows) == sorted({lower(r["text"]) for r in docs.collect()})


def test_only_ascii_is_lowered(spark):
    docs = spark.createDataFrame([(1, "ÉA"), (2, "éa"), (3, "Éa"), (4, "KK"), (5, "kk")], "doc_id bigint, text string")
    assert {r["doc_id"]: r["keep_id"] for r in exact_dedup.exact_dedup(docs).collect()} == {1: 3, 2: 2, 3: 3, 4: 4, 5: 5}


@pytest.mark.parametrize("capacity", [1, 3, 1000])
def test_directory_splits_until_buckets_fit(spark, capacity):
    keys = settle(spark.range(200).select(F.xxhash64("id").alias("key"), F.lit(1).alias("n")))
    table_, index = exact_dedup.build_index(keys, capacity)
    rows = index.collect()
    sizes = defaultdict(list)
    for r in rows:
        sizes[r["depth"], r["bucket"]].append(r["key"])
    assert len(rows) == 200 and max(map(len, sizes.values())) <= capacity
    for (depth, bucket), held in sizes.items():
        assert {(k % 2**64) >> (64 - depth) if depth else 0 for k in held} == {bucket}
    depth = max(d for d, _ in sizes)
    assert sorted(r["slot"] for r in table_.select("slot").distinct().collect()) == sorted(r["slot"] for r in table_.collect())
    assert table_.count() <= 2**depth


def test_no_python_on_the_way(spark):
    plan = exact_dedup.digest(table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty(spark):
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0 and exact_dedup.kept_documents(empty(spark)).count() == 0
