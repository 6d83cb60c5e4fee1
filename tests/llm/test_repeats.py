"""Substring deduplication by words and by bytes against brute force."""

import hashlib
from collections import Counter

import pytest

from corpus import empty, table
from stayloom.llm import repeats, substring_dedup, suffix_dedup


def brute(rows, length, words):
    """Sorted (id, units, removed, spans, digest) of (id, text) rows."""
    units = [((t or "").encode().split() if words else (t or "").encode()) for _, t in rows]
    key = tuple if words else bytes
    seen = Counter(key(u[k : k + length]) for u in units for k in range(len(u) - length + 1))
    out = []
    for (i, _), u in zip(rows, units):
        gone = [False] * len(u)
        for k in range(len(u) - length + 1):
            if seen[key(u[k : k + length])] > 1:
                gone[k : k + length] = [True] * length
        kept = [x for x, g in zip(u, gone) if not g]
        joined = b" ".join(kept) if words else bytes(kept)
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        out.append((i, len(u), sum(gone), spans, hashlib.sha256(joined).hexdigest()))
    return sorted(out, key=repr)


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("window", [3, 35])
def test_words(spark, window, seed):
    docs = table(spark, seed)
    got = substring_dedup.substring_dedup(docs, window)
    assert got.columns == [*docs.columns, "n_words", "n_removed", "n_spans", "kept_sha256"]
    rows = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got.collect()), key=repr)
    assert rows == brute(pairs(docs), window, True)


def test_cut_texts(spark):
    docs = table(spark)
    before = dict(pairs(docs))
    for r in substring_dedup.substring_dedup(docs).collect():
        if r["n_removed"]:
            assert hashlib.sha256(r["text"].encode()).hexdigest() == r["kept_sha256"]
        elif r["doc_id"] is not None:
            assert r["text"] == (before[r["doc_id"]] or "")


@pytest.mark.parametrize("group", [1, 4096])  # 1: every trigger is counted, none is sorted
@pytest.mark.parametrize("length", [30, 400])
def test_bytes(spark, length, group):
    docs = table(spark)
    got = suffix_dedup.suffix_dedup(docs, length, group=group)
    assert got.columns == [*docs.columns, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    done = got.collect()
    rows = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in done), key=repr)
    assert rows == brute(pairs(docs), length, False)
    assert all(hashlib.sha256(r["text"]).hexdigest() == r["kept_sha256"] for r in done)


def test_many_contexts_of_one_trigger(spark):
    """Near copies that differ around a common middle: sorted in one group, and counted."""
    middle = "the common middle of every text " * 3
    docs = spark.createDataFrame([(i, f"{i % 7} {i % 5}{middle}{i % 3} {i % 11}") for i in range(60)], "doc_id bigint, text string")
    want = brute(pairs(docs), 60, False)
    for group in (1, 1000):
        got = suffix_dedup.suffix_dedup(docs, 60, with_text=False, group=group)
        assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got.collect()), key=repr) == want


def test_empty_tables(spark):
    for operator in (substring_dedup.substring_dedup, suffix_dedup.suffix_dedup):
        assert operator(empty(spark)).count() == 0


def test_units_of_one_text(spark):
    unit = repeats.Unit(3, 2, True)
    assert unit.joined(unit.pieces(b" a\tb  c\n")) == b"a b c"


@pytest.mark.parametrize("operator", [substring_dedup.substring_dedup, suffix_dedup.suffix_dedup])
def test_many_rows_of_one_id_and_text(spark, operator):
    """Each keeps the places of its own text once, not those of all rows."""
    text = " ".join(f"word{i}" for i in range(400))
    docs = spark.createDataFrame([(None, text)] * 20_000 + [(1, "word1 word2")], "doc_id bigint, text string").repartition(8)
    counted = operator(docs, with_text=False).groupBy("doc_id", "n_removed").count().collect()
    whole = 400 if operator is substring_dedup.substring_dedup else len(text)
    assert {tuple(r) for r in counted} == {(None, whole, 20_000), (1, 0, 1)}


def test_blocks_are_small_and_freed_memory_is_given_back():
    """A worker's arrays are some 150 bytes for each byte of a block."""
    from stayloom.llm import arrays

    assert arrays.BLOCK <= 1 << 18
    arrays.release()
