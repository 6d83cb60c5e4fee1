"""Encoding, packing and token counts against the tokenizers library."""

import hashlib
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpus import empty, table, texts
from stayloom.llm import bpe, packing, token_counts

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
_TABLES = {p: bpe.Words(open(p).read()) for p in (BYTES, WORDS)}
_PLAIN = {p: Tokenizer.from_file(p) for p in (BYTES, WORDS)}

odd = st.text(alphabet=st.sampled_from("ab'sÉeé́Σς 1٣\t\n\r\x0b\x1c\x85  　.#<|>endoftext漢字"), max_size=40)


def block(rows):
    raw = [t.encode() for t in rows]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


@pytest.mark.parametrize("path", [BYTES, WORDS])
@settings(max_examples=300, deadline=None)
@given(rows=st.lists(odd | st.text(max_size=30), max_size=4))
def test_ids_are_the_librarys(path, rows):
    ids, bounds, *_ = _TABLES[path].encode(*block(rows))
    got = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    assert got == [x.ids for x in _PLAIN[path].encode_batch(rows, add_special_tokens=False)]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encode_and_decode(spark, path):
    docs = table(spark)
    plain = _PLAIN[path]
    encoded = bpe.encode(docs, path)
    assert encoded.columns == [c for c in docs.columns if c != "text"] + ["ids"]
    rows = bpe.decode(encoded, path).collect()
    want = sorted(plain.decode(plain.encode(r["text"] or "", add_special_tokens=False).ids, skip_special_tokens=False) for r in docs.collect())
    assert sorted(r["decoded"] for r in rows) == want
    if path == BYTES:
        assert want == sorted(r["text"] or "" for r in docs.collect())
    assert bpe.encode(empty(spark), path).count() == 0


@pytest.mark.parametrize("size", [0, 20, bpe.TABLE])  # none, some and all words in the table
@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_digest(spark, path, size):
    plain, docs = _PLAIN[path], table(spark, repeat=False)
    by_id = dict(enumerate(texts()))
    rows = bpe.digest(docs, path, size).collect()
    assert len(rows) == docs.count()
    for r in rows:
        ids = plain.encode(by_id[r["doc_id"]] or "", add_special_tokens=False).ids
        decoded = plain.decode(ids, skip_special_tokens=False).encode()
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded).hexdigest()


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_the_table_has_each_distinct_word_once(spark, path):
    docs = table(spark)
    source = bpe.packed(docs).select("in_text")
    rows = bpe.word_table(source, bpe.vocabulary(spark, path)).collect()
    want = set()
    for text in {r["text"] or "" for r in docs.collect()}:
        data, offsets = block([text])
        start, end, _ = _TABLES[path].units(data, offsets)
        want |= {data.tobytes()[a:b] for a, b in zip(start, end)}
    assert len(rows) == len({r["key"] for r in rows}) == len(want)
    assert sorted(r["ids"] for r in rows) == sorted(_PLAIN[path].encode(w.decode(), add_special_tokens=False).ids for w in want)
    few = bpe.word_table(source, bpe.vocabulary(spark, path), 30).collect()
    assert 0 < len(few) <= 30 and {r["key"] for r in few} < {r["key"] for r in rows}
    assert bpe.word_table(source, bpe.vocabulary(spark, path), 0).count() == 0


@pytest.mark.parametrize("length", [16, 2048])
def test_packing(spark, length):
    docs, plain = table(spark, repeat=False), _PLAIN[BYTES]
    whole = {i: [*plain.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts())}
    got = packing.packing(docs, BYTES, length)
    assert got.columns == [c for c in docs.columns if c != "text"] + ["piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    covered, filled = defaultdict(list), defaultdict(list)
    for r in got.collect():
        ids = whole[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        covered[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, ids in whole.items():
        at = 0
        for n, (piece, start, size) in enumerate(sorted(covered[i])):
            assert (piece, start) == (n, at) and (size == length or n == 0 or len(ids) <= length)
            at += size
        assert at == len(ids)
    for places in filled.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= length
    assert packing.packing(empty(spark), BYTES).count() == 0


def test_repeated_rows_are_packed_each(spark):
    docs = table(spark)
    rows = packing.packing(docs, BYTES).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows) >= docs.count()


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=20))
def test_best_fit(histogram):
    plan = packing.best_fit(histogram, 64)
    ranks, used = defaultdict(list), defaultdict(list)
    for length, rank, many, first, offset in plan:
        ranks[length] += range(rank, rank + many)
        for k in range(many):
            used[first + k].append((offset, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in histogram.items()}
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(k * n for k, n in histogram.items())
    assert len(used) <= max(-(-total // 64), 1.25 * total / 64 + 1, sum(n for k, n in histogram.items() if 2 * k > 64) + total / 48 + 1)


def test_plan_size_does_not_follow_the_documents():
    few = {k: 1 + k % 7 for k in range(1, 2049)}
    many = {k: n * 1_000_000 for k, n in few.items()}
    assert len(packing.best_fit(many, 2048)) < 60_000


def store_rows(store):
    return {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"]) for r in store.totals().collect()}


def test_token_counts(spark, tmp_path):
    plain = _PLAIN[BYTES]
    store = token_counts.Store(spark, str(tmp_path / "counts"))
    schema = "doc_id bigint, text string, source string, lang string"
    first = [(1, "one two", "a", "en"), (2, "three", "a", None), (3, None, None, "en"), (None, "no id", "a", "en"), (4, "x y", "b", "de"), (4, "x", "b", "de")]
    counted = lambda rows, version="v1": token_counts.counted(spark.createDataFrame(rows, schema), BYTES, version)

    def want(rows, version="v1"):
        out = defaultdict(lambda: [0, 0])
        for _, t, s, g in rows:
            cell = out[s, g, version]
            cell[0] += 1
            cell[1] += len(plain.encode(t or "", add_special_tokens=False).ids)
        return {k: tuple(v) for k, v in out.items()}

    assert store_rows(store) == {}
    assert store.commit("b/1", counted(first))
    assert store_rows(store) == want(first)
    assert not store.commit("b/1", counted(first))  # again: nothing happens
    assert store_rows(store) == want(first)
    revised = [(1, "one two three four", "c", "en"), (4, "z", "b", "de"), (5, "new", "a", "en")]
    assert store.commit("b2", counted(revised), spark.createDataFrame([(2,), (99,)], "doc_id bigint"))
    left = [r for r in first if r[0] not in (1, 2, 4)] + revised
    assert store_rows(store) == want(left)
    # A failed attempt leaves files without the marker: not read, and overwritten by the next attempt.
    counted(first).limit(0).write.parquet(store.place("ledger", "b3"))
    (tmp_path / "counts/deltas/b3").mkdir()
    assert store_rows(store) == want(left)
    assert store.commit("b3", counted(left[-1:], "v2"))
    assert store_rows(store) == want(left) | want(left[-1:], "v2")
    assert store.commit("b4", deleted=spark.createDataFrame([(5,)], "doc_id bigint"))
    assert store_rows(store) == want(left[:-1])


def test_a_history_ends_with_the_counts_of_the_documents(spark, tmp_path):
    """Every batch changes rows: a former state is taken back, deleted documents return."""
    plain, docs = _PLAIN[BYTES], table(spark)
    want = defaultdict(lambda: [0, 0])
    for r in docs.collect():
        cell = want[r["source"], r["lang"], "v"]
        cell[0] += 1
        cell[1] += len(plain.encode(r["text"] or "", add_special_tokens=False).ids)
    got = token_counts.digest(docs, str(tmp_path / "store"), BYTES, "v").collect()
    assert {(r["source"], r["lang"], r["tokenizer"]): [r["n_docs"], r["n_tokens"]] for r in got} == dict(want)
    store, total = token_counts.Store(spark, str(tmp_path / "store")), docs.count()
    assert len(store.committed()) == 4
    moved = [spark.read.parquet(store.place("deltas", n)).agg(F.sum("n_docs"), F.sum("n_tokens")).first() for n in ("1 insert", "2 revise", "3 delete", "4 restore")]
    assert [m[0] for m in moved][0] == total and moved[1][0] == 0 and moved[1][1] > 0 and moved[2][0] == -moved[3][0] < 0


def test_token_counts_of_nothing(spark, tmp_path):
    store = token_counts.Store(spark, str(tmp_path / "none"))
    assert store.commit("x", token_counts.counted(empty(spark), BYTES, "v")) and store.totals().count() == 0
