"""Byte-pair encoding by a distinct-word table, and decoding by an id-to-piece table.

* Splitting: blocks of documents are split into words; Spark counts the distinct ones, combined in each
  task first.
* Table: each distinct word goes through the tokenizers library once, in tasks of their own.  The table
  holds the commonest words with their ids, TABLE at most, which is all of them unless the corpus has more; so
  its size is bounded and it is broadcast.  Words beyond it, each of them rarer than all in it, are encoded where
  they stand and kept in a bounded table of the worker.
* Joining: ids join the words of a block by position, as arrays.
* Decoding: ids join a table of the vocabulary's pieces by position.

Words are told apart by 64-bit hashes.  They are what the library itself never merges across:

* for a vocabulary that drops white space, the stretches between ASCII white space;
* for a byte-level vocabulary, each such stretch with the white space before it, and the white space
  at the text's end; a text with other Unicode white space is one word, since there white space
  may be divided differently.

Null and empty texts have no ids and decode to the empty text.  Rows are encoded alone, so ties,
repeated rows and other columns play no part.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from itertools import chain, repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayloom.llm import arrays
from stayloom.llm.frames import packed, ready, settle, unpacked

TABLE = 500_000  # words of the corpus's table
WORDS = 500_000  # words a worker's table holds before it starts anew
IDS = 4_000_000  # and ids

#: Fixed value: how a byte-level vocabulary divides text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer file, a few megabytes whatever the corpus, for all executors."""
    return spark.sparkContext.broadcast(Path(path).read_text())


def other_space(data: np.ndarray) -> np.ndarray:
    """Places of Unicode white space beyond ASCII, in UTF-8."""
    at = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    if not len(at):
        return at
    after = np.concatenate([data, np.zeros(2, np.uint8)])
    a, b, c = after[at], after[at + 1], after[at + 2]
    hit = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    hit |= (a == 0xE1) & (b == 0x9A) & (c == 0x80)
    hit |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    hit |= (a == 0xE2) & (b == 0x81) & (c == 0x9F)
    hit |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
    return at[hit]


def byte_of_sign() -> dict[str, int]:
    """Byte-level vocabularies write a byte as its own Latin-1 sign, or one from 256 on if that doesn't print."""
    plain = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(plain)))}


def ranked(spec: dict) -> Callable[[str], list[int]] | None:
    """The ids of a word by merge rank, where the file is a plain byte-level one whose merges rank as their
    results' ids do; tiktoken then gives the library's own ids several times as fast."""
    import tiktoken

    model, before = spec["model"], spec["pre_tokenizer"]
    plain = spec["normalizer"] is None and before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
    if not plain or any(model.get(k) for k in ("dropout", "unk_token", "end_of_word_suffix", "ignore_merges", "byte_fallback")):
        return None
    added = {t["content"] for t in spec["added_tokens"]}
    merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if merged != sorted(merged):
        return None
    sign = byte_of_sign()
    ranks = {bytes(sign[c] for c in t): k for t, k in model["vocab"].items() if t not in added}
    return tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Words:
    """The distinct-word table of one worker."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        spec = json.loads(source)
        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.byte_level = spec["pre_tokenizer"]["type"] == "ByteLevel"
        self.spaced = spec.get("decoder") is None  # pieces are then joined by a space
        self.ranked = ranked(spec)
        self.added = [t["content"] for t in spec["added_tokens"]]
        size = self.tokenizer.get_vocab_size()
        self.by_id = Pieces([self.tokenizer.id_to_token(k) or "" for k in range(size)]) if self.spaced else None
        self.forget()

    def forget(self) -> None:
        self.slots: dict[int, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.begin = np.zeros(1, np.int64)

    def units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the block's words, and the rows' bounds."""
        start, end, bounds = arrays.words(data, offsets)
        if not self.byte_level:
            return start, end, bounds
        start = np.concatenate([[0], end[:-1]]) if len(end) else start
        filled = bounds[1:] > bounds[:-1]
        start[bounds[:-1][filled]] = offsets[:-1][filled]
        whole = np.zeros(len(offsets) - 1, bool)
        whole[np.searchsorted(offsets, other_space(data), "right") - 1] = True
        if whole.any():
            keep = ~whole[arrays.rows_of(bounds)]
            start, end = start[keep], end[keep]
            bounds = np.concatenate([[0], np.cumsum(np.where(whole, 0, np.diff(bounds)))])
        last = np.where(np.diff(bounds) > 0, np.concatenate([end, [0]])[np.maximum(bounds[1:] - 1, 0)], offsets[:-1])
        tail = np.flatnonzero(last < offsets[1:])  # white space at the end, or a whole text
        start = np.insert(start, bounds[1:][tail], last[tail])
        end = np.insert(end, bounds[1:][tail], offsets[1:][tail])
        more = np.zeros(len(offsets), np.int64)
        more[tail + 1] = 1
        return start, end, bounds + np.cumsum(more)

    def listed(self, words: list[str]) -> list[list[int]]:
        """The ids of each word."""
        if self.ranked is None:
            return [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        found = list(map(self.ranked, words))
        if any(t in word for t in self.added for word in ["".join(words)]):
            for k, word in enumerate(words):
                if any(t in word for t in self.added):
                    found[k] = self.tokenizer.encode(word, add_special_tokens=False).ids
        return found

    def learn(self, keys: list[int], words: list[str]) -> None:
        found = self.listed(words)
        size = np.fromiter(map(len, found), np.int64, len(found))
        self.slots.update(zip(keys, range(len(self.slots), len(self.slots) + len(keys))))
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(size)])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum()))])

    def rare(self, keys: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the distinct words from start to end, one after the other, and where each word's begin."""
        if len(self.slots) > WORDS or len(self.ids) > IDS:
            self.forget()
        slots = self._slots(keys, data, start, end)
        begin, to = self.begin[slots], self.begin[slots + 1]
        return self.ids[arrays.ranges(begin, to)], np.concatenate([[0], np.cumsum(to - begin)])

    def _slots(self, keys: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        listed = keys.tolist()
        slots = np.fromiter(map(self.slots.get, listed, repeat(-1)), np.int64, len(listed))
        new = np.flatnonzero(slots < 0)
        if len(new):
            block = data.tobytes()
            slots[new] = len(self.slots) + np.arange(len(new))
            self.learn(keys[new].tolist(), [block[a:b].decode() for a, b in zip(start[new].tolist(), end[new].tolist())])
        return slots

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the block, the rows' bounds in them, and the word slots with the rows' bounds in these."""
        if len(self.slots) > WORDS or len(self.ids) > IDS:
            self.forget()
        start, end, bounds = self.units(data, offsets)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64), bounds
        keys, first, back = np.unique(arrays.word_hashes(data, start, end), return_index=True, return_inverse=True)
        slots = self._slots(keys, data, start[first], end[first])[back]
        size = np.diff(self.begin)[slots]
        before = np.concatenate([[0], np.cumsum(size)])
        place = np.arange(before[-1]) + np.repeat(self.begin[slots] - before[:-1], size)
        return self.ids[place], before[bounds], slots, bounds


_tables: dict[int, Words] = {}


def table(source: Broadcast) -> Words:
    """This worker's table; it outlives the task, since workers are used again."""
    key = hash(source.value)
    if key not in _tables:
        _tables.clear()
        _tables[key] = Words(source.value)
    return _tables[key]


class Known:
    """Words with their ids: hashes in order, and the ids of the k-th from begin[k] to begin[k + 1]."""

    def __init__(self, keys: np.ndarray, begin: np.ndarray, ids: np.ndarray):
        order = np.argsort(keys)
        size = np.diff(begin)[order]
        self.keys, self.begin = keys[order], np.concatenate([[0], np.cumsum(size)])
        self.ids = ids[arrays.ranges(begin[:-1][order], begin[1:][order])]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 if it is not there."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)


def joined(words: Words, known: Known, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a block and the rows' bounds in them: the table's, joined to the words by position."""
    start, end, bounds = words.units(data, offsets)
    if not len(start):
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    keys, first, back = np.unique(arrays.word_hashes(data, start, end), return_index=True, return_inverse=True)
    at = known.find(keys)
    size = np.where(at >= 0, np.diff(known.begin)[at] if len(known.keys) else 0, 0)
    other = np.flatnonzero(at < 0)
    if len(other):
        own, cuts = words.rare(keys[other], data, start[first[other]], end[first[other]])
        size[other] = np.diff(cuts)
    begin = np.concatenate([[0], np.cumsum(size)])
    ids = np.zeros(begin[-1], np.uint32)
    hit = np.flatnonzero(at >= 0)
    ids[arrays.ranges(begin[hit], begin[hit + 1])] = known.ids[arrays.ranges(known.begin[at[hit]], known.begin[at[hit] + 1])]
    if len(other):
        ids[arrays.ranges(begin[other], begin[other + 1])] = own
    before = np.concatenate([[0], np.cumsum(size[back])])
    return ids[arrays.ranges(begin[back], begin[back + 1])], before[bounds]


def split(source: Broadcast) -> Callable:
    """The distinct words of each batch with their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = table(source)
        for batch in batches:
            for _, data, offsets in arrays.blocks(batch.column("in_text")):
                start, end, _ = words.units(data, offsets)
                if not len(start):
                    continue
                keys, first, many = np.unique(arrays.word_hashes(data, start, end), return_index=True, return_counts=True)
                block = data.tobytes()
                texts = [block[a:b].decode() for a, b in zip(start[first].tolist(), end[first].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(texts, pa.string()), pa.array(many.astype(np.int64))], ["key", "word", "many"]
                )

    return run


def listed(source: Broadcast) -> Callable:
    """The ids of each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = table(source)
        for batch in batches:
            if len(batch):
                found = words.listed(batch.column("word").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.list_(pa.int32()))], ["key", "ids"])

    return run


def word_table(source: DataFrame, tokenizer: Broadcast, size: int = TABLE) -> DataFrame:
    """(key, ids) of the commonest words of the texts in in_text, at most `size`, each encoded once.

    Words of about the same number (a sixteenth of a doubling) are in the table together or not at all.
    """
    found = source.select("in_text").mapInArrow(split(tokenizer), "key bigint, word string, many bigint")
    counted = settle(found.groupBy("key").agg(F.sum("many").alias("many"), F.first("word").alias("word")))
    number = F.floor(F.log2("many") * 16).cast("int")
    groups = counted.groupBy(number.alias("number")).count().orderBy(F.desc("number")).collect()  # at most 16 * 63 rows
    held, least = 0, 16 * 64
    for r in groups:
        held += r["count"]
        if held > size:
            break
        least = r["number"]
    return counted.where(number >= least).select("key", "word").mapInArrow(listed(tokenizer), "key bigint, ids array<int>")


def known_words(source: DataFrame, tokenizer: Broadcast, size: int = TABLE) -> Broadcast:
    found = word_table(source, tokenizer, size).toArrow()
    keys, ids = found.column("key").to_numpy().view(np.uint64), found.column("ids").combine_chunks()
    many = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) if len(ids) else np.zeros(0, np.int64)
    flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.uint32)
    return source.sparkSession.sparkContext.broadcast(Known(keys, np.concatenate([[0], np.cumsum(many)]), flat))


def encoded(source: Broadcast, known: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = table(source)
        for batch in batches:
            for first, data, offsets in arrays.blocks(batch.column("in_text")):
                ids, bounds = joined(words, known.value, data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("rest").slice(first, len(offsets) - 1),
                        arrays.lists(np.diff(bounds), pa.array(ids.astype(np.int32))),
                    ],
                    ["rest", "ids"],
                )

    return run


def encode(docs: DataFrame, path: str, text: str = "text", id: str = "doc_id", size: int = TABLE) -> DataFrame:
    """`docs` with `ids`, the text's token ids in order."""
    spark = ready(docs.sparkSession)
    source = packed(docs, text, id).select("rest", "in_text")
    rest = source.schema["rest"].dataType.simpleString()
    tokenizer = vocabulary(spark, path)
    found = source.mapInArrow(encoded(tokenizer, known_words(source, tokenizer, size)), f"rest {rest}, ids array<int>")
    return unpacked(found, [c for c in docs.columns if c != text], {"ids": F.col("ids")})


class Pieces:
    """The id-to-piece table of a vocabulary whose pieces are joined by spaces."""

    def __init__(self, pieces: list[str]):
        raw = [p.encode() + b" " for p in pieces]
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        self.begin = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The decoded text of each row."""
        start, end = self.begin[ids], self.begin[ids.astype(np.int64) + 1]
        before = np.concatenate([[0], np.cumsum(end - start)])[bounds].tolist()
        raw = self.data[arrays.ranges(start, end)].tobytes()
        return [raw[a : max(a, b - 1)] for a, b in zip(before, before[1:])]


def decoded_rows(words: Words, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    if words.spaced:
        return words.by_id.decode(ids, bounds)
    rows = [ids[a:b].tolist() for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
    return [x.encode() for x in words.tokenizer.decode_batch(rows, skip_special_tokens=False)]


def decoded(source: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = table(source)
        for batch in batches:
            column = batch.column("ids")
            many = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = column.flatten().to_numpy(zero_copy_only=False).astype(np.uint32)
            texts = decoded_rows(words, ids, np.concatenate([[0], np.cumsum(many)]))
            yield pa.RecordBatch.from_arrays([batch.column("rest"), pa.array(texts, pa.binary()).cast(pa.string())], ["rest", "decoded"])

    return run


def decode(encoded_docs: DataFrame, path: str, ids: str = "ids", id: str = "doc_id") -> DataFrame:
    """`encoded_docs` with `decoded` for its ids; null ids decode to the empty text."""
    spark = ready(encoded_docs.sparkSession)
    rest = [F.col(f"`{c}`") for c in encoded_docs.columns if c != ids]
    source = encoded_docs.select(F.struct(*rest).alias("rest"), F.col(f"`{ids}`").alias("ids"))
    kind = source.schema["rest"].dataType.simpleString()
    found = source.mapInArrow(decoded(vocabulary(spark, path)), f"rest {kind}, decoded string")
    return unpacked(found, [c for c in encoded_docs.columns if c != ids], {"decoded": F.col("decoded")})


def round_trip(source: Broadcast, known: Broadcast) -> Callable:
    """Digests of each row's ids and of their decoded text, without either leaving the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = table(source)
        for batch in batches:
            for first, data, offsets in arrays.blocks(batch.column("in_text")):
                ids, bounds = joined(words, known.value, data, offsets)
                raw, at = memoryview(ids.astype("<u4").tobytes()), (bounds * 4).tolist()
                sha = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(at, at[1:])]
                texts = [hashlib.sha256(x).hexdigest() for x in decoded_rows(words, ids, bounds)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("rest").slice(first, len(offsets) - 1), pa.array(np.diff(bounds)),
                        pa.array(sha, pa.string()), pa.array(texts, pa.string()),
                    ],
                    ["rest", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return run


def digest(docs: DataFrame, path: str, size: int = TABLE) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text, encoded and decoded again."""
    spark = ready(docs.sparkSession)
    source = packed(docs.select("doc_id", "text")).select("rest", "in_text")
    rest = source.schema["rest"].dataType.simpleString()
    tokenizer = vocabulary(spark, path)
    found = source.mapInArrow(
        round_trip(tokenizer, known_words(source, tokenizer, size)), f"rest {rest}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
    return unpacked(found, ["doc_id"], {k: F.col(k) for k in ("n_tokens", "ids_sha256", "decoded_sha256")})
