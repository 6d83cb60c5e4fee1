"""Repetition rules of a text: what part of its characters stands in duplicated n-grams and lines.

Rolling hashes of word n-grams (several lengths) and hashes of lines, in numpy, a block of texts at
a time.  A word belongs to the duplicated part of length n if an n-gram over it equals an earlier one
of its text; a line likewise.  So a heading that stands again at the end counts once.  Only the base
measure `n_repeat_words` counts first occurrences too.

Null and empty texts have no words and fail the base rule.  Every row is judged alone, so ties,
repeated rows and other columns play no part.  No verdict depends on other texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayloom.llm import arrays
from stayloom.llm.frames import packed, ready, unpacked

#: Greatest part of a text's word characters inside duplicated n-grams, by n.
LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Greatest part of the characters inside lines that an earlier line equals, and of symbols per word.
LINE_LIMIT = 0.20
SYMBOL_LIMIT = 0.10

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_FIRST = (np.arange(256) & 0xC0) != 0x80  # the first byte of a code point


def duplicated(keys: np.ndarray, firsts: bool) -> np.ndarray:
    """Which keys have an equal earlier one, or with `firsts` an equal one anywhere."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[order[1:]] == keys[order[:-1]]
    out = np.empty(len(keys), bool)
    out[order] = same[1:] | same[:-1] if firsts else same[:-1]
    return out


def covered(hashes: np.ndarray, row: np.ndarray, n: int, firsts: bool = False) -> np.ndarray:
    """Which words stand in an n-gram that repeats one of their row."""
    total = len(hashes)
    out = np.zeros(total, bool)
    if total < n:
        return out
    start = np.flatnonzero(row[n - 1 :] == row[: total - n + 1])
    keys = arrays.mix(arrays.windows(hashes, n)[start] + row[start].astype(np.uint64) * arrays.SEED)
    start = start[duplicated(keys, firsts)]
    edge = np.zeros(total + 1, np.int32)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + n, -1)
    return np.cumsum(edge[:-1]) > 0


def measures(data: np.ndarray, offsets: np.ndarray, lengths: list[int]) -> dict[str, np.ndarray]:
    rows = len(offsets) - 1
    total = lambda row, x=None: np.bincount(row, weights=x, minlength=rows).astype(np.int64)
    points = np.concatenate([[0], np.cumsum(_FIRST[data])])
    start, end, bounds = arrays.words(data, offsets)
    row = arrays.rows_of(bounds)
    chars = points[end] - points[start]
    polynomial = arrays.sums(arrays.BYTES[0][data])
    hashes = arrays.spans(polynomial, start, end)
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    out = {
        "n_words": np.diff(bounds).astype(np.int64),
        "word_chars": total(row, chars),
        "n_symbols": np.diff(symbols[offsets]).astype(np.int64),
        "n_repeat_words": total(row, covered(hashes, row, 3, firsts=True)),
    }
    for n in lengths:
        out[f"dup_chars_{n}"] = total(row, chars * covered(hashes, row, n))
    # Lines: cut at \n and at the rows' ends; those with a word, from the second of equals on.
    breaks = np.flatnonzero(data == 10)
    begin = np.concatenate([breaks + 1, offsets[:-1]])
    stop = np.concatenate([breaks, offsets[1:]])
    begin, stop = np.sort(begin), np.sort(stop)
    has_word = np.searchsorted(start, stop, "left") > np.searchsorted(start, begin, "left")
    begin, stop = begin[has_word], stop[has_word]
    line_row = np.searchsorted(offsets, begin, "right") - 1
    keys = arrays.mix(arrays.spans(polynomial, begin, stop) + line_row.astype(np.uint64) * arrays.SEED)
    later = np.ones(len(keys), bool)
    later[np.unique(keys, return_index=True)[1]] = False
    inner = np.concatenate([[0], np.cumsum(chars)])
    line_chars = inner[np.searchsorted(start, stop, "left")] - inner[np.searchsorted(start, begin, "left")]
    out["n_dup_lines"] = total(line_row, later)
    out["dup_line_chars"] = total(line_row, line_chars * later)
    return out


def measure(lengths: list[int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in arrays.blocks(batch.column("in_text")):
                found = measures(data, offsets, lengths)
                rest = batch.column("rest").slice(first, len(offsets) - 1)
                yield pa.RecordBatch.from_arrays([rest, *[pa.array(x) for x in found.values()]], ["rest", *found])

    return run


def quality_rules(
    docs: DataFrame,
    limits: dict[int, float] = LIMITS,
    line_limit: float = LINE_LIMIT,
    symbol_limit: float = SYMBOL_LIMIT,
    text: str = "text",
    id: str = "doc_id",
) -> DataFrame:
    """`docs` without its text, with the measures, base_failed and kept."""
    ready(docs.sparkSession)
    source = packed(docs, text, id).select("rest", "in_text")
    lengths = sorted(limits)
    names = ["n_words", "word_chars", "n_symbols", "n_repeat_words", *[f"dup_chars_{n}" for n in lengths], "n_dup_lines", "dup_line_chars"]
    rest = source.schema["rest"].dataType.simpleString()
    found = source.mapInArrow(measure(lengths), f"rest {rest}, " + ", ".join(f"{c} bigint" for c in names))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    passed = F.col("dup_line_chars") <= line_limit * F.col("word_chars")
    passed &= F.col("n_symbols") <= symbol_limit * F.col("n_words")
    for n, limit in limits.items():
        passed &= F.col(f"dup_chars_{n}") <= limit * F.col("word_chars")
    added = {c: F.col(c) for c in names} | {"base_failed": failed, "kept": ~failed & passed}
    return unpacked(found, [c for c in docs.columns if c != text], added)


def digest(docs: DataFrame) -> DataFrame:
    return quality_rules(docs.select("doc_id", "text"))
