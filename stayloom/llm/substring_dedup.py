"""Substring deduplication: words in windows that also stand elsewhere are removed.

Rabin-Karp hashes of every window of 35 words; hashes are counted in Spark, and repeated windows
merge into maximal removal intervals.  A window whose anchor word-gram occurs once in the corpus,
or whose whole stretch does not meet a different one, is decided without its own row (`repeats`).

Null and empty texts have no words and stay as they are; a text shorter than a window keeps all its
words; repeated rows count as separate documents and lose what they share; null ids are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayloom.llm.repeats import Unit, counted, remove_repeats

WINDOW = 35
GRAM = 8


def substring_dedup(
    docs: DataFrame, window: int = WINDOW, text: str = "text", id: str = "doc_id", with_text: bool = True
) -> DataFrame:
    """`docs` with n_words, n_removed, n_spans and kept_sha256; `text` holds the kept words joined by one
    space where any were removed, else the text unchanged.  Without `with_text` the text column goes."""
    unit = Unit(window, min(GRAM, window), True)
    return remove_repeats(
        docs, unit, lambda unit, kinds, fetch: counted(unit, fetch(kinds)), text, id, with_text, "n_words"
    )


def digest(docs: DataFrame) -> DataFrame:
    done = substring_dedup(docs.select("doc_id", "text"), with_text=False)
    return done.select("doc_id", "n_words", "n_removed", "kept_sha256", F.col("n_spans"))
