"""Comparing tables without regard to row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayloom.functions.values import quoted
from stayloom.operators.features import md5_number


def row_number(df: DataFrame) -> Column:
    """A row's 60-bit number: md5 of its columns as texts with their lengths, in name order.

    Other engines can compute the same, so tables can be compared across engines.
    """
    texts = [quoted(c).cast("string") for c in sorted(df.columns)]
    sized = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return md5_number(F.concat(*sized), digits=15)


def fingerprint(df: DataFrame) -> DataFrame:
    """(n_rows, hash_sum): equal for equal multisets of rows, whatever their order."""
    return df.select(row_number(df).cast("decimal(20,0)").alias("_h")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("_h").cast("string").alias("hash_sum")
    )


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """(only_a, only_b): rows of one table without a partner in the other, repeats counted."""
    columns = sorted(a.columns)
    left, right = (df.select(*[quoted(c) for c in columns]) for df in (a, b))
    only_a = left.exceptAll(right).agg(F.count(F.lit(1)).alias("only_a"))
    only_b = right.exceptAll(left).agg(F.count(F.lit(1)).alias("only_b"))
    both = only_a.unionByName(only_b, allowMissingColumns=True)
    return both.agg(F.max("only_a").alias("only_a"), F.max("only_b").alias("only_b"))


def compare(a: DataFrame, b: DataFrame) -> tuple[bool, str]:
    """Whether two tables hold the same rows, and why not."""
    if set(a.columns) != set(b.columns):
        only_a, only_b = sorted(set(a.columns) - set(b.columns)), sorted(set(b.columns) - set(a.columns))
        return False, f"columns differ: only in first {only_a}, only in second {only_b}"
    rows = [fingerprint(df).first() for df in (a, b)]
    if rows[0]["n_rows"] != rows[1]["n_rows"]:
        return False, f"row counts differ: {rows[0]['n_rows']} and {rows[1]['n_rows']}"
    if rows[0]["hash_sum"] != rows[1]["hash_sum"]:
        return False, "same shape, different content"
    return True, "identical"
