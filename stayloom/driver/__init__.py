"""The operators run over the given benchmark tables, each with its SQL check.

The given tables hold no hospital data, so `views` derives tables of the same shape from them.
"""

from stayloom.driver import evaluation, features, linkage, selection, series, storage, texts  # noqa: F401
from stayloom.driver.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
