"""Shortest form of a variant (H4)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def shortest(pos: int, ref: str, alt: str) -> tuple[int, str, str]:
    """Position and alleles without the bases that both end with, then those that both begin with.

    Of an insertion or a deletion one allele is empty; of others each keeps a base.
    """
    a, b, n = ref.upper(), alt.upper(), min(len(ref), len(alt))
    tail = 0
    while tail < n and a[len(a) - 1 - tail] == b[len(b) - 1 - tail]:
        tail += 1
    head = 0
    while head < n - tail and a[head] == b[head]:
        head += 1
    return pos + head, ref[head : len(ref) - tail], alt[head : len(alt) - tail]


def _shortest(pos: pd.Series, ref: pd.Series, alt: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([shortest(*x) for x in zip(pos, ref, alt, strict=True)], columns=["at", "drop", "add"])


def simplest(pos: str, ref: str, alt: str) -> Column:
    """:func:`shortest` of columns, as a struct ``at, drop, add``."""
    return F.pandas_udf(_shortest, "at long, drop string, add string")(pos, ref, alt)
