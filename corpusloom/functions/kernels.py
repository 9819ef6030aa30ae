"""The few scalar functions without a built-in counterpart, as Arrow-batched UDFs."""

from __future__ import annotations

import html
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


@F.pandas_udf(StringType())
def unescape(texts: pd.Series) -> pd.Series:
    """HTML entities to characters."""
    return texts.map(lambda t: t if t is None else html.unescape(t))


@F.pandas_udf(DoubleType())
def similarity(left: pd.Series, right: pd.Series) -> pd.Series:
    """Ratio of matching blocks of two strings (2 * matches / total length); 0 beside a null."""

    def one(a: str | None, b: str | None) -> float:
        if a is None or b is None:
            return 0.0
        if a == b:
            return 1.0
        m = SequenceMatcher(None, a, b)
        # Cheap upper bounds first: most blocked pairs fail them.
        return m.ratio() if m.real_quick_ratio() >= 0.9 and m.quick_ratio() >= 0.9 else 0.0

    return pd.Series([one(a, b) for a, b in zip(left, right)], dtype="float64")
