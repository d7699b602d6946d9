"""Cutting a table into key ranges whose bounds are fixed before any shuffle.

Spark's own range shuffle samples its bounds anew at each evaluation; here
the bounds are computed once, so that totals per range and the rows of a
range always belong together, also after a lost executor.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most ranges of a table, so that the list of bounds stays small at any size.
MAX_RANGES = 4096


def key_bounds(df: DataFrame, key: str, ranges: int) -> np.ndarray:
    """Ascending inner bounds that cut ``key`` into about ``ranges`` parts of similar row counts."""
    ranges = max(1, min(MAX_RANGES, ranges))
    if ranges == 1:
        return np.zeros(0, np.int64)
    shares = [i / ranges for i in range(1, ranges)]
    found = df.agg(F.percentile_approx(key, shares, max(10_000, 10 * ranges)).alias("b")).first()["b"]
    return np.unique(np.asarray(found if found is not None else [], np.int64))


def with_range(df: DataFrame, key: str, bounds: np.ndarray, out: str = "range") -> DataFrame:
    """``df`` with the number of the key's range (0 for a null key)."""

    @F.pandas_udf("long")
    def place(keys: pd.Series) -> pd.Series:
        if keys.dtype == object or keys.dtype.kind == "f":
            keys = keys.fillna(np.iinfo(np.int64).min).astype("int64")
        return pd.Series(np.searchsorted(bounds, keys.to_numpy(), side="right").astype("int64"))

    least = F.lit(int(np.iinfo(np.int64).min))
    return df.withColumn(out, place(F.coalesce(F.col(key), least)) if len(bounds) else F.lit(0).cast("long"))
