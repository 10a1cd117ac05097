"""What the two vector operators share: which vectors take part, and arrays to matrices."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not zero, no null or non-finite component."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(doubles, lambda x: x != 0), F.lit(False))


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in vectors]).reshape(len(vectors), -1)


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products along the last axis, summed in component order, so that equal vectors give equal products."""
    out = a[..., 0] * b[..., 0]
    for k in range(1, a.shape[-1]):
        out = out + a[..., k] * b[..., k]
    return out
