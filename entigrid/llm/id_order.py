"""Documents dealt out in stretches of the doc_id order, without sorting in one place."""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from entigrid.llm.common import shuffle_partitions

STRETCH_BYTES = 32 << 20
LEAST = -(1 << 63)


def order_key():
    """The doc_id, or what comes before all of them for a null one."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST))


def id_stretches(docs: DataFrame, stretch_bytes: int = STRETCH_BYTES) -> np.ndarray:
    """Bounds of doc_id that cut the documents into stretches of about even size: a stretch ends
    before its bound. Only these bounds come to the driver, one for each ``stretch_bytes`` of text."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(2 * shuffle_partitions(docs.sparkSession), ceil(size / stretch_bytes))
    shares = [i / count for i in range(1, count)]
    found = docs.agg(F.percentile_approx(order_key(), shares, max(10_000, 4 * count))).first()[0]
    return np.unique(np.array(found or [], dtype=np.int64))


def stretch_of(bounds: np.ndarray):
    @F.pandas_udf("int")
    def stretch(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, keys.to_numpy(), side="right").astype(np.int32))

    return stretch
