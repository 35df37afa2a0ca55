"""Joins that stay balanced when one key holds a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot beyond ``total / HOT_KEYS`` rows, so there are never more hot keys than this.
HOT_KEYS = 500
#: Below this many rows of one key a single task joins them easily.
HOT_ROWS = 200_000


def attach(big: DataFrame, small: DataFrame, key: str, how: str = "inner", total: int | None = None) -> DataFrame:
    """Join ``big`` with ``small``, which has at most one row per key.

    ``total`` is the number of rows of ``big`` where it is known. A key with more
    than ``max(HOT_ROWS, total / HOT_KEYS)`` rows of ``big`` is hot; by arithmetic there
    are at most ``HOT_KEYS`` of them. Rows of hot keys are joined where they lie, against
    the broadcast hot part of ``small`` (at most ``HOT_KEYS`` rows, since its keys are
    unique); all other rows take a shuffle join. No row is dropped either way.
    ``how`` is ``inner`` or ``left``; rows whose key is null match nothing.
    ``big`` is read more than once, so it should be a table or a written result.
    """
    total = big.count() if total is None else total
    limit = max(HOT_ROWS, total // HOT_KEYS)
    hot = []
    if total > limit:
        counts = big.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
        hot = counts.filter(F.col("_rows") > limit).select(key).collect()  # at most HOT_KEYS rows
    if not hot:
        return big.join(small, key, how)
    keys = [row[0] for row in hot]
    is_hot = F.coalesce(F.col(key).isin(keys), F.lit(False))
    near = big.filter(is_hot).join(F.broadcast(small.filter(F.col(key).isin(keys))), key, how)
    far = big.filter(~is_hot).join(small.filter(~F.col(key).isin(keys)), key, how)
    return near.unionByName(far)
