"""Principal-component shares of wide numeric vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MOMENTS = "part long, n long, left_out long, mean array<double>, moment array<double>"


def _merged(frames: pd.DataFrame, width: int) -> pd.DataFrame:
    """One row of moments about the mean from several: counts, means and products add up without raw sums, which would cancel."""
    n, left_out, mean, moment = 0, 0, np.zeros(width), np.zeros((width, width))
    for row in frames.itertuples():
        left_out += row.left_out
        if row.n:
            shift = np.array(row.mean) - mean
            moment += np.array(row.moment).reshape(width, width) + np.outer(shift, shift) * (n * row.n / (n + row.n))
            mean += shift * (row.n / (n + row.n))
            n += row.n
    return pd.DataFrame({"part": [0], "n": [n], "left_out": [left_out], "mean": [mean.tolist()], "moment": [moment.ravel().tolist()]})


def explained_variance(df: DataFrame, vector: str, width: int, k: int = 3) -> DataFrame:
    """(component, share, n_rows, n_left_out): shares of variance of the standardised columns of an array column of the given width.

    Each task keeps the moments of its rows about their mean (a square of the width, whatever the rows); they are merged in two levels, and one
    row reaches the driver. Vectors that are null, of another width or with a non-finite value are left out and counted; columns without variance
    have no share; under two rows there is no result.
    """

    def moments(batches):
        state = pd.DataFrame({"part": [0], "n": [0], "left_out": [0], "mean": [[0.0] * width], "moment": [[0.0] * width * width]})
        part = 0
        for batch in batches:
            part = int(batch["part"].iloc[0]) if len(batch) else part
            fitting = [v for v in batch["v"] if v is not None and len(v) == width and all(x is not None for x in v)]
            rows = np.array(fitting, dtype=float).reshape(-1, width)
            rows = rows[np.isfinite(rows).all(axis=1)]
            mean = rows.mean(axis=0) if len(rows) else np.zeros(width)
            centred = rows - mean
            fresh = {"part": [0], "n": [len(rows)], "left_out": [len(batch) - len(rows)], "mean": [mean.tolist()], "moment": [(centred.T @ centred).ravel().tolist()]}
            state = _merged(pd.concat([state, pd.DataFrame(fresh)]), width)
        yield state.assign(part=part)

    def merge(frames: pd.DataFrame) -> pd.DataFrame:
        return _merged(frames, width)

    parts = df.select(F.spark_partition_id().cast("long").alias("part"), F.col(vector).alias("v")).mapInPandas(moments, _MOMENTS)
    level = parts.groupBy(F.pmod("part", F.lit(256)).alias("level")).applyInPandas(merge, _MOMENTS)
    whole = level.groupBy("part").applyInPandas(merge, _MOMENTS).first()  # one row of width squared numbers
    schema = "component int, share double, n_rows long, n_left_out long"
    if whole is None or whole["n"] < 2:
        return df.sparkSession.createDataFrame([], schema)
    covariance = np.array(whole["moment"]).reshape(width, width) / (whole["n"] - 1)
    spread = np.sqrt(np.diag(covariance))
    keep = spread > 0
    values = np.linalg.eigvalsh(covariance[np.ix_(keep, keep)] / np.outer(spread[keep], spread[keep]))[::-1]
    rows = [(i + 1, float(v), whole["n"], whole["left_out"]) for i, v in enumerate(values[:k] / values.sum())]
    return df.sparkSession.createDataFrame(rows, schema)
