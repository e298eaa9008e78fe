"""Isotonic calibration from a bounded histogram of raw scores."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def histogram(rows: DataFrame, raw: Column, label: str, low: float, high: float,
              bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Positives and rows of each of ``bins`` equal ranges of ``raw``, clipped to [low, high]."""
    place = F.floor((F.least(F.greatest(raw, F.lit(low)), F.lit(high)) - low)
                    / (high - low) * (bins - 1) + 0.5).cast("int")
    counted = rows.groupBy(place.alias("bin")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.count("*").alias("n")).collect()
    pos, n = np.zeros(bins), np.zeros(bins)
    for r in counted:
        pos[r["bin"]], n[r["bin"]] = r["pos"], r["n"]
    return pos, n


def isotonic(pos: np.ndarray, n: np.ndarray, prior: float) -> np.ndarray:
    """Rising probability for each bin: pooled adjacent violators.

    Each pool counts ``prior`` more rows at the overall rate, so that no pool is
    certain; bins without rows lie between their neighbours.
    """
    total = n.sum()
    if not total:
        return np.full(len(n), 0.5)
    rate = pos.sum() / total
    pools: list[list[float]] = []  # positives, rows, first bin, last bin
    for i in np.flatnonzero(n):
        pools.append([pos[i], n[i], i, i])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            p = pools.pop()
            pools[-1] = [pools[-1][0] + p[0], pools[-1][1] + p[1], pools[-1][2], p[3]]
    value = [(p + prior * rate) / (k + prior) for p, k, _, _ in pools]
    value = np.maximum.accumulate(value)
    at = [x for p in pools for x in (p[2], p[3])]
    return np.interp(np.arange(len(n)), at, np.repeat(value, 2))


def calibrated(raw: np.ndarray, low: float, high: float, curve: np.ndarray) -> np.ndarray:
    place = (np.clip(raw, low, high) - low) / (high - low) * (len(curve) - 1)
    return np.clip(np.interp(place, np.arange(len(curve)), curve), 0.0, 1.0)
