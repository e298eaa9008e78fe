"""Quality classifier: random Fourier features of document statistics, ridge, isotonic.

Each text is reduced to a few statistics (lengths, shares of character classes,
repetition). Standardised, they go through random Fourier features, whose
products approximate a Gaussian kernel. Every partition sums its part of the
normal equations of ridge regression on the labels; the sums meet as one row
for each row of the matrix, and only that matrix (of fixed size) reaches the
driver. Two halves of the training rows are fitted apart, and each is scored by
the other's weights, for an isotonic calibration that has not seen its rows.

Defined results: null and empty texts have all-zero statistics and are scored
like others; without training rows every score is 0.5; repeated rows get equal
scores; null labels are not learned from; a doc_id labelled or found more than
once counts each time; equal raw scores share one calibrated score; long texts are
taken whole; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.calibration import calibrated, histogram, isotonic
from tillstream.llm.common import crc_remainder, load, small_side, staged, utf8

FEATURES = 128  # random Fourier features
GAMMA = 0.06  # of the Gaussian kernel exp(-gamma |x - y|^2) of standardised statistics
RIDGE = 1e-3  # per training row
SEED = 20240229
THRESHOLD = 0.5
BROADCAST_LABELS = 1_000_000
LOW, HIGH, BINS = -0.5, 1.5, 1001

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "sentence_marks", "other_marks",
    "non_ascii", "lines", "distinct_words", "distinct_lines", "same_as_last", "top_word",
    "marked_words", "sentences",
)

_SENTENCE = np.frombuffer(b".,;:'\"?-()", np.uint8)
_OTHER = np.array([c for c in range(33, 127)
                   if not chr(c).isalnum() and chr(c) not in ".,;:'\"?-()"])
_MARKS = bytes(_OTHER.astype(np.uint8))


def statistics_of(text: bytes) -> list[float]:
    n = len(text)
    words = text.split()
    k = len(words)
    if not k:
        return [0.0] * len(STATISTICS)
    c = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    letters = c[65:91].sum() + c[97:123].sum() + c[128:].sum()
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in text.split(b"\n") if x.strip()]
    solid = n - c[32] - c[9:14].sum()
    marked = sum(w[-1] in _MARKS for w in words)
    return [
        float(np.log1p(n)), float(np.log1p(k)), float(solid / k), float(c[65:91].sum() / max(letters, 1)),
        float(c[48:58].sum() / n), float(c[_SENTENCE].sum() / n), float(c[_OTHER].sum() / n),
        float(c[128:].sum() / n), len(lines) / k, len(counts) / k,
        len(set(lines)) / max(len(lines), 1), sum(map(eq, words, words[1:])) / k,
        max(counts.values()) / k, marked / k, float((c[46] + c[33] + c[63]) / k),
    ]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, x (array of the statistics) for every row."""
    def run(batches):
        for b in batches:
            x = [statistics_of(t) for t in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])
    return docs.select("doc_id", utf8("text").alias("_text")).mapInArrow(
        run, f"doc_id {dict(docs.dtypes)['doc_id']}, x array<double>")


def _fourier(x: np.ndarray, model: dict) -> np.ndarray:
    """Random Fourier features of rows of statistics, and a constant."""
    rng = np.random.default_rng(SEED)
    w = rng.normal(0.0, np.sqrt(2 * GAMMA), (x.shape[1], FEATURES))
    shift = rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.sqrt(2 / FEATURES) * np.cos(((x - model["mean"]) / model["spread"]) @ w + shift)
    return np.hstack([z, np.ones((len(x), 1))])


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, len(STATISTICS)) if len(flat) else np.zeros((0, len(STATISTICS)))


def _normal_equations(rows: DataFrame, model: dict) -> dict[int, tuple[np.ndarray, np.ndarray, int]]:
    """For each half: Z'Z, Z'y and the number of rows, summed by partition."""
    width = FEATURES + 3  # a row of Z'Z, one of Z'y, and the row count

    def run(batches):
        sums = np.zeros((2, FEATURES + 1, width))
        for b in batches:
            z = _fourier(_matrix(b.column("x")), model)
            y = b.column("quality").to_numpy(zero_copy_only=False).astype(float)
            half = b.column("half").to_numpy(zero_copy_only=False)
            for h in (0, 1):
                zh, yh = z[half == h], y[half == h]
                sums[h] += np.hstack([zh.T @ zh, (zh.T @ yh)[:, None],
                                      np.full((FEATURES + 1, 1), float(len(zh)))])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([0, 1], FEATURES + 1)),
             pa.array(np.tile(np.arange(FEATURES + 1), 2)),
             pa.array(list(sums.reshape(-1, width)), pa.list_(pa.float64()))],
            ["half", "i", "v"])
    summed = rows.select("x", "quality", "half").mapInArrow(
        run, "half bigint, i bigint, v array<double>").groupBy("half", "i").agg(
        F.array(*[F.sum(F.get("v", F.lit(j))) for j in range(width)]).alias("v")).collect()
    out = {h: (np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1), 0) for h in (0, 1)}
    for r in summed:
        zz, zy, _ = out[r["half"]]
        zz[r["i"]], zy[r["i"]] = r["v"][:-2], r["v"][-2]
        out[r["half"]] = (zz, zy, int(r["v"][-1]))
    return out


def _ridge(zz: np.ndarray, zy: np.ndarray, n: int) -> np.ndarray:
    penalty = np.full(len(zy), RIDGE * n + 1e-9)
    penalty[-1] = 1e-9  # not of the constant
    return np.linalg.solve(zz + np.diag(penalty), zy) if n else np.zeros(len(zy))


def learn(stats: DataFrame, labels: DataFrame) -> dict:
    """Model from ``stats`` (doc_id, x) of the training rows and their labels."""
    known = labels.filter("quality in (0, 1)").select(
        F.col("doc_id").alias("l_id"), F.col("quality").cast("int").alias("quality"))
    known = small_side(known, BROADCAST_LABELS)
    half = F.pmod(F.floor(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast(
        "binary")) / 3), F.lit(2))
    rows = staged(stats.join(known, F.col("doc_id") == F.col("l_id")).select(
        "x", "quality", half.alias("half")), "quality-training")
    dims = range(len(STATISTICS))
    row = rows.agg(*[F.avg(F.get("x", F.lit(j))).alias(f"m{j}") for j in dims],
                   *[F.stddev_pop(F.get("x", F.lit(j))).alias(f"s{j}") for j in dims]).first()
    model = {"mean": np.array([row[f"m{j}"] or 0.0 for j in dims]),
             "spread": np.array([row[f"s{j}"] or 1.0 for j in dims])}
    parts = _normal_equations(rows, model)
    apart = {h: _ridge(*parts[h]) for h in (0, 1)}
    model["weights"] = _ridge(*(parts[0][k] + parts[1][k] for k in range(3)))
    raw = F.when(F.col("half") == 0, _raw(model, apart[1])(F.col("x"))).otherwise(
        _raw(model, apart[0])(F.col("x")))
    pos, n = histogram(rows, raw, "quality", LOW, HIGH, BINS)
    model["curve"] = isotonic(pos, n, 1.0)
    return model


def _raw(model: dict, weights: np.ndarray):
    @F.arrow_udf("double")
    def raw(x: pa.Array) -> pa.Array:
        return pa.array(_fourier(_matrix(x), model) @ weights, pa.float64())
    return raw


def quality(model: dict, x: Column) -> Column:
    """Score of a column of statistics."""
    @F.arrow_udf("double")
    def score(x: pa.Array) -> pa.Array:
        raw = _fourier(_matrix(x), model) @ model["weights"]
        return pa.array(calibrated(raw, LOW, HIGH, model["curve"]), pa.float64())
    return score(x)


def op8_quality(spark, sf_dir: str) -> DataFrame:
    stats = staged(statistics(load(spark, sf_dir, "documents")), "statistics")
    held_out = crc_remainder("doc_id", 3) == 1
    model = learn(stats.filter(~held_out), load(spark, sf_dir, "labels"))
    return stats.select("doc_id", held_out.alias("held_out"),
                        quality(model, F.col("x")).alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
