"""Language identification by nearest clustered centroid.

A text becomes a vector of hashed character 1- to 3-grams (lower-cased
letters, one mark between words) weighted by 1 + log tf and by idf, of unit
length. Document frequencies are counted over every training row. Each
language gets a few centroids by spherical k-means over a bounded sample of
its training rows; a text takes the language of the centroid of highest
cosine. A text is rejected when that cosine lies below a floor learned for
its length: clean text of the length never came that far from its centroids.

Defined results: null and empty texts and texts without a letter are ``und``
with score 0 and rejected, as is everything when no row can be learned from;
repeated rows get equal results; ties go to the language of least code point;
rows with null lang are scored but not learned from; a null doc_id counts as
empty text in the fold; long texts are taken whole, in pieces; an empty table
gives an empty table; other columns are ignored, or kept by ``accepted``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import crc_remainder, load

DIMS = 4096
ORDERS = 3
CENTROIDS = 4
#: k-means sees about this many rows of a language, chosen by hash.
SAMPLE_PER_LANG = 1500
#: A text is rejected below this part of the least cosine seen at its length.
FLOOR_MARGIN = 0.4
LENGTH_BINS = 24  # by powers of two of the number of letters
UNDETERMINED = "und"

_CHUNK_CHARS = 1_000_000
_CHUNK_DOCS = 256
_is_letter: np.ndarray | None = None


def _letters(codes: np.ndarray) -> np.ndarray:
    global _is_letter
    if _is_letter is None:
        _is_letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _is_letter[codes]


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= _CHUNK_CHARS or len(part) >= _CHUNK_DOCS:
            yield part
            part, size = [], 0
    if part:
        yield part


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(texts x DIMS) counts of hashed n-grams, and the number of letters of each text."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("\n".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass"),
                          np.uint32)
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    owner = np.repeat(np.arange(len(lowered), dtype=np.int64), sizes + 1)  # a text and its mark
    codes = codes[1:]
    letter = _letters(codes)
    n_letters = np.bincount(owner[letter], minlength=len(texts))
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first other character after a letter stands for the gap
    c = np.where(letter, codes, np.uint32(32))[keep].astype(np.uint64)
    owner, letter = owner[keep], letter[keep]
    counts = np.zeros(len(texts) * DIMS, np.float32)
    gram = np.zeros(len(c), np.uint64)
    for order in range(ORDERS):
        if len(c) <= order:
            break
        m = len(c) - order
        gram = gram[:m] * np.uint64(1 << 21) + c[order:]
        same = owner[:m] == owner[order:]
        if order == 0:
            same = letter
        mixed = (gram + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
        slot = (mixed >> np.uint64(52)).astype(np.int64)
        counts += np.bincount((owner[:m] * DIMS + slot)[same], minlength=len(counts)).astype(
            np.float32)
    return counts.reshape(len(texts), DIMS), n_letters


def vectors(texts: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts, n = gram_counts(texts)
    with np.errstate(divide="ignore"):
        x = np.where(counts > 0, 1 + np.log(counts), 0).astype(np.float32) * idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1), n


def _bins(n_letters: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(n_letters, 1)).astype(int), LENGTH_BINS - 1)


def _document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    def run(batches):
        df, n = np.zeros(DIMS, np.int64), 0
        for b in batches:
            for part in _chunks(b.column("text").to_pylist()):
                counts, _ = gram_counts(part)
                df += (counts > 0).sum(axis=0)
                n += len(part)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(DIMS + 1)), pa.array(np.append(df, n))], ["slot", "n"])
    rows = (train.select(F.coalesce("text", F.lit("")).alias("text"))
            .mapInArrow(run, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
            .collect())  # DIMS + 1 rows
    counts = np.zeros(DIMS + 1, np.int64)
    for r in rows:
        counts[r["slot"]] = r["n"]
    return counts[:DIMS], int(counts[DIMS])


def _clustered(pdf: pd.DataFrame, idf: np.ndarray, k: int) -> pd.DataFrame:
    """Spherical k-means of one language's sample, and its least cosine by length."""
    pdf = pdf.sort_values("order")
    parts = [vectors(p, idf) for p in _chunks(pdf["text"].tolist())]
    x, n = (np.concatenate(a) for a in zip(*parts))
    x, n = x[n > 0], n[n > 0]
    empty = pd.DataFrame({"lang": [], "centroids": [], "floors": []})
    if not len(x):
        return empty
    k = max(1, min(k, len(x) // 20))
    centroids = x[:1]
    while len(centroids) < k:  # farthest point first
        centroids = np.vstack([centroids, x[np.argmin((x @ centroids.T).max(axis=1))]])
    for _ in range(12):
        near = np.argmax(x @ centroids.T, axis=1)
        sums = np.stack([x[near == i].sum(axis=0) if (near == i).any() else centroids[i]
                         for i in range(k)])
        centroids = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    best = (x @ centroids.T).max(axis=1)
    least = np.full(LENGTH_BINS, np.inf)
    np.minimum.at(least, _bins(n), best)
    floors = np.minimum.accumulate(least[::-1])[::-1]  # never above that of a longer length
    floors[:_bins(n).min()] = 0  # shorter than any text seen: nothing is known
    floors[~np.isfinite(floors)] = floors[np.isfinite(floors)].max()
    return pd.DataFrame({"lang": [pdf["lang"].iloc[0]],
                         "centroids": [centroids.astype(np.float64).ravel().tolist()],
                         "floors": [(FLOOR_MARGIN * floors).tolist()]})


def learn(train: DataFrame, centroids: int = CENTROIDS,
          sample_per_lang: int = SAMPLE_PER_LANG) -> dict:
    """Model from rows (doc_id, text, lang) of ``train``; a dict of numpy arrays.

    Every row counts for the document frequencies; about ``sample_per_lang``
    rows of each language, chosen by a hash, go into its k-means.
    """
    train = train.select("doc_id", "text", "lang").filter("lang is not null")
    counts = train.groupBy("lang").count()
    df, n = _document_frequencies(train)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    sample = (train.withColumn("order", draw)
              .join(F.broadcast(counts), "lang")  # one row for each language
              .filter(F.col("order") * F.col("count") < sample_per_lang)
              .select("lang", F.coalesce("text", F.lit("")).alias("text"), "order"))
    rows = sorted(sample.groupBy("lang").applyInPandas(
        lambda pdf: _clustered(pdf, idf, centroids),
        "lang string, centroids array<double>, floors array<double>").collect(),
        key=lambda r: r["lang"])
    owner = [i for i, r in enumerate(rows) for _ in range(len(r["centroids"]) // DIMS)]
    return {"idf": idf, "langs": [r["lang"] for r in rows], "owner": np.array(owner, np.int64),
            "centroids": np.array([c for r in rows for c in r["centroids"]],
                                  np.float32).reshape(-1, DIMS),
            "floors": np.array([r["floors"] for r in rows]).reshape(-1, LENGTH_BINS)}


def identify(model: dict, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, cosine and rejection of each text."""
    lang, score, rejected = [], [], []
    for part in _chunks(texts):
        x, n = vectors(part, model["idf"])
        if not len(model["langs"]):
            lang += [UNDETERMINED] * len(part)
            score.append(np.zeros(len(part)))
            rejected.append(np.ones(len(part), bool))
            continue
        cosine = x @ model["centroids"].T
        best = np.argmax(cosine, axis=1)
        own = model["owner"][best]
        s = np.clip(cosine[np.arange(len(part)), best].astype(np.float64), 0, 1)
        s[n == 0] = 0
        lang += [model["langs"][i] if k else UNDETERMINED for i, k in zip(own, n)]
        score.append(s)
        rejected.append((n == 0) | (s < model["floors"][own, _bins(n)]))
    if not lang:
        return [], np.zeros(0), np.zeros(0, bool)
    return lang, np.concatenate(score), np.concatenate(rejected)


def identified(model: dict, text: Column) -> Column:
    """Struct (lang_pred, score, rejected) of a text column."""
    @F.arrow_udf("lang_pred string, score double, rejected boolean")
    def run(texts: pa.Array) -> pa.Array:
        lang, score, rejected = identify(model, texts.to_pylist())
        return pa.StructArray.from_arrays(
            [pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)],
            ["lang_pred", "score", "rejected"])
    return run(F.coalesce(text, F.lit("")))


def accepted(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with the same columns."""
    return docs.filter(~identified(model, F.col("text"))["rejected"])


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(crc_remainder("doc_id", 4) != 2)


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = learn(training_rows(docs))
    return docs.select(
        "doc_id", (crc_remainder("doc_id", 4) == 2).alias("held_out"),
        identified(model, F.col("text")).alias("r")).select(
        "doc_id", "held_out", "r.lang_pred", "r.score", "r.rejected")
