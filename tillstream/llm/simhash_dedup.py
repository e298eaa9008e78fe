"""SimHash near-duplicates by a segment-popcount embedding and a grid range-join.

* Fingerprint: 64 majority bits of the XXH64 hashes of a text's word shingles.
* Embedding: each 2-bit segment of a fingerprint is mapped to its number of set
  bits (0, 1, 2), written in unary (00, 01, 11), so the Manhattan distance of
  two count vectors is the popcount of an XOR. It never exceeds the Hamming
  distance of the fingerprints.
* Grid range-join: the vector is cut into floor(d/2)+1 parts; two vectors
  within distance d are within 1 in some part. A vector lies in one cell per
  part; vectors of even weight also probe the adjacent cells (which all have
  odd weight), so every such pair meets exactly once per part.
* A pair that meets is kept when its Manhattan distance, then its exact Hamming
  distance, is at most d.

Only distinct fingerprints are joined: copies cost one row. Components of the
links are found by ``components`` and handed to all documents.

Defined results: null and empty texts, and texts without a word, have
fingerprint zero and link like any other; repeated rows all get the same
component; a null doc_id is ignored by the minimum unless its whole component
has none (then component_id is null); extra columns are ignored by ``classes``
and kept by ``keep_one``; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import small_side, staged, utf8
from tillstream.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: Dropped ids are broadcast up to this many (8 bytes each), else the join is shuffled.
BROADCAST_IDS = 1_000_000

_LOW = 0x5555555555555555  # low bit of every 2-bit segment
_LANES = np.uint64(0x0101010101010101)


def _shingle_hashes(text: bytes, k: int) -> list[int]:
    words = text.lower().split()  # on bytes: A-Z only, and exactly the six blanks of a word
    n = len(words)
    if n == 0:
        return []
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n <= k:
        return [digest(joined, SEED)]
    lens = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lens + 1) - 1
    starts = (ends - lens)[:n - k + 1].tolist()
    return [digest(joined[i:j], SEED) for i, j in zip(starts, ends[k - 1:].tolist())]


def _majority(hashes: list[list[int]]) -> np.ndarray:
    """Majority bits of each list: byte lanes are summed over runs of at most 255 hashes."""
    sizes = np.fromiter(map(len, hashes), np.int64, len(hashes))
    flat = np.fromiter((h for hs in hashes for h in hs), np.uint64, int(sizes.sum()))
    out = np.zeros(len(hashes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))[full]
    runs = -(-sizes[full] // 255)
    owner = np.repeat(np.arange(len(full)), runs)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
    at = first[owner] + 255 * step
    doc_at = np.cumsum(runs) - runs
    half = sizes[full]
    bits = np.zeros(len(full), np.uint64)
    for j in range(8):
        lanes = (flat >> np.uint64(j)) & _LANES
        sums = np.add.reduceat(lanes, at).view(np.uint8).reshape(-1, 8).astype(np.int64)
        count = np.add.reduceat(sums, doc_at, axis=0)  # byte lane i holds bit 8*i + j
        for i in range(8):
            bits |= (2 * count[:, i] > half).astype(np.uint64) << np.uint64(8 * i + j)
    out[full] = bits
    return out


def _flat_chunks(texts: list[bytes], k: int, limit: int = 2_000_000):
    """Fingerprints of the texts, with at most about ``limit`` hashes in memory at once."""
    part, n = [], 0
    for t in texts:
        part.append(_shingle_hashes(t, k))
        n += len(part[-1])
        if n >= limit:
            yield _majority(part)
            part, n = [], 0
    if part:
        yield _majority(part)


def simhash64(texts: list[bytes], k: int = SHINGLE_WORDS) -> np.ndarray:
    parts = list(_flat_chunks(texts, k))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long), one row per input row."""
    def run(batches):
        for b in batches:
            fp = simhash64(b.column("_text").to_pylist(), shingle_words)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", utf8("text").alias("_text")).mapInArrow(
        run, f"doc_id {kind}, fp bigint")


def _embedding(fp: str) -> Column:
    """Unary-coded number of set bits of every 2-bit segment."""
    return F.expr(f"(({fp} | shiftrightunsigned({fp}, 1)) & {_LOW}L)"
                  f" | shiftleft(({fp} & shiftrightunsigned({fp}, 1)) & {_LOW}L, 1)")


def _masks(max_bits: int) -> list[int]:
    """The 32 segments cut into floor(max_bits / 2) + 1 parts, as signed 64-bit masks."""
    parts = max_bits // 2 + 1
    cuts = [32 * i // parts for i in range(parts + 1)]
    masks = [(1 << 2 * hi) - (1 << 2 * lo) for lo, hi in zip(cuts, cuts[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct ``fp`` rows -> (a, b) once for every two within ``max_bits`` bits."""
    if not 0 <= max_bits <= 31:
        raise ValueError("max_bits must be between 0 and 31")
    masks = _masks(max_bits)
    cells = distinct.withColumn("u", _embedding("fp"))
    home = cells.select("fp", "u", F.posexplode(F.array(
        *[F.expr(f"u & {m}L") for m in masks])).alias("part", "cell"))
    # adjacent cells: one unary bit flipped, where the code stays a unary code
    flips = {p: [1 << i if i < 63 else -(1 << 63) for i in range(64)
                 if (m % (1 << 64)) >> i & 1] for p, m in enumerate(masks)}
    steps = F.element_at(F.array(*[F.array(*[F.lit(x) for x in flips[p]])
                                   for p in range(len(masks))]), F.col("part") + 1)
    near = F.filter(F.transform(steps, lambda s: s.bitwiseXOR(F.col("cell"))),
                    lambda c: (F.shiftrightunsigned(c, 1).bitwiseAND(F.bitwise_not(c))
                               .bitwiseAND(F.lit(_LOW))) == 0)
    probe = home.select(
        F.col("fp").alias("p_fp"), F.col("u").alias("p_u"), "part",
        F.explode(F.concat(
            F.array(F.struct(F.col("cell"), F.lit(True).alias("own"))),
            F.transform(F.when(F.bit_count("cell") % 2 == 0, near).otherwise(F.array().cast(
                "array<bigint>")), lambda c: F.struct(c.alias("cell"), F.lit(False).alias("own")))
        )).alias("at")).select("p_fp", "p_u", "part", "at.cell", "at.own")
    first = F.lit(True)  # the first part where the two are within 1 reports the pair
    for p, m in enumerate(masks[:-1]):
        first = first & ((F.col("part") <= p) | F.expr(f"bit_count((p_u ^ u) & {m}L) > 1"))
    met = probe.join(home, ["part", "cell"]).filter(
        (~F.col("own") | (F.col("p_fp") < F.col("fp"))) & first
        & F.expr(f"bit_count(p_u ^ u) <= {max_bits}")
        & F.expr(f"bit_count(p_fp ^ fp) <= {max_bits}"))
    return met.select(F.col("p_fp").alias("a"), F.col("fp").alias("b"))


def _classed(prints: DataFrame, max_bits: int) -> DataFrame:
    """Staged (doc_id, fp) -> (fp, root, component_id), one row per distinct fingerprint."""
    groups = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-groups")
    roots = components(links(groups.select("fp"), max_bits))
    rooted = groups.join(roots, groups["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = staged(rooted, "simhash-roots")
    least = rooted.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("component_id"))
    return staged(rooted.join(staged(least, "simhash-least"), F.col("root") == F.col("r"))
                  .select("fp", "root", "component_id"), "simhash-classes")


def classes(docs: DataFrame, shingle_words: int = SHINGLE_WORDS,
            max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp, component_id for every row of ``docs``."""
    prints = staged(fingerprints(docs, shingle_words), "simhash-prints")
    return prints.join(_classed(prints, max_bits), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS,
             max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` without near-duplicates: of each component the row of least doc_id stays.

    A component whose rows all lack a doc_id keeps one of them; of repeated rows
    of the least doc_id one stays.
    """
    prints = staged(fingerprints(docs, shingle_words), "simhash-prints")
    classed = _classed(prints, max_bits)
    rows = staged(prints.join(classed, "fp").select("doc_id", "component_id"), "simhash-rows")
    seen = rows.groupBy("doc_id").agg(F.count("*").alias("n"))
    again = staged(seen.filter("n > 1 or doc_id is null").select("doc_id"), "simhash-again")
    lost = staged(rows.filter("doc_id is not null and doc_id > component_id").select("doc_id")
                  .join(again, "doc_id", "left_anti"), "simhash-lost")
    plain = docs.join(small_side(lost, BROADCAST_IDS), "doc_id", "left_anti")
    if again.isEmpty():
        return plain
    # doc_ids on several rows, or none: decided by each row's own text
    again_c = small_side(again.withColumnRenamed("doc_id", "__sd_id"), BROADCAST_IDS)
    same = docs["doc_id"].eqNullSafe(again_c["__sd_id"])
    once = plain.join(again_c, plain["doc_id"].eqNullSafe(again_c["__sd_id"]), "left_anti")
    repeated = docs.join(again_c, same, "left_semi")
    renamed = classed.select(*[F.col(c).alias(f"__sd_{c}") for c in classed.columns])
    chosen = (repeated.withColumn("__sd_fp", _print_column(shingle_words)(utf8("text")))
              .join(renamed, "__sd_fp")
              .filter(F.col("doc_id").eqNullSafe(F.col("__sd_component_id"))))
    least = chosen.groupBy("__sd_root").agg(F.min("__sd_fp").alias("__sd_fp"))
    one = chosen.join(least, ["__sd_root", "__sd_fp"], "left_semi").dropDuplicates(["__sd_root"])
    return once.unionByName(one.select(*docs.columns))


def _print_column(shingle_words: int):
    @F.arrow_udf("bigint")
    def fp(texts: pa.Array) -> pa.Array:
        return pa.array(simhash64(texts.to_pylist(), shingle_words).view(np.int64))
    return fp


def op1_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the least doc_id of its component."""
    from tillstream.llm.common import load
    return classes(load(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
