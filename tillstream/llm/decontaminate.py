"""Benchmark decontamination with SimHash windows, in DataFrame operations only.

1. Words are runs of letters, marks and digits of the lower-cased text; a
   shingle is five words (an item of fewer words is one shingle), hashed.
2. Anchors place the windows. A window of weighted similarity s or more with an
   item holds at least that part of the item's shingles, so it must hold one of
   the item's floor((1 - s) * m) + 1 rarest: only these are anchors, and no
   window can be missed by this. A fixed-size bit set of the anchors is tested
   inside each document's row; only hits leave the row.
3. Each hit places an item-sized window (clipped to the text). Equal windows are
   handled once; each distinct window and each item gets a 64-bit SimHash of its
   shingles, weighted by how often they occur.
4. Multi-index Hamming blocks: 64 bits are cut into radius + 1 blocks; two
   fingerprints within the radius agree in one block at least. Windows meet the
   items of their size that agree in a block; each pair is reported by the
   first such block. A radius of 7 gives blocks of 8 bits, of which a chance pair
   shares one in 3 % of the cases.
5. A pair right at similarity 0.8 differs in 9.7 bits on average, so many lie beyond
   that radius. Therefore the items of its size that have an anchor in a window are its
   candidates too, whatever the bits: by 2 that loses no pair.
6. Candidates are verified by the exact weighted shingle similarity, sum of minima
   over sum of maxima.

Defined results: null and empty texts, and texts without a word, neither leak
nor match; equal items (after normalisation) are reported under their least
item_id, items without a word never; repeated rows are each reported or
dropped; rows with a null doc_id take part; other columns are ignored by
``leaks`` and kept by ``decontaminated``; an empty side gives no leaks.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import load, small_side, staged

SHINGLE_WORDS = 5
MIN_SIMILARITY = 0.8
RADIUS = 7
#: Rows of benchmark-derived tables that may be broadcast; larger ones are shuffled.
BROADCAST_ROWS = 500_000
BROADCAST_IDS = 1_000_000

_BITMAP_LONGS = 1 << 14
_LANES = (1 << 32) + 1  # one sum counts bit j in its low and bit j + 32 in its high half


def _words(text: str) -> Column:
    split = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{M}\p{N}]+")
    return F.filter(split, lambda w: w != "")


def _shingles(words: Column, k: int) -> Column:
    """Hashes of the k-word shingles of an array of words; none if it has fewer words."""
    def one(i):
        return F.xxhash64(*[F.get(words, i + F.lit(j)) for j in range(k)])
    n = F.size(words)
    return F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k), one)).otherwise(
        F.array().cast("array<bigint>"))


def _items(benchmark: DataFrame, k: int) -> DataFrame:
    """Distinct items: item (hash of the words), item_id (least of equal ones), size k of a
    shingle, hashes hs, and their number m.
    """
    items = (benchmark.select("item_id", _words("text").alias("w")).filter("size(w) > 0")
             .groupBy("w").agg(F.min("item_id").alias("item_id"))
             .withColumn("item", F.xxhash64("w")))
    sized = None
    for size in range(1, k + 1):
        of_size = F.size("w") >= k if size == k else F.size("w") == size
        part = items.filter(of_size).select(
            "item", "item_id", F.lit(size).alias("k"), _shingles(F.col("w"), size).alias("hs"))
        sized = part if sized is None else sized.union(part)
    return staged(sized.withColumn("m", F.size("hs")), "benchmark-items")


def _anchors(items: DataFrame, similarity: float) -> DataFrame:
    """The rarest shingles of every item: item, k, h, place in the item, shingles m of it."""
    at = items.select("item", "k", "m", F.posexplode("hs").alias("place", "h"))
    seen = at.groupBy("k", "h").agg(F.count("*").alias("often"))
    ranked = (at.join(seen, ["k", "h"]).groupBy("item", "k", "m")
              .agg(F.sort_array(F.collect_list(F.struct("often", "h", "place"))).alias("s")))
    # o shared shingles of m give a similarity of at most o / m
    needed = F.col("m") - F.ceil(F.col("m") * similarity - 1e-9) + 1
    return (ranked.select("item", "k", "m",
                          F.explode(F.slice("s", F.lit(1), needed.cast("int"))).alias("a"))
            .select("item", "k", "m", "a.h", "a.place"))


def _bit_places(h: Column) -> list[tuple[Column, Column]]:
    """(long, bit) of the two bits that stand for a hash in the bit set."""
    other = F.shiftrightunsigned(h, 20)
    return [((F.shiftrightunsigned(x, 6).bitwiseAND(F.lit(_BITMAP_LONGS - 1))).cast("int"),
             x.bitwiseAND(F.lit(63)).cast("int")) for x in (h, other)]


def _bitmap(anchors: DataFrame) -> Column:
    """The bit set of the anchors' hashes, as an array constant of fixed size."""
    spots = F.explode(F.array(*[F.struct(w.alias("w"), b.alias("b"))
                                for w, b in _bit_places(F.col("h"))]))
    rows = (anchors.select(spots.alias("s")).groupBy("s.w")
            .agg(F.bit_or(F.expr("shiftleft(1L, s.b)")).alias("bits")).collect())
    longs = [0] * _BITMAP_LONGS
    for r in rows:
        longs[r["w"]] = r["bits"]
    return F.from_json(F.lit(json.dumps(longs)), "array<bigint>")


def _windows(docs: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """Item-sized windows at the anchors: doc_id, th, k, m, start, and the hashes hs inside."""
    bits = _bitmap(anchors)

    def known(h: Column) -> Column:
        return reduce(lambda a, b: a & b, [
            F.getbit(F.get(bits, w), b) == 1 for w, b in _bit_places(h)])
    # explode of a one-element array keeps the costly arrays from being computed twice
    hashed = docs.select("doc_id", F.xxhash64("text").alias("th"),
                         F.explode(F.array(_shingles(F.col("w"), k))).alias("all_hs"))
    n = F.size("all_hs")
    hits = F.when(n > 0, F.filter(F.sequence(F.lit(0), n - 1),
                                  lambda i: known(F.get(F.col("all_hs"), i))))
    at = hashed.select("doc_id", "th", "all_hs", F.explode(hits).alias("pos")).withColumn(
        "h", F.get("all_hs", "pos"))
    placed = at.join(small_side(anchors, BROADCAST_ROWS), "h")
    start = F.col("pos") - F.col("place")
    begin = F.greatest(start, F.lit(0))
    stop = F.least(start + F.col("m"), F.size("all_hs"))
    return placed.select("doc_id", "th", F.lit(k).alias("k"), "m", start.alias("start"),
                         F.slice("all_hs", begin + 1, stop - begin).alias("hs")).distinct()


def _weighted(rows: DataFrame, key: list[str]) -> DataFrame:
    """(key, h, c): how often each shingle occurs."""
    return rows.select(*key, F.explode("hs").alias("h")).groupBy(*key, "h").agg(
        F.count("*").alias("c"))


def simhash(weighted: DataFrame, key: list[str]) -> DataFrame:
    """(key, h, c) -> key, fp, total: the bits set in more than half of the weight."""
    sums = [F.sum(F.shiftrightunsigned("h", j).bitwiseAND(F.lit(_LANES)) * F.col("c"))
            .alias(f"s{j}") for j in range(32)]
    counted = weighted.groupBy(*key).agg(F.sum("c").alias("total"), *sums)
    def bit(count: Column, i: int) -> Column:
        return F.when(2 * count > F.col("total"), F.lit(1 << i if i < 63 else -(1 << 63))
                      ).otherwise(F.lit(0)).cast("bigint")
    bits = [bit(F.col(f"s{j}").bitwiseAND(F.lit((1 << 32) - 1)), j) for j in range(32)]
    bits += [bit(F.shiftrightunsigned(f"s{j}", 32), j + 32) for j in range(32)]
    return counted.select(*key, "total", reduce(lambda a, b: a.bitwiseOR(b), bits).alias("fp"))


def _block_masks(radius: int) -> list[int]:
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    masks = [(1 << hi) - (1 << lo) for lo, hi in zip(cuts, cuts[1:])]
    return [x - (1 << 64) if x >> 63 else x for x in masks]


def within_radius(left: DataFrame, right: DataFrame, radius: int, same: list[str]) -> DataFrame:
    """Pairs of rows of ``left`` (fp) and ``right`` (r_fp), equal in ``same``, within the radius.

    Guaranteed complete: within ``radius`` bits, one of radius + 1 blocks agrees.
    """
    masks = _block_masks(radius)
    blocks = lambda fp: F.posexplode(F.array(
        *[F.col(fp).bitwiseAND(F.lit(m)) for m in masks])).alias("block", "value")
    x = F.col("fp").bitwiseXOR(F.col("r_fp"))
    agree = F.array(*[x.bitwiseAND(F.lit(m)) == 0 for m in masks])
    sides = left.select("*", blocks("fp")).join(
        small_side(right.select("*", blocks("r_fp")), BROADCAST_ROWS), [*same, "block", "value"])
    return (sides.filter((F.bit_count(x) <= radius)
                         & (F.array_position(agree, True) == F.col("block") + 1))
            .withColumn("bits", F.bit_count(x)).drop("block", "value"))


def leaks(docs: DataFrame, benchmark: DataFrame, shingle_words: int = SHINGLE_WORDS,
          similarity: float = MIN_SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """One row for each document row and item it holds: doc_id, th, item_id, start, n_words,
    bits, similarity (of the best window; th is the hash of the text).
    """
    items = _items(benchmark, shingle_words)
    anchored = staged(_anchors(items, similarity), "benchmark-anchors")
    anchors = anchored.drop("item").distinct()
    sizes = sorted(r["k"] for r in items.select("k").distinct().collect())  # at most five
    texts = docs.select("doc_id", "text", F.explode(F.array(_words("text"))).alias("w"))
    placed = [_windows(texts, anchors.filter(F.col("k") == k).drop("k"), k) for k in sizes]
    if not placed:  # no item has a word
        placed = [_windows(texts, anchors.drop("k"), shingle_words)]
    windows = staged(reduce(DataFrame.union, placed), "benchmark-windows")

    distinct = windows.select("k", "m", "hs", F.xxhash64("hs").alias("window")).distinct()
    in_windows = staged(_weighted(distinct, ["k", "m", "window"]), "window-shingles")
    in_items = staged(_weighted(items, ["k", "m", "item"]), "item-shingles")
    prints = simhash(in_windows, ["k", "m", "window"])
    item_prints = simhash(in_items, ["k", "m", "item"]).select(
        "k", "m", "item", F.col("fp").alias("r_fp"), F.col("total").alias("r_total"))
    prints, item_prints = staged(prints, "window-prints"), staged(item_prints, "item-prints")
    pair = ["k", "m", "window", "total", "item", "r_total", "bits"]
    rarest = anchored.select("item", "k", "m", "h").distinct()
    anchoring = (in_windows.select("k", "m", "window", "h")
                 .join(small_side(rarest, BROADCAST_ROWS), ["k", "m", "h"])
                 .select("k", "m", "window", "item").distinct()
                 .join(prints, ["k", "m", "window"]).join(item_prints, ["k", "m", "item"])
                 .withColumn("bits", F.bit_count(F.col("fp").bitwiseXOR(F.col("r_fp")))))
    near = staged(within_radius(prints, item_prints, radius, ["k", "m"]).select(*pair).union(
        anchoring.select(*pair)).distinct(), "window-pairs")

    shared = (near.join(in_windows, ["k", "m", "window"])
              .join(small_side(in_items.select("item", "k", "h", F.col("c").alias("r_c")),
                               BROADCAST_ROWS), ["item", "k", "h"])
              .groupBy("k", "m", "window", "item", "bits")
              .agg(F.sum(F.least("c", "r_c")).alias("both"),
                   F.first(F.col("total") + F.col("r_total")).alias("sizes")))
    ratio = F.col("both") / (F.col("sizes") - F.col("both"))
    verified = staged(shared.withColumn("similarity", ratio).filter(
        F.col("similarity") >= similarity).drop("both", "sizes"), "verified-windows")
    best = F.max_by(F.struct("start", (F.col("m") + F.col("k") - 1).alias("n_words"), "bits",
                             "similarity"), F.struct("similarity", -F.col("start")))
    return (windows.withColumn("window", F.xxhash64("hs")).drop("hs")
            .join(verified, ["k", "m", "window"])
            .groupBy("doc_id", "th", "item").agg(best.alias("b"))
            .join(small_side(items.select("item", "item_id"), BROADCAST_ROWS), "item")
            .select("doc_id", "th", "item_id", "b.*"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with the same columns."""
    found = staged(leaks(docs, benchmark, **settings).select(
        F.col("doc_id").alias("__dc_id"), F.col("th").alias("__dc_th")).distinct(), "leaking")
    found = small_side(found, BROADCAST_IDS)
    return docs.join(found, docs["doc_id"].eqNullSafe(found["__dc_id"])
                     & (F.xxhash64(docs["text"]) == found["__dc_th"]), "left_anti")


def op5_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the place and similarity of the passage."""
    return leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")).drop("th")
