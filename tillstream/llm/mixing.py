"""Mixing sources to target weights.

Every source gets a target in words: its weight's share of all words, at most
``max_epochs`` times its own size, the excess reshared by weight (water
filling, solved in closed form over one row for each source). Documents get
hash-random keys; a source is read in key order, over and over, and cut at its
exact budget. The cut is found by distributed prefix sums over key ranges:
words are summed by key prefix (partial sums in every task), the range in which
the budget ends is kept, and only its rows go to the next, finer level. A level
has at most 256 rows for each source, so a hot source never meets in one task.

Rows of one doc_id and text are identical for the mix and share one key; if the
cut falls on such copies they share the rest evenly (rounded down). So the
result does not depend on partitioning, and reruns agree.

Defined results: a null or empty text has size 0 and nothing taken of it; a
null doc_id counts as empty text in the key; null is a source of its own,
ordered last; a source without words has target 0; extra columns are ignored by
``mix``, and kept by ``mixed`` unless it returns one of that name; an empty
table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.common import WORD, load, small_side, staged

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
#: Key digits added by a level, and rows of a source up to which a range is ordered at once.
LEVEL_DIGITS = 2
RANGE_ROWS = 4096
BROADCAST_SOURCES = 100_000


def word_count(text: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def random_key(doc_id: str, text: str, seed: str) -> Column:
    """128 random bits as hexadecimal digits, from the row's doc_id and text."""
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")),
                             F.md5(F.coalesce(F.col(text), F.lit("")))))


def _targets(sizes: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """(source, source_size) -> source, source_size, target; one row for each source."""
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    slot = (F.row_number().over(ordered) - 1) % len(weights)
    weighed = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), slot + 1)
                               .cast("long")).withColumn(
        "cap", max_epochs * F.col("source_size"))
    # sources by rising cap for their weight: those before the water level are capped
    whole = Window.partitionBy()
    rising = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    levels = weighed.select(
        "*", F.sum("source_size").over(whole).alias("all_words"), F.sum("w").over(whole).alias("all_w"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"),
        F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w_before"))
    level = (F.col("all_words") - F.col("cap_before")).cast("double") / (
        F.col("all_w") - F.col("w_before")).cast("double")
    capped = levels.withColumn("level", level).withColumn(
        "capped", F.col("w") * F.col("level") >= F.col("cap"))
    free = F.min(F.when(~F.col("capped"), F.struct("w_before", "level"))).over(whole)["level"]
    return capped.select(
        "source", "source_size", F.when(F.col("capped"), F.col("cap").cast("double"))
        .otherwise(F.col("w") * free).alias("target"))


def _cuts(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """source, epochs, cut_key, share: rows of a lesser key are taken once more, those of
    cut_key ``share`` words more.
    """
    budget = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0)
    plan = targets.withColumn("budget", budget).withColumn("epochs", epochs.cast("long")).select(
        F.col("source").alias("c_source"), "source_size", "target", "epochs",
        (F.col("budget") - F.col("epochs") * F.col("source_size")).alias("rest"))
    plan = staged(plan, "mix-plan")
    at = plan.filter("rest > 0").select("c_source", "rest", F.lit("").alias("prefix"))
    digits = 0
    while True:
        near = small_side(at, BROADCAST_SOURCES)
        rows = rows.join(near, rows["source"].eqNullSafe(near["c_source"])
                         & (F.substring("key", 1, digits) == near["prefix"])).select(
            "source", "key", "size", "rest")
        if digits:
            rows = staged(rows, "mix-range")
        many = digits == 0 or (rows.groupBy("source").count().agg(F.max("count")).first()[0]
                               or 0) > RANGE_ROWS
        digits = digits + LEVEL_DIGITS if many and digits < 32 - LEVEL_DIGITS else 32
        ranges = rows.groupBy("source", "rest", F.substring("key", 1, digits).alias("prefix")).agg(
            F.sum("size").alias("words"), F.count("*").alias("n"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("prefix").rowsBetween(
            Window.unboundedPreceding, 0))
        cross = (ranges.withColumn("upto", upto)
                 .filter("upto - words < rest and rest <= upto")
                 .select(F.col("source").alias("c_source"),
                         (F.col("rest") - (F.col("upto") - F.col("words"))).alias("rest"),
                         "prefix", "n"))
        at = staged(cross, "mix-cross")
        if digits == 32:
            break
        rows = rows.drop("rest")
        at = at.drop("n")
    cut = at.select(F.col("c_source").alias("k_source"), F.col("prefix").alias("cut_key"),
                    F.expr("rest div n").alias("share"))
    return staged(plan.join(cut, plan["c_source"].eqNullSafe(cut["k_source"]), "left")
                  .drop("k_source", "rest"), "mix-cuts")


def _taken(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """``rows`` (source, size, key) with source_size, target and taken."""
    near = small_side(cuts, BROADCAST_SOURCES)
    more = (F.when(F.col("key") < F.col("cut_key"), F.col("size"))
            .when(F.col("key") == F.col("cut_key"), F.col("share")).otherwise(0))
    return rows.join(near, rows["source"].eqNullSafe(near["c_source"])).withColumn(
        "taken", (F.col("epochs") * F.col("size") + more).cast("long")).drop(
        "c_source", "cut_key", "share", "epochs", "key")


def _sized(docs: DataFrame, seed: str, *columns: Column | str) -> DataFrame:
    return docs.select(*columns, "source", word_count("text").alias("size"),
                       random_key("doc_id", "text", seed).alias("key"))


def _planned(rows: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    return _cuts(rows.select("source", "key", "size"), _targets(sizes, weights, max_epochs))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
        seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every row of ``docs``."""
    rows = staged(_sized(docs, seed, "doc_id"), "mix-rows")
    return _taken(rows, _planned(rows, weights, max_epochs))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
          seed: str = SEED) -> DataFrame:
    """The documents the mix takes, with ``taken``: words to read of each, repeats counted."""
    rows = staged(_sized(docs, seed), "mix-rows")
    whole = F.struct(*[F.col(c) for c in docs.columns if c != "taken"]).alias("__doc")
    return _taken(_sized(docs, seed, whole), _planned(rows, weights, max_epochs)).filter(
        "taken > 0").select("__doc.*", "taken")


def op9_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix(load(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, 3 * source_size AS cap,
        CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3
             WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM s),
l AS (SELECT *, w * ((sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::DOUBLE
             / (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::DOUBLE) >= cap AS capped
      FROM w WINDOW b AS (ORDER BY cap / w, encode(source) NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT (SELECT sum(source_size) FROM l)::DOUBLE AS all_words,
             coalesce(sum(cap) FILTER (capped), 0)::DOUBLE AS c,
             (sum(w) FILTER (NOT capped))::DOUBLE AS w FROM l),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE
             ELSE l.w * ((f.all_words - f.c) / f.w) END AS target FROM l, f),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size
                     ELSE 0 END AS epochs, floor(target + 0.5)::BIGINT AS budget FROM t),
g AS (SELECT source, key, sum(size)::BIGINT AS z, count(*) AS n FROM d GROUP BY source, key),
u AS (SELECT *, sum(z) OVER (PARTITION BY source ORDER BY key) - z AS before FROM g)
SELECT d.doc_id, d.size, p.source_size, p.target,
       (p.epochs * d.size + CASE
          WHEN u.before + u.z < p.budget - p.epochs * p.source_size THEN d.size
          WHEN u.before < p.budget - p.epochs * p.source_size
            THEN (p.budget - p.epochs * p.source_size - u.before)::BIGINT // u.n
          ELSE 0 END)::BIGINT AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
JOIN u ON d.source IS NOT DISTINCT FROM u.source AND d.key = u.key
"""
