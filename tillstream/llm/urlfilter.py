"""URL filter: explicit host and path rules, and association rules mined by FP-growth.

A url is split into host and path; the explicit rules (host suffix and path
prefix, longest wins) judge those they fit. Their verdicts also label the urls
for mining: Spark's FP-growth finds combinations of url tokens that come with a
verdict, association rules are kept by support and confidence, and a rule is
left out when a part of its tokens says the same as surely. The remaining
urls are judged by the surest mined rule whose tokens they all have: rules are
looked up by their rarest token (an inverted index) and then verified. Equal
token sets are judged once. Without a matching rule the verdict is ``allow``.

Defined results: a null url, or one without ``://``, has empty host and path,
no token and verdict ``allow``; repeated rows get equal results; ties between
mined rules go to the larger support, then to ``allow``, then to the tokens of
least code point; other columns (html) are not read; without labelled urls of
both verdicts nothing is mined; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import load, lower_ascii, small_side, staged

ALLOW, BLOCK = "allow", "block"

# The explicit rules (host and path prefix, verdict).
RULES = (
    ("net/", BLOCK),
    ("example.net/en/", ALLOW),
    ("example.com/de/", BLOCK),
    ("org/fr/", ALLOW),
)
MIN_SUPPORT = 0.002  # part of the labelled urls
MIN_CONFIDENCE = 0.9
BROADCAST_ROWS = 200_000

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def split_url(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url column."""
    text = F.coalesce(F.col(url), F.lit(""))
    return lower_ascii(F.regexp_extract(text, _URL, 1)), F.regexp_extract(text, _URL, 2)


def query_of(url: str) -> Column:
    """What stands between the first ``?`` and ``#`` of a url column."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _URL, 3)


def explicit(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Rule string and verdict of the longest fitting rule; nulls if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, decision in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(
            path, F.lit(slash + rest))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def tokens(host: Column, path: Column, query: Column) -> Column:
    """Distinct tokens, sorted: top-level and registered domain, words of the other host
    labels, every path segment and query key (digits as one), extension, and depth of the
    path. Support decides which of them can be part of a rule.
    """
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    n = F.size(labels)
    subs = F.when(n > 2, F.slice(labels, F.lit(1), n - 2)).otherwise(
        F.array().cast("array<string>"))
    words = F.filter(F.flatten(F.transform(subs, lambda x: F.split(x, "-"))), lambda x: x != "")
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    keys = F.filter(F.transform(F.split(query, "[&;]"), lambda x: F.substring_index(x, "=", 1)),
                    lambda x: x != "")
    extension = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1)

    def named(kind: str, values: Column) -> Column:
        return F.transform(values, lambda x: F.concat(
            F.lit(kind), F.regexp_replace(x, "[0-9]+", "#")))
    single = F.array(
        F.when(n > 0, F.concat(F.lit("t:"), F.element_at(labels, -1))),
        F.when(n > 1, F.concat(F.lit("d:"), F.array_join(F.slice(labels, -2, 2), "."))),
        F.when(extension != "", F.concat(F.lit("x:"), extension)),
        F.when(F.size(segments) > 0, F.concat(F.lit("n:"), F.size(segments).cast("string"))))
    return F.array_sort(F.array_distinct(F.array_compact(F.concat(
        single, F.transform(words, lambda x: F.concat(F.lit("s:"), x)), named("p:", segments),
        named("q:", keys)))))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT,
         min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(tokens, verdict) rows -> tokens, verdict, confidence, support, rarest of each rule."""
    marks = {ALLOW: "v:" + ALLOW, BLOCK: "v:" + BLOCK}
    spark = labelled.sparkSession
    empty = spark.createDataFrame(
        [], "tokens array<string>, verdict string, confidence double, support double, rarest string")
    if labelled.select("verdict").distinct().count() < 2:
        return empty
    mark = F.when(F.col("verdict") == ALLOW, marks[ALLOW]).otherwise(marks[BLOCK])
    model = FPGrowth(itemsCol="items", minSupport=min_support,
                     minConfidence=min_confidence).fit(
        labelled.select(F.concat("tokens", F.array(mark)).alias("items")))
    said = F.element_at("consequent", 1)
    rules = model.associationRules.filter(
        said.isin(*marks.values())
        & ~F.exists("antecedent", lambda t: F.startswith(t, F.lit("v:")))).select(
        F.array_sort("antecedent").alias("tokens"),
        F.when(said == marks[ALLOW], ALLOW).otherwise(BLOCK).alias("verdict"),
        "confidence", "support")
    rules = staged(rules.withColumn("id", F.xxhash64("tokens")), "url-rules")
    # left out: rules of which a rule with a part of the tokens is as sure. Every such part lacks
    # one token at least, so comparing with the sets that lack one token, down the sizes, is enough
    # when those are rules too; sets that are no rules are less sure than min_confidence.
    shorter = rules.filter(F.size("tokens") > 1).select(
        "id", "verdict", "confidence", "tokens", F.explode("tokens").alias("gone")).select(
        "id", "verdict", "confidence", F.array_except("tokens", F.array("gone")).alias("part"))
    parts = rules.select(F.col("tokens").alias("part"), "verdict",
                         F.col("confidence").alias("as_sure"))
    covered = shorter.join(parts, ["part", "verdict"]).filter("as_sure >= confidence").select(
        "id", "verdict").distinct()
    kept = rules.join(covered, ["id", "verdict"], "left_anti")
    often = staged(model.freqItemsets.filter("size(items) = 1").select(
        F.get("items", F.lit(0)).alias("token"), "freq"), "url-tokens")
    rarest = kept.select("id", "verdict", F.explode("tokens").alias("token")).join(
        often, "token").groupBy("id", "verdict").agg(
        F.min(F.struct("freq", "token"))["token"].alias("rarest"))
    return staged(kept.join(rarest, ["id", "verdict"]).select(
        "tokens", "verdict", "confidence", "support", "rarest"), "url-mined")


def matched(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``tokens`` -> tokens, mined (tokens of the rule), mined_verdict, of the surest rule."""
    r = small_side(rules.select(F.col("tokens").alias("r_tokens"), "verdict", "confidence",
                                "support", "rarest"), BROADCAST_ROWS)
    looked = sets.select("tokens", F.explode("tokens").alias("rarest")).join(r, "rarest").filter(
        F.size(F.array_except("r_tokens", "tokens")) == 0)
    best = F.min(F.struct((-F.col("confidence")).alias("a"), (-F.col("support")).alias("b"),
                          "verdict", "r_tokens"))
    return looked.groupBy("tokens").agg(best.alias("m")).select(
        "tokens", F.array_join("m.r_tokens", " ").alias("mined"),
        F.col("m.verdict").alias("mined_verdict"))


def judge(pages: DataFrame, rules=RULES, min_support: float = MIN_SUPPORT,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict, mined for every row of ``pages`` (page_id, url)."""
    host, path = split_url("url")
    rows = pages.select("page_id", host.alias("host"), path.alias("path"),
                        query_of("url").alias("query"))
    rule, verdict = explicit(F.col("host"), F.col("path"), rules)
    rows = staged(rows.select("*", rule.alias("rule"), verdict.alias("said"),
                              tokens(F.col("host"), F.col("path"), F.col("query")).alias("tokens"))
                  .drop("query"), "urls")
    mined = mine(rows.filter("said is not null").select("tokens", F.col("said").alias("verdict")),
                 min_support, min_confidence)
    decided = staged(matched(rows.filter("said is null").select("tokens").distinct(), mined),
                     "url-decisions")
    both = rows.join(small_side(decided, BROADCAST_ROWS), "tokens", "left")
    return both.select(
        "page_id", "host", "path", "rule",
        F.coalesce("said", "mined_verdict", F.lit(ALLOW)).alias("verdict"),
        F.when(F.col("said").isNull(), F.col("mined")).alias("mined"))


def op2_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(load(spark, sf_dir, "pages").select("page_id", "url"))
