"""Secret scan with multipart credential linking.

Each text is scanned for parts of credentials. Base parts (assignments of a
password, secret, token or key; access key ids; long hex runs) are always
reported. Weaker parts (user names and e-mail addresses, random-looking tokens
and short passwords, endpoints) are reported only when a complementary part
stands within scope: a join of the parts' intervals, by document and position
bin, finds for each weak part another one of a complementary role at most
SCOPE_CHARS code points away. Bins bound the number of parts that can meet, so
a text with very many parts is spread over many groups; finding them takes time in
proportion to the text (times the logarithm of its parts), in one task.

Roles: access identifiers complement secrets and the reverse; endpoints are
complemented by either, and complement secrets.

Defined results: a null text is empty and has no part; repeated rows get equal
results; rows are matched by doc_id (null included) and text hash, so several
texts under one doc_id keep apart; other columns are ignored by ``scan`` and
kept by ``redacted``; an empty table gives an empty table. Positions are code
points, ends exclusive.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import load, small_side, staged

SCOPE_CHARS = 200
MIN_ENTROPY = 3.0  # bits per character of a random-looking token
MARK = "<secret>"
BROADCAST_ROWS = 200_000

#: Kinds in the order in which parts at one position are listed; the first three are base kinds.
KINDS = ("assign", "access", "hex", "user", "weak", "endpoint")
ROLE = {"assign": "secret", "access": "access", "hex": "secret", "user": "access",
        "weak": "secret", "endpoint": "endpoint"}
BASE = 3

_ASCII = re.ASCII | re.IGNORECASE
_EQUALS = r"""["']?\x20*[:=]\x20*["']?"""
_ASSIGN = re.compile(
    rf"(password|passwd|secret|token|api_?key){_EQUALS}([A-Za-z0-9+/_.=-]+)", _ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_USER = re.compile(rf"(?:user(?:_?name)?|login|client_?id|account(?:_?id)?|access_?key(?:_?id)?)"
                   rf"{_EQUALS}[A-Za-z0-9._@+-]{{3,}}", _ASCII)
_MAIL = re.compile(r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+")
_URL = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s\"'<>]{3,}")
_HOST = re.compile(rf"(?:host|server|endpoint|base_?url){_EQUALS}[A-Za-z0-9.-]+(?::[0-9]+)?",
                   _ASCII)
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_SHORT = re.compile(rf"(?:pass(?:word|wd)?|pwd|secret|token|api_?key){_EQUALS}"
                    r"([A-Za-z0-9+/_.=!@#$%^&*-]+)", _ASCII)


def _random_looking(token: str) -> bool:
    if not (any(c.isdigit() for c in token) and any(c.isalpha() for c in token)):
        return False
    n = len(token)
    return -sum(k / n * math.log2(k / n) for k in Counter(token).values()) >= MIN_ENTROPY


def _merged(spans) -> tuple[list[int], list[int]]:
    """Starts and ends of the disjoint intervals that cover the same places, in order."""
    starts: list[int] = []
    ends: list[int] = []
    for s, e in sorted(spans):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def parts_of(text: str) -> list[tuple[int, int, int]]:
    """(start, index of kind, end) of every part; searches whose literal is absent are skipped."""
    low = text.lower()
    out: list[tuple[int, int, int]] = []
    names = any(w in low for w in ("pass", "pwd", "secret", "token", "api"))
    if names:
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    taken = _merged((s, e) for s, _, e in out)

    def add(kind: int, found) -> None:
        nonlocal taken
        last, new = 0, []
        for s, e in sorted(found):
            i = bisect.bisect_right(taken[1], s)  # the first taken interval that ends after s
            if s >= last and not (i < len(taken[0]) and taken[0][i] < e):
                new.append((s, e))
                last = e
        out.extend((s, kind, e) for s, e in new)
        taken = _merged([*zip(*taken), *new])
    ends: list[tuple[int, int]] = []
    if "://" in text:
        ends += [m.span() for m in _URL.finditer(text)]
    if any(w in low for w in ("host", "server", "endpoint", "url")):
        ends += [m.span() for m in _HOST.finditer(text)]
    add(5, ends)
    users: list[tuple[int, int]] = []
    if any(w in low for w in ("user", "login", "client", "account", "access")):
        users += [m.span() for m in _USER.finditer(text)]
    if "@" in text:
        users += [m.span() for m in _MAIL.finditer(text)]
    add(3, users)
    if any(ROLE[KINDS[k]] != "secret" for _, k, _ in out):  # else nothing complements a weak one
        weak = [m.span() for m in _TOKEN.finditer(text) if _random_looking(m[0])]
        if names:
            weak += [m.span() for m in _SHORT.finditer(text) if len(m[1]) >= 4]
        add(4, weak)
    return sorted(out)


def parts(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), parts (array of start, kind, end), one row per row."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for b in batches:
            found = [[{"start": s, "kind": k, "end": e} for s, k, e in parts_of(t)]
                     for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), pa.array(found, kind)],
                ["doc_id", "th", "parts"])
    return docs.select("doc_id", F.xxhash64("text").alias("th"),
                       F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, f"doc_id {dict(docs.dtypes)['doc_id']}, th bigint, "
             "parts array<struct<start:int,kind:int,end:int>>")


def _complement(a: Column, b: Column) -> Column:
    """Whether a part of kind ``b`` makes a weak part of kind ``a`` worth reporting."""
    role = F.element_at(F.array(*[F.lit(ROLE[k]) for k in KINDS]), b + 1)
    own = F.element_at(F.array(*[F.lit(ROLE[k]) for k in KINDS]), a + 1)
    return F.when(own == "access", role == "secret").otherwise(role != own)


def linked(found: DataFrame, scope: int = SCOPE_CHARS) -> DataFrame:
    """The weak parts with a complementary part in scope: doc_id, th, weak (array of parts)."""
    one = (found.filter(F.exists("parts", lambda p: p["kind"] >= BASE)
                        & (F.size("parts") > 1)).distinct()
           .select("doc_id", "th", F.explode("parts").alias("p"))
           .select("doc_id", "th", "p.*"))
    one = staged(one, "credential-parts")
    width = 2 * scope

    def bins(begin: Column, end: Column) -> Column:
        return F.explode(F.sequence(F.floor(begin / width), F.floor(end / width)))
    weak = one.filter(F.col("kind") >= BASE).withColumn(
        "bin", bins(F.col("start") - scope, F.col("end") + scope))
    other = one.select(F.col("doc_id").alias("o_id"), F.col("th").alias("o_th"),
                       F.col("start").alias("o_start"), F.col("end").alias("o_end"),
                       F.col("kind").alias("o_kind")).withColumn(
        "o_bin", bins(F.col("o_start"), F.col("o_end")))
    gap = F.greatest(F.col("o_start") - F.col("end"), F.col("start") - F.col("o_end"))
    meets = (weak["doc_id"].eqNullSafe(other["o_id"]) & (weak["th"] == other["o_th"])
             & (weak["bin"] == other["o_bin"]) & (gap <= scope)
             & _complement(weak["kind"], other["o_kind"]))
    return (weak.join(other, meets, "left_semi").select("doc_id", "th", "start", "kind", "end")
            .distinct().groupBy("doc_id", "th")
            .agg(F.collect_list(F.struct("start", "kind", "end")).alias("weak")))


def scan(docs: DataFrame, scope: int = SCOPE_CHARS) -> DataFrame:
    """doc_id, th, base, spans for every row: sorted arrays of (start, kind, end)."""
    found = staged(parts(docs), "parts")
    more = staged(linked(found, scope), "linked-parts").select(
        F.col("doc_id").alias("w_id"), F.col("th").alias("w_th"), "weak")
    base = F.filter("parts", lambda p: p["kind"] < BASE)
    both = found.join(small_side(more, BROADCAST_ROWS),
                      found["doc_id"].eqNullSafe(more["w_id"]) & (found["th"] == more["w_th"]),
                      "left")
    return both.select("doc_id", "th", base.alias("base"),
                       F.array_sort(F.concat(base, F.coalesce(
                           "weak", F.array().cast("array<struct<start:int,kind:int,end:int>>"))
                       )).alias("spans"))


def redacted(docs: DataFrame, scope: int = SCOPE_CHARS, mark: str = MARK) -> DataFrame:
    """``docs`` with every reported span replaced by ``mark`` (touching spans by one).

    An integer column n_chars, if there is one, follows the changed texts; all
    other rows and columns stay as they are.
    """
    def merged(batches):
        for b in batches:
            out = []
            for spans in b.column("spans").to_pylist():
                joined: list[list[int]] = []
                for p in spans:
                    if joined and p["start"] <= joined[-1][1]:
                        joined[-1][1] = max(joined[-1][1], p["end"])
                    else:
                        joined.append([p["start"], p["end"]])
                out.append(joined)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), pa.array(out, pa.list_(pa.list_(pa.int32())))],
                ["__sec_id", "__sec_th", "__sec_cuts"])
    kind = dict(docs.dtypes)["doc_id"]
    cuts = staged(scan(docs, scope).filter(F.size("spans") > 0).select("doc_id", "th", "spans")
                  .distinct().mapInArrow(merged, f"__sec_id {kind}, __sec_th bigint, "
                                                 "__sec_cuts array<array<int>>"), "secret-cuts")
    cuts = small_side(cuts, BROADCAST_ROWS)
    rows = docs.join(cuts, docs["doc_id"].eqNullSafe(cuts["__sec_id"])
                     & (F.xxhash64(docs["text"]) == cuts["__sec_th"]), "left")
    pieces = F.expr(
        "transform(sequence(0, size(__sec_cuts)), i -> substring(text, "
        "if(i = 0, 0, __sec_cuts[i - 1][1]) + 1, "
        "if(i = size(__sec_cuts), length(text), __sec_cuts[i][0])"
        " - if(i = 0, 0, __sec_cuts[i - 1][1])))")
    text = F.when(F.col("__sec_cuts").isNull(), F.col("text")).otherwise(
        F.array_join(pieces, mark))
    columns = [text.alias(c) if c == "text" else F.col(c) for c in docs.columns]
    if dict(docs.dtypes).get("n_chars") in ("int", "bigint"):
        n = F.when(F.col("__sec_cuts").isNull(), F.col("n_chars")).otherwise(F.length(text))
        columns[docs.columns.index("n_chars")] = n.cast(dict(docs.dtypes)["n_chars"]).alias(
            "n_chars")
    return rows.select(*columns)


def _listed(spans: str) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda p: F.concat_ws(
        ":", F.element_at(name, p["kind"] + 1), p["start"].cast("string"),
        p["end"].cast("string"))), ",")


def op6_secret_scan(spark, sf_dir: str) -> DataFrame:
    def n(kind: int) -> Column:
        return F.size(F.filter("base", lambda p: p["kind"] == kind)).cast("long")
    return scan(load(spark, sf_dir, "documents")).select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_linked"))
