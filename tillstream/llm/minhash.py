"""MinHash fingerprints of documents, edits of them, and a banded similarity search.

* Shingles are five words (a shorter text is one shingle), hashed from word
  hashes; a signature holds the least value of every shingle under many
  universal hash functions x -> (a x + b mod 2^64) >> 32, in vectorised numpy.
  Least values are folded to 16 bits. The share of equal components estimates
  the Jaccard similarity of the shingle sets.
* Search: different texts of one signature are a class when each has a verified
  Jaccard similarity to its representative (the text of the least XXH64); one
  that has not is a class of its own. Signatures are cut into bands; classes
  that share a band with a query's are candidates (joined in Spark), verified by
  the exact Jaccard similarity of their representatives' shingle sets.
* ``edited`` compares each document with an edited text, made from the next one
  in order of doc_id. Documents are range-partitioned and sorted once; the first
  and the last row of every partition (whose neighbour lies in another one) are
  resolved in a second, small step. The shingles that a text and its edit share
  are hashed once.

Defined results: a null text is empty; a text without a word has the signature
of the empty set, equal to that of any other such text, and is similar to none; documents of one doc_id
follow each other by the hash of their text, null doc_ids first; repeated rows
are documents of their own; one document alone is its own next; ids of any type are
kept and ordered as they are (only whole numbers divisible by 50 search); long texts
are taken whole; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.common import count_within, load, small_side, staged

SHINGLE_WORDS = 5
PERMUTATIONS = 128
BAND_ROWS = 6  # 21 bands: finds 99.8 % of the pairs at similarity 0.8
MIN_SIMILARITY = 0.8
SEED = 1
QUERY_EVERY = 50
BROADCAST_ROWS = 300_000

_NONE = np.uint64(0xFFFFFFFF)  # least value over no shingle
_MIX = np.uint64(0x9E3779B97F4A7C15)
_words: dict[bytes, int] = {}


def _word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_words) > 500_000:
        _words.clear()
    known = _words
    for w in words:
        if w not in known:
            known[w] = xxhash.xxh64_intdigest(w)
    return np.fromiter((known[w] for w in words), np.uint64, len(words))


def _shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of a row of word hashes (one if it is shorter)."""
    if not len(h):
        return h
    k = min(k, len(h))
    n = len(h) - k + 1
    s = np.zeros(n, np.uint64)
    for j in range(k):
        s = (s ^ h[j:j + n]) * _MIX
        s ^= s >> np.uint64(29)
    return s


def _functions(permutations: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    a = rng.integers(0, 1 << 63, permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, permutations, dtype=np.uint64)


def _minima(parts: list[np.ndarray], permutations: int) -> np.ndarray:
    """Least values of every part under every function; blocks of shingles stay in cache."""
    a, b = _functions(permutations)
    out = np.full((len(parts), permutations), _NONE, np.uint64)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    if not sizes.sum():
        return out
    flat = np.concatenate(parts)
    owner = np.repeat(np.arange(len(parts)), sizes)
    for lo in range(0, len(flat), 16384):
        x, own = flat[lo:lo + 16384], owner[lo:lo + 16384]
        first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        who = own[first]
        for i in range(permutations):
            v = (x * a[i] + b[i]) >> np.uint64(32)
            out[who, i] = np.minimum(out[who, i], np.minimum.reduceat(v, first))
    return out


def _folded(minima: np.ndarray) -> np.ndarray:
    return ((minima * _MIX) >> np.uint64(48)).astype(np.uint16)


def signatures(texts: list[bytes], k: int = SHINGLE_WORDS,
               permutations: int = PERMUTATIONS) -> np.ndarray:
    return _folded(_minima([_shingles(_word_hashes(t.lower().split()), k) for t in texts],
                           permutations))


def _pair_parts(text: str, following: str, k: int) -> tuple[list[np.ndarray], str]:
    """Shingle hashes that a text and its edit share, only the text's, only the edit's; the edit."""
    cut = len(text) - len(text) // 4
    kept, gone, new = text[:cut], text[cut:], following[:len(text) - cut]
    words = kept.encode("utf-8", "surrogatepass").lower().split()
    # the last word of the kept part may go on beyond the cut
    open_end = words.pop() if words and kept[-1] not in " \t\n\v\f\r" else b""
    tail = [(open_end + x.encode("utf-8", "surrogatepass").lower()).split() for x in (gone, new)]
    h = _word_hashes(words)
    parts = [_shingles(h, k) if len(h) >= k else h[:0]]
    for t in tail:
        whole = np.concatenate((h[max(0, len(h) - k + 1):], _word_hashes(t)))
        parts.append(_shingles(whole, k) if len(whole) >= k or len(h) < k else whole[:0])
    return parts, kept + new


def _with_next(rows: list[tuple[int | None, str, str]], k: int, permutations: int) -> dict:
    """Columns for (doc_id, text, next text) rows."""
    parts, edits = [], []
    for _, text, following in rows:
        p, edit = _pair_parts(text, following, k)
        parts += p
        edits.append(hashlib.sha256(edit.encode("utf-8", "surrogatepass")).digest())
    m = _minima(parts, permutations).reshape(len(rows), 3, permutations)
    own = _folded(np.minimum(m[:, 0], m[:, 1]))
    edited = _folded(np.minimum(m[:, 0], m[:, 2]))
    return {"n_chars": [len(t) for _, t, _ in rows], "edit": edits, "own": own, "edited": edited,
            "near_edited": (own == edited).mean(axis=1)}


_PAIR = pa.schema([  # after doc_id
    ("part", pa.int32()), ("place", pa.int64()), ("n_chars", pa.int64()),
    ("edit", pa.binary()), ("sig", pa.binary()), ("edited_sig", pa.binary()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()), ("text", pa.string()),
    ("th", pa.int64())])


def _neighbours(k: int, permutations: int):
    """Streams one sorted partition: all rows but the last are compared with their next one.

    The first and the last row carry their text, for the step between partitions.
    """
    def run(batches):
        part, place, last, first_sig = TaskContext.get().partitionId(), 0, None, True
        schema = None

        def out(keyed, following, following_sig, first, final):
            nonlocal place
            rows = [(i, t, n) for (i, t, _), n in zip(keyed, following)]
            c = _with_next(rows, k, permutations)
            after = np.vstack([c["own"][1:], following_sig])
            n = len(rows)
            near = (c["own"] == after).mean(axis=1).tolist()
            texts = [None] * n
            edit, es, ne = c["edit"], [x.tobytes() for x in c["edited"]], c["near_edited"].tolist()
            if first:
                texts[0] = rows[0][1]
            if final:  # its next one is in another partition
                texts[-1], edit[-1], es[-1], ne[-1], near[-1] = rows[-1][1], None, None, None, None
            batch = pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], schema.field(0).type),
                pa.array([part] * n, pa.int32()),
                pa.array(range(place, place + n), pa.int64()), pa.array(c["n_chars"], pa.int64()),
                pa.array(edit, pa.binary()), pa.array([x.tobytes() for x in c["own"]], pa.binary()),
                pa.array(es, pa.binary()), pa.array(ne, pa.float64()), pa.array(near, pa.float64()),
                pa.array(texts, pa.string()), pa.array([r[2] for r in keyed], pa.int64())],
                schema=schema)
            place += n
            return batch

        for b in batches:
            schema = pa.schema([b.schema.field("doc_id"), *_PAIR])
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            hashes = b.column("th").to_pylist()
            for lo in range(0, len(ids), 512):
                new = list(zip(ids[lo:lo + 512], texts[lo:lo + 512], hashes[lo:lo + 512]))
                seen = ([last] if last else []) + new
                last = seen[-1]
                if len(seen) > 1:
                    follow = signatures([last[1].encode("utf-8", "surrogatepass")], k, permutations)
                    yield out(seen[:-1], [x[1] for x in seen[1:]], follow, first_sig, False)
                    first_sig = False
        if last:
            yield out([last], [""], np.zeros((1, permutations), np.uint16), first_sig, True)
    return run


def edited(docs: DataFrame, shingle_words: int = SHINGLE_WORDS,
           permutations: int = PERMUTATIONS) -> DataFrame:
    """doc_id, n_chars, edit (SHA-256 of the edited text), sig, edited_sig, near_edited, near_next,
    th (XXH64 of the text).
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    ordered = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
               .withColumn("th", F.xxhash64("text"))
               .repartitionByRange("doc_id", "th").sortWithinPartitions("doc_id", "th"))
    ddl = (f"doc_id {kind}, part int, place bigint, n_chars bigint, edit binary, sig binary, "
           "edited_sig binary, near_edited double, near_next double, text string, th bigint")
    rows = staged(ordered.mapInArrow(
        _neighbours(shingle_words, permutations), ddl), "minhash")
    # two rows of every partition: the last one meets the first one of the next partition
    ends = rows.filter("text is not null")
    heads = ends.filter("place = 0")
    order = Window.orderBy("part")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # one number for each partition is ordered; the texts join by it
    numbers = heads.select(
        F.col("part").alias("n_part"), F.lag("part").over(order).alias("before"),
        F.max("part").over(whole).alias("most")).select(
        "n_part", F.coalesce("before", "most").alias("before"))
    after = heads.select(F.col("part").alias("n_part"), F.col("text").alias("n_text"),
                         F.col("sig").alias("n_sig")).join(numbers, "n_part")
    tails = ends.filter("edit is null").join(after, F.col("part") == F.col("before"))

    def resolve(batches):
        for b in batches:
            d = b.to_pydict()
            c = _with_next(list(zip(d["doc_id"], d["text"], d["n_text"])), shingle_words,
                           permutations) if d["text"] else None
            if c:
                near = [float((np.frombuffer(x, np.uint16) == np.frombuffer(y, np.uint16)).mean())
                        for x, y in zip(d["sig"], d["n_sig"])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(d["doc_id"], b.schema.field("doc_id").type),
                    pa.array(c["n_chars"], pa.int64()),
                    pa.array(c["edit"], pa.binary()), pa.array(d["sig"], pa.binary()),
                    pa.array([x.tobytes() for x in c["edited"]], pa.binary()),
                    pa.array(c["near_edited"], pa.float64()), pa.array(near, pa.float64()),
                    pa.array(d["th"], pa.int64())], columns)
    columns = ["doc_id", "n_chars", "edit", "sig", "edited_sig", "near_edited", "near_next", "th"]
    resolved = tails.select("doc_id", "text", "n_text", "sig", "n_sig", "th").mapInArrow(
        resolve, f"doc_id {kind}, n_chars bigint, edit binary, sig binary, edited_sig binary, "
                 "near_edited double, near_next double, th bigint")
    return rows.filter("edit is not null").select(*columns).union(resolved)


def _bands(rows: DataFrame, permutations: int, band_rows: int) -> DataFrame:
    """id, sig, band, value for each band; components beyond the last whole band are left out."""
    width = 2 * band_rows
    return rows.select("id", "sig", F.posexplode(F.array(*[
        F.xxhash64(F.substring("sig", i * width + 1, width))
        for i in range(permutations // band_rows)])).alias("band", "value"))


def _candidates(every: DataFrame, permutations: int, band_rows: int) -> DataFrame:
    """(q_id, id) once for each query and other signature that agree in a band."""
    mine = _bands(every.filter("q = 1"), permutations, band_rows)
    theirs = _bands(every, permutations, band_rows)
    mine = mine.withColumnRenamed("id", "q_id").withColumnRenamed("sig", "q_sig")
    if not count_within(mine, BROADCAST_ROWS):  # shuffled by band, without the signatures
        return theirs.drop("sig").join(mine.drop("q_sig"), ["band", "value"]).filter(
            "id != q_id").select("q_id", "id").distinct()
    width = 2 * band_rows
    first = F.lit(True)  # the first band in which the two agree reports the pair
    for i in range(permutations // band_rows - 1):
        first = first & ((F.col("band") <= i) | (F.substring("sig", i * width + 1, width)
                                                 != F.substring("q_sig", i * width + 1, width)))
    return theirs.join(F.broadcast(mine), ["band", "value"]).filter(
        (F.col("id") != F.col("q_id")) & first).select("q_id", "id")


def _shingle_sets(docs: DataFrame, wanted: DataFrame, shingle_words: int,
                  permutations: int) -> DataFrame:
    """id, shingles of the wanted texts (id, w: the text's hash or doc_id, s: hash of its signature)."""
    def sets(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            found = [np.unique(_shingles(_word_hashes(t.lower().split()), shingle_words)).view(
                np.int64) for t in texts]
            own = signatures(texts, shingle_words, permutations)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("s"), pa.array([x.tobytes() for x in own], pa.binary()),
                 pa.array(found, pa.list_(pa.int64()))], ["id", "s", "own", "shingles"])
    text = F.coalesce("text", F.lit(""))
    key = F.xxhash64(text) if "by_text" in wanted.columns else F.col("doc_id")
    texts = docs.select(key.alias("key"), text.cast("binary").alias("text")).join(
        small_side(wanted, BROADCAST_ROWS), F.col("key") == F.col("w")).select("id", "s", "text")
    # a doc_id may have several texts: only the one of this signature counts
    return staged(texts.mapInArrow(sets, "id bigint, s bigint, own binary, shingles array<bigint>")
                  .filter(F.xxhash64("own") == F.col("s")).drop("own", "s")
                  .dropDuplicates(["id"]), "shingle-sets")


def _jaccard(a: str, b: str):
    """Of two columns of shingle sets; null when both are empty."""
    shared = F.size(F.array_intersect(a, b))
    return F.try_divide(shared, F.size(a) + F.size(b) - shared)


def apart(docs: DataFrame, prints: DataFrame, similarity: float = MIN_SIMILARITY,
          shingle_words: int = SHINGLE_WORDS, permutations: int = PERMUTATIONS) -> DataFrame:
    """th of the texts that are not similar to the representative of their signature.

    Texts without a word, which are similar to no text, are not among them.
    """
    none = signatures([b""], shingle_words, permutations)[0].tobytes()
    several = staged(prints.filter(F.col("sig") != F.lit(none)).groupBy(F.xxhash64("sig").alias("s"))
                     .agg(F.min("th").alias("r"), F.max("th").alias("most"))
                     .filter("r < most").select("s", "r"), "shared-signatures")
    member = staged(prints.select(F.xxhash64("sig").alias("s"), "th").join(
        small_side(several, BROADCAST_ROWS), "s").distinct(), "members")
    sets = _shingle_sets(docs, member.select(F.col("th").alias("id"), F.col("th").alias("w"), "s",
                                             F.lit(True).alias("by_text")),
                         shingle_words, permutations)
    both = member.filter("th != r").join(sets, F.col("th") == F.col("id")).select(
        "th", "r", "shingles").join(
        sets.select(F.col("id").alias("r"), F.col("shingles").alias("r_shingles")), "r")
    return staged(both.filter(F.coalesce(_jaccard("shingles", "r_shingles"), F.lit(0.0))
                              < similarity).select("th"), "apart")


def classes(docs: DataFrame, prints: DataFrame) -> DataFrame:
    """``prints`` (doc_id, sig, th and others) with the id of each row's class of similar texts of
    one signature: the XXH64 of the signature, and of the text too for a text that stands apart.
    """
    alone = small_side(apart(docs, prints).withColumnRenamed("th", "a_th"), BROADCAST_ROWS)
    own = F.xxhash64("sig")
    return prints.join(alone, F.col("th") == F.col("a_th"), "left").withColumn(
        "id", F.when(F.col("a_th").isNull(), own).otherwise(F.xxhash64("sig", "th"))).drop("a_th")


def search(docs: DataFrame, prints: DataFrame, is_query, similarity: float = MIN_SIMILARITY,
           shingle_words: int = SHINGLE_WORDS, permutations: int = PERMUTATIONS,
           band_rows: int = BAND_ROWS) -> DataFrame:
    """q_id, id, jaccard: for the class of every query, the others that are similar.

    ``prints`` has doc_id and sig of all rows; ``is_query`` is a condition on it. With
    the columns th and id of ``classes``, these are its classes, found by the text
    of their representative. Without, all rows of a signature are one: its id is the
    XXH64 of the signature, and signatures that only rows without a doc_id have are
    not searched.
    """
    by_text = "th" in prints.columns
    if not by_text:
        prints = prints.withColumn("id", F.xxhash64("sig"))
    every = staged(prints.groupBy("id", "sig").agg(
        F.min("th" if by_text else "doc_id").alias("w"),
        F.max(is_query.cast("int")).alias("q")), "signatures")
    pairs = staged(_candidates(every, permutations, band_rows), "candidates")
    sides = pairs.select(F.explode(F.array("q_id", "id")).alias("id")).distinct()
    wanted = every.join(sides, "id").select("id", "w", F.xxhash64("sig").alias("s"))
    wanted = staged(wanted.withColumn("by_text", F.lit(True)) if by_text else wanted, "wanted")
    shingled = _shingle_sets(docs, wanted, shingle_words, permutations)
    both = pairs.join(shingled, "id").join(shingled.select(
        F.col("id").alias("q_id"), F.col("shingles").alias("q_shingles")), "q_id")
    return staged(both.select("q_id", "id", _jaccard("shingles", "q_shingles").alias("jaccard"))
                  .filter(F.col("jaccard") >= similarity), "similar")


def op7_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edits; documents whose id is divisible by 50
    also search all others: n_similar counts the documents of the similar classes and the
    others of their own. ``class`` is every document's class; similar_classes holds the other
    classes that are similar, on the rows of the least query doc_id of a class.
    """
    return fingerprints(load(spark, sf_dir, "documents").select("doc_id", "text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    rows = edited(docs)
    is_query = F.coalesce(F.col("doc_id").try_cast("bigint") % QUERY_EVERY == 0, F.lit(False))
    rows = classes(docs, rows)
    prints = rows.select("doc_id", "sig", "th", "id")
    found = search(docs, prints, is_query)
    sizes = staged(prints.groupBy("id").agg(
        F.count("*").alias("n"), F.min(F.when(is_query, F.col("doc_id"))).alias("q_doc")), "classes")
    linked = found.join(sizes.select("id", "n"), "id").groupBy("q_id").agg(
        F.sum("n").alias("others"), F.sort_array(F.collect_list("id")).alias("similar_classes"))
    none = F.xxhash64(F.lit(signatures([b""])[0].tobytes()))
    counted = staged(sizes.filter("q_doc is not null").join(
        linked, F.col("id") == F.col("q_id"), "left").select(
        F.col("id").alias("class"), "q_doc", "similar_classes",
        F.when(F.col("id") == none, 0).otherwise(
            F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_similar")), "similar-counts")
    return rows.withColumnRenamed("id", "class").join(small_side(counted, BROADCAST_ROWS), "class", "left").select(
        "doc_id", "n_chars", F.lower(F.hex("edit")).alias("edited_sha256"),
        F.lower(F.hex("sig")).alias("fingerprint"),
        F.lower(F.hex("edited_sig")).alias("edited_fingerprint"), "near_edited", "near_next",
        F.when(is_query, F.col("n_similar")).alias("n_similar"), "class",
        F.when(F.col("doc_id") == F.col("q_doc"), F.coalesce(
            "similar_classes", F.array().cast("array<bigint>"))).alias("similar_classes"))
