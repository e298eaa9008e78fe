"""Language-model scores from a probabilistic suffix tree over words.

Symbols are the frequent words, one end symbol, and rarer words. The tree is grown by depth: a context is a candidate when it is frequent
enough, its next-symbol counts are collected over the whole training part, and
it is retained when they diverge from those of its longest proper suffix (a
likelihood-ratio test, and a least Kullback-Leibler divergence). A text is
scored by the longest retained suffix of what precedes each symbol, its
distribution smoothed by absolute discounting into that of the next shorter
retained suffix, down to the frequencies of single symbols. What follows a
context is a frequent word, the end or a class of rarer words (by their hash, CLASSES at
most; a context tells rarer words apart by themselves); in its class a word has its own
discounted frequency, and the mass of unseen words is spread over as many unseen types
as the vocabulary has.

The tree has a head and a rest. What is broadcast only saves work, and no score depends on the
rates of longer contexts and pairs (HEAD_RATE says which words are frequent):
words with at least HEAD_RATE of all tokens and their contexts, longer contexts of such
words with CONTEXT_RATE, and next symbols with PAIR_RATE are broadcast. A place is open when it
needs a context or a next symbol that is not broadcast (bit filters of bounded size, of seldom next
symbols and of two words next to each other, leave out most of those that occur too seldom to matter). Open places are dealt out to buckets by the two
words before them, as packed columns, and the counts of seldom next symbols go to the same
buckets; there all contexts that are not of the head are counted, tested and scored. A hot
word's places are spread over several buckets, by the word before it. Contexts with a rarer word
at any place count from TAIL_CONTEXT occurrences on, tested against what the shorter suffix gives;
those that end with one are in its bucket. Rare words go to buckets by their hash, in the same
shuffle, with the text, the words before and the symbol after each; the word's own frequency and what
follows it come from its bucket, where words are told apart by themselves. Elsewhere in a context,
rarer words are told apart by 62 bits of their hash. What a bucket adds to a text is packed and summed by text.
All counts cover every training row.

Defined results: a null text is empty, its only token is the end; repeated rows
get equal scores and count each time; a null doc_id counts as empty text in the
fold; without training rows every token is unseen, the base is 0, and the end
and any other word are equally likely; long texts are taken whole, in pieces;
equal contexts are one context, whose counts add up; other columns are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import crc_remainder, load, small_side, staged, utf8
from tillstream.session import session_conf

HEAD_RATE = 2e-6
CONTEXT_RATE = 2e-6  # of longer contexts that are broadcast
PAIR_RATE = 5e-7  # of next symbols that are broadcast
CLASSES = 1 << 19  # most symbols of rarer words
DEPTH = 3
HEAD_LEAST = 10  # occurrences of a frequent word
MIN_CONTEXT = 2  # occurrences of a context of frequent words
MIN_PAIR = 2  # of a next symbol stored there
TAIL_CONTEXT = 2  # occurrences of a context of the tail
TAIL_PAIR = 2  # of a next symbol stored there
TAIL_WEIGHT = 4.0  # of the shorter suffix there, in occurrences
MIN_DIVERGENCE = 0.01  # nats
DISCOUNT = 0.75  # of next-symbol counts
BROADCAST_ROWS = 1_000_000

#: What a task holds at once: tokens or bytes of a piece of a batch, and entries of counts.
PIECE_TOKENS = 400_000
PIECE_BYTES = 4_000_000
HELD_COUNTS = 300_000
BUCKET_TOKENS = 500_000  # training tokens for each bucket of open places
MARK_BITS = 26  # most slots (a power of 2) of a broadcast filter

_BITS = 20  # of a symbol; 1 / HEAD_RATE, CLASSES and two more symbols fit
_SYMBOL = (1 << _BITS) - 1
_END_WORD = b""  # words are never empty
_NO_COUNTS = {k: np.zeros(0, np.int64) for k in ("keys", "pairs", "n", "count", "total", "down")}
_NO_LEVEL = {**_NO_COUNTS, "all": _NO_COUNTS}


def _pieces(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose bytes add up to about ``most``, of a row at least."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(
        zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        done = upto[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, done + most, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(keys, return_inverse=True)
    return keys, np.bincount(at, weights=counts, minlength=len(keys)).astype(np.int64)


_ZSTD = pa.Codec("zstd", compression_level=3)
_DEALT = "bucket bigint, size bigint, a binary, b binary, c binary, d binary, e binary, f binary"


def _dealt(bucket: np.ndarray, *columns: np.ndarray, words: pa.Array | None = None,
           by: np.ndarray | None = None) -> pa.RecordBatch:
    """A row for each bucket, with the longs of every column that belong there, as bytes: all
    lowest bytes first, compressed. ``words`` are the last column, their sizes the one before.
    ``by``, an order by bucket, may be given."""
    if by is None:
        by = np.argsort(bucket, kind="stable")
    starts = _runs(bucket[by]) if len(by) else np.zeros(0, np.int64)
    ends = np.append(starts, len(by))[1:]
    if words is not None:
        columns += (pc.binary_length(words).to_numpy(zero_copy_only=False),)
    out = []
    for c in columns:
        planes = np.ascontiguousarray(
            np.ascontiguousarray(c[by].astype(np.int64)).view(np.uint8).reshape(-1, 8).T)
        out.append(pa.array([_ZSTD.compress(np.ascontiguousarray(planes[:, i:j]).ravel(), asbytes=True)
                             for i, j in zip(starts, ends)], pa.binary()))
    if words is not None:
        at = np.concatenate(([0], np.cumsum(columns[-1][by])))
        whole = words.take(pa.array(by)).cast(pa.large_binary()).buffers()[2] or pa.py_buffer(b"")
        out.append(pa.array([_ZSTD.compress(whole.slice(at[i], at[j] - at[i]), asbytes=True)
                             for i, j in zip(starts, ends)], pa.binary()))
    out += [pa.array([b""] * len(starts), pa.binary())] * (6 - len(out))
    sizes = pa.array((ends - starts).astype(np.int64))
    return pa.RecordBatch.from_arrays([pa.array(bucket[by][starts].astype(np.int64)), sizes, *out],
                                      ["bucket", "size", "a", "b", "c", "d", "e", "f"])


def _buckets(batches, columns: int, below: int = 0) -> Iterator[list]:
    """The columns of each bucket of rows sorted by bucket; of those below 0, which have ``below``
    columns of longs, the last are words."""
    held, last = [], None

    def longs(bucket):
        return below if bucket < 0 else columns

    def whole():
        out = [np.concatenate(x) for x in zip(*(x[:longs(last)] for x in held))]
        if last < 0:
            texts = b"".join(pa.decompress(x[below], int(x[below - 1].sum()), codec="zstd",
                                           asbytes=True) for x in held)
            at = np.concatenate(([0], np.cumsum(out[-1])))
            out[-1] = pa.Array.from_buffers(pa.large_binary(), len(at) - 1,
                                            [None, pa.py_buffer(at), pa.py_buffer(texts)])
        return last, *out
    for batch in batches:
        for bucket, size, *own in zip(*(c.to_pylist() for c in batch.columns)):
            if held and bucket != last:
                yield whole()
                held = []
            last = bucket
            held.append([np.ascontiguousarray(np.frombuffer(
                pa.decompress(x, size * 8, codec="zstd"), np.uint8).reshape(8, -1).T).view(
                np.int64).ravel() for x in own[:longs(bucket)]] + own[longs(bucket):])
    if held:
        yield whole()


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of all texts, and the number of each text's words."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    words = lists.flatten()
    full = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # else before or after blanks
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    return words.filter(pa.array(full)).view(pa.binary()), np.bincount(row[full], minlength=len(texts))


def _count_words(train: DataFrame) -> DataFrame:
    """(word, n) over the training texts, the end token included."""
    def added(held):
        return pa.concat_tables(held).group_by("word", use_threads=False).aggregate(
            [("n", "sum")]).rename_columns(["word", "n"])

    def run(batches):
        held = []
        for b in (p for whole in batches for p in _pieces(whole, "text", PIECE_BYTES)):
            counts = _words(b.column("text"))[0].value_counts()
            held.append(pa.table({"word": counts.field(0), "n": counts.field(1)}))
            held.append(pa.table({"word": pa.array([_END_WORD], pa.binary()),
                                  "n": pa.array([b.num_rows], pa.int64())}))
            if sum(t.num_rows for t in held) > HELD_COUNTS:
                held = [added(held)]
                if held[0].num_rows > HELD_COUNTS // 2:
                    yield from held.pop().to_batches()
        if held:
            yield from added(held).to_batches()
    return train.select(utf8("text").alias("text")).mapInArrow(run, "word binary, n bigint").groupBy(
        "word").agg(F.sum("n").alias("n"))


def _classes(hashes: np.ndarray, classes: int) -> np.ndarray:
    """The class of rarer words, by their hashes: -1 and below."""
    return -1 - hashes % classes


def _symbols(sym: np.ndarray, other: int) -> np.ndarray:
    """The symbols as they follow a context: that of a rarer word is its class, ``other`` and below."""
    return np.where(sym < 0, sym + other + 1, sym)


def _class_counts(rarer: DataFrame, classes: int) -> DataFrame:
    """(class, n, v): the tokens and the words of each class of rarer words."""
    def run(batches):
        for b in (b for b in batches if b.num_rows):
            of, at = np.unique(_classes(_hashes(b.column("word")), classes), return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(of), pa.array(np.bincount(at, b.column("n").to_numpy()).astype(np.int64)),
                 pa.array(np.bincount(at))], ["class", "n", "v"])
    return rarer.select("word", "n").mapInArrow(run, "class bigint, n bigint, v bigint").groupBy(
        "class").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))


def _encoded(docs: DataFrame, head, base, held_out, classes: int) -> DataFrame:
    """Each row's symbols (4 bytes each; below 0: another word's class), its other words in order (a space between),
    and its tokens: all, those of the head that were seen, and the base of these.

    ``base``: of every symbol, the end's last; 0 where it was not seen.
    """
    def run(batches):
        known = pa.array(head.value, pa.binary())
        own = base.value
        for b in (p for whole in batches for p in _pieces(whole, "text", PIECE_BYTES)):
            words, sizes = _words(b.column("text"))
            coded = words.dictionary_encode()
            own_ids = pc.fill_null(pc.index_in(coded.dictionary, value_set=known), -1).to_numpy().astype(np.int32)
            rare = np.flatnonzero(own_ids < 0)
            own_ids[rare] = _classes(_hashes(coded.dictionary.take(pa.array(rare))), classes)
            ids = own_ids[coded.indices.to_numpy()]
            row = np.repeat(np.arange(len(sizes)), sizes)
            rare = ids < 0
            others = pa.ListArray.from_arrays(_offsets(np.bincount(row[rare], minlength=len(sizes))),
                                              words.filter(pa.array(rare)))
            seen = np.bincount(row[~rare], minlength=len(sizes)) + (own[-1] < 0)
            yield pa.RecordBatch.from_arrays(
                [b.column("rid"), b.column("doc_id"), b.column("held_out"), pa.array(sizes + 1),
                 pa.array(seen.astype(np.int64)),
                 pa.array(np.bincount(row[~rare], own[ids[~rare]], len(sizes)) + own[-1]),
                 pa.Array.from_buffers(pa.binary(), len(sizes),
                                       [None, _offsets(4 * sizes).buffers()[1], pa.py_buffer(ids)]),
                 pc.binary_join(others, pa.scalar(b" ", pa.binary()))],
                ["rid", "doc_id", "held_out", "n_tokens", "known", "base", "ids", "others"])
    return docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id",
                       held_out.alias("held_out"), utf8("text").alias("text")).mapInArrow(
        run, f"rid bigint, doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, n_tokens bigint, "
             "known bigint, base double, ids binary, others binary")


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each row's bytes begin (and the last one's end), and all bytes."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32, len(column) + 1, 4 * column.offset).astype(np.int64) if len(
        column) else np.zeros(1, np.int64)
    return at - at[0], (np.frombuffer(data, np.uint8, at[-1] - at[0], at[0]) if at[-1] > at[0]
                        else np.zeros(0, np.uint8))


def _stream(column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All symbols of a batch with an end after every row, each one's place in its row, and the
    rows' sizes.
    """
    at, own = _bytes(column)
    sizes, flat = np.diff(at) // 4, np.frombuffer(own.tobytes(), np.int32)
    ends = np.cumsum(sizes + 1) - 1
    sym = np.empty(len(flat) + len(sizes), np.int64)
    is_end = np.zeros(len(sym), bool)
    is_end[ends] = True
    sym[is_end] = end
    sym[~is_end] = flat
    first = ends - sizes
    return sym, np.arange(len(sym)) - np.repeat(first, sizes + 1), sizes + 1


def _contexts(sym: np.ndarray, place: np.ndarray, depth: int) -> np.ndarray:
    """Packed ``depth`` symbols before each place; -1 where there are fewer, or another word."""
    key = np.zeros(len(sym), np.int64)
    ok = place >= depth
    for back in range(depth, 0, -1):  # the farthest symbol first
        before = np.concatenate((np.full(min(back, len(sym)), -1), sym[:-back])) if back else sym
        ok &= before >= 0
        key = (key << _BITS) | np.maximum(before, 0)
    return np.where(ok, key, -1)


def _index(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted value in the sorted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    if keys[0] == 0 and keys[-1] == len(keys) - 1:  # all of 0, 1, ..
        return np.where((wanted >= 0) & (wanted < len(keys)), wanted, -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _next_counts(train: DataFrame, contexts, depth: int, end: int, other: int,
                 buckets: int) -> DataFrame:
    """(context, symbol, n): what follows the candidate contexts, summed by task first."""
    def run(batches):
        keys = contexts.value
        held = []
        for b in (p for whole in batches for p in _pieces(whole, "ids", 4 * PIECE_TOKENS)):
            sym, place, _ = _stream(b.column("ids"), end)
            at = _index(keys, _contexts(sym, place, depth))
            held.append(np.unique(((at << _BITS) | _symbols(sym, other))[at >= 0],
                                  return_counts=True))
            if sum(len(x) for x, _ in held) > 6 * HELD_COUNTS:
                held = [_summed(*map(np.concatenate, zip(*held)))]
                if len(held[0][0]) > 4 * HELD_COUNTS:
                    pair, n = held.pop()
                    yield _dealt(_slots(pair, 30) % buckets, pair, n)
        if held:
            pair, n = _summed(*map(np.concatenate, zip(*held)))
            yield _dealt(_slots(pair, 30) % buckets, pair, n)

    def add(batches):
        for _, pair, n in _buckets(batches, 2):
            pair, n = _summed(pair, n)
            yield pa.RecordBatch.from_arrays(
                [pa.array((pair >> _BITS).astype(np.int32)),
                 pa.array((pair & _SYMBOL).astype(np.int32)), pa.array(n)],
                ["context", "symbol", "n"])
    return train.select("ids").mapInArrow(run, _DEALT).repartition("bucket").sortWithinPartitions(
        "bucket").mapInArrow(add, "context int, symbol int, n bigint")


def _diverging(both: DataFrame) -> DataFrame:
    """context, total, stored, varied of the contexts that diverge from their suffix.

    ``both``: context, symbol, n, and p_n, p_total of the suffix's distribution.
    """
    total, stored = F.sum("n"), F.col("n") >= MIN_PAIR
    gain = F.sum(F.col("n") * F.log(F.col("n") * F.col("p_total") / F.col("p_n")))
    tested = both.groupBy("context").agg(total.alias("total"), gain.alias("gain"),
                                         F.count("*").alias("k"),
                                         F.sum(F.when(stored, F.col("n")).otherwise(0)).alias("stored"),
                                         F.sum(F.when(stored, 1).otherwise(0)).alias("varied"))
    # sum of n log((n / total) / (p_n / p_total)): total times the divergence
    divergence = F.col("gain") - F.col("total") * F.log("total")
    return tested.withColumn("d", divergence).filter(
        (2 * F.col("d") > F.col("k") + 3 * F.sqrt(2.0 * F.col("k")))
        & (F.col("d") >= MIN_DIVERGENCE * F.col("total"))).select("context", "total", "stored", "varied")


def _columns(df: DataFrame, *names: str) -> list[np.ndarray]:
    table = df.select(*names).toArrow()
    return [table.column(n).to_numpy() for n in names]


#: While learning: a step's shuffle files go once its table is written, which is small.
_LEARNING = {"spark_sql_classic_shuffleDependency_fileCleanup_enabled": "true",
             "spark_sql_parquet_compression_codec": "zstd"}


def learn(docs: DataFrame, held_out, depth: int = DEPTH) -> dict:
    """Model from the rows of ``docs`` that are not held out.

    Returns vocabulary (DataFrame word, n), encoded (all rows, staged), and the tree.
    """
    with session_conf(docs.sparkSession, **_LEARNING):
        return _learn(docs, held_out, depth)


def _learn(docs: DataFrame, held_out, depth: int) -> dict:
    spark = docs.sparkSession
    sc = spark.sparkContext
    vocabulary = staged(_count_words(docs.filter(~held_out)), "vocabulary")
    row = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    tokens, types = row["n"], row["v"]
    head_min = max(HEAD_LEAST, int(np.ceil(HEAD_RATE * tokens)))
    frequent = F.col("n") >= head_min
    is_end = F.length("word") == 0
    words, counts = _columns(vocabulary.filter(frequent & ~is_end), "word", "n")
    order = np.argsort(words) if len(words) else np.zeros(0, int)
    words, counts = [words[i] for i in order], counts[order]
    end = len(words)
    ends = vocabulary.filter(is_end).agg(F.sum("n")).first()[0] or 0
    tail = vocabulary.filter(~frequent & ~is_end).agg(
        F.sum("n").alias("n"), F.count("*").alias("v"),
        F.sum(F.when(F.col("n") == 1, 1)).alias("once"),
        F.sum(F.when(F.col("n") == 2, 1)).alias("twice")).first()
    once, twice = tail["once"] or 0, tail["twice"] or 0
    classes = min(CLASSES, max(1, tail["v"]))
    other = end + classes
    model = {"tokens": tokens, "types": types, "end": end, "other": other, "ends": ends, "classes": classes,
             "other_tokens": tail["n"] or 0, "other_types": tail["v"],
             "discount": once / (once + 2 * twice) if once else 0.5, "head_min": head_min}
    of, n, v = _columns(_class_counts(vocabulary.filter(~frequent & ~is_end), classes), "class", "n", "v")
    # of the rarer words' frequency that of unseen ones, the same in every class
    unseen = (model["discount"] * model["other_types"] + 1.0) / classes
    first = np.full(other + 1, unseen)
    first[:end + 1] = np.append(counts, ends + 1)
    first[of + other + 1] += n - model["discount"] * v
    model["first"] = first / (tokens + 2)

    model["ranked"] = np.argsort(-first[:end + 1], kind="stable")
    model["rank"] = np.argsort(model["ranked"])
    model["buckets"] = 1 + tokens // BUCKET_TOKENS
    base = np.log10((np.append(counts, ends) + 1) / (tokens + types + 1))
    encoded = staged(_encoded(docs, sc.broadcast(words), sc.broadcast(base), held_out, classes), "encoded")
    train = encoded.filter("not held_out")
    model["again"] = _repeated(train, end, model["buckets"], model["other_tokens"])
    context_min = max(MIN_CONTEXT, CONTEXT_RATE * tokens)
    pair_min = max(MIN_PAIR, PAIR_RATE * tokens)
    keys = np.arange(end)  # every frequent word
    above = sc.broadcast(first)

    def from_first(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(above.value[b.column("symbol").to_numpy()]),
                 pa.array(np.full(b.num_rows, tokens + 2))], [*b.schema.names, "p_n", "p_total"])
    parents = last_keys = None
    levels, rest = [], []
    model["often"], model["rare_pairs"] = np.zeros(2, np.uint32), []
    for d in range(1, depth + 1):
        if not len(keys):
            levels.append(_NO_LEVEL)
            continue
        pairs = staged(_next_counts(train, sc.broadcast(keys), d, end, other, model["buckets"]),
                       "next-counts")
        if d == 1:
            suffix = pairs.mapInArrow(
                from_first, "context int, symbol int, n bigint, p_n double, p_total bigint")
        else:
            # the suffix without the farthest symbol, as an index of the level above
            up = _index(last_keys, keys & ((1 << (_BITS * (d - 1))) - 1))
            link = spark.createDataFrame(pa.table({"context": pa.array(np.arange(len(keys)), pa.int32()),
                                                   "up": pa.array(up, pa.int32())}))
            totals = spark.createDataFrame(pa.table({
                "context": pa.array(np.arange(len(every)), pa.int32()),
                "p_total": pa.array(every.astype(np.int64))}))
            higher = parents.join(small_side(totals, BROADCAST_ROWS), "context").select(
                F.col("context").alias("up"), "symbol", F.col("n").alias("p_n"), "p_total")
            suffix = pairs.join(small_side(link, BROADCAST_ROWS), "context").join(
                higher.hint("shuffle_hash"), ["up", "symbol"]).select("context", "symbol", "n", "p_n", "p_total")
        kept = staged(_diverging(suffix), "retained")
        context, total, stored, varied = _columns(kept, "context", "total", "stored", "varied")
        o = np.argsort(context)
        context, total = context[o], total[o].astype(np.float64)
        # mass that goes to the shorter suffix
        down = total - stored[o] + DISCOUNT * varied[o] + 1.0
        p_context, p_symbol, p_n = _columns(pairs.filter(F.col("n") >= pair_min),
                                            "context", "symbol", "n")
        pair = (p_context.astype(np.int64) << _BITS) | p_symbol
        o = np.argsort(pair)
        pair, p_n = pair[o], p_n[o].astype(np.float64)
        state = _index(context, pair >> _BITS)
        own = state >= 0
        at, sums = _columns(pairs.groupBy("context").agg(F.sum("n").alias("n")), "context", "n")
        every, weight, below = np.zeros(len(keys)), np.zeros(len(keys)), np.zeros(len(keys))
        every[at], weight[context], below[context] = sums, total, down
        levels.append({"keys": keys[context], "total": total, "down": down,
                       "pairs": (state[own] << _BITS) | (pair[own] & _SYMBOL), "n": p_n[own],
                       # the same of all candidates; total 0: not retained
                       "all": {"keys": keys, "pairs": pair, "n": p_n, "count": every,
                               "total": weight, "down": below}})
        rest.append(pairs.filter((F.col("n") >= MIN_PAIR) & (F.col("n") < pair_min)).select(
            F.lit(d).alias("d"), "context", "symbol", "n"))
        if d == 1:
            often = pairs.filter((F.col("n") >= min(MIN_CONTEXT, TAIL_CONTEXT)) & (F.col("symbol") < end))
            model["often"] = _marks(often)
        model["rare_pairs"].append(_marks(rest[-1]))
        # longer candidates: a candidate context and a word after it, frequent enough
        c, s = _columns(pairs.filter((F.col("n") >= context_min) & (F.col("symbol") < end)),
                        "context", "symbol")
        last_keys, parents = keys, pairs
        keys = np.sort((keys[c] << _BITS) | s.astype(np.int64)) if len(c) else np.zeros(0, np.int64)
    model["levels"], model["rest"] = levels, reduce(DataFrame.unionAll, rest) if rest else None
    model["vocabulary"], model["encoded"] = vocabulary, encoded
    # buckets over which the places behind a word are spread
    model["spread"] = 1 + (model["first"][:end + 1] * model["buckets"]).astype(np.int64)
    model["tree"] = sc.broadcast(_small(model))
    return model


def _small(model: dict) -> dict:
    """What is broadcast."""
    return {**{k: v for k, v in model.items() if k not in ("vocabulary", "encoded", "rest")},
            "levels": [{"all": lv["all"]} for lv in model["levels"]]}


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(
        np.int64)


def _marks(pairs: DataFrame) -> np.ndarray:
    """A filter of (context, symbol) of one depth, of bounded size: a bit at each pair's slot."""
    bits = int(min(MARK_BITS, max(6, np.ceil(np.log2(16 * pairs.count() + 1)))))

    def run(batches):
        for b in batches:
            at = _slots((b.column("context").to_numpy().astype(np.int64) << _BITS)
                        | b.column("symbol").to_numpy(), bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at >> 5), pa.array(np.int64(1) << (at & 31))], ["place", "mark"])
    place, mark = _columns(pairs.select("context", "symbol").mapInArrow(
        run, "place bigint, mark bigint").groupBy("place").agg(
        F.bit_or("mark").alias("mark")), "place", "mark")
    out = np.zeros(1 << (bits - 5), np.uint32)
    out[place] = mark.astype(np.uint32)
    return out


def _pair_keys(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A long of two words next to each other, each a symbol or a hash."""
    u = x.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + y.astype(np.uint64)
    return ((u ^ (u >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) >> np.uint64(1)).astype(np.int64)


_KEY_BITS = 36  # by which two words are told apart for the filter


def _repeated(train: DataFrame, end: int, buckets: int, n: int) -> np.ndarray:
    """A filter, as _marks, of two words next to each other, one of them rarer, that the training
    texts have TAIL_CONTEXT times at least. ``n``: the rarer words' occurrences."""
    bits = int(min(MARK_BITS, max(6, np.ceil(np.log2(4 * n + 1)))))

    def run(batches):
        for b in (p for whole in batches for p in _pieces(whole, "ids", 4 * PIECE_TOKENS)):
            sym, place, _ = _stream(b.column("ids"), end)
            word = _named(b, sym)[0]
            before = _back(word, 1)
            at = np.flatnonzero((place >= 1) & (word != end) & ((word | before) >= _WORD_FLAG))
            key = np.sort(_slots(_pair_keys(before[at], word[at]), _KEY_BITS))
            yield _dealt((key >> (_KEY_BITS + 5 - bits)) * buckets >> (bits - 5), key)

    def add(batches):
        for _, key in _buckets(batches, 1):
            key = np.sort(key)
            at = np.unique(key[TAIL_CONTEXT - 1:][key[TAIL_CONTEXT - 1:] == key[:len(key) - TAIL_CONTEXT + 1]]
                           >> (_KEY_BITS - bits))
            own = _runs(at >> 5)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[own] >> 5), pa.array(np.bitwise_or.reduceat(np.int64(1) << (at & 31), own)
                                                  if len(own) else own)], ["place", "mark"])
    place, mark = _columns(train.select("ids", "others").mapInArrow(run, _DEALT).repartition(
        "bucket").sortWithinPartitions("bucket").mapInArrow(add, "place bigint, mark bigint"),
        "place", "mark")
    out = np.zeros(1 << (bits - 5), np.uint32)
    out[place] = mark.astype(np.uint32)
    return out


def _marked(marks: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False only for pairs that are not there."""
    at = _slots(np.maximum(keys, 0), len(marks).bit_length() + 4)
    return (marks[at >> 5] >> (at & 31).astype(np.uint32)) & 1 > 0


def _head(model: dict, symbol: np.ndarray, contexts: list[np.ndarray], rest=None):
    """Of each place: the symbol's probability after the contexts of the head, its relative
    frequency after the last of these (retained or not), the depth of the first context that is
    not of the head (0: none), and that of the first next symbol not broadcast (0: none).

    ``rest``: by depth, sorted pairs that are not broadcast, and their counts.
    """
    p = model["first"][symbol]
    q = p.copy()
    out, missing = np.zeros(len(p), np.int8), np.zeros(len(p), np.int8)
    here = np.arange(len(p))
    for d, level in enumerate(model["levels"], 1):
        level = level["all"]
        here = here[contexts[d - 1][here] >= 0]
        at = _index(level["keys"], contexts[d - 1][here])
        out[here[at < 0]] = d
        here, at = here[at >= 0], at[at >= 0]
        if not len(here):
            break
        pair = (at << _BITS) | symbol[here]
        found = np.full(len(here), -1)
        look = missing[here] == 0  # one that is not broadcast is not behind longer contexts either
        found[look] = _index(level["pairs"], pair[look])
        n = np.where(found >= 0, level["n"][found] if len(level["n"]) else 0.0, 1.0)
        lost = found < 0
        missing[here[lost & (missing[here] == 0)]] = d
        if rest is not None and lost.any():
            keys, counts = rest[d - 1]
            found = _index(keys, pair[lost])
            n[lost] = np.where(found >= 0, counts[found] if len(counts) else 0.0, 1.0)
        q[here] = n / level["count"][at]
        total = level["total"][at]
        p[here] = np.where(total > 0, (np.where(n >= MIN_PAIR, n - DISCOUNT, 0)
                                       + level["down"][at] * p[here]) / (total + 1.0), p[here])
    return p, q, out, missing


def _symbol_scores(model: dict, sym: np.ndarray, place: np.ndarray) -> np.ndarray:
    """log10 probability of each symbol after the longest retained suffix of the head before it."""
    return np.log10(_head(model, _symbols(sym, model["other"]),
                          [_contexts(sym, place, d) for d in range(1, len(model["levels"]) + 1)])[0])


def _back(sym: np.ndarray, by: int) -> np.ndarray:
    return np.concatenate((np.full(min(by, len(sym)), -1, sym.dtype), sym[:-by]))[:len(sym)]


def _named(batch: pa.RecordBatch, sym: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The symbols of a batch, the rarer words' hashes in place of -1; these words, and their places."""
    words, _ = _words(batch.column("others"))
    at = np.flatnonzero(sym < 0)
    out = sym.copy()
    out[at] = _hashes(words)
    return out, words, at


def _again(model: dict, sym: np.ndarray, word: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Of each place: False only if the training texts have the word there and the one before it
    seldom next to each other, so that no context holds the two."""
    rare, before = sym < 0, _back(word, 1)
    out = (place >= 1) & (sym != model["end"])
    rare |= _back(rare, 1)
    at = np.flatnonzero(out & rare)
    out[at] = _marked(model["again"], _pair_keys(before[at], word[at]))
    at = np.flatnonzero(out & ~rare)
    out[at] = _marked(model["often"], (before[at] << _BITS) | word[at])
    return out


def _places(model: dict, sym: np.ndarray, place: np.ndarray, again: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each symbol from the head, and whether the place is open: it needs counts
    that are not broadcast."""
    symbol = _symbols(sym, model["other"])
    contexts = [_contexts(sym, place, d) for d in range(1, len(model["levels"]) + 1)]
    p, _, out, missing = _head(model, symbol, contexts)
    one = contexts[0]
    # seldom next symbols; one seen less than twice behind a context is stored nowhere, nor behind longer ones
    need = np.zeros(len(sym), bool)
    for d, marks in enumerate(model["rare_pairs"], 1):
        at = np.flatnonzero(missing == d)
        need[at] = _marked(marks, (_index(model["levels"][d - 1]["all"]["keys"], contexts[d - 1][at]) << _BITS)
                           | symbol[at])
    # contexts that are not of the head, and may occur often enough
    two = contexts[1] if len(contexts) > 1 else np.full(len(sym), -1)
    known = _back(again, 1)
    need |= ((out == 2) & known) | ((out == 3) & known & _back(again, 2))
    # a rarer word, and one or two frequent ones after it
    if len(contexts) > 1:
        need |= (place >= 2) & (one >= 0) & (_back(sym, 2) < 0) & known
    if len(contexts) > 2:
        need |= (place >= 3) & (two >= 0) & (_back(sym, 3) < 0) & known & _back(again, 2)
    return p, need


def scores(model: dict) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    added = _dealt_places(model).mapInArrow(_bucket_sums(model), _DEALT).repartition(
        "bucket").sortWithinPartitions("bucket").mapInArrow(_added, _TEXT_SUMS)
    zero = F.lit(0.0)
    return model["encoded"].drop("ids", "others").join(added, "rid", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model["tokens"]).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
        F.coalesce("model", zero).alias("score"))


_TEXT_SUMS = "rid bigint, more_known bigint, more_base double, model double"


def _text_sums(rid: np.ndarray, known: np.ndarray, *sums: np.ndarray) -> list[np.ndarray]:
    """One entry of each text: known tokens, and the other columns' sums."""
    texts, at = np.unique(rid, return_inverse=True)
    known, *sums = (np.bincount(at, x, len(texts)) for x in (known, *sums))
    return [texts, known.astype(np.int64), *sums]


def _bucket_sums(model: dict):
    """A function over dealt rows: what they add to the texts, dealt out by text."""
    buckets = model["buckets"]
    tail, places = _tail_run(model["tree"], contexts=False), _open_run(model["tree"], contexts=False)

    def dealt(rid, known, *sums):
        # neighbours stay together
        return _dealt(_slots(rid >> 10, 30) % buckets, rid, known, *(x.view(np.int64) for x in sums))

    def run(batches):
        held = []
        for bucket, *columns in _buckets(batches, *_PLACES):
            held.append((tail if bucket < 0 else places)(*columns))
            if sum(len(x[0]) for x in held) > 4 * HELD_COUNTS:
                held = [_text_sums(*map(np.concatenate, zip(*held)))]
                if len(held[0][0]) > 2 * HELD_COUNTS:
                    yield dealt(*held.pop())
        if held:
            yield dealt(*_text_sums(*map(np.concatenate, zip(*held))))
    return run


def _added(batches):
    for _, rid, known, *sums in _buckets(batches, 4):
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in _text_sums(rid, known, *(x.view(np.float64) for x in sums))],
            ["rid", "more_known", "more_base", "model"])


_HELD = np.int64(1)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _order(first: np.ndarray, then: np.ndarray, bits: int) -> np.ndarray:
    """Order by ``first``, then by ``then``, which has so many bits."""
    if len(first) >> (63 - bits):
        return np.lexsort((then, first))
    return np.argsort((np.unique(first, return_inverse=True)[1] << bits) | then)


def _numbered(*keys: np.ndarray) -> np.ndarray:
    """The number of the run that each row belongs to."""
    out = np.zeros(len(keys[0]), np.int64)
    out[_runs(*keys)[1:]] = 1
    return np.cumsum(out)


def _tail_level(context: np.ndarray, pair: np.ndarray, train: np.ndarray, lower: np.ndarray,
                against: np.ndarray | None = None, least=TAIL_CONTEXT, weight=TAIL_WEIGHT):
    """Of one depth: whether each row's context is retained, the log10 gain of its next symbol,
    the context's occurrences, and the pair's.

    ``context`` and ``pair`` number the runs that the sorted rows belong to; ``lower`` is the
    probability of the row's next symbol after the shorter suffix, ``against`` what the
    divergence is from (``lower``, if not given); ``least`` and ``weight``, the least occurrences
    and the weight of the shorter suffix, may differ by row.
    """
    starts = _runs(pair)
    n = np.add.reduceat(train.astype(np.int64), starts)  # of each pair
    of, p = context[starts], lower[starts].astype(np.float64)
    to = p if against is None else against[starts]
    size = int(context[-1]) + 1
    begin = _runs(context)
    least, weight = (np.broadcast_to(x, len(context))[begin] for x in (least, weight))
    total = np.bincount(of, n, size)
    k = np.bincount(of, n > 0, size)
    seen = np.maximum(n, 1)
    d = np.bincount(of, np.where(n > 0, n * np.log(seen / np.maximum(total[of], 1) / to), 0), size)
    stored = n >= TAIL_PAIR
    kept = ((total >= least) & (2 * d > k + 3 * np.sqrt(2.0 * k))
            & (d >= MIN_DIVERGENCE * total) & (np.bincount(of, stored, size) > 0))
    down = total - np.bincount(of, np.where(stored, n - DISCOUNT, 0), size) + weight
    gain = np.log10((np.where(stored, n - DISCOUNT, 0) / p + down[of]) / (total + weight)[of])
    spread = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(pair))))
    return kept[context], gain[spread], total[context], n[spread]


def _longer(at: np.ndarray, context: np.ndarray, before: np.ndarray, symbol: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray]:
    """The rows ``at`` in the order of their contexts, numbered, each with the word before it, and
    of their next symbols; and the numbers of these longer contexts."""
    key = _pair_keys(context, before)
    slot = _slots(key, 63 - _BITS)
    by = np.argsort((slot << _BITS) | symbol)
    if ((np.diff(slot[by]) == 0) & (np.diff(key[by]) != 0)).any():  # two contexts of one slot
        by = np.lexsort((symbol, before, context))
    return at[by], _numbered(context[by], before[by])


def _tail_run(tree, contexts: bool):
    """A function over the rare words of a bucket, the symbol after each and its text: what each
    adds to its text, or the retained contexts."""
    def run(c, symbol, two, third, texts):
        m = tree.value
        tokens, types, single, discount = (m[k] for k in ("tokens", "types", "first", "discount"))
        unseen = (discount * m["other_types"] + 1.0) / (types + 1.0)
        encoded = texts.dictionary_encode()
        code = encoded.indices.to_numpy().astype(np.int64)
        by = np.argsort((code << (_BITS + 1)) | symbol)
        word, c, first, two, third = code[by], c[by], symbol[by], two[by], third[by]
        train, context = (c & _HELD) == 0, word
        kept, gain, total, _ = _tail_level(word, _numbered(word, first), train, single[first])
        if contexts:
            own = _runs(word)
            own = own[kept[own]]
            return pa.RecordBatch.from_arrays(
                [encoded.dictionary.take(pa.array(word[own])).cast(pa.binary()),
                 pa.nulls(len(own), pa.int64()), pa.nulls(len(own), pa.int32()),
                 pa.array(total[own].astype(np.int64))], _CONTEXTS)
        gain = np.where(kept, gain, 0)
        lower = np.log10(single[first])
        for before in (two, third):
            at = np.flatnonzero(before >= 0)
            if not len(at):
                break
            at, number = _longer(at, context[at], before[at], first[at])
            kept, more, _, _ = _tail_level(number, _numbered(number, first[at]), train[at],
                                           10.0 ** (lower[at] + gain[at]))
            gain[at] += np.where(kept, more, 0)
            context = np.full(len(c), -1)
            context[at] = number
        # its own frequency in its class
        mass = single[m["other"] + 1 + _classes(_hashes(encoded.dictionary.cast(pa.binary())), m["classes"])[word]]
        own = np.log10(np.where(total > 0, total - discount, unseen) / (tokens + 2) / mass)
        base = np.log10((total + 1) / float(tokens + types + 1))
        return c >> 1, total > 0, base, own + gain
    return run


_CONTEXTS = ["word", "hash", "symbol", "total"]


def tail_contexts(model: dict) -> DataFrame:
    """The retained contexts of the tail: word, the symbol of the frequent word after it (null:
    the word alone), and their occurrences in training texts."""
    tail, places = _tail_run(model["tree"], contexts=True), _open_run(model["tree"], contexts=True)

    def run(batches):
        for bucket, *columns in _buckets(batches, *_PLACES):
            yield (tail if bucket < 0 else places)(*columns)

    def hashed(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("word"), pa.array(_hashes(b.column("word")))],
                                             ["name", "hash"])
    found = staged(_dealt_places(model).mapInArrow(
        run, "word binary, hash bigint, symbol int, total bigint"), "tail-contexts")
    words = model["vocabulary"].select("word").mapInArrow(hashed, "name binary, hash bigint")
    return found.filter("word is not null").select("word", "symbol", "total").unionAll(
        found.filter("word is null").join(words, "hash").select(
            F.col("name").alias("word"), "symbol", "total"))


# ---------------------------------------------------------------- open places

_WORD_FLAG = 1 << 62  # of a rarer word's hash in place of a symbol
_TEXTS = -1000  # of a text's sum
_SHIFT = 24  # of the last word's rank, above the next symbol's
_PLACES = 4, 5  # columns of longs of a bucket of open places, and of rare words
_LONG_WORD = 64  # bytes


def _hashes(words: pa.Array) -> np.ndarray:
    """62 bits of each word's hash, and the flag."""
    at, text = _bytes(words)
    sizes, text = np.diff(at), np.concatenate((text, np.zeros(8, np.uint8)))
    every = np.ndarray(len(text) - 7, np.uint64, text, strides=(1,))  # 8 bytes from each place on
    h, here = sizes.astype(np.uint64), np.arange(len(sizes))
    for i in np.flatnonzero(sizes > _LONG_WORD):
        h[i] = int.from_bytes(blake2b(words[i].as_py(), digest_size=8).digest(), "little")
    here = here[sizes <= _LONG_WORD]
    for k in range(0, _LONG_WORD, 8):
        here = here[sizes[here] > k]
        beyond = np.maximum(8 - (sizes[here] - k), 0).astype(np.uint64) * np.uint64(8)
        x = h[here] ^ (every[at[here] + k] & (~np.uint64(0) >> beyond))
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
        h[here] = x ^ (x >> np.uint64(31))
    return ((h & np.uint64(_WORD_FLAG - 1)) | np.uint64(_WORD_FLAG)).astype(np.int64)


def _ranked(symbols: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The symbols' ranks by their frequency, of which most bytes are 0; all but those of frequent
    words and the end are left alone."""
    return np.where((symbols >= 0) & (symbols < len(rank)), rank[np.clip(symbols, 0, len(rank) - 1)], symbols)


def _bucket(model: dict, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Of places behind the words ``two`` (or -1) and ``one``."""
    part = _slots(two, 30) % model["spread"][one]
    return (_slots(one, 30) + part) % model["buckets"]


def _dealt_places(model: dict) -> DataFrame:
    """The open places, the next symbols that are not broadcast, and rare words, dealt out to
    buckets, and what the other places add to each text.

    A place: the word before the last (a symbol, a rarer word's hash, or -1); the last one, the
    next symbol and the third last; its text and whether that is held out. All places behind
    the same two words are in one bucket. A pair: context and symbol, its count, -depth; it goes
    where its context's places may be. A text: its sum, _TEXTS. Rare words are in buckets below 0:
    text and whether that is held out, the symbol after it, the word.
    """
    tree = model["tree"]

    def places(batches):
        m = tree.value
        # places behind frequent words only, other places, rare words: by themselves they pack better
        held = [], [], []
        for b in (p for whole in batches for p in _pieces(whole, "ids", 4 * PIECE_TOKENS)):
            sym, place, sizes = _stream(b.column("ids"), m["end"])
            symbol = _symbols(sym, m["other"])
            word, words, at = _named(b, sym)
            again = _again(m, sym, word, place)
            p, still = _places(m, sym, place, again)
            p[still] = 1  # added in the buckets
            rid = b.column("rid").to_numpy()
            known = np.add.reduceat(np.log10(p), np.cumsum(sizes) - sizes)
            none = np.zeros(len(rid), np.int64)
            yield _dealt(np.full(len(rid), rid[0] % m["buckets"]), rid, known.view(np.int64),
                         none + _TEXTS, none)
            text = np.repeat((rid << 1) | b.column("held_out").to_numpy(
                zero_copy_only=False).astype(np.int64), sizes)

            def before(at, k, told):
                return np.where(told & (place[at] >= k), word[np.maximum(at - k, 0)], -1)
            deep = len(m["levels"])
            # an end follows at least; words that no context of the place can begin with are -1
            two = before(at, 1, again[at] if deep > 1 else False)
            third = before(at, 2, (two >= 0) & again[at - 1] if deep > 2 else False)
            held[2].append((-1 - _slots(word[at], 30) % m["buckets"], text[at], symbol[at + 1], two, third,
                            words))
            at = np.flatnonzero(still)
            one, two = (before(at, k, True) for k in (1, 2))
            bucket = _bucket(m, one, two)
            two[~again[at - 1]] = -1
            third = before(at, 3, (two >= 0) & (again[at - 2] if deep > 2 else False))
            rare = (two >= _WORD_FLAG) | (third >= _WORD_FLAG)
            columns = (bucket, _ranked(two, m["rank"]), (m["rank"][one] << _SHIFT)
                       | _ranked(symbol[at], m["rank"]), text[at], _ranked(third, m["rank"]))
            held[0].append([x[~rare] for x in columns])
            held[1].append([x[rare] for x in columns])
            for own in held:
                if sum(len(x[0]) for x in own) > 2 * HELD_COUNTS:
                    yield joined(own)
                    own.clear()
        yield from map(joined, filter(None, held))

    def joined(held):
        *columns, last = zip(*held)
        columns = [np.concatenate(x) for x in columns]
        if isinstance(last[0], pa.Array):
            return _dealt(*columns, words=pa.concat_arrays(last))
        bucket, two, packed, _ = columns
        # neighbours of one bucket with the same words before them pack better
        by = np.argsort((bucket << (_BITS + _SHIFT)) | (packed >> _SHIFT << _SHIFT) | (two & ((1 << _SHIFT) - 1))
                        ) if bucket.max(initial=0) < 1 << (63 - _BITS - _SHIFT) else None
        return _dealt(*columns, np.concatenate(last), by=by)

    def pairs(batches):
        m = tree.value
        for b in (b for b in batches if b.num_rows):
            d, context, symbol, n = (c.to_numpy().astype(np.int64) for c in b.columns)
            pair = (context << _BITS) | symbol
            for depth in np.unique(d):
                own = np.flatnonzero(d == depth)
                key = m["levels"][depth - 1]["all"]["keys"][context[own]]
                one, two = key & _SYMBOL, (key >> _BITS) & _SYMBOL
                if depth > 1:
                    bucket = _bucket(m, one, two)
                else:  # to all buckets of the word
                    many = m["spread"][one]
                    own = np.repeat(own, many)
                    part = np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many)
                    bucket = (_slots(np.repeat(one, many), 30) + part) % m["buckets"]
                yield _dealt(bucket, pair[own], n[own], -d[own], np.zeros(len(own), np.int64))
    out = model["encoded"].select("rid", "held_out", "ids", "others").mapInArrow(places, _DEALT)
    if model["rest"] is not None:
        out = out.unionAll(model["rest"].mapInArrow(pairs, _DEALT))
    return out.repartition("bucket").sortWithinPartitions("bucket")


def _open_run(tree, contexts: bool):
    """A function over a bucket's places and pairs: what each adds to its text, or the retained
    contexts of a rarer word and a frequent one."""
    def run(two, packed, c, third):
        m = tree.value
        rest = []
        for d in range(1, len(m["levels"]) + 1):
            own = np.flatnonzero(c == -d)
            own = own[np.argsort(two[own])]
            rest.append((two[own], packed[own].astype(np.float64)))
        own = np.flatnonzero(c == _TEXTS)
        texts, whole = two[own], packed[own].view(np.float64)
        own = np.flatnonzero(c >= 0)
        own = own[_order(two[own], packed[own], _SHIFT + _BITS)]  # last word and next symbol
        two, packed, c, third = two[own], packed[own], c[own], third[own]
        rid, train = c >> 1, (c & _HELD) == 0
        one, symbol = m["ranked"][packed >> _SHIFT], _ranked(packed & ((1 << _SHIFT) - 1), m["ranked"])
        two, third = _ranked(two, m["ranked"]), _ranked(third, m["ranked"])
        rare, rare3 = two >= _WORD_FLAG, third >= _WORD_FLAG
        key2 = np.where(rare | (two < 0), -1, (two << _BITS) | one)
        key3 = np.where((key2 < 0) | (third < 0) | rare3, -1, (third << (2 * _BITS)) | key2)
        p, q, out, _ = _head(m, symbol, [one, key2, key3][:len(m["levels"])], rest)
        sums = np.log10(p)

        def level(by, context, rare):
            lower = 10.0 ** sums[by]
            kept, gain, total, n = _tail_level(
                context, _numbered(context, symbol[by]), train[by], lower,
                np.where(rare, lower, q[by]), np.where(rare, TAIL_CONTEXT, MIN_CONTEXT),
                np.where(rare, TAIL_WEIGHT, 1.0))
            sums[by] += np.where(kept, gain, 0)
            q[by] = np.maximum(n, 1) / np.maximum(total, 1)
            own = _runs(context)
            own = own[kept[own] & rare[own]]
            return by[own], total[own]
        at = np.flatnonzero((out == 2) | (rare if len(m["levels"]) > 1 else False))
        found = level(at, _numbered(two[at], one[at]), rare[at]) if len(at) else (at, at)
        if contexts:
            return pa.RecordBatch.from_arrays(
                [pa.nulls(len(found[0]), pa.binary()), pa.array(two[found[0]]),
                 pa.array(one[found[0]].astype(np.int32)), pa.array(found[1].astype(np.int64))],
                _CONTEXTS)
        at = np.flatnonzero((out == 3) | ((third >= 0) & ((out == 2) | rare | rare3)))
        if len(m["levels"]) > 2 and len(at):
            at, context = _longer(at, _numbered(two, one)[at], third[at], symbol[at])
            level(at, context, (rare | rare3)[at])
        rid, sums = np.concatenate((rid, texts)), np.concatenate((sums, whole))
        none = np.zeros(len(rid))
        return rid, none, none, sums
    return run


def op3_lm_score(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return scores(learn(docs, crc_remainder("doc_id", 7) == 2))
