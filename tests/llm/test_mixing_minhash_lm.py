import glob
import hashlib
import math
import os
import tempfile
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tillstream.llm import minhash, mixing, suffix_lm
from tillstream.llm.common import crc_remainder, load

COLUMNS = ["doc_id", "size", "source_size", "target", "taken"]


# -- mixing

def by_sql(docs):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toPandas().astype(
        {"doc_id": "Int64"}))
    return sorted(map(str, con.sql(mixing.OP9_SQL).fetchall()))


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.select(*COLUMNS).collect())


def test_mix_equals_sql(spark, odd, none):
    assert rows_of(mixing.mix(odd)) == by_sql(odd)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = rows_of(mixing.mix(docs.repartition(7)))
    assert got == by_sql(docs) == rows_of(mixing.mix(docs))
    assert mixing.mix(none).count() == 0 and mixing.mixed(none).count() == 0


def test_levels_reach_the_same_cut(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(
        "doc_id", "text", (crc_remainder("doc_id", 2) * 0).cast("string").alias("source"))
    two = docs.withColumn("source", (crc_remainder("doc_id", 2)).cast("string"))
    monkeypatch.setattr(mixing, "RANGE_ROWS", 1)  # finest ranges, level by level
    assert rows_of(mixing.mix(two)) == by_sql(two)
    assert rows_of(mixing.mix(docs)) == by_sql(docs)


def test_targets_and_budgets(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 400, None: 77}
    rows = [(i, " ".join(["w"] * 5), s) for s, n in sizes.items() for i in range(n // 5)]
    rows.append((0, "w w", None))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = mixing.mix(docs).collect()
    words = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in sizes}
    order = [*sorted(s for s in sizes if s), None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free = {}, set(order)
    while True:  # reshare the excess until none is above its cap
        left = sum(words.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * words[s]}
        if not over:
            break
        target |= {s: 3 * words[s] for s in over}
        free -= over
    target |= share
    for s in sizes:
        own = [r for r in out if r["source"] == s]
        assert all(abs(r["target"] - target[s]) < 1e-6 for r in own)
        assert abs(sum(r["taken"] for r in own) - target[s]) <= 1 + len(own)
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in own)


def test_mixed_rows(odd):
    out = mixing.mixed(odd)
    assert out.columns == [c for c in odd.columns if c != "taken"] + ["taken"]
    assert all(r["taken"] > 0 for r in out.collect())


# -- MinHash

def plain_shingles(text):
    w = text.encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_edits_equal_brute_force(spark, odd, none):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts[3], texts[9], texts[20] = None, "", "one two"
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(6, "text")
    got = {r["doc_id"]: r for r in minhash.edited(docs).collect()}
    assert len(got) == len(texts)
    plain = [t or "" for t in texts]
    for i, t in enumerate(plain):
        following = plain[(i + 1) % len(plain)]
        q = len(t) // 4
        edit = t[:len(t) - q] + following[:q]
        r = got[i]
        assert r["n_chars"] == len(t)
        assert r["edit"] == bytearray(hashlib.sha256(edit.encode()).digest())
        own, other = minhash.signatures([t.encode(), edit.encode()])
        assert bytes(r["sig"]) == own.tobytes() and bytes(r["edited_sig"]) == other.tobytes()
        assert r["near_edited"] == (own == other).mean()
        assert r["near_next"] == (own == minhash.signatures([following.encode()])[0]).mean()
    # null doc_ids first, several texts and repeated rows under one id
    assert minhash.edited(odd).count() == odd.count()
    assert minhash.edited(none).count() == 0
    one = minhash.edited(odd.filter("doc_id = 6")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_ids_of_any_type(spark):
    texts = {"b": "one two three four five six", "a": "one two three four five six seven",
             "100": "another text", "c": None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string").repartition(3)
    got = {r["doc_id"]: r for r in minhash.fingerprints(docs).collect()}
    assert set(got) == set(texts) and got["100"]["n_similar"] == 0 and got["a"]["n_similar"] is None
    order = sorted(texts)
    for i, own in enumerate(order):
        text, after = texts[own] or "", texts[order[(i + 1) % 4]] or ""
        cut = len(text) // 4
        edit = text[:len(text) - cut] + after[:cut]
        assert got[own]["edited_sha256"] == hashlib.sha256(edit.encode()).hexdigest()


def test_signatures_estimate_jaccard():
    rng = np.random.default_rng(0)
    base = [f"w{i}" for i in rng.integers(0, 10_000, 400)]
    for cut in (20, 100, 200):
        a, b = " ".join(base), " ".join(base[cut:])
        x, y = plain_shingles(a), plain_shingles(b)
        s = minhash.signatures([a.encode(), b.encode()])
        assert abs((s[0] == s[1]).mean() - len(x & y) / len(x | y)) < 0.15
    assert (minhash.signatures([b"", b" \n"])[0] == minhash.signatures([b""])[0]).all()


def test_search_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    texts = []
    for g in range(8):
        base = [f"g{g}w{i}" for i in rng.integers(0, 500, 120)]
        for k in range(6):
            t = list(base)
            for j in rng.integers(0, 120, k):
                t[j] = f"new{g}{k}{j}"
            texts.append(" ".join(t))
    texts += [texts[0], "", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    prints = minhash.edited(docs).select("doc_id", "sig")
    rows = minhash.search(docs, prints, prints["doc_id"] % 2 == 0).collect()
    found = {(r["q_id"], r["id"]): r["jaccard"] for r in rows}
    assert len(found) == len(rows)  # each pair once
    sig = [int(np.uint64(xxhash.xxh64_intdigest(s.tobytes(), 42)).astype(np.int64))
           for s in minhash.signatures([(t or "").encode() for t in texts])]
    sets = [plain_shingles(t or "") for t in texts]
    want = {}
    for i in range(0, len(texts), 2):
        for j in range(len(texts)):
            if sig[i] != sig[j] and sets[i] and sets[j]:
                s = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
                if s >= 0.8:
                    want[sig[i], sig[j]] = s
    assert found.keys() <= want.keys() and len(found) >= 0.95 * len(want) > 20
    assert all(abs(found[k] - want[k]) < 1e-9 for k in found)
    monkeypatch.setattr(minhash, "BROADCAST_ROWS", 0)  # every join shuffled
    shuffled = minhash.search(docs, prints, prints["doc_id"] % 2 == 0).collect()
    assert {(r["q_id"], r["id"]): r["jaccard"] for r in shuffled} == found


# -- language model

@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = suffix_lm.learn(docs, crc_remainder("doc_id", 7) == 2)
    return docs.collect(), model, {r["doc_id"]: r for r in suffix_lm.scores(model).collect()}


def tokens_of(text):
    return (text or "").encode().lower().split() + [b""]


def test_base_equals_brute_force(scored):
    docs, _, got = scored
    counts = Counter()
    for r in docs:
        if zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2:
            counts.update(tokens_of(r["text"]))
    n, v = sum(counts.values()), len(counts)
    for r in docs:
        t, g = tokens_of(r["text"]), got[r["doc_id"]]
        assert g["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
        assert (g["n_tokens"], g["n_known"], g["train_tokens"]) == (
            len(t), sum(counts[w] > 0 for w in t), n)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t)
        assert abs(g["base_score"] - base) < 1e-6 * abs(base)


def test_model_beats_the_base(scored):
    _, _, got = scored
    for part in (True, False):
        rows = [r for r in got.values() if r["held_out"] == part]
        assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_distributions_sum_to_one(scored):
    _, model, _ = scored
    assert model["levels"], "no context was retained"
    symbols = np.arange(model["other"] + 1)
    assert abs(model["first"].sum() - 1) < 1e-9
    level = model["levels"][0]
    for key in level["keys"][:3]:
        sym = np.stack([np.full(len(symbols), key), np.where(symbols == model["other"], -1, symbols)],
                       axis=1).ravel().astype(np.int64)
        place = np.tile([0, 1], len(symbols))
        p = 10 ** suffix_lm._symbol_scores(model, sym, place)[1::2]
        assert abs(p.sum() - 1) < 1e-6
    # behind "other words": seen ones discounted, unseen ones share the rest
    mass = model["other_tokens"] + 1
    seen = (model["other_tokens"] - model["discount"] * model["other_types"]) / mass
    unseen = (model["discount"] * model["other_types"] + 1) / mass
    assert abs(seen + unseen - 1) < 1e-9


def test_retained_contexts_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(suffix_lm, "MIN_CONTEXT", 5)
    text = "a b a b a c a b d d a b " * 6
    docs = spark.createDataFrame([(i, text) for i in range(4)], "doc_id bigint, text string")
    model = suffix_lm.learn(docs, crc_remainder("doc_id", 7) == 9)
    words = sorted({w for w in text.encode().split()})
    stream = [tokens_of(text)] * 4
    for d, level in enumerate(model["levels"], 1):
        follow, parent = {}, {}
        for t in stream:
            for i in range(d, len(t)):
                follow.setdefault(tuple(t[i - d:i]), Counter())[t[i]] += 1
            for i in range(d - 1, len(t)):
                parent.setdefault(tuple(t[i - d + 1:i]), Counter())[t[i]] += 1
        want = set()
        for c, nxt in follow.items():
            n, up = sum(nxt.values()), parent[c[1:]]
            m = sum(up.values())
            if d == 1:  # single frequencies count the end and other words once more
                up, m = up + Counter({b"": 1}), m + 2
            gain = sum(k * math.log((k / n) / (up[w] / m)) for w, k in nxt.items())
            k = len(nxt)
            if n >= 5 and 2 * gain > k + 3 * math.sqrt(2 * k) and gain >= 0.01 * n:
                want.add(sum(words.index(w) << 20 * (d - 1 - j) for j, w in enumerate(c)))
        assert set(level["keys"].tolist()) == want


def test_lm_odd_rows(odd, none):
    model = suffix_lm.learn(odd, crc_remainder("doc_id", 7) == 2)
    rows = suffix_lm.scores(model).collect()
    assert len(rows) == odd.count()
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in rows)
    assert all(r["n_tokens"] == 1 for r in rows if r["doc_id"] in (3, 4, 5))
    assert suffix_lm.scores(suffix_lm.learn(none, crc_remainder("doc_id", 7) == 2)).count() == 0
    unlearned = suffix_lm.scores(suffix_lm.learn(odd, crc_remainder("doc_id", 1) == 0)).collect()
    assert all(abs(r["score"] - r["n_tokens"] * math.log10(0.5)) < 1e-6 for r in unlearned)
    assert {r["base_score"] for r in unlearned} == {0.0} and {r["n_known"] for r in unlearned} == {0}


def test_texts_of_one_signature_are_all_linked(spark, odd, none, monkeypatch):
    base = [f"w{i}" for i in range(200)]
    near = [*base[:100], "changed", *base[101:]]
    texts = {50: " ".join(base), 51: " ".join(base).upper(), 52: "  ".join(base),
             53: " ".join(base), 100: " ".join(near), 101: "\n".join(near), 150: "", 151: " \n",
             200: "quite another text that stands alone here"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: r for r in minhash.fingerprints(docs).collect()}
    assert len(got) == len(texts)
    a, b = {got[i]["class"] for i in range(50, 54)}, {got[i]["class"] for i in (100, 101)}
    assert len(a) == len(b) == 1 and a != b
    assert {i: r["n_similar"] for i, r in got.items()} == {
        50: 5, 51: None, 52: None, 53: None, 100: 5, 101: None, 150: 0, 151: None, 200: 0}
    assert set(got[50]["similar_classes"]) == b and set(got[100]["similar_classes"]) == a
    assert got[200]["similar_classes"] == [] and got[51]["similar_classes"] is None
    assert minhash.fingerprints(odd).count() == odd.count()
    assert minhash.fingerprints(none).count() == 0
    # a text that is not similar to its signature's representative is a class of its own
    every = minhash.edited(docs).select("doc_id", "sig", "th")
    rep = {r["r"] for r in every.groupBy("sig").agg(F.min("th").alias("r")).collect()}
    alone = {r["th"] for r in minhash.apart(docs, every, similarity=1.01).collect()}
    assert alone == {r["th"] for r in every.collect() if r["doc_id"] not in (150, 151)} - rep
    monkeypatch.setattr(minhash, "apart", lambda d, p: every.filter("doc_id = 51").select("th"))
    split = {r["doc_id"]: r["id"] for r in minhash.classes(docs, every).collect()}
    assert split[50] == split[52] == split[53] != split[51]


def every_context(rows, model, fold):
    """Score of every text, token by token, from the head's levels, and the retained contexts with a rarer word."""
    bits, other, end = suffix_lm._BITS, model["other"], model["end"]
    texts = [tokens_of(r.text) for r in rows]
    train = [zlib.crc32(str(r.doc_id).encode()) % 7 != fold for r in rows]
    counts = Counter(w for t, own in zip(texts, train) if own for w in t)
    head = {w: i for i, w in enumerate(sorted(
        w for w, n in counts.items() if w and n >= model["head_min"]))} | {b"": end}
    levels = [({k: i for i, k in enumerate(lv["keys"].tolist())},
               dict(zip(lv["pairs"].tolist(), lv["n"].tolist())), lv) for lv in model["levels"]]
    rare = sorted({w for t in texts for w in t} - head.keys())
    symbol = head | {w: other - h % model["classes"] for w, h in zip(
        rare, suffix_lm._hashes(pa.array(rare, pa.binary())).tolist())}
    total, discount = model["tokens"] + 2, model["discount"]
    unseen = (discount * model["other_types"] + 1) / total
    mass = Counter()
    for w in counts.keys() - head.keys():
        mass[symbol[w]] += (counts[w] - discount) / total
    for x in range(end + 1, other + 1):
        assert abs(mass[x] + unseen / model["classes"] - model["first"][x]) < 1e-9

    def from_head(sym, i):
        p = model["first"][sym[i]]
        for d, (keys, pairs, lv) in enumerate(levels, 1):
            if i < d or max(sym[i - d:i]) > end:
                break
            key = 0
            for x in sym[i - d:i]:
                key = key << bits | x
            if key in keys:
                at = keys[key]
                n = pairs.get(at << bits | sym[i], 0)
                p = (max(n - suffix_lm.DISCOUNT, 0) + lv["down"][at] * p) / (lv["total"][at] + 1)
        return p
    symbols = [[symbol[w] for w in t] for t in texts]
    places = [[from_head(s, i) for i in range(len(s))] for s in symbols]
    every, w = {}, suffix_lm.TAIL_WEIGHT
    for depth in range(1, len(levels) + 1):
        follow, given = {}, {}
        for t, s, p, own in zip(texts, symbols, places, train):
            for j in range(depth, len(s)):
                if max(s[j - depth:j]) > end:
                    c = tuple(t[j - depth:j])
                    given[c, s[j]] = p[j]
                    if own:
                        follow.setdefault(c, Counter())[s[j]] += 1
        kept = {}
        for c, nxt in follow.items():
            n, k = sum(nxt.values()), len(nxt)
            d = sum(x * math.log(x / n / given[c, y]) for y, x in nxt.items())
            stored = {y: x - suffix_lm.DISCOUNT for y, x in nxt.items() if x >= suffix_lm.TAIL_PAIR}
            if n >= suffix_lm.TAIL_CONTEXT and stored and d >= 0.01 * n and 2 * d > k + 3 * math.sqrt(2 * k):
                kept[c] = n, stored
        for t, s, p in zip(texts, symbols, places):
            for j in range(depth, len(s)):
                if (c := tuple(t[j - depth:j])) in kept:
                    n, stored = kept[c]
                    p[j] = (stored.get(s[j], 0) + (n - sum(stored.values()) + w) * p[j]) / (n + w)
        every |= {c: n for c, (n, _) in kept.items()}
    out = [sum(map(math.log10, p)) + sum(math.log10(
        (counts[x] - discount if counts[x] else unseen * total / (model["types"] + 1)) / total / model["first"][y])
        for x, y in zip(t, s) if y > end) for t, s, p in zip(texts, symbols, places)]
    return out, every, head


def plain_scores(rows, model, fold):
    """Score and tail contexts of every text."""
    out, every, head = every_context(rows, model, fold)
    return out, {c[:1] + tuple(head[x] for x in c[1:]): n for c, n in every.items()
                 if len(c) < 3 and c[0] not in head and (len(c) == 1 or c[1] in head)}


def test_scores_and_tail_contexts_equal_brute_force(spark, scored):
    rows, model, got = scored
    want, kept = plain_scores(rows, model, 2)
    assert len(kept) > 100
    for r, x in zip(rows, want):
        assert abs(got[r.doc_id].score - x) < 1e-5 * got[r.doc_id].n_tokens + 1e-6
    tail = suffix_lm.tail_contexts(model).collect()
    assert {(bytes(r.word),) if r.symbol is None else (bytes(r.word), r.symbol): r.total
            for r in tail} == kept and len(tail) == len(kept)


def test_rarer_words_anywhere_in_contexts(spark):
    """Rarer words count at every place of a context, and as what follows it."""
    rng = np.random.default_rng(5)
    frequent, rare = [f"f{i}" for i in range(12)], [f"r{i}" for i in range(900)]
    texts = [" ".join(rng.choice(frequent, 30)) for _ in range(60)] + [
        "f1 ra rb f3", "f2 ra rb f4", "rc ra rb f5"] * 3
    mixed = [[str(rng.choice(frequent if rng.random() < 0.6 else rare)) for _ in range(40)] for _ in range(30)]
    again = [" ".join(t) for t in mixed for _ in range(2)]
    once = [" ".join(rng.permutation(t)) for t in mixed]
    rows = [(i, t) for i, t in enumerate(texts + again + once)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = suffix_lm.learn(docs, crc_remainder("doc_id", 7) == 9)
    got = {r.doc_id: r.score for r in suffix_lm.scores(model).collect()}
    want, kept, head = every_context(docs.collect(), model, 9)
    shapes = {"".join("fr"[x not in head] for x in c) for c in kept}
    assert shapes == {"r", "fr", "rf", "rr", "ffr", "frf", "frr", "rff", "rfr", "rrf", "rrr"}
    for (i, t), x in zip(rows, want):
        assert abs(got[i] - x) < 1e-5 * len(t.split())
    # a text that occurs twice scores apart from the same words in another order
    first = len(texts) + len(again)
    assert min(got[i] for i in range(len(texts), first)) > max(got[i] for i in range(first, len(rows)))


def test_seldom_contexts_of_frequent_words_count(spark):
    """Two occurrences of a context are enough, whether its words are frequent or not."""
    rng = np.random.default_rng(6)
    texts = [" ".join(f"f{x}" for x in rng.integers(0, 120, 40)) for _ in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts + texts[:20])), "doc_id bigint, text string")
    model = suffix_lm.learn(docs, crc_remainder("doc_id", 7) == 9)
    got = {r.doc_id: r.score / r.n_tokens for r in suffix_lm.scores(model).collect()}
    assert model["end"] == 120
    assert min(got[i] for i in range(20)) > max(got[i] for i in range(20, 120)) + 0.5


def test_tail_over_small_batches_and_ties(spark, scored):
    """The groups of a word may reach over several Arrow batches."""
    _, model, got = scored
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        again = {r.doc_id: r.score for r in suffix_lm.scores(model).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert all(abs(again[i] - r.score) < 1e-6 for i, r in got.items())


def test_the_tree_grows_with_the_corpus(spark):
    """Ten times the corpus: several times the contexts, and the held-out texts gain by them."""
    size = {}
    for sf in ("sf0.01", "sf0.1"):
        docs = load(spark, f"/root/testdata/{sf}", "documents")
        model = suffix_lm.learn(docs, crc_remainder("doc_id", 7) == 2)
        size[sf] = (sum(len(lv["keys"]) for lv in model["levels"])
                    + suffix_lm.tail_contexts(model).count())
        if sf == "sf0.1":
            held = suffix_lm.scores(model).where("held_out").agg(
                F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
            assert held[0] / held[2] > -4.0 > held[1] / held[2]
    assert size["sf0.1"] > 4 * size["sf0.01"] > 10_000


def test_scores_do_not_depend_on_what_is_broadcast(spark, scored, monkeypatch):
    """Contexts and next symbols below the rates are counted all the same, in many buckets."""
    _, model, got = scored
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    tail = sorted(map(str, suffix_lm.tail_contexts(model).collect()))
    for contexts, pairs, bucket in ((1e-3, 1e-3, 9_000), (2e-4, 0, 500_000), (0, 4e-5, 30_000)):
        monkeypatch.setattr(suffix_lm, "CONTEXT_RATE", contexts)
        monkeypatch.setattr(suffix_lm, "PAIR_RATE", pairs)
        monkeypatch.setattr(suffix_lm, "BUCKET_TOKENS", bucket)
        few = suffix_lm.learn(docs, crc_remainder("doc_id", 7) == 2)
        assert sum(len(lv["pairs"]) for lv in few["levels"]) < sum(
            len(lv["pairs"]) for lv in model["levels"])
        for r in suffix_lm.scores(few).collect():
            assert abs(r.score - got[r.doc_id].score) < 1e-9 * abs(r.score)
        assert sorted(map(str, suffix_lm.tail_contexts(few).collect())) == tail


def test_learning_leaves_no_shuffle_files(spark):
    """A step's shuffle files go with the step: the disk holds one step's, not all steps'."""
    root = os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", tempfile.gettempdir())

    def files():
        return set(glob.glob(f"{root}/**/blockmgr-*/*/shuffle_*.data", recursive=True))
    docs = spark.createDataFrame([(i, f"a b c d{i % 7} a b " * 9) for i in range(50)],
                                 "doc_id bigint, text string").repartition(3)
    docs.groupBy("text").count().write.format("noop").mode("overwrite").save()
    before = files()
    assert before, "no shuffle file is seen here"
    model = suffix_lm.learn(docs, crc_remainder("doc_id", 7) == 2)
    until = time.time() + 20  # files go in the background
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert suffix_lm.scores(model).count() == 50


def test_words_and_hashes_of_odd_bytes():
    texts = [b"", b" \t ", b"\x0bAb  \xc3\x84B\xff\r\ncd\x0c", b"one", b"\xc2\xa0x \x1fy"]
    column = pa.array([b"cut off", *texts], pa.binary()).slice(1)
    words, sizes = suffix_lm._words(column)
    assert words.to_pylist() == [w for t in texts for w in t.lower().split()]
    assert sizes.tolist() == [len(t.split()) for t in texts]
    names = [b"x" * i for i in range(1, 140)] + [b"\0" * i for i in range(1, 140)] + [
        b"x" * 8 + bytes([i]) for i in range(100)]
    hashes = suffix_lm._hashes(pa.array([b"zz", *names, b"x"], pa.binary()).slice(1))
    assert len(set(hashes.tolist())) == len(set(names)) and hashes[0] == hashes[-1]
    assert (hashes >= suffix_lm._WORD_FLAG).all()
