import random

from tillstream.llm import decontaminate as D

BENCH = "item_id bigint, text string, doc_id string"


def words(n, seed):
    rng = random.Random(seed)
    return [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]


def multiset_jaccard(a, b):
    from collections import Counter
    a, b = Counter(a), Counter(b)
    return sum((a & b).values()) / sum((a | b).values())


def grams(ws, k=5):
    return [tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)]


def test_planted_passages(spark):
    item, short, other = words(60, 1), ["alpha", "beta", "gamma"], words(25, 2)
    bench = spark.createDataFrame([
        (1, " ".join(item), None), (2, " ".join(item).upper() + "!", "x"),  # equal after folding
        (3, "Alpha, beta gamma.", None), (4, " ".join(other), None), (5, "", None),
        (6, None, None), (7, "--- !!", None)], BENCH)
    changed = item[:30] + ["zzz"] + item[31:]  # 51 of 56 shingles left
    two = item[:10] + ["y1"] + item[11:40] + ["y2"] + item[41:]
    inserted = item[:30] + ["extra"] + item[30:]
    texts = {
        10: words(40, 3) + item + words(30, 4),
        11: [w.upper() + "," for w in item],
        12: words(9, 5) + changed,
        13: two + words(5, 6),
        14: words(200, 7),
        15: ["x", "alpha", "beta,", "Gamma", "y"],
        16: words(100, 8) + other[:24],  # clipped at the end of the text
        17: inserted,
        18: item + words(3, 9) + other + item,
        19: item[:20],
    }
    rows = [(d, " ".join(t)) for d, t in texts.items()] + [
        (None, " ".join(item)), (20, None), (21, ""), (10, "a clean text with the id of a leak")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in D.leaks(docs, bench).collect()}
    assert multiset_jaccard(grams(changed), grams(item)) >= 0.8
    assert multiset_jaccard(grams(two), grams(item)) < 0.8
    assert set(got) == {(10, 1), (11, 1), (12, 1), (15, 3), (16, 4), (17, 1), (18, 1), (18, 4),
                        (None, 1)}
    assert got[10, 1]["start"] == 40 and got[10, 1]["n_words"] == 60 and got[10, 1]["bits"] == 0
    assert abs(got[12, 1]["similarity"] - multiset_jaccard(grams(changed), grams(item))) < 1e-9
    clean = D.decontaminated(docs, bench)
    assert sorted(r["doc_id"] for r in clean.collect()) == [10, 13, 14, 19, 20, 21]


def test_hamming_blocks_find_all(spark):
    rng = random.Random(4)
    left = [(rng.getrandbits(64) - (1 << 63), 1) for _ in range(60)]
    right = []
    for x, _ in left:
        y = x % (1 << 64)
        for b in rng.sample(range(64), rng.randrange(0, 24)):
            y ^= 1 << b
        right.append((y - (1 << 64) if y >> 63 else y, 1))
    a = spark.createDataFrame(left, "fp bigint, k int")
    b = spark.createDataFrame(right, "r_fp bigint, k int")
    for radius in (0, 5, 16):
        got = sorted((r["fp"], r["r_fp"], r["bits"])
                     for r in D.within_radius(a, b, radius, ["k"]).collect())
        want = sorted((x, y, n) for x, _ in left for y, _ in right
                      if (n := ((x ^ y) % (1 << 64)).bit_count()) <= radius)
        assert got == want


def test_simhash_is_the_weighted_majority(spark):
    rng = random.Random(6)
    rows = [(i % 3, rng.getrandbits(64) - (1 << 63), rng.randrange(1, 5)) for i in range(90)]
    got = {r["g"]: r for r in D.simhash(spark.createDataFrame(
        rows, "g int, h bigint, c bigint"), ["g"]).collect()}
    for g in range(3):
        own = [(h % (1 << 64), c) for k, h, c in rows if k == g]
        total = sum(c for _, c in own)
        want = sum(1 << b for b in range(64) if 2 * sum(c for h, c in own if h >> b & 1) > total)
        assert got[g]["fp"] % (1 << 64) == want and got[g]["total"] == total


def test_whole_tables_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    import re
    fold = lambda t: re.findall(r"[^\W_]+", t.lower())
    items = {r["item_id"]: fold(r["text"]) for r in bench.collect()}
    want = set()
    for r in docs.collect():
        text = " " + " ".join(fold(r["text"])) + " "
        want |= {(r["doc_id"], i) for i, ws in items.items() if " " + " ".join(ws) + " " in text}
    found = D.leaks(docs, bench)
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert want <= got and want
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_rows(odd, none, spark):
    bench = spark.createDataFrame([(1, "the cat sat on the mat and looked at the dog", None),
                                   (None, "one", None)], BENCH)
    found = D.leaks(odd, bench)
    assert sorted(str(r["doc_id"]) for r in found.collect()) == ["1", "2", "7", "None"]
    clean = D.decontaminated(odd, bench)
    assert clean.columns == odd.columns and clean.count() == odd.count() - 5
    assert D.decontaminated(odd, bench.limit(0)).count() == odd.count()
    assert D.decontaminated(none, bench).count() == 0


def test_no_pair_at_the_threshold_is_lost(spark):
    """Passages with replaced words, similarities around 0.8: exactly those at 0.8 or more are
    found, however many bits of their fingerprints differ."""
    rng = random.Random(11)
    items = {i: words(rng.randrange(13, 120), 100 + i) for i in range(40)}
    rows, want, far = [], {}, 0
    for d in range(400):
        i = rng.randrange(40)
        own = list(items[i])
        m = len(own) - 4
        for at in rng.sample(range(len(own)), rng.choice([1, 2, 2, 3]) if m > 40 else 1):
            own[at] = f"q{rng.randrange(10 ** 9)}"
        s = multiset_jaccard(grams(own), grams(items[i]))
        rows.append((d, " ".join(words(rng.randrange(30), 900 + d) + own + words(5, 5000 + d))))
        if s >= 0.8:
            want[d, i] = s
    bench = spark.createDataFrame([(i, " ".join(w), None) for i, w in items.items()], BENCH)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for radius in (D.RADIUS, 0):
        found = {(r["doc_id"], r["item_id"]): r for r in D.leaks(docs, bench, radius=radius).collect()}
        assert set(found) == set(want) and len(want) > 100
        assert all(abs(found[k]["similarity"] - s) < 1e-9 for k, s in want.items())
        far = sum(r["bits"] > radius for r in found.values())
        assert far > 0, "some pairs lie beyond the radius"
    # windows placed by one item are compared with every similar item of their size, even
    # where that item's own anchors lie elsewhere in it
    base = words(64, 77)
    shifted = {1: base[:60], 2: base[2:62], 3: base[4:64]}
    bench = spark.createDataFrame([(i, " ".join(w), None) for i, w in shifted.items()], BENCH)
    docs = spark.createDataFrame([(1, " ".join(shifted[1]))], "doc_id bigint, text string")
    want = {i for i, w in shifted.items() if multiset_jaccard(grams(shifted[1]), grams(w)) >= 0.8}
    assert {r["item_id"] for r in D.leaks(docs, bench).collect()} == want == {1, 2, 3}
