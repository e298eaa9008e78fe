import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tillstream.llm import simhash_dedup as S
from tillstream.llm.components import components


def union_find(nodes, edges):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\v\f\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("bits", [0, 1, 3, 6])
def test_links_equal_brute_force(spark, bits):
    rng = random.Random(bits)
    prints = {0, (1 << 64) - 1}
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(12):
            x = base
            for _ in range(rng.randrange(5)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    prints = sorted(prints)
    df = spark.createDataFrame([(signed(x),) for x in prints], "fp bigint")
    found = sorted(tuple(sorted(r)) for r in S.links(df, bits).collect())
    want = sorted(tuple(sorted((signed(a), signed(b)))) for i, a in enumerate(prints)
                  for b in prints[:i] if (a ^ b).bit_count() <= bits)
    assert found == want  # each pair once


def test_manhattan_is_a_lower_bound(spark):
    rng = np.random.default_rng(3)
    rows = [(int(a), int(b)) for a, b in rng.integers(-(1 << 63), 1 << 63, (200, 2))]
    df = spark.createDataFrame(rows, "a bigint, b bigint")
    got = df.select("a", "b", F.bit_count(S._embedding("a").bitwiseXOR(S._embedding("b")))
                    .alias("l1")).collect()
    for r in got:
        counts = [[(x >> i & 3).bit_count() for i in range(0, 64, 2)]
                  for x in (r["a"] % (1 << 64), r["b"] % (1 << 64))]
        assert r["l1"] == sum(abs(p - q) for p, q in zip(*counts))
        assert r["l1"] <= (r["a"] % (1 << 64) ^ r["b"] % (1 << 64)).bit_count()


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    edges += [(1000, 1000 + i) for i in range(1, 60)] + [(2000 + i, 2001 + i) for i in range(40)]
    df = spark.createDataFrame(edges + [(7, 7), (None, 3)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    nodes = {x for e in edges for x in e}
    want = union_find(nodes, edges)
    size = defaultdict(int)
    for r in want.values():
        size[r] += 1
    assert got == {n: r for n, r in want.items() if size[r] > 1}
    assert components(df.limit(0)).count() == 0


def expected_components(rows):
    """(doc_id, text) -> component_id of each row, by brute force."""
    prints = [plain_fingerprint(t) for _, t in rows]
    edges = [(i, j) for i in range(len(rows)) for j in range(i)
             if (prints[i] ^ prints[j]).bit_count() <= 3]
    root = union_find(range(len(rows)), edges)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root[i]] = min(d, least.get(root[i], d))
    return prints, [least.get(root[i]) for i in range(len(rows))], root


def test_classes_equal_brute_force(spark, odd, none):
    for docs in (odd, spark.read.parquet("/root/testdata/sf0.001/documents.parquet")):
        rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        prints, component, _ = expected_components(rows)
        want = sorted((str(d), signed(p), str(c)) for (d, _), p, c in zip(rows, prints, component))
        got = sorted((str(r["doc_id"]), r["fp"], str(r["component_id"]))
                     for r in S.classes(docs).collect())
        assert got == want
    assert S.classes(none).count() == 0


def test_long_runs_of_one_shingle():
    text = ("a b c " * 5000 + "x y z").encode()
    assert int(S.simhash64([text, b"", text])[0]) == plain_fingerprint(text.decode())
    assert list(S.simhash64([])) == []


def test_keep_one(odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    _, component, root = expected_components(rows)
    kept = S.keep_one(odd)
    assert kept.columns == odd.columns and kept.dtypes == odd.dtypes
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    groups = defaultdict(list)
    for row, c, r in zip(rows, component, root.values()):
        groups[r].append((row, c))
    assert len(got) == len(groups)
    for group in groups.values():
        may = [row for row, c in group if row[0] == c]
        assert sum(row in may for row in got) >= 1
    assert S.keep_one(none).count() == 0
