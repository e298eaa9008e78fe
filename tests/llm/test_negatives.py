"""Hard negatives: brute force on odd, tied and skewed rows; the R-tree's packing and bounds."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillstream.llm import negatives as N

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, scale=256, low=30, high=90, n_pos=5, n_neg=10):
    """The contract over Python integers."""
    part = []
    for i, e, label in rows:
        if label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        part.append((i, label, tuple(math.floor(scale * float(np.float32(x))) for x in e)))
    out = []
    last = (1 << 63) - 1

    def ranked(found, k):
        return sorted(found, key=lambda f: (-f[0], last if f[1] is None else f[1]))[:k]
    for a in sorted({r for r in part if r[0] is not None and r[0] % 100 == 0}):
        scored = [(sum(x * y for x, y in zip(a[2], r[2])), r[0], r[1]) for r in part
                  if r != a and len(r[2]) == len(a[2])]
        for p, pid, _ in ranked([s for s in scored if s[2] == a[1]], n_pos):
            fit = [s for s in scored if s[2] != a[1] and low * p <= 100 * s[0] <= high * p]
            for k, (s, nid, _) in enumerate(ranked(fit, n_neg), 1):
                out.append((a[0], pid, k, nid, p, s))
    return sorted(out, key=repr)


def mined(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    q = N.quantized(df, label=label)
    out = N.hard_negatives(q, q.where(F.col("id") % 100 == 0))
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                           "negative_score"]
    return sorted(map(tuple, out.collect()), key=repr)


def vectors(n, dim, seed, labels=4):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, .3) + (i % labels == 0) for _ in range(dim)], rng.randrange(labels))
            for i in range(n)]


def test_equals_brute_force(spark):
    rows = vectors(700, 6, 1)
    got = mined(spark, rows)
    assert got == brute(rows) and len(got) > 200


def test_odd_rows(spark):
    """Nulls, other lengths, ties, repeated rows and anchors, empty vectors."""
    nan, inf = float("nan"), float("inf")
    rows = vectors(220, 3, 2, labels=2)
    rows += [(300, [1.0, 2.0, 3.0], None), (None, [1.0, 1.0, 1.0], 0), (None, [2.0, 0.0, 1.0], 1),
             (400, None, 1), (500, [1.0, None, 0.0], 1), (600, [nan, 1.0, 0.0], 1),
             (700, [inf, 0.0, 0.0], 0), (800, [1.0, 2.0], 0), (801, [2.0, 1.0], 0),
             (802, [1.0, 1.5], 1), (803, [1.0, 1.0], 1), (900, [], 1), (901, [], 1), (902, [], 0),
             (1000, [1.0, 1.0, 1.0], 0), (1000, [1.0, 1.0, 1.0], 0), (1000, [1.0, 0.5, 1.0], 1)]
    rows += [(i, [0.5, 0.5, 0.5], i % 3) for i in range(1001, 1040)]
    # a repeated anchor is searched once: equal copies are itself
    got = mined(spark, rows)
    assert got == brute(rows)
    assert any(r[0] == 900 for r in got) and any(r[3] is None or r[1] is None for r in got)


def test_components_beyond_doubles_are_exact(spark):
    rows = [(i, [float(2 ** 40 + i * 2 ** 20), float(i)], i % 2) for i in range(40)] + [
        (100, [float(2 ** 20), 3.0], 0), (200, [1e30, 0.0], 1)]
    got = [r for r in mined(spark, rows) if r[0] == 100]
    assert got == [r for r in brute(rows) if r[0] == 100 and abs(r[4]) < 1 << 63]


def test_one_label_and_hot_copies(spark):
    """A third of the rows are one vector; one label holds most rows."""
    rows = [(i, [1.0, 0.0, 0.25], 0) for i in range(300)] + [
        (i, [math.sin(i), math.cos(i), 0.5], 0 if i % 9 else 1) for i in range(300, 900)]
    assert mined(spark, rows) == brute(rows)


def test_empty_and_lonely(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []


def test_many_blocks_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ANCHORS", 2)
    monkeypatch.setattr(N, "TILE_ROWS", 40)
    rows = [(i * 10, e, label) for i, e, label in vectors(600, 4, 3)]
    assert mined(spark, rows) == brute(rows)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(0, 5), st.integers(1, 20), st.integers(0, 5))
def test_packing_and_intervals(n, dim, page, seed):
    rng = np.random.default_rng(seed)
    v = rng.integers(-300, 300, (n, dim))
    pages = N.str_order(v, page)
    assert sorted(np.concatenate(pages).tolist()) == list(range(n))
    assert max(map(len, pages)) <= page and len(pages) <= 4 * math.ceil(n / page)
    rows = [dict(label=int(k % 3), width=8, lo=v[p].min(axis=0).astype("<i8").tobytes(),
                 hi=v[p].max(axis=0).astype("<i8").tobytes(), ids=p.astype(np.int64).tobytes(),
                 vectors=v[p].astype("<i8").tobytes()) for k, p in enumerate(pages)]
    tree = N.Tree(rows, dim, True)
    q = rng.integers(-300, 300, (3, dim)).astype(float)
    low, high = tree.intervals(q)
    scores = q @ v.T
    for k, p in enumerate(pages):
        assert (scores[:, p] >= low[:, [k]]).all() and (scores[:, p] <= high[:, [k]]).all()
    assert (high[:, tree.root] >= scores.max(axis=1)).all()
    windows = [(-5000, 20000), (0, 0), (-math.inf, math.inf)]
    for i in range(3):
        got = tree.search(q[i], low[i], high[i], windows, 4, None, 1, None)
        own = [(int(scores[i, r]), int(r)) for k, p in enumerate(pages) if k % 3 != 1 for r in p]
        for w, g in zip(windows, got):
            assert g == sorted((x for x in own if w[0] <= x[0] <= w[1]),
                               key=lambda x: (-x[0], x[1]))[:4]


def test_far_boxes_are_not_opened():
    """Best-first: with clustered rows only a few pages are read."""
    rng = np.random.default_rng(0)
    v = np.concatenate([rng.integers(-20, 20, (64, 2)) + np.array([c, -c]) * 1000
                        for c in range(-20, 20)])
    pages = N.str_order(v, 64)
    rows = [dict(label=0, width=8, lo=v[p].min(axis=0).astype("<i8").tobytes(),
                 hi=v[p].max(axis=0).astype("<i8").tobytes(), ids=p.astype(np.int64).tobytes(),
                 vectors=v[p].astype("<i8").tobytes()) for p in pages]
    tree = N.Tree(rows, 2, True)
    opened = []

    class Counted(list):
        def __getitem__(self, k):
            opened.append(k)
            return list.__getitem__(self, k)
    tree.vectors = Counted(tree.vectors)
    q = np.array([1.0, 0.0])
    low, high = (x[0] for x in tree.intervals(q[None]))
    got = tree.search(q, low, high, [(-math.inf, math.inf)], 5, 0, None, None)[0]
    assert [s for s, _ in got] == sorted(v[:, 0].tolist(), reverse=True)[:5]
    assert len(opened) <= 4


@pytest.mark.parametrize("scale", [1.0, 256.0])
def test_extra_columns_are_ignored(spark, scale):
    df = spark.createDataFrame([(1, [0.5], 1, "x", 2, 3)],
                               "vec_id int, embedding array<double>, label int, id string, "
                               "v int, tile int")
    assert N.quantized(df, scale=scale).collect()[0].asDict() == {
        "id": 1, "label": 1, "v": [math.floor(scale * 0.5)]}
