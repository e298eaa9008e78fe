"""Packing: exact token round trip, one window for each id, little padding, the capacity tree."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillstream.llm import packing
from tillstream.llm.common import load

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [1]


def check(pieces, docs, plain, capacity=2048):
    """Every id in one piece, gapless sequences, digests; returns padded places and all ids."""
    ids = [(d, plain(t)) for d, t in docs]
    left = defaultdict(list)  # documents of one id and length may be swapped
    for d, x in ids:
        left[d, len(x)].append(x)
    by_doc = defaultdict(list)
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
        by_doc[p.doc_id, p.doc_tokens].append(p)
    padding = 0
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        at = 0
        for p in own:
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= capacity
        if at & (at - 1):
            padding += capacity - at
    assert sorted(by_doc, key=repr) == sorted(left, key=repr)
    for key, own in by_doc.items():
        for x in left[key]:
            at = 0
            while at < len(x):
                match = next(p for p in own if p.start == at and p.ids_crc32 == zlib.crc32(
                    np.array(x[at:at + p.length], "<u4").tobytes()))
                own.remove(match)
                at += match.length
        assert not own
    return padding, sum(len(x) for _, x in ids)


def test_odd_rows(odd, plain):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    pieces = packing.pack(odd, with_ids=True)
    padding, total = check(pieces.collect(), docs, plain)
    assert padding <= packing.SLACK * (total // 2048 + 12)
    whole = packing.sequences(pieces).collect()
    assert sum(len(r.ids) for r in whole) == total
    for r in whole:
        assert len(r.ids) == sum(p.length for p in r.pieces)
        assert r.padding == (0 if len(r.ids) & (len(r.ids) - 1) == 0 else 2048 - len(r.ids))


def test_query_over_the_whole_table(spark, plain):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in load(spark, sf, "documents").collect()]
    out = packing.op12_pack(spark, sf)
    assert out.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens",
                               "sequence_id", "offset"]
    padding, total = check(out.collect(), docs, plain)
    assert padding < 0.005 * total


def test_many_partitions_and_small_bounds(spark, plain):
    rng = random.Random(5)
    words = "alpha beta  gamma\n delta, 12345 éü 汉字 🙂 \t".split(" ")
    docs = [(i % 50, " ".join(rng.choices(words, k=rng.randrange(0, 900)))) for i in range(120)]
    df = spark.createDataFrame(docs, "doc_id int, text string").repartition(7)
    out = packing.pack(df, capacity=256, slack=0, max_open=4)
    padding, total = check(out.collect(), docs, plain, 256)
    assert padding == 0


def test_empty_table_and_capacity(none):
    assert packing.pack(none).collect() == []
    with pytest.raises(ValueError):
        packing.pack(none, capacity=1000)


def test_ids_equal_the_tokenizers_library(plain):
    encode = packing.text_encoder(open(PATH).read())
    texts = ["", " ", "a  b", "\n\nx\n", "<|endoftext|> a<|endoftext|>", "it's 12ab!?   x",
             " " * 300_000, "a" * 300_000]
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 64):
        texts.append("".join(f"a{chr(c)}1 {chr(c)} {chr(c)}{chr(c)}!\n{chr(c)}x  {chr(c)}"
                             for c in points[i:i + 64]))
    t = Tokenizer.from_file(PATH)
    want = t.encode_batch_fast(texts, add_special_tokens=False)
    assert all(encode(x).tolist() == w.ids for x, w in zip(texts, want))


def test_other_files_are_read_by_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    assert packing.byte_ranks(open(path).read()) is None
    text = "Some words, twice: some WORDS"
    assert packing.text_encoder(open(path).read())(text).tolist() == Tokenizer.from_file(
        path).encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 40)), max_size=200))
def test_tree_takes_the_tightest_window(steps):
    tree, held = packing.CapacityTree(40), []
    for add, size in steps:
        if add:
            tree.add(size, size)
            held.append(size)
        else:
            fits = [h for h in held if h >= size]
            got = tree.take(size)
            assert got == ((min(fits), min(fits)) if fits else None)
            if fits:
                held.remove(min(fits))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 200), max_size=40), max_size=4), st.integers(0, 6),
       st.integers(0, 5))
def test_packer_keeps_every_id_and_pads_little(blocks, slack, max_open):
    packer, number, total = packing.Packer(64, slack, max_open), 0, 0
    for block in blocks:
        items = []
        for n in block:
            items.append(packing.Item(number, 0, n, np.arange(total, total + n, dtype=np.uint32)))
            number, total = number + 1, total + n
        packer.add(items)
        assert packer.open <= max(max_open, 1)
    packer.finish()
    seen = np.concatenate([np.empty(0, np.uint32)] + [x.ids for s in packer.done for x in s])
    assert sorted(seen.tolist()) == list(range(total))
    for s in packer.done:
        used = sum(len(x.ids) for x in s)
        assert used & (used - 1) == 0 or 64 - slack <= used <= 64


def test_whole_documents_when_they_fit():
    """Best-fit decreasing: 40 + 24, 30 + 20 + 14 fill two windows of 64 without a cut."""
    packer = packing.Packer(64, 0, 8)
    packer.add([packing.Item(n, 0, n, np.zeros(n, np.uint32)) for n in (14, 40, 20, 30, 24)])
    packer.finish()
    assert sorted(sorted(x.doc for x in s) for s in packer.done) == [[14, 20, 30], [24, 40]]
