"""Fill-in-the-middle: brute force over odd rows, exact round trips, piece-table properties."""

import hashlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillstream.llm import fim


def plainly(doc_id, text):
    """The contract, step by step, on Python strings."""
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        form, out = "plain", text
    elif h4 % 100 < 20:
        form, out = "spm", "<S>" + text[b:] + "<P>" + text[:a] + "<M>" + text[a:b]
    else:
        form, out = "psm", "<P>" + text[:a] + "<S>" + text[b:] + "<M>" + text[a:b]
    cuts = (None, None) if form == "plain" else (a, b - a)
    return (doc_id, n, form, *cuts, out,
            hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def _rows(df):
    cols = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256",
            "restored_sha256"]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_odd_rows_equal_brute_force(odd):
    want = sorted((plainly(r.doc_id, r.text) for r in odd.collect()), key=repr)
    assert _rows(fim.transform(odd, digests=True)) == want


def test_every_form_and_sentinels_in_texts(spark):
    texts = ["a<P>b", "<M>", "x <S", "P>", "<", ">", "<P", "S><", "é<🙂>ß", "<<P", "M>M>"]
    rows = [(i, t) for i, t in enumerate(texts * 12)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    got = _rows(fim.transform(docs, digests=True))
    assert got == sorted((plainly(*r) for r in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    made = fim.transform(docs)
    back = made.select("doc_id", fim.restored(made).alias("text"))
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_empty_table_and_types(none, spark):
    assert fim.transform(none, digests=True).collect() == []
    ids = spark.createDataFrame([("a", "some text"), ("b", None)], "doc_id string, text string")
    out = fim.transform(ids, output=False, digests=True)
    assert dict(out.dtypes)["doc_id"] == "string" and "output" not in out.columns
    assert {r.doc_id: r.n for r in out.collect()} == {"a": 9, "b": 0}


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40), st.integers(0, 60), st.integers(0, 60), st.sampled_from(["psm", "spm"]))
def test_cut_arrange_restore_is_exact(text, first, second, form):
    if any(m in text for m in fim.SENTINELS):
        return
    a, b = sorted((first % (len(text) + 1), second % (len(text) + 1)))
    raw = text.encode()
    ends = [len(text[:k].encode()) for k in (a, b)]
    buffers = (raw, fim.SENTINEL_BUFFER)
    pieces = fim.arrange(fim.parts_at([(fim.TEXT, 0, len(raw))] if raw else [], *ends), form)
    out = b"".join(fim.stream(pieces, buffers))
    p, m, s = text[:a], text[a:b], text[b:]
    assert out.decode() == (f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}")
    assert fim.digest(pieces, buffers) == hashlib.sha256(out).hexdigest()
    assert b"".join(fim.stream(fim.restore(out, form), (out,))) == raw


def test_split_of_many_descriptors():
    pieces = [(0, 5, 3), (1, 0, 4), (0, 9, 2)]
    for at in range(10):
        left, right = fim.split(pieces, at)
        assert sum(d[2] for d in left) == min(at, 9) and all(d[2] for d in left + right)
        assert sum(d[2] for d in left + right) == 9


@pytest.mark.parametrize("cut", [0, 2, 5])
def test_buffer_of_a_sliced_column(cut):
    column = pa.array(["ab", "", "çd", "e", "", "fgh"]).slice(cut)
    data, offsets = fim.text_buffer(column)
    got = [bytes(data[a:b]).decode() for a, b in zip(offsets, offsets[1:])]
    assert got == column.to_pylist()
