"""Fill-in-the-middle transformation by piece tables.

A document is a list of descriptors (buffer, start, length) over immutable
buffers: the text's UTF-8 bytes as they lie in the Arrow batch, and one buffer of
the sentinels. Two cuts split the descriptors into prefix, middle and suffix, an
arrangement permutes these parts behind their sentinels, and hashes or the output
stream the descriptors in order: no part is copied before that. To restore, the
output is a buffer of its own: its sentinels are found from the left, the
descriptors between them are the arranged parts, and the inverse permutation puts
them back. A text that holds a sentinel is left plain, so the sentinels of an
output are its own (none can arise across a boundary, as each begins with "<",
ends with ">" and has neither within).

Forms: ``plain`` (the text), ``psm`` (prefix, suffix, middle) and ``spm`` (suffix,
prefix, middle). The cuts and the form come from the first four 8-digit groups of
the sha256 of "<seed>:<id>", so they do not depend on partitioning, and reruns
agree. The job has no shuffle; a task holds one Arrow batch and one output text.

Defined results: a null or empty text is empty, ``plain`` and has no cuts; a null
id counts as empty text in the hash; repeated rows, and texts under one id, get the
same draw and one row each; a text of any length is one row, cut where the draw
says; there are no ties; other columns are ignored; an empty table gives an empty
table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import load

PLAIN_PERCENT = 10
SPM_PERCENT = 20
SEED = "1"

SENTINELS = ("<P>", "<S>", "<M>")
SENTINEL_BUFFER = "".join(SENTINELS).encode()
#: Parts in output order, each behind its sentinel; parts are 0 prefix, 1 middle, 2 suffix.
FORMS = {"psm": (("<P>", 0), ("<S>", 2), ("<M>", 1)),
         "spm": (("<S>", 2), ("<P>", 0), ("<M>", 1))}
TEXT, SENTINEL = 0, 1

Descriptor = tuple[int, int, int]


def split(pieces: list[Descriptor], at: int) -> tuple[list[Descriptor], list[Descriptor]]:
    """The descriptors of the first ``at`` bytes, and of the rest; at most one is split."""
    left: list[Descriptor] = []
    for i, (buffer, start, length) in enumerate(pieces):
        if at < length:
            rest = [(buffer, start + at, length - at), *pieces[i + 1:]]
            return left + ([(buffer, start, at)] if at else []), rest
        left.append((buffer, start, length))
        at -= length
    return left, []


def parts_at(pieces: list[Descriptor], first: int, second: int) -> list[list[Descriptor]]:
    """Prefix, middle and suffix of a document cut at two byte offsets."""
    head, suffix = split(pieces, second)
    return [*split(head, first), suffix]


def sentinel(mark: str) -> Descriptor:
    return SENTINEL, SENTINEL_BUFFER.index(mark.encode()), len(mark)


def arrange(parts: list[list[Descriptor]], form: str) -> list[Descriptor]:
    """The parts permuted as the form says, each behind its sentinel."""
    return [d for mark, k in FORMS[form] for d in (sentinel(mark), *parts[k])]


def stream(pieces: list[Descriptor], buffers: tuple) -> Iterator[memoryview]:
    for buffer, start, length in pieces:
        yield memoryview(buffers[buffer])[start:start + length]


def digest(pieces: list[Descriptor], buffers: tuple) -> str:
    h = hashlib.sha256()
    for view in stream(pieces, buffers):
        h.update(view)
    return h.hexdigest()


def restore(output: bytes, form: str) -> list[Descriptor]:
    """Descriptors over an output (buffer 0) that give the original text."""
    if form == "plain":
        return [(TEXT, 0, len(output))]
    marks = [m.encode() for m, _ in FORMS[form]]
    ends, at = [], 0
    for m in marks:
        at = output.index(m, at) + len(m)
        ends.append(at)
    stops = [*(e - len(m) for e, m in zip(ends[1:], marks[1:])), len(output)]
    arranged = [[(TEXT, a, b - a)] for a, b in zip(ends, stops)]
    order = [k for _, k in FORMS[form]]
    inverse = sorted(range(len(order)), key=order.__getitem__)
    return [d for k in inverse for d in arranged[k]]


def _draw(key: str, n: int, holds_sentinel: bool, plain_percent: int,
          spm_percent: int) -> tuple[str, int, int]:
    """Form, and the code points at which prefix and middle end."""
    h1, h2, h3, h4 = (int(key[i:i + 8], 16) for i in range(0, 32, 8))
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n or holds_sentinel or h3 % 100 >= 100 - plain_percent:
        return "plain", 0, 0
    return ("spm" if h4 % 100 < spm_percent else "psm"), first, second


def text_buffer(column: pa.Array) -> tuple[memoryview, list[int]]:
    """The bytes of a string column without nulls, and the offsets of its values in them."""
    if not len(column):
        return memoryview(b""), [0]
    offsets = pa.Array.from_buffers(
        pa.int64() if pa.types.is_large_string(column.type) else pa.int32(), len(column) + 1,
        [None, column.buffers()[1]], offset=column.offset).to_pylist()
    return memoryview(column.buffers()[2] or b""), offsets


def _byte_at(raw: bytes, text: str, at: int) -> int:
    return at if len(raw) == len(text) else len(text[:at].encode())


def _keyed(docs: DataFrame, id_col: str, text_col: str, seed: str) -> DataFrame:
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.sha2(key.cast("binary"), 256).alias("key"))


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = SEED,
              plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT,
              output: bool = True, digests: bool = False) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n, form, prefix_chars, middle_chars, then
    ``output`` (the text to train on) and/or ``output_sha256`` and ``restored_sha256``
    (of the text rebuilt from the output)."""
    keyed = _keyed(docs, id_col, text_col, seed)
    fields = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(),
              "middle_chars": pa.int64()}
    if output:
        fields["output"] = pa.string()
    if digests:
        fields |= {"output_sha256": pa.string(), "restored_sha256": pa.string()}

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        data, offsets = text_buffer(batch.column("text"))
        buffers = (data, SENTINEL_BUFFER)
        for i, key in enumerate(batch.column("key").to_pylist()):
            start, length = offsets[i], offsets[i + 1] - offsets[i]
            raw = bytes(data[start:start + length])
            text = raw.decode()
            n = len(text)
            form, first, second = _draw(key, n, any(m in text for m in SENTINELS),
                                        plain_percent, spm_percent)
            pieces = [(TEXT, start, length)] if length else []
            if form != "plain":
                pieces = arrange(parts_at(pieces, _byte_at(raw, text, first),
                                          _byte_at(raw, text, second)), form)
            made = raw if form == "plain" else b"".join(stream(pieces, buffers))
            row = (n, form) + ((None, None) if form == "plain" else (first, second - first))
            if output:
                row += (made.decode(),)
            if digests:
                row += (digest(pieces, buffers), digest(restore(made, form), (made,)))
            yield row

    def run(batches):
        for b in batches:
            columns = list(zip(*rows(b))) or [()] * len(fields)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, fields.values())]],
                ["doc_id", *fields])
    kinds = {pa.int64(): "bigint", pa.string(): "string"}
    schema = ", ".join([f"doc_id {keyed.schema['doc_id'].dataType.simpleString()}",
                        *[f"{c} {kinds[t]}" for c, t in fields.items()]])
    return keyed.mapInArrow(run, schema)


def restored(rows: DataFrame, output_col: str = "output", form_col: str = "form") -> Column:
    """The original text, rebuilt from the columns of an output and its form (native)."""
    out, form = F.col(output_col), F.col(form_col)

    def between(start: str, end: str | None) -> Column:
        tail = F.substr(out, F.locate(start, out) + F.lit(len(start)))
        return tail if end is None else F.substring_index(tail, end, 1)
    psm = F.concat(between("<P>", "<S>"), between("<M>", None),
                   F.substring_index(between("<S>", None), "<M>", 1))
    spm = F.concat(between("<P>", "<M>"), between("<M>", None), between("<S>", "<P>"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(out)


def op11_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    return transform(load(spark, sf_dir, "documents"), output=False, digests=True)


OP11_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h
           FROM documents),
u AS (SELECT doc_id, t, length(t) AS n,
             CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
             CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
      FROM d),
c AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                       OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
      FROM u),
o AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM c),
w AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                          ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS output FROM o),
k AS (SELECT *, strpos(output, '<P>') AS ip, strpos(output, '<S>') AS i_s, strpos(output, '<M>') AS im FROM w)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
       sha256(output) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN output
                        WHEN 'psm' THEN substr(output, 4, i_s - 4) || substr(output, im + 3)
                                        || substr(output, i_s + 3, im - i_s - 3)
                        ELSE substr(output, ip + 3, im - ip - 3) || substr(output, im + 3)
                             || substr(output, 4, ip - 4) END) AS restored_sha256
FROM k"""
