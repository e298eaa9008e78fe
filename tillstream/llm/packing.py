"""Packing of tokenized documents into training windows by best-fit decreasing.

A document is its token ids and an end id. Overlong documents are first cut into
full windows; what remains of a document (less than a window) is an item. Items of
a block are placed in order of decreasing length, each into the open window with
the least room that still holds it, found in a segment tree over the remaining
capacities. Windows with at most ``slack`` free places are closed and padded; the
others stay open for the next block of the task. So that no window is padded by
more, the ones still open at the end (or when too many are open) are completed:
the emptiest ones are taken apart and their items, cut where needed, fill the
others; the one window left over is cut into sequences whose lengths are powers of
two, which need no padding.

The job has no shuffle: every task packs its own partition. It holds one bounded
piece of a batch (``PIECE_BYTES`` of text, or one document) and at most ``MAX_OPEN``
open windows. ``sequence_id`` carries the task's partition number in its high bits; for
the same input partitioning reruns agree.

Tokens are those of the ``tokenizers`` file. Where that file is a plain byte-level BPE
whose merges are in id order, the ``tiktoken`` library computes the same ids from its
vocabulary, about four times faster (tests compare the two over every code point);
any other file is read by ``tokenizers`` itself.

Defined results: a null or empty text has the end id alone; a text of any length
is whole in its pieces; repeated rows are packed each on its own; equal lengths are
taken in input order; a null id is kept; other columns are ignored; an empty table
gives an empty table. Every id lies in exactly one piece.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import load

CAPACITY = 2048
END_ID = 1
SLACK = 8
MAX_OPEN = 512
PIECE_BYTES = 8 << 20


#: Fixed value: the split pattern of a byte-level BPE pre-tokenizer.
SPLIT_PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


def byte_ranks(tokenizer_json: str) -> tuple[list[bytes], dict[str, int]] | None:
    """The tokens' bytes in merge order and the special tokens, or None if the file is no
    plain byte-level BPE."""
    spec = json.loads(tokenizer_json)
    model, split, added = spec["model"], spec.get("pre_tokenizer") or {}, spec["added_tokens"]
    if (model.get("type") != "BPE" or spec.get("normalizer") or split.get("type") != "ByteLevel"
            or split.get("add_prefix_space") or not split.get("use_regex", True)
            or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges",
                                          "end_of_word_suffix", "byte_fallback"))
            or any(a.get(k) for a in added for k in ("lstrip", "rstrip", "single_word",
                                                      "normalized"))):
        return None
    # printable bytes stand for themselves, the others for code points from 256 on
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown}
    byte |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)).difference(shown)))}
    special = {a["content"]: a["id"] for a in added}
    ids = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
    ranks = sorted(ids, key=ids.__getitem__)
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    same = (sorted(ids.values()) == list(range(len(ids))) and len(ids) == 256 + len(merges)
            and all(model["vocab"][a + b] == 256 + i for i, (a, b) in enumerate(merges)))
    return (ranks, special) if same else None


def text_encoder(tokenizer_json: str):
    """A function from a text to its ids."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_str(tokenizer_json)

    def by_file(text: str) -> np.ndarray:
        return np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)
    found = byte_ranks(tokenizer_json)
    if found is None:
        return by_file
    import tiktoken

    ranks, special = found
    fast = tiktoken.Encoding("ranks", pat_str=SPLIT_PATTERN, special_tokens=special,
                             mergeable_ranks={t: i for i, t in enumerate(ranks)})

    def by_ranks(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special="all").astype(np.uint32)
        except ValueError:  # its pattern matcher gives up on, say, a million blanks in a row
            return by_file(text)
    return by_ranks


class CapacityTree:
    """Open windows by remaining capacity; finds the least capacity that is large enough."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.windows: dict[int, list] = {}

    def add(self, room: int, window) -> None:
        self.windows.setdefault(room, []).append(window)
        i = room + self.size
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int):
        """Remove and return (room, window) of the tightest window with room >= need, or None."""
        i = need + self.size
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.size
        window = self.windows[room].pop()
        while i:
            self.count[i] -= 1
            i >>= 1
        return room, window


@dataclass
class Item:
    """Ids of one document from ``start`` on."""

    doc: int
    start: int
    total: int
    ids: np.ndarray

    def cut(self, at: int) -> tuple[Item, Item]:
        return (Item(self.doc, self.start, self.total, self.ids[:at]),
                Item(self.doc, self.start + at, self.total, self.ids[at:]))


@dataclass
class Window:
    items: list[Item] = field(default_factory=list)
    used: int = 0

    def put(self, item: Item) -> None:
        self.items.append(item)
        self.used += len(item.ids)


class Packer:
    """Best-fit decreasing over blocks of documents; closed sequences are in ``done``."""

    def __init__(self, capacity: int, slack: int, max_open: int):
        self.capacity, self.slack, self.max_open = capacity, slack, max_open
        self.tree = CapacityTree(capacity)
        self.open = 0
        self.done: list[list[Item]] = []

    def add(self, docs: list[Item]) -> None:
        items = []
        for d in docs:
            whole = len(d.ids) // self.capacity * self.capacity
            for at in range(0, whole, self.capacity):
                self.done.append([Item(d.doc, at, d.total, d.ids[at:at + self.capacity])])
            if whole < len(d.ids):
                items.append(Item(d.doc, whole, d.total, d.ids[whole:]))
        items.sort(key=lambda x: -len(x.ids))
        for item in items:
            n = len(item.ids)
            room, window = self.tree.take(n) or (self.capacity, None)
            if window is None:
                window = Window()
                self.open += 1
            window.put(item)
            if room - n:
                self.tree.add(room - n, window)
            else:
                self._close(window)
        left = self._take_open()
        for w in left:
            if self.capacity - w.used <= self.slack:
                self._close(w)
            else:
                self.tree.add(self.capacity - w.used, w)
        if self.open > self.max_open:
            last = self._complete(self._take_open())
            if last.used:
                self.tree.add(self.capacity - last.used, last)

    def _close(self, window: Window) -> None:
        self.open -= 1
        self.done.append(window.items)

    def _take_open(self) -> list[Window]:
        """Remove all open windows from the tree, the fullest first (in order of their age)."""
        out = [w for room in sorted(self.tree.windows) for w in self.tree.windows[room]]
        self.tree = CapacityTree(self.capacity)
        return out

    def _complete(self, windows: list[Window]) -> Window:
        """Fill the fullest windows exactly with the items of the emptiest; what is left over
        is one window (it may be empty)."""
        self.open = 0
        stock: list[tuple[int, int, Item]] = []  # (-length, order, item)
        number = 0
        i, j = 0, len(windows)
        while True:
            if i < j:
                window = windows[i]
                i += 1
            elif stock:
                window = Window()
            else:
                return Window()
            while window.used < self.capacity:
                if not stock:
                    if i >= j:
                        self.open = int(window.used > 0)
                        return window
                    j -= 1
                    for x in windows[j].items:
                        number += 1
                        stock.append((-len(x.ids), number, x))
                room = self.capacity - window.used
                fits = [s for s in stock if -s[0] <= room]
                chosen = min(fits or stock)
                stock.remove(chosen)
                item = chosen[2]
                if not fits:
                    item, rest = item.cut(room)
                    number += 1
                    stock.append((-len(rest.ids), number, rest))
                window.put(item)
            self.done.append(window.items)

    def finish(self) -> None:
        """Complete the open windows; the rest becomes sequences of 2^k ids."""
        last = self._complete(self._take_open())
        self.open = 0
        if self.capacity - self.slack <= last.used < self.capacity:
            self.done.append(last.items)
            return
        items = last.items[::-1]
        for bit in reversed(range(last.used.bit_length())):
            room, sequence = last.used & (1 << bit), []
            while room:
                item = items.pop()
                if len(item.ids) > room:
                    item, rest = item.cut(room)
                    items.append(rest)
                sequence.append(item)
                room -= len(item.ids)
            if sequence:
                self.done.append(sequence)


def default_tokenizer() -> str:
    """Path of the byte-level BPE vocabulary (50,257 ids)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in consecutive pieces of at most PIECE_BYTES of text (or one row)."""
    sizes = np.fromiter((len(x or "") for x in batch.column("text").to_pylist()), np.int64,
                        batch.num_rows)
    first, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > PIECE_BYTES:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += n
    if first < batch.num_rows:
        yield batch.slice(first)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
         end_id: int = END_ID, slack: int = SLACK, max_open: int = MAX_OPEN,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, padding (of its sequence), and ``ids`` (the tokens) if asked for.

    ``tokenizer`` is the path of a tokenizers file on the driver; its content travels with
    the job (a few MB). ``capacity`` must be a power of two.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    with open(tokenizer or default_tokenizer()) as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())
    src = docs.select(F.col(id_col).alias("doc_id"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = src.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
             "padding"]

    def rows(sequences: list[list[Item]], first: int) -> tuple[list[list], list[np.ndarray]]:
        columns: list[list] = [[] for _ in names]
        ids = []
        for k, items in enumerate(sequences):
            used = sum(len(x.ids) for x in items)
            padding = 0 if used & (used - 1) == 0 else capacity - used
            offset = 0
            for x in items:
                raw = x.ids.astype("<u4")
                row = (x.doc, x.start, len(raw), zlib.crc32(raw.tobytes()), x.total, first + k,
                       offset, padding)
                for c, v in zip(columns, row):
                    c.append(v)
                if with_ids:
                    ids.append(raw)
                offset += len(raw)
        return columns, ids

    def batch_out(columns, ids, kind: pa.DataType) -> pa.RecordBatch:
        arrays = [pa.array(columns[0], kind), *[pa.array(c, pa.int64()) for c in columns[1:]]]
        if with_ids:
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.concatenate([np.empty(0, np.uint32), *ids]).astype(np.int32)
            arrays.append(pa.ListArray.from_arrays(ends, flat))
        return pa.RecordBatch.from_arrays(arrays, names + ["ids"] * with_ids)

    def run(batches):
        encode = text_encoder(vocabulary.value)
        end = np.array([end_id], np.uint32)
        packer = Packer(capacity, slack, max_open)
        number = TaskContext.get().partitionId() << 40
        kind = None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for b in _blocks(batch):
                ids = [np.concatenate([encode(t), end]) for t in b.column("text").to_pylist()]
                packer.add([Item(d, 0, len(x), x)
                            for d, x in zip(b.column("doc_id").to_pylist(), ids)])
                done, packer.done = packer.done, []
                yield batch_out(*rows(done, number), kind)
                number += len(done)
        if kind is not None:
            packer.finish()
            yield batch_out(*rows(packer.done, number), kind)
    schema = f"doc_id {id_type}, " + ", ".join(f"{c} bigint" for c in names[1:])
    return src.mapInArrow(run, schema + ", ids array<int>" * with_ids)


def sequences(pieces: DataFrame) -> DataFrame:
    """The training sequences of ``pack(..., with_ids=True)``: sequence_id, ids (without
    padding), padding and the pieces' (doc_id, start, length, offset) in order."""
    own = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids")))
    return pieces.groupBy("sequence_id").agg(
        own.alias("p"), F.max("padding").alias("padding")).select(
        "sequence_id", F.flatten("p.ids").alias("ids"), "padding",
        F.transform("p", lambda x: x.dropFields("ids")).alias("pieces"))


def op12_pack(spark, sf_dir: str) -> DataFrame:
    return pack(load(spark, sf_dir, "documents")).drop("padding")
