"""Best-fit decreasing packing of token sequences.

Each task tokenizes its share of the rows and packs it on its own: documents
longer than a window are cut into full windows, the rests are placed longest
first, each into the fullest open window that still has room.  The open
windows are found through a segment tree over the room that is left, so one
placement costs log2(window) steps whatever the number of rests.

No row leaves its task, so there is no shuffle and no group to skew; memory
holds a task's rests as integers only.  After the best fit, the windows that
are still open are levelled: the emptiest are cut up to fill the others, which
leaves one open window a task, and that one is written as windows whose
lengths are powers of two, which need no padding.

Defined results: a null or empty text is the end id alone; equal rows are
packed separately; ties of length go by order of reading; an empty table gives no
rows; columns other than key and text are left out, whatever their names; keys
may be of any type, null included.  A sequence number is the number of the task
shifted by 40 bits plus a count within it: a rerun of a task reads the same split
and gives the same numbers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.storage import lean

WINDOW = 1024
END_ID = 0
#: How byte-level vocabularies cut texts before merging (a fixed value of the format).
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Ids of whole texts by a byte-level tokenizer file.

    The vocabulary is read from the file; merges are done by the ``tiktoken``
    core, which gives the ids that ``tokenizers`` gives (tested) in a fraction of
    its time.  The file's added tokens get their own ids wherever a text holds
    their strings, as in a plain ``Tokenizer.encode``; with ``added`` off, such
    strings are ordinary text.
    """

    def __init__(self, path: str, added: bool = True) -> None:
        import json

        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        of = byte_alphabet()
        ranks = {bytes(map(of.__getitem__, t)): i for t, i in model["model"]["vocab"].items() if t not in special}
        self.special = tuple(special) if added else ()
        self.merges = tiktoken.Encoding("own", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens=special if added else {})

    def ids(self, text: str | None) -> list[int]:
        if not text:
            return []
        if any(s in text for s in self.special):
            return self.merges.encode(text, allowed_special="all")
        return self.merges.encode_ordinary(text)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        return [np.array(self.ids(t), np.uint32) for t in texts]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file; kept while the worker lives."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class RoomTree:
    """Open windows by the room left in them; a segment tree finds the least room that suffices."""

    def __init__(self, window: int) -> None:
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: dict[int, list[int]] = {}

    def add(self, room: int, window: int) -> None:
        self.open.setdefault(room, []).append(window)
        at = room + self.leaves
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, window) of the tightest open window with room for ``least``, or None."""
        count, at = self.count, least + self.leaves
        if not count[at]:
            while at > 1 and not (at % 2 == 0 and count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if count[2 * at] else 2 * at + 1
        room = at - self.leaves
        window = self.open[room].pop()
        while at:
            count[at] -= 1
            at >>= 1
        return room, window


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """For each length, all within ``window``: its window; and each window's fill."""
    tree, placed, fill = RoomTree(window), [0] * len(lengths), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        found = tree.take(n)
        if found is None:
            room, at = window, len(fill)
            fill.append(0)
        else:
            room, at = found
        placed[i] = at
        fill[at] += n
        if room - n:
            tree.add(room - n, at)
    return placed, fill


def level(pieces: list[list[tuple[int, int, int]]], window: int) -> list[list[tuple[int, int, int]]]:
    """Fill open windows by cutting up the emptiest; pieces are (document, start, length).

    At most one open window is left; it is written as windows of lengths that
    are powers of two.
    """
    size = lambda w: sum(p[2] for p in w)
    full = [w for w in pieces if size(w) == window]
    rest = sorted((w for w in pieces if size(w) != window), key=size)
    lo, hi = 0, len(rest) - 1
    while lo < hi:
        room = window - size(rest[hi])
        while room and lo < hi:
            doc, start, n = rest[lo][-1]
            cut = min(room, n)
            rest[hi].append((doc, start + n - cut, cut))
            room -= cut
            if cut == n:
                rest[lo].pop()
                lo += not rest[lo]
            else:
                rest[lo][-1] = (doc, start, n - cut)
        if not room:
            full.append(rest[hi])
            hi -= 1
    if rest and lo == hi and rest[lo]:
        left, n = rest[lo], size(rest[lo])
        for bit in reversed(range(n.bit_length())):
            if n >> bit & 1:
                need, part = 1 << bit, []
                while need:
                    doc, start, length = left[0]
                    cut = min(need, length)
                    part.append((doc, start, cut))
                    need -= cut
                    left[:1] = [(doc, start + cut, length - cut)] if cut < length else []
                full.append(part)
    return full


def pack_split(documents: Iterator[tuple[object, np.ndarray]], window: int = WINDOW) -> Iterator[tuple]:
    """Pieces (key, start, length, crc32, document's ids, window number, offset) of one task's documents."""
    sequence = 0
    rests: list[tuple[object, int, int, np.ndarray]] = []
    for key, ids in documents:
        n = len(ids)
        whole = n // window * window
        for start in range(0, whole, window):
            yield key, start, window, zlib.crc32(ids[start : start + window].astype("<u4").tobytes()), n, sequence, 0
            sequence += 1
        if n > whole:
            rests.append((key, whole, n, ids[whole:].astype(np.uint32)))
    placed, fill = best_fit([len(r[3]) for r in rests], window)
    windows: list[list[tuple[int, int, int]]] = [[] for _ in fill]
    for i, at in enumerate(placed):
        windows[at].append((i, 0, len(rests[i][3])))
    for pieces in level(windows, window):
        offset = 0
        for i, start, length in pieces:
            key, before, n, ids = rests[i]
            yield key, before + start, length, zlib.crc32(ids[start : start + length].astype("<u4").tobytes()), n, sequence, offset
            offset += length
        sequence += 1


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer`` is the path of a byte-level tokenizer file on every machine.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer), np.array([END_ID], np.uint32)

        key_type = None

        def documents() -> Iterator[tuple[object, np.ndarray]]:
            nonlocal key_type
            for batch in batches:
                key_type = batch.schema.field(0).type
                for at in range(0, batch.num_rows, 1000):
                    part = batch.slice(at, 1000)
                    for k, ids in zip(part.column(0).to_pylist(), enc.encode(part.column(1).to_pylist())):
                        yield k, np.concatenate([ids, end])

        base = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []

        def table() -> pa.RecordBatch:
            k, start, length, crc, n, seq, offset = zip(*rows)
            whole = lambda x: pa.array(x, pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(k, key_type), whole(start), whole(length), whole(crc), whole(n), whole([base + s for s in seq]), whole(offset)], [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for row in pack_split(documents(), window):
            rows.append(row)
            if len(rows) == 20_000:
                yield table()
                rows.clear()
        if rows:
            yield table()

    return docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).mapInArrow(lean(run), f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
