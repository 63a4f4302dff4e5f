"""Sampled SentencePiece segmentations by forward filtering and backward sampling.

A text becomes the lattice of all ways to cut it into vocabulary pieces.  The
forward pass sums, for each place, the weight of every segmentation that ends
there; the backward pass draws the last piece in proportion to the weight that
it leaves before it, and so on to the front, which samples whole segmentations
exactly.  No piece holds a space mark after another character, so the lattice
falls apart at each space and the forward pass of a word is kept between texts.

Random numbers come from a counter hash of the seed, the row key and the place
in the text, so a row's segmentation does not depend on batches, tasks, reruns
or other rows; rows with equal key and text are segmented alike.

A file trained by merges scores its pieces by rank; the weight of a piece is
then 1 / (rank + 10) ** alpha, Zipf's law.  Characters without a piece are
written as byte pieces, the space mark itself too, so decoding gives back every
text.  A null or empty text has no pieces and decodes to the empty text; a null key seeds as a key of its own;
an empty table gives no rows; columns other than key and text are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.storage import lean

MARK = "▁"
UNITS_KEPT = 300_000
_STAND_IN = "\ud800"
_RAW = 1 << 21  # ids from here on stand for a character written as bytes
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x + _GOLD
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def row_seed(key: object, seed: int) -> int:
    if isinstance(key, int):
        return (key ^ seed * 0x5851F42D4C957F2D) & 0xFFFFFFFFFFFFFFFF
    return int.from_bytes(hashlib.blake2b(f"{seed}:{key}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


class Lattices:
    """Forward-filtered lattices of words, kept flat: the edges that end at each place with cumulated shares."""

    def __init__(self, model: str, alpha: float) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.vocab_size()
        self.bytes_at: dict[int, int] = {}
        self.text = [b""] * n
        self.piece: dict[str, tuple[int, float]] = {}
        rank = 0
        for i in range(n):
            s = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes_at[int(s[3:5], 16)] = i
                self.text[i] = bytes([int(s[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.text[i] = s.replace(MARK, " ").encode()
                self.piece[s] = (i, (rank + 10.0) ** -alpha)
                rank += 1
        self.grow_trie()
        self.raw_weight = (n + 10.0) ** -alpha
        self.first_byte = [self.bytes_at[b] for b in range(256)]
        self.clear()

    def grow_trie(self) -> None:
        """The pieces as a trie in arrays: a hash table from (node, character) to the next node, and nodes' pieces."""
        nodes: dict[str, int] = {"": 0}
        for s in self.piece:
            for k in range(1, len(s) + 1):
                nodes.setdefault(s[:k], len(nodes))
        keys = np.array([nodes[s[:-1]] << 21 | ord(s[-1]) for s in nodes if s], np.int64)
        self.slots = np.full(1 << _SLOT_BITS, -1, np.int64)
        self.leads = np.zeros(1 << _SLOT_BITS, np.int64)
        for key, lead, at in zip(keys.tolist(), (i for s, i in nodes.items() if s), _slot(keys).tolist()):
            while self.slots[at] >= 0:
                at = at + 1 & (1 << _SLOT_BITS) - 1
            self.slots[at], self.leads[at] = key, lead
        self.node_piece, self.node_log = np.full(len(nodes), -1, np.int64), np.zeros(len(nodes))
        for s, (i, w) in self.piece.items():
            self.node_piece[nodes[s]], self.node_log[nodes[s]] = i, np.log(w)

    def child(self, key: np.ndarray) -> np.ndarray:
        """The node that each (node, character) key leads to, or -1."""
        at = _slot(key)
        found = self.slots[at]
        out = np.where(found == key, self.leads[at], -1)
        probe = np.flatnonzero((found != key) & (found >= 0))
        while len(probe):
            at[probe] = at[probe] + 1 & (1 << _SLOT_BITS) - 1
            found = self.slots[at[probe]]
            same = found == key[probe]
            out[probe[same]] = self.leads[at[probe[same]]]
            probe = probe[~same & (found >= 0)]
        return out

    def clear(self) -> None:
        self.at: dict[str, int] = {}  # word -> its place 0
        self.cum, self.step, self.ident = np.empty(0), np.empty(0, np.int32), np.empty(0, np.int32)
        self.edge, self.size = np.empty(0, np.int64), np.empty(0, np.int32)  # by place: its first edge; its word's length

    def learn(self, names: list[str]) -> None:
        """Forward pass over words: at each place, the edges that end there and their cumulated shares of its weight.

        A name that starts with neither mark nor line feed is a word after one space.
        """
        if not names:
            return
        words = [w if w[0] == "\n" or w[0] == MARK else MARK + w for w in names]
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        begin = np.cumsum(size) - size
        chars = np.frombuffer("\0".join([*words, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        within = np.arange(len(chars)) - np.repeat(begin, size)
        real = within < np.repeat(size - 1, size)
        start = np.flatnonzero(real)
        node = np.zeros(len(start), np.int64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        length = 0
        while len(start):
            here = start + length
            length += 1
            key = node << 21 | chars[here]
            lead = self.child(key)
            hit = (lead >= 0) & real[here]
            if length == 1:
                lone = np.where(hit, self.node_piece[lead], -1) < 0
                raw = start[lone]
                found.append((raw, np.full(len(raw), 1), _RAW | chars[raw], np.full(len(raw), np.log(self.raw_weight))))
            start, node = start[hit], lead[hit]
            ends = self.node_piece[node] >= 0
            n = int(ends.sum())
            found.append((start[ends], np.full(n, length), self.node_piece[node[ends]], self.node_log[node[ends]]))
        begins, steps, ids, logs = (np.concatenate(x) for x in zip(*found))
        stop = begins + steps
        order = np.argsort(within[stop] * len(chars) + stop, kind="stable")  # all words' first places, then all their second places, ...
        begins, steps, ids, logs, stop = begins[order], steps[order], ids[order], logs[order], stop[order]
        weight, share = np.zeros(len(chars)), np.empty(len(stop))
        depth = within[stop]
        bounds = np.flatnonzero(np.diff(depth, prepend=-1, append=np.iinfo(np.int64).max))
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            w, s = weight[begins[lo:hi]] + logs[lo:hi], stop[lo:hi]
            first = np.flatnonzero(np.diff(s, prepend=-1))
            many = np.diff(first, append=len(s))
            top = np.maximum.reduceat(w, first)
            sums = np.add.reduceat(np.exp(w - np.repeat(top, many)), first)
            weight[s[first]] = top + np.log(sums)
            share[lo:hi] = np.exp(w - np.repeat(weight[s[first]], many))
        order = np.argsort(stop - 0.999 * share, kind="stable")  # the likeliest edge of a place first
        stop, share = stop[order], share[order]
        upto = np.cumsum(share)
        first = np.flatnonzero(np.diff(stop, prepend=-1))
        many = np.diff(first, append=len(stop))
        upto -= np.repeat(upto[first] - share[first], many)
        upto[first + many - 1] = 2.0  # the last edge takes what is left
        edge = np.zeros(len(chars), np.int64)
        edge[stop[first]] = first + len(self.cum)
        at = len(self.edge) + begin
        self.edge = np.concatenate([self.edge, edge])
        self.size = np.concatenate([self.size, np.repeat(size - 1, size).astype(np.int32)])
        self.cum = np.concatenate([self.cum, upto])
        self.step = np.concatenate([self.step, steps[order].astype(np.int32)])
        self.ident = np.concatenate([self.ident, ids[order].astype(np.int32)])
        self.at.update(zip(names, at.tolist()))

    def sample(self, place: np.ndarray, starts: np.ndarray, seeds: np.ndarray, total: int, offsets: np.ndarray) -> np.ndarray:
        """Ids by global place, shifted by one: words at ``place`` begin at ``starts``; 0 is no id."""
        left = self.size[place].astype(np.int64)
        out = np.zeros(total + 1, np.int32)
        while len(left):
            u = (mixed(seeds + (offsets + left).astype(np.uint64) * _GOLD) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            edge = self.edge[place + left]
            more = np.flatnonzero(u >= self.cum[edge])
            while len(more):
                edge[more] += 1
                more = more[u[more] >= self.cum[edge[more]]]
            out[starts + left] = self.ident[edge] + 1
            left = left - self.step[edge]
            going = left > 0
            if not going.all():
                place, left, starts, seeds, offsets = place[going], left[going], starts[going], seeds[going], offsets[going]
        return out

    def encode(self, keys: list, texts: list[str | None], seed: int) -> list[np.ndarray]:
        """Sampled ids of each text.

        A mark in the text itself is swapped with a lone surrogate, which no
        text holds and no piece has, so it is written as the mark's bytes.  No
        piece holds a line feed, so words end there too.
        """
        units = []
        for t in texts:
            if not t:
                units.append([])
                continue
            parts = (t.replace(MARK, _STAND_IN) if MARK in t else t).replace("\n", " \n").split(" ")
            if "" not in parts:
                units.append(parts)
                continue
            found, run = [], ""  # runs of spaces stay before the word that they lead to
            for w in parts:
                if w[:1] == "\n":
                    found += [run, w] if run else [w]
                    run = ""
                else:
                    run += MARK
                    if w:
                        found.append(run + w if len(run) > 1 else w)
                        run = ""
            units.append(found + [run] if run else found)
        words = list(chain.from_iterable(units))
        new = set(words).difference(self.at)
        if len(self.at) + len(new) > UNITS_KEPT and self.at:
            self.clear()
            new = set(words)
        self.learn(list(new))
        counts = np.array([len(x) for x in units], np.int64)
        place = np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))
        size = self.size[place].astype(np.int64)
        begin = np.cumsum(size) - size
        doc_begin = np.concatenate([begin, [size.sum()]])[np.concatenate([[0], np.cumsum(counts)])]
        base = np.array([row_seed(k, seed) for k in keys], np.uint64)
        with np.errstate(over="ignore"):
            base = mixed(base)
            out = self.sample(place, begin, np.repeat(base, counts), int(size.sum()), begin - np.repeat(doc_begin[:-1], counts))
        return [self.spelled(out[a + 1 : b + 1]) for a, b in zip(doc_begin[:-1], doc_begin[1:])]

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        """Ids without gaps, characters without a piece as byte pieces."""
        ids = ids[ids > 0] - 1
        raw = np.flatnonzero(ids >= _RAW)
        if not len(raw):
            return ids
        parts, last = [], 0
        for i in raw.tolist():
            c = chr(int(ids[i]) & (_RAW - 1))
            body = (MARK if c == _STAND_IN else c).encode("utf-8", "surrogatepass")
            parts += [ids[last:i], np.array([self.first_byte[b] for b in body], np.int32)]
            last = i + 1
        return np.concatenate([*parts, ids[last:]])

    def decode(self, ids: list[int]) -> str:
        body = b"".join(map(self.text.__getitem__, ids))
        return body[1:].decode("utf-8", "surrogatepass")


_SLOT_BITS = 19


def _slot(key: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


_MODELS: dict[tuple[str, float], Lattices] = {}


def lattices(model: str, alpha: float) -> Lattices:
    if (model, alpha) not in _MODELS:
        _MODELS[model, alpha] = Lattices(model, alpha)
    return _MODELS[model, alpha]


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", alpha: float = 1.0, seed: int = 0, digest: bool = False) -> DataFrame:
    """The key and ``ids array<int>``; with ``digest`` instead n_chars, n_pieces, ids_crc32, decoded_sha256, lossless."""
    kind = docs.schema[key].dataType.simpleString()
    columns = "n_chars long, n_pieces long, ids_crc32 long, decoded_sha256 string, lossless boolean" if digest else "ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = lattices(model, alpha)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = part.column(1).to_pylist()
                ids = lat.encode(part.column(0).to_pylist(), texts, seed)
                if digest:
                    back = [lat.decode(x.tolist()) for x in ids]
                    rows = (
                        pa.array([len(t or "") for t in texts], pa.int64()),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(b.encode("utf-8", "surrogatepass")).hexdigest() for b in back]),
                        pa.array([b == (t or "") for b, t in zip(back, texts)]),
                    )
                    yield pa.RecordBatch.from_arrays([part.column(0), *rows], [key, "n_chars", "n_pieces", "ids_crc32", "decoded_sha256", "lossless"])
                else:
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x.tolist() for x in ids], pa.list_(pa.int32()))], [key, "ids"])

    return docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).mapInArrow(lean(run), f"`{key}` {kind}, {columns}")


def decode(encoded: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """The key and ``text`` again; a null list decodes to null."""
    kind = encoded.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = lattices(model, 1.0)
        for batch in batches:
            found = [None if x is None else lat.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], [key, "text"])

    return encoded.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{ids}`").alias("_ids")).mapInArrow(lean(run), f"`{key}` {kind}, text string")
