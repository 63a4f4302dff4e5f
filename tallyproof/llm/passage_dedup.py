"""Passage dedup: runs of two or more sentences that occur earlier, short ones included, and passages of words wherever sentences end.

A sentence of a few words repeats by chance, a run of them does not.  Sentences are
those of ``line_dedup``, without blank ones; a run is the fewest sentences from one on, or up to one, that hold
``least`` words, if these are two at least.  Of equal runs the earliest, by key and then by place,
stays; the sentences of all others go, with blank ones between them.  Overlaps count, and runs
are judged on the input, so the first occurrence of a sentence always stays.  Sentences that
hold so many words alone are left to ``line_dedup``.

With ``passage``, every word in a run of so many words (A-Z as a-z) that starts earlier too goes as well, with the
white space behind it on its line, and so does a line that has no word left then; a passage that
starts or ends within a sentence, or holds no sentence end, is found by this.  Equal runs of
so many words share an anchor, by winnowing: of the runs of half as many words in each, the one of least
digest.  Anchors are counted, those that occur twice go into a bitmap, and only runs around
these are hashed and dealt; more than the bitmap has room for means more runs, none is lost.

Runs are hashed where the texts are read, as differences of running sums, and dealt by hash in packed
blobs; of those that are equal within a few MB of text only the earliest is sent, so no task gathers a
frequent run.  Nothing that grows with the corpus is broadcast or collected.

Defined results: a null text stays null; a null key ranks before all others; rows that share key
and text are one document repeated and keep the same sentences; ties on key between different texts go to
the lesser text hash; an empty table gives no rows; other columns pass through untouched.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.deal import labels
from tallyproof.llm.line_dedup import LEAST, SENTENCE, WHITE, cut
from tallyproof.llm.partenum import _filter_of
from tallyproof.llm.shingles import GOLD, U, forget, mixed, powers, word_hashes
from tallyproof.llm.storage import discard, lean, stored
from tallyproof.llm.suffix_groups import _bucket, _numbered

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_WORD_AND_SPACE = re.compile(r"[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]*")
_SPLIT = re.compile(f"(?<={SENTENCE})|(?<=\n)")
_IN_LINE = re.compile(f"(?<={SENTENCE})")
#: For corpora: passages of over 50 words.
PASSAGE = 51
#: Code points of texts that are hashed together (words by smaller slices), and that a gathering task's runs come from on average.
CHUNK, SLICE, EACH = 2_000_000, 250_000, 10_000_000
#: Ranges of words are told from those of sentences by this bit.
BY_WORD = 1 << 31
_FOUND = "k long, h long, a long, b long"


def sentences(text: str) -> tuple[list[int], list[int], list[int]]:
    """Hash, number of words and place of each sentence with a word; places count blank ones too."""
    hashes, words, places = [], [], []
    for place, unit in enumerate(_SPLIT.split(text)):
        if found := _WORD.findall(unit):
            hashes.append(int.from_bytes(hashlib.blake2b(" ".join(found).lower().encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"))
            words.append(len(found))
            places.append(place)
    return hashes, words, places


def runs(hashes: np.ndarray, words: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digest, first sentence and the one behind the last of the runs of documents that ``bounds`` cuts."""
    n = len(hashes)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    upto = np.concatenate([[0], np.cumsum(words)])
    at = np.arange(n)
    end = np.searchsorted(upto, upto[:-1] + least)
    start = np.searchsorted(upto, upto[1:] - least, side="right") - 1
    on, back = (end <= bounds[doc + 1]) & (end - at > 1), (start >= bounds[doc]) & (at + 1 - start > 1)
    both = np.unique(np.concatenate([at[on] * (n + 1) + end[on], start[back] * (n + 1) + at[back] + 1]))
    first, last = both // (n + 1), both % (n + 1)
    up, down = powers(n + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(hashes) * up[:n], dtype=np.uint64)])
        digest = mixed((total[last] - total[first]) * down[first] ^ mixed((last - first).astype(np.uint64)))
    return digest, first, last


def _worded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and how many lie before each text (one entry more than texts)."""
    upto = np.cumsum([0, *(len(t) for t in texts)])
    hashes, counts, at = [], [np.zeros(1, np.int64)], 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + SLICE, side="right")) - 1)
        h, before = word_hashes(texts[at:end])
        hashes.append(h)
        counts.append(np.diff(before))
        at = end
    return np.concatenate(hashes), np.cumsum(np.concatenate(counts))


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    """Digest of the run of ``size`` words from each word on, where there are so many."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = powers(len(words) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)], dtype=np.uint64)])
        return mixed((total[size:] - total[:-size]) * down[:n] ^ U(size) * GOLD)


def _sliding(extreme: Callable, x: np.ndarray, wide: int) -> np.ndarray:
    """The extreme of every ``wide`` entries in a row."""
    have = 1
    while have < wide:
        step = min(have, wide - have)
        x = extreme(x[:-step], x[step:])
        have += step
    return x


def _inside(bounds: np.ndarray, size: int) -> np.ndarray:
    """For each word with so many to come, if a run of ``size`` words from it on stays within its document."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    return doc[: len(doc) - size + 1] == doc[size - 1 :]


def anchors(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Digest and first word of the anchors of documents that ``bounds`` cuts: every run of ``size`` words holds one at least, and equal runs hold the same."""
    if len(words) < size:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    half = (size + 1) // 2
    wide = size - half + 1
    x = _grams(words, half)
    least = _sliding(np.minimum, x, wide)
    least[~_inside(bounds, size)] = 0
    at = np.flatnonzero(_sliding(np.maximum, np.pad(least, wide - 1), wide) == x)
    return x[at], at


def _around(words: np.ndarray, bounds: np.ndarray, size: int, width: int, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digest and first word of the runs of ``size`` words that hold an anchor in the bitmap."""
    v, at = anchors(words, bounds, size)
    there = np.ones(len(v), bool)
    for x in (v, v << U(32) | v >> U(32)):
        there &= bits[(x >> U(64 - width + 3)).astype(np.int64)] >> (x & U(7)).astype(np.uint8) & 1 == 1
    at = at[there]
    if not len(at):
        return np.empty(0, np.uint64), at
    inside = _inside(bounds, size)
    marks = np.zeros(len(inside) + 1, np.int64)
    np.add.at(marks, np.maximum(at - (size - (size + 1) // 2), 0), 1)
    np.add.at(marks, np.minimum(at, len(inside) - 1) + 1, -1)
    first = np.flatnonzero((np.cumsum(marks[:-1]) > 0) & inside)
    return mixed(_grams(words, size)[first] ^ GOLD), first


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Lists of (k, h, t) of some ``CHUNK`` code points, without empty texts."""
    held: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[2]:
                held.append(row)
                size += len(row[2])
            if size > CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


def repeated_anchors(rows: DataFrame, size: int) -> DataFrame:
    """(cls): digests of the anchors that occur more than once; of rows (k, h, t)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _chunks(batches):
            digest, n = np.unique(anchors(*_worded([t for *_, t in held]), size)[0], return_counts=True)
            for i in range(0, len(digest), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(digest[i : i + 50_000].view(np.int64)), pa.array(n[i : i + 50_000])], ["cls", "n"])

    return rows.mapInArrow(lean(count, forget), "cls long, n long").groupBy("cls").agg(F.sum("n").alias("n")).filter("n > 1").select("cls")


def _later(digest: np.ndarray, k: np.ndarray, h: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs that an earlier one is equal to, and the earliest of each digest."""
    order = np.lexsort((a, h, k, digest))
    new = np.diff(digest[order], prepend=~digest[order][:1]) != 0
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    later = (k[order] != k[first]) | (h[order] != h[first]) | (a[order] != a[first])
    return order[later], order[new]


def _found(k: np.ndarray, h: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Ranges of places, those of a document that touch made one."""
    if not len(k):
        return
    order = np.lexsort((a, h, k))
    k, h, a, b = k[order], h[order], a[order].astype(np.int64), b[order].astype(np.int64)
    doc = np.cumsum((np.diff(k, prepend=k[0]) != 0) | (np.diff(h, prepend=h[0]) != 0))
    reach = np.maximum.accumulate(b + (doc << 32)) - (doc << 32)
    new = np.ones(len(k), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (a[1:] > reach[:-1])
    first = np.flatnonzero(new)
    k, h, a, b = k[first], h[first], a[first], reach[np.append(first[1:], len(k)) - 1]
    for i in range(0, len(k), 50_000):
        some = slice(i, i + 50_000)
        yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (k, h, a, b)], ["k", "h", "a", "b"])


def repeats(rows: DataFrame, buckets: int, least: int, passage: int | None = None) -> DataFrame:
    """(k, h, a, b): places from a to b, without b, that go from the document of number ``k`` and text hash ``h``, those from ``BY_WORD`` on words; of rows (k, h, t)."""
    wanted = None
    if passage:
        found = stored(repeated_anchors(rows, passage), "anchors")
        turned = F.shiftleft("cls", 32).bitwiseOR(F.shiftrightunsigned("cls", 32))
        wanted = _filter_of(found.select(F.explode(F.array("cls", turned)).alias("cls")))  # two bits each, as one lets in a sixteenth of all anchors
        discard(found)
    shared = rows.sparkSession.sparkContext.broadcast((labels(buckets), wanted))
    kinds = (np.uint64, np.int64, np.int64, np.uint32, np.uint32)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, wanted = shared.value

        def hashed(held: list[tuple]) -> list[np.ndarray]:
            told = [sentences(t) for *_, t in held]
            bounds = np.cumsum([0, *(len(x[0]) for x in told)])
            hashes, words, places = (np.array([v for x in told for v in x[i]], kind) for i, kind in enumerate((np.uint64, np.int64, np.int64)))
            digest, first, last = runs(hashes, words, bounds, least)
            doc = np.searchsorted(bounds, first, side="right") - 1
            found = [[digest, doc, places[first], places[last - 1] + 1]]
            if wanted:
                words, bounds = _worded([t for *_, t in held])
                digest, first = _around(words, bounds, passage, wanted[0], np.frombuffer(wanted[1], np.uint8))
                doc = np.searchsorted(bounds, first, side="right") - 1
                at = BY_WORD + first - bounds[doc]
                found.append([digest, doc, at, at + passage])
            digest, doc, a, b = map(np.concatenate, zip(*found))
            k, h = (np.array([x[i] for x in held], np.int64)[doc] for i in (0, 1))
            return [digest, k, h, a, b]

        for held in _chunks(batches):
            digest, k, h, a, b = hashed(held)
            later, one = _later(digest, k, h, a)
            packed, where, kind = [], [], []
            for part in _found(k[later], h[later], a[later], b[later]):
                packed.append(b"".join(c.to_numpy().tobytes() for c in part.columns))
                where.append(int(label[part.column(0)[0].as_py() % buckets]))
                kind.append(True)
            bucket = _bucket(digest[one], buckets)
            order = np.argsort(bucket, kind="stable")
            one, bucket = one[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket, prepend=U(buckets)) != 0)
            for s, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(one)]):
                x = one[s:e]
                packed.append(b"".join(c[x].astype(t).tobytes() for c, t in zip((digest, k, h, a, b), kinds)))
                where.append(int(label[int(bucket[s])]))
                kind.append(False)
            yield pa.RecordBatch.from_arrays([pa.array(where, pa.int64()), pa.array(kind, pa.bool_()), pa.array(packed, pa.binary())], ["bucket", "ranges", "packed"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list[np.ndarray]] = [[] for _ in kinds]
        for batch in batches:
            for ranges, blob in zip(batch.column(1).to_pylist(), batch.column(2)):
                raw = blob.as_buffer()
                if ranges:
                    yield from _found(*np.frombuffer(raw, np.int64).reshape(4, -1))
                    continue
                n, upto = len(raw) // 32, 0
                for c, t in zip(columns, kinds):
                    c.append(np.frombuffer(raw, t, n, upto))
                    upto += n * np.dtype(t).itemsize
        if columns[0]:
            digest, k, h, a, b = map(np.concatenate, columns)
            columns.clear()
            later, _ = _later(digest, k, h, a)
            yield from _found(k[later], h[later], a[later], b[later])

    dealt = rows.mapInArrow(lean(emit, forget), "bucket long, ranges boolean, packed binary").repartition(buckets, "bucket")
    return dealt.mapInArrow(lean(gather), _FOUND)


def without(text: str, places: set[int], spans: list[tuple[int, int]]) -> str:
    """What stays of a text without the sentences of ``places`` and the words of ``spans``."""
    if not spans:
        return cut(text, places, "\n", _IN_LINE)[0]
    keep = bytearray(b"\x01") * len(text)
    words = [m.span() for m in _WORD_AND_SPACE.finditer(text)]
    for a, b in spans:
        for start, end in words[a:b]:
            keep[start:end] = bytes(end - start)
    lines, first, place = [], 0, 0
    for line in text.split("\n"):
        at, had, lost = first, False, 0 in keep[first : first + len(line)]
        for unit in _IN_LINE.split(line):
            if place in places:
                keep[at : at + len(unit)] = bytes(len(unit))
                had = True
            at += len(unit)
            place += 1
        left = "".join(compress(line, keep[first:at]))
        if left.strip(WHITE) if lost else left or not had:
            lines.append(left)
        first = at + 1
    return "\n".join(lines)


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars", least: int = LEAST, passage: int | None = None) -> DataFrame:
    """All rows and columns of ``docs`` with the kept text, its length in ``n_chars`` if the text changed."""
    number, ranks = _numbered(docs, key)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(whole, F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("t"), F.xxhash64(F.col(f"`{text}`")).alias("h"), *([number.alias("k")] if ranks is None else []))
    if ranks is not None:
        rows = rows.join(ranks.select(F.col("_key").alias("_same"), "k"), F.col("_key").eqNullSafe(F.col("_same")))
    size = docs.agg(F.sum(F.length(F.col(f"`{text}`")))).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // EACH)
    spans = repeats(rows.select("k", "h", "t"), buckets, least, passage).groupBy("k", "h").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    spans = stored(spans, "passages")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                kept = []
                for t, found in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    gone = {i for s in found or () if s["a"] < BY_WORD for i in range(s["a"], s["b"])}
                    kept.append(without(t, gone, [(s["a"] - BY_WORD, s["b"] - BY_WORD) for s in found if s["a"] >= BY_WORD]) if found else t)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(kept, pa.string()), pa.array([bool(s) for s in part.column(2).to_pylist()])], ["_row", "kept", "changed"])

    joined = rows.join(spans, ["k", "h"], "left").select("_row", "t", "spans")
    done = joined.mapInArrow(lean(run), f"_row {joined.schema['_row'].dataType.simpleString()}, kept string, changed boolean")
    columns = []
    for c in docs.columns:
        own = F.col(f"_row.`{c}`")
        if c == text:
            own = F.col("kept")
        elif c == n_chars:
            own = F.when(F.col("changed"), F.length("kept").cast(docs.schema[c].dataType)).otherwise(own)
        columns.append(own.alias(c))
    return done.select(*columns)
