"""Substring dedup: every byte covered by a 100-byte string that also starts earlier.

Suffixes are sorted by linear grouping.  They are first grouped by their first
byte; groups are taken in descending order, each member points to the last
earlier suffix of a smaller group, and the suffixes pointed to move to new groups right
behind their own, those with more pointers further back.  Groups then hold suffixes of equal longest
Lyndon prefix, and one pass over the growing order emits each group's members
by following the pointers, without naming anything anew.  ``suffix_array`` does
this for one string, ``suffix_arrays`` for many at once, each step on the next group of all of them.

One suffix array of the corpus would need the corpus in one place, so strings
are brought together by anchors: of the 69 runs of 32 bytes in a 100-byte
string, the one with the least hash.  Equal strings have equal anchors, and
the string lies within 68 bytes of its anchor.
1. A count finds anchors with very many contexts (an anchor and 68 bytes on
   either side).  Their strings are dealt by one of four 83-byte ranges around the anchor,
   one of which each string holds, and within such a range that has very many
   contexts by the whole string.  There are at most ``total / heavy`` such
   keys, so their list is bounded whatever the input.
2. Every context is one record, dealt by its key: digest, owner, and the digests of
   its four ranges.  Contexts equal to one of an earlier owner are removed as a whole;
   of the distinct ones, those with a range in common with another are asked for.  If these
   are more than ``MANY``, what surrounds each such range is asked for instead, under a key of its own.
3. The contexts asked for are cut from their texts, and the distinct
   contexts of a key are sorted together by the suffix array; equal 100-byte
   strings then stand side by side, and all but the earliest are marked.
Contexts that are equal within a few MB of text are one record, so copies are not gathered anywhere.
Nothing that grows with the corpus is broadcast or collected.

Defined results: a null text is empty; matches never cross documents; strings
are judged on the input; keys of any type count in their order, a null key before
all others; rows that share a key count as one document, cut by what is found in any
of them; an empty table gives no rows; columns other than key and text are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.deal import labels
from tallyproof.llm.shingles import GOLD, U, forget, mixed, powers
from tallyproof.llm.storage import lean, stored

LENGTH = 100
GRAM = 32
REACH = LENGTH - GRAM  # 68: an anchor's distance from the ends of its string
STEPS = 4
SIDE = REACH // STEPS  # 17
#: Contexts of a key from which it is split, at least.
HOT = 1000
#: Distinct contexts of an anchor from which they are sorted by range.
MANY = 24
#: Keys that are split, at most, for each level.
SPLIT_KEYS = 20_000
#: Records, and bytes of contexts, that a task takes on average.
RECORDS, BYTES = 250_000, 3_000_000
_CHUNK = 2_000_000
_BLOCK = 1 << 16
_INDEX = np.arange(_BLOCK + LENGTH, dtype=np.uint64)
_BYTE = mixed(np.arange(1000, 1256, dtype=np.uint64))


def suffix_array(data: bytes) -> list[int]:
    """Starts of the suffixes of ``data`` in order, by linear grouping."""
    n = len(data) + 1
    text = [b + 1 for b in data]
    text.append(0)
    counts = [0] * 257
    for c in text:
        counts[c] += 1
    first, total = [0] * 257, 0
    for c, k in enumerate(counts):
        first[c], total = total, total + k
    size = [0] * (n + 1)  # of the group that starts at a place
    group, place, order = [0] * n, [0] * n, [0] * n
    fill = first[:]
    for i, c in enumerate(text):
        at = fill[c]
        order[at], place[i], group[i] = i, at, first[c]
        fill[c] = at + 1
    for c, k in enumerate(counts):
        if k:
            size[first[c]] = k
    previous = [-1] * n
    end = n
    while end:
        start = group[order[end - 1]]
        members = sorted(order[start:end])
        pointed: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        if pointed:
            by_count: dict[int, list[int]] = {}
            for j, k in pointed.items():
                by_count.setdefault(k, []).append(j)
            for k in sorted(by_count, reverse=True):
                moved: dict[int, list[int]] = {}
                for j in by_count[k]:
                    moved.setdefault(group[j], []).append(j)
                for s, some in moved.items():
                    left = size[s]
                    if left == len(some):
                        continue  # the whole group moves: it stays where it is
                    for j in some:
                        left -= 1
                        at, last = place[j], s + left
                        other = order[last]
                        order[at], place[other] = other, at
                        order[last], place[j] = j, last
                    size[s], size[s + left] = left, len(some)
                    new = s + left
                    for j in some:
                        group[j] = new
        end = start
    out = [-1] * n
    out[0] = n - 1
    done = [False] * n
    done[n - 1] = True
    slot = list(range(n))
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not done[j]:
            g = group[j]
            out[slot[g]] = j
            slot[g] += 1
            done[j] = True
            j = previous[j]
    return out[1:]


def suffix_arrays(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of the strings ``data[bounds[i]:bounds[i + 1]]``, in order within each string."""
    lengths = np.diff(bounds) + 1  # each string ends with a byte of its own, less than all others
    rank = np.argsort(-lengths, kind="stable")  # long ones first, so those not yet through are the first ones
    sizes = lengths[rank]
    n, count = int(sizes.sum()), len(sizes)
    base = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    text = np.zeros(n, np.uint16)
    inner = np.repeat(bounds[:-1][rank] - base[:-1], sizes - 1) + (at := _spread(base[:-1], sizes - 1))
    text[at] = data[inner].astype(np.uint16) + np.uint16(1)
    owner = np.repeat(np.arange(count, dtype=np.uint32), sizes)
    order = np.argsort(text, kind="stable")
    low = np.argsort((owner[order] & 0xFFFF).astype(np.uint16), kind="stable")
    order = order[low]
    if count > 0xFFFF:
        order = order[np.argsort((owner[order] >> 16).astype(np.uint16), kind="stable")]
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    first = np.flatnonzero((np.diff(text[order].astype(np.int32), prepend=-1) != 0) | (np.diff(owner[order].astype(np.int64), prepend=-1) != 0))
    size = np.zeros(n, np.int64)
    size[first] = np.diff(first, append=n)
    group = np.empty(n, np.int64)
    group[order] = np.repeat(first, size[first])
    previous = np.full(n, -1, np.int64)
    moved = np.zeros(n, bool)
    end, floor = base[1:].copy(), base[:-1]
    while len(end):
        start = group[order[end - 1]]
        many = end - start
        if len(end) == many.sum():
            members, lowest, own = order[start], floor, start
        else:
            members, lowest, own = order[_spread(start, many)], np.repeat(floor, many), np.repeat(start, many)
        to = members - 1
        to[to < lowest] = -1
        previous[members] = to
        todo = np.flatnonzero((to >= 0) & (group[to] >= own))
        while len(todo):
            further = previous[to[todo]]
            to[todo] = further
            previous[members[todo]] = further
            todo = todo[(further >= 0) & (group[further] >= own[todo])]
        to = to[to >= 0]
        if len(to):
            to.sort()
            new = np.flatnonzero(np.diff(to, prepend=-1))
            times, to = np.diff(new, append=len(to)), to[new]
            within = group[to]
            sort = np.argsort(within << 32 | times)
            to, times, within = to[sort], times[sort], within[sort]
            other = np.diff(within, prepend=-1) != 0
            run = np.flatnonzero(other)
            some = np.diff(run, append=len(to))
            whole = within[run]
            tail = whole + size[whole] - some
            slot = _spread(tail, some)
            held, was = order[slot], place[to]
            moved[to] = True
            out = held[~moved[held]]
            gap = was[was < np.repeat(tail, some)]
            order[gap], place[out] = out, gap
            order[slot], place[to] = to, slot
            moved[to] = False
            kind = np.flatnonzero(other | (np.diff(times, prepend=0) != 0))
            fresh = slot[kind]
            group[to] = np.repeat(fresh, np.diff(kind, append=len(to)))
            size[whole] -= some
            size[fresh] = np.diff(kind, append=len(to))
        left = start > floor
        end, floor = (start, floor) if left.all() else (start[left], floor[left])
    out = np.full(n, -1, np.int64)
    last = base[1:] - 1
    out[base[:-1]] = last
    done = np.zeros(n, bool)
    done[last] = True
    slot = np.arange(n)
    running = np.searchsorted(-sizes, -np.arange(sizes[0] if count else 0), side="left")  # strings longer than i
    for i in range(int(sizes[0]) if count else 0):
        some = base[: running[i]]
        j = out[some + i] - 1
        j = j[j >= some]
        j = j[~done[j]]
        while len(j):
            g = group[j]
            out[slot[g]] = j
            slot[g] += 1
            done[j] = True
            j = previous[j]
            j = j[j >= 0]
            j = j[~done[j]]
    found = out[_spread(base[:-1] + 1, sizes - 1)] - np.repeat(base[:-1] - bounds[:-1][rank], sizes - 1)
    back = np.empty(len(found), np.int64)
    back[_spread(bounds[:-1][rank] - bounds[0], sizes - 1)] = found
    return back


def _spread(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (many[0] numbers), first[1], ..."""
    upto = np.cumsum(many)
    return np.repeat(first - (upto - many), many) + np.arange(upto[-1] if len(upto) else 0)


#: Bytes of a group from which it is sorted alone, and of all groups sorted at once.
_ALONE, _AT_ONCE = 9_000, 500_000


def repeated(data: np.ndarray, bounds: np.ndarray, groups: np.ndarray, k: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(context, offset) of the 100-byte strings that start earlier in another context of their group.

    Context i is ``data[bounds[i]:bounds[i + 1]]`` and starts at byte ``at[i]`` of document ``k[i]``; group
    g has the contexts ``groups[g]`` to ``groups[g + 1]``.
    """
    edges = bounds[groups]
    width = np.diff(edges)
    order = np.argsort(width, kind="stable")
    parts = np.flatnonzero(np.diff(np.cumsum(width[order]) // _AT_ONCE, prepend=-1) != 0).tolist() + [len(order)]
    found = []
    for one, two in zip(parts[:-1], parts[1:]):
        some = order[one:two]
        wide = some[width[some] >= _ALONE]
        some = some[width[some] < _ALONE]
        sorted_ = [np.array(suffix_array(data[edges[g] : edges[g + 1]].tobytes()), np.int64) + edges[g] for g in wide.tolist()]
        if len(some):
            lengths = width[some]
            upto = np.concatenate([[0], np.cumsum(lengths)])
            source = _spread(edges[some], lengths)
            sorted_.append(source[suffix_arrays(data[source], upto)])
        found.append(_runs(data, bounds, groups, k, at, np.concatenate(sorted_)))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _runs(data: np.ndarray, bounds: np.ndarray, groups: np.ndarray, k: np.ndarray, at: np.ndarray, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of suffixes in order, the (context, offset) of those that begin as an earlier one of their group does for 100 bytes."""
    context = np.searchsorted(bounds, suffixes, side="right") - 1
    fits = suffixes + LENGTH <= bounds[context + 1]
    suffixes, context = suffixes[fits], context[fits]
    group = np.searchsorted(groups, context, side="right") - 1
    words = np.ndarray(max(len(data) - 7, 0), "<u8", data, strides=(1,))
    like = np.flatnonzero(group[1:] == group[:-1]) + 1
    for step in (*range(0, LENGTH - 8, 8), LENGTH - 8):
        like = like[words[suffixes[like] + step] == words[suffixes[like - 1] + step]]
    if not len(like):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    new = np.ones(len(suffixes), bool)
    new[like] = False
    inside = ~new
    inside[:-1] |= ~new[1:]
    run = np.cumsum(new)[inside]
    suffixes, context = suffixes[inside], context[inside]
    offset = suffixes - bounds[context]
    key, place = k[context], at[context] + offset
    order = np.lexsort((place, key, run))
    first = np.flatnonzero(np.diff(run[order], prepend=-1) != 0)
    least = np.repeat(order[first], np.diff(first, append=len(order)))
    later = order[(key[order] != key[least]) | (place[order] != place[least])]
    return context[later], offset[later]


class Scan:
    """Anchors of texts that lie side by side in ``data``, cut at ``bounds``, with hashes of any range."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray) -> None:
        n = len(data)
        found = []
        if n >= LENGTH:
            up, self.down = powers(n + 1)
            self.total = np.empty(n + 1, np.uint64)
            self.total[0] = carry = U(0)
            low = U((1 << 20) - 1)
            with np.errstate(over="ignore"):
                for s in range(0, n, _BLOCK):  # in blocks that stay in the cache
                    e = min(s + _BLOCK, n)
                    part = self.total[s + 1 : e + 1]
                    np.multiply(_BYTE[data[s:e]], up[s:e], out=part)
                    np.cumsum(part, out=part)
                    part += carry
                    carry = self.total[e]
                for s in range(0, n - LENGTH + 1, _BLOCK):
                    e = min(s + _BLOCK + REACH, n - GRAM + 1)
                    m = self.total[s + GRAM : e + GRAM] - self.total[s:e]
                    m *= self.down[s:e]
                    _mix(m)
                    m &= ~low
                    m |= _INDEX[: e - s]
                    for step in (1, 2, 4, 8, 16, 32):  # least of 64, then of 69
                        m = np.minimum(m[:-step], m[step:])
                    m = np.minimum(m[:-5], m[5:])
                    m &= low
                    found.append(self._whole(m.astype(np.int64) + s, s, bounds))
        place = np.concatenate(found) if found else np.empty(0, np.int64)  # a later string has no earlier anchor
        self.place = place[np.diff(place, prepend=-1) != 0]
        with np.errstate(over="ignore"):
            self.h = mixed((self.total[self.place + GRAM] - self.total[self.place]) * self.down[self.place]) if found else np.empty(0, np.uint64)
        self.doc = np.searchsorted(bounds, self.place, side="right") - 1
        self.low, self.high = bounds[self.doc], bounds[self.doc + 1]

    @staticmethod
    def _whole(anchor: np.ndarray, first: int, bounds: np.ndarray) -> np.ndarray:
        """The anchors, without those that repeat the one before, of the strings from byte ``first`` on that no bound cuts."""
        n = len(anchor)
        inner = bounds[np.searchsorted(bounds, first, side="right") : np.searchsorted(bounds, first + n + LENGTH - 1, side="left")] - first
        keep = np.diff(anchor, prepend=-1) != 0
        if len(inner):
            cut = np.zeros(n + 1, np.int32)
            np.add.at(cut, np.clip(inner - LENGTH + 1, 0, n), 1)
            np.add.at(cut, np.clip(inner, 0, n), -1)
            whole = np.cumsum(cut[:-1]) == 0
            keep[1:] |= ~whole[:-1]
            keep &= whole
        return anchor[keep]

    def ranges(self, start: np.ndarray, end: np.ndarray, salt: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed(((self.total[end] - self.total[start]) * self.down[start] + U(salt)) ^ (end - start).astype(np.uint64) << U(48))

    def level(self, j: int, which: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, ...]:
        """Hash, fit, first and last byte of the contexts around the j-th 83-byte range of anchors."""
        place, low, high = self.place[which], self.low[which], self.high[which]
        start, end = place - SIDE * j, place + LENGTH - SIDE * (j + 1)
        first, last = np.maximum(start - SIDE, low), np.minimum(end + SIDE, high)
        fits = (start >= low) & (end <= high) & (last - first >= LENGTH)
        return self.ranges(np.where(fits, start, place), np.where(fits, end, place), 2 * j + 1), fits, first, last


def _mix(x: np.ndarray) -> None:
    """``mixed`` in place."""
    x += GOLD
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)


def _among(h: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Whether the sorted ``hot`` holds each of ``h``."""
    if not len(hot):
        return np.zeros(len(h), bool)
    return hot[np.minimum(np.searchsorted(hot, h), len(hot) - 1)] == h


class Records:
    """Contexts of a chunk of texts, by owner, as columns: key, digest, four range digests, document, first and last byte, place of the anchor."""

    def __init__(self, keys: np.ndarray, firsts: np.ndarray, data: np.ndarray, bounds: np.ndarray, hot: np.ndarray) -> None:
        scan = Scan(data, bounds)
        heavy = _among(scan.h, hot)
        one = np.flatnonzero(~heavy)
        place, low, high = scan.place[one], scan.low[one], scan.high[one]
        a, b = np.maximum(place - REACH, low), np.minimum(place + LENGTH, high)
        digest = scan.ranges(a, b, 101) if len(one) else np.empty(0, np.uint64)
        grams = np.empty((len(one), STEPS), np.uint32)
        for j in range(STEPS if len(one) else 0):
            g, fits, _, _ = scan.level(j, one)
            grams[:, j] = np.where(fits, g, mixed(digest ^ U(j))).astype(np.uint32)
        hashes, digests, docs, first, last, many, before = [scan.h[one]], [digest], [scan.doc[one]], [a], [b], [grams], [place - a]
        two = np.flatnonzero(heavy)
        for j in range(STEPS if len(two) else 0):
            g, fits, a, b = scan.level(j, two)
            wide = _among(g, hot) & fits
            plain = np.flatnonzero(fits & ~wide)
            hashes.append(g[plain])
            digests.append(scan.ranges(a[plain], b[plain], 103 + 2 * j))
            docs.append(scan.doc[two][plain])
            first.append(a[plain])
            last.append(b[plain])
            x = np.flatnonzero(wide)
            starts = _spread(a[x], np.maximum(b[x] - LENGTH - a[x] + 1, 0))
            owners = np.repeat(scan.doc[two][x], np.maximum(b[x] - LENGTH - a[x] + 1, 0))
            string = scan.ranges(starts, starts + LENGTH, 99)
            hashes.append(string)
            digests.append(string)
            docs.append(owners)
            first.append(starts)
            last.append(starts + LENGTH)
            many.append(np.zeros((len(plain) + len(starts), STEPS), np.uint32))
            before.append(np.zeros(len(plain) + len(starts), np.int64))
        self.key, self.digest, self.doc, self.a, self.b = map(np.concatenate, (hashes, digests, docs, first, last))
        self.grams, self.before = np.concatenate(many), np.concatenate(before).astype(np.uint8)
        start = bounds[self.doc] - firsts[self.doc]
        self.a, self.b = self.a - start, self.b - start
        if len(two) or (keys[1:] == keys[:-1]).any():  # in order of their owners again
            order = np.lexsort((self.a, keys[self.doc]))
            self.key, self.digest, self.doc, self.a, self.b, self.grams, self.before = (x[order] for x in (self.key, self.digest, self.doc, self.a, self.b, self.grams, self.before))


def _texts(batches: Iterator[pa.RecordBatch], most: int = _CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Keys, first bytes, bytes side by side and bounds of a few MB of texts at a time, in order of the keys.

    Longer texts come in pieces that overlap by 99 bytes, so each 100-byte string is whole in one.
    """
    keys: list[int] = []
    firsts: list[int] = []
    raw: list[bytes] = []
    held = 0

    def chunk() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        k, first = np.array(keys, np.int64), np.array(firsts, np.int64)
        order = np.lexsort((first, k))
        texts = [raw[i] for i in order.tolist()]
        return k[order], first[order], np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])

    for batch in batches:
        for k, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
            size = len(t.as_buffer()) if t.is_valid else 0
            if size < LENGTH:
                continue
            t = t.as_py()
            for first in range(0, size - LENGTH + 1, most):
                keys.append(k)
                firsts.append(first)
                raw.append(t[first : first + most + LENGTH - 1])
                held += len(raw[-1])
                if held > most:
                    yield chunk()
                    keys, firsts, raw, held = [], [], [], 0
    if raw:
        yield chunk()


def _merged(k: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of documents, those that touch made one."""
    if not len(k):
        return k, a, b
    order = np.lexsort((a, k))
    k, a, b = k[order], a[order], b[order]
    doc = np.cumsum(np.diff(k, prepend=k[0]) != 0)
    reach = np.maximum.accumulate(b + (doc << 40)) - (doc << 40)
    new = np.ones(len(k), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (a[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return k[first], a[first], reach[np.append(first[1:], len(k)) - 1]


def _heavy(rows: DataFrame, hot: int) -> tuple[np.ndarray, int]:
    """The sorted keys with more than ``hot`` contexts, counted where a few MB of text hold two at least; the number of records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, data, bounds in _texts(batches):
            scan = Scan(data, bounds)
            n = len(scan.h)
            found = [(np.zeros(1, np.uint64), np.array([n]), np.array([True]))]
            if n:
                a, b = np.maximum(scan.place - REACH, scan.low), np.minimum(scan.place + LENGTH, scan.high)
                twice, many = _several(scan.h, scan.ranges(a, b, 101))
                found.append((twice, many, np.zeros(len(twice), bool)))
                two = np.flatnonzero(_among(scan.h, twice))
                for j in range(STEPS if len(two) else 0):
                    g, fits, a, b = scan.level(j, two)
                    twice, many = _several(g[fits], scan.ranges(a[fits], b[fits], 103 + 2 * j))
                    found.append((twice, many, np.zeros(len(twice), bool)))
            h, many, total = map(np.concatenate, zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(many.astype(np.int64)), pa.array(total)], ["h", "n", "total"])

    counts = rows.mapInArrow(lean(run, forget), "h long, n long, total boolean").groupBy("total", "h").agg(F.sum("n").alias("n"))
    counts = stored(counts.filter(F.col("total") | (F.col("n") > hot)), "counts")
    total = counts.filter("total").agg(F.sum("n")).first()[0] or 0
    least = max(hot, total // SPLIT_KEYS)  # of so many contexts there are SPLIT_KEYS anchors at most, and four times as many ranges
    keys = counts.filter(~F.col("total") & (F.col("n") > least)).select("h").toArrow().column(0).to_numpy()
    return np.sort(keys.astype(np.int64).view(np.uint64)), total


def _several(key: np.ndarray, digest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted keys with two distinct digests at least, and how many."""
    both = np.unique(np.stack([key, digest], 1), axis=0)[:, 0] if len(key) < 2 else _pairs(key, digest)
    first = np.flatnonzero(np.diff(both, prepend=~both[:1]) != 0) if len(both) else np.empty(0, np.int64)
    many = np.diff(first, append=len(both))
    return both[first][many > 1], many[many > 1]


def _pairs(key: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """The keys of the distinct pairs, sorted."""
    order = np.lexsort((digest, key))
    key, digest = key[order], digest[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (digest[1:] != digest[:-1])
    return key[new]


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> U(32)) * U(buckets)) >> U(32)


_FOUND = "k long, a long, b long, key long"


def _found(k: np.ndarray, a: np.ndarray, b: np.ndarray, key: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(k), 50_000):
        some = slice(i, i + 50_000)
        asked = pa.nulls(len(k[some]), pa.int64()) if key is None else pa.array(key[some].view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(k[some]), pa.array(a[some].astype(np.int64)), pa.array(b[some].astype(np.int64)), asked], ["k", "a", "b", "key"])


def _matched(rows: DataFrame, hot: np.ndarray, buckets: int) -> DataFrame:
    """(k, a, b, key): ranges of contexts that an earlier owner has, without a key; contexts to be sorted, with theirs."""
    shared = rows.sparkSession.sparkContext.broadcast((hot, labels(buckets)))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, label = shared.value
        for keys, firsts, data, bounds in _texts(batches):
            r = Records(keys, firsts, data, bounds, hot)
            order = np.argsort(mixed(r.key ^ mixed(r.digest)), kind="stable")  # of equal ones the earliest stays first
            same = np.zeros(len(order), bool)
            key, digest = r.key[order], r.digest[order]
            same[1:] = (key[1:] == key[:-1]) & (digest[1:] == digest[:-1])
            first = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
            own, rep = order, order[first]
            again = own[same & ((keys[r.doc[own]] != keys[r.doc[rep]]) | (r.a[own] != r.a[rep]))]
            ranges = np.concatenate(_merged(keys[r.doc[again]], r.a[again], r.b[again])).astype(np.int64)
            one = np.sort(order[~same])
            bucket = _bucket(r.key[one], buckets)
            deal = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 16 else bucket, kind="stable")
            one, bucket = one[deal], bucket[deal]
            cuts = np.flatnonzero(np.diff(bucket, prepend=U(buckets)) != 0)
            packed = []
            for s, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(one)]):
                x = one[s:e]
                columns = (r.key[x], r.digest[x], r.grams[x], keys[r.doc[x]], r.a[x].astype(np.uint32), (r.b[x] - r.a[x]).astype(np.uint8), r.before[x])
                packed.append(b"".join(c.tobytes() for c in columns))
            where, kinds = label[bucket[cuts].astype(np.int64)].tolist(), [False] * len(packed)
            if len(ranges):
                where.append(int(label[int(keys[0]) % buckets]))
                packed.append(ranges.tobytes())
                kinds.append(True)
            yield pa.RecordBatch.from_arrays([pa.array(where, pa.int64()), pa.array(kinds, pa.bool_()), pa.array(packed, pa.binary())], ["bucket", "ranges", "packed"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list[np.ndarray]] = [[] for _ in range(7)]
        for batch in batches:
            for ranges, blob in zip(batch.column(1).to_pylist(), batch.column(2)):
                raw = blob.as_buffer()
                if ranges:
                    yield from _found(*np.frombuffer(raw, np.int64).reshape(3, -1))
                    continue
                n, upto = len(raw) // 46, 0
                for c, (kind, wide) in zip(columns, ((np.uint64, 8), (np.uint64, 8), (np.uint32, 16), (np.int64, 8), (np.uint32, 4), (np.uint8, 1), (np.uint8, 1))):
                    c.append(np.frombuffer(raw, kind, n * wide // np.dtype(kind).itemsize, upto))
                    upto += n * wide
        if not columns[0]:
            return
        key, digest, grams, k, a, size, before = map(np.concatenate, columns)
        columns.clear()
        order = np.lexsort((a, k, digest, key))
        key, digest, k, a, before = key[order], digest[order], k[order], a[order].astype(np.int64), before[order]
        b = a + size[order]
        same = np.zeros(len(key), bool)
        same[1:] = (key[1:] == key[:-1]) & (digest[1:] == digest[:-1])
        rep = np.maximum.accumulate(np.where(same, 0, np.arange(len(key))))
        again = same & ((k != k[rep]) | (a != a[rep]))
        yield from _found(*_merged(k[again], a[again], b[again]))
        one = np.flatnonzero(~same)
        group = np.cumsum(np.diff(key[one], prepend=~key[one][:1]) != 0) - 1
        several = np.bincount(group)[group] > 1
        one, group = one[several], group[several]
        grams = grams.reshape(-1, STEPS)[order[one]]
        alike = np.zeros((len(one), STEPS), bool)
        for j in range(STEPS):
            sort = np.lexsort((grams[:, j], group))
            g, own = grams[sort, j], group[sort]
            pair = np.flatnonzero((g[1:] == g[:-1]) & (own[1:] == own[:-1]))
            alike[sort[pair], j] = alike[sort[pair + 1], j] = True
        keep = alike.any(1)
        crowd = keep & (np.bincount(group, keep)[group] > MANY) & grams.any(1) if len(one) else keep
        for j in range(STEPS if crowd.any() else 0):
            which = crowd & alike[:, j]
            some = one[which]
            start = a[some] + before[some] - SIDE * (j + 1)
            first, last = np.maximum(start, a[some]), np.minimum(start + LENGTH + SIDE, b[some])
            long = last - first >= LENGTH
            with np.errstate(over="ignore"):
                part = mixed(key[some] ^ mixed(grams[which, j].astype(np.uint64) | U(j + 1 << 32)))
            yield from _found(k[some][long], first[long], last[long], part[long])
        one = one[keep & ~crowd]
        yield from _found(k[one], a[one], b[one], key[one])

    dealt = rows.mapInArrow(lean(emit, forget), "bucket long, ranges boolean, packed binary").repartition(buckets, "bucket")
    return dealt.mapInArrow(lean(gather), _FOUND)


def _marked(rows: DataFrame, asked: DataFrame, buckets: int) -> DataFrame:
    """(k, a, b): ranges of the repeated strings that the suffix arrays of the contexts asked for show."""

    shared = rows.sparkSession.sparkContext.broadcast(labels(buckets))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                wanted = part.column(2).flatten()
                a, b, key = (wanted.field(i).to_numpy() for i in range(3))
                key = key.view(np.uint64)
                texts = [t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()]
                data = np.frombuffer(b"".join(texts), np.uint8)
                size = np.array(list(map(len, texts)), np.int64)
                row = np.repeat(np.arange(part.num_rows), part.column(2).value_lengths().to_numpy())
                fits = b <= size[row]  # rows that share a key need not share a length
                a, b, key, row = a[fits], b[fits], key[fits], row[fits]
                owner = part.column(0).to_numpy()[row]
                start = (np.cumsum(size) - size)[row] + a
                bucket = _bucket(key, buckets)
                deal = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.diff(bucket[deal], prepend=U(buckets)) != 0)
                packed = []
                for s, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(deal)]):
                    x = deal[s:e]
                    wide = b[x] - a[x]
                    columns = (np.array([len(x)]), key[x], owner[x], a[x].astype(np.uint32), wide.astype(np.uint8), data[_spread(start[x], wide)])
                    packed.append(b"".join(c.tobytes() for c in columns))
                yield pa.RecordBatch.from_arrays([pa.array(label[bucket[deal][cuts].astype(np.int64)]), pa.array(packed, pa.binary())], ["bucket", "packed"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list[np.ndarray]] = [[] for _ in range(5)]
        for batch in batches:
            for blob in batch.column(1):
                raw = blob.as_buffer()
                n, upto = int(np.frombuffer(raw, np.int64, 1)[0]), 8
                for c, kind in zip(columns, (np.uint64, np.int64, np.uint32, np.uint8)):
                    c.append(np.frombuffer(raw, kind, n, upto))
                    upto += n * np.dtype(kind).itemsize
                columns[4].append(np.frombuffer(raw, np.uint8, -1, upto))
        if not columns[0]:
            return
        key, k, a, size, body = map(np.concatenate, columns)
        columns.clear()
        size, a = size.astype(np.int64), a.astype(np.int64)
        start = np.cumsum(size) - size
        words = np.ndarray(len(body) - 7, "<u8", body, strides=(1,))
        with np.errstate(over="ignore"):
            digest = mixed(words[start + size - 8] ^ size.astype(np.uint64))
            for step in range(0, int(size.max()) - 7, 8):
                some = size >= step + 8
                digest[some] = mixed(digest[some] ^ words[start[some] + step])
        order = np.lexsort((a, k, digest, key))
        key, digest, k, a, size = key[order], digest[order], k[order], a[order], size[order]
        same = np.zeros(len(order), bool)
        same[1:] = (key[1:] == key[:-1]) & (digest[1:] == digest[:-1])
        rep = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
        again = same & ((k != k[rep]) | (a != a[rep]))
        yield from _found(*_merged(k[again], a[again], a[again] + size[again]))
        order, key, k, a, size = (x[~same] for x in (order, key, k, a, size))
        data = body[_spread(start[order], size)]
        bounds = np.concatenate([[0], np.cumsum(size)])
        groups = np.append(np.flatnonzero(np.diff(key, prepend=~key[:1]) != 0), len(key))
        context, offset = repeated(data, bounds, groups, k, a)
        yield from _found(*_merged(k[context], a[context] + offset, a[context] + offset + LENGTH))

    wanted = stored(asked.groupBy("k").agg(F.collect_list(F.struct("a", "b", "key")).alias("wanted")), "asked")
    cuts = rows.join(wanted, "k").select("k", "t", "wanted").mapInArrow(lean(cut), "bucket long, packed binary")
    return cuts.repartition(buckets, "bucket").mapInArrow(lean(sort), _FOUND).select("k", "a", "b")


def _numbered(docs: DataFrame, key: str) -> tuple[Column | None, DataFrame | None]:
    """Integral keys without nulls number their rows themselves; for others, a table of keys and their ranks, null first."""
    kind = docs.schema[key].dataType.simpleString()
    column = F.col(f"`{key}`")
    if kind in ("bigint", "int", "smallint", "tinyint") and not docs.filter(column.isNull()).limit(1).count():
        return column.cast("long"), None
    ranks = docs.select(column.alias("_key")).distinct().sort(F.col("_key").asc_nulls_first())
    return None, stored(ranks.select("_key", F.monotonically_increasing_id().alias("k")), "ranks")


def _rows(docs: DataFrame, key: str, text: str, number: Column | None, ranks: DataFrame | None) -> DataFrame:
    """(_key, k, t) of every row."""
    own = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("t"), *([number.alias("k")] if ranks is None else []))
    if ranks is not None:
        own = own.join(ranks.select(F.col("_key").alias("_same"), "k"), F.col("_key").eqNullSafe(F.col("_same")))
    return own.select("_key", "k", "t")


def _ranges(rows: DataFrame, hot: int) -> DataFrame:
    base = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy, total = _heavy(rows, hot)
    found = stored(_matched(rows, heavy, max(base, total // RECORDS)), "contexts")
    size = found.filter("key is not null").agg(F.sum(F.col("b") - F.col("a"))).first()[0] or 0
    marked = stored(_marked(rows, found.filter("key is not null"), max(base, size // BYTES)), "marked")
    return found.filter("key is null").select("k", "a", "b").unionByName(marked)


def removed_ranges(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """(k, a, b): byte ranges, overlapping maybe, that the rule removes from the document of number ``k``."""
    return _ranges(_rows(docs, key, text, *_numbered(docs, key)).select("k", "t"), hot)


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT, digest: bool = True) -> DataFrame:
    """The key, n_bytes, n_removed, n_spans and kept_sha256 of each row, or with ``digest`` off the kept bytes as ``kept``."""
    kind = docs.schema[key].dataType.simpleString()
    rows = _rows(docs, key, text, *_numbered(docs, key))
    spans = stored(_ranges(rows.select("k", "t"), hot).groupBy("k").agg(F.collect_list(F.struct("a", "b")).alias("spans")), "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lists = part.column(2)
                many = lists.value_lengths().fill_null(0).to_numpy()
                flat = lists.flatten()
                doc, a, b = _merged(np.repeat(np.arange(part.num_rows), many), flat.field(0).to_numpy(), flat.field(1).to_numpy())
                upto = np.searchsorted(doc, np.arange(part.num_rows + 1)).tolist()
                a, b, rows = a.tolist(), b.tolist(), []
                for i, raw in enumerate(part.column(1).cast(pa.binary()).to_pylist()):
                    raw, kept, done, n = raw or b"", [], 0, 0
                    for s, e in zip(a[upto[i] : upto[i + 1]], b[upto[i] : upto[i + 1]]):
                        if s < len(raw):  # rows that share a key need not share a length
                            kept.append(raw[done:s])
                            done, n = min(e, len(raw)), n + 1
                    kept.append(raw[done:])
                    rest = b"".join(kept)
                    rows.append((len(raw), len(raw) - len(rest), n, hashlib.sha256(rest).hexdigest() if digest else rest))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(columns[i], pa.int64()) for i in range(3)), pa.array(columns[3], pa.string() if digest else pa.binary())], [key, "n_bytes", "n_removed", "n_spans", "kept_sha256" if digest else "kept"])

    joined = rows.join(spans, "k", "left").select("_key", "t", "spans")
    return joined.mapInArrow(lean(run), f"`{key}` {kind}, n_bytes long, n_removed long, n_spans long, " + ("kept_sha256 string" if digest else "kept binary"))
