"""N-gram Jaccard join with PartEnum signatures.

Set sizes are cut into bands whose ends are in the ratio of the threshold, so
two similar sets lie in one band or in neighbouring ones, and each set signs
for its own band and the next.  Similar sets of a band differ in at most k
elements, which its largest size gives.  The hash domain is cut into n1 first-level
partitions and each of these into ``CELLS`` second-level ones; a set signs under
every subset of ``CELLS - 1`` of the latter, where a signature is the sum of the mixed
hashes that lie in the subset.  If every first-level partition held two differences,
there would be 2 n1 > k of them, so some partition holds one at most, and
the subset without its cell is equal in both sets.

A subset without elements says nothing and is left out.  To break all the
others takes one difference in a partition with one cell in use and two
in any other; if the k differences suffice for that, the set signs under
up to two further partitions of the domain, the last with its empty subsets, and no
pair is lost.  What they don't suffice for is the number of signatures that
similar sets share at least, so a class that shares fewer than that
has no partner and is left out.  n1 exceeds k / 2 by ``SLACK`` to make that number larger.

Work is done on classes of equal sets, found by digest, so copies cost nothing.
1. Signatures are gathered by range in packed blobs; those of one class only are
   left out, and then, twice, classes that share too few.
2. Every class is compared exactly with its hub, the class of most shared
   signatures that shares one with it; links are closed to components.
3. Signatures whose classes still lie in several components are worked off: their classes
   are compared with the end of their chain of hubs, which all of a group have in common.  Then
   classes of different chains are compared if their sizes allow a link; classes of
   one chain only if the elements in which they differ from its end overlap as a link
   demands (prefix filter by frequency).
A pair within a component needs no comparison, so the pairs of a group of
copies are never listed.

Set and class digests have 64 bits, signatures 40 within a range; links are decided on the sets themselves.
Defined results: a null or empty text, or one without words, has an empty set and is linked with
nothing; a text of fewer words than a shingle is one shingle; rows with equal
keys are each given the result of their own text, and a null key counts as the greatest; an empty table
gives no rows; ``join`` leaves out other columns, whatever their names, ``keep_one`` returns them untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyproof.llm.deal import labels
from tallyproof.llm.shingles import GOLD, U, fingerprints, forget, mixed, shingle_sets
from tallyproof.llm.storage import discard, lean, stored

CLASS_SALT, PART_SALT = 0x1234ABCD5678EF01, 0x0F1E2D3C4B5A6978
LEVELS = 3
CELLS = 3
SUBSETS = list(combinations(range(CELLS), CELLS - 1))
SLACK = 0.1
BLOB = 1_000_000  # signatures that a task of the gathering step takes on average
#: Bits of the filter on wanted classes: so many a class, and at most; past that, more sets than wanted are shuffled.
BITS_EACH, BITS_MOST = 16, 28


class Bands:
    """Sizes 1, 2, ... cut into bands; similar sizes, at least num/den of each other, are in neighbouring ones."""

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den
        self.first, self.last = [1], [1]
        while self.last[-1] < 1 << 40:
            low = self.last[-1] + 1
            self.first.append(low)
            self.last.append(low * den // num)
        r = np.array(self.last, np.int64)
        self.differ = (den - num) * 2 * r // (den + num)  # k of each band
        least = self.differ // 2
        self.partitions = least + 1 + np.ceil(least * SLACK).astype(np.int64)  # n1

    def of(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.last, n)


def signatures(sets: list[np.ndarray], bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted sets of mixed hashes: signatures, number of the set, code of band and level, and how many of a code a partner shares at least."""
    out: list[tuple[np.ndarray, ...]] = []
    with np.errstate(over="ignore"):
        for ahead in (0, 1):
            some = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
            for level in range(LEVELS):
                if not len(some):
                    break
                size = np.array([len(sets[i]) for i in some.tolist()], np.int64)
                elements = np.concatenate([sets[i] for i in some.tolist()])
                band = bands.of(size) + ahead
                parts = bands.partitions[band]
                own = np.repeat(np.arange(len(some)), size)
                h = mixed(elements ^ U(0x51ED27 * level + 1))
                part = ((h >> U(32)) * parts.astype(np.uint64)[own]) >> U(32)
                cell = ((h & U(0xFFFFFFFF)) * U(CELLS)) >> U(32)
                before = np.cumsum(parts) - parts
                at = (part.astype(np.int64) + before[own]) * CELLS + cell.astype(np.int64)
                sums = np.zeros(int(parts.sum()) * CELLS, np.uint64)
                np.add.at(sums, at, mixed(elements ^ U(PART_SALT)))
                used = np.bincount(at, minlength=len(sums)).reshape(-1, CELLS) > 0
                sums = sums.reshape(-1, CELLS)
                own = np.repeat(np.arange(len(some)), parts)
                cost = np.bincount(own, np.minimum(used.sum(1), 2), len(some)).astype(np.int64)
                sure = cost - bands.differ[band]
                empties = (sure <= 0) & (level == LEVELS - 1)
                base = band.astype(np.uint64)[own] * U(0x2545F4914F6CDD1D) + (np.arange(len(own)) - before[own]).astype(np.uint64) * GOLD
                code = np.full(len(own), ahead * LEVELS + level, np.uint8)
                for n, subset in enumerate(SUBSETS):
                    keep = used[:, subset].any(1) | empties[own]
                    sig = mixed(mixed(sums[keep][:, subset].sum(1, dtype=np.uint64) + base[keep]) + U(n * LEVELS + level))
                    out.append((sig, some[own[keep]], code[keep], np.clip(sure, 1, 60_000).astype(np.uint16)[own[keep]]))
                some = some[sure <= 0]
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.uint8), np.empty(0, np.uint16)
    return tuple(map(np.concatenate, zip(*out)))


def similar(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    return len(np.intersect1d(a, b, assume_unique=True))


def _chunks(batches: Iterator[pa.RecordBatch], rows: int = 150) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _members(docs: DataFrame, text: str, words: int, bands: Bands, buckets: int) -> DataFrame:
    """(sig, cls, code, least) of signatures that two classes at least share."""
    shared = docs.sparkSession.sparkContext.broadcast(labels(buckets))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen, n, label = [], set(), 0, shared.value

        def blobs() -> pa.RecordBatch:
            s, c, code, least = map(np.concatenate, zip(*held))
            bucket = ((s >> U(32)) * U(buckets)) >> U(32)
            order = np.lexsort((c, bucket))
            s, c, code, least, bucket = s[order], c[order], code[order], least[order], bucket[order]
            first = np.flatnonzero(np.diff(bucket, prepend=U(buckets)) != 0)
            packed = []
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(s)]):
                columns = (s[a:b].astype(np.uint32), (s[a:b] >> U(32)).astype(np.uint8), c[a:b], code[a:b], least[a:b])
                packed.append(b"".join(x.tobytes() for x in columns))
            where = bucket[first].astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(label[where]), pa.array(where), pa.array(packed, pa.binary())], ["dealt", "bucket", "packed"])

        for part in _chunks(batches):
            new, classes = [], []
            sets = shingle_sets(part.column(0).to_pylist(), words)
            for s, cls in zip(sets, fingerprints(sets, CLASS_SALT).tolist()):
                if len(s) and cls not in seen:  # copies in a task sign once
                    seen.add(cls)
                    new.append(s)
                    classes.append(cls)
            sig, own, code, least = signatures(new, bands)
            held.append((sig, np.array(classes, np.int64)[own], code, least))
            n += len(sig)
            if n > 350_000:
                yield blobs()
                held, seen, n = [], set(), 0
        if n:
            yield blobs()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list[np.ndarray]] = [[] for _ in range(4)]
        for batch in batches:
            for bucket, blob in zip(batch.column(1).to_pylist(), batch.column(2)):
                raw = blob.as_buffer()
                n, upto = len(raw) // 16, 5 * (len(raw) // 16)
                s = np.frombuffer(raw, np.uint8, n, 4 * n).astype(np.uint64)
                s <<= U(32)
                s |= np.frombuffer(raw, np.uint32, n)
                s |= U(bucket << 40)
                columns[0].append(s)
                for column, kind in zip(columns[1:], (np.int64, np.uint8, np.uint16)):
                    column.append(np.frombuffer(raw, kind, n, upto))
                    upto += n * np.dtype(kind).itemsize
        if not columns[0]:
            return
        s, c, code, least = map(np.concatenate, columns)
        columns.clear()
        order = np.argsort(s, kind="stable")
        s = s[order]
        alone = np.diff(s, prepend=~s[:1]) != 0
        alone[:-1] &= alone[1:]  # neither like the one before nor like the one after
        s, order = s[~alone], order[~alone]
        c, code, least = c[order], code[order], least[order]
        order = np.lexsort((c, s))
        s, c, code, least = s[order], c[order], code[order], least[order]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (c[1:] != c[:-1])
        s, c, code, least = s[new], c[new], code[new], least[new]
        first = np.flatnonzero(np.diff(s, prepend=~s[:1]) != 0) if len(s) else np.empty(0, int)
        many = np.repeat(np.diff(first, append=len(s)), np.diff(first, append=len(s))) > 1
        s, c, code, least = s[many].view(np.int64), c[many], code[many], least[many]
        for at in range(0, len(s), 50_000):
            some = slice(at, at + 50_000)
            yield pa.RecordBatch.from_arrays([pa.array(s[some]), pa.array(c[some]), pa.array(code[some].astype(np.int8)), pa.array(least[some].astype(np.int32))], ["sig", "cls", "code", "least"])

    return docs.select(F.col(f"`{text}`").alias("_text")).mapInArrow(lean(sign, forget), "dealt long, bucket long, packed binary").repartition(buckets, "dealt").mapInArrow(lean(gather), "sig long, cls long, code byte, least int")


def _enough(members: DataFrame) -> DataFrame:
    """Without the members that have no partner: those whose signature is shared by no other, or that share fewer than a partner would."""
    shared = members.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("cls", "code"))).filter("n >= least").drop("n")
    several = stored(shared, "members")
    discard(members)
    left = stored(several.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("sig"))).filter("n > 1"), "members")
    discard(several)
    return left


def _filter_of(classes: DataFrame) -> tuple[int, bytes]:
    """A bitmap with the bits of all classes of a DataFrame, 16 a class and at most 32 MB in all, merged on the executors."""
    n = classes.count()
    width = min(max(20, (n * BITS_EACH).bit_length()), BITS_MOST)
    size, chunk = 1 << width - 3, 1 << 13

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            v = np.asarray(batch.column(0)).view(np.uint64)
            place = (v >> U(64 - width + 3)).astype(np.int64)
            order = np.argsort(place // chunk, kind="stable")
            v, place = v[order], place[order]
            first = np.flatnonzero(np.diff(place // chunk, prepend=-1) != 0)
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(v)]):
                into = found.setdefault(int(place[a]) // chunk, np.zeros(chunk, np.uint8))
                np.bitwise_or.at(into, place[a:b] % chunk, np.uint8(1) << (v[a:b] & U(7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([x.tobytes() for x in found.values()], pa.binary())], ["at", "bits"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                v = np.frombuffer(b, np.uint8)
                found[at] = found[at] | v if at in found else v
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([v.tobytes() for v in found.values()], pa.binary())], ["at", "bits"])

    schema = "at long, bits binary"
    dealt = classes.select("cls").repartition(max(1, min(size // chunk, n // 200_000 + 1)), F.shiftrightunsigned("cls", 64 - width + 16))
    rows = dealt.mapInArrow(bits, schema).repartition(16, "at").mapInArrow(merge, schema).toArrow()  # as many bytes as the filter has, at most
    out = np.zeros((size // chunk, chunk), np.uint8)
    for at, b in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
        out[at] = np.frombuffer(b, np.uint8)
    return width, out.tobytes()


def _rows(docs: DataFrame, key: str, text: str, words: int, wanted: DataFrame) -> DataFrame:
    """Each row's key, set size, class, and the set of a wanted class where a task meets it first, with a few others that pass the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(_filter_of(wanted))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, bits = shared.value
        bits, seen = np.frombuffer(bits, np.uint8), set()
        for part in _chunks(batches):
            sets = shingle_sets(part.column(1).to_pylist(), words)
            classes = fingerprints(sets, CLASS_SALT)
            v = classes.view(np.uint64)
            hit = bits[(v >> U(64 - width + 3)).astype(np.int64)] >> (v & U(7)).astype(np.uint8) & 1 == 1
            packed = []
            for s, cls, h in zip(sets, classes.tolist(), hit.tolist()):
                first = h and len(s) > 0 and cls not in seen
                if first:
                    seen.add(cls)
                packed.append(s.tobytes() if first else None)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(classes), pa.array(packed, pa.binary())], ["k", "n", "cls", "elements"])

    return docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).mapInArrow(lean(run, forget), f"k {kind}, n long, cls long, elements binary")


def _verified(pairs: DataFrame, sets: DataFrame, differences: bool = False) -> DataFrame:
    """Pairs (a, b) with the sizes of both sets and of what they share; if asked for, the elements of just one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches, 2000):
            na, nb, both, apart = [], [], [], []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                na.append(len(p))
                nb.append(len(q))
                both.append(similar(p, q))
                if differences:
                    apart.append(np.setxor1d(p, q, assume_unique=True).view(np.int64))
            columns = [batch.column(0), batch.column(1), *(pa.array(v, pa.int64()) for v in (na, nb, both))]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(apart, pa.list_(pa.int64()))] * differences, ["a", "b", "na", "nb", "both"] + ["apart"] * differences)

    one = sets.select(F.col("cls").alias("a"), F.col("elements").alias("ea"))
    two = sets.select(F.col("cls").alias("b"), F.col("elements").alias("eb"))
    return pairs.join(two, "b").join(one, "a").select("a", "b", "ea", "eb").mapInArrow(lean(run), "a long, b long, na long, nb long, both long" + ", apart array<long>" * differences)


def roots(nodes: DataFrame, parents: DataFrame, most: int = 60) -> DataFrame:
    """(cls, label): where the chain of (a, b) links from each node ends; each node links at most once, to a greater one."""
    up = nodes.select("cls").join(parents.select(F.col("a").alias("cls"), "b"), "cls", "left").select("cls", F.coalesce("b", "cls").alias("label"))
    up = stored(up, "roots")
    for _ in range(most):
        above = up.select(F.col("cls").alias("label"), F.col("label").alias("far"))
        after = stored(up.join(above, "label").select("cls", F.col("far").alias("label"), (F.col("far") != F.col("label")).alias("moved")), "roots")
        up = after.select("cls", "label")
        if not after.filter("moved").limit(1).count():
            return up
    raise RuntimeError("chains did not end")


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(cls, label) of the nodes of (a, b) edges: the least node of each one's component.

    Each round every node takes the least label near it and then that label's
    own; labels of stars settle in two rounds, of chains in the logarithm of their length.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("cls")).agg(F.min("b").alias("b")).select("cls", F.least("cls", "b").alias("label"))
    labels = stored(labels, "labels")
    for _ in range(most):
        heard = both.join(labels.select(F.col("cls").alias("b"), "label"), "b").groupBy(F.col("a").alias("cls")).agg(F.min("label").alias("heard"))
        jump = labels.select(F.col("cls").alias("label"), F.col("label").alias("far"))
        after = labels.join(jump, "label").join(heard, "cls").select("cls", F.least("far", "heard").alias("label"), (F.least("far", "heard") < F.col("label")).alias("moved"))
        after = stored(after, "labels")
        labels = after.select("cls", "label")
        if not after.filter("moved").limit(1).count():
            return labels
    raise RuntimeError("components did not settle")


def _open(state: DataFrame) -> DataFrame:
    """The members of signatures whose classes lie in several components, with the label of most of them as ``top``."""
    by_label = state.groupBy("sig", "label").count()
    several = by_label.groupBy("sig").agg(F.count(F.lit(1)).alias("labels"), F.max(F.struct("count", "label")).alias("top")).filter("labels > 1").select("sig", F.col("top.label").alias("top"))
    return stored(state.join(several, "sig"), "open")


def _common(state: DataFrame, central: DataFrame, rounds: int = 2) -> DataFrame:
    """With the hub of a class the most central of those of all it shares a signature with, in ``rounds`` rounds: one a group, mostly."""
    own = F.coalesce("hub", "cls")
    at = state.select("cls", own.alias("hub")).distinct().join(central.select(F.col("cls").alias("hub"), "degree"), "hub").select("cls", F.struct("degree", "hub").alias("top"))
    for _ in range(rounds):
        by_sig = state.select("sig", "cls").join(at, "cls").groupBy("sig").agg(F.max("top").alias("top"))
        at = stored(state.select("sig", "cls").join(by_sig, "sig").groupBy("cls").agg(F.max("top").alias("top")), "hubs")
    hub = F.when(F.col("_hub") != F.col("cls"), F.col("_hub"))
    return stored(state.join(at.select("cls", F.col("top.hub").alias("_hub")), "cls").withColumn("hub", hub).drop("_hub"), "open")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after (a, b) links."""
    of = lambda c: labels.select(F.col("cls").alias(c), F.col("label").alias(f"label_{c}"))
    between = stored(links.join(of("a"), "a").join(of("b"), "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b")).filter("a <> b").distinct(), "between")
    if not between.limit(1).count():
        return labels
    joined = components(between).select(F.col("cls").alias("label"), F.col("label").alias("wide"))
    return stored(labels.join(joined, "label", "left").select("cls", F.coalesce("wide", "label").alias("label")), "labels")


def _across(state: DataFrame, near) -> DataFrame:
    """Pairs of classes with different hubs that share a signature and lie in different components."""
    fields = ("cls", "label", "size", "hub")
    one = state.filter("label <> top").select("sig", *(F.col(c).alias(f"{c}1") for c in fields))
    two = state.select("sig", "top", *(F.col(c).alias(f"{c}2") for c in fields))
    new = (F.col("label1") != F.col("label2")) & ((F.col("label2") == F.col("top")) | (F.col("cls1") < F.col("cls2"))) & near(F.col("size1"), F.col("size2"))
    met = F.coalesce(F.col("hub1") == F.col("cls2"), F.lit(False)) | F.coalesce(F.col("hub2") == F.col("cls1"), F.lit(False)) | F.coalesce(F.col("hub1") == F.col("hub2"), F.lit(False))
    return one.join(two, (one["sig"] == two["sig"]) & new & ~met).select(F.least("cls1", "cls2").alias("a"), F.greatest("cls1", "cls2").alias("b")).distinct()


def _within(state: DataFrame, far: DataFrame, labels: DataFrame, near, num: int, den: int) -> DataFrame:
    """Pairs of classes with one hub, in different components, that can be linked.

    With D the elements in which a class differs from the hub, two classes
    differ in |D1| + |D2| - 2 |D1 and D2| elements, and a link allows h.  So the
    sets D of a pair share t = (|D1| + |D2| - h) / 2 elements at least, and, each in the order
    of the elements' frequency, one of the first |D| - t + 1; for the smaller
    set these are no more than h / 2 + 1.  Elements that one component alone has come first of all.  A pair with |D1| + |D2| <= h need
    share none: there, classes not in the hub's component meet all that are as near to the hub.
    """
    active = state.select("cls", "label", "size", "hub").filter("hub is not null").distinct()
    home = labels.select(F.col("cls").alias("hub"), F.col("label").alias("home"))
    rows = active.join(far.select(F.col("a").alias("cls"), "apart"), "cls").join(home, "hub")
    widest = F.floor((den - num) * (F.col("size") + F.floor(F.col("size") * den / num)) / (den + num))
    rows = stored(rows.select("hub", "home", "cls", "label", "size", F.size("apart").alias("m"), widest.alias("widest"), "apart"), "apart")
    each, met = rows.select("hub", "cls", "label", F.explode("apart").alias("e")), Window.partitionBy("hub", "e")
    each = each.select("cls", "e", F.count(F.lit(1)).over(met).alias("df"), (F.min("label").over(met) != F.max("label").over(met)).alias("several"))
    # elements that classes of one component alone have link nothing new, but keep their place before the others
    shared = each.filter("several").groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("df", "e"))).alias("order"))
    placed = rows.drop("apart").join(shared, "cls").withColumn("before", F.col("m") - F.size("order"))
    first = F.slice("order", F.lit(1), F.greatest(F.lit(0), F.col("widest") + 1 - F.col("before")).cast("int"))
    placed = placed.select("hub", "cls", "label", "size", "m", "widest", "before", F.posexplode(first).alias("p", "x"))
    placed = placed.select("hub", "cls", "label", "size", "m", "widest", F.col("x.e").alias("e"), (F.col("p") + F.col("before")).alias("p"))
    placed = stored(placed, "placed")
    name = lambda df, i, *more: df.select("hub", *more, *(F.col(c).alias(f"{c}{i}") for c in ("cls", "label", "size", "m", "p")))
    allowed = F.floor((den - num) * (F.col("size1") + F.col("size2")) / (den + num))
    t = F.ceil((F.col("m1") + F.col("m2") - allowed) / 2)
    apart = (F.col("label1") != F.col("label2")) & near(F.col("size1"), F.col("size2"))
    larger = (F.col("m1") > F.col("m2")) | (F.col("m1") == F.col("m2")) & (F.col("cls1") > F.col("cls2"))
    one, two = name(placed, 1, "e"), name(placed.filter("p <= widest / 2"), 2, "e")
    meet = (one["hub"] == two["hub"]) & (one["e"] == two["e"]) & apart & larger & (t > 0) & (F.col("p1") <= F.col("m1") - t) & (F.col("p2") <= F.col("m2") - t)
    sharing = one.join(two, meet).select("cls1", "cls2")
    close = rows.filter("m <= widest").withColumn("p", F.lit(0))
    one, two = name(close, 1), name(close.filter("label <> home"), 2)
    none = one.join(two, (one["hub"] == two["hub"]) & apart & (F.col("m1") + F.col("m2") <= allowed)).select("cls1", "cls2")
    return sharing.unionByName(none).select(F.least("cls1", "cls2").alias("a"), F.greatest("cls1", "cls2").alias("b")).distinct()


def link(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, num: int = 80, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """(rows, labels): every row's key ``k``, set size ``n`` and class ``cls``; the label of each class that was compared.

    Sets are linked when den * intersection >= num * union.
    """
    bands = Bands(num, den)
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    per = 3 * (1 + SLACK) * (den - num) / (den + num) * 2  # signatures a shingle, which takes some six bytes
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size / 6 * per / BLOB) + 1)
    members = _enough(_enough(stored(_members(docs, text, words, bands, buckets), "members")))
    wanted = stored(members.select("cls").distinct(), "wanted")
    rows = stored(_rows(docs, key, text, words, wanted), "rows")
    sets = rows.filter("elements is not null").select("cls", "elements").join(wanted, "cls", "left_semi").groupBy("cls").agg(F.first("elements").alias("elements"))
    sets = stored(sets, "sets")
    rows = rows.select("k", "n", "cls")
    nodes = sets.select("cls", (F.octet_length("elements") / 8).cast("long").alias("size"))

    near = lambda a, b: den * F.least(a, b) >= num * F.greatest(a, b)
    linked = den * F.col("both") >= num * (F.col("na") + F.col("nb") - F.col("both"))

    # each class and the most central class that shares a signature with it, its hub
    central = stored(members.groupBy("cls").agg(F.sum("n").alias("degree")), "central")
    members = members.select("sig", "cls")
    pivots = stored(members.join(central, "cls").groupBy("sig").agg(F.max(F.struct("degree", "cls")).alias("top")), "pivots")
    best = members.join(pivots, "sig").filter("cls <> top.cls").groupBy("cls").agg(F.max("top").alias("top")).select(F.col("cls").alias("a"), F.col("top.cls").alias("b"))
    best = stored(best, "best")
    first = _verified(best, sets).filter(linked).select("a", "b")
    labels = roots(nodes, first)

    # the classes of signatures that are still open, against the end of their chain of hubs
    chains = roots(nodes, best).select("cls", F.when(F.col("label") != F.col("cls"), F.col("label")).alias("hub"))
    state = stored(members.join(nodes.join(labels, "cls").join(chains, "cls"), "cls"), "state")
    discard(members, pivots)
    open_state = _common(_open(state), central)
    far = open_state.select(F.col("cls").alias("a"), F.col("hub").alias("b")).filter("hub is not null").distinct()
    far = stored(_verified(far, sets, differences=True), "links")
    labels = _merged(labels, far.filter(linked).select("a", "b"))
    again = open_state.drop("label", "top").join(labels, "cls")
    open_state = _open(again)
    pairs = _across(open_state, near).unionByName(_within(open_state, far, labels, near, num, den)).distinct()
    labels = _merged(labels, stored(_verified(pairs, sets).filter(linked).select("a", "b"), "links"))
    return rows, labels


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per row of ``docs``: the key, n_shingles, and component_id, the least key that links reach."""
    rows, labels = link(docs, key, text, words, num, den)
    class_label = rows.filter("n > 0").groupBy("cls").agg(F.min("k").alias("least")).join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    class_label = stored(class_label, "classes")
    least = class_label.groupBy("label").agg(F.min("least").alias("component_id"))
    table = stored(class_label.join(least, "label").select("cls", "component_id"), "classes")
    linked = rows.filter("n > 0").join(table, "cls").select(F.col("k").alias(key), F.col("n").alias("n_shingles"), "component_id")
    alone = rows.filter("n = 0").select(F.col("k").alias(key), F.col("n").alias("n_shingles"), F.col("k").alias("component_id"))
    return linked.unionByName(alone)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of ``docs`` of each component, columns as they were.

    It is the one with the least key, null keys last, then the least text hash.
    Rows that share key and text are one document repeated, of which one row stays, with
    or without words.  Copies meet where they are read before they are shuffled, so a
    document with a third of all rows is one row a task.
    """
    ident = F.struct(F.col(f"`{key}`").isNull().alias("nameless"), F.col(f"`{key}`").alias("k"), F.xxhash64(F.col(f"`{text}`")).alias("h"))
    found = join(docs.select(ident.alias("_id"), F.col(f"`{text}`").alias("_t")), "_id", "_t", words, num, den)
    flat = lambda c: [F.col(f"{c}.{f}").alias(f"_{f}") for f in ("nameless", "k", "h")]
    chosen = stored(found.filter(F.col("_id") == F.col("component_id")).select(*flat("_id")).distinct(), "chosen").alias("c")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    order = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])
    rows = docs.select(ident.alias("_id"), whole.alias("_row"), order.alias("_order")).select(*flat("_id"), "_row", "_order")
    rows = rows.groupBy("_nameless", "_k", "_h").agg(F.min_by("_row", "_order").alias("_row")).alias("r")
    same = (F.col("r._h") == F.col("c._h")) & (F.col("r._nameless") == F.col("c._nameless")) & F.col("r._k").eqNullSafe(F.col("c._k"))
    return rows.join(chosen, same, "left_semi").select("_row.*")
