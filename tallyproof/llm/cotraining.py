"""Quality classification by co-training two views of a document.

View one sees the text alone: presence of hashed words and a few shares (symbols,
digits, repeated words and lines, stop words).  View two sees only what is known
about the page besides its text: source, language and stated length.
Both are regularised logistic regressions.  Each round, every view scores all documents
without a label and hands the ``exchange`` that it is surest of, of either
kind, to the other; at the end each view's log-odds are calibrated on labelled rows held back from
training and the two are added, less the log-odds of all labelled rows, which both hold.

Fitting reads at most ``labelled`` labelled rows, chosen by a hash of the key; candidates for
exchange are sought among all other documents, every document is scored.  Features of all documents are made
once, on the executors, and stored while the rounds last; only those of the rows trained on, a few KB each, reach the driver.

Defined results: a null text counts as empty, null metadata as a value of its
own; without labels of both kinds every score is 0.5 and every row is kept; a
row is kept when its score is at least ``least``; an empty table gives no rows.  Repeated rows get equal
scores; of rows that share a key, the one of least features is learned from.  Labels of unknown documents are ignored; of two labels of a
document, the lower counts; ties of sureness go to the lesser key.  Other columns, whatever their names, are left out, or with ``rows`` untouched.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.storage import discard, lean, stored

WORDS = 1 << 11
SHARES = 8
PLACES = 1 << 7
FACTS = 3
_SYMBOL = re.compile(r"[^\w\s.,;:!?'\"()-]")
_DIGIT = re.compile(r"\d")

_SEEN: dict[str, int] = {}


def bucket(word: str) -> int:
    found = _SEEN.get(word)
    if found is None:
        if len(_SEEN) > 150_000:
            _SEEN.clear()
        found = _SEEN[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % WORDS
    return found


def content(text: str | None) -> tuple[list[int], list[float]]:
    """Buckets of the distinct words, and shares between 0 and 1."""
    text = text or ""
    words = text.lower().split()
    n, size = max(1, len(words)), max(1, len(text))
    distinct = set(words)
    lines = text.split("\n")
    shares = [
        len(_SYMBOL.findall(text)) / size,
        len(_DIGIT.findall(text)) / size,
        1 - len(distinct) / n,
        1 - len(set(lines)) / len(lines),
        min(1.0, (size / n) / 20),
        min(1.0, np.log1p(n) / 10),
        sum(1 for w in words if len(w) <= 3) / n,
        sum(1 for w in words if not w[-1].isalnum()) / n,
    ]
    return sorted({bucket(w) for w in distinct}), shares


def facts(source: object, lang: object, n_chars: int | None) -> tuple[list[int], list[float]]:
    """Buckets of source, language and order of length, and the length."""
    n = max(0, n_chars or 0)
    place = [zlib.crc32(f"{kind}:{value}".encode("utf-8", "surrogatepass")) % PLACES for kind, value in (("s", source), ("l", lang), ("n", n.bit_length()))]
    return place, [min(1.0, np.log1p(n) / 14), min(1.0, (np.log1p(n) / 14) ** 2), float(n_chars is None)]


def matrix(rows: list[tuple[list[int], list[float]]], hashed: int, dense: int) -> np.ndarray:
    x = np.zeros((len(rows), hashed + dense + 1), np.float32)
    for i, (at, shares) in enumerate(rows):
        x[i, at] = 1.0 / max(1.0, len(at)) ** 0.5
        x[i, hashed:-1] = shares
    x[:, hashed:-1] *= 4
    x[:, -1] = 1
    return x


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.02, steps: int = 300) -> np.ndarray:
    """Weights by accelerated gradient descent, classes weighted evenly."""
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())).astype(np.float32)
    w = np.zeros(x.shape[1], np.float32)
    ahead, rate = w.copy(), 1.0 / (0.25 * float((share * (x * x).sum(1)).sum()) + penalty)
    for k in range(steps):
        p = 1 / (1 + np.exp(-(x @ ahead)))
        step = ahead - rate * (x.T @ (share * (p - y)) + penalty * 0.01 * ahead)
        ahead = step + k / (k + 3) * (step - w)
        w = step
    return w


def calibrated(logits: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that fit held-back labels (Platt), the slope kept from 0."""
    if len(set(y.tolist())) < 2:
        return 1.0, 0.0
    x = np.stack([logits, np.ones_like(logits)], 1).astype(np.float64)
    prior, pull = np.array([1.0, 0.0]), 1.0 / len(y)  # as much as one row
    loss = lambda w: float(np.logaddexp(0, np.where(y > 0, -1, 1) * (x @ w)).mean() + pull / 2 * ((w - prior) ** 2).sum())
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) / len(y) + pull * (w - prior)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x / len(y) + pull * np.eye(2), slope)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
    return max(float(w[0]), 0.0), float(w[1])


class Model:
    """Weights and calibration of the two views; both None when there was nothing to learn."""

    def __init__(self) -> None:
        self.text = self.page = None
        self.cal = ((1.0, 0.0), (1.0, 0.0))
        self.prior = 0.0  # log-odds of a labelled row, which both views count
        self.exchanged: list[tuple[int, int]] = []

    def logits(self, texts: list, pages: list) -> tuple[np.ndarray, np.ndarray]:
        a = matrix(texts, WORDS, SHARES) @ self.text
        b = matrix(pages, PLACES, FACTS) @ self.page
        return a * self.cal[0][0] + self.cal[0][1], b * self.cal[1][0] + self.cal[1][1]


Row = tuple[tuple[list[int], list[float]], tuple[list[int], list[float]]]


class Pupils:
    """Two views in training: their sets and, once learned, their weights."""

    def __init__(self, rows: list[Row], labels: list[float]) -> None:
        self.y = np.array(labels, np.float32)
        self.x = [matrix([r[0] for r in rows], WORDS, SHARES), matrix([r[1] for r in rows], PLACES, FACTS)]
        held = np.arange(len(rows)) % 5 == 0
        if len(set(self.y[~held].tolist())) < 2:
            held[:] = False
        self.back = held if held.any() else ~held
        self.sets = [[x[~held], self.y[~held]] for x in self.x]

    def learn(self) -> tuple[np.ndarray, np.ndarray, tuple, tuple]:
        """Weights and calibration of both views."""
        a, b = (logistic(*s) for s in self.sets)
        return a, b, calibrated(self.x[0][self.back] @ a, self.y[self.back]), calibrated(self.x[1][self.back] @ b, self.y[self.back])

    def take(self, view: int, rows: list[Row], label: float) -> None:
        """Rows that the other view labelled."""
        if rows:
            x = matrix([r[view] for r in rows], *((WORDS, SHARES), (PLACES, FACTS))[view])
            self.sets[view] = [np.vstack([self.sets[view][0], x]), np.concatenate([self.sets[view][1], np.full(len(rows), label, np.float32)])]


def packed(row: Row) -> bytes:
    (words, shares), (places, measures) = row
    return np.array([len(words), *words, *places], np.uint16).tobytes() + np.array([*shares, *measures], np.float32).tobytes()


def unpacked(raw: bytes) -> Row:
    n = int.from_bytes(raw[:2], "little")
    upto = 2 * (1 + n + 3)
    whole, real = np.frombuffer(raw[:upto], np.uint16), np.frombuffer(raw[upto:], np.float32)
    return (whole[1 : 1 + n].tolist(), real[:SHARES].tolist()), (whole[1 + n :].tolist(), real[SHARES:].tolist())


def features(columns: list[pa.Array]) -> tuple[list, list]:
    """Of key, text, source, language and length."""
    text, source, lang, n = (c.to_pylist() for c in columns[1:5])
    return [content(t) for t in text], [facts(*x) for x in zip(source, lang, n)]


def _inputs(docs: DataFrame, key: str) -> DataFrame:
    return docs.select(F.col(f"`{key}`").alias("_k"), F.col("text"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("long").alias("n_chars"))


def _featured(docs: DataFrame, key: str) -> DataFrame:
    """(_k, x) of every row with a key."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([packed(r) for r in zip(*features(part.columns))], pa.binary())], ["_k", "x"])

    return stored(_inputs(docs, key).filter("_k is not null").mapInArrow(lean(run, _SEEN.clear), f"_k {kind}, x binary"), "features")


def _surest(rows: DataFrame, done: DataFrame, weights: tuple, sure: float, exchange: int) -> DataFrame:
    """(_k, view, label): of all rows but those ``done``, the ``exchange`` that each view is surest of, of either kind."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)
    kind = rows.schema["_k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, one, two = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                both = [unpacked(x) for x in part.column(1).to_pylist()]
                told = []
                for view, (w, (slope, offset), sizes) in enumerate(((a, one, (WORDS, SHARES)), (b, two, (PLACES, FACTS)))):
                    z = matrix([r[view] for r in both], *sizes) @ w * slope + offset
                    told.append(pa.array(np.round(1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30))), 6)))
                yield pa.RecordBatch.from_arrays([part.column(0), *told], ["_k", "pa", "pb"])

    scored = rows.mapInArrow(lean(run), f"_k {kind}, pa double, pb double").filter((F.abs(F.col("pa") - 0.5) >= sure - 0.5) | (F.abs(F.col("pb") - 0.5) >= sure - 0.5))
    scored = stored(scored.groupBy("_k").agg(F.min("pa").alias("pa"), F.min("pb").alias("pb")).join(done.hint("merge"), "_k", "left_anti"), "scored")
    found = None
    for view, p in ((0, "pa"), (1, "pb")):
        for label in (1, 0):
            far = F.col(p) if label else 1 - F.col(p)
            top = scored.filter(far >= sure).orderBy(far.desc(), "_k").limit(exchange).select("_k", F.lit(view).alias("view"), F.lit(label).alias("label"))
            found = top if found is None else found.unionByName(top)
    return found


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", labelled: int = 3000, exchange: int = 150, share: float = 0.05, rounds: int = 3, sure: float = 0.9) -> Model:
    """Co-train on at most ``labelled`` labelled rows and, each round, ``exchange`` rows of either kind from each view, of few documents a ``share``."""
    known = labels.filter(F.col(label).isNotNull() & F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("_k")).agg(F.min(label).cast("int").alias("_y"))
    rows = _featured(docs, key)
    some = known.join(rows.select("_k").distinct(), "_k").orderBy(F.xxhash64("_k"), "_k").limit(labelled)
    read = lambda chosen, *more: rows.join(F.broadcast(chosen), "_k").groupBy("_k", *more).agg(F.min("x").alias("x")).collect()  # noqa: E731  a few thousand rows
    found = sorted(read(some, "_y"), key=lambda r: (zlib.crc32(str(r["_k"]).encode()), str(r["_k"])))
    model = Model()
    if len({r["_y"] > 0 for r in found}) < 2:
        discard(rows)
        return model
    pupils = Pupils([unpacked(r["x"]) for r in found], [float(r["_y"] > 0) for r in found])
    done, each = known.select("_k"), min(exchange, max(1, int(share * rows.count())))
    for _ in range(rounds):
        weights = pupils.learn()
        chosen = stored(_surest(rows, done, weights, sure, each), "exchanged")
        given = sorted(read(chosen, "view", "label"), key=lambda r: str(r["_k"]))
        for view in (0, 1):
            for kind in (0, 1):
                pupils.take(1 - view, [unpacked(r["x"]) for r in given if (r["view"], r["label"]) == (view, kind)], float(kind))
        model.exchanged.append(tuple(sum(r["view"] == v for r in given) for v in (0, 1)))
        if not given:
            break
        done = done.unionByName(chosen.select("_k"))
    model.text, model.page, *model.cal = pupils.learn()
    model.prior = float(np.log((pupils.y > 0).sum() / (pupils.y <= 0).sum()))
    discard(rows)
    return model


COLUMNS = "p_content double, p_page double, score double, kept boolean"


def score(docs: DataFrame, model: Model, key: str = "doc_id", least: float = 0.5, rows: bool = False) -> DataFrame:
    """The key, each view's probability, the combined score and ``kept``; with ``rows``, the kept rows of ``docs`` as they were."""
    if rows:  # the row itself holds all that the views see
        columns = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_k"))
    else:
        columns = _inputs(docs, key)
    kind = columns.schema["_k"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                seen = [part.column(0), *(part.column(0).field(c) for c in ("text", "source", "lang", "n_chars"))] if rows else part.columns
                if m.text is None:
                    a = b = np.zeros(part.num_rows)
                else:
                    a, b = m.logits(*features(seen))
                squash = lambda v: 1 / (1 + np.exp(-np.clip(v.astype(np.float64), -30, 30)))
                both = squash(a + b - m.prior)
                if rows:
                    yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(both >= least))], ["_row"])
                else:
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(squash(a)), pa.array(squash(b)), pa.array(both), pa.array(both >= least)], [key, "p_content", "p_page", "score", "kept"])

    if rows:
        return columns.mapInArrow(lean(run, _SEEN.clear), f"_row {kind}").select("_row.*")
    return columns.mapInArrow(lean(run, _SEEN.clear), f"`{key}` {kind}, {COLUMNS}")
