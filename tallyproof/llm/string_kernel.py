"""Language identification by string kernels.

The kernel of two texts is the number of distinct character n-grams, of length
1 to 4, that both hold (blended spectrum, presence), over the root of the product of
their own numbers.  N-grams are hashed to a fixed number of buckets.  Landmark
texts give the Nystroem map K(x, L) K(L, L)^-1/2, on which one-versus-rest
kernel ridge regression is solved in closed form; a batch of texts is scored by
two matrix products.

Training reads at most ``per_class`` labelled rows of every language, chosen by
a hash of the key, from the rows that the caller marks for training, and fewer
of each where there are many languages; landmarks are shared out among the
languages, one each at least.  The model is a few MB whatever the number of rows.  The driver gets hashed n-grams, no texts.

Texts of no known language are told by another measure, as scores say only
which of the known ones is nearest: the share of a text's n-grams that the
predicted language's profile holds, n-grams of a fiftieth of its training rows.
Each language's floor comes from its own training rows, each measured on the
others of its language, so it does not depend on how many languages there are.

Defined results: a null text, or one without a letter, gets ``und`` and score
0, as do all texts when there is nothing to learn from; ties go to the
language that sorts first; repeated rows get equal answers; rows with a null key or label teach nothing; an empty table gives
no rows; texts are read whole, whatever their length; other columns, whatever their names, are left out, or kept as they are by ``reject_unknown``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyproof.llm.storage import lean

BUCKETS = 1 << 14
ORDERS = 4
UNKNOWN = "und"
SHARPNESS = 4.0


def presence(texts: list[str], out: np.ndarray) -> np.ndarray:
    """Rows of 0 and 1 in ``out``: which buckets of n-grams each text holds."""
    out = out[: len(texts)]
    out[:] = 0
    for i, t in enumerate(texts):
        c = np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        h = c * np.uint32(0x9E3779B1)
        row = out[i]
        row[(h ^ h >> np.uint32(15)) % np.uint32(BUCKETS)] = 1
        for n in range(2, ORDERS + 1):
            if len(c) < n:
                break
            h = (h[:-1] * np.uint32(0x85EBCA6B) + c[n - 1 :]) * np.uint32(0xC2B2AE35)
            row[(h ^ h >> np.uint32(15)) % np.uint32(BUCKETS)] = 1
    return out


def held(text: str) -> bytes:
    """The buckets that a text holds, two bytes each."""
    row = presence([text], np.zeros((1, BUCKETS), np.float32))[0]
    return np.flatnonzero(row).astype(np.uint16).tobytes()


def spread(rows: list, out: np.ndarray) -> np.ndarray:
    """Rows of 0 and 1 of texts, or of what ``held`` gave for them."""
    if rows and isinstance(rows[0], str):
        return presence(rows, out)
    out = out[: len(rows)]
    out[:] = 0
    for i, raw in enumerate(rows):
        out[i, np.frombuffer(raw, np.uint16)] = 1
    return out


class Model:
    """Landmarks, their map and the weights of each language."""

    def __init__(self, texts: list, labels: list[str], landmarks: int = 128, ridge: float = 0.1) -> None:
        self.classes = sorted(set(labels))
        if not self.classes:
            return
        turn: dict[str, int] = {}
        order = []
        for i, c in enumerate(labels):  # the first of each language, then the second of each, ...
            order.append((turn.setdefault(c, 0), c, i))
            turn[c] += 1
        chosen = [i for _, _, i in sorted(order)[: max(landmarks, len(self.classes))]]
        x = spread([texts[i] for i in chosen], np.zeros((len(chosen), BUCKETS), np.float32))
        x /= np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
        self.landmarks = np.ascontiguousarray(x.T)
        values, vectors = np.linalg.eigh((self.landmarks.T @ self.landmarks).astype(np.float64))
        good = values > 1e-6 * values.max()
        nystroem = vectors[:, good] / np.sqrt(values[good])
        room = np.zeros((128, BUCKETS), np.float32)
        blocks = []
        for at in range(0, len(texts), len(room)):  # a few rows at a time: only their products with landmarks are kept
            x = spread(texts[at : at + len(room)], room)
            blocks.append((x @ self.landmarks) / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1)))
        z = np.concatenate(blocks).astype(np.float64) @ nystroem
        z = np.hstack([z, np.ones((len(z), 1))])
        y = np.where(np.array(labels)[:, None] == np.array(self.classes), 1.0, -1.0)
        beta = np.linalg.solve(z.T @ z + ridge * np.eye(z.shape[1]), z.T @ y)
        self.weights, self.bias = (nystroem @ beta[:-1]).astype(np.float32), beta[-1].astype(np.float32)

    def score(self, texts: list[str], room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(best class, its share) of each text."""
        x = presence(texts, room)
        kernel = (x @ self.landmarks) / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
        f = kernel @ self.weights + self.bias
        e = np.exp(SHARPNESS * (f - f.max(1, keepdims=True)))
        return f.argmax(1), (e / e.sum(1, keepdims=True)).max(1)


class Profiles:
    """Which n-grams are usual in each language, and the least share of usual ones that its texts have."""

    def __init__(self, classes: list[str], texts: list[str], labels: list[str], usual: float = 0.02, lost: float = 0.01, slack: float = 0.9) -> None:
        place = {c: i for i, c in enumerate(classes)}
        room = np.zeros((128, BUCKETS), np.float32)
        self.usual, self.floor = np.zeros((len(classes), BUCKETS), bool), np.zeros(len(classes))
        for c, i in place.items():
            own = [t for t, label in zip(texts, labels) if label == c]
            parts = range(0, len(own), len(room))
            counts = sum((spread(own[at : at + len(room)], room).sum(0) for at in parts), np.zeros(BUCKETS, np.float32))
            least = max(1.0, usual * len(own))
            self.usual[i] = counts >= least
            held_back = []
            for at in parts:
                x = spread(own[at : at + len(room)], room)
                held_back += ((x * (counts - 1 >= least)).sum(1) / np.maximum(x.sum(1), 1)).tolist()
            self.floor[i] = slack * np.quantile(held_back, lost) if held_back else 0.0

    def known(self, x: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Whether rows of presence reach the floor of their best class."""
        share = np.einsum("ij,ij->i", x, self.usual[best].astype(np.float32)) / np.maximum(x.sum(1), 1)
        return share >= self.floor[best]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def training_rows(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", label: str = "lang", per_class: int = 250, most: int = 16_000) -> tuple[list[bytes], list[str]]:
    """What texts hold, and their labels, of at most ``per_class`` rows of every label, fewer each if that were over ``most`` rows.

    Keys are chosen first, without texts, one row a key: of rows that share one, those of the least text hash.  The chosen few are then joined to the
    texts and their n-grams hashed on the executors, so that a few KB a row reach the driver.
    """
    column, at = F.col(f"`{text}`"), F.col(f"`{key}`")
    letters = column.rlike(r"\p{L}")
    rows = docs.filter(train & F.col(f"`{label}`").isNotNull() & letters).select(at.alias("_k"), F.col(f"`{label}`").alias("_c"), F.xxhash64(column).alias("_h"))
    rows = rows.groupBy("_k").agg(F.min(F.struct("_h", "_c")).alias("_f")).select("_k", "_f.*")
    each = max(1, min(per_class, most // max(1, rows.select("_c").distinct().count())))
    order = [F.xxhash64("_k"), F.col("_k")]
    dealt = rows.withColumn("_s", F.pmod(F.xxhash64("_k", F.lit("deal")), F.lit(64)))  # so that no task gets all rows of a language
    first = dealt.withColumn("_r", F.row_number().over(Window.partitionBy("_c", "_s").orderBy(*order))).filter(F.col("_r") <= each)
    chosen = first.withColumn("_r", F.row_number().over(Window.partitionBy("_c").orderBy(*order))).filter(F.col("_r") <= each).drop("_s")
    texts = docs.filter(train).select(at.alias("_k"), F.xxhash64(column).alias("_h"), column.alias("_t"))
    found = texts.join(F.broadcast(chosen), ["_k", "_h"]).select("_c", "_r", "_t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(1), pa.array([held(t) for t in batch.column(2).to_pylist()], pa.binary())], ["c", "r", "x"])

    got = found.mapInArrow(lean(run), "c string, r int, x binary").groupBy("c", "r").agg(F.min("x").alias("x")).orderBy("c", "r").collect()
    return [bytes(r["x"]) for r in got], [r["c"] for r in got]


def fit(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", label: str = "lang", per_class: int = 250, landmarks: int = 128, ridge: float = 0.1) -> Model:
    """A model of the training rows."""
    return Model(*training_rows(docs, train, key, text, label, per_class), landmarks, ridge)


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key, ``lang_pred`` and ``score`` of each row; the text is all that a prediction sees."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few MB, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        room = np.zeros((128, BUCKETS), np.float32)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                texts = part.column(1).to_pylist()
                known = [i for i, t in enumerate(texts) if m.classes and has_letter(t)]
                langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
                if known:
                    best, share = m.score([texts[i] for i in known], room)
                    for i, c, s in zip(known, best.tolist(), share.tolist()):
                        langs[i], scores[i] = m.classes[c], min(max(s, 0.0), 1.0)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [key, "lang_pred", "score"])

    return docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).mapInArrow(lean(run), f"`{key}` {kind}, lang_pred string, score double")


def held_out(key: str = "doc_id", folds: int = 5) -> Column:
    """True for the fold that no model learns from."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds == 0


def reject_unknown(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """``docs`` without rows of no known language: no letter, or too few n-grams that are usual in the nearest; all columns as they were.

    Decisions are made row by row where the text is read, so nothing is joined.
    """
    texts, labels = training_rows(docs, train, key, text, label)
    model = Model(texts, labels)
    profiles = Profiles(model.classes, texts, labels)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    kind = rows.schema["_row"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((model, profiles))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, usual = shared.value
        room = np.zeros((128, BUCKETS), np.float32)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                texts = part.column(0).field(text).to_pylist()
                known = [i for i, t in enumerate(texts) if has_letter(t)]
                if known and m.classes:
                    best = m.score([texts[i] for i in known], room)[0]
                    known = [i for i, good in zip(known, usual.known(room[: len(known)], best).tolist()) if good]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(known, pa.int64()))], ["_row"])

    return rows.mapInArrow(lean(run), f"_row {kind}").select("_row.*")
