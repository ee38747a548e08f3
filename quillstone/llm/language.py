"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, and what isn't a letter counts as a space. 1- to 3-grams of code points are hashed to BUCKETS. Document
frequencies are counted over all learnable rows; the weights are fitted to at most SAMPLE of them, those of smallest hash
of their id, by follow-the-regularised-leader with elastic-net penalties, and a temperature to a part kept apart.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.llm.session import arrow_map

BUCKETS, SAMPLE, EPOCHS = 1 << 14, 4000, 3
#: FTRL: learning rate, smoothing, and the penalties on absolute and squared weights.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.002, 0.01
#: Every so manieth sample row sets the temperature instead of the weights.
CALIBRATE = 5
UNKNOWN = "und"


def _tables() -> tuple[np.ndarray, np.ndarray]:
    letter, low = np.zeros(1 << 16, bool), np.full(1 << 16, 32, np.uint32)
    for c in range(1 << 16):
        if chr(c).isalpha():
            letter[c] = True
            small = chr(c).lower()
            low[c] = ord(small) if len(small) == 1 else c
    return letter, low


_LETTER, _LOW = _tables()
_M = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def grams(text: str | None) -> np.ndarray | None:
    """Bucket of every n-gram of a whole text; None if it is null or has no letter."""
    codes = np.frombuffer((text or "").encode("utf-32-le"), np.uint32)
    plain = np.minimum(codes, 0xFFFF)
    low = _LOW[plain]
    beyond = np.flatnonzero(codes > 0xFFFF)
    if len(beyond):
        low[beyond] = [c if chr(c).isalpha() else 32 for c in codes[beyond].tolist()]
    if not (low != 32).any():
        return None
    padded = np.concatenate([[np.uint32(32)], low, [np.uint32(32)]]).astype(np.uint32)
    a = padded * _M[0]
    two = (a[:-1] ^ (padded[1:] * _M[1])) * _M[2]
    three = ((two[:-1] >> np.uint32(7)) ^ (padded[2:] * _M[1])) * _M[0]
    full = padded != 32
    some2 = full[:-1] | full[1:]
    shift = np.uint32(32 - 14)
    return np.concatenate([(a[full] * _M[1]) >> shift, two[some2] >> shift, three[some2[:-1] | full[2:]] >> shift])


def counts(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Buckets of a text in ascending order and how often each occurs."""
    g = grams(text)
    if g is None:
        return None
    all_ = np.bincount(g, minlength=BUCKETS)
    which = np.flatnonzero(all_)
    return which, all_[which]


@dataclass
class Model:
    classes: list[str]
    idf: np.ndarray
    weights: np.ndarray  # (BUCKETS, classes)
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, which: np.ndarray, times: np.ndarray) -> np.ndarray:
        x = (1 + np.log(times)) * self.idf[which]
        return x / max(np.sqrt((x * x).sum()), 1e-12)

    def logits(self, which: np.ndarray, times: np.ndarray) -> np.ndarray:
        return self.vector(which, times) @ self.weights[which] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        found = counts(text)
        if found is None or not self.classes:
            return UNKNOWN, 0.0
        p = _softmax(self.logits(*found) / self.temperature)
        best = int(np.argmax(p))
        return self.classes[best], float(p[best])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], idf: np.ndarray) -> Model:
    """A model of (language, buckets, counts) rows, taken in the order given."""
    classes = sorted({r[0] for r in rows})
    model = Model(classes, idf, np.zeros((BUCKETS, len(classes))), np.zeros(len(classes)))
    if len(classes) < 2:
        return model
    apart = [r for i, r in enumerate(rows) if i % CALIBRATE == CALIBRATE - 1]
    rows = [r for i, r in enumerate(rows) if i % CALIBRATE != CALIBRATE - 1]
    z, n = np.zeros((BUCKETS + 1, len(classes))), np.zeros((BUCKETS + 1, len(classes)))  # the last row is the bias

    def weights(at) -> np.ndarray:
        w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) <= L1, 0, w)

    order = np.random.default_rng(1)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            language, which, times = rows[i]
            at, x = np.append(which, BUCKETS), np.append(model.vector(which, times), 1.0)
            w = weights(at)
            error = _softmax(x @ w)
            error[classes.index(language)] -= 1
            g = x[:, None] * error
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    whole = weights(slice(None))
    model.weights, model.bias = whole[:-1], whole[-1]
    held = [(classes.index(language), model.logits(which, times)) for language, which, times in apart]
    if held:
        y, logits = np.array([h[0] for h in held]), np.stack([h[1] for h in held])
        loss = lambda t: -np.log(np.maximum(_softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean()
        model.temperature = float(min(np.geomspace(0.02, 20, 200), key=loss))
    return model


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def fit(documents: DataFrame, learnable: Column, sample: int = SAMPLE) -> Model:
    """A model of documents' text and lang where `learnable` holds and both aren't null."""
    rows = documents.where(learnable & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")

    def frequency(batches):
        total = np.zeros(BUCKETS + 1, np.int64)  # the last counts the documents
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if (found := counts(text)) is not None:
                    total[found[0]] += 1
                    total[BUCKETS] += 1
        which = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(which, pa.int64()), pa.array(total[which], pa.int64())], ["bucket", "n"])

    seen = np.zeros(BUCKETS + 1, np.int64)
    for r in arrow_map(rows, frequency, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS + 1 rows at most
        seen[r["bucket"]] = r["n"]
    idf = np.log((1 + seen[BUCKETS]) / (1 + seen[:BUCKETS])) + 1
    chosen = rows.groupBy("doc_id").agg(F.min("lang").alias("lang")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    picked = rows.join(F.broadcast(chosen), ["doc_id", "lang"])  # at most `sample` rows are broadcast

    def features(batches):
        for batch in batches:
            found = [counts(t) for t in batch.column("text").to_pylist()]
            keep = [i for i, f in enumerate(found) if f is not None]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()).take(keep), batch.column("lang").take(keep), pa.array([found[i][0].astype("<u2").tobytes() for i in keep], pa.binary()), pa.array([found[i][1].astype("<u4").tobytes() for i in keep], pa.binary())],
                ["doc_id", "lang", "buckets", "times"],
            )

    one = arrow_map(picked, features, "doc_id long, lang string, buckets binary, times binary").groupBy("doc_id").agg(F.min(F.struct("lang", "buckets", "times")).alias("r"))
    got = one.select("doc_id", "r.*").collect()  # at most `sample` rows of at most BUCKETS pairs
    got.sort(key=lambda r: r["doc_id"] * 0x9E3779B97F4A7C15 % (1 << 64))
    return train([(r["lang"], np.frombuffer(r["buckets"], "<u2").astype(np.int64), np.frombuffer(r["times"], "<u4").astype(float)) for r in got], idf)


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every whole text; only text is looked at.

    documents: doc_id, text; other columns don't matter. Null texts and texts without a letter are UNKNOWN with score 0, and so
    is everything if nothing could be learned. A null doc_id isn't held out. Repeated rows give repeated rows, no rows none.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)  # BUCKETS x classes weights

    def run(batches):
        for batch in batches:
            out = [shared.value.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = documents.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "text")
    return arrow_map(rows, run, "doc_id long, held_out boolean, lang_pred string, score double")
