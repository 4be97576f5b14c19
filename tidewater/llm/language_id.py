"""Operator 13: language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of hashed character n-grams (orders 1 to 3, lower
case, runs of anything but letters as one space) of the whole text, scaled to
length 1. Document frequencies cover all documents that may be learned from.
The weights are trained by follow-the-regularised-leader (per-coordinate
rates, L1 and L2 penalties, so most stay exactly 0) on a sample of about
``max_train`` documents chosen by a hash of their ids, at least ``MIN_PER_LANG``
of each language; a fifth of the sample is kept out of the fit, and the
temperature that the scores are divided by is fitted on it.

The driver holds the sample's sparse features (about ``max_train`` rows, never
texts), 2**16 document frequencies and three tables of 2**16 weights a language.

Rules for odd input: a null text, or one without a letter, is ``und`` with
score 0; a null language is never learned, '' is a value like any other; rows
with a null id never train and are not held out; repeated rows each count and
each get a row; without anything to learn from all rows are ``und``; ties go to
the smaller language name; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ship_by_value, small_batches, stored, table

BITS = 16
SIZE = 1 << BITS
ORDERS = (1, 2, 3)
PIECE = 1 << 20        # characters whose n-grams are hashed at once
MAX_TRAIN = 6_000      # sampled documents, about
MIN_PER_LANG = 50      # of each language, if it has so many
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.02
UNKNOWN = "und"

_OTHER = re.compile(r"[\W\d_]+")
_MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))  # fixed odd multipliers


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Occurrences of each hashed n-gram in the whole text; None without a letter."""
    words = _OTHER.sub(" ", (text or "").lower()).strip()
    if not any(map(str.isalpha, words)):
        return None
    words = f" {words} "
    counts = np.zeros(SIZE, np.int64)
    for at in range(0, len(words), PIECE):  # a piece takes the first characters of the next for its last n-grams
        code = np.frombuffer(words[at:at + PIECE + max(ORDERS) - 1].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        for order in ORDERS:
            n = min(PIECE, len(code) - order + 1)
            if n > 0:
                h = np.full(n, order, np.uint64)
                for k in range(order):
                    h = (h ^ code[k:k + n]) * _MIX[k]
                h ^= h >> np.uint64(29)
                counts += np.bincount((h * _MIX[0] >> np.uint64(64 - BITS)).astype(np.int64), minlength=SIZE)
    return counts


def weights(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices and TF-IDF values of one document, of length 1."""
    at = np.flatnonzero(counts)
    x = (1 + np.log(counts[at])) * idf[at]
    return at, x / max(np.sqrt((x * x).sum()), 1e-12)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class Ftrl:
    """Follow-the-regularised-leader for multinomial logistic regression with elastic net.

    ``z`` and ``n`` are the summed adjusted gradients and squared gradients of
    every weight; a weight is 0 while |z| is at most ``l1``.
    """

    def __init__(self, classes: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros((SIZE + 1, classes)), np.zeros((SIZE + 1, classes))  # the last row is the bias
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weight(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        at, x = np.append(at, SIZE), np.append(x, 1.0)
        w = self.weight(at)
        error = softmax(x @ w)
        error[y] -= 1
        g = x[:, None] * error
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    w: np.ndarray
    temperature: float = 1.0

    def margins(self, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ self.w[at] + self.w[SIZE]

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = ngram_counts(text) if self.langs else None
        if counts is None:
            return UNKNOWN, 0.0
        p = softmax(self.margins(*weights(counts, self.idf)) / self.temperature)
        k = int(np.argmax(p))
        return self.langs[k], float(p[k])


def temperature(margins: np.ndarray, y: np.ndarray) -> float:
    """The positive factor with the smallest log loss of softmax(margins / factor), by golden section over its logarithm."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        z = margins / np.exp(t)
        z = z - z.max(1, keepdims=True)
        return float((np.log(np.exp(z).sum(1)) - z[np.arange(len(y)), y]).sum())

    a, b, r = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3, is 1: never used for training."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task's document frequencies; feature -1 carries its number of documents."""
    seen, total = np.zeros(SIZE, np.int64), 0
    for b in batches:
        for text in b.column("text"):
            counts = ngram_counts(text.as_py())
            if counts is not None:
                seen += counts > 0
                total += 1
    if total:
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(-1, at)), pa.array(np.append(total, seen[at]))], names=["feature", "n"])


def inverse_frequencies(known: DataFrame) -> np.ndarray:
    """Smoothed inverse document frequency of every feature over all of ``known``: 2**16 numbers."""
    rows = small_batches(known).select("text").mapInArrow(_frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(SIZE)
    of = rows[rows["feature"] >= 0]
    df[of["feature"].to_numpy()] = of["n"].to_numpy()
    return np.log((1 + float(rows.loc[rows["feature"] < 0, "n"].sum())) / (1 + df)) + 1


def _sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        counts = [ngram_counts(t) for t in b["text"]]
        at = [None if c is None else np.flatnonzero(c).astype(np.int32) for c in counts]
        yield pd.DataFrame({"id": b["id"], "lang": b["lang"], "at": at, "n": [None if c is None else c[i].astype(np.int32) for c, i in zip(counts, at)]})


def sample(known: DataFrame, max_train: int = MAX_TRAIN, min_per_lang: int = MIN_PER_LANG) -> pd.DataFrame:
    """id, lang, at, n of about ``max_train`` documents in proportion to their languages, rare languages up to ``min_per_lang``."""
    sizes = stored(known.groupBy("lang").agg(F.count(F.lit(1)).alias("size")), "languages")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    rates = sizes.select("lang", F.greatest(F.lit(max_train / max(1, total)), min_per_lang / F.col("size")).alias("rate"))
    draw = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    drawn = known.withColumn("draw", draw).join(rates, "lang").where("draw < rate").select("id", "lang", "text")
    out = small_batches(drawn).mapInPandas(_sparse, "id long, lang string, at array<int>, n array<int>").where("at IS NOT NULL").toPandas()
    return out.sort_values(["id", "lang"]).reset_index(drop=True)


def fit(rows: pd.DataFrame, idf: np.ndarray, epochs: int = EPOCHS, seed: int = 13, **penalties: float) -> Model:
    """Train on the sampled documents, calibrate on every fifth of them."""
    langs = sorted(set(rows["lang"]))
    code = {name: k for k, name in enumerate(langs)}
    y = np.array([code[name] for name in rows["lang"]], np.int64)
    x = []
    for at, n in zip(rows["at"], rows["n"]):
        full = np.zeros(SIZE, np.int64)
        full[np.asarray(at)] = n
        x.append(weights(full, idf))
    draw = np.random.default_rng(seed)
    part = draw.permutation(len(y)) % 5
    kept_out, ours = np.flatnonzero(part == 0), np.flatnonzero(part != 0)
    if len(set(y[ours])) < len(langs):  # too few rows to spare any
        kept_out, ours = np.zeros(0, np.int64), np.arange(len(y))
    learner = Ftrl(len(langs), **penalties)
    for _ in range(epochs):
        for i in draw.permutation(ours):
            learner.learn(*x[i], int(y[i]))
    model = Model(langs, idf, learner.weight(slice(None)))
    if len(kept_out):
        model.temperature = temperature(np.array([model.margins(*x[i]) for i in kept_out]), y[kept_out])
    return model


def train(docs: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Model of the documents that have a language and are not held out."""
    rows = docs.select(docs["doc_id"].cast("long").alias("id"), docs["lang"].cast("string").alias("lang"), docs["text"].alias("text"))
    known = rows.where("id IS NOT NULL AND lang IS NOT NULL").where(~held_out("id"))
    return fit(sample(known, max_train), inverse_frequencies(known))


def _predict(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [model.value.predict(t.as_py()) for t in b.column("text")]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array([f[0] for f in found], pa.string()),
                                          pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; texts stay where they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**16 weights a language
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"), docs["text"].alias("text"))
    return small_batches(rows).mapInArrow(partial(_predict, model=shared), "doc_id long, held_out boolean, lang_pred string, score double")


def op13_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs))


ship_by_value(__name__)
