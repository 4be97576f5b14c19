"""Operator 8: quality classifier, a generalised additive model with pairwise interactions.

Every text becomes a few features. Each feature is cut into bins; cyclic
boosting visits the features in turn, fits a shallow tree on the bins to the
residuals and adds it to that feature's lookup table. Then the pairs of
features with the largest remaining gain get two-dimensional tables boosted
the same way. A score is the logistic of the sum of table entries: vectorised
bin additions.

The model is fitted on the driver from about ``max_train`` labelled rows at
most (chosen by a hash of their ids): features only, no texts. Everything else
runs over all rows. Null and empty texts have features too (all zero) and a
score; without labels the score is 0.5; rows with a null id never train.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ship_by_value, small_batches, stored, table

MAX_TRAIN = 20_000   # labelled rows used to fit the model, at most
THRESHOLD = 0.3
FEATURES = ["log_chars", "word_len", "long_words", "upper", "digits", "marks", "bangs", "pipes", "stops",
            "lines", "line_len", "distinct_words", "distinct_lines", "short_words", "spread"]


def text_features(text: str) -> list[float]:
    """Shares and lengths of one whole text, in the order of ``FEATURES``."""
    if not text:
        return [0.0] * len(FEATURES)
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    n = max(1, len(text))
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    w, ln = max(1, len(words)), max(1, len(lines))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    return [float(np.log1p(n)), float(lengths.mean()), float((lengths > 12).mean()), raw[65:91].sum() / n,
            raw[48:58].sum() / n, (raw[35] + raw[36] + raw[37] + raw[38] + raw[42] + raw[64] + raw[94] + raw[126]) / n,
            (raw[33] + raw[63]) / n, raw[124] / n, (raw[46] + raw[44]) / n, ln / w, float(np.log1p(n / ln)),
            len(set(words)) / w, len(set(lines)) / ln, float((lengths <= 3).mean()), float(lengths.std())]


def features(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and the array ``x`` of every row's features."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "x": [text_features(t) for t in b["text"]]})

    src = small_batches(df).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return src.mapInPandas(run, "id long, x array<double>")


@dataclass
class Gam:
    """Bin edges per feature, a table per feature, a table per chosen pair."""
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray] = field(default_factory=list)  # bin -> coarse bin, for the pairs
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    base: float = 0.0

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], 1) \
            if len(x) else np.zeros((0, len(self.edges)), np.int64)

    def margin(self, b: np.ndarray) -> np.ndarray:
        out = np.full(len(b), self.base)
        for j, t in enumerate(self.tables):
            out += t[b[:, j]]
        for (i, j), t in zip(self.pairs, self.pair_tables):
            out += t[self.coarse[i][b[:, i]], self.coarse[j][b[:, j]]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(self.bins(np.asarray(x, float))), -30, 30)))


def _step(g: np.ndarray, h: np.ndarray, lam: float) -> np.ndarray:
    return g / (h + lam)


def _split(g: np.ndarray, h: np.ndarray, lam: float) -> tuple[float, int]:
    """Best cut of an ordered run of bins: gain and the first bin on the right."""
    cg, ch = np.cumsum(g), np.cumsum(h)
    if len(g) < 2:
        return 0.0, 0
    gain = cg[:-1] ** 2 / (ch[:-1] + lam) + (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + lam) - cg[-1] ** 2 / (ch[-1] + lam)
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray, lam: float, leaves: int = 4) -> np.ndarray:
    """A shallow regression tree over ordered bins: its value in each bin."""
    runs = [(0, len(g))]
    while len(runs) < leaves:
        best = max(((*_split(g[a:b], h[a:b], lam), a, b) for a, b in runs), key=lambda s: s[0])
        if best[0] <= 1e-9:
            break
        _, k, a, b = best
        runs.remove((a, b))
        runs += [(a, a + k), (a + k, b)]
    out = np.zeros(len(g))
    for a, b in runs:
        out[a:b] = _step(g[a:b].sum(), h[a:b].sum(), lam)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, lam: float) -> tuple[float, np.ndarray]:
    """Best pair of cuts, one on each axis: gain and the value of each cell."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    tg, th = cg[-1, -1], ch[-1, -1]
    best, value = 0.0, np.zeros_like(g)
    for i in range(g.shape[0] - 1):
        for j in range(g.shape[1] - 1):
            gs = np.array([cg[i, j], cg[i, -1] - cg[i, j], cg[-1, j] - cg[i, j], tg - cg[i, -1] - cg[-1, j] + cg[i, j]])
            hs = np.array([ch[i, j], ch[i, -1] - ch[i, j], ch[-1, j] - ch[i, j], th - ch[i, -1] - ch[-1, j] + ch[i, j]])
            gain = float((gs ** 2 / (hs + lam)).sum() - tg ** 2 / (th + lam))
            if gain > best:
                best, v = gain, _step(gs, hs, lam)
                value = np.empty_like(g)
                value[:i + 1, :j + 1], value[:i + 1, j + 1:] = v[0], v[1]
                value[i + 1:, :j + 1], value[i + 1:, j + 1:] = v[2], v[3]
    return best, value


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 120, rate: float = 0.15, bins: int = 32, n_pairs: int = 4,
        lam: float = 2.0) -> Gam:
    """Fit the lookup tables to labels ``y`` in {0, 1}."""
    if not len(y):
        return Gam([np.zeros(0)] * len(FEATURES), [np.zeros(1)] * len(FEATURES), [np.zeros(1, int)] * len(FEATURES))
    x, y = np.asarray(x, float).reshape(len(y), -1), np.asarray(y, float)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    prior = (y.sum() + 1) / (len(y) + 2)
    gam = Gam(edges, [np.zeros(len(e) + 1) for e in edges], base=float(np.log(prior / (1 - prior))))
    gam.coarse = [np.arange(len(e) + 1) * 8 // (len(e) + 1) for e in edges]
    b = gam.bins(x)
    f = gam.margin(b)
    for _ in range(rounds):
        for j, t in enumerate(gam.tables):
            p = 1 / (1 + np.exp(-f))
            g, h = (np.bincount(b[:, j], w, len(t)) for w in (y - p, p * (1 - p)))
            step = rate * _tree(g, h, lam)
            t += step
            f += step[b[:, j]]
    c = np.stack([m[b[:, j]] for j, m in enumerate(gam.coarse)], 1)

    def grids(i: int, j: int) -> list[np.ndarray]:
        p = 1 / (1 + np.exp(-f))
        return [np.bincount(c[:, i] * 8 + c[:, j], w, 64).reshape(8, 8) for w in (y - p, p * (1 - p))]

    gains = sorted(((_quadrants(*grids(i, j), lam)[0], i, j) for i in range(len(edges)) for j in range(i)), reverse=True)
    gam.pairs = [(i, j) for g, i, j in gains[:n_pairs] if g > 1e-9]
    gam.pair_tables = [np.zeros((8, 8)) for _ in gam.pairs]
    for _ in range(rounds // 4):
        for (i, j), t in zip(gam.pairs, gam.pair_tables):
            step = rate * _quadrants(*grids(i, j), lam)[1]
            t += step
            f += step[c[:, i], c[:, j]]
    return gam


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5, is 0: never used for training."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(feats: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Gam:
    """Fit on labelled rows that are not held out: about ``max_train`` of them, by a hash of the id, if there are more."""
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").alias("y")).where("y IN (0, 1)")
    known = known.where(~held_out("id"))
    share = max_train / max(1, known.count())
    if share < 1:
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = feats.join(known, "id").select("id", "x", "y").toPandas().sort_values(["id", "y"])
    return fit(np.array(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES)), rows["y"].to_numpy())


def score(feats: DataFrame, gam: Gam) -> DataFrame:
    """``id`` and ``score`` of every row of features."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = np.array(b["x"].tolist(), float).reshape(len(b), len(FEATURES))
            yield pd.DataFrame({"id": b["id"], "score": gam.score(x)})

    return feats.mapInPandas(run, "id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    feats = stored(features(docs), "features")
    scored = score(feats, train(feats, labels, max_train))
    return scored.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """The documents that the classifier does not reject, columns unchanged.

    Only features are joined with the labels; then each text is scored where
    it lies, so no text is shuffled.
    """
    gam = train(features(docs), labels, max_train)
    schema = docs.schema

    def run(batches):
        import pyarrow as pa
        for b in batches:
            x = np.array([text_features(t or "") for t in b.column("text").to_pylist()]).reshape(-1, len(FEATURES))
            yield b.filter(pa.array(gam.score(x) >= THRESHOLD))

    return docs.mapInArrow(run, schema)


def op8_quality_gam(spark, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ship_by_value(__name__)
