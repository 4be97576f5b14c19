"""Operator 9: approximate nearest neighbours by an inverted multi-index.

Vectors are scaled to length 1 and cut into two halves; each half has its own
codebook, and a vector lies in the cell of its pair of centroids. A query
visits cells in the order of summed centroid distance, which a heap over the
two sorted distance lists yields, until they hold enough vectors; the entries
of the visited cells are reranked by exact cosine in double precision. How many
entries the cells must hold is measured: a bounded sample of the queries is
answered by brute force first, and the visit goes as far as the wanted share
of their neighbours needs. Clustered vectors need few cells, random ones many.

A block of cells is scanned against one chunk of about ``QUERY_CHUNK`` of its
visitors at a time, so neither the entries nor the queries of a group grow with
the table; a block's entries are copied once a chunk of its own visitors, and
blocks without visitors not at all.

Equal vectors are one index entry with their smallest ids, so a vector that a
third of the rows share costs no more than any other. Cells with many entries
are dealt into chunks. The codebooks are fitted on the driver from about
``max_train`` vectors (the smallest hashes); every row is indexed. Cells are
counted over all entries; there are at most ``MAX_CENTROIDS ** 2`` of them.

Rules for odd input: vectors that are null, zero, not of the most frequent
length, or hold null or non-finite components take no part; rows repeated
with the same id and vector count once; an id with several vectors is a query
with ranks of its own for each; a query's own id is no candidate; components
of any finite size are scaled by the largest before they are squared; ties go
to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import ship_by_value, stored, table

MAX_TRAIN = 8192
MAX_CENTROIDS = 256
CHUNK = 4096          # entries of neighbouring cells scanned together
QUERY_CHUNK = 1024    # queries that a block's entries are scanned for together, about
MAX_VISITED = 1 << 20 # blocks whose numbers of chunks are broadcast, at most (16 bytes each)
RECALL = 0.97         # share of the sampled queries' neighbours that the visit must reach
PROBES = 128          # queries answered by brute force to measure how far to visit, at most


def kmeans(x: np.ndarray, k: int, steps: int = 12) -> np.ndarray:
    """Lloyd's algorithm from evenly spread starts (rows come in random order)."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(steps):
        near = nearest(x, c)
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def _far(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids (without the rows' own squares)."""
    return (c ** 2).sum(1)[None, :] - 2 * x @ c.T


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return _far(x, c).argmin(1) if len(x) else np.zeros(0, np.int64)


def unit(x: np.ndarray) -> np.ndarray:
    return scaled(x) / norm(scaled(x))[:, None]


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component near 1, so that squares neither overflow nor vanish."""
    _, exponent = np.frexp(np.abs(x).max(1, initial=0, keepdims=True))
    half = exponent // 2  # the whole factor itself may be beyond a double
    return np.ldexp(np.ldexp(x, -half), half - exponent)


def norm(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x ** 2).sum(1))


def visit(d1: np.ndarray, d2: np.ndarray, counts: np.ndarray, target: int) -> list[int]:
    """Non-empty cells by rising d1 + d2 until they hold ``target`` entries (multi-sequence traversal)."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    heap, seen, cells, held = [(d1[o1[0]] + d2[o2[0]], 0, 0)], {(0, 0)}, [], 0
    while heap and held < target:
        _, i, j = heapq.heappop(heap)
        cell = int(o1[i]) * len(d2) + int(o2[j])
        if counts[cell]:
            cells.append(cell)
            held += int(counts[cell])
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(d1) and b < len(d2) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (d1[o1[a]] + d2[o2[b]], a, b))
    return cells


def reach(d1: np.ndarray, d2: np.ndarray, counts: np.ndarray, wanted: list, recall: float) -> int:
    """Entries that cells must hold so that ``recall`` of the wanted (query, cell) are among them."""
    need = []
    for q in sorted({r.q for r in wanted}):
        order = visit(d1[q], d2[q], counts, int(counts.sum()))
        held = dict(zip(order, np.cumsum(counts[order])))
        need += [held[r.cell] for r in wanted if r.q == q]
    return int(np.quantile(need, recall, method="higher")) if need else 0


def _sample(df: DataFrame, rows: int, most: int) -> np.ndarray:
    """The vectors of about ``most`` rows at most, chosen by their hash."""
    part = df.select("va", "vb", "v")
    if rows > most:
        part = part.where(F.pmod("va", F.lit(1 << 30)) < int(most / rows * (1 << 30)))
    got = part.toPandas().sort_values(["va", "vb"])
    return _matrix(got["v"])


def _matrix(col: pd.Series) -> np.ndarray:
    return np.array(col.to_list(), np.float64)


def blocks_of(counts: np.ndarray, chunk: int) -> tuple[np.ndarray, np.ndarray]:
    """Each cell's first block and number of blocks: neighbouring cells share one of about ``chunk`` entries, large cells have several."""
    first, parts = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    block, held = 0, 0
    for c, n in enumerate(counts.tolist()):
        if n > chunk:
            block += held > 0
            first[c], parts[c] = block, -(-n // chunk)
            block, held = block + int(parts[c]), 0
            continue
        if held + n > chunk:
            block, held = block + 1, 0
        first[c] = block
        held += n
    return first, parts


def _scan(k: int):
    """Per block: each query's ``k`` best entries of the cells that it visits, ties to the smaller least id."""
    def run(queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(entries):
            e, least, ids = scaled(_matrix(entries["v"])), entries["least"].to_numpy(), entries["ids"].to_list()
            names, of = np.unique(entries["cell"].to_numpy(), return_inverse=True)
            ne = norm(e)
            take = min(4 * k, len(e))
            for a in range(0, len(queries), 256):
                part = queries.iloc[a:a + 256]
                q = scaled(_matrix(part["v"]))
                nq = norm(q)
                visits = np.stack([np.isin(names, c) for c in part["cells"]])
                rough = np.where(visits[:, of], (q @ e.T) / ne / nq[:, None], -np.inf)
                cut = np.partition(rough, len(e) - take, axis=1)[:, len(e) - take]
                for i, (qa, qb) in enumerate(zip(part["va"], part["vb"])):
                    best = np.flatnonzero((rough[i] >= cut[i] - 1e-12) & (rough[i] > -np.inf))
                    s = (e[best] * q[i]).sum(1) / (ne[best] * nq[i])
                    for j in np.lexsort((least[best], -s))[:k]:
                        out.append((qa, qb, float(s[j]), int(least[best[j]]), list(ids[best[j]])))
        return pd.DataFrame(out, columns=["va", "vb", "score", "least", "ids"])
    return run


def entries_of(vectors: DataFrame, id_col: str, vec_col: str, k: int) -> tuple[DataFrame, int]:
    """(vec_id, va, vb, v) of the rows that take part, and their length."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    fine = F.expr("v IS NOT NULL AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) "
                  "AND exists(v, x -> x <> 0)")
    rows = rows.where(fine)
    size = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    dims = size[0].d if size else 0
    return rows.where(F.size("v") == dims).select("vec_id", F.xxhash64("v").alias("va"), F.xxhash64(F.lit(1), "v").alias("vb"), "v"), dims


def nearest_rows(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 50, k: int = 5,
                 recall: float = RECALL, max_train: int = MAX_TRAIN, chunk: int = CHUNK, query_chunk: int = QUERY_CHUNK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row whose id is divisible by ``every``."""
    rows, dims = entries_of(vectors, id_col, vec_col, k)
    rows = stored(rows, "vectors")
    first = Window.partitionBy("va", "vb").orderBy("vec_id")
    few = (rows.dropDuplicates(["vec_id", "va", "vb"]).withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1))
    entries = stored(few.groupBy("va", "vb").agg(F.min("vec_id").alias("least"), F.sort_array(F.collect_list("vec_id")).alias("ids"),
                                                 F.first("v").alias("v")), "entries")
    total = entries.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not total:
        return rows.sparkSession.createDataFrame([], schema)

    sample = unit(_sample(entries, total, max_train).reshape(-1, dims))
    if not len(sample):
        sample = unit(_matrix(entries.limit(1).select("v").toPandas()["v"]))
    m = max(1, min(MAX_CENTROIDS, math.isqrt(total // 50), len(sample)))
    half = max(1, dims // 2)
    books = kmeans(sample[:, :half], m), kmeans(sample[:, half:], m) if dims > 1 else np.zeros((1, 0))
    width = len(books[1])

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = unit(_matrix(b["v"])) if len(b) else np.zeros((0, dims))
            yield b.assign(cell=nearest(x[:, :half], books[0]) * width + nearest(x[:, half:], books[1]))

    index = stored(entries.mapInPandas(cells, "va long, vb long, least long, ids array<long>, v array<double>, cell long"), "index")
    counts = np.zeros(len(books[0]) * width, np.int64)
    for r in index.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():  # at most MAX_CENTROIDS ** 2 rows
        counts[r.cell] = r.n
    asked = rows.where(F.col("vec_id") % every == 0)
    queries = stored(asked.groupBy("va", "vb").agg(F.first("v").alias("v")), "queries")
    tried = unit(_sample(queries, queries.count(), PROBES).reshape(-1, dims))

    def brute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s = tried @ unit(_matrix(b["v"]).reshape(-1, dims)).T
            near = np.argsort(-s, 1)[:, :k + 1]
            yield pd.DataFrame({"q": np.repeat(np.arange(len(tried)), near.shape[1]), "s": np.take_along_axis(s, near, 1).ravel(),
                                "cell": b["cell"].to_numpy()[near.ravel()]})

    close = Window.partitionBy("q").orderBy(F.desc("s"))
    wanted = (index.mapInPandas(brute, "q long, s double, cell long").withColumn("r", F.row_number().over(close))
                   .where(F.col("r") <= k + 1).select("q", "cell").collect())  # at most PROBES * (k + 1) rows
    target = reach(_far(tried[:, :half], books[0]), _far(tried[:, half:], books[1]), counts, wanted, recall)

    first, parts = blocks_of(counts, chunk)

    def probes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            x = unit(_matrix(b["v"]))
            d1, d2 = _far(x[:, :half], books[0]), _far(x[:, half:], books[1])
            for i, (va, vb, v) in enumerate(zip(b["va"], b["vb"], b["v"])):
                to: dict[int, list[int]] = {}
                for c in visit(d1[i], d2[i], counts, target):
                    for j in range(int(parts[c])):
                        to.setdefault(int(first[c]) + j, []).append(c)
                yield pd.DataFrame({"va": va, "vb": vb, "v": [v] * len(to), "cells": list(to.values()), "block": list(to)})

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            c = b["cell"].to_numpy()
            yield b.assign(block=first[c] + b["vb"].to_numpy() % parts[c])

    spread_out = queries.repartition(queries.sparkSession.sparkContext.defaultParallelism, "va")
    sent = stored(spread_out.mapInPandas(probes, "va long, vb long, v array<double>, cells array<long>, block long"), "visits")
    held = index.mapInPandas(dealt, "va long, vb long, least long, ids array<long>, v array<double>, cell long, block long")
    visitors = stored(sent.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / query_chunk).alias("chunks")), "visitors")
    if visitors.count() <= MAX_VISITED:
        visitors = F.broadcast(visitors)
    sent = sent.join(visitors, "block").withColumn("part", F.pmod("va", "chunks")).drop("chunks")
    held = held.join(visitors, "block").withColumn("part", F.explode(F.expr("sequence(0L, chunks - 1)"))).drop("chunks")
    found = (sent.groupBy("block", "part").cogroup(held.groupBy("block", "part"))
                 .applyInPandas(_scan(k + 1), "va long, vb long, score double, least long, ids array<long>"))
    best = Window.partitionBy("va", "vb").orderBy(F.desc("score"), "least")
    top = stored(found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
                      .select("va", "vb", "score", F.explode("ids").alias("vec_id")), "top")
    mine = asked.select(F.col("vec_id").alias("query_id"), "va", "vb").distinct()
    rank = F.row_number().over(Window.partitionBy("query_id", "va", "vb").orderBy(F.desc("score"), "vec_id"))
    return (mine.join(top, ["va", "vb"]).where("vec_id <> query_id").withColumn("rank", rank).where(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))


def op9_inverted_multi_index(spark, sf_dir: str) -> DataFrame:
    return nearest_rows(table(spark, sf_dir, "embeddings"))


ship_by_value(__name__)
