"""Vector top-k retrieval (W7): exact cosine neighbours over a pivot index.

Index. A bounded sample of the corpus are pivots; every vector belongs to its
nearest pivot, and cells too large for one task are cut into rings by the
angle to the pivot (and rings of equal angles into pieces by id). Per block,
only its pivot and the smallest and largest angle to it are kept.

Search. By the triangle inequality on the sphere no vector of a block is nearer to a
query than the gap between the query's angle to the pivot and the
block's range of angles. A query first visits the nearest blocks that hold
k vectors; the k-th similarity found then rules out every block whose bound is
beyond it, and only the rest is visited: the result is exact whatever the data,
blocks visited depend on how clustered they are.

Queries travel to the blocks: the corpus is written once, in its blocks, and is
never copied per group of queries. A task holds one block piece and streams the
queries that visit it, so neither side is ever one in-memory group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import materialised, ship_by_value

ship_by_value(__name__)

BLOCK_ROWS = 4096      # corpus vectors that a task multiplies against at once, about
MAX_PIVOTS = 512       # pivots, at most
SAMPLE = 8             # vectors that the driver draws to choose a pivot from
QUERY_CHUNK = 512
VISIT_BYTES = 4 << 20  # of query vectors in a frame that a task hands on, about
BOUND_CELLS = 250_000  # (query, block piece) bounds that a task holds at once
SLACK = 1e-6           # radians: far above the rounding of an angle
NEIGHBOUR_SCHEMA = "query_id long, neighbor_id long, similarity double"


def _unit(mat: np.ndarray) -> np.ndarray:
    """Rows of length 1, scaled by their largest component first so that nothing over- or underflows; NaN without a direction."""
    with np.errstate(divide="ignore", invalid="ignore"):
        top = np.abs(mat).max(axis=1, initial=0.0)
        out = mat / top[:, None]
        out = out / np.linalg.norm(out, axis=1)[:, None]
    out[~np.isfinite(out).all(axis=1)] = np.nan
    return out


def _matrix(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors]) if len(vectors) else np.zeros((0, 0))


def _angles(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ pivots.T, -1.0, 1.0))


def _chunk_top_k(q_ids, q_unit, c_ids, c_unit, k, exclude_self):
    sims = q_unit @ c_unit.T
    sims = np.where(np.isnan(sims), -np.inf, sims)
    if exclude_self:
        sims[q_ids[:, None] == c_ids[None, :]] = -np.inf
    kk = min(k, sims.shape[1])
    part = np.argpartition(-sims, kk - 1, axis=1)[:, :kk]
    kth = sims[np.arange(len(q_ids))[:, None], part].min(axis=1)
    qs, ns, ss = [], [], []
    for i in range(len(q_ids)):
        cand = np.nonzero((sims[i] >= kth[i]) & np.isfinite(sims[i]))[0]
        order = cand[np.lexsort((c_ids[cand], -sims[i, cand]))][:kk]
        qs.append(np.full(len(order), q_ids[i]))
        ns.append(c_ids[order])
        ss.append(sims[i, order])
    return qs, ns, ss


def block_top_k(q_ids: np.ndarray, q_unit: np.ndarray, c_ids: np.ndarray, c_unit: np.ndarray,
                k: int, exclude_self: bool, chunk: int = QUERY_CHUNK) -> pd.DataFrame:
    """Exact top-k of one block piece, ordered by (similarity desc, id asc); queries are taken ``chunk`` rows at a time."""
    qs, ns, ss = [np.zeros(0)], [np.zeros(0)], [np.zeros(0)]
    if len(c_ids):
        for lo in range(0, len(q_ids), chunk):
            a, b, c = _chunk_top_k(q_ids[lo:lo + chunk], q_unit[lo:lo + chunk], c_ids, c_unit, k, exclude_self)
            qs += a
            ns += b
            ss += c
    return pd.DataFrame({"query_id": np.concatenate(qs).astype("int64"),
                         "neighbor_id": np.concatenate(ns).astype("int64"),
                         "similarity": np.concatenate(ss).astype("float64")})


@dataclass
class PivotIndex:
    """``rows`` (block, piece, id, v) lie in the shared folder; the rest is one entry a pivot or a block."""
    rows: DataFrame
    pivots: np.ndarray   # unit vectors
    pivot: np.ndarray    # of each block
    low: np.ndarray      # smallest angle to the pivot in each block
    high: np.ndarray     # largest
    count: np.ndarray
    pieces: np.ndarray

    def bounds(self, unit: np.ndarray) -> np.ndarray:
        """Smallest angle that a vector of each block can have to each of the unit vectors."""
        a = _angles(unit, self.pivots)[:, self.pivot]
        return np.maximum(0.0, np.maximum(a - self.high, self.low - a))

    def nearest(self, bounds: np.ndarray, need: int) -> np.ndarray:
        """Per row, the blocks of the smallest bounds that hold ``need`` vectors together."""
        order = np.argsort(bounds, axis=1, kind="stable")
        held = np.cumsum(self.count[order], axis=1)
        first = np.zeros(bounds.shape, bool)
        np.put_along_axis(first, order, held - self.count[order] < need, axis=1)
        return first


def _directed(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(
        F.col("v").isNotNull() & (F.size("v") > 0) & F.exists("v", lambda x: x != 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))


def _spread_out(unit: np.ndarray, wanted: int) -> np.ndarray:
    """Up to ``wanted`` of the vectors, each the farthest from those before it; no two of the same direction."""
    chosen, gap = [0], _angles(unit, unit[:1])[:, 0]
    while len(chosen) < wanted and gap.max() > SLACK:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, _angles(unit, unit[chosen[-1:]])[:, 0])
    return unit[chosen]


def pivot_index(corpus: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", block_rows: int = BLOCK_ROWS,
                max_pivots: int = MAX_PIVOTS) -> PivotIndex:
    """Cut ``corpus`` into blocks around pivots (module notes). The driver holds the pivots and one row a block."""
    c = _directed(corpus, id_col, vec_col)
    wanted = max(1, min(max_pivots, -(-corpus.count() // block_rows)))  # rows without a direction count too: a few pivots more
    drawn = c.withColumn("_h", F.xxhash64("id", F.lit("pivot"))).orderBy("_h", "id").limit(SAMPLE * wanted).select("v").collect()
    pivots = _spread_out(_unit(_matrix([r["v"] for r in drawn])), wanted) if drawn else np.zeros((1, 1))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                a = _angles(_unit(_matrix(b["v"])), pivots)
                cell = a.argmin(axis=1)
                yield pd.DataFrame({"id": b["id"], "v": b["v"], "cell": cell.astype("int32"), "angle": a[np.arange(len(b)), cell]})

    placed = materialised(c.mapInPandas(assign, "id long, v array<double>, cell int, angle double"), "pivot-cells")
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("angle").alias("lo"), F.max("angle").alias("hi")).collect()
    known = corpus.sparkSession.createDataFrame([(r["cell"], r["lo"], r["hi"] - r["lo"], -(-r["n"] // block_rows)) for r in cells],
                                                "cell int, lo double, spread double, rings long")
    part = (F.col("angle") - F.col("lo")) / F.col("spread") * F.col("rings")
    ringed = placed.join(F.broadcast(known), "cell").withColumn(  # at most max_pivots rows
        "ring", F.when(F.col("spread") > 0, F.least(F.floor(part), F.col("rings") - 1)).otherwise(F.lit(0)))
    found = ringed.groupBy("cell", "ring").agg(F.count(F.lit(1)).alias("n"), F.min("angle").alias("lo"), F.max("angle").alias("hi"))
    blocks = found.orderBy("cell", "ring").toPandas()
    blocks["block"], blocks["pieces"] = np.arange(len(blocks)), -(-blocks["n"] // block_rows)
    numbered = corpus.sparkSession.createDataFrame(blocks[["cell", "ring", "block", "pieces"]].astype("int64"),
                                                   "cell long, ring long, block long, pieces long") if len(blocks) else \
        corpus.sparkSession.createDataFrame([], "cell long, ring long, block long, pieces long")
    rows = ringed.select(F.col("cell").cast("long").alias("cell"), F.col("ring").cast("long").alias("ring"), "id", "v").join(numbered, ["cell", "ring"])
    rows = rows.select("block", F.pmod(F.xxhash64("id", F.lit("piece")), "pieces").alias("piece"), "id", "v")
    return PivotIndex(rows, pivots, *(blocks[x].to_numpy() for x in ("cell", "lo", "hi", "n", "pieces")))


def _search(index: PivotIndex, visits: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    """Top k of every (query, block piece) that meet. Within a task a piece's vectors come first, its queries stream after them."""
    rows = index.rows.withColumn("asks", F.lit(0)).unionByName(visits.withColumn("asks", F.lit(1)))
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, min(16_384, int(index.pieces.sum()) if len(index.pieces) else 1))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, ids, vectors, unit = None, [], [], None
        for b in batches:
            where = b[["block", "piece", "asks"]].to_numpy()
            cuts = np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(b)]):
                if hi == lo:
                    continue
                block, piece, asks = where[lo]
                if (block, piece) != key:
                    key, ids, vectors, unit = (block, piece), [], [], None
                own, mat = b["id"].to_numpy(np.int64)[lo:hi], _matrix(b["v"].iloc[lo:hi])
                if not asks:
                    ids.append(own)
                    vectors.append(mat)
                elif ids:
                    if unit is None:
                        unit = _unit(np.concatenate(vectors))
                    yield block_top_k(own, _unit(mat), np.concatenate(ids), unit, k, exclude_self)

    return rows.repartition(tasks, "block", "piece").sortWithinPartitions("block", "piece", "asks").mapInPandas(run, NEIGHBOUR_SCHEMA)


def _visits(index: PivotIndex, need: int, later: bool):
    """The (block, piece) that each query goes to: first the nearest ones, ``later`` the others in reach of its ``kth`` similarity.

    A query may visit every piece, so neither bounds nor visits are held for a whole batch of queries.
    """
    step = max(1, BOUND_CELLS // max(1, int(index.pieces.sum())))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b) if len(index.pivot) else 0, step):
                part = b.iloc[lo:lo + step]
                unit = _unit(_matrix(part["v"]))
                bounds = index.bounds(unit)
                go = first = index.nearest(bounds, need)
                if later:  # a query with fewer than k neighbours so far visits all
                    reach = np.where(np.isnan(part["kth"]), np.inf, np.arccos(np.clip(part["kth"], -1, 1)) + SLACK)
                    go = (bounds <= reach[:, None]) & ~first
                q, block = np.nonzero(go)
                times = index.pieces[block]
                ends = np.cumsum(times)
                size = max(1, VISIT_BYTES // (8 * unit.shape[1]))
                for a in range(0, int(ends[-1]) if len(q) else 0, size):
                    at = np.arange(a, min(a + size, int(ends[-1])))
                    of = np.searchsorted(ends, at, side="right")
                    yield pd.DataFrame({"block": block[of], "piece": at - (ends[of] - times[of]),
                                        "id": part["id"].to_numpy()[q[of]], "v": part["v"].to_numpy()[q[of]]})
    return run


def vector_top_k(queries: DataFrame, corpus: DataFrame, k: int = 5, id_col: str = "vec_id",
                 vec_col: str = "embedding", exclude_self: bool = False,
                 prefix: str | None = None, prefix_col: str | None = None,
                 block_rows: int = BLOCK_ROWS, max_pivots: int = MAX_PIVOTS, report: bool = False) -> DataFrame:
    """W7. Exact cosine top-k neighbours of every query row.

    ``prefix``/``prefix_col`` restricts the corpus to rows whose
    ``prefix_col`` starts with ``prefix`` (pushed to the scan). Output:
    ``query_id, rank, neighbor_id, similarity`` (ties: lower id first).
    ``exclude_self`` leaves out the corpus row with the query's id: for a
    table searched in itself. Rows without a direction (NULL, zero, NaN or
    infinite vectors) are neighbours of nothing and have none. ``report`` adds
    ``blocks_visited`` and ``blocks`` to each row.
    """
    if prefix is not None:
        corpus = corpus.filter(F.col(prefix_col).startswith(prefix))
    index = pivot_index(corpus, id_col, vec_col, block_rows, max_pivots)
    asked, need = _directed(queries, id_col, vec_col), k + int(exclude_self)
    pivots = PivotIndex(None, index.pivots, index.pivot, index.low, index.high, index.count, index.pieces)
    schema = "block long, piece long, id long, v array<double>"
    near = materialised(_search(index, asked.mapInPandas(_visits(pivots, need, False), schema), k, exclude_self), "near")
    w = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), F.col("neighbor_id").asc())
    top = lambda found: found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    kth = top(near).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("similarity").alias("kth"))
    second = asked.join(kth, "id", "left").mapInPandas(_visits(pivots, need, True), schema)
    if report:
        second = materialised(second, "visits")
    out = top(near.unionByName(_search(index, second, k, exclude_self))).select("query_id", "rank", "neighbor_id", "similarity")
    if not report:
        return out
    seen = asked.mapInPandas(_visits(pivots, need, False), schema).unionByName(second).select("id", "block").distinct()
    seen = seen.groupBy(F.col("id").alias("query_id")).agg(F.count(F.lit(1)).alias("blocks_visited"))
    return out.join(seen, "query_id").withColumn("blocks", F.lit(len(index.pivot)).cast("long"))
