import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewater.operators import vector
from tidewater.operators.vector import vector_top_k


def _brute(ids, mat, k):
    u = mat / np.linalg.norm(mat, axis=1)[:, None]
    s = u @ u.T
    out = {}
    for i, q in enumerate(ids):
        cand = [(-s[i, j], ids[j]) for j in range(len(ids)) if ids[j] != q]
        out[q] = [c[1] for c in sorted(cand)[:k]]
    return out


def _frame(spark, ids, mat):
    return spark.createDataFrame([(int(i), v.tolist(), "src%d/x" % (i % 3)) for i, v in zip(ids, mat)],
                                 "vec_id long, embedding array<float>, source string")


def _found(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.neighbor_id)
    return got


@pytest.mark.parametrize("block_rows, pivots", [(1000, 8), (16, 4), (16, 100)])
def test_pivot_search_equals_brute_force(spark, block_rows, pivots):
    rng = np.random.default_rng(7)
    mat = rng.normal(size=(120, 16)).astype(np.float32)
    mat[5] = mat[6]  # exact duplicate: tie broken by id
    ids = list(range(100, 220))
    df = _frame(spark, ids, mat)
    want = _brute(np.array(ids), mat.astype(np.float64), 5)
    assert _found(vector_top_k(df, df, 5, exclude_self=True, block_rows=block_rows, max_pivots=pivots)) == want


def test_prefix_and_rows_without_direction(spark):
    mat = np.random.default_rng(8).normal(size=(60, 8)).astype(np.float32)
    df = _frame(spark, range(60), mat)
    pre = vector_top_k(df, df, 3, prefix="src1/", prefix_col="source", block_rows=8)
    assert {r.neighbor_id % 3 for r in pre.collect()} == {1} and pre.count() == 180
    odd = spark.createDataFrame([(900, [0.0] * 8, "src1/"), (901, None, "src1/"), (902, [float("nan")] * 8, "src1/"), (903, [], "src1/"),
                                 (904, [float("inf")] * 8, "src1/")], "vec_id long, embedding array<float>, source string")
    both = df.unionByName(odd)
    got = _found(vector_top_k(both, both, 3, exclude_self=True, block_rows=8))
    assert set(got) == set(range(60)) and max(max(v) for v in got.values()) < 60
    assert vector_top_k(df, df.where("false"), 3).collect() == [] and vector_top_k(df.where("false"), df, 3).collect() == []


def test_extreme_lengths_do_not_change_directions(spark):
    df = spark.createDataFrame([(1, [1e200, 1e200, 0.0]), (2, [1e-200, 0.0, 0.0]), (3, [1.0, 1.0, 0.0]), (4, [0.0, 0.0, 5.0])], "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank): (r.neighbor_id, r.similarity) for r in vector_top_k(df, df, 1, exclude_self=True).collect()}
    assert got[1, 1][0] == 3 and got[1, 1][1] == pytest.approx(1.0) and got[2, 1][1] == pytest.approx(0.5 ** 0.5)


def test_clustered_corpus_prunes_blocks_and_stays_exact(spark):
    """40 tight clusters, one of which holds a third of all rows in equal copies."""
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(40, 24))
    mat = np.concatenate([centres[rng.integers(0, 40, 800)] + rng.normal(size=(800, 24)) * 0.01, np.repeat(centres[:1], 400, 0)])
    ids = np.arange(len(mat))
    df = _frame(spark, ids, mat)
    queries = df.where("vec_id % 40 = 0")
    out = vector_top_k(queries, df, 5, exclude_self=True, block_rows=32, max_pivots=64, report=True).persist()
    want = _brute(ids, np.array([r.embedding for r in df.orderBy("vec_id").collect()]), 5)
    got = _found(out)
    stats = out.groupBy("query_id").agg(F.max("blocks_visited").alias("n"), F.max("blocks").alias("of")).collect()
    out.unpersist()
    assert set(got) == {int(i) for i in ids if i % 40 == 0}
    u = mat / np.linalg.norm(mat, axis=1)[:, None]
    for q, found in got.items():  # equal copies may change places by rounding: similarities must agree
        assert np.allclose(sorted(u[q] @ u[found].T), sorted(u[q] @ u[want[q]].T), atol=1e-7)
    assert all(r.n <= r.of / 3 for r in stats) and stats[0].of >= 38  # most blocks are never visited


def test_plan_has_no_cartesian(spark):
    df = spark.range(50).select("id", F.array(*[F.rand(i) for i in range(4)]).cast("array<float>").alias("e"))
    plan = vector_top_k(df, df, 3, id_col="id", vec_col="e", block_rows=16)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("later", [False, True])
def test_visits_are_handed_on_in_bounded_frames(later):
    """A batch of queries that all visit nearly every block piece: no frame grows with the number of blocks, none is lost."""
    rng = np.random.default_rng(3)
    n, blocks, dims = 3000, 40, 64
    pieces = np.array([3 if b % 7 == 0 else 1 for b in range(blocks)])
    index = vector.PivotIndex(None, vector._unit(rng.normal(size=(blocks, dims))), np.arange(blocks), np.zeros(blocks), np.full(blocks, 3.1),
                              np.full(blocks, 5000), pieces)
    batch = pd.DataFrame({"id": np.arange(n), "v": list(rng.normal(size=(n, dims))), "kth": np.where(np.arange(n) % 2, np.nan, -1.0)})
    frames = list(vector._visits(index, 6, later)(iter([batch])))
    assert max(len(f) for f in frames) * dims * 8 <= 4 << 20
    got = pd.concat(frames)
    bounds = index.bounds(vector._unit(np.stack(batch["v"])))
    go = (index.nearest(bounds, 6) != later) if later else index.nearest(bounds, 6)
    want = {(q, b, p) for q, b in zip(*np.nonzero(go)) for p in range(pieces[b])}
    seen = list(zip(got["id"], got["block"], got["piece"]))
    assert len(seen) == len(want) and set(seen) == want
    assert all((v == batch["v"][i]).all() for i, v in list(zip(got["id"], got["v"]))[::997])
