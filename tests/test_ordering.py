import datetime as dt

from pyspark.sql import functions as F

from tidewater.operators import ordering as O
from conftest import rows


def test_first_n_global_and_grouped(spark):
    df = spark.createDataFrame([(i, "a" if i < 7 else "b") for i in range(10)], "id int, g string")
    top = O.first_n(df, 3, order=["id"])
    assert rows(top, "rank", "id", "total", "more") == [(1, 0, 10, 7), (2, 1, 10, 7), (3, 2, 10, 7)]
    grp = O.first_n(df, 2, order=[F.col("id").desc()], by=["g"])
    assert rows(grp, "g", "rank", "id", "total", "more") == [
        ("a", 1, 6, 7, 5), ("a", 2, 5, 7, 5), ("b", 1, 9, 3, 1), ("b", 2, 8, 3, 1)]


def test_group_limit_is_map_side(spark):
    df = spark.range(10000).select((F.col("id") % 5).alias("g"), F.col("id"))
    plan = O.leaderboard(df, ["g"], "id", 3, method="row_number")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_latest_suffix_sort_newest(spark):
    df = spark.createDataFrame([("job-9", "x"), ("job-10", "x"), ("other", "x"), ("job-2", "y")], "n string, g string")
    assert rows(O.latest_suffix(df, "n")) == [("job-10", 10)]
    assert rows(O.latest_suffix(df, "n", by=["g"])) == [("x", "job-10", 10), ("y", "job-2", 2)]
    d = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("b", None), ("c", dt.date(2024, 2, 1))], "k string, d date")
    assert [r.k for r in O.newest_first(d, "d", tie=["k"]).collect()] == ["c", "a", "b"]
    assert [r.k for r in O.sort_by(d, ["k"], descending=True).collect()] == ["c", "b", "a"]


def test_chat_history_and_leaderboard_ties(spark):
    cv = spark.createDataFrame([(2, 1, "b"), (1, 1, "y"), (1, 0, "x")], "conv_id int, turn int, text string")
    assert [r.text for r in O.chat_history(cv).collect()] == ["x", "y", "b"]
    assert [r.text for r in O.chat_history(cv, conv=1).collect()] == ["x", "y"]
    s = spark.createDataFrame([("u1", 5.0), ("u2", 5.0), ("u3", 1.0)], "u string, s double")
    assert rows(O.leaderboard(s, [], "s", 2), "u", "rank") == [("u1", 1), ("u2", 1)]
    assert rows(O.leaderboard(s, [], "s", 2, method="dense_rank"), "u", "rank") == [("u1", 1), ("u2", 1), ("u3", 2)]


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["g1", "g2", "g3"]), st.integers(0, 1000)), min_size=1, max_size=50,
                unique_by=lambda t: t[1]),
       st.integers(1, 5))
def test_first_n_matches_python(spark, items, n):
    df = spark.createDataFrame(items, "g string, v int")
    got = sorted(tuple(r) for r in O.first_n(df, n, order=["v"], by=["g"]).select("g", "rank", "v", "total", "more").collect())
    want = []
    for g in {i[0] for i in items}:
        vs = sorted(v for gg, v in items if gg == g)
        want += [(g, r + 1, v, len(vs), max(len(vs) - n, 0)) for r, v in enumerate(vs[:n])]
    assert got == sorted(want)


import random  # noqa: E402
from collections import Counter, defaultdict  # noqa: E402

import pytest  # noqa: E402


@pytest.mark.parametrize("method", ["rank", "dense_rank", "row_number"])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_ranks_beyond_the_group_limit(spark, method, by):
    """n above Spark's own limit: salted first, then whole; ties kept, a group with two thirds of the rows."""
    r = random.Random(4)
    data = [(r.choice(["a", "a", "b"]), r.randrange(120) if method != "row_number" else i, i) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, s int, i int").repartition(4)
    old = spark.conf.get(O.GROUP_LIMIT)
    try:
        spark.conf.set(O.GROUP_LIMIT, "50")
        got = Counter((x.g if by else None, x.s, x["rank"]) for x in O.leaderboard(df, by, "s", 90, method=method).collect())
    finally:
        spark.conf.set(O.GROUP_LIMIT, old)
    groups = defaultdict(list)
    for g, s, _ in data:
        groups[g if by else None].append(s)
    want = Counter()
    for g, scores in groups.items():
        scores.sort(reverse=True)
        distinct = sorted(set(scores), reverse=True)
        for k, s in enumerate(scores, 1):
            rank = {"rank": scores.index(s) + 1, "dense_rank": distinct.index(s) + 1, "row_number": k}[method]
            if rank <= 90:
                want[g, s, rank] += 1
    assert got == want


def test_rank_all_rows_with_a_hot_key_and_nulls(spark):
    r = random.Random(5)
    data = [(i, None if i % 50 == 0 else 7.0 if i % 3 == 0 else float(r.randrange(400))) for i in range(2000)]
    df = spark.createDataFrame(data, "i int, s double").repartition(5)
    for descending in (False, True):
        out = O.rank_all(df, ["s"], descending, dense_col="dense")
        got = {x.i: (x["rank"], x.dense) for x in out.collect()}
        order = sorted((s for _, s in data if s is not None), reverse=descending)
        distinct = sorted(set(order), reverse=descending)
        first, place = {}, {s: k for k, s in enumerate(distinct, 1)}
        for k, s in enumerate(order, 1):
            first.setdefault(s, k)
        want = {i: (len(order) + 1, len(distinct) + 1) if s is None else (first[s], place[s]) for i, s in data}
        assert got == want
        assert "Window" in out._jdf.queryExecution().executedPlan().toString() and "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    assert O.rank_all(df.where("false"), ["s"]).collect() == []
