from pyspark.sql import functions as F

from tidewater.operators import aggregate as A
from conftest import rows


def test_counts_average_max_totals(spark):
    df = spark.createDataFrame([("IT", 10.0, 3), ("IT", 20.0, None), ("HR", 5.0, 4)], "dept string, v double, n int")
    assert rows(A.row_count(df)) == [(3,)]
    assert rows(A.count_by(df, "dept")) == [("HR", 1), ("IT", 2)]
    assert rows(A.average(df, "v", "avg_v", by=["dept"])) == [("HR", 5.0), ("IT", 15.0)]
    assert rows(A.maximum(df, "v", "m")) == [(20.0,)]
    assert rows(A.document_totals(df, "n", by=["dept"])) == [("HR", 1, 4), ("IT", 2, 3)]


def test_gather_sorted_and_counted(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, "c", 1)], "k int, name string, size int")
    g = {r.k: r for r in A.gather(df, ["k"], ["name", "size"]).collect()}
    assert [x.name for x in g[1].items] == ["a", "b"] and g[1].n_items == 2


def test_stats_queue_depth(spark):
    df = spark.createDataFrame([("a", "queued", 10), ("a", "sent", 30), ("b", "queued", 5)], "k string, status string, size int")
    assert rows(A.queue_depth(df)) == [(2, 3)]
    assert rows(A.table_stats(df, "size", "k")) == [(3, 2, 45, 15.0, 30)]


def test_evaluate_and_report_match_manual(spark):
    pairs = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 1), (1, 0)]
    df = spark.createDataFrame(pairs, "label int, pred int")
    ev = A.evaluate(df, "label", "pred").first()
    assert abs(ev.accuracy_pct - 100 * 3 / 6) < 1e-9
    rep = {r["class"]: r for r in A.classification_report(df, "label", "pred").collect()}
    # class 1: tp=2, predicted=4, support=3
    assert abs(rep[1].precision - 0.5) < 1e-12 and abs(rep[1].recall - 2 / 3) < 1e-12
    assert abs(rep[1].f1 - 2 * 0.5 * (2 / 3) / (0.5 + 2 / 3)) < 1e-12
    assert rep[2].support == 1 and rep[2].precision == 0.0 and rep[2].recall == 0.0
    assert set(rep) == {0, 1, 2}


def test_profile_and_constraints(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (2, 4.0)], "a int, b double")
    p = {r.column: r for r in A.profile(df).collect()}
    assert (p["a"].n, p["a"].nulls, p["a"].n_distinct, p["a"].min, p["a"].max) == (3, 0, 2, 1.0, 2.0)
    assert p["b"].nulls == 1 and abs(p["b"].mean - 3.0) < 1e-12
    cur = A.profile(spark.createDataFrame([(5, 2.0), (2, 3.0), (2, 4.0)], "a int, b double"))
    chk = {(r.column, r.check): r.ok for r in A.check_constraints(cur, A.profile(df)).collect()}
    assert chk[("a", "max")] is False and chk[("b", "min")] is True and chk[("b", "null_ratio")] is True
    approx = A.profile(df, exact_distinct=False)
    assert {r.column: r.n_distinct for r in approx.collect()}["a"] == 2


def test_profile_covers_every_column(spark):
    schema = "s string, d date, f boolean, l array<int>, b binary, m map<string,int>, `a.b` int"
    from datetime import date
    row = lambda s, d: (s, d and date(2020, 1, d), True, [1], b"x", {"k": 1}, 7)
    base = A.profile(spark.createDataFrame([row("b", 2), row("c", 3), row("c", None)], schema))
    p = {r.column: r for r in base.collect()}
    assert list(p) == ["s", "d", "f", "l", "b", "m", "a.b"]
    assert (p["s"].n, p["s"].nulls, p["s"].n_distinct, p["s"].min_text, p["s"].max_text, p["s"].mean) == (3, 0, 2, "b", "c", None)
    assert (p["d"].nulls, p["d"].min_text, p["d"].max_text, p["f"].max_text, p["b"].n_distinct) == (1, "2020-01-02", "2020-01-03", "true", 1)
    assert p["a.b"].max == 7.0 and p["a.b"].max_text is None
    current = A.profile(spark.createDataFrame([row("a", 2), row(None, 2), row(None, 3)], schema))
    chk = {(r.column, r.check): r.ok for r in A.check_constraints(current, base).collect()}
    assert not chk[("s", "null_ratio")] and not chk[("s", "min")] and chk[("s", "max")] and chk[("d", "min")] and ("s", "mean") not in chk


def test_gather_rows_counts(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, "c", 1)], "k int, name string, size int")
    assert rows(A.gather_rows(df, ["k"], ["name"])) == [(1, "a", 2), (1, "b", 2), (2, "c", 1)]


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=60))
def test_classification_report_matches_python(spark, pairs):
    df = spark.createDataFrame(pairs, "label int, pred int")
    got = {r["class"]: (r.precision, r.recall, r.f1, r.support) for r in A.classification_report(df, "label", "pred").collect()}
    want = {}
    for c in {x for p in pairs for x in p}:
        tp = sum(1 for l, p in pairs if l == c and p == c)
        sup = sum(1 for l, _ in pairs if l == c)
        prd = sum(1 for _, p in pairs if p == c)
        pr = tp / prd if prd else 0.0
        rc = tp / sup if sup else 0.0
        want[c] = (pr, rc, 2 * pr * rc / (pr + rc) if pr + rc else 0.0, sup)
    assert set(got) == set(want)
    for c in want:
        assert all(abs(a - b) < 1e-12 for a, b in zip(got[c], want[c])), (c, got[c], want[c])


def test_gather_chunks_of_a_hot_group(spark):
    """A group with most rows, equal records and a NULL key: chunks in order are the sorted list, none beyond its bound."""
    data = [(None if i % 10 == 0 else "b" if i % 10 == 1 else "hot", i * 7919 % 1000 if i % 3 else 5, "x" * (i % 4)) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, v int, t string").repartition(6)
    for size, chunk, most in ((F.lit(1), 100, 100), (None, 500, 500 + 30)):
        got = A.gather_chunks(df, ["g"], ["v", "t"], chunk, size).collect()
        lists = {}
        for r in sorted(got, key=lambda r: r.chunk):
            assert r.n_items == len(r["items"]) > 0
            if size is not None:
                assert r.n_items <= most
            else:
                assert sum(len('{"v":,"t":""}') + len(str(x.v)) + len(x.t) for x in r["items"]) <= most
            lists.setdefault(r.g, []).extend((x.v, x.t) for x in r["items"])
        assert lists == {g: sorted((v, t) for k, v, t in data if k == g) for g in (None, "b", "hot")}
    assert A.gather_chunks(df.where("false"), ["g"], ["v"]).collect() == []


def test_gather_chunks_parts_by_size(spark, monkeypatch):
    """Parts and blocks follow the number and width of the records: none holds more than its share, lists stay whole."""
    monkeypatch.setattr(A, "TASK_BYTES", 40_000, raising=False)  # about 300 of these records
    monkeypatch.setattr(A, "BLOCK_ROWS", 16, raising=False)
    kept = {}
    write = A.materialised
    monkeypatch.setattr(A, "materialised", lambda df, name: kept.setdefault(name, write(df, name)))
    data = [("hot" if i % 20 else f"g{i % 60}" if i % 40 else None, i * 7919 % 1000 if i % 3 else 5) for i in range(6000)]
    out = A.gather_chunks(spark.createDataFrame(data, "g string, v int").repartition(6), ["g"], ["v"], 70, F.lit(1))
    per_part = [r["count"] for r in kept["gather"].groupBy("_tw_part").count().collect()]
    assert sum(per_part) == 6000 and max(per_part) <= 900
    lists = {}
    for r in sorted(out.collect(), key=lambda r: r.chunk):
        assert r.n_items == len(r["items"]) and r.chunk == len(lists.get(r.g, [])) // 70 and r.n_items <= 70
        lists.setdefault(r.g, []).extend(x.v for x in r["items"])
    assert lists == {g: sorted(v for k, v in data if k == g) for g in {k for k, _ in data}}


def test_profiles_merge_without_the_data(spark):
    df = spark.range(30_000).select((F.col("id") % 3).alias("day"), (F.col("id") % 9000).alias("a"), F.when(F.col("id") % 10 > 0, F.col("id").cast("string")).alias("b"))
    days = [A.profile_sketches(df.where(f"day = {k}"), ["a", "b"], by=["day"]) for k in range(3)]
    merged = {r.column: r for r in A.merge_profiles(days[0].unionByName(days[1]).unionByName(days[2])).collect()}
    assert merged["a"].n == 30_000 and merged["b"].nulls == 3000 and merged["a"].min_text == "0"
    assert abs(merged["a"].n_distinct - 9000) < 0.03 * 9000 and abs(merged["b"].n_distinct - 27_000) < 0.03 * 27_000
