"""Cases that were wrong once: missing predictions, blank sections, order of changes, and the like."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewater.operators import aggregate as A
from tidewater.operators import audit as AU
from tidewater.operators import ml as M
from tidewater.operators import nested as N
from tidewater.operators import shape as P
from tidewater.operators.vector import vector_top_k
from tidewater.sinks import to_log_rows
from tidewater.sources.catalog import register_table
from tidewater.streaming.jobs import apply_changes, consume_rows
from tidewater.streaming.tables import read_table


def test_missing_prediction_is_wrong(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (0, 1), (0, None)], "y int, p int")
    assert A.evaluate(df, "y", "p").first().accuracy_pct == 25.0


def test_tenure_a_year_ahead_is_null(spark):
    df = spark.createDataFrame([("2025-01-01", 10.0)], "d string, a double")
    assert P.tenure(df, "d", "a", as_of="2024-01-02").first().amount_per_year is None


def test_blank_sections_keep_their_number(spark):
    df = spark.createDataFrame([(1, "A\n\n \n\nB"), (2, ""), (3, None)], "id int, text string")
    got = rows(N.sections(df, "text", ["id"], title_prefix="Slide"), "id", "section_no", "title")
    assert got == [(1, 1, "A"), (1, 2, "Slide 2"), (1, 3, "B"), (2, 1, "Slide 1"), (3, 1, "Slide 1")]


def test_csv_columns_are_read_by_name(spark):
    df = spark.createDataFrame([('b,x,a\r\n1,"p, ""q""",u\r\n,,v\n',)], "t string")
    got = rows(AU.explode_csv_text(df, "t", "a string, b int, c string, x string"), "a", "b", "c", "x")
    assert got == [("u", 1, None, 'p, "q"'), ("v", None, None, None)]


def test_prediction_keeps_rows_with_missing_features(spark):
    train = spark.createDataFrame([(float(i), float(i % 7), int(i > 50)) for i in range(100)], "a double, b double, y int")
    model = M.train_linear(train, ["a", "b"], "y")
    test = spark.createDataFrame([(1, 3.0, 1.0), (2, None, 1.0), (3, 90.0, float("nan"))], "id int, a double, b double")
    got = rows(M.predict(model, test, keep=["id"]), "id", "prediction", "error")
    assert got == [(1, 0.0, None), (2, None, "missing feature"), (3, None, "missing feature")]


def test_drift_sees_nulls_and_empty_frames(spark):
    base = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    nulls = base.select(F.when(F.col("x") % 10 == 0, F.col("x")).alias("x"))
    assert M.drift(base, nulls, "x").first().psi > 1
    assert M.drift(base, base.limit(0), "x").first().psi > 1


def test_neighbours_of_another_table_keep_equal_ids(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0])], "vec_id long, embedding array<double>")
    c = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert vector_top_k(q, c, 1).first().neighbor_id == 1


def test_registering_another_place_is_an_error(spark, tmp):
    for n in "ab":
        spark.range(3).write.parquet(f"{tmp}/{n}")
    spark.sql("DROP TABLE IF EXISTS corrections.t")
    assert register_table(spark, "corrections", "t", f"{tmp}/a").count() == 3
    assert register_table(spark, "corrections", "t", f"{tmp}/a").count() == 3
    with pytest.raises(ValueError):
        register_table(spark, "corrections", "t", f"{tmp}/b")
    spark.sql("DROP TABLE corrections.t")


def test_missing_fields_are_not_sent(spark):
    full = {"message_id": "1", "timestamp": "t", "recipient": "r", "subject": "s", "message": "m"}
    lines = [json.dumps({"body": json.dumps({k: v for k, v in full.items() if k != gone})}) for gone in (None, "recipient", "subject", "message")]
    got = rows(consume_rows(spark.createDataFrame([(x,) for x in lines], "value string")), "error")
    assert sorted(str(r[0]) for r in got) == ["None", "missing message", "missing recipient", "missing subject"]


def test_log_times_do_not_follow_the_session_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:01.250' AS ts, 'm' AS m")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert to_log_rows(df, "g", "s", "m", "ts").first().timestamp == 1704067201250
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def _change(name, v, number=None):
    image = {"id": {"S": "k"}, "v": {"N": str(v)}}
    d = {"Keys": {"id": {"S": "k"}}} | ({} if name == "REMOVE" else {"NewImage": image}) | ({"SequenceNumber": number} if number else {})
    return {"eventName": name, "dynamodb": d}


@pytest.mark.parametrize("files", [
    [["INSERT 1", "REMOVE 0", "INSERT 5"]],            # three messages of one file
    [["INSERT 1"], ["REMOVE 0"], ["INSERT 5"]],        # one message a file
    [["INSERT 1", "REMOVE 0"], ["INSERT 5"]],
])
def test_changes_apply_in_order(spark, tmp, files):
    os.makedirs(f"{tmp}/src")
    for n, messages in enumerate(files):
        p = f"{tmp}/src/{n}.json"
        with open(p, "w") as f:
            f.write("".join(json.dumps({"Records": [_change(*m.split())]}) + "\n" for m in messages))
        os.utime(p, (1_700_000_000 + n, 1_700_000_000 + n))
    apply_changes(spark, f"{tmp}/src", f"{tmp}/t", ["id"], {"id": "string", "v": "int"}, checkpoint=f"{tmp}/cp").awaitTermination()
    assert [(r.id, r.v) for r in read_table(spark, f"{tmp}/t").collect()] == [("k", 5)]


def test_changes_follow_sequence_numbers(spark, tmp):
    os.makedirs(f"{tmp}/src")
    with open(f"{tmp}/src/a.json", "w") as f:
        for m in (_change("INSERT", 5, "900"), _change("INSERT", 1, "100"), _change("REMOVE", 0, "200")):
            f.write(json.dumps({"Records": [m]}) + "\n")
    apply_changes(spark, f"{tmp}/src", f"{tmp}/t", ["id"], {"id": "string", "v": "int"}, checkpoint=f"{tmp}/cp").awaitTermination()
    assert [(r.id, r.v) for r in read_table(spark, f"{tmp}/t").collect()] == [("k", 5)]
