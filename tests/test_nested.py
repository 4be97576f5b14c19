import decimal
import json

from pyspark.sql import functions as F

from tidewater.operators import nested as N
from conftest import rows


def test_classify_events(spark):
    ev = [
        ({"httpMethod": "GET", "path": "/"}, "api_gateway"),
        ({"Records": [{"s3": {"bucket": {"name": "b"}}}]}, "s3"),
        ({"Records": [{"eventName": "INSERT", "dynamodb": {"NewImage": {}}}]}, "dynamodb"),
        ({"source": "aws.events", "detail-type": "Scheduled Event"}, "scheduled"),
        ({"Records": []}, "generic"),
        ({"Records": [{"eventSource": "aws:sqs"}]}, "generic"),
        ({"source": "other"}, "generic"),
    ]
    df = spark.createDataFrame([(json.dumps(e), k) for e, k in ev] + [("not json", "generic")], "b string, want string")
    out = N.classify_events(df, "b")
    assert all(r.kind == r.want for r in out.collect())


def test_explode_records_decodes_keys(spark):
    body = {"Records": [
        {"eventName": "ObjectCreated:Put", "s3": {"bucket": {"name": "bk"}, "object": {"key": "a+b%20c.txt", "size": 5}}},
        {"eventName": "ObjectCreated:Put", "s3": {"bucket": {"name": "bk"}, "object": {"key": "bad%zzkey", "size": 1}}},
    ]}
    df = spark.createDataFrame([(1, json.dumps(body))], "id int, body string")
    got = rows(N.explode_records(df, "body", keep=["id"]), "id", "bucket", "key", "size")
    assert sorted(got, key=repr) == sorted([(1, "bk", "a b c.txt", 5), (1, "bk", None, 1)], key=repr)


def test_flatten_instances_defaults(spark):
    t = ("Reservations array<struct<Instances: array<struct<InstanceId: string, InstanceType: string, "
         "State: struct<Name: string>, PublicIpAddress: string, Placement: struct<AvailabilityZone: string>, "
         "LaunchTime: string, Tags: array<struct<Key: string, Value: string>>>>>>")
    data = [([([("i-1", "t3", ("running",), None, ("eu-1a",), "2024-01-01", [("Team", "x"), ("Name", "web"), ("Name", "dup")]),
                ("i-2", None, None, None, None, None, None)],), ([],)],)]
    out = {r.instance_id: r for r in N.flatten_instances(spark.createDataFrame(data, t)).collect()}
    assert (out["i-1"].name, out["i-1"].zone, out["i-1"].public_ip) == ("web", "eu-1a", "N/A")
    assert (out["i-2"].name, out["i-2"].state, out["i-2"].instance_type) == ("N/A", "N/A", "N/A")


def test_describe_tables_and_decode(spark):
    names = spark.createDataFrame([("t1",), ("t2",)], "table_name string")
    facts = spark.createDataFrame([("t1", 10)], "table_name string, items bigint")
    assert rows(N.describe_tables(names, facts)) == [("t1", 10, None), ("t2", None, "not found")]
    img = spark.createDataFrame([('{"id": {"S": "u1"}, "age": {"N": "31"}, "bad": {"N": "x"}}',)], "img string")
    d = N.decode_attributes(img, "img", {"id": "string", "age": "int", "bad": "double"}).first()
    assert (d.id, d.age, d.bad) == ("u1", 31, None)


def test_sections_title_fallback(spark):
    text = "  Title one \n body a\n\n\n\n   \nSecond\n\n  \n next  "
    df = spark.createDataFrame([(1, text)], "id int, text string")
    got = rows(N.sections(df, "text", ["id"]), "section_no", "title", "body")
    # section 2 is blank, 3 and 4 start with a blank line: no title, so "Section n"
    assert got == [(1, "Title one", "Title one\nbody a"), (2, "Section 2", ""), (3, "Section 3", "Second"), (4, "Section 4", "next")]
    lines = rows(N.sections(df, "text", ["id"], sep="\n"), "section_no", "title")
    assert [t for _, t in lines] == ["Title one", "body a", *[f"Section {n}" for n in (3, 4, 5, 6)], "Second", "Section 8", "Section 9", "next"]


def test_join_list_and_as_json(spark):
    df = spark.createDataFrame([(["a", "b"],), (None,)], "l array<string>")
    assert rows(N.join_list(df, "l", ", ", "t", missing="N/A"), "t") == [("N/A",), ("a, b",)]
    d = spark.createDataFrame([("k", decimal.Decimal("21.5000000000"))], "id string, t decimal(38,10)")
    assert N.as_json(d, ["id", "t"]).first().json == '{"id":"k","t":21.5}'


def test_assemble_chunks_and_blocks(spark):
    chunks = [("r1", 2, {"type": "content_block_delta", "delta": {"text": "lo"}}),
              ("r1", 0, {"type": "message_start"}),
              ("r1", 1, {"type": "content_block_delta", "delta": {"text": "hel"}}),
              ("r1", 3, {"type": "message_stop"})]
    df = spark.createDataFrame([(a, b, json.dumps(c)) for a, b, c in chunks], "id string, seq int, body string")
    assert rows(N.assemble_chunks(df, "id", "seq", "body")) == [("r1", "hello")]
    big = spark.range(0, 1000).select(F.lit("k").alias("k"), F.col("id").alias("seq"),
                                      F.col("id").cast("string").alias("t"))
    one = N.ordered_concat(big, ["k"], "seq", "t", sep=",", block=7).first()
    assert one.text == ",".join(str(i) for i in range(1000)) and one.n_parts == 1000


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 60), st.text("xyz", max_size=3)),
                min_size=1, max_size=40, unique_by=lambda t: (t[0], t[1])),
       st.integers(1, 16))
def test_ordered_concat_matches_python(spark, pieces, block):
    df = spark.createDataFrame(pieces, "k string, seq int, t string")
    got = {r.k: (r.text, r.n_parts) for r in N.ordered_concat(df, ["k"], "seq", "t", sep="|", block=block).collect()}
    want = {}
    for k in {p[0] for p in pieces}:
        mine = sorted((s, t) for kk, s, t in pieces if kk == k)
        want[k] = ("|".join(t for _, t in mine), len(mine))
    assert got == want
