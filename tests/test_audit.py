import json

from pyspark.sql import functions as F

from tidewater.operators import audit as AU
from tidewater.operators import joins as J
from conftest import rows


def test_users_roles_mfa_groups(spark):
    users = spark.createDataFrame([("ali",), ("ayse",), ("can",)], "UserName string")
    prof = spark.createDataFrame([("ali",)], "UserName string")
    keys = spark.createDataFrame([("ali", "K2"), ("ali", "K1"), ("can", "K3")], "UserName string, AccessKeyId string")
    e = {r.UserName: r for r in AU.enrich_users(users, prof, keys).collect()}
    assert e["ali"].has_console and e["ali"].access_keys == ["K1", "K2"] and e["ali"].n_keys == 2
    assert not e["ayse"].has_console and e["ayse"].access_keys == [] and e["ayse"].n_keys == 0
    roles = spark.createDataFrame([("r1",), ("r2",)], "RoleName string")
    pol = spark.createDataFrame([("r1", "P", "arn:p")], "RoleName string, PolicyName string, PolicyArn string")
    er = {r.RoleName: r.policies for r in AU.enrich_roles(roles, pol).collect()}
    assert len(er["r1"]) == 1 and er["r2"] == []
    dev = spark.createDataFrame([("ayse",), ("ayse",)], "UserName string")
    assert rows(AU.with_mfa(users, dev)) == [("ayse",)]
    assert rows(AU.without_mfa(users, dev)) == [("ali",), ("can",)]
    mem = spark.createDataFrame([("ali", "dev"), ("can", "ops")], "UserName string, GroupName string")
    gp = spark.createDataFrame([("dev", "Read"), ("dev", "Write")], "GroupName string, PolicyName string")
    via = AU.group_policies(mem, gp)
    assert rows(via) == [("ali", "Read", "dev"), ("ali", "Write", "dev")]
    direct = spark.createDataFrame([("ali", "Read")], "UserName string, PolicyName string")
    perms = AU.user_permissions(direct, via)
    assert rows(perms, "UserName", "PolicyName", "origin", "total") == [
        ("ali", "Read", "direct", 3), ("ali", "Read", "group", 3), ("ali", "Write", "group", 3)]


REPORT = """user,arn,mfa_active,password_enabled,password_last_used,access_key_1_active,access_key_2_active
<root_account>,arn:root,false,not_supported,2020-01-01T00:00:00+00:00,true,true
u90,arn:1,true,true,2023-10-03T00:00:00+00:00,false,false
u91,arn:2,TRUE,true,2023-10-02T00:00:00+00:00,false,false
una,arn:3,false,true,N/A,true,true
"""


def test_credential_findings(spark):
    doc = spark.createDataFrame([(REPORT,)], "content string")
    rep = AU.explode_csv_text(doc, "content", "user string, arn string, mfa_active string, password_enabled string, "
                                              "password_last_used string, access_key_1_active string, access_key_2_active string")
    assert rep.count() == 4
    f = rows(AU.credential_findings(rep, as_of="2024-01-01 00:00:00"))
    assert sorted(f, key=repr) == sorted([("u91", "password_stale", 91), ("una", "mfa_inactive", None), ("una", "active_keys", 2)], key=repr)
    assert rows(AU.active_keys(rep)) == [("una", 2)]


def test_trust_principals_list_scalar_star(spark):
    docs = [
        ("r1", {"Statement": [{"Principal": {"Service": ["a", "b", "c", "d"]}}]}),
        ("r2", {"Statement": {"Principal": {"AWS": "arn:x"}}}),
        ("r3", {"Statement": [{"Principal": "*"}]}),
    ]
    df = spark.createDataFrame([(r, json.dumps(d)) for r, d in docs], "RoleName string, trust_policy string")
    got = rows(AU.trust_principals(df), "RoleName", "type", "shown")
    assert got == [("r1", "Service", "a, b, c"), ("r2", "AWS", "arn:x")]


def test_wildcard_statements(spark):
    docs = [("p1", {"Statement": [{"Effect": "Allow", "Action": "*"}, {"Effect": "Allow", "Action": ["s3:Get"]}]}),
            ("p2", {"Statement": {"Effect": "Allow", "Action": ["ec2:Describe", "*"]}}),
            ("p3", {"Statement": [{"Effect": "Deny", "Action": "*"}]})]
    df = spark.createDataFrame([(n, json.dumps(d)) for n, d in docs], "PolicyName string, document string")
    assert rows(AU.wildcard_statements(df), "PolicyName", "statement_no") == [("p1", 0), ("p2", 0)]


def test_cost_rollup_worked_example(spark):
    usage = spark.createDataFrame([("in", 1000.0, "m"), ("out", 500.0, "m")], "item string, quantity double, month string")
    prices = spark.createDataFrame([("in", 1000.0, 0.003), ("out", 1000.0, 0.015)], "item string, unit double, price double")
    c = J.cost_rollup(usage, prices, "item", "quantity", "price", by=["month"], unit_col="unit").first()
    assert abs(c.cost - 0.0105) < 1e-12
    vers = spark.createDataFrame([("k", "v1")], "key string, version string")
    marks = spark.createDataFrame([("k", "v2")], "key string, version string")
    assert rows(J.object_versions(vers, marks)) == [("k", "v1", False), ("k", "v2", True)]


def test_role_policy_chunks(spark):
    roles = spark.createDataFrame([("r1",), ("r2",)], "RoleName string")
    pol = spark.createDataFrame([("r1", f"p{i:03d}", str(i)) for i in range(25)], "RoleName string, PolicyName string, PolicyArn string")
    got = AU.role_policy_chunks(roles, pol, chunk=10).orderBy("RoleName", "chunk").collect()
    assert [(r.RoleName, r.chunk, r.n_policies, len(r.policies)) for r in got] == [("r1", 0, 10, 10), ("r1", 1, 10, 10), ("r1", 2, 5, 5), ("r2", 0, 0, 0)]
    assert [p.PolicyName for r in got[:3] for p in r.policies] == [f"p{i:03d}" for i in range(25)]


def test_csv_text_fields_and_odd_lines(spark):
    text = '\n a,b,c\r\n1,"x, ""y"" z",3\n,,\n"",q"r,"s"t\n4\n\n5,6,7,8\n\n  '
    got = AU.explode_csv_text(spark.createDataFrame([(9, text), (10, None), (11, ""), (12, "a,b,c")], "id int, t string"), "t", "c string, a string, b string, d string")
    assert rows(got) == rows(spark.createDataFrame([(9, "3", "1", 'x, "y" z', None), (9, None, None, None, None), (9, '"s"t', None, 'q"r', None),
                                                    (9, None, "4", None, None), (9, "7", "5", "6", None)], "id int, c string, a string, b string, d string"))


def test_csv_text_is_linear_in_its_lines(spark):
    """A text of 20,000 lines: nothing but its lines leaves the explode."""
    import time
    text = "user,n\n" + "\n".join(f'u{i},"{i}"' for i in range(20_000))
    df = spark.createDataFrame([(text,)], "t string")
    start = time.time()
    got = AU.explode_csv_text(df, "t", "user string, n int").agg(F.count("user"), F.sum("n")).first()
    assert tuple(got) == (20_000, sum(range(20_000))) and time.time() - start < 20
