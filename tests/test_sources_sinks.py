import json
import os

from pyspark.sql import functions as F

from tidewater.operators import aggregate as A
from tidewater.operators import shape as P
from tidewater.sinks import to_log_rows, to_metrics, write_json_docs, write_metadata, write_parquet
from tidewater.sources import (
    convert, object_inventory, read_csv, read_json, read_json_folder, read_pixels, read_xml, register_table,
)
from conftest import rows

# Eight employees in the reference sample's shape (values invented):
# IT 3, HR 2, Finance 1, Sales 1, Marketing 1; age <30: 5, 30-39: 3;
# salary <70000: 2, 70000-79999: 3, rest: 3; three big cities: 6.
EMPLOYEES = [
    (1, "Zeynep Şahin", 26, "İstanbul", 65000, "IT", "2021-03-15"),
    (2, "Emre Güneş", 31, "Ankara", 72000, "HR", "2019-07-01"),
    (3, "Ayşe Çelik", 24, "İzmir", 68000, "IT", "2022-01-10"),
    (4, "Murat Öztürk", 35, "Bursa", 85000, "Finance", "2017-11-20"),
    (5, "Elif Doğan", 28, "İstanbul", 75000, "Sales", "2020-05-05"),
    (6, "Burak Kılıç", 38, "Antalya", 90000, "IT", "2016-02-29"),
    (7, "Selin Aydın", 27, "Ankara", 78000, "Marketing", "2021-09-30"),
    (8, "Kerem Yıldız", 29, "İstanbul", 82000, "HR", "2020-12-01"),
]
HEADER = "id,name,age,city,salary,department,hire_date"


def _csv(tmp):
    p = os.path.join(tmp, "emp.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write(HEADER + "\n" + "\n".join(",".join(str(x) for x in r) for r in EMPLOYEES) + "\n")
    return p


def _etl(df):
    df = P.cast_columns(df, {"id": "int", "age": "int", "salary": "double", "hire_date": ("date", "yyyy-MM-dd")})
    df = P.bucket(df, "age", [(30, "Genç"), (40, "Orta Yaş")], "Deneyimli", "age_group")
    df = P.bucket(df, "salary", [(70000, "Düşük"), (80000, "Orta")], "Yüksek", "salary_category")
    df = P.label_in(df, "city", ["İstanbul", "Ankara", "İzmir"], "Büyük Şehir", "Diğer", "city_category")
    return P.stamp(df, "processing_date", "date", as_of="2024-01-01")


def test_csv_etl_fixture_counts(spark, tmp):
    df = _etl(read_csv(spark, _csv(tmp)))
    assert df.count() == 8
    assert dict(rows(A.count_by(df, "department"))) == {"IT": 3, "HR": 2, "Finance": 1, "Sales": 1, "Marketing": 1}
    assert dict(rows(A.count_by(df, "age_group"))) == {"Genç": 5, "Orta Yaş": 3}
    assert dict(rows(A.count_by(df, "salary_category"))) == {"Düşük": 2, "Orta": 3, "Yüksek": 3}
    assert dict(rows(A.count_by(df, "city_category"))) == {"Büyük Şehir": 6, "Diğer": 2}
    out = os.path.join(tmp, "out")
    write_parquet(df, out)
    assert spark.read.parquet(out).count() == 8


def test_json_array_multiline_and_edge_rows(spark, tmp):
    recs = [dict(zip(HEADER.split(","), r)) for r in EMPLOYEES]
    recs.append({"id": "bad", "name": "X", "age": None, "city": "Van", "salary": "n/a", "department": "IT",
                 "hire_date": "31-12-2020"})
    p = os.path.join(tmp, "emp.json")
    with open(p, "w") as f:
        json.dump(recs, f, indent=2, ensure_ascii=False)
    df = _etl(read_json(spark, p))
    assert df.count() == 9
    bad = df.filter(F.col("name") == "X").first()
    assert (bad.id, bad.age, bad.salary, bad.hire_date, bad.age_group) == (None, None, None, None, "Deneyimli")
    t = P.tenure(df, "hire_date", "salary", as_of="2024-01-01").filter("id = 1").first()
    assert abs(t.experience_years - 1022 / 365) < 1e-12


def test_json_folder_good_and_bad(spark, tmp):
    d = os.path.join(tmp, "meta")
    os.makedirs(os.path.join(d, "sub"))
    json.dump({"pdf_name": "a.pdf", "slide_count": 3, "create_date": "2024-01-01T00:00:00Z"}, open(os.path.join(d, "a.json"), "w"))
    json.dump({"pdf_name": "b.pdf"}, open(os.path.join(d, "sub", "b.json"), "w"))
    open(os.path.join(d, "broken.json"), "w").write("{not json")
    open(os.path.join(d, "note.txt"), "w").write("ignore me")
    good, bad = read_json_folder(spark, d, "pdf_name string, slide_count int, create_date string")
    assert rows(good, "pdf_name", "slide_count") == [("a.pdf", 3), ("b.pdf", None)]
    assert [r.file_path.endswith("broken.json") for r in bad.collect()] == [True]
    totals = A.document_totals(good, "slide_count", "create_date").first()
    assert (totals.n_documents, totals.total_count) == (2, 3)


def test_inventory_catalog_xml_convert(spark, tmp):
    root = os.path.join(tmp, "bucket")
    os.makedirs(os.path.join(root, "uploads"))
    open(os.path.join(root, "uploads", "x.txt"), "w").write("hello")
    open(os.path.join(root, "top.bin"), "w").write("12")
    inv = object_inventory(spark, root, prefix="uploads/")
    assert rows(inv, "key", "size") == [("uploads/x.txt", 5)]
    pq = os.path.join(tmp, "pq")
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string").write.partitionBy("v").parquet(pq)
    t = register_table(spark, "lake_test", "things", pq, partitioned=True)
    assert t.count() == 2 and spark.catalog.tableExists("lake_test.things")
    xml = os.path.join(tmp, "x.xml")
    open(xml, "w").write("<rows><row><id>1</id><n>a</n></row><row><id>2</id><n>b</n></row></rows>")
    assert rows(read_xml(spark, xml, "row", "id int, n string")) == [(1, "a"), (2, "b")]
    convert(spark, pq, "parquet", os.path.join(tmp, "csv"), "csv", write_options={"header": "true"})
    assert spark.read.option("header", True).csv(os.path.join(tmp, "csv")).count() == 2


def test_sinks(spark, tmp):
    df = spark.createDataFrame([("c1", "2024-01-01 00:00:00", 3.0, "q1")], "id string, ts string, v double, queue string") \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    write_json_docs(df, os.path.join(tmp, "docs"), "id")
    assert os.path.isdir(os.path.join(tmp, "docs", "id=c1"))
    m = to_metrics(df, "App", "Depth", "v", "ts", dims={"Queue": "queue"}).first()
    assert (m.namespace, m.metric_name, m.value, m.unit, m.dimensions) == ("App", "Depth", 3.0, "Count", {"Queue": "q1"})
    lg = to_log_rows(df, "/app", "s1", "id", "ts", source="test").first()
    assert lg.timestamp == 1704067200000 and json.loads(lg.message) == {
        "timestamp": "2024-01-01T00:00:00.000000", "message": "c1", "source": "test"}
    write_metadata(spark.createDataFrame([(0.9,)], "accuracy double"), os.path.join(tmp, "meta"))
    assert spark.read.json(os.path.join(tmp, "meta")).first().accuracy == 0.9


def test_pixels(spark, tmp):
    p = os.path.join(tmp, "px")
    spark.createDataFrame([(1, [255.0] * 784), (2, [0.0] * 10)], "label int, pixels array<float>").write.parquet(p)
    got = {r.label: r for r in read_pixels(spark, p).collect()}
    assert got[1].valid and abs(got[1].pixels[0] - 1.0) < 1e-6 and not got[2].valid


def test_inventory_lists_only_what_begins_with_the_prefix(spark, tmp):
    for f in ("logs/2024/a.txt", "logs/2024/sub/b.txt", "logs/2025/c.txt", "lo[g/d.txt", "other/e.txt", "log.txt"):
        os.makedirs(os.path.dirname(os.path.join(tmp, f)), exist_ok=True)
        open(os.path.join(tmp, f), "w").write("x")
    keys = lambda p: sorted(r.key for r in object_inventory(spark, tmp, p).collect())
    assert keys("logs/2024") == ["logs/2024/a.txt", "logs/2024/sub/b.txt"]
    assert keys("log") == ["log.txt", "logs/2024/a.txt", "logs/2024/sub/b.txt", "logs/2025/c.txt"]
    assert keys("lo[") == ["lo[g/d.txt"] and keys("nothing") == [] and len(keys("")) == 6
    listed = object_inventory(spark, tmp, "logs/2025").inputFiles()
    assert len(listed) == 1 and listed[0].endswith("logs/2025/c.txt")
