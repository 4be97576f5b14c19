import pandas as pd
import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidewater.operators import aggregate as A
from tidewater.operators import ml as M
from conftest import SF001


def _emb(spark):
    e = spark.read.parquet(f"{SF001}/embeddings.parquet")
    feats = [f"f{i}" for i in range(8)]
    return e.select("vec_id", "label", *[F.col("embedding")[i].alias(f) for i, f in enumerate(feats)]), feats


def test_split_repeatable_and_sized(spark):
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    tr, te = M.split(o, "o_orderkey", 0.2, 42)
    n, nt = o.count(), te.count()
    assert tr.count() + nt == n and abs(nt / n - 0.2) < 0.02
    assert sorted(r.o_orderkey for r in M.split(o.repartition(7), "o_orderkey", 0.2, 42)[1].collect()) == \
        sorted(r.o_orderkey for r in te.collect())
    a = [r.o_orderkey for r in M.shuffle(o, "o_orderkey", 1).limit(20).collect()]
    b = [r.o_orderkey for r in M.shuffle(o.repartition(3), "o_orderkey", 1).limit(20).collect()]
    assert a == b and a != sorted(a)


def test_forest_predict_evaluate_tune(spark):
    df, feats = _emb(spark)
    tr, te = M.split(df, "vec_id", 0.2)
    model = M.train_forest(tr, feats, "label", num_trees=20)
    pred = M.predict(model, te, keep=["label"])
    acc = M.accuracy(pred, "label").first().accuracy
    assert 0.0 <= acc <= 1.0 and len(pred.first().probability) == 10
    ev = A.evaluate(pred.withColumn("prediction", F.col("prediction").cast("int")), "label", "prediction").first()
    assert abs(ev.accuracy_pct - 100 * acc) < 1e-9
    best, trials = M.tune(tr, feats, "label", {"numTrees": [5, 10], "maxDepth": [2, 4], "minInstancesPerNode": [1, 2]},
                          max_trials=3, parallelism=2)
    assert len(trials) == 3 and best is not None


def test_other_learners(spark):
    df, feats = _emb(spark)
    binary = df.withColumn("label", (F.col("label") < 5).cast("int"))
    for fn in (M.train_linear, M.train_boosted, M.train_fm):
        m = fn(binary, feats, "label")
        assert M.predict(m, binary).count() == binary.count()
    reg = M.train_linear(df.withColumn("y", F.col("f0") * 2 + 1), feats[1:] + ["f0"], "y", kind="linear")
    assert M.predict(reg, df.withColumn("y", F.col("f0"))).count() == df.count()
    cl = M.cluster(df, feats, 4)
    assert cl.select("cluster").distinct().count() <= 4
    assert len(M.reduce(df, feats, 3).first().pcs) == 3


def test_pixels_topics_words(spark):
    rng = np.random.default_rng(0)
    rows = [(int(i % 2), (rng.random(784) * (0.2 + 0.6 * (i % 2))).astype(float).tolist()) for i in range(60)]
    px = spark.createDataFrame(rows, "label int, pixels array<double>")
    m = M.train_pixels(px, layers=(784, 16, 2), max_iter=30)
    pred = m.transform(px.withColumn("features", array_to_vector("pixels")))
    assert pred.filter(F.col("prediction") == F.col("label")).count() >= 45
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    t = M.topics(docs, "text", 3, vocab=500, max_iter=3)
    assert len(t.first().topic_mix) == 3
    wv = M.word_vectors(docs, "text", size=8)
    assert wv.count() > 10 and len(wv.first().vector) == 8


def test_drift_and_handler(spark):
    base = spark.range(2000).select((F.col("id") % 100).cast("double").alias("x"))
    same = spark.range(2000).select(((F.col("id") * 7) % 100).cast("double").alias("x"))
    shifted = spark.range(2000).select(((F.col("id") % 100) + 40).cast("double").alias("x"))
    assert M.drift(base, same, "x").first().psi < 0.05
    assert M.drift(base, shifted, "x").first().psi > 0.5

    def handler(pdf):
        if (pdf["id"] % 50 == 3).any():
            raise ValueError("boom")
        return pd.DataFrame({"id": pdf["id"], "double": pdf["id"] * 2, "error": (pdf["id"] == 7).map({True: "own", False: None})})
    out = M.apply_handler(spark.range(100), handler, "double long", keep=["id"])
    got = {r.id: (r.double, r.error) for r in out.collect()}
    assert len(got) == 100 and [i for i, (_, e) in got.items() if e] == [3, 7, 53] and "boom" in got[3][1] and got[7] == (14, "own")
    assert all(v == (2 * i, None) for i, v in got.items() if i not in (3, 7, 53))
    assert got[3][0] is None


def test_handler_is_called_on_batches_and_halves(spark):
    """100 records with one at fault in one batch: about 2 log2(100) calls, not 100."""
    import numpy as np
    count = spark.sparkContext.accumulator(0)

    def handler(pdf):
        count.add(1)
        if (pdf["id"] == 42).any():
            raise KeyError("42")
        return pd.DataFrame({"x": np.ones(len(pdf))})
    out = M.apply_handler(spark.range(100).coalesce(1), handler, "x double", keep=["id"])
    assert [r.id for r in out.filter("error is not null").collect()] == [42] and count.value <= 16
    short = M.apply_handler(spark.range(4), lambda pdf: pdf.head(0), "x double")
    assert all("rows for 1" in r.error for r in short.collect())


def test_drift_by_width_and_by_sketches(spark):
    base = spark.range(20_000).select((F.col("id") % 1000).cast("double").alias("x"), (F.col("id") % 4).alias("part"))
    odd = base.unionByName(spark.createDataFrame([(None, 0), (float("nan"), 1)] * 50, "x double, part long"))
    shifted = base.withColumn("x", F.col("x") + 300)
    for method in ("width", "quantile"):
        assert M.drift(base, base, "x", edges=method).first().psi == 0
        assert M.drift(odd, odd, "x", edges=method).first().psi == 0
        assert M.drift(base, shifted, "x", edges=method).first().psi > 0.5
    a, b = (M.value_sketches(d, "x", by=["part"]) for d in (odd, shifted))
    assert a.count() == 4 and a.agg(F.sum("missing")).first()[0] == 100
    exact = M.drift(odd, shifted, "x").first().psi
    assert abs(M.sketch_drift(a, b).first().psi - exact) < 0.05 * exact
    assert M.sketch_drift(a, M.value_sketches(base, "x")).first().psi < 0.1  # only the missing rows differ
    # stated rank error of the merged sketch
    one = a.agg(F.kll_merge_agg_double("sketch").alias("s")).select(F.kll_sketch_get_rank_double("s", F.lit(499.0))).first()[0]
    assert abs(one - 0.5) < 0.01


def test_batch_predict_files(spark, tmp):
    df, feats = _emb(spark)
    model = M.train_forest(df, feats, "label", num_trees=5)
    src = tmp + "/in"
    df.limit(30).write.option("header", True).csv(src)
    schema = "vec_id long, label int, " + ", ".join(f"{f} double" for f in feats)
    M.batch_predict(spark, model, src, "csv", tmp + "/out_csv", "csv", schema=schema, keep=["vec_id"])
    M.batch_predict(spark, model, src, "csv", tmp + "/out_json", "json", schema=schema, keep=["vec_id"])
    got = spark.read.option("header", True).csv(tmp + "/out_csv")
    assert got.count() == 30 and set(got.columns) == {"vec_id", "prediction", "probability", "error"}
    assert len(spark.read.json(tmp + "/out_json").first().probability) == 10


def test_topics_keep_every_word(spark):
    from tidewater.operators import ml
    words = " ".join(f"w{i:05d}" for i in range(5000))
    df = spark.createDataFrame([(1, f"{words} {words}"), (2, "rare")], "id int, text string")
    mix = {r.id: r.topic_mix for r in ml.topics(df, "text", 2, max_iter=1).collect()}
    assert abs(sum(mix[2]) - 1) < 1e-6


def test_forest_is_the_same_from_any_layout(spark):
    df, feats = _emb(spark)
    trees = {M.train_forest(d, feats, "label", num_trees=5).stages[-1].toDebugString.split("\n", 1)[1]
             for d in (df, df.repartition(3), df.coalesce(1).orderBy(F.desc("vec_id")), df.repartition(9, "label"))}
    assert len(trees) == 1


def test_vocabulary_bound_of_word_vectors(spark):
    df = spark.createDataFrame([("aa aa aa bb bb cc dd ee",), (None,), ("AA bb",)], "text string")
    assert {r.word: r.n for r in M.word_counts(df, "text").collect()} == {"aa": 4, "bb": 3, "cc": 1, "dd": 1, "ee": 1}
    known = df.where("text is not null")
    assert {r.word for r in M.word_vectors(known, "text", size=2).collect()} == {"aa", "bb", "cc", "dd", "ee"}
    assert {r.word for r in M.word_vectors(known, "text", size=2, max_words=4).collect()} == {"aa", "bb"}
