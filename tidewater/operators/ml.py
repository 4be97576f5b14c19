"""Machine learning on Spark ML (M1-M16) plus drift (M7).

Splits and shuffles are hash-based on a row id and a seed, so they are
repeatable on any partitioning (``randomSplit`` depends on partition
layout). Training uses Spark ML estimators; nothing is collected to the
driver except model parameters.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    FMClassifier, GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier,
)
from pyspark.ml.clustering import LDA, KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, CountVectorizer, HashingTF, RegexTokenizer, VectorAssembler, Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tidewater.session import ship_by_value, spread

ship_by_value(__name__)


def hash_number(id_col: str, seed: int, method: str = "xxhash64") -> Column:
    """A number per (id, seed) that other engines can give too (``"md5"``: the first 32 bits of md5 of ``id:seed``) or a faster one of Spark's."""
    if method == "xxhash64":
        return F.xxhash64(F.col(id_col), F.lit(int(seed)))
    if method != "md5":
        raise ValueError("method must be 'xxhash64' or 'md5'")
    text = F.concat(F.col(id_col).cast("string"), F.lit(f":{int(seed)}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def split(df: DataFrame, id_col: str, test: float = 0.2, seed: int = 42, method: str = "xxhash64") -> tuple[DataFrame, DataFrame]:
    """M1. Repeatable train/test split by a hash of (id, seed), see ``hash_number``."""
    b = F.pmod(hash_number(id_col, seed, method), F.lit(10_000))
    cut = int(round(test * 10_000))
    return df.filter(b >= cut), df.filter(b < cut)


def shuffle(df: DataFrame, id_col: str, seed: int = 42, method: str = "xxhash64") -> DataFrame:
    """M6. Seeded, repeatable row order (range-partitioned sort on a hash)."""
    return df.orderBy(hash_number(id_col, seed, method), F.col(id_col))


def _assembler(features: Sequence[str]) -> VectorAssembler:
    """Training on a missing value is an error (impute or filter first): no
    row leaves without notice. Prediction keeps such rows, see ``predict``."""
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


LAYOUT_ROWS = 100_000  # rows of a partition of a forest's training data


def _featurize(df: DataFrame, features: Sequence[str] | str) -> tuple[DataFrame, list]:
    """Forest training input in a fixed layout: bags are drawn by partition
    and place in it, so rows are dealt over a number of partitions that follows from
    their number (``LAYOUT_ROWS`` each, 8 at least) and sorted there by
    a hash of their values. The same rows and seed give the same forest on any
    cluster and from any files. ``features`` is a
    list of numeric columns (assembled in the pipeline) or one array column."""
    parts = max(8, df.count() // LAYOUT_ROWS)
    df = df.withColumn("_tw_h", F.xxhash64(*df.columns)).repartition(parts, "_tw_h").sortWithinPartitions("_tw_h").drop("_tw_h")
    if isinstance(features, str):
        return df.withColumn("features", array_to_vector(F.col(features))), []
    return df, [_assembler(features)]


def train_forest(df: DataFrame, features: Sequence[str] | str, label: str, num_trees: int = 100,
                 seed: int = 42, max_depth: int = 5) -> PipelineModel:
    """M2. Random forest (100 trees, seed 42) on numeric feature columns or
    one array column."""
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=num_trees, seed=seed,
                                maxDepth=max_depth)
    d, stages = _featurize(df, features)
    return Pipeline(stages=[*stages, rf]).fit(d)


def train_linear(df: DataFrame, features: Sequence[str] | str, label: str, kind: str = "logistic",
                 max_iter: int = 100) -> PipelineModel:
    """M8. Logistic (classification) or linear (regression) learner."""
    est = (LogisticRegression(labelCol=label, maxIter=max_iter) if kind == "logistic"
           else LinearRegression(labelCol=label, maxIter=max_iter))
    if isinstance(features, str):
        return Pipeline(stages=[est]).fit(df.withColumn("features", array_to_vector(F.col(features))))
    return Pipeline(stages=[_assembler(features), est]).fit(df)


def train_boosted(df: DataFrame, features: Sequence[str], label: str, max_iter: int = 20,
                  seed: int = 42) -> PipelineModel:
    """M9. Gradient-boosted trees (binary labels)."""
    gbt = GBTClassifier(labelCol=label, maxIter=max_iter, seed=seed)
    return Pipeline(stages=[_assembler(features), gbt]).fit(df)


def train_fm(df: DataFrame, features: Sequence[str], label: str, factor_size: int = 8,
             seed: int = 42) -> PipelineModel:
    """M11. Factorisation machine classifier."""
    fm = FMClassifier(labelCol=label, factorSize=factor_size, seed=seed)
    return Pipeline(stages=[_assembler(features), fm]).fit(df)


def predict(model: PipelineModel, df: DataFrame, keep: Sequence[str] = (),
            features: str | None = None) -> DataFrame:
    """M3. Batch prediction; probability as a plain array (JSON/CSV friendly).
    ``features`` names an array column when the model was trained on one.
    Every row comes back: one with a missing feature has no prediction and
    says so in ``error``."""
    if features is not None:
        # a vector must exist for the model to run; the result is masked below
        blank = F.array_repeat(F.lit(0.0), int(model.stages[-1].numFeatures))
        fine = F.coalesce(F.forall(features, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))), F.lit(False))
        df = df.withColumn("features", array_to_vector(F.when(fine, F.col(features).cast("array<double>")).otherwise(blank)))
    else:
        fine, model = F.lit(True), model.copy()  # the caller's stages stay as they are
        for st in model.stages:
            if isinstance(st, VectorAssembler):
                st.setHandleInvalid("keep")
                for c in st.getInputCols():
                    fine = fine & F.col(c).isNotNull() & ~F.isnan(F.coalesce(F.col(c).cast("double"), F.lit(0.0)))
    out = model.transform(df.withColumn("_tw_fine", fine))
    cols = [*keep, F.when(F.col("_tw_fine"), F.col("prediction")).alias("prediction")]
    if "probability" in out.columns:
        cols.append(F.when(F.col("_tw_fine"), vector_to_array("probability")).alias("probability"))
    return out.select(*cols, F.when(~F.col("_tw_fine"), F.lit("missing feature")).alias("error"))


def batch_predict(spark, model: PipelineModel, src: str, src_fmt: str, dst: str, dst_fmt: str,
                  schema: str | None = None, keep: Sequence[str] = (), features: str | None = None) -> None:
    """M3. Files in, predictions out: JSON or CSV (header) on both sides.
    CSV cannot hold arrays, so probabilities are written as JSON text there."""
    r = spark.read.format(src_fmt)
    if src_fmt == "csv":
        r = r.option("header", True)
    if src_fmt == "json":
        r = r.option("multiLine", True)
    if schema:
        r = r.schema(schema)
    out = predict(model, r.load(src), keep, features)
    if dst_fmt == "csv" and "probability" in out.columns:
        out = out.withColumn("probability", F.to_json("probability"))
    w = out.write.mode("overwrite").format(dst_fmt)
    if dst_fmt == "csv":
        w = w.option("header", True)
    w.save(dst)


def accuracy(pred: DataFrame, label: str) -> DataFrame:
    """Share of correct predictions (one-row frame)."""
    return pred.agg(F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("accuracy"),
                    F.count(F.lit(1)).alias("n"))


def tune(df: DataFrame, features: Sequence[str], label: str, grid: Mapping[str, Sequence],
         max_trials: int = 10, parallelism: int = 2, seed: int = 42,
         train_ratio: float = 0.8) -> tuple[PipelineModel, list[tuple[dict, float]]]:
    """M4. Random-forest tuning: at most ``max_trials`` grid points (sampled
    with ``seed``), ``parallelism`` models trained at once, best accuracy.
    Grid keys are RandomForestClassifier params (``numTrees``, ``maxDepth``,
    ``minInstancesPerNode`` for the reference's min_samples_split)."""
    rf = RandomForestClassifier(labelCol=label, seed=seed)
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(rf.getParam(name), list(values))
    maps = b.build()
    if len(maps) > max_trials:
        maps = random.Random(seed).sample(maps, max_trials)
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    tvs = TrainValidationSplit(estimator=Pipeline(stages=[_assembler(features), rf]),
                               estimatorParamMaps=maps, evaluator=ev, trainRatio=train_ratio,
                               parallelism=parallelism, seed=seed)
    m = tvs.fit(df)
    trials = [({p.name: v for p, v in pm.items()}, float(s)) for pm, s in zip(maps, m.validationMetrics)]
    return m.bestModel, trials


def train_pixels(df: DataFrame, label: str = "label", pixels: str = "pixels",
                 layers: Sequence[int] = (784, 128, 10), block_size: int = 128, max_iter: int = 50,
                 seed: int = 42) -> PipelineModel:
    """M5. Dense 784-128-10 network on pixel arrays (Spark ML has no
    convolution; the multilayer perceptron is the closest built-in)."""
    d = df.withColumn("features", array_to_vector(F.col(pixels)))
    mlp = MultilayerPerceptronClassifier(labelCol=label, featuresCol="features", layers=list(layers),
                                         blockSize=block_size, maxIter=max_iter, seed=seed)
    return Pipeline(stages=[mlp]).fit(d)


def cluster(df: DataFrame, features: Sequence[str] | str, k: int, seed: int = 42) -> DataFrame:
    """M12. k-means cluster id per row (``features``: columns or an array column)."""
    d = (df.withColumn("features", array_to_vector(F.col(features))) if isinstance(features, str)
         else _assembler(features).transform(df))
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(d)
    return model.transform(d).drop("features")


def reduce(df: DataFrame, features: Sequence[str] | str, k: int) -> DataFrame:
    """M13. First ``k`` principal components as an array column ``pcs``."""
    d = (df.withColumn("features", array_to_vector(F.col(features))) if isinstance(features, str)
         else _assembler(features).transform(df))
    model = PCA(k=k, inputCol="features", outputCol="_pcs").fit(d)
    return model.transform(d).withColumn("pcs", vector_to_array("_pcs")).drop("features", "_pcs")


def topics(df: DataFrame, text_col: str, k: int, vocab: int | None = None, max_iter: int = 10,
           seed: int = 42, features: int = 1 << 18) -> DataFrame:
    """M14. LDA topic mixture per document (``topic_mix`` array), over all
    words of two letters or more.

    Words are hashed to ``features`` counters, so every word counts and the driver holds
    ``features * k`` numbers however large the vocabulary is. With ``vocab`` the
    most frequent words are counted by name instead (that many words on the driver).
    """
    tok = RegexTokenizer(inputCol=text_col, outputCol="_tok", pattern=r"\W+", minTokenLength=2)
    tf = (HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=features) if vocab is None
          else CountVectorizer(inputCol="_tok", outputCol="_tf", vocabSize=vocab))
    lda = LDA(k=k, maxIter=max_iter, seed=seed, featuresCol="_tf", topicDistributionCol="_mix")
    model = Pipeline(stages=[tok, tf, lda]).fit(df)
    return model.transform(df).withColumn("topic_mix", vector_to_array("_mix")).drop("_tok", "_tf", "_mix")


def word_counts(df: DataFrame, text_col: str, min_length: int = 2) -> DataFrame:
    """All words (lower case, ``min_length`` letters or more) with their number of occurrences."""
    words = F.explode(F.split(F.lower(F.col(text_col)), r"\W+")).alias("word")
    return df.select(words).where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_vectors(df: DataFrame, text_col: str, size: int = 50, seed: int = 42, min_count: int = 1, max_words: int = 1_000_000) -> DataFrame:
    """M15. Word2Vec embeddings: one row per vocabulary word, words seen once
    too (``min_count`` leaves rarer ones out).

    The learner holds its vocabulary and two vectors a word on the driver, so words are
    counted first: where more than ``max_words`` are left, ``min_count`` is
    raised until they are not (whole frequencies go, not some of their words).
    """
    sizes = word_counts(df, text_col).where(F.col("n") >= min_count).groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    if (sizes.agg(F.sum("words")).first()[0] or 0) > max_words:
        from pyspark.sql import Window
        above = sizes.withColumn("held", F.sum("words").over(Window.orderBy(F.desc("n"))))  # a row a frequency
        least = above.where(F.col("held") <= max_words).agg(F.min("n")).first()[0]
        min_count = least if least is not None else above.agg(F.max("n")).first()[0] + 1
    tok = RegexTokenizer(inputCol=text_col, outputCol="_tok", pattern=r"\W+", minTokenLength=2)
    d = tok.transform(df)
    model = Word2Vec(vectorSize=size, inputCol="_tok", outputCol="_vec", seed=seed, minCount=min_count).fit(d)
    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))


SKETCH_K = 1000  # size of a quantile sketch: normalised rank error about 0.4 %


def _psi(j: DataFrame, eps: float) -> DataFrame:
    """``PSI = sum of (c - b) * ln(c / b)`` over the shares of the bins' counts ``b`` and ``c`` (a few rows)."""
    from pyspark.sql import Window
    everything = Window.partitionBy()
    pb = F.greatest(F.try_divide(F.col("b"), F.sum("b").over(everything)), F.lit(eps))
    pc = F.greatest(F.try_divide(F.col("c"), F.sum("c").over(everything)), F.lit(eps))
    return j.select(((pc - pb) * F.log(pc / pb)).alias("_t")).agg(F.sum("_t").alias("psi"))


def drift(baseline: DataFrame, current: DataFrame, col: str, bins: int = 10,
          eps: float = 1e-6, edges: str = "quantile") -> DataFrame:
    """M7. Population stability index of ``col`` between two frames.

    ``edges``: baseline quantiles (``"quantile"``, one ``percentile_approx``
    scalar subquery) or equal widths between the baseline's smallest and largest value
    (``"width"``, exact). Both frames are binned by the same edges and
    counted (``eps`` smoothing). NULLs and NaNs are a bin of their own; an
    empty frame has share 0 everywhere.
    """
    if edges not in ("quantile", "width"):
        raise ValueError("edges must be 'quantile' or 'width'")
    v = F.col(col).cast("double")
    known = baseline.where(v.isNotNull() & ~F.isnan(v))
    qs = [i / bins for i in range(1, bins)]
    if edges == "quantile":
        cuts = known.select(F.percentile_approx(v, qs, 10_000)).scalar()
    else:
        cuts = known.select(F.array(*[F.min(v) + (F.max(v) - F.min(v)) * q for q in qs])).scalar()

    def binned(df: DataFrame, side: str) -> DataFrame:
        # bin = number of edges <= x (edges stay a scalar subquery; no lambda,
        # since subqueries are not allowed inside higher-order functions)
        b = sum((v >= F.element_at(cuts, i + 1)).cast("int") for i in range(len(qs)))
        b = F.when(v.isNull() | F.isnan(v), F.lit(-1)).otherwise(F.coalesce(b, F.lit(0)))
        return (df.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias(side)))

    return _psi(binned(baseline, "b").join(binned(current, "c"), on="bin", how="full").fillna(0, ["b", "c"]), eps)


def value_sketches(df: DataFrame, col: str, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """M7 for incremental runs: per part (``by``), rows, NULL or NaN rows, and a mergeable quantile sketch of the other values."""
    v = F.col(col).cast("double")
    known = F.when(~F.isnan(v), v)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(v.isNull() | F.isnan(v)).alias("missing"),
                               F.kll_sketch_agg_double(known, F.lit(k)).alias("sketch"))


def sketch_drift(baseline: DataFrame, current: DataFrame, bins: int = 10, eps: float = 1e-6) -> DataFrame:
    """M7 from stored :func:`value_sketches`: no data is read again. Edges and shares are off by the sketches' rank error."""
    qs = [i / bins for i in range(1, bins)]
    one = lambda df: df.where("n > missing").agg(F.kll_merge_agg_double("sketch").alias("s"))
    cuts = one(baseline).where("s IS NOT NULL").select(*[F.kll_sketch_get_quantile_double("s", F.lit(q)) for q in qs]).first()  # bins - 1 numbers

    def shares(df: DataFrame, side: str) -> DataFrame:
        sums = df.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("missing"), F.lit(0)).alias("m"))
        below = one(df).where("s IS NOT NULL").select(*[F.kll_sketch_get_rank_double("s", F.lit(c)) for c in cuts or []]).first() if cuts else None
        known = (F.col("n") - F.col("m")).cast("double")
        up = [F.lit(0.0), *map(F.lit, below or [0.0] * len(qs)), F.lit(1.0)]
        counts = [F.struct(F.lit(-1).alias("bin"), F.col("m").cast("double").alias(side)),
                  *[F.struct(F.lit(i).alias("bin"), (known * (up[i + 1] - up[i])).alias(side)) for i in range(bins)]]
        return sums.select(F.explode(F.array(*counts)).alias("_f")).select("_f.*")

    return _psi(shares(baseline, "b").join(shares(current, "c"), on="bin"), eps)


def apply_handler(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
                  error_col: str = "error", keep: Sequence[str] = ()) -> DataFrame:
    """M16. User handler on batches of records (``mapInPandas``, Arrow batches).

    ``fn`` gets a frame and returns one of as many rows in the same order with the
    fields of ``schema``; it may reject single rows by an ``error_col`` of its
    own. If it raises, the batch is halved until the records at fault stand
    alone: these get the error (and nulls), all others their result. ``keep``
    columns are copied from the input to every output row.
    """
    from pyspark.sql.types import StructType
    out_fields = [f.name for f in StructType.fromDDL(schema).fields]
    keep = list(keep)
    keep_ddl = ", ".join(f"{c} {t}" for c, t in df.select(*keep).dtypes) if keep else ""

    def handled(pdf: pd.DataFrame) -> list[pd.DataFrame]:
        try:
            got = fn(pdf).reset_index(drop=True)
            if len(got) != len(pdf):
                raise ValueError(f"handler returned {len(got)} rows for {len(pdf)}")
            return [got.reindex(columns=[*out_fields, error_col])]
        except Exception as e:
            if len(pdf) == 1:
                return [pd.DataFrame({**{c: [None] for c in out_fields}, error_col: [f"{type(e).__name__}: {e}"]})]
            half = len(pdf) // 2
            return handled(pdf.iloc[:half]) + handled(pdf.iloc[half:])

    def run(batches):
        for pdf in batches:
            if len(pdf):
                out = pd.concat([p.astype(object) for p in handled(pdf.reset_index(drop=True))], ignore_index=True)
                out = out.where(out.notna(), None)
                yield pd.concat([pdf[keep].reset_index(drop=True), out], axis=1)

    full = ", ".join(x for x in [keep_ddl, schema, f"{error_col} string"] if x)
    return df.mapInPandas(run, full)
