"""Aggregations (A1-A6, A9, A10, A12, A13, A15). All are hash aggregates
with a partial (map-side) phase; none collects a group into one task
except :func:`gather`, whose output *is* the group's list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import join_null_safe, materialised, sized_broadcast

TASK_BYTES = 64 << 20  # of records that a task of gather_chunks sorts, about
ROW_BYTES = 100        # of a record in memory beside its JSON, about
BLOCK_ROWS = 4096      # positions of a block, at most
WIDTH_SHARE = 0.01     # of the records, whose JSON gives the width


def row_count(df: DataFrame, out: str = "n") -> DataFrame:
    """A1. One row with the row count."""
    return df.agg(F.count(F.lit(1)).alias(out))


def count_by(df: DataFrame, *cols: str, out: str = "count") -> DataFrame:
    """A2. Rows per group."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(out))


def average(df: DataFrame, col: str, out: str, by: Sequence[str] = ()) -> DataFrame:
    """A3."""
    return df.groupBy(*by).agg(F.avg(col).alias(out))


def maximum(df: DataFrame, col: str, out: str, by: Sequence[str] = ()) -> DataFrame:
    """A4."""
    return df.groupBy(*by).agg(F.max(col).alias(out))


def document_totals(df: DataFrame, count_col: str, date_col: str | None = None,
                    by: Sequence[str] = ()) -> DataFrame:
    """A5. Documents, summed count (missing count = 0) and newest date."""
    aggs = [F.count(F.lit(1)).alias("n_documents"),
            F.sum(F.coalesce(F.col(count_col), F.lit(0))).cast("bigint").alias("total_count")]
    if date_col:
        aggs.append(F.max(date_col).alias("latest"))
    return df.groupBy(*by).agg(*aggs)


def gather(df: DataFrame, by: Sequence[str], fields: Sequence[str],
           out: str = "items", count_out: str = "n_items") -> DataFrame:
    """A6. Records of each group as a sorted array plus their count.

    ``collect_list`` runs partially per map task; the final array is the
    group's own output row, so its size is the result's size, not a cap.
    The array is sorted on all fields so the result does not depend on
    shuffle order.
    """
    items = F.array_sort(F.collect_list(F.struct(*[F.col(f) for f in fields])))
    return (df.groupBy(*by).agg(items.alias(out), F.count(F.lit(1)).alias(count_out)))


def gather_rows(df: DataFrame, by: Sequence[str], fields: Sequence[str],
                count_out: str = "n_items") -> DataFrame:
    """A6 in row form: every record of a group with the group's count.

    Nothing is collected: counts are a partial aggregate joined back on the
    key (size-checked broadcast, else a sort-merge join that AQE splits when
    one key is hot). Use this instead of :func:`gather` when a group may be
    too large to hold as one value.
    """
    counts = materialised(df.groupBy(*by).agg(F.count(F.lit(1)).alias(count_out)), "counts")
    return join_null_safe(df.select(*by, *fields), sized_broadcast(counts), list(by))


def gather_chunks(df: DataFrame, by: Sequence[str], fields: Sequence[str], chunk: int = 1 << 20,
                  size: Column | None = None, out: str = "items", count_out: str = "n_items", chunk_col: str = "chunk") -> DataFrame:
    """A6 for groups of any size: each group's sorted list in chunks, one row a chunk (numbered from 0).

    A record is in chunk ``(sum of size of the group's records before it) div chunk``, by
    default sizes are bytes of the record as JSON; so a chunk is at most ``chunk``
    and one record long, and chunks in order are the whole list. Records are sorted by
    ``fields`` over all tasks (range partition, equal records dealt apart), in as many parts as
    their number and width ask for, so no task ever sees a whole group or a fixed share of the
    table. Parts are cut into blocks of positions; only a block's first group can have records before it,
    whose sizes are summed by blocks and by parts.
    """
    by = list(by)
    rows = df.select(*by, F.struct(*fields).alias("_tw_r"), (size if size is not None else F.octet_length(F.to_json(F.struct(*fields)))).cast("long").alias("_tw_s"))
    wide = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in by], "_tw_r")))
    n, width = rows.withColumn("_tw_u", F.rand(7)).agg(F.count(F.lit(1)), F.avg(F.when(F.col("_tw_u") < WIDTH_SHARE, wide))).first()
    width = ROW_BYTES + (width or 0)
    n_parts = max(df.sparkSession.sparkContext.defaultParallelism, int(n * width / TASK_BYTES) + 1)
    block = int(max(1, min(BLOCK_ROWS, TASK_BYTES / 16 / width)))
    rows = rows.withColumn("_tw_i", F.monotonically_increasing_id()).repartitionByRange(n_parts, *by, "_tw_r", "_tw_i")
    rows = rows.sortWithinPartitions(*by, "_tw_r", "_tw_i").withColumn("_tw_i", F.monotonically_increasing_id())
    at = F.col("_tw_i").bitwiseAND((1 << 33) - 1)  # a record's position in its part, the bits above are the part's number
    rows = materialised(rows.withColumns({"_tw_part": F.shiftright("_tw_i", 33), "_tw_block": F.floor(at / block)}), "gather")

    ones = rows.groupBy(*by, "_tw_part", "_tw_block").agg(F.sum("_tw_s").alias("_tw_own"), F.min("_tw_i").alias("_tw_first"))
    ones = materialised(ones, "gather-blocks")
    parts = ones.groupBy(*by, "_tw_part").agg(F.sum("_tw_own").alias("_tw_sum"))
    w = Window.partitionBy(*by).orderBy("_tw_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a part
    parts = parts.withColumn("_tw_before", F.coalesce(F.sum("_tw_sum").over(w), F.lit(0))).drop("_tw_sum")
    w = Window.partitionBy(*by, "_tw_part").orderBy("_tw_block").rowsBetween(Window.unboundedPreceding, -1)  # a row a block
    ones = join_null_safe(ones.withColumn("_tw_inner", F.coalesce(F.sum("_tw_own").over(w), F.lit(0))), parts, [*by, "_tw_part"])
    starts = F.col("_tw_first").bitwiseAND((1 << 33) - 1) == F.col("_tw_block") * block
    carry = ones.where(starts).select("_tw_part", "_tw_block", (F.col("_tw_inner") + F.col("_tw_before")).alias("_tw_carry"))

    own = Window.partitionBy("_tw_part", "_tw_block", *by).orderBy("_tw_i")
    rows = rows.repartition(n_parts, "_tw_part", "_tw_block").withColumns({
        "_tw_sum": F.coalesce(F.sum("_tw_s").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_tw_first": F.first("_tw_i").over(own.rowsBetween(Window.unboundedPreceding, 0))})
    rows = rows.join(carry, ["_tw_part", "_tw_block"])
    rows = rows.withColumn(chunk_col, F.floor((F.col("_tw_sum") + F.when(starts, F.col("_tw_carry")).otherwise(F.lit(0))) / chunk))
    rows = rows.select(*by, chunk_col, "_tw_r").repartition(n_parts, *by, chunk_col)
    return rows.groupBy(*by, chunk_col).agg(F.array_sort(F.collect_list("_tw_r")).alias(out), F.count(F.lit(1)).alias(count_out))


def table_stats(df: DataFrame, size_col: str | None = None, key_col: str | None = None,
                by: Sequence[str] = ()) -> DataFrame:
    """A12. Count, distinct keys, total / mean / max size."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    if key_col:
        aggs.append(F.countDistinct(key_col).alias("n_keys"))
    if size_col:
        aggs += [F.sum(size_col).alias("total_size"), F.avg(size_col).alias("avg_size"),
                 F.max(size_col).alias("max_size")]
    return df.groupBy(*by).agg(*aggs)


def queue_depth(df: DataFrame, status_col: str = "status", by: Sequence[str] = (),
                waiting: str = "queued") -> DataFrame:
    """A13. Messages still waiting (status = ``waiting``) and all messages."""
    return df.groupBy(*by).agg(
        F.count_if(F.col(status_col) == F.lit(waiting)).alias("waiting"),
        F.count(F.lit(1)).alias("total"))


def evaluate(df: DataFrame, label: str, pred: str, loss: str | None = None) -> DataFrame:
    """A9. Mean loss and accuracy in percent over all rows; a row without a
    label or a prediction counts as wrong."""
    hit = F.coalesce(F.col(label) == F.col(pred), F.lit(False))
    aggs = [F.count(F.lit(1)).alias("n"),
            (F.lit(100.0) * F.avg(hit.cast("double"))).alias("accuracy_pct")]
    if loss:
        aggs.insert(1, F.avg(loss).alias("mean_loss"))
    return df.agg(*aggs)


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """A10. Per-class precision, recall, F1 and support over label ∪ prediction.

    Each row is unrolled into (its label class, its predicted class) and
    summed per class: one partial aggregate, no join, no per-class pass.
    A zero denominator gives 0.0.
    """
    l, p = F.col(label), F.col(pred)
    hit = (l == p).cast("long")
    rows = F.array(
        F.struct(l.alias("cls"), F.lit(1).cast("long").alias("in_label"), F.lit(0).cast("long").alias("in_pred"), hit.alias("tp")),
        F.struct(p.alias("cls"), F.lit(0).cast("long").alias("in_label"), F.lit(1).cast("long").alias("in_pred"), F.lit(0).cast("long").alias("tp")),
    )
    per = (df.select(F.inline(rows))
           .groupBy("cls").agg(F.sum("tp").alias("tp"), F.sum("in_label").alias("support"),
                               F.sum("in_pred").alias("predicted")))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    f1 = F.when(prec + rec > 0, F.lit(2.0) * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    return per.select(F.col("cls").alias("class"), prec.alias("precision"), rec.alias("recall"),
                      f1.alias("f1"), F.col("support"))


# Statistic names of a column profile, in output order.
PROFILE_STATS = ["n", "nulls", "n_distinct", "min", "max", "mean", "stddev"]
_NUMERIC = ("integer", "long", "double", "float", "short", "byte", "decimal")


def profile(df: DataFrame, cols: Sequence[str] | None = None, exact_distinct: bool = True) -> DataFrame:
    """A15. One output row per column: n, nulls, distinct, min, max, mean,
    sample stddev, type.

    ``min`` and ``max`` are numbers; columns of other types have NULL there and
    in the moments, and their range as text in ``min_text`` and ``max_text``
    (in the order of the type; nested values in that of their text).

    Counts and moments come from one aggregate pass. Exact distinct counts
    are one scalar subquery per column (each reads only its column and
    de-duplicates with a partial aggregate), instead of ``count(DISTINCT)``
    in the main pass, which Spark plans as an Expand that copies every row
    once per distinct column. ``exact_distinct=False`` uses HyperLogLog++
    (``approx_count_distinct``) inside the single pass.
    """
    cols = list(cols or df.columns)
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def comparable(c: str) -> Column:
        kind = kinds[c].typeName()
        if kind == "binary":
            return F.hex(F.col(f"`{c}`"))
        return F.col(f"`{c}`").cast("string") if kind in ("array", "map", "struct", "variant") else F.col(f"`{c}`")

    aggs: list[Column] = []
    for i, c in enumerate(cols):
        v = comparable(c)
        numeric = kinds[c].typeName() in _NUMERIC
        x = v.cast("double") if numeric else F.lit(None).cast("double")
        t = F.lit(None).cast("string") if numeric else v
        aggs += [F.count(F.lit(1)).alias(f"n_{i}"), F.count_if(v.isNull()).alias(f"nulls_{i}"),
                 F.min(x).alias(f"min_{i}"), F.max(x).alias(f"max_{i}"),
                 F.avg(x).alias(f"mean_{i}"), F.stddev_samp(x).alias(f"stddev_{i}"),
                 F.min(t).cast("string").alias(f"min_text_{i}"), F.max(t).cast("string").alias(f"max_text_{i}")]
        if not exact_distinct:
            aggs.append(F.approx_count_distinct(v).alias(f"n_distinct_{i}"))
    wide = df.agg(*aggs)
    if exact_distinct:
        wide = wide.withColumns({f"n_distinct_{i}": df.select(F.countDistinct(comparable(c))).scalar()
                                 for i, c in enumerate(cols)})
    rows = [F.struct(F.lit(c).alias("column"), *(F.col(f"{k}_{i}").alias(k) for k in PROFILE_STATS),
                     F.lit(kinds[c].simpleString()).alias("type"), F.col(f"min_text_{i}").alias("min_text"), F.col(f"max_text_{i}").alias("max_text"))
            for i, c in enumerate(cols)]
    return wide.select(F.inline(F.array(*rows)))


def check_constraints(current: DataFrame, baseline: DataFrame, tolerance: float = 0.1) -> DataFrame:
    """A15. Compare a profile with a baseline profile (both from :func:`profile`).

    Checks per column: null ratio not above baseline + ``tolerance``; min
    not below and max not above the baseline range; mean shift
    ``|Δmean| <= tolerance * (baseline stddev + |baseline mean|)``. Columns
    without numbers are checked by their text range, and have no mean check.
    """
    b = baseline.select(*[F.col(c).alias(f"b_{c}") if c != "column" else F.col(c) for c in baseline.columns])
    j = current.join(b, on="column", how="full")
    null_ratio = F.col("nulls") / F.greatest(F.col("n"), F.lit(1))
    b_null_ratio = F.col("b_nulls") / F.greatest(F.col("b_n"), F.lit(1))
    is_text = F.col("min_text").isNotNull() | F.col("b_min_text").isNotNull()
    no_mean = F.col("mean").isNull() & F.col("b_mean").isNull() & ~F.col("type").rlike("int|double|float|decimal")
    checks = F.array(
        F.struct(F.lit("null_ratio").alias("check"), b_null_ratio.alias("baseline"), null_ratio.alias("current"),
                 (null_ratio <= b_null_ratio + F.lit(tolerance)).alias("ok")),
        F.struct(F.lit("min").alias("check"), F.col("b_min").alias("baseline"), F.col("min").alias("current"),
                 F.when(is_text, F.col("min_text") >= F.col("b_min_text")).otherwise(F.col("min") >= F.col("b_min")).alias("ok")),
        F.struct(F.lit("max").alias("check"), F.col("b_max").alias("baseline"), F.col("max").alias("current"),
                 F.when(is_text, F.col("max_text") <= F.col("b_max_text")).otherwise(F.col("max") <= F.col("b_max")).alias("ok")),
        F.struct(F.lit("mean").alias("check"), F.col("b_mean").alias("baseline"), F.col("mean").alias("current"),
                 (F.abs(F.col("mean") - F.col("b_mean"))
                  <= F.lit(tolerance) * (F.coalesce(F.col("b_stddev"), F.lit(0.0)) + F.abs(F.col("b_mean")))).alias("ok")),
    )
    return (j.select("column", no_mean.alias("_no_mean"), F.inline(checks))
            .where(~(F.coalesce(F.col("_no_mean"), F.lit(False)) & (F.col("check") == "mean"))).drop("_no_mean")
            .withColumn("ok", F.coalesce(F.col("ok"), F.lit(False))))


def profile_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), lg_k: int = 14) -> DataFrame:
    """A15 for incremental runs: per part (``by``) and column, rows, nulls, smallest and largest value as text, and a distinct-count sketch.

    Store the rows; parts that change are profiled again, and
    :func:`merge_profiles` adds them up without reading the data of the others.
    """
    long = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("x")) for c in cols])).alias("_f")
    return df.select(*by, long).select(*by, "_f.column", "_f.x").groupBy(*by, "column").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("x").isNull()).alias("nulls"), F.min("x").alias("min_text"), F.max("x").alias("max_text"),
        F.hll_sketch_agg("x", lg_k).alias("sketch"))


def merge_profiles(sketches: DataFrame) -> DataFrame:
    """One row per column from the rows of :func:`profile_sketches`; ``n_distinct`` is an estimate (2**14 registers: standard error 0.8 %)."""
    return sketches.groupBy("column").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.min("min_text").alias("min_text"), F.max("max_text").alias("max_text"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))
