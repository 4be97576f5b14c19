"""Sorts, top-k and ranks.

Top-k is ``orderBy().limit()`` (TakeOrderedAndProject: k rows per map
task, then a k-row merge) or ``row_number()/rank() <= k`` per group,
which Spark plans with a map-side WindowGroupLimit, so hot groups are
cut to k rows before the shuffle. Beyond the k up to which Spark does that, groups are
cut in two levels (salted, then whole). Ranks of all rows come from a range
partition and the sizes of the parts before it. Totals come from aggregates or scalar
subqueries, never from a window over the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import join_null_safe, materialised, sized_broadcast

SALTS = 64  # parts that a group is cut to its first rows in, before it meets
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def _order(cols: Sequence[str | Column], descending: bool = False) -> list[Column]:
    out = []
    for c in cols:
        if isinstance(c, Column):
            out.append(c)
        else:
            out.append(F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last())
    return out


def sort_by(df: DataFrame, cols: Sequence[str], descending: bool = False) -> DataFrame:
    """W2. Total order (range-partitioned sort)."""
    return df.orderBy(*_order(cols, descending))


def newest_first(df: DataFrame, ts: str, tie: Sequence[str] = ()) -> DataFrame:
    """W3. Newest first, missing dates last, ties by ``tie`` ascending."""
    return df.orderBy(F.col(ts).desc_nulls_last(), *[F.col(t).asc() for t in tie])


def _first_ranked(df: DataFrame, by: Sequence[str], ordcols: Sequence[Column], n: int, fn, rank_col: str) -> DataFrame:
    """Rows whose rank within ``by`` is at most ``n``, for any ``n``.

    Spark cuts groups to ``n`` rows before the shuffle up to a threshold of
    its own. Beyond it each group is dealt over ``SALTS`` parts and every part is cut first:
    a row among the first n of its group is among the first n of its part, and
    what stands before it survives with it, so the last ranks are those of the whole group.
    """
    rank = lambda frame, *keys: frame.withColumn(
        rank_col, fn().over((Window.partitionBy(*keys) if keys else Window).orderBy(*ordcols))).filter(F.col(rank_col) <= n)
    if n > int(df.sparkSession.conf.get(GROUP_LIMIT, "1000")):
        dealt = df.withColumn("_tw_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
        df = rank(dealt, *by, "_tw_salt").drop("_tw_salt", rank_col)
    return rank(df, *by)


def first_n(df: DataFrame, n: int, order: Sequence[str | Column], by: Sequence[str] = (),
            rank_col: str = "rank", total_col: str = "total", more_col: str = "more") -> DataFrame:
    """W5. The first ``n`` rows (per group) plus the total and "M more".

    Global: top-n via ``limit`` and the total as a scalar subquery.
    Per group: ``row_number() <= n`` (see ``_first_ranked``) and totals from
    a grouped count, written first so that its true size decides the join.
    """
    ordcols = _order(order)
    if not by:
        total = df.select(F.count(F.lit(1))).scalar()
        top = df.orderBy(*ordcols).limit(n)
        w = Window.orderBy(*ordcols)
        top = top.withColumn(rank_col, F.row_number().over(w))  # over n rows only
        out = top.withColumn(total_col, total)
    else:
        top = _first_ranked(df, by, ordcols, n, F.row_number, rank_col)
        totals = materialised(df.groupBy(*by).agg(F.count(F.lit(1)).alias(total_col)), "totals")
        out = join_null_safe(top, sized_broadcast(totals), list(by))
    return out.withColumn(more_col, F.greatest(F.col(total_col) - F.lit(n), F.lit(0)))


def latest_suffix(df: DataFrame, name_col: str, pattern: str = r"(\d+)$",
                  by: Sequence[str] = (), out_suffix: str = "suffix") -> DataFrame:
    """W6. Name with the largest numeric suffix (per group). Names without
    a suffix are ignored."""
    suf = F.regexp_extract(F.col(name_col), pattern, 1)
    num = F.when(suf != "", suf.try_cast("bigint"))
    d = df.withColumn(out_suffix, num).filter(F.col(out_suffix).isNotNull())
    if by:
        return d.groupBy(*by).agg(F.max_by(F.col(name_col), F.struct(out_suffix, name_col)).alias(name_col),
                                  F.max(out_suffix).alias(out_suffix))
    return d.orderBy(F.col(out_suffix).desc(), F.col(name_col).desc()).limit(1).select(name_col, out_suffix)


def chat_history(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 conv=None) -> DataFrame:
    """W8. Turns in order, optionally of one conversation (pushed-down filter)."""
    if conv is not None:
        df = df.filter(F.col(conv_col) == F.lit(conv))
    return df.orderBy(F.col(conv_col), F.col(turn_col))


def leaderboard(df: DataFrame, by: Sequence[str], score: str, n: int,
                method: str = "rank", rank_col: str = "rank", tie: Sequence[str] = ()) -> DataFrame:
    """W9. Rank rows by ``score`` (highest first) within ``by``; keep rank <= n.

    ``method``: ``rank`` (gaps), ``dense_rank`` or ``row_number``.
    """
    fn = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[method]
    ordcols = [F.col(score).desc_nulls_last(), *[F.col(t).asc() for t in tie]]
    return _first_ranked(df, by, ordcols, n, fn, rank_col)


def rank_all(df: DataFrame, cols: Sequence[str], descending: bool = False, rank_col: str = "rank",
             dense_col: str | None = None) -> DataFrame:
    """W9 for every row: its rank in the whole table by ``cols`` (and its dense rank).

    Rows of equal keys are counted first, so a key that holds a third of all rows is one
    row; the distinct keys are range-partitioned, ranked within their part,
    and moved by the rows in the parts before (one number a part). NULLs come last.
    """
    cols = list(cols)
    ordcols = _order(cols, descending)
    keys = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_tw_n")).repartitionByRange(*ordcols)
    keys = materialised(keys.withColumn("_tw_part", F.spark_partition_id()), "rank-keys")
    parts, rows, distinct = [], 0, 0
    for p in keys.groupBy("_tw_part").agg(F.sum("_tw_n").alias("n"), F.count(F.lit(1)).alias("k")).orderBy("_tw_part").collect():
        parts.append((p["_tw_part"], rows, distinct))
        rows, distinct = rows + p["n"], distinct + p["k"]
    before = df.sparkSession.createDataFrame(parts, "_tw_part int, _tw_rows long, _tw_keys long")
    w = Window.partitionBy("_tw_part").orderBy(*ordcols)
    here = F.coalesce(F.sum("_tw_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = keys.join(F.broadcast(before), "_tw_part").select(  # one row a partition
        *cols, (F.col("_tw_rows") + here + 1).alias(rank_col),
        *([(F.col("_tw_keys") + F.row_number().over(w)).alias(dense_col)] if dense_col else []))
    return join_null_safe(df, ranks, cols)
