"""Equi-joins and unions (J5, J6, J7, U3). Small sides are broadcast only
behind :func:`sized_broadcast`; beyond the bound Spark keeps a shuffle
join and AQE splits skewed partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.time import as_ts
from tidewater.session import sized_broadcast


def attach_object_info(events: DataFrame, inventory: DataFrame,
                       keys: Sequence[str] = ("bucket", "key")) -> DataFrame:
    """J5. Events joined to object metadata; events without metadata drop."""
    return events.join(inventory, on=list(keys), how="inner")


def enrich(fact: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str]]],
           max_broadcast_bytes: int | None = None) -> DataFrame:
    """J7. Chain of left joins ``fact ⟕ dim_i USING keys_i``."""
    out = fact
    for dim, keys in dims:
        out = out.join(sized_broadcast(dim, max_broadcast_bytes), on=list(keys), how="left")
    return out


def cost_rollup(usage: DataFrame, prices: DataFrame, item_col: str, qty_col: str,
                price_col: str, by: Sequence[str] = (), unit_col: str | None = None,
                out: str = "cost") -> DataFrame:
    """J6. ``Σ quantity / unit × price`` per ``by`` (columns of either side).

    Usage is summed per item *before* the join (cost is linear in the
    quantity), so the join sees one row per item however skewed the usage
    is; the price list is broadcast only when its estimate is small.
    """
    usage_by = [c for c in by if c in usage.columns and c != item_col]
    u = usage.groupBy(item_col, *usage_by).agg(F.sum(qty_col).alias("_tw_qty"))
    p = prices.select(item_col, price_col, *([unit_col] if unit_col else []),
                      *[c for c in by if c in prices.columns and c != item_col and c not in usage_by])
    j = u.join(sized_broadcast(p), on=item_col, how="inner")
    per_unit = F.col(price_col) / F.col(unit_col) if unit_col else F.col(price_col)
    return j.groupBy(*by).agg(F.sum(F.col("_tw_qty") * per_unit).alias(out))


def monthly_cost(df: DataFrame, date_col: str, cost_col: str, by: Sequence[str] = (),
                 out: str = "cost") -> DataFrame:
    """A8. Cost per calendar month (``month`` = first instant of the month)."""
    return (df.groupBy(F.date_trunc("month", F.col(date_col)).alias("month"), *by)
            .agg(F.sum(cost_col).alias(out)))


def object_versions(versions: DataFrame, markers: DataFrame) -> DataFrame:
    """U3. Object versions and delete markers as one list with ``is_marker``."""
    return (versions.withColumn("is_marker", F.lit(False))
            .unionByName(markers.withColumn("is_marker", F.lit(True)), allowMissingColumns=True))


def usage_window(df: DataFrame, ts: str, start, end) -> DataFrame:
    """Half-open time range helper used by the cost reports."""
    return df.filter((F.col(ts) >= as_ts(start)) & (F.col(ts) < as_ts(end)))
