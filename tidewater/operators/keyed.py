"""Keyed-table operators: put / update / delete by key, latest, dedup, TTL.

Latest-per-key is an aggregate (``max_by`` over a struct), not a
``row_number`` window: the aggregate is combined map-side, so a key that
holds a third of all rows sends one partial row per map task to the
shuffle instead of all of its rows to a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.time import as_ts, ts_type

_SRC = "_tw_src"
_ROW = "_tw_row"


def _ordered(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], pick) -> DataFrame:
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.select(*keys).distinct()
    ordkey = F.struct(*[F.col(c) for c in order_by])
    agg = df.groupBy(*keys).agg(pick(F.struct(*[F.col(c) for c in payload]), ordkey).alias(_ROW))
    return agg.select(*keys, *[F.col(f"{_ROW}.{c}").alias(c) for c in payload])


def latest_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Newest row per key by ``order_by`` (lexicographic). ``order_by``
    should end in a unique column so the choice is deterministic."""
    return _ordered(df, keys, order_by, F.max_by)


def first_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Oldest row per key by ``order_by``."""
    return _ordered(df, keys, order_by, F.min_by)


def upsert(base: DataFrame, changes: DataFrame, keys: Sequence[str],
           order_by: Sequence[str] = (), deleted_col: str | None = None) -> DataFrame:
    """K2. Insert or replace whole rows by key; last write wins.

    Rows are ranked by ``order_by``, then changes over base. A change row
    replaces the entire item (columns it lacks become NULL). When
    ``deleted_col`` is given, a winning row with ``deleted_col = true`` is a
    tombstone and removes the key.
    """
    b = base.withColumn(_SRC, F.lit(0))
    c = changes.withColumn(_SRC, F.lit(1))
    u = b.unionByName(c, allowMissingColumns=True)
    out = latest_by_key(u, keys, [*order_by, _SRC]).drop(_SRC)
    if deleted_col:
        out = out.filter(~F.coalesce(F.col(deleted_col), F.lit(False))).drop(deleted_col)
    return out


def update_by_key(base: DataFrame, patch: DataFrame, keys: Sequence[str],
                  set_cols: Sequence[str], order_by: Sequence[str] = (),
                  created_col: str | None = None) -> DataFrame:
    """K3. Set ``set_cols`` for the keys in ``patch``; create the item when
    the key is absent (other attributes NULL). A NULL patch value leaves
    the current value. Several patches for one key: the last by
    ``order_by`` wins (or the largest values when no order is given)."""
    keys = list(keys)
    set_cols = list(set_cols)
    if order_by:
        p = latest_by_key(patch.select(*keys, *set_cols, *order_by), keys, order_by).select(*keys, *set_cols)
    else:
        p = (patch.groupBy(*keys).agg(F.max(F.struct(*set_cols)).alias(_ROW))
             .select(*keys, *[F.col(f"{_ROW}.{c}").alias(c) for c in set_cols]))
    p = p.select(*keys, *[F.col(c).alias(f"_tw_new_{c}") for c in set_cols]).withColumn("_tw_hit", F.lit(True))
    b = base.withColumn("_tw_base", F.lit(True))
    j = b.join(p, on=keys, how="full")
    cols = {}
    for c in set_cols:
        new = F.col(f"_tw_new_{c}")
        cols[c] = F.coalesce(new, F.col(c)) if c in base.columns else new
    if created_col:
        cols[created_col] = F.col("_tw_base").isNull()
    out = j.withColumns(cols)
    ordered = list(base.columns) + [c for c in set_cols if c not in base.columns]
    if created_col:
        ordered.append(created_col)
    return out.select(*ordered)


def delete_by_key(base: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K4. Remove items whose key appears in ``keys_df`` (anti join)."""
    return base.join(keys_df.select(*keys).distinct(), on=list(keys), how="left_anti")


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
          count_col: str | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """A16. One row per key: the first by ``order_by``; optional copy count.

    ``keep`` limits the carried columns (default: all), so a wide column
    that is only a key (e.g. the text being de-duplicated) is not shuffled.
    With a single ordering column and nothing else to carry, this is a plain
    ``min`` (hash aggregate).
    """
    keys = list(keys)
    payload = [c for c in (keep if keep is not None else df.columns) if c not in keys]
    cnt = [F.count(F.lit(1)).alias(count_col)] if count_col else []
    if len(order_by) == 1 and set(payload) <= set(order_by):
        out = df.groupBy(*keys).agg(F.min(order_by[0]).alias(order_by[0]), *cnt)
        return out.select(*keys, *payload, *([count_col] if count_col else []))
    out = df.groupBy(*keys).agg(F.min_by(F.struct(*payload), F.struct(*order_by)).alias(_ROW), *cnt)
    sel = [*keys, *[F.col(f"{_ROW}.{c}").alias(c) for c in payload]]
    if count_col:
        sel.append(count_col)
    return out.select(*sel)


def dedup_text(df: DataFrame, text_col: str, id_col: str, count_col: str = "n_copies",
               keep: Sequence[str] | None = None) -> DataFrame:
    """A16 for long texts: group on a SHA-256 of the text so the shuffle key
    stays 32 bytes however long the documents are; keep the lowest id."""
    keyed = df.withColumn("_tw_h", F.sha2(F.col(text_col), 256))
    return dedup(keyed, ["_tw_h"], [id_col], count_col, keep).drop("_tw_h")


def latest(df: DataFrame, ts: str, by: Sequence[str] = (), tie: Sequence[str] = ()) -> DataFrame:
    """W4. Newest row overall (top-1, TakeOrderedAndProject) or per group."""
    if by:
        return latest_by_key(df, by, [ts, *tie])
    order = [F.col(ts).desc_nulls_last(), *[F.col(t).desc() for t in tie]]
    return df.orderBy(*order).limit(1)


def expire(df: DataFrame, ts: str, seconds: int, as_of=None) -> DataFrame:
    """T10. Keep rows younger than ``seconds`` at ``as_of`` (retention / TTL)."""
    ref = F.current_timestamp() if as_of is None else as_ts(as_of, ts_type(df, ts))
    lo = ref - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(seconds)))
    return df.filter(F.col(ts) > lo)


# ------------------------------------------------------------------ change log
# A keyed table kept as an append-only log of put / update / delete rows.
# ``_op`` is the operation, ``_set`` the columns an update sets, ``_seq``
# the order of application. The current table is one aggregate over the
# log: every column takes its value from the newest row that defines it
# (a put or delete defines every column, an update only those in
# ``_set``); a key whose newest put/delete is a delete, with no later
# update, is gone. Same semantics as upsert / update_by_key / delete_by_key.

PUT, UPDATE, DELETE = "put", "update", "delete"
OP, SET, SEQ = "_op", "_set", "_seq"


def as_changes(df: DataFrame, op: str, seq, set_cols: Sequence[str] | None = None) -> DataFrame:
    """Tag rows as change-log entries. For updates, ``_set`` lists the
    columns of ``set_cols`` that are non-NULL in the row."""
    seqc = F.lit(seq) if not hasattr(seq, "alias") else seq
    if op == UPDATE:
        cols = list(set_cols or [])
        s = F.filter(F.array(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in cols]), lambda x: x.isNotNull()) \
            if cols else F.array().cast("array<string>")
    else:
        s = F.array().cast("array<string>")
    return df.withColumns({OP: F.lit(op), SET: s, SEQ: seqc})


def merge_changes(log: DataFrame, keys: Sequence[str], order: Sequence[str] = (SEQ,)) -> DataFrame:
    """Current table from a change log (see module notes above)."""
    keys = list(keys)
    meta = {OP, SET, *order}
    payload = [c for c in log.columns if c not in keys and c not in meta]
    ordkey = F.struct(*[F.col(c) for c in order])
    op = F.col(OP)
    aggs = []
    for c in payload:
        defines = (op != F.lit(UPDATE)) | F.array_contains(F.col(SET), F.lit(c))
        aggs.append(F.max_by(F.col(c), F.when(defines, ordkey)).alias(c))
    last_full = F.when(op != F.lit(UPDATE), ordkey)
    aggs += [F.max_by(op == F.lit(DELETE), last_full).alias("_tw_del"),
             F.max(last_full).alias("_tw_full"),
             F.max(F.when(op == F.lit(UPDATE), ordkey)).alias("_tw_upd")]
    m = log.groupBy(*keys).agg(*aggs)
    alive = (~F.coalesce(F.col("_tw_del"), F.lit(False))) | (F.col("_tw_upd") > F.col("_tw_full"))
    return m.filter(alive).select(*keys, *payload)
