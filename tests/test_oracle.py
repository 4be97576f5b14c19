"""Registered queries against DuckDB on the same tables (the driver's gate)."""

import pytest

import __spark_entry__ as E
from conftest import SF0001, SF001
from oracle_compare import _rows, compare
from tidewater.plans import ORACLE_SQL, QUERIES


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["balance_band", "n"] and df.count() >= 1


def test_every_query_has_oracle_or_is_listed():
    missing = set(QUERIES) - set(ORACLE_SQL)
    assert missing <= {"ml_split_sizes", "kmeans_sizes", "forest_eval", "shuffle_orders", "drift_totalprice",
                       "pca_embeddings", "logistic_eval"}, missing


def test_all_queries_match_oracle(spark):
    res = compare(spark, SF001, sorted(QUERIES))
    bad = {k: v for k, v in res.items() if v.get("oracle") and not v.get("value_match")}
    errs = {k: v for k, v in res.items() if "error" in v}
    assert not bad and not errs, {**bad, **errs}


@pytest.mark.parametrize("name", ["upsert_latest", "gather_lines", "findings", "vector_top5", "alarm_2x5min",
                                  "assemble_turns", "dedup_exact"])
def test_shuffle_partition_invariance(spark, name):
    q = QUERIES[name]
    outs = []
    for n in ("1", "3", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        df = q(spark, SF0001)
        outs.append(_rows(df.columns, [tuple(r) for r in df.collect()]))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert outs[0] == outs[1] == outs[2]
