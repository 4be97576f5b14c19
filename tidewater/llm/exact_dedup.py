"""Operator 2: exact dedup by two-pass Bloom filtering (DataFrame functions only).

Pass 1 hashes every text and finds the Bloom bits that two rows set. Pass 2
probes each row: a row with a bit that no other row sets is certainly unique
and passes straight through; only the possibly repeated rows are shuffled,
grouped by SHA-256.

Rules for odd input: a null text counts as empty; texts are equal when
identical byte for byte; of equal texts the row with the largest id stays
(a null id is smaller than any other); rows repeated with the same id and
text are equally "kept" in ``mark_duplicates`` and become one row in
``drop_duplicates``; empty tables give empty results; extra columns are
ignored by the first and carried through by the second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm import bloom
from tidewater.llm.common import stored, table


def _sha(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def _bits(df: DataFrame, rows: int, max_words: int) -> DataFrame:
    return bloom.with_bits(df, F.xxhash64("sha"), bloom.n_words(rows, max_words))


def mark_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    max_words: int = bloom.MAX_WORDS) -> DataFrame:
    """One row per row of ``df``: id, keep_id, group_size, kept, text_sha256."""
    digests = stored(df.select(F.col(id_col).alias("id"), F.unhex(_sha(text_col)).alias("sha")), "digests")
    digests = _bits(digests, digests.count(), max_words)
    repeats = stored(bloom.repeat_filter(digests), "bloom")
    probed = bloom.probe(digests, repeats, "maybe")

    alone = probed.where("NOT maybe").select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("n"), "sha")
    again = probed.where("maybe").drop("maybe")
    groups = again.groupBy("sha").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    shared = again.join(groups, "sha").select("id", "keep_id", "n", "sha")
    return alone.unionByName(shared).select(
        F.col("id").alias(id_col), "keep_id", F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def drop_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    max_words: int = bloom.MAX_WORDS) -> DataFrame:
    """The rows of ``df``, one of each text; unique rows are not shuffled."""
    cols = df.columns
    keyed = df.select(F.struct(*[df[c] for c in cols]).alias("row"), df[id_col].alias("id"), _sha(text_col).alias("sha"))
    rows = df.count()
    repeats = stored(bloom.repeat_filter(_bits(keyed.select("sha"), rows, max_words)), "bloom")
    probed = bloom.probe(_bits(keyed, rows, max_words), repeats, "maybe")
    alone = probed.where("NOT maybe").select("row.*")
    # combined in each map task first: a group of any size sends one row a task
    order = F.struct(F.col("id").isNotNull(), "id")
    kept = probed.where("maybe").groupBy("sha").agg(F.max_by("row", order).alias("row")).select("row.*")
    return alone.unionByName(kept)


def op2_bloom_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return mark_duplicates(table(spark, sf_dir, "documents"))


OP2_SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents)
"""
