"""File sources. Schemas are always explicit when given (no inference
pass over the data); CSV without a schema reads every column as text,
to be typed with :func:`tidewater.operators.shape.cast_columns`."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, sep: str = ",") -> DataFrame:
    """S1. CSV with header; without a schema every column is a string."""
    r = spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None,
              multi_line: bool = True) -> DataFrame:
    """S2. JSON documents; ``multi_line`` reads pretty-printed arrays as rows
    (line mode would turn ``[`` and ``]`` into corrupt rows)."""
    r = spark.read.option("multiLine", multi_line)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_json_folder(spark: SparkSession, path: str, schema: StructType | str,
                     suffix: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """S3. One JSON document per file under ``path`` (recursive), only files
    matching ``suffix``. Returns ``(good, bad)``: a file that does not parse
    becomes a ``bad`` row (file path + raw text) instead of failing the read.

    Each file is read whole as text and parsed with ``from_json`` against
    the given schema, so no inference pass runs over the folder.
    """
    st = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    raw = (spark.read.option("wholetext", True).option("pathGlobFilter", suffix)
           .option("recursiveFileLookup", True).text(path)
           .withColumn("file_path", F.col("_metadata.file_path")))
    ok = F.try_parse_json(F.col("value")).isNotNull()
    good = (raw.filter(ok).select(F.from_json(F.col("value"), st).alias("_d"), "file_path")
            .select("_d.*", "file_path"))
    bad = raw.filter(~ok).select("file_path", F.col("value").alias("raw"))
    return good, bad


def read_table(spark: SparkSession, path_or_name: str, fmt: str = "parquet") -> DataFrame:
    """S4. Full scan of a table by catalog name or by path."""
    if "/" in path_or_name or ":" in path_or_name:
        return spark.read.format(fmt).load(path_or_name)
    return spark.table(path_or_name)


def object_inventory(spark: SparkSession, path: str, prefix: str = "", glob: str | None = None) -> DataFrame:
    """S5. Objects under ``path``: key (relative path), size, last modified.

    Uses the ``binaryFile`` source without its ``content`` column, so only
    file metadata is listed, never the bytes. ``prefix`` becomes a path
    pattern: what does not begin with it is never listed. What matches at the first
    level are the roots of the listing, which Spark spreads over tasks when they are many."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    base = path.rstrip("/") + "/"
    pattern = base + re.sub(r"([\\\[\]{}*?,^])", r"\\\1", prefix) + "*"
    try:
        df = r.load(pattern)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        if not prefix:
            r.load(path)  # an error where there is no such folder
        df = spark.createDataFrame([], "path string, modificationTime timestamp, length bigint")
    rel = F.regexp_replace(F.col("path"), r"^(file:)?(//)?", "")
    base_clean = base.replace("file://", "").replace("file:", "")
    key = F.when(rel.startswith(base_clean), F.substring(rel, len(base_clean) + 1, 1 << 30)).otherwise(rel)
    out = df.select(key.alias("key"), F.col("length").alias("size"),
                    F.col("modificationTime").alias("last_modified"))
    return out


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: StructType | str | None = None) -> DataFrame:
    """S13. XML rows (built-in ``xml`` source)."""
    r = spark.read.format("xml").option("rowTag", row_tag)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def convert(spark: SparkSession, src: str, src_fmt: str, dst: str, dst_fmt: str,
            read_options: dict | None = None, write_options: dict | None = None,
            partition_by: tuple[str, ...] = ()) -> None:
    """S14. Read one format, write another (csv, json, parquet, orc, xml, text).
    Avro needs the external spark-avro package and is not bundled."""
    df = spark.read.format(src_fmt).options(**(read_options or {})).load(src)
    w = df.write.mode("overwrite").format(dst_fmt).options(**(write_options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(dst)


def read_pixels(spark: SparkSession, path: str, n_pixels: int = 784, scale: float | None = 255.0) -> DataFrame:
    """S15. Labelled image rows ``(label, pixels array<float>)``; ``valid``
    marks rows of the expected length; ``scale`` divides pixel values
    (``None`` keeps them)."""
    df = spark.read.parquet(path)
    px = F.col("pixels").cast("array<float>")
    if scale:
        px = F.transform(px, lambda x: x / F.lit(float(scale)))
    return df.select(F.col("label").cast("int").alias("label"), px.alias("pixels"),
                     (F.size("pixels") == F.lit(n_pixels)).alias("valid"))
