"""Catalog registration (S12) and relational reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_table(spark: SparkSession, db: str, name: str, path: str, fmt: str = "parquet",
                   partitioned: bool = False) -> DataFrame:
    """S12. Create the database if needed, register ``path`` as an external
    table (schema read from the files) and discover its partitions. A name
    that is already registered at another place is an error."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    full = f"`{db}`.`{name}`"
    if not spark.catalog.tableExists(f"{db}.{name}"):
        spark.catalog.createTable(f"{db}.{name}", path=path, source=fmt)
    else:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {full}").where("col_name = 'Location'").select("data_type").collect()
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()
        if rows and rows[0][0].rstrip("/") != at.rstrip("/"):
            raise ValueError(f"{db}.{name} is registered at {rows[0][0]}, not {at}")
    if partitioned:
        spark.catalog.recoverPartitions(full)
    return spark.table(full)


def read_jdbc(spark: SparkSession, url: str, query: str, props: dict | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """S6. SQL query against a relational server over JDBC. With
    ``partition_column`` and bounds the read is split into parallel range
    queries instead of one connection (then ``query`` becomes a subquery)."""
    r = spark.read.format("jdbc").option("url", url)
    for k, v in (props or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("dbtable", f"({query}) q").option("partitionColumn", partition_column)
             .option("lowerBound", lower).option("upperBound", upper).option("numPartitions", num_partitions))
    else:
        r = r.option("query", query)
    return r.load()
