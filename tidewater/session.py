"""Session construction and plan-level helpers shared by all modules."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Explicit broadcasts are bounded by the session's own
# ``spark.sql.autoBroadcastJoinThreshold`` (10 MB unless the cluster
# raises it); callers may pass a tighter or looser proven bound.
FALLBACK_BROADCAST_BYTES = 10 * 1024 * 1024


def get_session(app: str = "tidewater", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every operator assumes.

    On a cluster ``master`` stays ``None`` so spark-submit decides; the
    shuffle partition count is then left to AQE coalescing.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Keep top-k-per-group windows map-side limited (WindowGroupLimit).
        "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    elif not (master or "").startswith("local"):
        # Cluster sizing: start every shuffle wide and let AQE coalesce to
        # ~128 MB partitions. AQE can merge small partitions but cannot split
        # ordinary large ones, so a 200-partition default would leave
        # hundreds of GB per reduce task at 100 TB; oversized skewed
        # partitions are split by the skew-join rule.
        conf.update({
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16384",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
            "spark.sql.files.maxPartitionBytes": "256m",
        })
    forced = set(extra or {}) | ({"spark.sql.shuffle.partitions"} if shuffle_partitions else set())
    conf.update(extra or {})
    from pyspark import SparkConf
    preset = SparkConf()  # spark-submit / spark-defaults.conf values
    active = SparkSession.getActiveSession()
    for k, v in conf.items():
        # never override what the cluster already set, unless asked explicitly
        taken = preset.contains(k) or (active is not None and active.conf.get(k, None) is not None)
        if k in forced or not taken:
            b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only when the setting is absent *and* the master is local (unit tests,
    a laptop) is a private folder created and registered. On a cluster a
    machine-local folder would not survive executor loss, so an unset
    setting is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store)")
        d = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder: the plan is
    replaced by the written data, so a lost executor re-reads files instead
    of recomputing a long lineage. (Never ``localCheckpoint``.)"""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def checkpoint_path(spark: SparkSession, *parts: str) -> str:
    """Sub-path below the shared checkpoint folder (stream state, snapshots)."""
    return os.path.join(checkpoint_dir(spark), *parts)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (no job is run)."""
    v = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(v) if isinstance(v, int) else int(v.toString())


def broadcast_limit(spark: SparkSession) -> int:
    """The session's broadcast threshold in bytes; 0 when broadcasts are off
    (the fallback of 10 MB only when the setting is unreadable)."""
    try:
        return max(0, int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()))
    except Exception:
        return FALLBACK_BROADCAST_BYTES


def sized_broadcast(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Broadcast hint only when the optimizer's estimate is under the bound
    (default: the session's ``autoBroadcastJoinThreshold``).

    Above the bound, or with broadcasts turned off in the session, the frame
    is returned unchanged and the planner keeps a shuffle join (sort-merge,
    with AQE skew splitting).
    """
    try:
        limit = broadcast_limit(df.sparkSession)
        if limit and max_bytes is not None:
            limit = max_bytes
        size = estimated_bytes(df)
    except Exception:  # statistics unavailable (e.g. remote session)
        return df
    return F.broadcast(df) if limit and 0 <= size <= limit else df


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared checkpoint folder and read back.

    For small aggregates that are joined to their own large input: the
    estimate of an aggregate is its input's size, the written table has its
    true one, so :func:`sized_broadcast` can decide. Runs a job.
    """
    path = checkpoint_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_null_safe(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Join on ``cols`` where NULL equals NULL; their left values are kept."""
    for i, c in enumerate(cols):
        right = right.withColumnRenamed(c, f"_tw_key{i}")
    on = F.lit(True)
    for i, c in enumerate(cols):
        on = on & left[c].eqNullSafe(right[f"_tw_key{i}"])
    return left.join(right, on, how).drop(*[f"_tw_key{i}" for i in range(len(cols))])


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Parallelism floor for narrow inputs.

    A scan of a few unsplittable files (one Parquet row group each) gives
    fewer tasks than there are cores, and all per-row work before the first
    shuffle then runs on those few. When ``df`` is such a narrow plan (no
    exchange, no subquery) with fewer than half of ``min_partitions``
    (default: the session's default parallelism) partitions, it is
    round-robin repartitioned to ``min_partitions``. Plans that already
    shuffle are left alone, so counting partitions never runs a job; on a
    large lake a scan has thousands of splits and this is a no-op.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    try:
        plan = df._jdf.queryExecution().executedPlan()
        text = plan.toString()
        if "Exchange" in text or "Subquery" in text or "AdaptiveSparkPlan" in text:
            return df
        n = plan.execute().getNumPartitions()
    except Exception:
        return df
    return df.repartition(target) if n * 2 <= target else df


def ship_by_value(module_name: str) -> None:
    """Pickle the functions of ``module_name`` by value when they are sent to
    Python workers (pandas UDFs, ``mapInPandas``), so executors need not have
    this package installed."""
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[module_name])
    except Exception:  # older cloudpickle: workers must import the package
        pass
