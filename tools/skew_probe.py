"""Hot-key probe: one key holds a third of all rows.

Runs the skew-sensitive operators on such a table with Spark's event log
written to a scratch folder, then reads the log and reports, per operator,
the largest number of shuffle records any single task read. Map-side
combining keeps that number near (map tasks x keys per reducer); a plan
that ships the hot key's rows to one task shows ~rows/3.

Usage: ``python tools/skew_probe.py [rows] [scratch_dir]`` -> one JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 1_200_000
    scratch = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="skew-")
    logdir = os.path.join(scratch, "events")
    os.makedirs(logdir, exist_ok=True)
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from tidewater.operators import aggregate as A
    from tidewater.operators import keyed as K
    from tidewater.operators import ordering as O
    from tidewater.operators.joins import cost_rollup
    from tidewater.session import get_session

    spark = get_session("skew-probe", master="local[8]", shuffle_partitions=8,
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
                               "spark.eventLog.compress": "false",
                               "spark.sql.adaptive.enabled": "false"})
    # key 0 holds a third of the rows; the rest spread over 10,000 keys
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 10_000 + 1).alias("k"),
        F.col("id"), (F.col("id") % 97).cast("double").alias("v"),
        F.concat(F.lit("t"), (F.col("id") % 5).cast("string")).alias("txt"))
    path = os.path.join(scratch, "skewed")
    base.repartition(8).write.mode("overwrite").parquet(path)
    df = spark.read.parquet(path)
    prices = spark.range(10_001).select(F.col("id").alias("k"), (F.col("id") % 7 + 1).cast("double").alias("p"))

    runs = {
        "upsert_latest_by_key": lambda: K.latest_by_key(df, ["k"], ["id"]),
        "dedup_by_text": lambda: K.dedup_text(df, "txt", "id", keep=["id"]),
        "top3_per_key_row_number": lambda: O.leaderboard(df, ["k"], "v", 3, method="row_number", tie=["id"]),
        "count_by_key": lambda: A.count_by(df, "k"),
        "cost_rollup": lambda: cost_rollup(df, prices, "k", "v", "p", by=["k"]),
        # negative control: a whole-partition window ships every row of the
        # hot key to one task
        "whole_window_control": lambda: df.withColumn("n_in_key", F.count(F.lit(1)).over(Window.partitionBy("k"))),
    }
    for name, fn in runs.items():
        spark.sparkContext.setJobDescription(name)
        fn().write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    spark.stop()

    stage_job: dict[int, str] = {}
    max_read: dict[str, int] = {}
    for f in glob.glob(os.path.join(logdir, "**", "*"), recursive=True):
        if os.path.isdir(f) or os.path.basename(f).startswith("appstatus"):
            continue
        for line in open(f):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                desc = (e.get("Properties") or {}).get("spark.job.description")
                for sid in e.get("Stage IDs", []):
                    stage_job[sid] = desc
            elif ev == "SparkListenerTaskEnd":
                desc = stage_job.get(e.get("Stage ID"))
                m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                rec = int(m.get("Total Records Read", 0))
                if desc:
                    max_read[desc] = max(max_read.get(desc, 0), rec)
    print(json.dumps({"rows": n, "hot_key_rows": n // 3 + (1 if n % 3 else 0),
                      "max_shuffle_records_per_task": max_read}))


if __name__ == "__main__":
    main()
