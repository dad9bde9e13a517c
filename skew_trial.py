"""Time ordered operators where one key holds a third of all rows, cut and not cut.

Usage: python skew_trial.py [million rows]
The rows are derived from the given events, copied with shifted times and ids.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from rillmark.operators.aggregates import running_count
from rillmark.operators.ordered import KNOWN_SMALL
from rillmark.operators.patterns import consecutive_times
from rillmark.operators.windows import session
from rillmark.session import build_session, shared_folder


def main() -> None:
    millions = int(sys.argv[1]) if len(sys.argv) > 1 else 10
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("skew", f"local[{cpus}]", spark__sql__shuffle__partitions="32", spark__ui__enabled="false",
                          spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    events = spark.read.parquet(os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1") + "/events.parquet")
    copies = millions * 1_000_000 // events.count()
    path = shared_folder(spark, "skew")
    hot = F.when(F.hash("event_id", "copy") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id"))
    (
        events.repartition(16)
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        .select(
            hot.cast("bigint").alias("user_id"),
            (F.col("event_id") * copies + F.col("copy")).alias("event_id"),
            (F.col("ts").cast("timestamp") + F.expr("make_interval(0, 0, 0, 0, 0, copy)")).alias("ts"),
            "event_type",
        )
        .write.parquet(path)
    )
    table = spark.read.parquet(path)
    error = F.col("event_type") == "error"
    runs = {
        "running_count": lambda limit: running_count(
            table.select("user_id", "event_id"), key="user_id", order="event_id", slice_rows=limit
        ),
        "consecutive_times": lambda limit: consecutive_times(
            table.select("user_id", "event_id", "event_type"), key="user_id", order="event_id", condition=error,
            times=3, value="event_id", slice_rows=limit,
        ),
        "session": lambda limit: session(table, ts="ts", gap="1 second", key="user_id", slice_rows=limit),
    }
    out = {"rows": copies * events.count(), "cpus": int(cpus)}
    for name, run in runs.items():
        for label, limit in (("one_task_per_key", KNOWN_SMALL), ("cut", 200_000)):
            run(limit).write.format("noop").mode("overwrite").save()
            start = time.perf_counter()
            run(limit).write.format("noop").mode("overwrite").save()
            out[f"{name}_{label}"] = round(time.perf_counter() - start, 2)
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
