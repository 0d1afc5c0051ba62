"""Headline queries, timed. Prints one JSON line.

The large tables are first written anew in files of ``ROWS_PER_FILE`` rows, as a table that grew
by loads has them: a file of one row group is read by one task, and its time is that of one core.
``BENCH_COPIES=10`` writes them that many times over, with keys of their own, and with a third of
all lines on one order and a third of all orders on one customer.

Each query runs once to warm up; the value is the median of the runs behind it, with
every row written to the ``noop`` sink. Tables that a warehouse keeps are built once per
session and timed as queries of their own (``build_*``, one run). ``detail`` has, for each
query, the exchanges of its plan, and from Spark's event log the megabytes shuffled and
spilled in its last run and the rows it read from tables each second.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import tempfile
import time
from collections import defaultdict

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from starlane.session import local_session
from starlane.workload import tables
from starlane.workload.queries import QUERIES

HEADLINES = (
    "fact_rentals",
    "fact_customer_as_of",
    "scd2_apply",
    "scd2_history",
    "kpi_revenue_by_car",
    "kpi_tickets_by_segment",
    "chk_fk_orphans",
    "chk_unresolved_lookups",
)
BUILDS = {"build_fact": tables.fact, "build_customer_dim": tables.customer_dim_early}


ROWS_PER_FILE = 50_000
GROWING, FIXED = ("lineitem", "orders"), ("region", "nation", "customer", "supplier", "part")


def spread_tables(spark: SparkSession, sf_dir: str, copies: int) -> str:
    """A folder with the same tables, the large ones in many files and ``copies`` times over."""
    out = tempfile.mkdtemp(prefix="bench-tables-")
    for name in FIXED:
        os.symlink(f"{sf_dir}/{name}.parquet", f"{out}/{name}.parquet")
    for name in GROWING:
        rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        key = {"lineitem": "l_orderkey", "orders": "o_orderkey"}[name]
        if copies > 1:
            step = spark.read.parquet(f"{sf_dir}/orders.parquet").agg(F.max("o_orderkey")).first()[0] + 1
            rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
            rows = rows.withColumn(key, F.col(key) + F.col("copy") * step).drop("copy")
            if name == "lineitem":
                rows = rows.withColumn(key, F.when(F.xxhash64("*") % 3 == 0, F.lit(1)).otherwise(F.col(key)))
            else:
                rows = rows.withColumn("o_custkey", F.when(F.col(key) % 3 == 0, F.lit(4)).otherwise(F.col("o_custkey")))
            rows = rows.repartition(copies * 4)
        rows.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(f"{out}/{name}.parquet")
    return out


def moved(folder: str) -> dict[str, dict[str, float]]:
    """Shuffle, spill and rows read of each job group, from the event log."""
    group_of: dict[int, str] = {}
    out: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    for path in glob.glob(f"{folder}/*"):
        with open(path, encoding="utf-8") as log:
            for event in map(json.loads, log):
                if event["Event"] == "SparkListenerJobStart":
                    group = (event.get("Properties") or {}).get("spark.jobGroup.id")
                    group_of |= {stage: group for stage in event["Stage IDs"] if group}
                elif event["Event"] == "SparkListenerTaskEnd" and event["Stage ID"] in group_of:
                    found, metrics = out[group_of[event["Stage ID"]]], event.get("Task Metrics") or {}
                    found["shuffle_mb"] += metrics.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0) / 1e6
                    found["spill_mb"] += metrics.get("Disk Bytes Spilled", 0) / 1e6
                    found["rows_read"] += metrics.get("Input Metrics", {}).get("Records Read", 0)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    copies = int(os.environ.get("BENCH_COPIES", "1"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINES)).split(",")
    events = tempfile.mkdtemp(prefix="bench-events-")
    spark = local_session(cpus, shuffle_partitions=8, **{
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{events}",
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
    })

    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    sf_dir = spread_tables(spark, sf_dir, copies)

    def timed(action) -> float:
        begin = time.perf_counter()
        action()
        return time.perf_counter() - begin

    def run(name: str, group: str) -> None:
        spark.sparkContext.setJobGroup(group, name)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds = {name: round(timed(lambda b=build: b(spark, sf_dir)), 3) for name, build in BUILDS.items()}
    detail = {}
    for name in names:
        run(name, "warm-up")
        times = [timed(lambda k=k: run(name, name if k == runs - 1 else "timed")) for k in range(runs)]
        seconds[name] = round(statistics.median(times), 3)
        spark.sparkContext.setJobGroup("plan", name)
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        detail[name] = {"exchanges": plan.count("Exchange "), "slowest_sec": round(max(times), 3)}
    spark.stop()
    for name, found in moved(events).items():
        if name in detail:
            detail[name] |= {k: round(v, 1) for k, v in found.items() if k != "rows_read"}
            detail[name]["rows_per_sec"] = round(found["rows_read"] / seconds[name])
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds[n] for n in names), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf,
        "copies": copies,
        "detail": detail,
        "runs": runs,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
