"""Skew drill: one customer card holds a third of all orders.

Runs the loyalty running total on that data with one time bucket (a plain per-card
window), with buckets of an hour and with even slices; and, with all of the card's rows
at one time, with hours and with slices. Reports, from Spark's event log in a fresh
scratch folder, the largest and median shuffle-read record counts per task of each
stage. Also checks that all give identical results. AQE's
byte thresholds are scaled down to this data size so its split of the hot
customer's join partition shows as well.

usage: python tools/skew_drill.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tillstream.operators import loyalty  # noqa: E402
from tillstream.session import build_session, utc  # noqa: E402
from tillstream.sources import adapters  # noqa: E402
from tillstream.sources.tables import read_table  # noqa: E402


def task_records(log_dir: str, job_group: str) -> dict[int, tuple[str, list[int]]]:
    """Per stage of the given job group: (stage name, shuffle-read records per task)."""
    stages, recs, names = set(), {}, {}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if not os.path.isfile(path):
            continue
        with open(path) as fh:
            events = [json.loads(line) for line in fh]
        for e in events:
            if e["Event"] == "SparkListenerJobStart":
                props = e.get("Properties") or {}
                if props.get("spark.jobGroup.id") == job_group:
                    stages.update(e.get("Stage IDs", []))
        for e in events:
            if e["Event"] == "SparkListenerStageSubmitted":
                info = e["Stage Info"]
                names[info["Stage ID"]] = info.get("Stage Name", "")
            if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in stages:
                m = e.get("Task Metrics") or {}
                r = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                if r:
                    recs.setdefault(e["Stage ID"], []).append(r)
    return {sid: (names.get(sid, ""), r) for sid, r in sorted(recs.items())}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="skew-drill-events-")
    spark = build_session(extra={"spark.eventLog.enabled": "true",
                                 "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.compress": "false",
                                 "spark.eventLog.rolling.enabled": "false",
                                 # small-data versions of the cluster settings, so AQE's
                                 # skew-join split shows at this size
                                 "spark.sql.adaptive.coalescePartitions.enabled": "false",
                                 "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
                                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
                                 "spark.sql.autoBroadcastJoinThreshold": "-1"},
                          shuffle_partitions=16)
    sc = spark.sparkContext
    with utc(spark):
        # the test file is one parquet row group, i.e. one map task; spread it the
        # way a multi-file scan would be, so AQE has map outputs to split
        orders = read_table(spark, sf_dir, "orders").repartition(16)
        hot = orders.select(F.min("o_custkey")).first()[0]
        n_hot = orders.where((F.col("o_orderkey") % 3 == 0) | (F.col("o_custkey") == hot)).count()
        # every third order goes to one card
        skewed = orders.withColumn(
            "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(hot)).otherwise(F.col("o_custkey")))
        at_once = skewed.withColumn("o_orderdate", F.when(
            F.col("o_custkey") != hot, F.col("o_orderdate")).otherwise(F.lit("2024-01-01").cast(
                skewed.schema["o_orderdate"].dataType)))
        results = {}
        for label, of, width in (("one bucket", skewed, 1 << 62),
                                 ("hours", skewed, loyalty.BUCKET_US), ("slices", skewed, None),
                                 ("at once: hours", at_once, loyalty.BUCKET_US),
                                 ("at once: slices", at_once, None)):
            inv = adapters.invoices(spark, sf_dir, lines=False, items=False, address=False,
                                    orders=of)
            sc.setJobGroup(label, label)
            out = loyalty.loyalty_changelog(inv, prime_only=False, bucket_us=width)
            rows = out.select("invoiceNumber", "totalLoyaltyPoints").collect()
            results[label] = {r.invoiceNumber: r.totalLoyaltyPoints for r in rows}
    spark.stop()
    same = (results["one bucket"] == results["hours"] == results["slices"]
            and results["at once: hours"] == results["at once: slices"])
    print(f"hot card holds {n_hot} of {len(results['hours'])} rows; results identical: {same}")
    for label in results:
        print(f"[{label}]")
        for sid, (name, recs) in task_records(log_dir, label).items():
            print(f"  stage {sid:3d} tasks={len(recs):3d} max records/task={max(recs):7d} "
                  f"median={int(statistics.median(recs)):7d}  {name[:60]}")


if __name__ == "__main__":
    main()
