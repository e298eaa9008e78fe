"""Print the README's shuffle table: per batch query, the non-broadcast
exchanges of its physical plan (automatic broadcast off, as for big tables).

usage: python tools/plan_table.py [sf_dir]
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillstream.plans.catalog import BATCH_QUERIES  # noqa: E402
from tillstream.session import build_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name, fn in BATCH_QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        keys = []
        for m in re.finditer(r"Exchange (hashpartitioning\((.*?), \d+\)|SinglePartition)", plan):
            keys.append("(" + re.sub(r"#\d+L?", "", m.group(2)) + ")" if m.group(2) else "single")
        print(f"| `{name}` | {len(keys)} | {', '.join(keys)} | {plan.count('BroadcastExchange')} |")


if __name__ == "__main__":
    main()
