"""Run by test_recovery.py in its own process (task retries need their own master)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from quarry.plans import revenue, standins  # noqa: E402
from quarry.session import ensure_checkpoint_dir  # noqa: E402
from quarry.sources.tables import table  # noqa: E402

data_dir = sys.argv[1]
spark = (
    SparkSession.builder.master("local[4,3]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
ensure_checkpoint_dir(spark)


def fail_first_attempt(batches):
    ctx = TaskContext.get()
    if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    yield from batches


orders = table(spark, data_dir, "orders")
flaky_orders = orders.mapInPandas(fail_first_attempt, orders.schema)


def answers(o):
    joined = standins.stays_with_income(spark, data_dir, orders=o).checkpoint(eager=True)
    out = {}
    for name, df in {
        "in_f": revenue.revenue_in(joined, "F"),
        "top": revenue.top_revenue(joined, 100),
        "by_city": revenue.revenue_by(joined, ("city",), None),
        "none": revenue.no_revenue(joined),
    }.items():
        out[name] = sorted(tuple(str(x) for x in r) for r in df.collect())
    return out


clean = answers(orders)
retried = answers(flaky_orders)
assert clean == retried, "results differ after a retried task"
print("RECOVERED", sum(len(v) for v in clean.values()))
spark.stop()
