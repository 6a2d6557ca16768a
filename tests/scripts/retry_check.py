"""Run in its own JVM (local[4,4]: tasks may be retried): the first attempt of half the tasks
fails, both in the stage feeding the split numbering's range shuffle and in its final stage, and
the retried tasks must give the same numbers."""

import os
import random
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from slipflow.operators.numbering import number_rows  # noqa: E402


MARKS = tempfile.mkdtemp(prefix="slipflow-retry-marks-")


@F.udf(T.LongType())
def fail_first_attempt(x):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        open(os.path.join(MARKS, f"{ctx.stageId()}-{ctx.partitionId()}"), "w").close()
        raise RuntimeError("injected task failure")
    return x


def main():
    spark = (SparkSession.builder.master("local[4,4]").appName("retry-check")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "6")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="slipflow-retry-"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.4 else f"g{rnd.randrange(20)}", rnd.randrange(30), i) for i in range(3000)]
    # failures also hit the input stage feeding the range shuffle of the slicing job
    df = spark.createDataFrame(rows, "g string, k int, id long").withColumn("id", fail_first_attempt("id"))
    order = [F.col("k").desc(), F.col("id").asc()]
    # expected numbers from plain Python
    want = {}
    for g in {r[0] for r in rows}:
        members = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        want.update({r[2]: i for i, r in enumerate(members)})
    for kw in (dict(strategy="split", num_slices=8), dict(single_task_rows=200, num_slices=8)):
        out = number_rows(df, ["g"], order, "rn", start=0, **kw)
        got = {r["id"]: r["rn"] for r in out.select("id", fail_first_attempt("rn").alias("rn")).collect()}
        assert got == want, kw
    assert len(os.listdir(MARKS)) >= 2, "no task failure was injected"
    print("RETRY_CHECK_OK", len(os.listdir(MARKS)), "failed attempts retried")
    spark.stop()


if __name__ == "__main__":
    main()
