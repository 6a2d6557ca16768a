"""Writing of landed files: a folder per department and one in it per landing folder, one file in each.

Landing folders are small and many. Spark's file writer gives every one a folder of the attempt, a
folder of the task and the final one, and the driver renames them one by one; here a task writes the
file of a folder where it belongs, as a task that fetches documents does. All lines of a folder meet in one
task, so a folder gets one file, however many tasks the rows come from.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .listing import _resolve

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name of a missing value
FOLDER = ["department_key", "folder_num"]


def write_landing(lines: DataFrame, root: str, suffix: str) -> int:
    """Write the lines ``value`` of every folder (``department_key``, a name without a slash, and
    ``folder_num``) to one new file of it below ``root``, whose name ends in ``suffix``; returns how many
    files there are. Files of earlier calls stay.

    A file is written under a hidden name of the attempt, which no listing sees, and renamed when it is
    whole. A repeated task sorts the same lines into files of the same names, so nothing lands twice.
    """
    name = f"lines-{uuid.uuid4().hex}{suffix}"

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, path, _ = _resolve(root)
        attempt, written, at, out = TaskContext.get().taskAttemptId(), 0, None, None

        def end() -> int:
            if out is None:
                return 0
            out.close()
            files.move(f"{at}/.{attempt}-{name}", f"{at}/{name}")
            return 1

        rows = (r for b in batches for r in zip(b["department"], b["folder"], b["value"]))
        for (department, folder), some in groupby(rows, key=lambda r: r[:2]):
            written += end()
            at = f"{path.rstrip('/')}/department_key={department}/folder_num={folder}"
            files.create_dir(at, recursive=True)
            out = files.open_output_stream(f"{at}/.{attempt}-{name}")
            for _, _, value in some:
                out.write(f"{value}\n".encode())
        written += end()
        yield pd.DataFrame({"files": [written]})

    # the work is the number of files and not their bytes: as many tasks as the session's shuffles have
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [F.coalesce(F.col(c).cast("string"), F.lit(NO_VALUE)).alias(a) for c, a in zip(FOLDER, ("department", "folder"))]
    dealt = lines.select(*names, F.coalesce("value", F.lit("")).alias("value")).repartition(tasks, "department", "folder") \
        .sortWithinPartitions("department", "folder", "value")
    return dealt.mapInPandas(write, "files long").agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]
