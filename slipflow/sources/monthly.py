"""Documents stored by month of creation, so that a run reads the months it needs.

``created_month`` ("2021-07", or "none" without a date) is the partition column. A bound on the
creation date becomes a bound on the month, which Spark applies before it lists a file (static
pruning); a table of months, known only when the query runs, prunes by the broadcast join with it
(dynamic pruning). Both are implied by the conditions on the date itself, which stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SelectionConfig
from ..operators.joins import dimension
from .registry import SCHEMAS

MONTH = "created_month"
NO_MONTH = "none"
ROWS_PER_FILE = 5_000_000


def month_of(date: Column) -> Column:
    """The month of a zone-less datetime, "none" without one; sorts as the datetimes do."""
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(NO_MONTH))


def store_by_month(docs: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write ``docs`` partitioned by month. Rows are dealt by month and a hash of the id, so a month
    that holds most of them is many tasks' work, and files hold at most ``rows_per_file`` rows."""
    keyed = docs.withColumn(MONTH, month_of(F.col("CreateDate")))
    spread = F.pmod(F.xxhash64("DocumentID"), F.lit(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    (keyed.withColumn("_spread", spread).repartition(MONTH, "_spread").drop("_spread").write.mode("overwrite")
     .option("maxRecordsPerFile", rows_per_file).partitionBy(MONTH).parquet(path))


def load_months(spark: SparkSession, path: str) -> DataFrame:
    """The stored documents with ``created_month``."""
    schema = T.StructType([*SCHEMAS["docs"].fields, T.StructField(MONTH, T.StringType())])
    return spark.read.schema(schema).parquet(path)


def created_before(docs: DataFrame, cfg: SelectionConfig) -> DataFrame:
    """The stored documents of the months up to that of the run's last creation date. Documents
    without a date are in none of them, and no run selects any."""
    last = cfg.created_before.strftime("%Y-%m")
    return docs.where((F.col(MONTH) <= F.lit(last)) & (F.col(MONTH) != F.lit(NO_MONTH)))


def in_months(docs: DataFrame, months: DataFrame, column: str = MONTH) -> DataFrame:
    """The stored documents of the months in ``months`` (one row a month or more): a semi-join by the
    partition column, so only files of these months are read."""
    wanted = dimension(months.select(F.col(column).alias("_month")).distinct())
    return docs.join(wanted, docs[MONTH] == F.col("_month"), "left_semi")
