"""A registry stored by contract key: documents and contracts in buckets, written once.

Documents and contracts are bucketed by (object id, folded object code) into the same number of
buckets. The contract join and the ranking window that follows it then read buckets against buckets:
neither needs an exchange, in any later run. The lookups are stored beside them as they are.

Spark's session catalog keeps the bucketing, not the files, so ``load_stored`` declares the tables
anew over the same folder; ``layout`` there tells how they were written. Documents are readable
without their buckets as well (``Registry.plain_docs``), so the documents of a hot contract, which all
lie in one bucket, are read and numbered by many tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SelectionConfig
from ..operators.priority import CONTRACT_KEYS, contract_side, with_contract_code
from .registry import Registry, conform

KEYS = {"docs": CONTRACT_KEYS, "contracts": ["ObjectID", "_ocode"]}
BYTES_PER_BUCKET = 1 << 30


def _declare(spark: SparkSession, path: str, name: str, buckets: int) -> DataFrame:
    """The bucketed table in ``path`` under a catalog name of its own."""
    table = f"stored_{name}_{uuid.uuid4().hex}"
    files = f"{path}/{name}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(files).schema.fields)
    by = ", ".join(KEYS[name])
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
              f"INTO {buckets} BUCKETS LOCATION '{files}'")
    return spark.table(table)


def store_by_contract(reg: Registry, cfg: SelectionConfig, path: str, buckets: int) -> None:
    """Write ``reg`` below ``path``: documents and contracts in ``buckets`` buckets by contract key,
    sorted in them, every other table as it is. ``buckets`` follows the bytes, about one for each
    ``BYTES_PER_BUCKET``. One file a bucket: rows are dealt as the buckets are before they are written."""
    spark = reg.docs.sparkSession
    path = path.rstrip("/")
    frames = {"docs": with_contract_code(reg.docs, cfg), "contracts": contract_side(reg, cfg)}
    for name, df in frames.items():
        table = f"storing_{name}_{uuid.uuid4().hex}"
        (df.repartition(buckets, *KEYS[name]).write.mode("overwrite").bucketBy(buckets, *KEYS[name])
         .sortBy(*KEYS[name]).option("path", f"{path}/{name}").format("parquet").saveAsTable(table))
        spark.sql(f"DROP TABLE {table}")  # an external table: the files stay
    for name in Registry.table_names():
        if name != "docs":
            reg.table(name).write.mode("overwrite").parquet(f"{path}/{name}")
    spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(cfg.case_sensitive).alias("case_sensitive")) \
        .write.mode("overwrite").parquet(f"{path}/layout")


def load_stored(spark: SparkSession, path: str, cfg: SelectionConfig, source: str = "default") -> Registry:
    """The registry that ``store_by_contract`` wrote below ``path``."""
    path = path.rstrip("/")
    layout = spark.read.parquet(f"{path}/layout").first()
    if layout["case_sensitive"] != cfg.case_sensitive:
        raise ValueError("the stored codes are folded under another collation than this configuration's")
    tables = {n: conform(spark.read.parquet(f"{path}/{n}"), n) for n in Registry.table_names() if n != "docs"}
    return Registry(**tables, source=source, docs=_declare(spark, path, "docs", layout["buckets"]),
                    plain_docs=spark.read.parquet(f"{path}/docs"),
                    stored_contracts=_declare(spark, path, "contracts", layout["buckets"]))
