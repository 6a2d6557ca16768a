"""The ten registry tables the selection reads, their schemas, and ways to load them.

A :class:`Registry` holds one DataFrame per source table under neutral names. Deployments read
the tables from Parquet (``load_parquet``) or straight from the registry database over JDBC
(``read_jdbc``, partitioned on an integer key so the read is spread over executors). Tests and
the benchmark derive them from the generated TPC-H-style tables (``sources.fixtures``).
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns the selection needs, per table (secrets and unused settings are never read).
SCHEMAS: dict[str, T.StructType] = {
    "divisions": T.StructType([
        T.StructField("DivisionID", T.IntegerType()),
        T.StructField("Version", T.IntegerType()),
        T.StructField("Server", T.StringType()),
        T.StructField("WorkSpace", T.StringType()),
        T.StructField("DocumentDocLibrary", T.StringType()),
        T.StructField("DocumentPath", T.StringType()),
    ]),
    "departments": T.StructType([
        T.StructField("DepartmentID", T.IntegerType()),
        T.StructField("DepartmentName", T.StringType()),
    ]),
    "sub_departments": T.StructType([
        T.StructField("SubDepartmentID", T.LongType()),
        T.StructField("Name", T.StringType()),
    ]),
    "business_objects": T.StructType([
        T.StructField("ObjectCode", T.StringType()),
        T.StructField("ObjectName", T.StringType()),
    ]),
    "facility_types": T.StructType([
        T.StructField("FacilityTypesID", T.IntegerType()),
        T.StructField("Code", T.StringType()),
    ]),
    "facility": T.StructType([
        T.StructField("FacilityID", T.LongType()),
        T.StructField("FacilityRef", T.StringType()),
        T.StructField("UniqueMarketRef", T.StringType()),
        T.StructField("InceptionDate", T.TimestampNTZType()),
        T.StructField("ExpiryDate", T.TimestampNTZType()),
        T.StructField("CreateDate", T.TimestampNTZType()),
        T.StructField("DepartmentID", T.IntegerType()),
        T.StructField("SubDepartmentID", T.LongType()),
        T.StructField("BrokerID", T.IntegerType()),
        T.StructField("TypeFacility", T.IntegerType()),
    ]),
    "master_policy": T.StructType([
        T.StructField("PolicyID", T.LongType()),
        T.StructField("PolicyRef", T.StringType()),
        T.StructField("UniqueMarketRef", T.StringType()),
        T.StructField("InceptionDate", T.TimestampNTZType()),
        T.StructField("ExpiryDate", T.TimestampNTZType()),
        T.StructField("CreateDate", T.TimestampNTZType()),
        T.StructField("DepartmentID", T.IntegerType()),
        T.StructField("SubDepartmentID", T.LongType()),
        T.StructField("BrokerProducerID", T.IntegerType()),
    ]),
    "folders": T.StructType([
        T.StructField("FolderID", T.IntegerType()),
        T.StructField("FolderTypeID", T.IntegerType()),
        T.StructField("FolderType", T.StringType()),
        T.StructField("SectionKey", T.StringType()),
        T.StructField("FolderPath", T.StringType()),
    ]),
    "statuses": T.StructType([
        T.StructField("DocumentSystemStatusID", T.IntegerType()),
        T.StructField("StatusName", T.StringType()),
    ]),
    "docs": T.StructType([
        T.StructField("DocumentID", T.LongType()),
        T.StructField("RootObjectID", T.LongType()),
        T.StructField("RootObjectCode", T.StringType()),
        T.StructField("FolderID", T.IntegerType()),
        T.StructField("DepartmentID", T.IntegerType()),
        T.StructField("SettingsVersion", T.IntegerType()),
        T.StructField("DocumentSystemStatusID", T.IntegerType()),
        T.StructField("DocumentName", T.StringType()),
        T.StructField("FileName", T.StringType()),
        T.StructField("FolderNumber", T.IntegerType()),
        T.StructField("TemplateID", T.IntegerType()),
        T.StructField("DocNumber", T.StringType()),
        T.StructField("CreateDate", T.TimestampNTZType()),
        T.StructField("UserName", T.StringType()),
    ]),
}

# Columns a query only carries (never joins or filters on): they may be absent from a source and
# then load as typed NULLs. Every other column of SCHEMAS is required.
OPTIONAL_COLUMNS = {
    "facility": {"ExpiryDate", "CreateDate", "BrokerID"},
    "master_policy": {"ExpiryDate", "CreateDate", "BrokerProducerID"},
    "docs": {"TemplateID", "UserName"},
}

# Tables that grow with the data: over JDBC they are read by ranges of a key, never over one connection.
LARGE_TABLES = ("docs", "facility", "master_policy")


@dataclass(frozen=True)
class Registry:
    divisions: DataFrame
    departments: DataFrame
    sub_departments: DataFrame
    business_objects: DataFrame
    facility_types: DataFrame
    facility: DataFrame
    master_policy: DataFrame
    folders: DataFrame
    statuses: DataFrame
    docs: DataFrame
    # Which registry the rows come from (several registries share one schema).
    source: str = "default"
    # The contract columns that documents take, where they are stored by key (``sources.stored``).
    stored_contracts: DataFrame | None = None
    # The same rows as ``docs``, read without their buckets.
    plain_docs: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def with_tables(self, **tables) -> "Registry":
        return replace(self, **tables)

    @classmethod
    def table_names(cls) -> list[str]:
        return [f.name for f in fields(cls) if f.name not in ("source", "stored_contracts", "plain_docs")]


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select and cast the needed columns of table ``name`` (names matched case-insensitively,
    extra columns such as secrets dropped); missing optional columns become typed NULLs.
    Raises ``ValueError`` when a required column is missing."""
    schema = SCHEMAS[name]
    have = {c.lower(): c for c in df.columns}
    missing = [f.name for f in schema.fields
               if f.name.lower() not in have and f.name not in OPTIONAL_COLUMNS.get(name, set())]
    if missing:
        raise ValueError(f"table {name!r} lacks required columns {missing}")
    cols = []
    for f in schema.fields:
        src = have.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(src).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def load_parquet(spark: SparkSession, root: str, source: str = "default") -> Registry:
    """Read ``{root}/{name}.parquet`` for every registry table."""
    return Registry(
        **{n: conform(spark.read.parquet(f"{root}/{n}.parquet"), n) for n in Registry.table_names()},
        source=source,
    )


def jdbc_options(url: str, name: str, *, table: str | None = None, columns: list[str] | None = None,
                 properties: dict | None = None, partition_column: str | None = None,
                 lower_bound: int | None = None, upper_bound: int | None = None,
                 num_partitions: int | None = None, predicates: list[str] | None = None) -> dict:
    """Reader options for one registry table: a subquery of only the needed columns, and, for
    large tables, a range partitioning on an integer key (``num_partitions`` parallel queries).

    ``table`` is the source's table name (default: ``name``). ``columns`` are the columns that the
    source has, so that optional ones it lacks are not asked for (default: all are there).
    Datetimes are read without a time zone, as the registry stores them. The tables of
    ``LARGE_TABLES`` need a ``partition_column`` with its bounds, or ``predicates`` that part them
    (``sources.ranges``).
    """
    have = None if columns is None else {c.lower() for c in columns}
    wanted = [f.name for f in SCHEMAS[name].fields
              if have is None or f.name.lower() in have or f.name not in OPTIONAL_COLUMNS.get(name, set())]
    opts = {"url": url, "dbtable": f"(SELECT {', '.join(wanted)} FROM {table or name}) AS t",
            "preferTimestampNTZ": "true"}
    opts.update(properties or {})
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update({"partitionColumn": partition_column, "lowerBound": str(lower_bound),
                     "upperBound": str(upper_bound), "numPartitions": str(num_partitions)})
    elif name in LARGE_TABLES and not predicates:
        raise ValueError(f"table {name!r} grows with the data: pass partition_column and its bounds, or predicates")
    return opts


def read_jdbc(spark: SparkSession, url: str, name: str, *, table: str | None = None,
              properties: dict | None = None, **partitioning) -> DataFrame:
    """Read one registry table over JDBC, only its needed columns (see ``jdbc_options``). The
    columns that the source has are read from an empty result first."""
    jdbc_options(url, name, **partitioning)  # fail on missing bounds before any connection
    empty = {"url": url, "dbtable": f"(SELECT * FROM {table or name} WHERE 1 = 0) AS t", **(properties or {})}
    columns = spark.read.format("jdbc").options(**empty).load().columns
    opts = jdbc_options(url, name, table=table, columns=columns, properties=properties, **partitioning)
    if partitioning.get("predicates"):  # one query a predicate
        rest = {k: v for k, v in opts.items() if k not in ("url", "dbtable")}
        return conform(spark.read.jdbc(opts["url"], opts["dbtable"], predicates=partitioning["predicates"],
                                       properties=rest), name)
    return conform(spark.read.format("jdbc").options(**opts).load(), name)


def load_jdbc(spark: SparkSession, url: str, *, partitions: dict, tables: dict[str, str] | None = None,
              properties: dict | None = None, source: str = "default") -> Registry:
    """Registry read over JDBC. ``partitions`` maps a table name to its range options, needed for
    every table of ``LARGE_TABLES``; ``tables`` maps a registry table to its name in the source."""
    tables = tables or {}
    return Registry(
        **{n: read_jdbc(spark, url, n, table=tables.get(n), properties=properties, **partitions.get(n, {}))
           for n in Registry.table_names()},
        source=source,
    )
