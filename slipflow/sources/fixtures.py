"""Registry tables derived from the generated TPC-H-style test tables.

Each definition follows FIXTURES.md part B: nations play divisions and departments, suppliers
play sub-departments, customers play facilities (not divisible by 3) and master policies
(divisible by 3), orders play documents. Every row of the source tables is used; the ``%``
expressions below only shape values (versions, folder numbers, names), they never drop rows
except to split customers into the two contract kinds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import Registry, conform

# Fixed fixture values (FIXTURES.md part B).
BUSINESS_OBJECTS = [("P", "Master Policy"), ("F1", "Facility A"), ("F2", "Facility B")]
FACILITY_TYPES = [(1, "F1"), (2, "F2")]
FOLDERS = [
    (0, 44, "Placing", "sec0", ""),
    (1, 60, "Signed", "sec1", None),
    (2, 97, "Signing", "sec2", "/a/b"),
    (3, 52, "Quote", None, ""),
    (4, 83, "Other", "sec4", "/c"),
    (5, 1, "Skip", "sec5", "/d"),
    (6, 60, "Signed", "sec6", "/e/f"),
]
STATUSES = [(1, "Exists"), (2, "Deleted")]
NBSP = "\u00a0"
# Document names by o_orderkey % 23 (index 22 is a NULL name).
DOCUMENT_NAMES = [
    "MRC Slip", "Signed Slip", "Contract v2", "London Market MRC", "Final wording", "Final",
    "Slip", "Scan", "FOS", "Policy", "Cover note", "Binder MRC", "CONTRACT", "slip final", "Sign",
    "Client Contract", "Quote Slip", "Endt Slip", "Declaration MRC", "MRC xs", "Misc",
    "Placing slip", None,
]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(key, mapping: dict, default=None):
    out = None
    for k, v in mapping.items():
        cond = key == F.lit(k)
        val = v if isinstance(v, Column) else F.lit(v)
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out.otherwise(default if default is not None else F.lit(None))


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def _small(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A fixed lookup table as an inline ``VALUES`` relation (planned in the JVM, no Python
    scan), with the column types of ``schema``."""
    cols = [c.strip().split() for c in schema.split(",")]
    body = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    names = ", ".join(n for n, _ in cols)
    casts = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in cols)
    return spark.sql(f"SELECT {casts} FROM VALUES {body} AS t({names})")


def divisions(spark, sf_dir):
    n = _read(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    # division 1 has settings for version 0 and for a NULL version: both match version 0
    twice = F.when(k == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    n = n.withColumn("_copy", F.explode(twice))
    return n.select(
        k.alias("DivisionID"),
        F.when(F.col("_copy") == 0, _case(k % 4, {0: F.lit(None).cast("int"), 1: 0}, F.lit(1))).alias("Version"),
        F.concat(F.when(F.col("_copy") == 0, F.lit("http://srv")).otherwise(F.lit("http://alt")),
                 F.col("n_regionkey").cast("string")).alias("Server"),
        F.concat(F.lit("sites/"), F.col("n_name"), F.lit("/ws")).alias("WorkSpace"),
        F.lit("Docs").alias("DocumentDocLibrary"),
        F.when(k == 7, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("p"), k.cast("string"))).alias("DocumentPath"),
    )


def departments(spark, sf_dir):
    """Nations; one department has an empty name and one a name of digits."""
    k = F.col("n_nationkey")
    return _read(spark, sf_dir, "nation").select(
        k.alias("DepartmentID"), F.when(k == 3, F.lit("")).when(k == 5, F.lit("007"))
        .otherwise(F.col("n_name")).alias("DepartmentName"))


def sub_departments(spark, sf_dir):
    return _read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("SubDepartmentID"), F.col("s_name").alias("Name"))


def _contract_common(c):
    k = F.col("c_custkey")
    # some contracts incept at nine in the morning, also on the boundary day of the selection
    inception = F.make_timestamp_ntz((F.lit(1994) + k % 5).cast("int"), (F.lit(1) + k % 12).cast("int"), F.lit(1),
                                     F.when(k % 120 == 6, F.lit(9)).otherwise(F.lit(0)), F.lit(0), F.lit(0))
    return k, inception


def facility(spark, sf_dir):
    c = _read(spark, sf_dir, "customer")
    k, inception = _contract_common(c)
    return c.where(k % 3 != 0).select(
        k.alias("FacilityID"),
        # references with no-break spaces, as Latin-1 text holds them; blank and missing ones
        F.when(k % 13 == 0, F.concat(F.lit("FAC" + NBSP), k.cast("string")))
        .when(k % 17 == 0, F.concat(F.lit(NBSP + " FAC "), k.cast("string")))
        .when(k % 19 == 0, F.lit(NBSP + "  "))
        .when(k % 23 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("FAC "), k.cast("string"))).alias("FacilityRef"),
        F.when(k % 41 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("B"), (k % 500).cast("string"))).alias("UniqueMarketRef"),
        inception.alias("InceptionDate"),
        F.col("c_nationkey").alias("DepartmentID"),
        (k % 11).alias("SubDepartmentID"),
        (k % 3).cast("int").alias("TypeFacility"),
    )


def master_policy(spark, sf_dir):
    c = _read(spark, sf_dir, "customer")
    k, inception = _contract_common(c)
    return c.where(k % 3 == 0).select(
        k.alias("PolicyID"),
        F.concat(F.lit("POL "), k.cast("string")).alias("PolicyRef"),
        F.concat(F.lit("P"), (k % 500).cast("string")).alias("UniqueMarketRef"),
        inception.alias("InceptionDate"),
        F.col("c_nationkey").alias("DepartmentID"),
        (k % 11).alias("SubDepartmentID"),
    )


def docs(spark, sf_dir):
    o = _read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    cust = F.col("o_custkey")
    doc_id = k.cast("string")
    file_name = _case(k % 5, {
        0: F.concat(F.lit("/"), doc_id, F.lit(".v1.docx")),
        1: F.concat(F.lit("/"), doc_id, F.lit(".PDF")),
        2: F.lit("/noext"),
    }, F.concat(F.lit("/x/"), doc_id, F.lit(".a.pdf")))
    root_code = (F.when(k % 53 == 0, F.lit("X"))
                 .when(cust % 3 == 0, F.lit("P"))
                 .otherwise(F.concat(F.lit("F"), (cust % 3).cast("string"))))
    names = {i: F.lit(n).cast("string") for i, n in enumerate(DOCUMENT_NAMES)}
    # some documents are named by a policy reference, in another case and with a blank behind
    names[20] = F.when(k % 2 == 0, F.concat(F.lit("pol "), (3 * (k % 40 + 1)).cast("string"), F.lit(" "))) \
        .otherwise(F.lit(DOCUMENT_NAMES[20]))
    return o.select(
        k.alias("DocumentID"),
        cust.alias("RootObjectID"),
        root_code.alias("RootObjectCode"),
        (k % 7).cast("int").alias("FolderID"),
        (k % 26).cast("int").alias("DepartmentID"),
        _case(k % 3, {0: F.lit(None).cast("int"), 1: 0}, F.lit(1)).alias("SettingsVersion"),
        F.when(k % 11 == 0, F.lit(2)).otherwise(F.lit(1)).alias("DocumentSystemStatusID"),
        _case(k % 23, names).alias("DocumentName"),
        file_name.alias("FileName"),
        _case(k % 17, {0: F.lit(None).cast("int"), 1: 0, 2: 123}, (k % 17).cast("int")).alias("FolderNumber"),
        F.concat(F.lit("D"), doc_id).alias("DocNumber"),
        F.col("o_orderdate").alias("CreateDate"),
        F.col("o_orderstatus").alias("UserName"),
    )


# Two registries that share the tables but not the documents: each holds one half of them, and
# the second lacks an optional column.
HALVES = {"registry_a": 0, "registry_b": 1}


def fixture_registry(spark: SparkSession, sf_dir: str, source: str = "default") -> Registry:
    """All documents, or for the sources of ``HALVES`` the half of them that this source holds."""
    held = docs(spark, sf_dir)
    if source in HALVES:
        held = held.where(F.col("DocumentID") % 2 == HALVES[source])
        if HALVES[source]:
            held = held.drop("UserName")
    tables = {
        "divisions": divisions(spark, sf_dir),
        "departments": departments(spark, sf_dir),
        "sub_departments": sub_departments(spark, sf_dir),
        "business_objects": _small(spark, BUSINESS_OBJECTS, "ObjectCode string, ObjectName string"),
        "facility_types": _small(spark, FACILITY_TYPES, "FacilityTypesID int, Code string"),
        "facility": facility(spark, sf_dir),
        "master_policy": master_policy(spark, sf_dir),
        "folders": _small(spark, FOLDERS, "FolderID int, FolderTypeID int, FolderType string, "
                                          "SectionKey string, FolderPath string"),
        "statuses": _small(spark, STATUSES, "DocumentSystemStatusID int, StatusName string"),
        "docs": held,
    }
    return Registry(**{n: conform(df, n) for n, df in tables.items()}, source=source)
