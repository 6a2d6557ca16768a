"""Registry sources: Parquet layout round trip, schema conformance, Latin-1 decoding."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slipflow.config import FIXTURE
from slipflow.operators import selection
from slipflow.sources.fixtures import fixture_registry
from slipflow.sources.encoding import decode_latin1
from slipflow.sources.registry import SCHEMAS, Registry, conform, load_parquet


def test_parquet_registry_round_trip(spark, tmp_path):
    """Write the fixture registry in the deployment layout, load it back, same selection."""
    reg = fixture_registry(spark, "/root/testdata/sf0.001")
    for name in Registry.table_names():
        reg.table(name).write.parquet(str(tmp_path / f"{name}.parquet"))
    loaded = load_parquet(spark, str(tmp_path), source="registry_a")
    assert loaded.source == "registry_a"
    for name in Registry.table_names():
        assert loaded.table(name).schema == SCHEMAS[name]
    a = selection.selected_documents(reg, FIXTURE, ordered=False)
    b = selection.selected_documents(loaded, FIXTURE, ordered=False)
    assert a.count() == 37 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_conform_adds_missing_optional_columns_and_ignores_extra(spark):
    df = spark.createDataFrame([(1, "Marine", "secret")], "departmentid int, DepartmentName string, pwd string")
    out = conform(df, "departments")
    assert out.columns == ["DepartmentID", "DepartmentName"]
    cols = [f for f in SCHEMAS["docs"].fields if f.name not in ("TemplateID", "UserName")]
    partial = spark.createDataFrame([tuple([None] * len(cols))], T.StructType(cols))
    docs = conform(partial, "docs")
    assert docs.first()["UserName"] is None and docs.schema == SCHEMAS["docs"]
    with pytest.raises(ValueError, match="FolderID"):
        conform(partial.drop("FolderID"), "docs")


def test_latin1_decoding(spark):
    df = spark.createDataFrame([(bytearray(b"caf\xe9 na\xefve"),)], "b binary")
    assert df.select(decode_latin1(F.col("b")).alias("t")).first()["t"] == "café naïve"


def test_read_latin1_text_lines(spark, tmp_path):
    from slipflow.sources.encoding import read_latin1_text
    (tmp_path / "a.txt").write_bytes(b'caf\xe9 "x", y\n  na\xefve \n')
    (tmp_path / "b.txt").write_bytes(b"one\n\n   \ntwo\x00tail\nthree\xa0\n")
    assert sorted(r["value"] for r in read_latin1_text(spark, str(tmp_path)).collect()) == sorted(
        ['café "x", y', "  naïve ", "one", "", "   ", "two\x00tail", "three\xa0"])


def test_jdbc_options_read_only_needed_columns_in_parallel():
    from slipflow.sources.registry import jdbc_options
    opts = jdbc_options("jdbc:sqlserver://host;databaseName=x", "docs", table="dbo.Documents",
                        properties={"user": "u"}, partition_column="DocumentID", lower_bound=1, upper_bound=10_000_000,
                        num_partitions=200)
    assert opts["dbtable"].startswith("(SELECT DocumentID, RootObjectID, RootObjectCode, FolderID")
    assert "FROM dbo.Documents) AS t" in opts["dbtable"] and opts["preferTimestampNTZ"] == "true"
    assert (opts["partitionColumn"], opts["numPartitions"], opts["user"]) == ("DocumentID", "200", "u")
    divisions = jdbc_options("jdbc:x", "divisions")["dbtable"]
    assert "Password" not in divisions and "partitionColumn" not in jdbc_options("jdbc:x", "divisions")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "docs", partition_column="DocumentID")
    for large in ("docs", "facility", "master_policy"):  # never over one connection
        with pytest.raises(ValueError, match="partition_column"):
            jdbc_options("jdbc:x", large)


def test_jdbc_does_not_ask_for_optional_columns_the_source_lacks():
    from slipflow.sources.registry import jdbc_options
    bounds = dict(partition_column="FacilityID", lower_bound=1, upper_bound=9, num_partitions=2)
    have = ["facilityid", "FacilityRef", "UniqueMarketRef", "InceptionDate", "DepartmentID", "SubDepartmentID",
            "TypeFacility"]
    query = jdbc_options("jdbc:x", "facility", columns=have, **bounds)["dbtable"]
    assert "ExpiryDate" not in query and "BrokerID" not in query and "FacilityID" in query
    missing = jdbc_options("jdbc:x", "facility", columns=["FacilityID"], **bounds)["dbtable"]
    assert "TypeFacility" in missing  # a required column is asked for and fails at the source
