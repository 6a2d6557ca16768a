"""Small hand-written registries for unit tests (FIXTURES.md part C)."""

from __future__ import annotations

import datetime as dt

from slipflow.config import FIXTURE
from slipflow.sources.registry import SCHEMAS, Registry, conform

CFG = FIXTURE

DEFAULTS = {
    "divisions": [dict(DivisionID=1, Version=None, Server="http://srv", WorkSpace="sites/a/b",
                       DocumentDocLibrary="L", DocumentPath="p")],
    "departments": [dict(DepartmentID=1, DepartmentName="Marine"),
                    dict(DepartmentID=2, DepartmentName="Aviation")],
    "sub_departments": [dict(SubDepartmentID=1, Name="Sub")],
    "business_objects": [dict(ObjectCode="P", ObjectName="Master Policy"),
                         dict(ObjectCode="F1", ObjectName="Facility A")],
    "facility_types": [dict(FacilityTypesID=1, Code="F1")],
    "facility": [],
    "master_policy": [dict(PolicyID=100, PolicyRef="POL 100", UniqueMarketRef="UMR100",
                           InceptionDate=dt.date(1998, 1, 1), DepartmentID=1, SubDepartmentID=1)],
    "folders": [dict(FolderID=60, FolderTypeID=60, FolderType="Signed", SectionKey="s", FolderPath="/f"),
                dict(FolderID=44, FolderTypeID=44, FolderType="Placing", SectionKey="s", FolderPath="/g"),
                dict(FolderID=52, FolderTypeID=52, FolderType="Quote", SectionKey="s", FolderPath="/q")],
    "statuses": [dict(DocumentSystemStatusID=1, StatusName="Exists")],
}


def doc(doc_id, name, *, folder=60, file_name=None, root=100, code="P", dept=1, created=None,
        version=None, number=None, status=1):
    return dict(DocumentID=doc_id, RootObjectID=root, RootObjectCode=code, FolderID=folder,
                DepartmentID=dept, SettingsVersion=version, DocumentSystemStatusID=status,
                DocumentName=name, FileName=file_name if file_name is not None else f"/{doc_id}.pdf",
                FolderNumber=number, DocNumber=f"D{doc_id}",
                CreateDate=created or dt.datetime(1999, 1, 1))


def frame(spark, name, rows):
    schema = SCHEMAS[name]
    def value(v):  # dates stand for midnight
        return dt.datetime(v.year, v.month, v.day) if type(v) is dt.date else v

    data = [tuple(value(r.get(f.name)) for f in schema.fields) for r in rows]
    return conform(spark.createDataFrame(data, schema), name)


def registry(spark, docs, **overrides) -> Registry:
    tables = {n: frame(spark, n, overrides.get(n, rows)) for n, rows in DEFAULTS.items()}
    tables["docs"] = frame(spark, "docs", docs)
    return Registry(**tables)
