"""Contracts: facilities and master policies, each joined to their dimensions and stacked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SelectionConfig
from ..sources.registry import Registry
from .joins import dimension, join_on_constant, key_text, small_rows

# The 13 contract columns of both branches, in this order (stacked by position).
CONTRACT_COLUMNS = [
    "ObjectID", "ObjectCode", "ObjectName", "Reference", "UniqueMarketRef", "InceptionDate",
    "ExpiryDate", "CreateDate", "DepartmentID", "DepartmentName", "SubDepartmentID",
    "SubDepartmentName", "BrokerID",
]

POLICY_CODE = "P"


def facility_contracts(reg: Registry, cfg: SelectionConfig) -> DataFrame:
    cs = cfg.case_sensitive
    f = reg.facility
    ft = dimension(reg.facility_types).select(
        "FacilityTypesID", key_text(F.col("Code"), cs).alias("_code"))
    bo = dimension(reg.business_objects).select(
        "ObjectCode", "ObjectName", key_text(F.col("ObjectCode"), cs).alias("_code"))
    dept = dimension(reg.departments).select("DepartmentID", "DepartmentName")
    sub = dimension(reg.sub_departments).select(
        "SubDepartmentID", F.col("Name").alias("SubDepartmentName"))
    j = (f.join(ft, f["TypeFacility"] == ft["FacilityTypesID"])
         .join(bo, "_code")
         .join(dept, "DepartmentID")
         .join(sub, "SubDepartmentID"))
    out = j.withColumnsRenamed({"FacilityID": "ObjectID", "FacilityRef": "Reference"})
    return out.select(*CONTRACT_COLUMNS)


def policy_contracts(reg: Registry, cfg: SelectionConfig) -> DataFrame:
    """Master policies; the business object comes from a constant condition (code ``P``), so
    each policy is repeated once per matching business-object row."""
    cs = cfg.case_sensitive
    p = reg.master_policy
    code = POLICY_CODE if cs else POLICY_CODE.lower()
    bo = reg.business_objects.where(key_text(F.col("ObjectCode"), cs) == F.lit(code)) \
        .select("ObjectCode", "ObjectName")
    dept = dimension(reg.departments).select("DepartmentID", "DepartmentName")
    sub = dimension(reg.sub_departments).select(
        "SubDepartmentID", F.col("Name").alias("SubDepartmentName"))
    rows = small_rows(bo, cache_on=reg.business_objects, key=(POLICY_CODE, cs))
    j = join_on_constant(p.join(dept, "DepartmentID"), bo, inline=rows)
    j = j.join(sub, "SubDepartmentID")
    out = j.withColumnsRenamed({"PolicyID": "ObjectID", "PolicyRef": "Reference",
                                "BrokerProducerID": "BrokerID"})
    return out.select(*CONTRACT_COLUMNS)


def contract_objects(reg: Registry, cfg: SelectionConfig) -> DataFrame:
    """Both contract kinds stacked by position (UNION ALL; duplicates kept)."""
    return facility_contracts(reg, cfg).union(policy_contracts(reg, cfg))
