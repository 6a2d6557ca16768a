"""The flagship selection as SQL text over the registry's views, with named parameters.

The same steps as ``operators.selection``: locations, contracts, documents with their paths, the
priority ladder, the rank per contract, the final filter and the result order. It is what a user
who keeps their own SQL starts from; ``parameters`` binds it to a configuration.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import SelectionConfig
from ..operators.contracts import POLICY_CODE
from ..operators.joins import key_text, small_rows
from ..operators.priority import RANKED_COLUMNS, TIE_BREAK
from ..sources.registry import Registry

_TIES = ", ".join(f"{c} ASC NULLS FIRST" for c in TIE_BREAK)

SELECTED_SQL = r"""
WITH locations AS (
  SELECT DivisionID, coalesce(Version, 0) AS VersionKey,
    regexp_replace(Server, '(?i)http://', '') AS ServerName,
    regexp_replace(WorkSpace, '(?i)sites/', '') AS SiteName,
    '\\' || :sep || regexp_replace(Server, '(?i)http://', '') || :sep || replace(WorkSpace, '/', :sep) || :sep
      || DocumentDocLibrary || :sep || DocumentPath AS LibraryPath,
    concat(Server, '/', WorkSpace, '/', DocumentDocLibrary, '/', DocumentPath) AS LibraryURL
  FROM divisions),
contracts AS (
  SELECT f.FacilityID AS ObjectID, lower(rtrim(b.ObjectCode)) AS Code, f.FacilityRef AS Reference,
    f.UniqueMarketRef, f.InceptionDate, s.Name AS SubDepartmentName
  FROM facility f
  JOIN facility_types t ON t.FacilityTypesID = f.TypeFacility
  JOIN business_objects b ON lower(rtrim(b.ObjectCode)) = lower(rtrim(t.Code))
  JOIN departments d ON d.DepartmentID = f.DepartmentID
  JOIN sub_departments s ON s.SubDepartmentID = f.SubDepartmentID
  UNION ALL
  SELECT p.PolicyID, lower(rtrim(code)), p.PolicyRef, p.UniqueMarketRef, p.InceptionDate, s.Name
  FROM master_policy p
  JOIN departments d ON d.DepartmentID = p.DepartmentID
  JOIN sub_departments s ON s.SubDepartmentID = p.SubDepartmentID
  -- the business object of a policy is a constant: its codes, exploded, instead of a cross join
  LATERAL VIEW explode(CAST(:policy_codes AS ARRAY<STRING>)) AS code),
located AS (
  SELECT o.DocumentID, o.RootObjectID, lower(rtrim(o.RootObjectCode)) AS Code, o.DocumentName, o.DocNumber,
    o.CreateDate, o.FolderID, o.DepartmentID, o.DocumentSystemStatusID, o.FileName AS RawFileName,
    f.FolderTypeID, f.FolderType, l.ServerName, l.SiteName, l.LibraryPath, l.LibraryURL,
    CASE WHEN rtrim(f.FolderPath) = '' THEN NULL ELSE f.FolderPath END AS StoredPath, f.SectionKey,
    '_' || CASE WHEN o.FolderNumber > 99 OR o.FolderNumber < -9 THEN '*'
                ELSE CAST(nullif(o.FolderNumber, 0) AS STRING) END AS NumberPart
  FROM docs o
  JOIN folders f ON f.FolderID = o.FolderID
  JOIN locations l ON l.DivisionID = o.DepartmentID AND l.VersionKey = coalesce(o.SettingsVersion, 0)),
pathed AS (
  SELECT *, coalesce(replace(StoredPath, '/', :sep), :sep || SectionKey || :sep || FolderType) AS FolderPath,
    coalesce(StoredPath, '/' || SectionKey || '/' || FolderType) AS FolderURL,
    CASE WHEN contains(RawFileName, '.') THEN substring_index(RawFileName, '.', -1) END AS DocumentFileType,
    CASE WHEN length(RawFileName) >= 1 THEN substring(RawFileName, 2) END AS FileName
  FROM located),
eligible AS (
  SELECT p.*, b.ObjectName, d.DepartmentName, c.UniqueMarketRef, c.Reference, c.InceptionDate, c.SubDepartmentName,
    concat_ws('', LibraryPath, FolderPath, NumberPart, replace(RawFileName, '/', :sep)) AS DocumentFilePath,
    concat_ws('', LibraryURL, FolderURL, NumberPart, RawFileName) AS DocumentFileURL,
    lower(DocumentName) AS name, lower(rtrim(DocumentFileType)) = :file_type AS right_type,
    array_contains(:signed_types, FolderTypeID) AS signed, array_contains(:placing_types, FolderTypeID) AS placing
  FROM pathed p
  JOIN statuses s ON s.DocumentSystemStatusID = p.DocumentSystemStatusID AND lower(rtrim(s.StatusName)) = :status
  JOIN business_objects b ON lower(rtrim(b.ObjectCode)) = p.Code
  JOIN departments d ON d.DepartmentID = p.DepartmentID
  JOIN contracts c ON c.ObjectID = p.RootObjectID AND c.Code = p.Code
  WHERE array_contains(:folder_types, FolderTypeID)
    AND c.InceptionDate > CAST(:inception_after AS TIMESTAMP_NTZ)
    AND p.CreateDate < CAST(:created_before AS TIMESTAMP_NTZ)),
prioritised AS (
  SELECT *, CASE
    WHEN signed AND contains(name, 'slip') OR contains(name, 'mrc') OR contains(name, 'contract')
      OR contains(name, 'london market') OR contains(name, 'final') AND right_type THEN 1
    WHEN signed AND contains(name, 'sign') AND right_type THEN 3
    WHEN signed AND contains(name, 'scan') AND right_type THEN 4
    WHEN signed AND contains(name, 'fos') AND right_type THEN 5
    WHEN signed AND contains(name, 'policy') AND right_type THEN 6
    WHEN placing AND contains(name, 'slip') OR contains(name, 'mrc') OR contains(name, 'contract') AND right_type THEN 7
    WHEN placing AND contains(name, 'sign') AND right_type THEN 9
    WHEN placing AND contains(name, 'scan') AND right_type THEN 10
    WHEN placing AND contains(name, 'fos') AND right_type THEN 11
    WHEN placing AND contains(name, 'policy') AND right_type THEN 12
    WHEN signed AND right_type THEN 13
    WHEN placing AND right_type THEN 14
    ELSE 99 END AS DocumentTypePriorityOrdinal
  FROM eligible),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY RootObjectID, Code ORDER BY DocumentTypePriorityOrdinal,
      CreateDate DESC NULLS LAST, DocumentID, {ties}) AS BIGINT) AS DocumentPriorityOrdinal
  FROM prioritised)
SELECT {columns}
FROM ranked
WHERE DocumentTypePriorityOrdinal = 1 AND right_type
  AND NOT exists(:stop_words, w -> contains(name, lower(w)))
ORDER BY UniqueMarketRef DESC NULLS LAST, DocumentPriorityOrdinal, DocumentID, {ties}
""".replace("{ties}", _TIES).replace("{columns}", ", ".join(RANKED_COLUMNS))


def parameters(cfg: SelectionConfig, reg: Registry) -> dict:
    """The values of the text's markers. The text compares under the case-insensitive collation and
    leaves out the dormant options. The object codes of policies (normally one) are read once."""
    if cfg.case_sensitive or cfg.match_policy_refs:
        raise ValueError("the SQL text has neither case-sensitive comparison nor the dormant outcomes")
    rows = small_rows(reg.business_objects.where(key_text(F.col("ObjectCode"), False) == POLICY_CODE.lower())
                      .select("ObjectCode"), cache_on=reg.business_objects, key=("codes", False))
    if rows is None:
        raise ValueError("too many business objects of the policies' code for a parameter")
    return {"sep": cfg.path_separator, "folder_types": list(cfg.eligible_folder_types),
            "signed_types": list(cfg.signed_folder_types), "placing_types": list(cfg.placing_folder_types),
            "status": cfg.required_status.rstrip(" ").lower(), "file_type": cfg.selected_file_type.rstrip(" ").lower(),
            "stop_words": list(cfg.distinct_stop_words), "inception_after": cfg.inception_after.isoformat(),
            "created_before": cfg.created_before.isoformat(sep=" "),
            "policy_codes": [r[0] for r in rows] or [None]}
