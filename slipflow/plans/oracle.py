"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the specification, not generated from the Spark plans: plain window functions,
``LIKE`` chains and ``CASE`` ladders over the base tables (``nation customer supplier orders
documents``), with the fixture registry inlined as CTEs. Matching rules: case-insensitive,
trailing blanks ignored by ``=`` (``lower(rtrim(x))``), NULL-propagating ``||`` for the
original ``+`` and NULL-skipping concatenation (``coalesce(x, '')``) for ``CONCAT``.
"""

from __future__ import annotations

# The oracle's own constants, written out so that a slip in the engine's configuration shows.
INCEPTION_AFTER = "1995-07-01 00:00:00"
CREATED_BEFORE = "2000-02-15 00:00:00"
MANIFEST_FOLDER_SIZE = 10
ORDERS_FOLDER_SIZE = 300
LOG_FILE = " 04-08-21 14PM.txt"
# The stop-words, in the original order.
STOP_WORDS = ("Note Bind Binder Cert Certificate Invoices Withhold Wording Debit DebitNote Credit Note CoverNote "
              "Quote Client cc cv subscription FON Endt Endors Placing Amend Excess xs dec schedule cover "
              "consort").split()
# What Python takes as blanks, as a class of characters.
BLANKS = (r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")

FIXTURE_CTES = """
divisions AS (
  SELECT n_nationkey AS DivisionID,
    CASE WHEN c = 1 THEN NULL ELSE CASE n_nationkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE 1 END END AS Version,
    CASE c WHEN 0 THEN 'http://srv' ELSE 'http://alt' END || CAST(n_regionkey AS VARCHAR) AS Server,
    'sites/' || n_name || '/ws' AS WorkSpace, 'Docs' AS DocumentDocLibrary,
    CASE WHEN n_nationkey = 7 THEN NULL ELSE 'p' || CAST(n_nationkey AS VARCHAR) END AS DocumentPath
  FROM nation JOIN (VALUES (0), (1)) AS copies(c) ON c = 0 OR n_nationkey = 1),
departments AS (SELECT n_nationkey AS DepartmentID,
  CASE n_nationkey WHEN 3 THEN '' WHEN 5 THEN '007' ELSE n_name END AS DepartmentName FROM nation),
sub_departments AS (SELECT s_suppkey AS SubDepartmentID, s_name AS Name FROM supplier),
business_objects AS (
  SELECT * FROM (VALUES ('P','Master Policy'),('F1','Facility A'),('F2','Facility B'))
    AS t(ObjectCode, ObjectName)),
facility_types AS (SELECT * FROM (VALUES (1,'F1'),(2,'F2')) AS t(FacilityTypesID, Code)),
facility AS (
  SELECT c_custkey AS FacilityID,
    CASE WHEN c_custkey % 13 = 0 THEN 'FAC' || chr(160) || CAST(c_custkey AS VARCHAR)
         WHEN c_custkey % 17 = 0 THEN chr(160) || ' FAC ' || CAST(c_custkey AS VARCHAR)
         WHEN c_custkey % 19 = 0 THEN chr(160) || '  ' WHEN c_custkey % 23 = 0 THEN NULL
         ELSE 'FAC ' || CAST(c_custkey AS VARCHAR) END AS FacilityRef,
    CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE 'B' || CAST(c_custkey % 500 AS VARCHAR) END AS UniqueMarketRef,
    make_timestamp(1994 + c_custkey % 5, 1 + c_custkey % 12, 1, CASE c_custkey % 120 WHEN 6 THEN 9 ELSE 0 END,
      0, 0) AS InceptionDate,
    CAST(NULL AS TIMESTAMP) AS ExpiryDate, CAST(NULL AS TIMESTAMP) AS CreateDate,
    c_nationkey AS DepartmentID, c_custkey % 11 AS SubDepartmentID, CAST(NULL AS INT) AS BrokerID,
    CAST(c_custkey % 3 AS INT) AS TypeFacility
  FROM customer WHERE c_custkey % 3 <> 0),
master_policy AS (
  SELECT c_custkey AS PolicyID, 'POL ' || CAST(c_custkey AS VARCHAR) AS PolicyRef,
    'P' || CAST(c_custkey % 500 AS VARCHAR) AS UniqueMarketRef,
    make_timestamp(1994 + c_custkey % 5, 1 + c_custkey % 12, 1, CASE c_custkey % 120 WHEN 6 THEN 9 ELSE 0 END,
      0, 0) AS InceptionDate,
    CAST(NULL AS TIMESTAMP) AS ExpiryDate, CAST(NULL AS TIMESTAMP) AS CreateDate,
    c_nationkey AS DepartmentID, c_custkey % 11 AS SubDepartmentID, CAST(NULL AS INT) AS BrokerProducerID
  FROM customer WHERE c_custkey % 3 = 0),
folders AS (
  SELECT * FROM (VALUES (0,44,'Placing','sec0',''),(1,60,'Signed','sec1',CAST(NULL AS VARCHAR)),
    (2,97,'Signing','sec2','/a/b'),(3,52,'Quote',CAST(NULL AS VARCHAR),''),(4,83,'Other','sec4','/c'),
    (5,1,'Skip','sec5','/d'),(6,60,'Signed','sec6','/e/f'))
    AS t(FolderID, FolderTypeID, FolderType, SectionKey, FolderPath)),
statuses AS (SELECT * FROM (VALUES (1,'Exists'),(2,'Deleted')) AS t(DocumentSystemStatusID, StatusName)),
docs AS (
  SELECT o_orderkey AS DocumentID, o_custkey AS RootObjectID,
    CASE WHEN o_orderkey % 53 = 0 THEN 'X' WHEN o_custkey % 3 = 0 THEN 'P'
         ELSE 'F' || CAST(o_custkey % 3 AS VARCHAR) END AS RootObjectCode,
    CAST(o_orderkey % 7 AS INT) AS FolderID, CAST(o_orderkey % 26 AS INT) AS DepartmentID,
    CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE 1 END AS SettingsVersion,
    CASE WHEN o_orderkey % 11 = 0 THEN 2 ELSE 1 END AS DocumentSystemStatusID,
    CASE o_orderkey % 23 WHEN 0 THEN 'MRC Slip' WHEN 1 THEN 'Signed Slip' WHEN 2 THEN 'Contract v2'
      WHEN 3 THEN 'London Market MRC' WHEN 4 THEN 'Final wording' WHEN 5 THEN 'Final' WHEN 6 THEN 'Slip'
      WHEN 7 THEN 'Scan' WHEN 8 THEN 'FOS' WHEN 9 THEN 'Policy' WHEN 10 THEN 'Cover note'
      WHEN 11 THEN 'Binder MRC' WHEN 12 THEN 'CONTRACT' WHEN 13 THEN 'slip final' WHEN 14 THEN 'Sign'
      WHEN 15 THEN 'Client Contract' WHEN 16 THEN 'Quote Slip' WHEN 17 THEN 'Endt Slip'
      WHEN 18 THEN 'Declaration MRC' WHEN 19 THEN 'MRC xs'
      WHEN 20 THEN CASE o_orderkey % 2 WHEN 0 THEN 'pol ' || CAST(3 * (o_orderkey % 40 + 1) AS VARCHAR) || ' '
        ELSE 'Misc' END WHEN 21 THEN 'Placing slip'
      ELSE NULL END AS DocumentName,
    CASE o_orderkey % 5 WHEN 0 THEN '/' || CAST(o_orderkey AS VARCHAR) || '.v1.docx'
      WHEN 1 THEN '/' || CAST(o_orderkey AS VARCHAR) || '.PDF' WHEN 2 THEN '/noext'
      ELSE '/x/' || CAST(o_orderkey AS VARCHAR) || '.a.pdf' END AS FileName,
    CASE o_orderkey % 17 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 123
      ELSE CAST(o_orderkey % 17 AS INT) END AS FolderNumber,
    'D' || CAST(o_orderkey AS VARCHAR) AS DocNumber, o_orderdate AS CreateDate
  FROM orders)"""

DERIVED_CTES = f"""
division_path AS (
  SELECT DivisionID, Version,
    chr(92) || chr(92) || regexp_replace(Server, 'http://', '', 'gi') || chr(92)
      || replace(WorkSpace, '/', chr(92)) || chr(92) || DocumentDocLibrary || chr(92) || DocumentPath AS LibraryPath,
    Server || '/' || WorkSpace || '/' || DocumentDocLibrary || '/' || DocumentPath AS LibraryURL,
    Server, regexp_replace(Server, 'http://', '', 'gi') AS ServerName,
    WorkSpace, regexp_replace(WorkSpace, 'sites/', '', 'gi') AS SiteName,
    DocumentDocLibrary, DocumentPath
  FROM divisions),
contract_objects AS (
  SELECT f.FacilityID AS ObjectID, b.ObjectCode, b.ObjectName, f.FacilityRef AS Reference,
    f.UniqueMarketRef, f.InceptionDate, f.ExpiryDate, f.CreateDate, dp.DepartmentID,
    dp.DepartmentName, f.SubDepartmentID, sd.Name AS SubDepartmentName, f.BrokerID
  FROM facility f
  JOIN facility_types ft ON ft.FacilityTypesID = f.TypeFacility
  JOIN business_objects b ON lower(rtrim(b.ObjectCode)) = lower(rtrim(ft.Code))
  JOIN departments dp ON dp.DepartmentID = f.DepartmentID
  JOIN sub_departments sd ON sd.SubDepartmentID = f.SubDepartmentID
  UNION ALL
  SELECT m.PolicyID, b.ObjectCode, b.ObjectName, m.PolicyRef, m.UniqueMarketRef, m.InceptionDate,
    m.ExpiryDate, m.CreateDate, dp.DepartmentID, dp.DepartmentName, m.SubDepartmentID, sd.Name,
    m.BrokerProducerID
  FROM master_policy m
  JOIN departments dp ON dp.DepartmentID = m.DepartmentID
  JOIN business_objects b ON lower(rtrim(b.ObjectCode)) = 'p'
  JOIN sub_departments sd ON sd.SubDepartmentID = m.SubDepartmentID),
located AS (
  SELECT d.*, f.FolderTypeID, f.FolderType, p.DivisionID, p.Version, p.LibraryPath, p.LibraryURL,
    p.ServerName, p.SiteName,
    coalesce(replace(CASE WHEN rtrim(f.FolderPath) = '' THEN NULL ELSE f.FolderPath END, '/', chr(92)),
             chr(92) || f.SectionKey || chr(92) || f.FolderType) AS FolderPath,
    coalesce(CASE WHEN rtrim(f.FolderPath) = '' THEN NULL ELSE f.FolderPath END,
             '/' || f.SectionKey || '/' || f.FolderType) AS FolderURL,
    '_' || CASE WHEN d.FolderNumber IS NULL OR d.FolderNumber = 0 THEN NULL
                WHEN d.FolderNumber > 99 OR d.FolderNumber < -9 THEN '*'
                ELSE CAST(d.FolderNumber AS VARCHAR) END AS NumberPart
  FROM docs d
  JOIN folders f ON f.FolderID = d.FolderID
  JOIN division_path p ON p.DivisionID = d.DepartmentID
   AND coalesce(p.Version, 0) = coalesce(d.SettingsVersion, 0)),
document_paths AS (
  SELECT l.*,
    coalesce(LibraryPath, '') || coalesce(FolderPath, '') || coalesce(NumberPart, '')
      || coalesce(replace(l.FileName, '/', chr(92)), '') AS DocumentFilePath,
    coalesce(LibraryURL, '') || coalesce(FolderURL, '') || coalesce(NumberPart, '')
      || coalesce(l.FileName, '') AS DocumentFileURL,
    CASE WHEN l.FileName LIKE '%.%' THEN split_part(l.FileName, '.', -1) END AS DocumentFileType,
    CASE WHEN length(l.FileName) >= 1 THEN substr(l.FileName, 2) END AS StrippedFileName
  FROM located l),
joined AS (
  SELECT dp.*, s.StatusName, b.ObjectName AS BusObjectName, de.DepartmentName,
    c.UniqueMarketRef, c.Reference, c.InceptionDate, c.SubDepartmentName
  FROM document_paths dp
  JOIN statuses s ON s.DocumentSystemStatusID = dp.DocumentSystemStatusID
  JOIN business_objects b ON lower(rtrim(b.ObjectCode)) = lower(rtrim(dp.RootObjectCode))
  JOIN departments de ON de.DepartmentID = dp.DepartmentID
  JOIN contract_objects c ON c.ObjectID = dp.RootObjectID
   AND lower(rtrim(c.ObjectCode)) = lower(rtrim(b.ObjectCode))),
eligible AS (
  SELECT * FROM joined
  WHERE FolderTypeID IN (44, 52, 60, 83, 97)
    AND lower(rtrim(StatusName)) = 'exists'
    AND InceptionDate > TIMESTAMP '{INCEPTION_AFTER}'
    AND CreateDate < TIMESTAMP '{CREATED_BEFORE}'),
"""


def _ladder(policy_ref: bool) -> str:
    n = "lower(DocumentName)"
    s = "FolderTypeID IN (60, 97)"
    p = "FolderTypeID = 44"
    pdf = "lower(rtrim(DocumentFileType)) = 'pdf'"
    two = f"WHEN {s} AND IsPolicyRef THEN 2" if policy_ref else ""
    eight = f"WHEN {p} AND IsPolicyRef THEN 8" if policy_ref else ""
    return f"""CASE
      WHEN {s} AND {n} LIKE '%slip%' OR {n} LIKE '%mrc%' OR {n} LIKE '%contract%'
           OR {n} LIKE '%london market%' OR {n} LIKE '%final%' AND {pdf} THEN 1
      {two}
      WHEN {s} AND {n} LIKE '%sign%' AND {pdf} THEN 3
      WHEN {s} AND {n} LIKE '%scan%' AND {pdf} THEN 4
      WHEN {s} AND {n} LIKE '%fos%' AND {pdf} THEN 5
      WHEN {s} AND {n} LIKE '%policy%' AND {pdf} THEN 6
      WHEN {p} AND {n} LIKE '%slip%' OR {n} LIKE '%mrc%' OR {n} LIKE '%contract%' AND {pdf} THEN 7
      {eight}
      WHEN {p} AND {n} LIKE '%sign%' AND {pdf} THEN 9
      WHEN {p} AND {n} LIKE '%scan%' AND {pdf} THEN 10
      WHEN {p} AND {n} LIKE '%fos%' AND {pdf} THEN 11
      WHEN {p} AND {n} LIKE '%policy%' AND {pdf} THEN 12
      WHEN {s} AND {pdf} THEN 13
      WHEN {p} AND {pdf} THEN 14
      ELSE 99 END"""


# The fixed stop-word list of config.py, folded for the case-insensitive LIKE.
STOP_WORDS_SQL = [w.lower() for w in STOP_WORDS]

RANKED_SELECT = """DocumentID, FolderType, UniqueMarketRef, RootObjectID, Reference, InceptionDate,
    BusObjectName AS ObjectName, DepartmentID, DepartmentName, SubDepartmentName, ServerName, SiteName,
    FolderID, DocumentTypePriorityOrdinal, DocumentPriorityOrdinal, DocumentName, DocumentFileType,
    DocumentFilePath, DocumentFileURL, LibraryPath, FolderPath, StrippedFileName AS FileName,
    DocNumber, CreateDate"""

def _ties(object_name: str = "ObjectName", file_name: str = "FileName") -> str:
    """The rest of a total order: every other result column."""
    columns = ["DocumentFileURL", "DocumentFilePath", "LibraryPath", "ServerName", "SiteName", "FolderType",
               "FolderPath", "DepartmentName", object_name, "RootObjectID", "FolderID", "DocumentName", file_name,
               "DocNumber", "UniqueMarketRef", "Reference", "InceptionDate", "SubDepartmentName"]
    return ", ".join(f"{c} ASC NULLS FIRST" for c in columns)


PRIORITY_CTES = f"""
prioritised AS (SELECT *, {_ladder(False)} AS DocumentTypePriorityOrdinal FROM eligible),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY RootObjectID, lower(rtrim(RootObjectCode))
    ORDER BY DocumentTypePriorityOrdinal ASC, CreateDate DESC NULLS LAST, DocumentID ASC,
      {_ties("BusObjectName", "StrippedFileName")})
    AS DocumentPriorityOrdinal
  FROM prioritised),
selected AS (
  SELECT {RANKED_SELECT} FROM ranked
  WHERE DocumentTypePriorityOrdinal = 1 AND lower(rtrim(DocumentFileType)) = 'pdf'
    AND {' AND '.join(f"lower(DocumentName) NOT LIKE '%{w}%'" for w in STOP_WORDS_SQL)}),
manifest AS (
  SELECT DepartmentName, record_num, record_num // {MANIFEST_FOLDER_SIZE} AS folder_num,
    ' ' || CAST(record_num // {MANIFEST_FOLDER_SIZE} AS VARCHAR) || ' ' || DepartmentName AS folder_name,
    landing_file AS filename,
    ' ' || CAST(record_num // {MANIFEST_FOLDER_SIZE} AS VARCHAR) || ' ' || DepartmentName || '/'
      || CAST(record_num AS VARCHAR) || ' - ' || landing_file AS landing_path,
    DocumentFileURL, UniqueMarketRef, DocumentID,
    CASE WHEN DocumentID IS NULL OR RootObjectID IS NULL OR Reference IS NULL OR DocumentFileType IS NULL
           THEN 'file name part missing'
         WHEN landing_file IS NULL THEN 'file name cannot be built'
         WHEN UniqueMarketRef IS NULL THEN 'market reference missing' END AS reason
  FROM (
    SELECT *, row_number() OVER (PARTITION BY DepartmentName
        ORDER BY CreateDate ASC NULLS LAST, DocumentID ASC, {_ties()}) - 1 AS record_num,
      nullif(regexp_extract(CAST(DocumentID AS VARCHAR), '([^{BLANKS}]+)', 1), '') || '_'
        || nullif(regexp_extract(CAST(RootObjectID AS VARCHAR), '([^{BLANKS}]+)', 1), '') || '_'
        || nullif(regexp_extract(Reference, '([^{BLANKS}]+)', 1), '') || '.'
        || nullif(regexp_extract(DocumentFileType, '([^{BLANKS}]+)', 1), '') AS landing_file
    FROM selected WHERE DepartmentName IS NOT NULL) m),
fetch_status AS (
  SELECT *, CASE WHEN landing_path IS NOT NULL
                  AND DocumentID IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag <> 'N')
                 THEN 'OK' ELSE 'FILE NOT FOUND' END AS status
  FROM manifest)
"""


def _with(*parts: str) -> str:
    body = ",".join(p.strip().rstrip(",") for p in parts)
    return "WITH " + body + "\n"


BASE = _with(FIXTURE_CTES, DERIVED_CTES, PRIORITY_CTES)

SELECTED_COLUMNS = [
    "DocumentID", "FolderType", "UniqueMarketRef", "RootObjectID", "Reference", "InceptionDate",
    "ObjectName", "DepartmentID", "DepartmentName", "SubDepartmentName", "ServerName", "SiteName",
    "FolderID", "DocumentTypePriorityOrdinal", "DocumentPriorityOrdinal", "DocumentName",
    "DocumentFileType", "DocumentFilePath", "DocumentFileURL", "LibraryPath", "FolderPath",
    "FileName", "DocNumber", "CreateDate",
]
_OTHERS = [c for c in SELECTED_COLUMNS if c != "DepartmentName"]

ORACLE: dict[str, str] = {
    "division_path": BASE + "SELECT * FROM division_path",
    "contract_objects": BASE + "SELECT * FROM contract_objects",
    "policy_contracts": BASE + "SELECT * FROM contract_objects WHERE ObjectCode = 'P'",
    "versioned_location": BASE + """
SELECT d.DocumentID, d.DepartmentID, d.SettingsVersion, p.DivisionID, p.Version, p.LibraryURL
FROM docs d JOIN division_path p ON p.DivisionID = d.DepartmentID
 AND coalesce(p.Version, 0) = coalesce(d.SettingsVersion, 0)""",
    "duplicate_locations": BASE + """
SELECT DivisionID, coalesce(Version, 0) AS VersionKey, count(*) AS locations
FROM divisions GROUP BY DivisionID, coalesce(Version, 0) HAVING count(*) > 1""",
    "document_paths": BASE + """
SELECT DocumentID, FolderID, DivisionID, LibraryPath, LibraryURL, FolderPath, FolderURL,
  DocumentFilePath, DocumentFileURL, DocumentFileType, StrippedFileName AS FileName
FROM document_paths""",
    "document_contract": BASE + """
SELECT d.DocumentID, d.RootObjectID, d.RootObjectCode, b.ObjectName, c.Reference, c.UniqueMarketRef,
  c.InceptionDate, c.SubDepartmentName
FROM docs d
JOIN business_objects b ON lower(rtrim(b.ObjectCode)) = lower(rtrim(d.RootObjectCode))
JOIN contract_objects c ON c.ObjectID = d.RootObjectID
 AND lower(rtrim(c.ObjectCode)) = lower(rtrim(b.ObjectCode))""",
    "eligible_documents": BASE + """
SELECT DocumentID, RootObjectID, RootObjectCode, FolderTypeID, StatusName, InceptionDate, CreateDate,
  DepartmentName, UniqueMarketRef FROM eligible""",
    "document_priority": BASE + """
SELECT DocumentID, DocumentName, FolderTypeID, DocumentFileType, DocumentTypePriorityOrdinal
FROM prioritised""",
    "priority_histogram": BASE + """
SELECT DocumentTypePriorityOrdinal, count(*) AS documents FROM prioritised
GROUP BY DocumentTypePriorityOrdinal""",
    "document_rank": BASE + f"SELECT {RANKED_SELECT} FROM ranked",
    "best_document": BASE + f"SELECT {RANKED_SELECT} FROM ranked WHERE DocumentPriorityOrdinal = 1",
    "stopword_hits": BASE + f"""
SELECT p.DocumentID, p.DocumentName, w.StopWord
FROM prioritised p
JOIN (VALUES {', '.join(f"('{w}')" for w in dict.fromkeys(STOP_WORDS))})
  AS w(StopWord)
  ON position(lower(w.StopWord) IN lower(p.DocumentName)) > 0""",
    "selected_documents": BASE + "SELECT * FROM selected ORDER BY UniqueMarketRef DESC NULLS LAST, "
                                 "DocumentPriorityOrdinal, DocumentID, " + _ties(),
    "registry_union": " UNION ALL ".join(
        "SELECT *, '" + source + "' AS Source FROM (" + BASE.replace(
            "FROM orders)", f"FROM orders WHERE o_orderkey % 2 = {half})") + "SELECT * FROM selected)"
        for half, source in enumerate(("registry_a", "registry_b"))),
    "decoded_text": """
SELECT doc_id, CAST(strlen(text) AS BIGINT) AS decoded_length,
  sha256(array_to_string(list_transform(range(0, strlen(text)),
    lambda i: chr(CAST('0x' || substr(hex(encode(text)), 2 * i + 1, 2) AS INT))), '')) AS decoded_sha256
FROM documents""",
    "creation_order": BASE + """
SELECT *, row_number() OVER (ORDER BY CreateDate ASC NULLS LAST, DocumentID ASC, """ + _ties() + """) - 1
  AS position
FROM selected""",
    "first_documents": BASE + "SELECT * FROM selected ORDER BY CreateDate ASC NULLS LAST, DocumentID, "
                              + _ties() + " LIMIT 5",
    "department_list": BASE + "SELECT DISTINCT DepartmentName FROM selected",
    "department_column_counts": BASE + f"""
SELECT DepartmentName, {', '.join(f'count({c}) AS {c}' for c in _OTHERS)}
FROM selected WHERE DepartmentName IS NOT NULL GROUP BY DepartmentName""",
    "department_totals": BASE + "SELECT DepartmentName, count(*) AS documents FROM selected GROUP BY DepartmentName",
    "manifest_totals": BASE + "SELECT count(*) AS documents FROM selected",
    "batch_manifest": BASE + "SELECT * FROM manifest",
    "batch_orders": f"""
SELECT o_orderpriority, o_orderkey, o_orderdate, record_num, record_num // {ORDERS_FOLDER_SIZE} AS folder_num
FROM (SELECT o_orderpriority, o_orderkey, o_orderdate,
        row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate ASC NULLS LAST, o_orderkey) - 1
          AS record_num
      FROM orders) t""",
    "folder_sizes": BASE + "SELECT DepartmentName, folder_num, count(*) AS documents FROM manifest "
                           "GROUP BY DepartmentName, folder_num",
    "rejected_rows": BASE + """
SELECT DocumentID, DepartmentName, record_num, reason FROM manifest WHERE reason IS NOT NULL""",
    "fetch_status": BASE + "SELECT * FROM fetch_status",
    "missing_files": BASE + "SELECT * EXCLUDE (status) FROM fetch_status WHERE status = 'FILE NOT FOUND'",
    "fetch_summary": BASE + "SELECT DepartmentName, status, count(*) AS documents FROM fetch_status "
                            "GROUP BY DepartmentName, status",
    "run_log_lines": BASE + f"""
SELECT DepartmentName, CAST(record_num AS BIGINT) AS record_num,
  CASE WHEN status = 'OK' THEN coalesce(filename, '') || ' , OK , ' || coalesce(UniqueMarketRef, '')
       ELSE coalesce(filename, '') || ' , FILE NOT FOUND  , ' || coalesce(UniqueMarketRef, '') END AS line,
  '{LOG_FILE}' AS log_file
FROM fetch_status
UNION ALL
SELECT DepartmentName, CAST(-1 AS BIGINT), DepartmentName || ' ' || CAST(count(*) AS VARCHAR), '{LOG_FILE}'
FROM fetch_status GROUP BY DepartmentName""",
    "write_manifest": BASE + "SELECT * FROM manifest",
    "landed_departments": BASE + """
SELECT d.DepartmentName, count(f.status) AS documents,
  count(DISTINCT CASE WHEN f.status = 'OK' THEN f.folder_num END) AS landed_folders,
  CAST(coalesce(sum(CASE WHEN f.status = 'OK' THEN strlen(coalesce(f.filename, '')) + 1 END), 0) AS BIGINT)
    AS landed_bytes,
  count(DISTINCT CASE WHEN f.status <> 'OK' THEN f.folder_num END) AS other_folders
FROM (SELECT DepartmentName FROM departments UNION ALL SELECT 'NOWHERE') d
LEFT JOIN fetch_status f ON f.DepartmentName = d.DepartmentName GROUP BY d.DepartmentName""",
    "run_log_file": BASE + f"""
SELECT line AS value FROM (
  SELECT CASE WHEN status = 'OK' THEN coalesce(filename, '') || ' , OK , ' || coalesce(UniqueMarketRef, '')
              ELSE coalesce(filename, '') || ' , FILE NOT FOUND  , ' || coalesce(UniqueMarketRef, '') END AS line
  FROM fetch_status
  UNION ALL
  SELECT DepartmentName || ' ' || CAST(count(*) AS VARCHAR) FROM fetch_status GROUP BY DepartmentName) t""",
    "policy_ref_matches": BASE.replace(
        "prioritised AS (SELECT *, " + _ladder(False),
        "prioritised AS (SELECT *, " + _ladder(True)).replace(
        "eligible AS (\n  SELECT * FROM joined",
        "eligible AS (\n  SELECT *, CASE WHEN DocumentName IS NULL THEN NULL ELSE lower(rtrim(DocumentName)) IN "
        "(SELECT lower(rtrim(PolicyRef)) FROM master_policy WHERE PolicyRef IS NOT NULL) END AS IsPolicyRef "
        "FROM joined") + """
SELECT DocumentID, DocumentName, IsPolicyRef, DocumentTypePriorityOrdinal FROM prioritised""",
    "filter_by_reference": BASE + """
SELECT * FROM selected
WHERE lower(rtrim(UniqueMarketRef)) IN (SELECT lower(rtrim(UniqueMarketRef)) FROM master_policy)""",
}
# The same rows by other ways of the engine: from SQL text, from a registry stored by key.
ORACLE["selected_documents_sql"] = ORACLE["selected_documents"]
ORACLE["document_rank_stored"] = ORACLE["document_rank"]
ORACLE["selected_documents_monthly"] = ORACLE["selected_documents"]
ORACLE["documents_of_months"] = BASE + f"""
SELECT DocumentID, strftime(CreateDate, '%Y-%m') AS created_month, CreateDate FROM docs
WHERE strftime(CreateDate, '%Y-%m') IN (
  SELECT strftime(InceptionDate, '%Y-%m') FROM contract_objects WHERE InceptionDate > TIMESTAMP '{INCEPTION_AFTER}')"""
ORACLE["planned_ranges"] = BASE + """
SELECT DocumentID, CAST(1 AS INT) AS ranges, RootObjectCode = 'X' AS without_key FROM docs"""
ORACLE["published_manifest"] = ORACLE["write_manifest"]
ORACLE["fetch_status_reduced"] = ORACLE["fetch_status"]
