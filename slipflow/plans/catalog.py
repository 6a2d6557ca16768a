"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the generated test tables of ``sf_dir`` through the fixture registry
(``sources.fixtures``) and runs over all of their rows; the only parameters are the fixture
dates of ``config.FIXTURE`` and the folder sizes named below.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FIXTURE, LOG_OK
from ..operators import contracts, locations, manifest, priority, reconcile, selection
from ..operators.joins import dimension, key_text
from ..operators.numbering import write_stage
from ..sources import monthly, ranges
from ..sources.fixtures import fixture_registry
from ..sources.encoding import decode_latin1
from ..sources.landing import write_landing
from ..sources.listing import list_landed
from ..session import ensure_checkpoint_dir
from ..sources.registry import Registry
from ..sources.stored import load_stored, store_by_contract
from ..sources.views import run_sql
from . import publish
from .selection_sql import SELECTED_SQL, parameters

# Parameters of the registered queries.
CFG = FIXTURE
MANIFEST_FOLDER_SIZE = 10     # the selection is small: size 10 gives several folders per department
ORDERS_FOLDER_SIZE = 300      # the original folder size, on orders grouped by priority
EXTRACTION_PARTS = 12
ROWS_PER_FILE = 100
STORED_BUCKETS = 16           # one for about a gigabyte at scale (sources.stored)
RUN_TIME = _dt.datetime(2021, 8, 4, 14, 10, 12)
REGISTRIES = ("registry_a", "registry_b")

_REGISTRY_CACHE: dict[tuple, Registry] = {}


def registry(spark: SparkSession, sf_dir: str, source: str = "default") -> Registry:
    key = (id(spark), spark.sparkContext.applicationId, sf_dir, source)
    reg = _REGISTRY_CACHE.get(key)
    if reg is None:
        reg = _REGISTRY_CACHE[key] = fixture_registry(spark, sf_dir, source)
    return reg


def _selected(spark, sf_dir, **kw) -> DataFrame:
    return selection.selected_documents(registry(spark, sf_dir), CFG, ordered=False, **kw)


def _bound(spark, sf_dir) -> int:
    return priority.registry_row_bound(registry(spark, sf_dir), CFG)


def _manifest(spark, sf_dir) -> DataFrame:
    return manifest.batch_manifest(_selected(spark, sf_dir), MANIFEST_FOLDER_SIZE,
                                   max_rows=_bound(spark, sf_dir))


def fetch_results(spark, sf_dir) -> DataFrame:
    """Fetch results that know nothing of the manifest: a document was fetched when one of its
    order's lines was shipped and settled. Documents repeat, and some have no line like that."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lines.where(F.col("l_returnflag") != "N").select(F.col("l_orderkey").alias("DocumentID"))


def _months(spark, sf_dir) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/months-{uuid.uuid4().hex}"
    monthly.store_by_month(registry(spark, sf_dir).docs, path)
    return monthly.load_months(spark, path)


def _status(spark, sf_dir) -> DataFrame:
    return reconcile.fetch_status(_manifest(spark, sf_dir), fetch_results(spark, sf_dir), "DocumentID")


# --- queries ------------------------------------------------------------------------------------

def q_division_path(spark, sf_dir):
    return locations.division_path(registry(spark, sf_dir), CFG)


def q_contract_objects(spark, sf_dir):
    return contracts.contract_objects(registry(spark, sf_dir), CFG)


def q_policy_contracts(spark, sf_dir):
    return contracts.policy_contracts(registry(spark, sf_dir), CFG)


def q_versioned_location(spark, sf_dir):
    reg = registry(spark, sf_dir)
    j = locations.versioned_location(reg.docs, locations.division_path(reg, CFG))
    return j.select("DocumentID", "DepartmentID", "SettingsVersion", "DivisionID", "Version",
                    "LibraryURL")


def q_duplicate_locations(spark, sf_dir):
    return locations.duplicate_locations(registry(spark, sf_dir), CFG)


def q_document_paths(spark, sf_dir):
    return locations.document_paths(registry(spark, sf_dir), CFG)


def q_document_contract(spark, sf_dir):
    reg = registry(spark, sf_dir)
    cs = CFG.case_sensitive
    bo = dimension(reg.business_objects).select(
        key_text(F.col("ObjectCode"), cs).alias("_code"), "ObjectName")
    d = reg.docs.withColumn("_code", key_text(F.col("RootObjectCode"), cs)).join(bo, "_code")
    c = contracts.contract_objects(reg, CFG).select(
        "ObjectID", key_text(F.col("ObjectCode"), cs).alias("_ocode"), "Reference",
        "UniqueMarketRef", "InceptionDate", "SubDepartmentName")
    j = d.join(c, (d["RootObjectID"] == c["ObjectID"]) & (d["_code"] == c["_ocode"]))
    return j.select("DocumentID", "RootObjectID", "RootObjectCode", "ObjectName", "Reference",
                    "UniqueMarketRef", "InceptionDate", "SubDepartmentName")


def q_eligible_documents(spark, sf_dir):
    p = priority.joined_documents(registry(spark, sf_dir), CFG).where(priority.eligibility(CFG))
    return p.select("DocumentID", "RootObjectID", "RootObjectCode", "FolderTypeID", "StatusName",
                    "InceptionDate", "CreateDate", "DepartmentName", "UniqueMarketRef")


def q_document_priority(spark, sf_dir):
    p = priority.prioritised_documents(registry(spark, sf_dir), CFG)
    return p.select("DocumentID", "DocumentName", "FolderTypeID", "DocumentFileType",
                    "DocumentTypePriorityOrdinal")


def q_priority_histogram(spark, sf_dir):
    p = priority.prioritised_documents(registry(spark, sf_dir), CFG)
    return p.groupBy("DocumentTypePriorityOrdinal").agg(F.count(F.lit(1)).alias("documents"))


def q_document_rank(spark, sf_dir):
    p = priority.prioritised_documents(registry(spark, sf_dir), CFG)
    reg = registry(spark, sf_dir)
    return priority.output_columns(priority.rank_documents(
        priority.rank_input(p), max_rows=_bound(spark, sf_dir),
        **priority.ranking_parts(reg, CFG)))


def q_document_rank_stored(spark, sf_dir):
    """The ranking of a registry that was stored by contract key: no exchange for the contract join
    and none for the window."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/registry-{uuid.uuid4().hex}"
    store_by_contract(registry(spark, sf_dir), CFG, path, STORED_BUCKETS)
    reg = load_stored(spark, path, CFG)
    p = priority.rank_input(priority.prioritised_documents(reg, CFG))
    return priority.output_columns(priority.rank_documents(p, max_rows=_bound(spark, sf_dir),
                                                           **priority.ranking_parts(reg, CFG)))


def q_best_document(spark, sf_dir):
    return priority.output_columns(priority.best_documents(registry(spark, sf_dir), CFG))


def q_stopword_hits(spark, sf_dir):
    return selection.stopword_hits(registry(spark, sf_dir), CFG)


def q_selected_documents(spark, sf_dir):
    return selection.selected_documents(registry(spark, sf_dir), CFG)


def q_selected_documents_sql(spark, sf_dir):
    """The flagship as SQL text over the registry's views, its parameters bound."""
    reg = registry(spark, sf_dir)
    return run_sql(spark, SELECTED_SQL, parameters(CFG, reg), registry=reg)


def q_selected_documents_monthly(spark, sf_dir):
    """The flagship over documents stored by month, of which only the months of the run are read."""
    reg, months = registry(spark, sf_dir), _months(spark, sf_dir)
    return selection.selected_documents(reg.with_tables(docs=monthly.created_before(months, CFG).drop(monthly.MONTH)), CFG)


def q_documents_of_months(spark, sf_dir):
    """Documents created in a month in which an eligible contract incepts: the months are known only
    when the query runs, and only their files are read."""
    contracts_ = contracts.contract_objects(registry(spark, sf_dir), CFG).where(priority.contract_eligibility(CFG))
    wanted = contracts_.select(monthly.month_of(F.col("InceptionDate")).alias(monthly.MONTH))
    return monthly.in_months(_months(spark, sf_dir), wanted).select("DocumentID", monthly.MONTH, "CreateDate")


def q_planned_ranges(spark, sf_dir):
    """Extraction ranges planned on a skewed key with missing values: how many of them read each
    document (one), and whether it is the part of missing keys."""
    docs = registry(spark, sf_dir).docs.select("DocumentID", F.when(
        F.col("RootObjectCode") != "X", F.when(F.col("RootObjectID") % 3 == 0, F.lit(3)).otherwise(F.col("RootObjectID")))
        .alias("key"))
    predicates = ranges.plan_ranges(docs, "key", EXTRACTION_PARTS)
    number, hits = ranges.part_of("key", predicates)
    return docs.select("DocumentID", hits.alias("ranges"), (number == len(predicates) - 1).alias("without_key"))


def q_registry_union(spark, sf_dir):
    """Two registries with different documents, the second without an optional column: each is
    selected for itself, and the selections are appended."""
    sels = [selection.selected_documents(registry(spark, sf_dir, src), CFG, ordered=False) for src in REGISTRIES]
    return selection.registry_union(sels, list(REGISTRIES))


def q_decoded_text(spark, sf_dir):
    """Latin-1 decoding of the UTF-8 bytes of every document text: one character per byte. The
    decoded text itself is compared, as its hash."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    decoded = decode_latin1(F.encode(F.col("text"), "UTF-8"))
    return d.select("doc_id", F.length(decoded).cast("long").alias("decoded_length"),
                    F.sha2(decoded.cast("binary"), 256).alias("decoded_sha256"))


def q_creation_order(spark, sf_dir):
    return manifest.creation_order(_selected(spark, sf_dir), max_rows=_bound(spark, sf_dir))


def q_first_documents(spark, sf_dir):
    return manifest.first_documents(_selected(spark, sf_dir))


def q_department_list(spark, sf_dir):
    return manifest.department_list(_selected(spark, sf_dir))


def q_department_column_counts(spark, sf_dir):
    return manifest.department_column_counts(_selected(spark, sf_dir))


def q_department_totals(spark, sf_dir):
    return manifest.department_totals(_selected(spark, sf_dir))


def q_manifest_totals(spark, sf_dir):
    return manifest.manifest_totals(_selected(spark, sf_dir))


def q_batch_manifest(spark, sf_dir):
    return _manifest(spark, sf_dir)


def q_batch_orders(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return manifest.batch_orders(orders, ORDERS_FOLDER_SIZE)


def q_folder_sizes(spark, sf_dir):
    return manifest.folder_sizes(_manifest(spark, sf_dir))


def q_rejected_rows(spark, sf_dir):
    return manifest.rejected_rows(_manifest(spark, sf_dir))


def q_fetch_status(spark, sf_dir):
    return _status(spark, sf_dir)


def q_fetch_status_reduced(spark, sf_dir):
    """The same with a Bloom filter of the manifest's keys before the fetch results are shuffled."""
    return reconcile.fetch_status_reduced(_manifest(spark, sf_dir), fetch_results(spark, sf_dir), "DocumentID",
                                          larger_than="1")


def q_missing_files(spark, sf_dir):
    return reconcile.missing_files(_manifest(spark, sf_dir), fetch_results(spark, sf_dir), "DocumentID")


def q_fetch_summary(spark, sf_dir):
    return reconcile.fetch_summary(_status(spark, sf_dir))


def q_run_log_lines(spark, sf_dir):
    return reconcile.run_log_lines(write_stage(_status(spark, sf_dir), "status"), RUN_TIME)


def q_policy_ref_matches(spark, sf_dir):
    cfg = CFG.with_(match_policy_refs=True)
    p = priority.prioritised_documents(registry(spark, sf_dir), cfg)
    return p.select("DocumentID", "DocumentName", "IsPolicyRef", "DocumentTypePriorityOrdinal")


def q_filter_by_reference(spark, sf_dir):
    reg = registry(spark, sf_dir)
    refs = reg.master_policy.select("UniqueMarketRef")
    return selection.filter_by_reference(_selected(spark, sf_dir), refs, CFG)


def q_write_manifest(spark, sf_dir):
    """Write the manifest as its sink does (partitioned by the department's key, the name beside
    it), read it back."""
    man = _manifest(spark, sf_dir)
    return write_stage(manifest.sink_layout(man), "manifest", partition_by=["department_key"]) \
        .select(*manifest.MANIFEST_COLUMNS)


def q_published_manifest(spark, sf_dir):
    """The manifest of the published run, after two: the first holds only the odd record numbers, the
    second replaces every department by the whole of it."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/published-{uuid.uuid4().hex}"
    laid = write_stage(manifest.sink_layout(_manifest(spark, sf_dir)), "laid")

    def first(folder: str) -> list[str]:
        publish.write_departments(laid.where("record_num % 2 = 1"), f"{folder}/manifest", ROWS_PER_FILE)
        return ["manifest"]
    publish.run_and_publish(spark, base, "first", first)
    publish.amend_departments(spark, base, "second", laid, rows_per_file=ROWS_PER_FILE)
    return publish.read_current(spark, base, "manifest").select(*manifest.MANIFEST_COLUMNS)


def q_landed_departments(spark, sf_dir):
    """What a run has left below its landing root, listed in tasks and held to the manifest.

    The tree has a folder per department and one in it per landing folder. Documents that were
    fetched are lines of ``.txt`` files, the others of ``.json`` files. Per department: its documents,
    the folders that hold a ``.txt`` file, the bytes of those files, and the folders that hold a file
    of another suffix. One more department has no documents and no folder."""
    status = write_stage(_status(spark, sf_dir), "status")
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/landing-{uuid.uuid4().hex}"
    lines = status.select(manifest.department_key(F.col("DepartmentName")).alias("department_key"), "folder_num",
                          F.coalesce("filename", F.lit("")).alias("value"), "status")
    ok = F.col("status") == LOG_OK
    write_landing(lines.where(ok), root, ".txt")
    write_landing(lines.where(~ok).withColumn("value", F.to_json(F.struct("value"))), root, ".json")
    names = spark.range(1).select(F.lit("NOWHERE").alias("DepartmentName"))
    every = registry(spark, sf_dir).departments.select("DepartmentName").unionByName(names)
    return reconcile.landed_departments(status, every, list_landed(spark, root, suffix=".txt"),
                                        list_landed(spark, root).where(~F.col("path").endswith(".txt")))


def q_run_log_file(spark, sf_dir):
    """Write the run log as text (ordered part files), read the lines back."""
    log = reconcile.run_log_lines(write_stage(_status(spark, sf_dir), "status"), RUN_TIME)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/run-log-{uuid.uuid4().hex}"
    reconcile.write_run_log(log, path)
    return spark.read.text(path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
