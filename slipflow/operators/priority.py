"""Eligible documents, the type-priority ladder, per-contract ranking and the best document."""

from __future__ import annotations

import weakref

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SelectionConfig
from ..functions.text import same_text
from ..sources.registry import Registry
from .contracts import contract_objects
from .joins import dimension, key_text
from .locations import located_documents, version_key
from .numbering import number_rows

# A contract is (object id, object code); the code compared under the registry collation
# (``ContractCode`` = folded code), the same key the contract join uses.
CONTRACT_KEYS = ["RootObjectID", "ContractCode"]


def top_priority(cfg: SelectionConfig, name: Column, folder_type: Column, file_type: Column) -> Column:
    """Condition of outcome 1 of the ladder (UNKNOWN for a NULL name, like every keyword test)."""
    cs = cfg.case_sensitive
    folded = name if cs else F.lower(name)

    def kw(word: str) -> Column:
        return folded.contains(F.lit(word if cs else word.lower()))

    # The keywords of the first outcome.
    return ((folder_type.isin(*cfg.signed_folder_types) & kw("Slip")) | kw("MRC") | kw("Contract")
            | kw("London Market") | (kw("Final") & same_text(file_type, cfg.selected_file_type, cs)))


def ladder(cfg: SelectionConfig, name: Column, folder_type: Column, file_type: Column,
           policy_ref: Column | None = None) -> Column:
    """Type priority of a document: the first matching outcome, else 99.

    ``AND`` binds tighter than ``OR``, so some outcomes are wider than their layout suggests:
    outcome 1 is ``(signed AND Slip) OR MRC OR Contract OR London Market OR (Final AND pdf)``.
    A NULL name makes every keyword test UNKNOWN (not taken).
    """
    cs = cfg.case_sensitive
    signed = folder_type.isin(*cfg.signed_folder_types)
    placing = folder_type.isin(*cfg.placing_folder_types)
    pdf = same_text(file_type, cfg.selected_file_type, cs)
    folded = name if cs else F.lower(name)  # built once, shared by every keyword test

    def kw(word: str) -> Column:
        return folded.contains(F.lit(word if cs else word.lower()))

    # The keywords and outcome numbers of the original ladder, in its order.
    steps: list[tuple[Column, int]] = [(top_priority(cfg, name, folder_type, file_type), 1)]
    if policy_ref is not None:
        steps.append((signed & policy_ref, 2))
    steps += [
        (signed & kw("Sign") & pdf, 3),
        (signed & kw("Scan") & pdf, 4),
        (signed & kw("FOS") & pdf, 5),
        (signed & kw("Policy") & pdf, 6),
        ((placing & kw("Slip")) | kw("MRC") | (kw("Contract") & pdf), 7),
    ]
    if policy_ref is not None:
        steps.append((placing & policy_ref, 8))
    steps += [
        (placing & kw("Sign") & pdf, 9),
        (placing & kw("Scan") & pdf, 10),
        (placing & kw("FOS") & pdf, 11),
        (placing & kw("Policy") & pdf, 12),
        (signed & pdf, 13),
        (placing & pdf, 14),
    ]
    out = None
    for cond, value in steps:
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return out.otherwise(F.lit(99))


# A frequent document name is spread over this many tasks in the join to the policy references.
REF_SALTS = 32


def policy_ref_flags(reg: Registry, docs: DataFrame, cfg: SelectionConfig) -> DataFrame:
    """Dormant option: flag documents whose name equals a master-policy reference.

    A left join to the distinct references, giving a boolean per document (NULL without a name).
    The distinct references stand ``REF_SALTS`` times with a salt and every document draws one, so
    a name that a third of the documents carry is joined by many tasks. Documents without a name
    take a salt of their own kind that no reference has, spread by document.

    The references grow with the registry and Spark sizes the repeated ones as if they stood once, so
    the join is asked for by merging: they must never be gathered in the driver for a broadcast.
    """
    cs = cfg.case_sensitive
    refs = (reg.master_policy.select(key_text(F.col("PolicyRef"), cs).alias("_ref"))
            .where(F.col("_ref").isNotNull()).distinct()
            .select("_ref", F.explode(F.sequence(F.lit(0), F.lit(REF_SALTS - 1))).alias("_salt"))
            .withColumn("_is_ref", F.lit(True)).hint("merge"))
    spread = F.xxhash64("DocumentID", "FileName")
    keyed = docs.withColumn("_ref", F.coalesce(key_text(F.col("DocumentName"), cs), F.lit(""))) \
        .withColumn("_salt", F.when(F.col("DocumentName").isNotNull(), F.pmod(spread, F.lit(REF_SALTS)).cast("int"))
                    .otherwise(-1 - F.pmod(spread, F.lit(2 ** 30)).cast("int")))
    return (keyed.join(refs, ["_ref", "_salt"], "left")
            .withColumn("IsPolicyRef", F.when(F.col("DocumentName").isNotNull(),
                                              F.coalesce(F.col("_is_ref"), F.lit(False))))
            .drop("_ref", "_salt", "_is_ref"))


def with_contract_code(docs: DataFrame, cfg: SelectionConfig) -> DataFrame:
    """``docs`` with ``ContractCode``; a stored table has it already (``sources.stored``)."""
    if "ContractCode" in docs.columns:
        return docs
    return docs.withColumn("ContractCode", key_text(F.col("RootObjectCode"), cfg.case_sensitive))


def document_side(reg: Registry, cfg: SelectionConfig, docs: DataFrame | None = None) -> DataFrame:
    """Documents joined to folder, location, status, business object and department (all of them
    size-checked broadcasts), before the contract join."""
    cs = cfg.case_sensitive
    statuses = dimension(reg.statuses).select("DocumentSystemStatusID", "StatusName")
    bo = dimension(reg.business_objects).select(
        key_text(F.col("ObjectCode"), cs).alias("ContractCode"), F.col("ObjectName").alias("BusObjectName"))
    depts = dimension(reg.departments).select("DepartmentID", "DepartmentName")
    docs = reg.docs if docs is None else docs
    if cfg.match_policy_refs:
        docs = policy_ref_flags(reg, docs, cfg)
    located = located_documents(reg, cfg, docs=with_contract_code(docs, cfg))
    return located.join(statuses, "DocumentSystemStatusID").join(bo, "ContractCode").join(depts, "DepartmentID")


def contract_side(reg: Registry, cfg: SelectionConfig) -> DataFrame:
    """The contract columns a document takes, with the join keys ``ObjectID`` and ``_ocode``."""
    if reg.stored_contracts is not None:
        return reg.stored_contracts
    return contract_objects(reg, cfg).select(
        F.col("ObjectID"), key_text(F.col("ObjectCode"), cfg.case_sensitive).alias("_ocode"), *CONTRACT_TAKEN)


def joined_documents(reg: Registry, cfg: SelectionConfig, docs: DataFrame | None = None) -> DataFrame:
    """Documents with their lookups, joined to their contract: the one shuffle join (documents and
    contracts both grow with the data)."""
    d, c = document_side(reg, cfg, docs), contract_side(reg, cfg)
    return d.join(c, (d["RootObjectID"] == c["ObjectID"]) & (d["ContractCode"] == c["_ocode"])) \
        .drop("_ocode", "ObjectID")


_ROW_BOUNDS: "weakref.WeakKeyDictionary[Registry, dict]" = weakref.WeakKeyDictionary()


def _max_per_key(df: DataFrame, *keys: Column) -> int:
    row = df.groupBy(*keys).count().agg(F.max("count")).first()
    return max(1, int(row[0] or 0))


# Above this many documents the bound below cannot spare the measuring, so the fan-out is not computed.
BOUND_WORTH_ROWS = 1_000_000


def registry_row_bound(reg: Registry, cfg: SelectionConfig) -> int:
    """Proven upper bound on the rows of any document pipeline (eligible, ranked, selected).

    Every joined row is one document with one matching row of each lookup and one contract, so
    a document becomes at most ``fan-out`` rows: the product of the largest number of rows
    sharing a key in each lookup table and in the contracts. The bound is documents x fan-out.
    Like table statistics it is computed once per registry (small lookups, one narrow
    aggregation over the contracts, a row count of the documents). With more than
    ``BOUND_WORTH_ROWS`` documents no bound is small enough to matter: the count is the end of
    it, and the answer is larger than any single task's share.
    """
    cache = _ROW_BOUNDS.setdefault(reg, {})
    cs = cfg.case_sensitive
    if cs not in cache:
        documents = reg.docs.count()
        if documents > BOUND_WORTH_ROWS:
            cache[cs] = 2 ** 62
            return cache[cs]
        fan_out = (_max_per_key(reg.folders, F.col("FolderID"))
                   * _max_per_key(reg.divisions, F.col("DivisionID"), version_key(F.col("Version")))
                   * _max_per_key(reg.statuses, F.col("DocumentSystemStatusID"))
                   * _max_per_key(reg.business_objects, key_text(F.col("ObjectCode"), cs))
                   * _max_per_key(reg.departments, F.col("DepartmentID"))
                   * _max_per_key(contract_objects(reg, cfg), F.col("ObjectID"),
                                  key_text(F.col("ObjectCode"), cs)))
        cache[cs] = documents * fan_out
    return cache[cs]


def document_eligibility(cfg: SelectionConfig) -> Column:
    """The conditions on a document itself: folder type, status, creation date."""
    return (F.col("FolderTypeID").isin(*cfg.eligible_folder_types)
            & same_text(F.col("StatusName"), cfg.required_status, cfg.case_sensitive)
            & (F.col("CreateDate") < F.lit(cfg.created_before.isoformat(sep=" ")).cast("timestamp_ntz")))


def contract_eligibility(cfg: SelectionConfig) -> Column:
    """Inception strictly after midnight of the boundary day: later that day counts."""
    return F.col("InceptionDate") > F.lit(cfg.inception_after.isoformat()).cast("timestamp_ntz")


def eligibility(cfg: SelectionConfig) -> Column:
    return document_eligibility(cfg) & contract_eligibility(cfg)


def type_priority(cfg: SelectionConfig) -> Column:
    return ladder(cfg, F.col("DocumentName"), F.col("FolderTypeID"), F.col("DocumentFileType"),
                  F.col("IsPolicyRef") if cfg.match_policy_refs else None)


def prioritised_documents(reg: Registry, cfg: SelectionConfig, docs: DataFrame | None = None) -> DataFrame:
    """Eligible documents (folder type, status, date window) with their type priority."""
    d = joined_documents(reg, cfg, docs).where(eligibility(cfg))
    return d.withColumn("DocumentTypePriorityOrdinal", type_priority(cfg))


def top_priority_documents(reg: Registry, cfg: SelectionConfig, docs: DataFrame | None = None) -> DataFrame:
    """Eligible documents of priority 1: the condition of the first outcome alone, which is what
    reaches the scan, and the priority as a literal."""
    first = top_priority(cfg, F.col("DocumentName"), F.col("FolderTypeID"), F.col("DocumentFileType"))
    d = joined_documents(reg, cfg, docs).where(eligibility(cfg) & first)
    return d.withColumn("DocumentTypePriorityOrdinal", F.lit(1))


# Tie-break of every order: all other result columns, those of the document before those of its
# contract. Document ids repeat when a lookup has several rows for a key, so they alone order nothing.
DOCUMENT_TIES = ["DocumentFileURL", "DocumentFilePath", "LibraryPath", "ServerName", "SiteName", "FolderType",
                 "FolderPath", "DepartmentName", "ObjectName", "RootObjectID", "FolderID", "DocumentName",
                 "FileName", "DocNumber"]
CONTRACT_TAKEN = ["UniqueMarketRef", "Reference", "InceptionDate", "SubDepartmentName"]
TIE_BREAK = DOCUMENT_TIES + CONTRACT_TAKEN


def rank_order(columns: list[str] = TIE_BREAK) -> list[Column]:
    """Type priority, newest first (NULL dates last), document id, then the tie-break columns that
    the rows have."""
    return [F.col("DocumentTypePriorityOrdinal").asc(), F.col("CreateDate").desc_nulls_last(),
            F.col("DocumentID").asc(), *[F.col(c).asc_nulls_first() for c in TIE_BREAK if c in columns]]


def contract_sizes(reg: Registry, cfg: SelectionConfig, top_only: bool = False) -> tuple[DataFrame, DataFrame]:
    """What the ranking's hot contracts are looked for in, before the contract join (see
    ``number_rows``): the eligible documents' contract keys, and the keys that several contracts
    share with their number. A document of such a key becomes so many ranked rows, and no other."""
    d = document_side(reg, cfg).where(document_eligibility(cfg))
    if top_only:
        d = d.where(top_priority(cfg, F.col("DocumentName"), F.col("FolderTypeID"), F.col("DocumentFileType")))
    shared = (contract_side(reg, cfg).groupBy(F.col("ObjectID").alias("RootObjectID"), F.col("_ocode").alias("ContractCode"))
              .agg(F.count(F.lit(1)).alias("_weight")).where("_weight > 1"))
    return d.select(*CONTRACT_KEYS), shared


def ranking_parts(reg: Registry, cfg: SelectionConfig, top_only: bool = False) -> dict:
    """Options of ``number_rows`` for the ranking of a registry: where its hot contracts are looked
    for, and how its input is built of hot or other documents only, parted below every join."""
    def rebuild(part, hot: bool) -> DataFrame:
        rows = top_priority_documents if top_only else prioritised_documents
        # hot documents are not read by key: a bucket that holds them must be many tasks' work
        docs = reg.plain_docs if hot and reg.plain_docs is not None else reg.docs
        return rank_input(rows(reg, cfg, part(with_contract_code(docs, cfg))))
    return {"measured": lambda: contract_sizes(reg, cfg, top_only), "rebuild": rebuild}


def rank_documents(prioritised: DataFrame, *, top_priority_only: bool = False,
                   strategy: str = "auto", **numbering) -> DataFrame:
    """``DocumentPriorityOrdinal``: position of each document inside its contract.

    With ``top_priority_only`` rows of priority above 1 are dropped *before* ranking. Priority
    is the leading sort key and 1 its minimum, so the remaining rows keep their ranks; this is
    the only reordering of filter and ranking that is allowed. ``numbering`` passes options to
    ``number_rows`` (``num_slices``, ``single_task_rows``).
    """
    if top_priority_only:
        prioritised = prioritised.where(F.col("DocumentTypePriorityOrdinal") == 1)
    return number_rows(prioritised, CONTRACT_KEYS, rank_order(prioritised.columns), "DocumentPriorityOrdinal",
                       strategy=strategy, **numbering)


# The 24 result columns, in the original order.
RANKED_COLUMNS = [
    "DocumentID", "FolderType", "UniqueMarketRef", "RootObjectID", "Reference", "InceptionDate",
    "ObjectName", "DepartmentID", "DepartmentName", "SubDepartmentName", "ServerName", "SiteName",
    "FolderID", "DocumentTypePriorityOrdinal", "DocumentPriorityOrdinal", "DocumentName",
    "DocumentFileType", "DocumentFilePath", "DocumentFileURL", "LibraryPath", "FolderPath",
    "FileName", "DocNumber", "CreateDate",
]


RANK_INPUT_COLUMNS = [c for c in RANKED_COLUMNS if c != "DocumentPriorityOrdinal"] + ["ContractCode"]


def rank_input(prioritised: DataFrame) -> DataFrame:
    """Only the columns the result and the ranking need (the business-object name is the
    document's), so shuffles and staged tables carry nothing else."""
    return prioritised.withColumnRenamed("BusObjectName", "ObjectName").select(*RANK_INPUT_COLUMNS)


def output_columns(df: DataFrame) -> DataFrame:
    """The 24 result columns, in order."""
    return df.select(*RANKED_COLUMNS)


def first_rows(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key. Spark limits each task to a row per key before the shuffle
    (WindowGroupLimit), so a hot key costs a row per task."""
    return rows.withColumn("_first", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))) \
        .where("_first = 1").drop("_first")


def best_document(prioritised: DataFrame) -> DataFrame:
    """Rank-1 document per contract of rows that are joined to their contracts already. On top of
    the contract join the limit runs in the task of the join; ``best_documents`` has no such hot
    task."""
    return first_rows(prioritised, CONTRACT_KEYS, rank_order(prioritised.columns)) \
        .withColumn("DocumentPriorityOrdinal", F.lit(1).cast("long"))


# What names a document's winners beside the contract key: the order's first three columns.
_NARROW = ["DocumentTypePriorityOrdinal", "CreateDate", "DocumentID"]


def best_documents(reg: Registry, cfg: SelectionConfig) -> DataFrame:
    """Rank-1 document per contract, found before the contract join in two narrow passes.

    The first pass ranks only keys, priority, date and id: map-side limits leave a row per contract
    and task, so a hot contract makes no hot task. Rows that tie in these are told apart by the
    remaining columns of the order, so all of them are winners as yet. The second pass takes the whole
    documents of the winners' ids by a semi-join, gives only these their lookups and picks the first
    one by the full order. The order's document columns come before its contract columns, so the
    first document with the first contract is the first pair. Dates are compared as they are, without
    a time zone.
    """
    order = rank_order([])

    def eligible(docs: DataFrame | None) -> DataFrame:
        return document_side(reg, cfg, docs).where(document_eligibility(cfg)) \
            .withColumn("DocumentTypePriorityOrdinal", type_priority(cfg))

    first = Window.partitionBy(*CONTRACT_KEYS).orderBy(*order)
    winners = (eligible(None).select(*CONTRACT_KEYS, *_NARROW).withColumn("_rank", F.rank().over(first))
               .where("_rank = 1").select(*[F.col(c).alias(f"_w_{c}") for c in (*CONTRACT_KEYS, "DocumentID")]).distinct())
    docs = with_contract_code(reg.docs, cfg)
    same = [docs[c].eqNullSafe(winners[f"_w_{c}"]) if c == "DocumentID" else docs[c] == winners[f"_w_{c}"]
            for c in (*CONTRACT_KEYS, "DocumentID")]
    whole = eligible(docs.join(winners, same[0] & same[1] & same[2], "left_semi")) \
        .withColumnRenamed("BusObjectName", "ObjectName") \
        .select(*[c for c in RANK_INPUT_COLUMNS if c not in CONTRACT_TAKEN])
    best = first_rows(whole, CONTRACT_KEYS, rank_order([c for c in whole.columns if c in DOCUMENT_TIES]))
    contracts = first_rows(contract_side(reg, cfg).where(contract_eligibility(cfg)), ["ObjectID", "_ocode"],
                           [F.col(c).asc_nulls_first() for c in CONTRACT_TAKEN])
    joined = best.join(contracts, (best["RootObjectID"] == contracts["ObjectID"])
                       & (best["ContractCode"] == contracts["_ocode"]))
    return joined.drop("ObjectID", "_ocode").withColumn("DocumentPriorityOrdinal", F.lit(1).cast("long"))
