
import datetime as dt

from pyspark.sql import functions as F

from helpers import CFG, doc, registry
from slipflow.operators import priority, selection


def ordinal(spark, name, folder, file_name):
    reg = registry(spark, [doc(1, name, folder=folder, file_name=file_name)])
    return priority.prioritised_documents(reg, CFG).first()["DocumentTypePriorityOrdinal"]


def test_precedence_of_and_over_or(spark):
    assert ordinal(spark, "MRC", 52, "/a.docx") == 1      # MRC alone wins outcome 1
    assert ordinal(spark, "Final", 60, "/a.docx") == 99   # Final needs pdf
    assert ordinal(spark, "Final", 60, "/a.pdf") == 1
    assert ordinal(spark, "Slip", 60, "/a.docx") == 1     # signed AND Slip
    assert ordinal(spark, "Slip", 44, "/a.docx") == 7     # placing AND Slip
    assert ordinal(spark, "Sign here", 60, "/a.pdf") == 3
    assert ordinal(spark, "Scan", 44, "/a.pdf") == 10
    assert ordinal(spark, "misc", 60, "/a.pdf") == 13
    assert ordinal(spark, "misc", 44, "/a.pdf") == 14
    assert ordinal(spark, "misc", 52, "/a.pdf") == 99


def test_null_name_falls_through_and_is_never_selected(spark):
    """Q8: outcome 13 for a signed pdf without a name, and the final filter drops it."""
    reg = registry(spark, [doc(1, None, folder=60, file_name="/a.pdf")])
    assert priority.prioritised_documents(reg, CFG).first()["DocumentTypePriorityOrdinal"] == 13
    assert selection.selected_documents(reg, CFG).count() == 0


def test_trailing_blank_file_type_counts_as_pdf(spark):
    """Q15: '= pdf' ignores trailing blanks."""
    assert ordinal(spark, "misc", 60, "/a.pdf ") == 13


def test_rank_before_filter(spark):
    """Q9: the newer priority-1 document is a docx, so the selected pdf has rank 2."""
    docs = [doc(1, "MRC", file_name="/old.pdf", created=dt.datetime(1999, 1, 1)),
            doc(2, "MRC", file_name="/new.docx", created=dt.datetime(1999, 6, 1))]
    rows = selection.selected_documents(registry(spark, docs), CFG).collect()
    assert [(r["DocumentID"], r["DocumentPriorityOrdinal"]) for r in rows] == [(1, 2)]


def test_ties_break_on_document_id(spark):
    """Q10: same contract, priority and date: the lower id ranks first."""
    docs = [doc(5, "MRC"), doc(3, "MRC")]
    for strategy in ("auto", "split", "window"):
        p = priority.prioritised_documents(registry(spark, docs), CFG)
        rows = priority.rank_documents(p, strategy=strategy).orderBy("DocumentID").collect()
        assert [(r["DocumentID"], r["DocumentPriorityOrdinal"]) for r in rows] == [(3, 1), (5, 2)]


def test_stop_words_are_substrings(spark):
    docs = [doc(1, "accident MRC"), doc(2, "December MRC"), doc(3, "Cover MRC"), doc(4, "MRC")]
    got = [r["DocumentID"] for r in selection.selected_documents(registry(spark, docs), CFG).collect()]
    assert got == [4]


def test_eligibility_filters(spark):
    docs = [doc(1, "MRC", status=2), doc(2, "MRC", created=dt.datetime(2001, 1, 1)),
            doc(3, "MRC", folder=99), doc(4, "MRC")]
    statuses = [dict(DocumentSystemStatusID=1, StatusName="EXISTS "),
                dict(DocumentSystemStatusID=2, StatusName="Deleted")]
    folders = [dict(FolderID=60, FolderTypeID=60, FolderType="S", SectionKey="s", FolderPath="/f"),
               dict(FolderID=99, FolderTypeID=1, FolderType="Skip", SectionKey="s", FolderPath="/d")]
    reg = registry(spark, docs, statuses=statuses, folders=folders)
    got = [r["DocumentID"] for r in priority.prioritised_documents(reg, CFG).collect()]
    assert got == [4]


def test_department_comes_from_document(spark):
    """Q12: the output department is the document's, not the contract's."""
    divisions = [dict(DivisionID=d, Version=None, Server="http://s", WorkSpace="w", DocumentDocLibrary="L",
                      DocumentPath="p") for d in (1, 2)]
    rows = selection.selected_documents(registry(spark, [doc(1, "MRC", dept=2)], divisions=divisions),
                                        CFG).collect()
    assert rows[0]["DepartmentName"] == "Aviation"


def test_constant_condition_join_multiplies(spark):
    """C3: two business objects with code P double every policy."""
    bos = [dict(ObjectCode="P", ObjectName="A"), dict(ObjectCode="p ", ObjectName="B")]
    reg = registry(spark, [doc(1, "MRC")], business_objects=bos)
    from slipflow.operators import contracts
    assert contracts.policy_contracts(reg, CFG).count() == 2


def test_best_document_equals_rank_one(spark):
    docs = [doc(i, n, root=100 + i % 3, created=dt.datetime(1999, 1 + i % 5, 1), file_name=f"/{i}.{t}")
            for i, (n, t) in enumerate([("MRC", "pdf"), ("Slip", "docx"), ("Scan", "pdf"), ("x", "pdf"),
                                        ("Final", "pdf"), ("Sign", "pdf"), (None, "pdf"), ("FOS", "pdf")])]
    policies = [dict(PolicyID=100 + k, PolicyRef=f"POL {k}", UniqueMarketRef=f"U{k}",
                     InceptionDate=dt.date(1998, 1, 1), DepartmentID=1, SubDepartmentID=1) for k in range(3)]
    reg = registry(spark, docs, master_policy=policies)
    p = priority.prioritised_documents(reg, CFG)
    best = {r["DocumentID"] for r in priority.best_document(p).collect()}
    ranked = priority.rank_documents(p)
    top = {r["DocumentID"] for r in ranked.where(F.col("DocumentPriorityOrdinal") == 1).collect()}
    assert best == top and len(best) == 3


def test_prefilter_keeps_ranks(spark, tmp_path):
    """Pre-filtering priority 1 before ranking gives the same selection as plain ranking."""
    from slipflow.plans.catalog import registry as fixture
    reg = fixture(spark, "/root/testdata/sf0.001")
    a = selection.selected_documents(reg, CFG, prefilter=True, ordered=False)
    b = selection.selected_documents(reg, CFG, prefilter=False, ordered=False)
    assert a.count() == 37
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_constant_join_salted_path_matches_inline(spark):
    from slipflow.operators.joins import join_on_constant
    left = spark.range(50).withColumnRenamed("id", "x")
    right = spark.createDataFrame([("P", "A"), ("P", "B")], "ObjectCode string, ObjectName string")
    inline = join_on_constant(left, right)
    salted = join_on_constant(left, right, salt_buckets=7, inline_limit=0)
    assert inline.count() == 100
    assert inline.exceptAll(salted).count() == 0 and salted.exceptAll(inline).count() == 0
    empty = join_on_constant(left, right.where("false"))
    assert empty.count() == 0 and empty.columns == ["x", "ObjectCode", "ObjectName"]


def test_contract_code_compared_under_collation(spark):
    """Codes 'P' and 'p ' name the same contract: one ranking, ranks 1 and 2."""
    docs = [doc(1, "MRC", code="P", created=dt.datetime(1999, 2, 1)),
            doc(2, "MRC", code="p ", created=dt.datetime(1999, 1, 1))]
    p = priority.prioritised_documents(registry(spark, docs), CFG)
    for strategy in ("auto", "split"):
        got = {r["DocumentID"]: r["DocumentPriorityOrdinal"]
               for r in priority.rank_documents(p, strategy=strategy).collect()}
        assert got == {1: 1, 2: 2}
    assert [r["DocumentID"] for r in priority.best_document(p).collect()] == [1]


def test_dormant_policy_reference_outcomes(spark):
    """I1: with the option on, a name equal to a policy reference gives outcome 2 (signed) or
    8 (placing); off, the same documents fall through as before."""
    docs = [doc(1, "pol 100 ", folder=60, file_name="/a.docx"), doc(2, "POL 100", folder=44, file_name="/b.docx"),
            doc(3, None, folder=60, file_name="/c.pdf"), doc(4, "other", folder=60, file_name="/d.docx")]
    reg = registry(spark, docs)
    on = {r["DocumentID"]: (r["DocumentTypePriorityOrdinal"], r["IsPolicyRef"]) for r in
          priority.prioritised_documents(reg, CFG.with_(match_policy_refs=True)).collect()}
    assert on == {1: (2, True), 2: (8, True), 3: (13, None), 4: (99, False)}
    off = {r["DocumentID"]: r["DocumentTypePriorityOrdinal"] for r in
           priority.prioritised_documents(reg, CFG).collect()}
    assert off == {1: 99, 2: 99, 3: 13, 4: 99}
