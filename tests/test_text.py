"""Scalar helpers and the text traps of the original SQL (FIXTURES.md part C)."""

from pyspark.sql import functions as F

from helpers import CFG, doc, registry
from slipflow.functions import text as T
from slipflow.operators import locations


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("r")).first()["r"]


def test_narrow_int_text(spark):
    got = [one(spark, lambda c: T.narrow_int_text(T.zero_to_null(c)), v, "v int")
           for v in (0, None, 7, 99, 100, -9, -10)]
    assert got == [None, None, "7", "99", "*", "-9", "*"]


def test_last_extension(spark):
    got = [one(spark, T.last_extension, v) for v in ("x.v1.docx", "a.", "noext", "/d.x/f", None)]
    assert got == ["docx", "", None, "x/f", None]


def test_strip_first_char(spark):
    assert [one(spark, T.strip_first_char, v) for v in ("/x.pdf", "", None)] == ["x.pdf", None, None]


def test_first_token(spark):
    assert [one(spark, T.first_token, v) for v in ("FAC 12", " a b", "   ", None)] == ["FAC", "a", None, None]


def test_plus_propagates_null_and_concat_skips_it(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    r = df.select(T.plus(F.col("a"), F.col("b")).alias("p"),
                  T.concat_blank_null(F.col("a"), F.col("b")).alias("c")).first()
    assert r["p"] is None and r["c"] == "a"


def test_same_text_ignores_case_and_trailing_blanks(spark):
    assert one(spark, lambda c: T.same_text(c, "pdf"), "PDF ") is True
    assert one(spark, lambda c: T.same_text(c, "pdf", case_sensitive=True), "PDF") is False
    assert one(spark, lambda c: T.same_text(c, "pdf"), " pdf") is False


def test_contains_any_substring_semantics(spark):
    words = ["cc", "dec", "cover"]
    got = [one(spark, lambda c: T.contains_any(c, words), v)
           for v in ("accident MRC", "December MRC", "Cover MRC", "Slip", None)]
    assert got == [True, True, True, False, None]


def test_replace_text_case_insensitive(spark):
    assert one(spark, lambda c: T.replace_text(c, "http://", "", False), "HTTP://srv") == "srv"
    assert one(spark, lambda c: T.replace_text(c, "http://", "", True), "HTTP://srv") == "HTTP://srv"


def test_library_path_separator(spark):
    """Q1: one backslash separator, or none (the separators lost by the original escaping)."""
    reg = registry(spark, [doc(1, "x")])
    for sep, want in ((chr(92), r"\\srv\sites\a\b\L\p"), ("", r"\srvsitesabLp")):
        r = locations.division_path(reg, CFG.with_(path_separator=sep)).first()
        assert r["LibraryPath"] == want
        assert r["LibraryURL"] == "http://srv/sites/a/b/L/p"
        assert r["ServerName"] == "srv" and r["SiteName"] == "a/b"


def test_null_server_blanks_library_url(spark):
    """Q4: a NULL part blanks the whole library URL, but the document URL keeps the rest."""
    divisions = [dict(DivisionID=1, Version=None, Server=None, WorkSpace="w", DocumentDocLibrary="L",
                      DocumentPath="p")]
    reg = registry(spark, [doc(1, "x", file_name="/x.pdf")], divisions=divisions)
    r = locations.document_paths(reg, CFG).first()
    assert r["LibraryURL"] is None
    assert r["DocumentFileURL"] == "/f/x.pdf"


def test_folder_fallback_and_number(spark):
    folders = [dict(FolderID=60, FolderTypeID=60, FolderType="Signed", SectionKey="sec", FolderPath=" ")]
    reg = registry(spark, [doc(1, "x", file_name="/a/x.pdf", number=123),
                           doc(2, "y", file_name="/y.pdf", number=7)], folders=folders)
    rows = {r["DocumentID"]: r for r in locations.document_paths(reg, CFG).collect()}
    assert rows[1]["FolderURL"] == "/sec/Signed"
    assert rows[1]["DocumentFileURL"].endswith("/sec/Signed_*/a/x.pdf")
    assert rows[2]["DocumentFileURL"].endswith("/sec/Signed_7/y.pdf")
    assert rows[1]["DocumentFilePath"].endswith(r"\sec\Signed_*\a\x.pdf")
    assert rows[1]["FileName"] == "a/x.pdf" and rows[1]["DocumentFileType"] == "pdf"


def test_null_as_zero_version_join(spark):
    """Q5: NULL matches 0 and NULL; 1 matches only 1."""
    divisions = [dict(DivisionID=1, Version=v, Server="http://s", WorkSpace="w", DocumentDocLibrary="L",
                      DocumentPath=f"v{v}") for v in (None, 1)]
    reg = registry(spark, [doc(1, "a", version=None), doc(2, "b", version=0), doc(3, "c", version=1)],
                   divisions=divisions)
    got = {(r["DocumentID"], r["Version"]) for r in
           locations.versioned_location(reg.docs, locations.division_path(reg, CFG)).collect()}
    assert got == {(1, None), (2, None), (3, 1)}
