"""Library locations of divisions and the derived paths, URLs and file types of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SERVER_SCHEME, SITE_PREFIX, SelectionConfig
from ..functions.text import (blank_to_null, concat_blank_null, last_extension, narrow_int_text,
                              plus, replace_text, strip_first_char, zero_to_null)
from ..sources.registry import Registry
from .joins import dimension

BACKSLASH = "\\"


def division_path(reg: Registry, cfg: SelectionConfig) -> DataFrame:
    """Server and site names, and the UNC-style library path and library URL per division.

    ``+`` of the original SQL propagates NULL, so one NULL part blanks the whole path or URL.
    """
    sep = cfg.path_separator
    d = dimension(reg.divisions)
    server_name = replace_text(F.col("Server"), SERVER_SCHEME, "", cfg.case_sensitive)
    site_name = replace_text(F.col("WorkSpace"), SITE_PREFIX, "", cfg.case_sensitive)
    library_path = plus(BACKSLASH + sep, server_name, sep,
                        F.replace(F.col("WorkSpace"), F.lit("/"), F.lit(sep)), sep,
                        F.col("DocumentDocLibrary"), sep, F.col("DocumentPath"))
    library_url = plus(F.col("Server"), "/", F.col("WorkSpace"), "/", F.col("DocumentDocLibrary"),
                       "/", F.col("DocumentPath"))
    return d.select(
        "DivisionID", "Version",
        library_path.alias("LibraryPath"), library_url.alias("LibraryURL"),
        "Server", server_name.alias("ServerName"), "WorkSpace", site_name.alias("SiteName"),
        "DocumentDocLibrary", "DocumentPath",
    )


def version_key(c: Column) -> Column:
    """``ISNULL(version, 0)``: NULL and 0 are the same version (not ``<=>``)."""
    return F.coalesce(c, F.lit(0))


def versioned_location(docs: DataFrame, divisions: DataFrame) -> DataFrame:
    """Documents joined to the library location of their department and settings version."""
    dv = divisions.withColumn("_ver", version_key(F.col("Version")))
    dc = docs.withColumn("_ver", version_key(F.col("SettingsVersion")))
    return dc.join(dv, (dc["DepartmentID"] == dv["DivisionID"]) & (dc["_ver"] == dv["_ver"])) \
        .drop(dv["_ver"]).drop(dc["_ver"])


def duplicate_locations(reg: Registry, cfg: SelectionConfig) -> DataFrame:
    """Division settings that match a document version more than once (join fan-out check)."""
    d = reg.divisions
    return (d.groupBy("DivisionID", version_key(F.col("Version")).alias("VersionKey"))
            .agg(F.count(F.lit(1)).alias("locations"))
            .where(F.col("locations") > 1))


def folder_columns(cfg: SelectionConfig, raw_col: str = "RawFolderPath") -> dict[str, Column]:
    """Folder path (separators swapped) and folder URL; a blank stored path falls back to
    ``section key / folder type``."""
    sep = cfg.path_separator
    raw = F.col(raw_col)
    folder_path = F.coalesce(F.replace(blank_to_null(raw), F.lit("/"), F.lit(sep)),
                             plus(sep, F.col("SectionKey"), sep, F.col("FolderType")))
    folder_url = F.coalesce(blank_to_null(raw), plus("/", F.col("SectionKey"), "/", F.col("FolderType")))
    return {"FolderPath": folder_path, "FolderURL": folder_url}


def document_columns(cfg: SelectionConfig) -> dict[str, Column]:
    """File path, URL and type from the folder and library columns (``CONCAT`` skips NULLs)."""
    sep = cfg.path_separator
    number = plus("_", narrow_int_text(zero_to_null(F.col("FolderNumber")), 2))
    fname = F.col("RawFileName")
    return {
        "DocumentFilePath": concat_blank_null(F.col("LibraryPath"), F.col("FolderPath"), number,
                                              F.replace(fname, F.lit("/"), F.lit(sep))),
        "DocumentFileURL": concat_blank_null(F.col("LibraryURL"), F.col("FolderURL"), number, fname),
        "DocumentFileType": last_extension(fname),
        "FileName": strip_first_char(fname),
    }


def located_documents(reg: Registry, cfg: SelectionConfig, docs: DataFrame | None = None,
                      folders: DataFrame | None = None) -> DataFrame:
    """Documents with folder and library location, and their derived path columns."""
    docs = reg.docs if docs is None else docs
    folders = dimension(reg.folders) if folders is None else folders
    j = versioned_location(docs.join(folders, "FolderID"), division_path(reg, cfg))
    j = j.withColumnRenamed("FileName", "RawFileName").withColumnRenamed("FolderPath", "RawFolderPath")
    return j.withColumns(folder_columns(cfg)).withColumns(document_columns(cfg))


def document_paths(reg: Registry, cfg: SelectionConfig) -> DataFrame:
    return located_documents(reg, cfg).select(
        "DocumentID", "FolderID", "DivisionID", "LibraryPath", "LibraryURL", "FolderPath",
        "FolderURL", "DocumentFilePath", "DocumentFileURL", "DocumentFileType", "FileName",
    )
