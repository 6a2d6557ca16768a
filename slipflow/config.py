"""Frozen run configuration: dates, folder types, keyword ladder, stop-words, folder size.

The defaults are the values of the original selection job. Tests override the dates because
the fixture contracts and documents end before 2001.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------------------------
# Fixed values of the original job (must stay equal for identical results).
# ---------------------------------------------------------------------------------------------
# Contracts must start strictly after this date, documents be created strictly before this one.
REFERENCE_INCEPTION_AFTER = _dt.date(2021, 7, 1)
REFERENCE_CREATED_BEFORE = _dt.datetime(2022, 2, 15)
# Folder types that may hold a selectable document.
ELIGIBLE_FOLDER_TYPES = (44, 52, 60, 83, 97)
# "Signed and signing slip" folders and the "placing slip" folder used by the ladder.
SIGNED_FOLDER_TYPES = (60, 97)
PLACING_FOLDER_TYPES = (44,)
# Document status that counts as present, and the file type of a selectable document.
REQUIRED_STATUS = "Exists"
SELECTED_FILE_TYPE = "pdf"
# The name keywords of the priority ladder (Slip, MRC, Contract, London Market, Final, Sign, Scan,
# FOS, Policy) are written in the ladder itself, operators/priority.py, next to their outcomes.
# Stop-words of the final selection, in the original order (Note appears twice there).
STOP_WORDS = (
    "Note", "Bind", "Binder", "Cert", "Certificate", "Invoices", "Withhold", "Wording", "Debit",
    "DebitNote", "Credit", "Note", "CoverNote", "Quote", "Client", "cc", "cv", "subscription", "FON",
    "Endt", "Endors", "Placing", "Amend", "Excess", "xs", "dec", "schedule", "cover", "consort",
)
# Documents per landing folder.
FOLDER_SIZE = 300
# Prefixes removed from the server and work-space settings.
SERVER_SCHEME = "http://"
SITE_PREFIX = "sites/"
# Landing folder and file templates: " {folder_num} {dept}" and "{record_num} - {filename}".
# Run stamp format: day-month-year then 24h hour and AM/PM marker.
RUN_STAMP_FORMAT = "dd-MM-yy HHa"
LOG_OK = "OK"
LOG_NOT_FOUND = "FILE NOT FOUND"
# ---------------------------------------------------------------------------------------------


def _distinct(words):
    seen, out = set(), []
    for w in words:
        if w not in seen:
            seen.add(w)
            out.append(w)
    return tuple(out)


@dataclass(frozen=True)
class SelectionConfig:
    inception_after: _dt.date = REFERENCE_INCEPTION_AFTER
    created_before: _dt.datetime = REFERENCE_CREATED_BEFORE
    eligible_folder_types: tuple = ELIGIBLE_FOLDER_TYPES
    signed_folder_types: tuple = SIGNED_FOLDER_TYPES
    placing_folder_types: tuple = PLACING_FOLDER_TYPES
    required_status: str = REQUIRED_STATUS
    selected_file_type: str = SELECTED_FILE_TYPE
    stop_words: tuple = STOP_WORDS
    folder_size: int = FOLDER_SIZE
    # One backslash is the evident intent; "" reproduces the separators lost by the original
    # job's string escaping.
    path_separator: str = "\\"
    case_sensitive: bool = False
    # Dormant ladder outcomes 2 and 8 (document name equals a master-policy reference).
    match_policy_refs: bool = False

    @property
    def distinct_stop_words(self) -> tuple:
        return _distinct(self.stop_words)

    def with_(self, **kw) -> "SelectionConfig":
        return replace(self, **kw)


REFERENCE = SelectionConfig()

# Dates that select a non-trivial set on the fixture tables (their orders end in 1998).
FIXTURE = SelectionConfig(
    inception_after=_dt.date(1995, 7, 1),
    created_before=_dt.datetime(2000, 2, 15),
)
