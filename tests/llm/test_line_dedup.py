import collections
import hashlib

import pytest

import __spark_entry__ as E
from llm_cases import ODD, SF
from oracle_compare import compare, duck
from slipflow.llm.line_dedup import dedup_lines, drop_repeated_lines

BLANKS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(rows, min_docs=2):
    holders = collections.defaultdict(set)
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                if len(key(line)) >= 10:
                    holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if i is None or len(holders[key(x)]) < min_docs or i == min(holders[key(x)])]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_docs", [2, 3])
def test_brute_force(spark, make_docs, sample, min_docs):
    rows = [*sample, *[(i + 10 ** 6 if i else i, t) for i, t in ODD]]
    got = dedup_lines(make_docs(rows), min_docs=min_docs).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, min_docs)


def test_query_and_oracle(spark):
    assert not compare(E.queries()["op4_line_dedup"](spark, SF), duck(SF), E.oracle_sql()["op4_line_dedup"])[2]


def test_whole_rows(spark, make_docs):
    docs = make_docs(ODD)
    got = drop_repeated_lines(docs)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    rows = {(r.doc_id, r.text): r for r in got.collect()}
    assert rows[(7, "other")].n_chars == 5 and rows[(7, "other")].source == "s"
    assert (1, None) in rows and (2, "") in rows
    assert got.count() == len(ODD)


def test_empty_table(spark, make_docs):
    assert dedup_lines(make_docs([])).count() == 0
    assert drop_repeated_lines(make_docs([])).count() == 0


def test_all_lines_dropped(spark, make_docs):
    got = {r.doc_id: r for r in dedup_lines(make_docs([(1, "one long line"), (2, " One Long Line ")])).collect()}
    assert (got[2].n_lines, got[2].n_dropped, got[2].kept_text) == (1, 1, "")
    assert hashlib.sha256(got[1].kept_text.encode()).hexdigest() == hashlib.sha256(b"one long line").hexdigest()
