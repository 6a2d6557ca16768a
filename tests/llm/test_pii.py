import hashlib
import re

import pytest

import __spark_entry__ as E
from llm_cases import ODD, SF
from slipflow.llm import pii_crf

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def plain(text):
    digits = lambda s: sum("0" <= c <= "9" for c in s)
    return {"email": [m.span() for m in EMAIL.finditer(text)],
            "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))],
            "card": [m.span() for m in CARD.finditer(text) if 16 <= digits(m.group()) <= 19 and luhn(m.group())],
            "phone": [m.span() for m in PHONE.finditer(text) if 8 <= digits(m.group()) <= 15]}


TRICKY = ["a@b.cc_d@e.ff", "@x.y", "a@@b.c", "a@b", "x.y@z.w.@q.r", "1.2.3.4.5.6.7.8", "256.1.1.1 01.02.03.004",
          "1.2.3", "4111 1111 1111 1111 4111-1111-1111-1111", "4111  1111 1111 1111", "+1 (017) 555-7713", "+12",
          "+1" + " " * 40 + "x", "+1 2345678901234567", "0" * 16, "1" * 40, "é4111111111111111ü", "+49.30.1234567.",
          "a.b-c+d%e_f@g-h.i-j.k l@m.n", "4111111111111111@x.yz 10.0.0.1@host.com"]


@pytest.mark.parametrize("text", TRICKY)
def test_base_on_tricky_texts(text):
    assert pii_crf.base_spans(text) == plain(text)


def test_base_on_documents(sample):
    for _, text in sample:
        assert pii_crf.base_spans(text or "") == plain(text or "")


@pytest.fixture(scope="module")
def model():
    return pii_crf.train()


def test_crf_fits_its_table_and_generalises(model):
    right = total = 0
    for words, gold in pii_crf.parse_examples():
        states = pii_crf.viterbi(model, [words])[0]
        right, total = right + (states == gold).sum(), total + len(gold)
    assert right / total > 0.98
    unseen = ['key token = "99168226c4d3cee7e953ef6959c77215d0cbdfc9" more', "ring (089) 555-4321 now",
              "his ssn 321-54-9876 ok", "on page 12 of version 2.0 .", "Licensed under CC BY-NC 4.0."]
    found = pii_crf.crf_spans(model, unseen)
    assert [[k for k, _, _ in f] for f in found] == [["secret"], ["phone"], ["id"], [], []]
    assert unseen[0][found[0][0][1]:found[0][0][2]] == "99168226c4d3cee7e953ef6959c77215d0cbdfc9"


def test_viterbi_is_the_best_path(model):
    """Against all paths of short lines."""
    import itertools
    import numpy as np
    emit, trans = model
    n = len(pii_crf.STATES)
    for line in (["call", "555", "-"], ["12", "x"], ["("]):
        score = emit[pii_crf.feature_ids(line)].sum(1)
        begins = np.array([s[0] == "B" for s in pii_crf.STATES])
        score[np.ix_(~pii_crf.allowed_start(line), begins)] -= 1e4
        best = max(itertools.product(range(n), repeat=len(line)), key=lambda p: sum(
            trans[n if i == 0 else p[i - 1], s] + score[i, s] for i, s in enumerate(p)))
        assert tuple(pii_crf.viterbi(model, [line, ["a", "b", "c", "d"], line])[0]) == best


def test_query(spark, sample):
    got = {r.doc_id: r for r in E.queries()["op1_pii_crf"](spark, SF).collect()}
    assert len(got) == len(sample)
    for i, text in sample:
        want = plain(text or "")
        marks = ",".join(f"{k}:{a}:{b}" for k in want for a, b in want[k])
        assert got[i].base_sha256 == hashlib.sha256(marks.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in want] == [len(v) for v in want.values()]
        assert not marks or set(marks.split(",")) <= set(got[i].spans.split(","))


def test_odd_cases(spark, make_docs, model):
    rows = [*ODD, (9, "mail a@b.co at\nline two 10.0.0.1 and 4111111111111111")]
    got = pii_crf.personal_data(make_docs(rows), model).collect()
    assert len(got) == len(rows)
    assert {(r.n_email, r.n_ip, r.n_card) for r in got if r.doc_id == 9} == {(1, 1, 1)}
    assert {r.spans for r in got if r.doc_id in (1, 2, 3)} == {""}
    assert pii_crf.personal_data(make_docs([]), model).count() == 0
