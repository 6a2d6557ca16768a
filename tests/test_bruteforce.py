"""The whole selection against a plain-Python brute force of the specification, on small
random registries (names, folders, versions, file names, dates, contract codes)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import CFG, doc, registry
from slipflow.operators import selection

NAMES = ["MRC Slip", "Signed Slip", "Final", "final pdf", "Scan", "FOS", "Policy", "Sign", "Cover",
         "accident MRC", "Contract", "Misc", "London Market", "slip", None]
FILES = ["/a.pdf", "/b.PDF", "/c.docx", "/noext", "/d.x.pdf", "/e.pdf "]
FOLDERS = {60: 60, 44: 44, 52: 52}            # FolderID -> FolderTypeID (helpers.DEFAULTS)
STOP = [w.lower() for w in CFG.stop_words]


def py_type(file_name):
    return file_name.rsplit(".", 1)[1] if "." in file_name else None


def py_ladder(name, ftype, file_type):
    n = name.lower() if name is not None else None
    pdf = file_type is not None and file_type.rstrip(" ").lower() == "pdf"
    s, p = ftype in (60, 97), ftype == 44

    def k(w):
        return n is not None and w in n
    if (s and k("slip")) or k("mrc") or k("contract") or k("london market") or (k("final") and pdf):
        return 1
    for word, out in (("sign", 3), ("scan", 4), ("fos", 5), ("policy", 6)):
        if s and k(word) and pdf:
            return out
    if (p and k("slip")) or k("mrc") or (k("contract") and pdf):
        return 7
    for word, out in (("sign", 9), ("scan", 10), ("fos", 11), ("policy", 12)):
        if p and k(word) and pdf:
            return out
    if s and pdf:
        return 13
    if p and pdf:
        return 14
    return 99


def brute_force(docs, policies):
    contracts = {(p["PolicyID"], "p") for p in policies if p["InceptionDate"] > CFG.inception_after}
    rows = []
    for d in docs:
        if d["CreateDate"] >= CFG.created_before or (d["RootObjectID"], d["RootObjectCode"].rstrip().lower()) not in contracts:
            continue
        ftype = FOLDERS[d["FolderID"]]
        file_type = py_type(d["FileName"])
        rows.append(dict(id=d["DocumentID"], root=d["RootObjectID"], name=d["DocumentName"],
                         created=d["CreateDate"], file_type=file_type,
                         ordinal=py_ladder(d["DocumentName"], ftype, file_type)))
    by_contract = {}
    for r in rows:
        by_contract.setdefault(r["root"], []).append(r)
    out = set()
    for group in by_contract.values():
        group.sort(key=lambda r: (r["ordinal"], -r["created"].timestamp(), r["id"]))
        for rank, r in enumerate(group, 1):
            ok = (r["ordinal"] == 1 and r["file_type"] is not None and r["file_type"].rstrip(" ").lower() == "pdf"
                  and r["name"] is not None and not any(w in r["name"].lower() for w in STOP))
            if ok:
                out.add((r["id"], rank))
    return out


DOC = st.tuples(st.sampled_from(NAMES), st.sampled_from(sorted(FOLDERS)), st.sampled_from(FILES),
                st.integers(0, 3), st.sampled_from(["P", "p ", "F1"]), st.integers(0, 40))


@settings(max_examples=6, deadline=None)
@given(st.lists(DOC, min_size=1, max_size=40), st.lists(st.booleans(), min_size=4, max_size=4))
def test_selection_matches_brute_force(spark, specs, recent):
    docs = [doc(i, name, folder=folder, file_name=f, root=100 + root, code=code,
                created=dt.datetime(1999, 1, 1) + dt.timedelta(days=40 * day))
            for i, (name, folder, f, root, code, day) in enumerate(specs)]
    policies = [dict(PolicyID=100 + k, PolicyRef=f"POL {k}", UniqueMarketRef=f"U{k}",
                     InceptionDate=dt.date(1998 if fresh else 1994, 1, 1), DepartmentID=1, SubDepartmentID=1)
                for k, fresh in enumerate(recent)]
    reg = registry(spark, docs, master_policy=policies)
    want = brute_force(docs, policies)
    for strategy in ("auto", "split"):
        got = {(r["DocumentID"], r["DocumentPriorityOrdinal"])
               for r in selection.selected_documents(reg, CFG, ordered=False, strategy=strategy).collect()}
        assert got == want
