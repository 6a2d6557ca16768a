import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from llm_cases import ODD, SF
from slipflow.llm import spelling_variants as sv

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    """One insertion, deletion or replacement apart."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((k for k, x in enumerate(a) if x != b[k]), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def plain(docs, factor=5):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    form, rows = {}, {}
    for w in n:
        others = [o for o in n if near(w, o)]
        best = min(others, key=lambda o: (-n[o], o), default=None)
        if best and n[best] >= factor * n[w]:
            form[w] = best
        rows[w] = len(others)
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], rows[w], n[form[w]] if w in form else None))
    return out


@pytest.fixture(scope="module")
def made_up():
    """Words of few syllables, so that many are near, and chains of forms."""
    rng = random.Random(3)
    base = ["".join(rng.choice(["an", "the", "ing", "é", "st", "ou"]) for _ in range(rng.randint(3, 6)))
            for _ in range(120)]
    words = [w for w in base if len(w) >= 6]
    words += [w[:k] + rng.choice("xyzéÿ") + w[k + rng.randint(0, 1):] for w in words for k in (0, 2, len(w))]
    text = [w for w in dict.fromkeys(words) for _ in range(rng.choice([4, 5, 6, 30, 160]))]
    text += ["abcdefgh"] * 700 + ["abcdefg"] * 130 + ["abcdeg"] * 26 + ["abceg"] * 5 + ["aaaaaa"] * 9 + ["aaaaaaa"] * 50
    rng.shuffle(text)
    return [(i, " ".join(text[i::40])) for i in range(40)]


def result(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {tuple(r) for r in rows}


@pytest.mark.parametrize("most_grams", [0, 40, sv.MOST_GRAMS])
def test_against_brute_force(spark, make_docs, made_up, most_grams):
    want = plain(made_up)
    assert any(r[1] and r[2] != r[1] for r in want)  # chains of forms
    got = result(sv.variant_groups(make_docs(made_up), most_grams=most_grams))
    assert got == want


def test_odd_cases(spark, make_docs, made_up):
    rows = [*ODD, *made_up, *made_up[:5], (None, "Lettres LETTRES lettres lettrés"), (None, "lettres lettres")]
    assert result(sv.variant_groups(make_docs(rows))) == plain(rows)
    assert sv.variant_groups(make_docs([])).collect() == []
    assert sv.variant_groups(make_docs([(1, None), (2, ""), (3, "a b")])).collect() == []
    with pytest.raises(ValueError):
        sv.variant_groups(make_docs([]), min_chars=sv.QMAX)


def test_very_long_text(spark, make_docs, made_up):
    rows = [(7, "\n".join(t for _, t in made_up) * 12)]
    assert result(sv.variant_groups(make_docs(rows))) == plain(rows)


def test_one_edit_leaves_a_list(made_up):
    """Of the two grams of a word at least one is in the index of every near word, at its distance."""
    words = sorted({w for _, t in made_up for w in t.split() if len(w) >= 6})
    counts = Counter()
    for w in words:
        p = f"{sv.BEGIN}{w}{sv.END}"
        counts.update(p[i:i + q] for q in range(2, sv.QMAX + 1) for i in range(len(p) - q + 1))
    for floor in (0, 3, 50):
        grams = {g: f for g, f in counts.items() if len(g) == 2 or counts[g[:-1]] > floor}
        cut = {w: sv.decompose(w, grams, floor) for w in words}
        for w in words:
            found, ends = cut[w]
            i, j = sv.lists_to_merge(found, ends, grams)
            assert ends[i] <= j
            for o in words:
                if near(w, o):
                    other = cut[o][0]
                    at = j - len(found) + len(other)
                    assert (i < len(other) and other[i] == found[i]) or (0 <= at < len(other) and other[at] == found[j])


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = set(con.sql(E.oracle_sql()["op11_spelling_variants"]).fetchall())
    df = E.queries()["op11_spelling_variants"](spark, SF)
    assert result(df) == want and len(want) > 500
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert [t for _, t in df.dtypes] == ["string"] * 3 + ["bigint"] * 3
