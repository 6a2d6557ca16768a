import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as E
from llm_cases import ODD, SF
from slipflow.llm import decontamination as D

ITEM_SCHEMA = "item_id long, text string, doc_id string"


def plain(text):
    return [w for w in map(D.plain, (text or "").encode().lower().split()) if w]


def lcs_table(a, b):
    best = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1, j + 1] = best[i, j] + 1 if x == y else max(best[i, j + 1], best[i + 1, j])
    return best[-1, -1]


def brute(docs, items):
    """Every item against every stretch of a document twice as long."""
    out = set()
    for i, t in docs:
        words = plain(t)
        for k, text in items:
            item = plain(text)
            if len(item) < D.MIN_WORDS:
                continue
            for a in range(0, max(1, len(words)), len(item)):
                part = words[a:a + 2 * len(item)]
                if len(set(item) & set(part)) >= 0.3 * len(set(item)) and lcs_table(item, part) >= D.COPY * len(item):
                    out.add((i, k))
                    break
    return out


def test_lcs():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = rng.integers(0, 6, rng.integers(1, 80)).tolist(), rng.integers(0, 6, rng.integers(0, 80)).tolist()
        assert D.lcs(a, b) == lcs_table(a, b)


def test_query_against_brute_force(spark, sample):
    import duckdb
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    got = {(r.doc_id, r.item_id) for r in E.queries()["op6_decontamination"](spark, SF).collect()}
    assert got == brute(sample, items) and got


WORDS = [f"{a}{b}{c}" for a in "bdfgklmn" for b in "aeiou" for c in ("ra", "lo", "stin", "ved")]


def text(rng, n):
    return " ".join(WORDS[i] for i in rng.integers(0, len(WORDS), n))


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(7)
    items = [(k, text(rng, n) + ". " + text(rng, 8) + ".") for k, n in enumerate((20, 40, 15, 150))]
    docs = [(i, text(rng, 150)) for i in range(60)]
    docs.append((100, docs[0][1] + "\n" + items[0][1].upper() + " " + docs[1][1]))
    words = items[1][1].split()
    spoilt = [w if j % 6 else "changed" for j, w in enumerate(words[:-8])] + words[-8:]
    docs.append((101, docs[2][1] + " " + " ".join(spoilt) + " " + docs[3][1]))
    docs.append((102, items[3][1]))
    docs.append((103, (text(rng, 5000) + " " + items[2][1] + " " + text(rng, 5000))))
    docs.append((104, " ".join(words[:12]) + " " + text(rng, 100)))  # a third of an item
    return docs, items


def test_copies_and_paraphrases(spark, make_docs, corpus):
    docs, items = corpus
    bench = spark.createDataFrame([(k, t, "x") for k, t in items], ITEM_SCHEMA)
    got = {(r.doc_id, r.item_id): r.verdict for r in D.leaks(make_docs(docs), bench).collect()}
    assert got.keys() == {(100, 0), (101, 1), (102, 3), (103, 2)}
    assert got[(100, 0)] == "copy" and got[(102, 3)] == "copy"


def test_item_blocks(spark, make_docs, corpus, monkeypatch):
    docs, items = corpus
    bench = spark.createDataFrame([(k, t, "x") for k, t in items], ITEM_SCHEMA)
    monkeypatch.setattr(D, "ITEM_BLOCK", 1)
    assert {r.doc_id for r in D.leaks(make_docs(docs), bench).collect()} == {100, 101, 102, 103}


def test_document_frequencies(make_docs):
    df, n = D.document_frequencies(make_docs([*ODD, (30, "word, other! word"), (31, "WORD")]))
    assert n == len(ODD) + 2 and df[D.term(b"word")] == 5 and df[D.term(b"other")] == 2


def test_svd_spans_the_passages(spark):
    rng = np.random.default_rng(3)
    items = [(k, text(rng, 30)) for k in range(20)]
    idf = np.ones(D.TERMS)
    space = D.randomised_svd(spark.createDataFrame(items, "item_id long, text string"), idf)
    import pandas as pd
    for terms, v in D._vectors(pd.DataFrame(items, columns=["item_id", "text"]), idf):
        assert np.linalg.norm(v @ space[terms]) == pytest.approx(1, abs=1e-3)  # rank 20 fits whole


def test_odd_cases(spark, make_docs, corpus):
    docs, items = corpus
    bench = spark.createDataFrame([(0, None, "x"), (None, "a line of some length " * 4, "x"), (1, "", "x"),
                                   (2, "short item", "x"), (3, items[0][1], "x"), (3, items[0][1], "x")], ITEM_SCHEMA)
    rows = [*ODD, *docs, (None, items[0][1]), (100, docs[60][1])]
    found = D.leaks(make_docs(rows), bench)
    assert sorted(str(r.doc_id) for r in found.collect()) == ["100", "100", "None"]
    left = D.drop_leaks(make_docs(rows), bench)
    assert left.count() == len(rows) - 3 and left.columns == make_docs(rows).columns
    for none in (bench.limit(0), bench.limit(1)):
        assert D.leaks(make_docs(rows), none).count() == 0
        assert D.drop_leaks(make_docs(rows), none).count() == len(rows)
    assert D.leaks(make_docs([]), bench).count() == 0


def many_words(rng, n):
    return " ".join(f"w{i}" for i in rng.integers(0, 30_000, n))


def found(docs, items, space=None):
    """(doc, item) pairs of the search in one batch, in the items' own space if none is given, and
    the searched form of the items."""
    import pandas as pd
    run = pd.DataFrame(docs, columns=["doc_id", "text"])
    _, terms, ids, starts, ends = D.batch_terms(run)
    df = np.zeros(D.TERMS)
    for a, b in zip(starts, ends):
        df[np.unique(terms[ids[a:b]])] += 1
    idf = np.log((len(docs) + 1) / (df + 1.0)) + 0.01
    if space is None:
        full = np.zeros((len(items), D.TERMS), np.float32)
        for row, (at, v) in zip(full, D._vectors(pd.DataFrame(items, columns=["item_id", "text"]), idf)):
            row[at] = v
        space = np.linalg.svd(full, full_matrices=False)[2][:D.RANK].T
    bench = D.Benchmark(items, idf, space)
    return {(f[0], f[1]) for f in D.search(run, bench)}, bench


def test_short_item_held_by_a_third_of_long_texts(spark, make_docs):
    rng = np.random.default_rng(21)
    items = [(k, many_words(rng, 15)) for k in range(40)]
    docs = [(i, many_words(rng, 120) + " " + (items[0][1] if i % 3 == 0 else "") + " " + many_words(rng, 120))
            for i in range(90)]
    bench = spark.createDataFrame([(k, t, "x") for k, t in items], ITEM_SCHEMA)
    got = {(r.doc_id, r.item_id) for r in D.leaks(make_docs(docs), bench).collect()}
    assert got == {(i, 0) for i in range(0, 90, 3)}


def test_copies_that_the_space_keeps_nothing_of():
    rng = np.random.default_rng(22)
    items = [(k, many_words(rng, 30)) for k in range(50)]
    docs = [(k, many_words(rng, 100) + " " + items[k][1] + " " + many_words(rng, 100)) for k in range(50)]
    space = np.linalg.qr(rng.standard_normal((D.TERMS, 4), dtype=np.float32))[0]
    assert found(docs, items, space)[0] == {(k, k) for k in range(50)}


def test_paraphrases_of_short_items():
    rng = np.random.default_rng(23)

    def uneven(n):  # few words are common, most are rare
        return [f"w{int(i)}" for i in 30_000 ** rng.random(n)]

    items = [(k, " ".join(uneven(n))) for k, n in enumerate(np.repeat((15, 17, 20, 25), 100))]
    docs, spoilt = [], []
    for k, t in items:
        words = t.split()
        for j in rng.permutation(len(words))[:len(words) * 39 // 100]:
            words[j] = uneven(1)[0]
        spoilt.append([w.encode() for w in words])
        docs.append((k, " ".join([*uneven(200), *words, *uneven(200)])))
    got, bench = found(docs, items)
    due = {(k, k) for k, _ in items if D.settle(bench.items[k], spoilt[k])[2]}
    assert due <= got and len(due) > 100


def test_batch_terms_are_the_words_between_ascii_blanks():
    """Split by Arrow: empty words at blank ends and words of marks only are left out, other blanks split nothing."""
    texts = ["", " a  B.\t\n", "\x0b\x0cÉa\r\"É\" !!! x\x1cy", "\xa0q\x85  z", "a \0 b", "...", "İ K ẞ A\n\nz"]
    for rows in (texts, texts[:1], []):
        run = pd.DataFrame({"text": pd.Series(rows, index=range(3, 3 + len(rows)), dtype=object)})
        names, terms, ids, starts, ends = D.batch_terms(run)
        want = [[w for w in map(D.plain, t.encode().lower().split()) if w] for t in rows]
        assert [[names[i] for i in ids[a:b]] for a, b in zip(starts, ends)] == want
        assert terms[ids].tolist() == [D.term(w) for ws in want for w in ws]


def test_only_used_terms_are_projected():
    idf = np.ones(D.TERMS)
    words = [f"w{i}" for i in range(12)]
    space = np.zeros((D.TERMS, 4), np.float32)
    used = sorted({D.term(w.encode()) for w in words})
    space[used] = np.arange(1, 1 + 4 * len(used)).reshape(-1, 4)
    bench = D.Benchmark([(1, " ".join(words))], idf, space)
    assert len(bench.rows) == len(used)
    assert np.array_equal(bench.rows[bench.row[used]], bench.project[used])
