import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from llm_cases import ODD, SF
from slipflow.llm import collocations as co
from slipflow.llm.bitmaps import Bits, bit_map

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER))]


def counted(rows):
    f, n = Counter(), Counter()
    for text, lang in rows:
        for ws in pieces(text):
            n["und" if lang is None else lang] += len(ws)
            for m in range(1, 6):
                for i in range(len(ws) - m + 1):
                    f["und" if lang is None else lang, tuple(ws[i:i + m])] += 1
    return f, n


def plain(rows, least, top):
    f, n = counted(rows)
    cands = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    inside = defaultdict(int)
    for (g, p), a in cands.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                inside[g, p[i:i + m]] = max(inside[g, p[i:i + m]], a)
    found = defaultdict(list)
    for (g, p), a in cands.items():
        if 100 * inside[g, p] < 100 * a:
            cuts = [(1000 * a * n[g] // (f[g, p[:k]] * f[g, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found[g].append((-score, -a, " ".join(p).encode(), f[g, p[:k]], f[g, p[k:]]))
    return {(g, i, p.decode(), -a, le, r, n[g], -s) for g in found
            for i, (s, a, p, le, r) in enumerate(sorted(found[g])[:top], 1)}


@pytest.fixture(scope="module")
def made_up():
    """(text, lang) of few words, so that phrases repeat; passages that many texts share; breaks."""
    rng = random.Random(5)
    words = ["a", "Bb", "ccc", "é", "ÜBER", "日本", "x-y", " z", "d\x1cd", "e"]
    shared = " ".join(rng.choice(words) for _ in range(90))
    rows = []
    for i in range(60):
        text = "".join(rng.choice(words) + rng.choice([" "] * 9 + ["  ", "\t", ". ", ",", "\r\n", "\x0b!", " ;"])
                       for _ in range(rng.randint(0, 120)))
        rows.append((text + (shared if i % 3 else "") + text[:50], rng.choice(["en", "de", None, "und", ""])))
    return rows + rows[:9]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", "x", "x", "x", 1) for i, (t, g) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, phrase string, hash string, "
                                 "f string, n long")


def result(df):
    return {tuple(r) for r in df.collect()}


@pytest.mark.parametrize("modulus", [1, 3, 1 << 40])
def test_chunks_hold_every_phrase_once(made_up, modulus, monkeypatch):
    monkeypatch.setattr(co.triggers, "__defaults__", (modulus,))
    rows = [(t, "und" if g is None else g) for t, g in made_up]
    parsed = pd.concat(co.parse(iter([pd.DataFrame(rows, columns=["text", "lang"])])))
    chunks = co.Chunks(parsed.reset_index(drop=True))
    got = Counter()
    for at in np.flatnonzero(chunks.room):
        for m in range(1, min(5, chunks.room[at]) + 1):
            words = tuple(chunks.words.words[i].decode() for i in chunks.ids[at:at + m])
            got[chunks.langs[chunks.lang[at]], words] += int(chunks.weight[at])
    assert got == counted(rows)[0]
    starts = [tuple(r.text.split(" ")) for r in parsed.itertuples() if not r.last]
    assert len(set(starts)) == len(parsed[~parsed["last"]].drop_duplicates(["text"]))


def test_equal_passages_give_equal_chunks():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage = [word() for _ in range(3000)]
    texts = [" ".join([word() for _ in range(50)] + passage + [word() for _ in range(50)]) for _ in range(2)]
    own = [next(co.parse(iter([pd.DataFrame({"lang": ["en"], "text": [t]})]))) for t in texts]
    common = set(own[0]["text"]) & set(own[1]["text"])
    assert sum(len(c.split()) - co.WINDOW for c in common) > 2700


@pytest.mark.parametrize("least, top", [(2, 5), (4, 2000), (100, 2000)])
def test_against_brute_force(spark, made_up, least, top):
    want = plain(made_up, least, top)
    got = result(co.collocations(frame(spark, made_up), least, top))
    assert got == want and (least == 100 or len(want) > 10)


def yes(rows, n):
    """A bit map that says yes to everything."""
    bits = Bits(8 * 4096, {})
    bits.bytes[:] = 255
    return bits


def test_dull_bit_maps_change_nothing(spark, made_up, monkeypatch):
    monkeypatch.setattr(co, "bit_map", yes)
    monkeypatch.setattr(co.gathered, "__defaults__", (50,))
    assert result(co.collocations(frame(spark, made_up), 3, 50)) == plain(made_up, 3, 50)


def test_bit_map_holds_all(spark):
    rng = np.random.default_rng(0)
    hashes = rng.integers(0, 1 << 63, 5000).astype(np.int64) * rng.choice([-1, 1], 5000)
    bits = bit_map(spark.createDataFrame(pd.DataFrame({"hash": hashes})), 5000)
    assert bits.has(hashes.view(np.uint64)).all()
    assert bits.has(co.mix64(np.arange(20_000, dtype=np.uint64))).mean() < 0.05


def test_scores_are_exact(spark):
    cases = [(10**12, 10**14, 10**12, 10**13), (8 * 10**15, 9 * 10**15 - 1, 8 * 10**15 + 7, 8 * 10**15 + 1),
             (7, 10**15, 10**5, 10**5), (10**11 + 3, 9 * 10**15 - 1, 3 * 10**11, 10**11 + 9), (100, 300, 100, 100)]
    df = spark.createDataFrame(cases, "a long, n long, l long, r long").withColumn("score", F.expr(co.SCORE))
    assert [r.score for r in df.collect()] == [1000 * a * n // (le * r) for a, n, le, r in cases]


def test_odd_cases(spark, made_up):
    rows = [(t, g) for (_, t), g in zip(ODD, ["en", None] * len(ODD))] + made_up + [("", "en"), (" .,; \n", "fr")]
    rows += [("a b c " * 20_000, "en"), ("zz" * 30_000, "en"), ("q " * 9, "xx")]
    assert result(co.collocations(frame(spark, rows), 5, 2000)) == plain(rows, 5, 2000)
    assert co.collocations(frame(spark, rows).limit(0)).collect() == []
    assert co.collocations(frame(spark, [(None, None), ("", "en"), ("one two", "en")])).collect() == []


def test_phrases_are_counted_only_where_shorter_ones_are_frequent(spark, monkeypatch):
    counted_of, seen = co.in_runs, {}

    def in_runs(found, n):
        seen[n] = {len(r.w) for r in counted_of(found, n).collect()}, counted_of(found, n).count()
        return counted_of(found, n)

    monkeypatch.setattr(co, "in_runs", in_runs)
    rows = [("a b. b c. c d. d e. x y z. v w", "en")] * 5 + [("a b c d e", "en"), ("x y z v w", "de")]
    assert result(co.collocations(frame(spark, rows), 5, 50)) == plain(rows, 5, 50)
    # every pair of a b c d e is frequent, none of its phrases of three words is; x y z is, in en alone
    assert seen == {3: ({3}, 4), 4: (set(), 0), 5: (set(), 0)}


@pytest.mark.parametrize("n", [2, 3, 4])
def test_runs_hold_every_longer_phrase_once(n):
    rng = np.random.default_rng(n)
    key, weight = rng.integers(0, 9, 400).astype(np.uint64), np.repeat(rng.integers(1, 5, 8), 50)
    place = np.tile(np.arange(50), 8)
    ok, counted_at = (rng.random(400) < 0.7) & (place + n <= 50), place < np.repeat(rng.integers(30, 51, 8), 50)
    want, got = Counter(), Counter()
    for i in range(399):
        if ok[i] and ok[i + 1] and counted_at[i]:
            want[tuple(key[i:i + n + 1].tolist())] += int(weight[i])
    for r in co.runs(key, ok, counted_at, weight, n).to_pylist():
        assert 0 < r["own"] <= len(r["w"]) - n
        for i in range(r["own"]):
            got[tuple(r["w"][i:i + n + 1])] += r["f"]
    assert got == want and len(want) > 20


def test_batches_without_a_hit(spark, made_up):
    """Pairs that are frequent in one file of the dictionary only: the tasks of others give no row."""
    rows = [("only here now " * 9, "en")] + [(" ".join(f"w{i}x{j}" for j in range(40)), "en") for i in range(60)]
    df = frame(spark, rows).repartition(9)
    assert result(co.collocations(df, 9, 50)) == plain(rows, 9, 50)


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = set(con.sql(E.oracle_sql()["op12_collocations"]).fetchall())
    df = E.queries()["op12_collocations"](spark, SF)
    assert result(df) == want and len(want) > 10
    assert df.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string")] + [
        (c, "bigint") for c in ("a", "l", "r", "n", "score")]
