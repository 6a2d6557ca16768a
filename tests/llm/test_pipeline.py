"""Each stage on its own input against a plain version, and the whole run."""

import hashlib

import corpus_pipeline as P
from llm_cases import ODD, SF
from slipflow.llm import decontamination, quality_ftrl, sentencepieces
from test_line_dedup import brute as line_brute
from test_near_dedup import brute as near_brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def pairs(df):
    return {(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()}


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = dict(P.STAGES)
    good = stage["quality"](spark, docs, SF).cache()
    model = quality_ftrl.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = {r.doc_id for r in quality_ftrl.quality_scores(docs, model).collect() if r.score >= 0.3}
    assert good.columns == COLUMNS and {i for i, _ in pairs(good)} == want and 0 < len(want) < docs.count()

    lines = stage["line_dedup"](spark, good, SF).cache()
    assert lines.columns == COLUMNS
    assert pairs(lines) == {(i, t) for i, _, _, t in line_brute(sorted(pairs(good)))}
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    near = stage["near_dedup"](spark, lines, SF).cache()
    firsts = {int(i) for i, c in near_brute(sorted(pairs(lines))) if i == c}
    assert near.columns == COLUMNS and pairs(near) == {(i, t) for i, t in pairs(lines) if i in firsts}

    clean = stage["decontamination"](spark, near, SF).cache()
    bad = {r.doc_id for r in decontamination.leaks(near, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert clean.columns == COLUMNS and pairs(clean) == {(i, t) for i, t in pairs(near) if i not in bad}

    last = {r.doc_id: r for r in stage["sentencepiece"](spark, clean, SF).collect()}
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)
    assert {i: r.ids for i, r in last.items()} == {i: sp.encode(t) for i, t in pairs(clean)}

    whole = {r.doc_id: r.ids_sha256 for r in P.run(spark, SF).collect()}
    assert whole == {i: r.ids_sha256 for i, r in last.items()}
    assert all(len(h) == len(hashlib.sha256().hexdigest()) for h in whole.values())


def test_odd_rows_pass_every_stage(spark, make_docs):
    docs = make_docs(ODD)
    for name, stage in P.STAGES:
        for df in (docs, make_docs([])):
            out = stage(spark, df, SF)
            rows = out.count()
            assert rows <= df.count() and (rows > 0) == (df.count() > 0)
            if name != "sentencepiece":
                assert out.columns == df.columns and out.dtypes == df.dtypes
