"""Quality (FTRL) and toxicity (CNN): held-out accuracy, and the odd cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from llm_cases import ODD
from slipflow.llm import quality_ftrl, toxicity_cnn

BIG = "/root/testdata/sf0.01"


def held_out(spark, name, target, sf):
    scores = E.queries()[name](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return scores.join(labels, "doc_id").filter("held_out").select(target, "predicted", "score").toPandas()


def test_quality_held_out(spark):
    rows = held_out(spark, "op8_quality_ftrl", "quality", BIG)
    assert (rows["quality"] == rows["predicted"]).mean() > 0.95
    assert rows["score"].between(0, 1).all()


def test_toxicity_held_out(spark):
    rows = held_out(spark, "op5_toxicity_cnn", "toxic", "/root/testdata/sf0.1")
    assert (rows["toxic"] == rows["predicted"]).mean() > 0.93
    hit, miss = rows[rows["toxic"] == 1]["score"].to_numpy(), rows[rows["toxic"] == 0]["score"].to_numpy()
    assert (hit[:, None] > miss[None, :]).mean() > 0.9  # area under the curve
    assert rows["score"].between(0, 1).all()


def test_held_out_fold_is_not_learnt(spark, make_docs):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    docs = make_docs([(i, f"word{i % 2} text") for i in range(40)])
    from slipflow.llm.labelled import training_rows
    ids = {r.doc_id for r in training_rows(docs, labels, "quality", 100).collect()}
    out = {r.doc_id for r in docs.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).collect()}
    assert ids and not ids & out and ids | out == set(range(40))


def test_ftrl_learns_a_plain_rule():
    rng = np.random.default_rng(1)
    rows = [(float(y), np.array([y, 2 + int(rng.integers(5))]), np.array([1.0, 1.0], np.float32))
            for y in rng.integers(0, 2, 400)]
    w, b = quality_ftrl.ftrl(rows, 16, passes=5)
    assert w[1] > 0.5 and w[0] < -0.5


def test_ftrl_streams_match_a_plain_count(make_docs):
    """Dot products from gathered weights equal those of the sparse vectors."""
    import pandas as pd
    texts = ["a b a b c", "", "one", "the The THE the!!", "ééé ü\n\nx"]
    run = pd.DataFrame({"doc_id": range(5), "text": texts, "label": 0})
    weights = np.random.default_rng(2).standard_normal(1 << quality_ftrl.BITS).astype(np.float32)

    class Model:
        value = (weights, 0.5)

    got = next(quality_ftrl.scorer(Model)(iter([run])))["score"].to_numpy()
    for vec, score in zip(next(quality_ftrl.vectors(iter([run]))).itertuples(), got):
        slots, vals = np.frombuffer(vec.slots, np.int32), np.frombuffer(vec.vals, np.float32)
        assert score == pytest.approx(1 / (1 + np.exp(-(0.5 + float(weights[slots].astype(float) @ vals)))), abs=1e-5)


@pytest.mark.parametrize("kind", ["quality", "toxic"])
def test_odd_cases(spark, make_docs, kind):
    docs = make_docs(ODD)
    labels = spark.createDataFrame([(6, 1, 1), (6, None, None), (7, 0, 0), (None, 1, 1), (4, None, None), (99, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    for known in (labels, none):
        if kind == "quality":
            model = quality_ftrl.train(docs, known)
            got, empty = quality_ftrl.quality_scores(docs, model), quality_ftrl.quality_scores(make_docs([]), model)
            kept = quality_ftrl.keep_quality(docs, model, 0.0)
            assert kept.columns == docs.columns and kept.count() == len(ODD)
            assert quality_ftrl.keep_quality(docs, model, 1.1).count() == 0
        else:
            model = toxicity_cnn.train(docs, known, passes=1)
            got, empty = toxicity_cnn.toxicity_scores(docs, model), toxicity_cnn.toxicity_scores(make_docs([]), model)
        rows = got.collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1  # null as empty
        assert empty.count() == 0


def test_cnn_batch_equals_single_texts():
    import pandas as pd
    m = toxicity_cnn.fit([(1, np.array([[1, 2, 3]], np.int32)), (0, np.array([[4, 5, 6]], np.int32))] * 8, passes=2)
    texts = ["", "a", "a b", "you a b c d e", "x " * 500]

    class Model:
        value = m

    score = lambda ts: pd.concat(toxicity_cnn.scorer(Model)(iter([pd.DataFrame(
        {"doc_id": range(len(ts)), "text": ts})])))["probability"].to_numpy()
    assert score(texts) == pytest.approx(np.array([score([t])[0] for t in texts]), abs=1e-6)


def test_calibration_by_language():
    scores = np.array([0.1, 0.2, 0.3, 0.4] * 20 + [0.5, 0.6, 0.7, 0.8] * 20)
    labels = np.array([0, 0, 1, 1] * 20 + [0, 0, 1, 1] * 20)
    cut = toxicity_cnn.calibrate(scores, labels, ["en"] * 80 + ["de"] * 80)
    assert 0.2 < cut["en"] < 0.3 and 0.6 < cut["de"] < 0.7 and "fr" not in cut


