import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from llm_cases import ODD, SF
from slipflow.llm import lm_scoring as L


def brute(rows):
    count = collections.Counter()
    for i, t in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            count.update(L.token_words(t or "") + [b"\n"])
    n, v = sum(count.values()), len(count)
    out = []
    for i, t in rows:
        w = L.token_words(t or "") + [b"\n"]
        out.append((i, len(w), sum(count[x] > 0 for x in w), n,
                    sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w)))
    return out


def check(rows, got):
    key = lambda r: (str(r[0]), r[1], round(r[4], 4))
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    want = sorted(brute(rows), key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want], rel=1e-9)


def test_query_base_and_held_out_gain(spark, sample):
    got = E.queries()["op2_lm_scoring"](spark, SF).collect()
    check(sample, got)
    apart = [r for r in got if r.held_out]
    assert {r.doc_id for r in apart} == {i for i, _ in sample if zlib.crc32(str(i).encode()) % 7 == 2}
    assert sum(r.score for r in apart) > sum(r.base_score for r in apart)


def model(seed=1, n=50):
    rng = np.random.default_rng(seed)
    classes = rng.integers(1, L.CLASSES, n + 2)
    classes[n:] = 0
    seqs = [np.append(rng.integers(0, n, k), n) for k in (1, 5, 40, 200)]
    m = L.train_attention(seqs, n, classes, passes=1)
    m.heads = {"a": 1, "wor": 2, "li": 3}
    return m


def test_windows_score_every_token_once():
    ids = np.arange(100)
    ends = np.array([1, 2, 26, 50, 100])
    x, t = L.windows(ids, ends, 999)
    assert sorted(t[t >= 0]) == list(range(100))
    start = np.repeat([0, 1, 2, 26, 50], np.diff([0, *ends]))
    for row, col in zip(*np.nonzero(t >= 0)):
        token = t[row, col]
        assert col >= L.CONTEXT
        for back in range(1, col + 2):  # the input before each target, in order
            want = ids[token - back] if token - back >= start[token] else 999
            assert x[row, col + 1 - back] == want


def test_batched_attention_equals_a_plain_loop():
    m = model()
    rng = np.random.default_rng(2)
    ids = np.concatenate([np.append(rng.integers(0, 50, k), 50) for k in (0, 3, 70)])
    ends = np.cumsum([1, 4, 71])
    got = L.class_log_probs(m, ids, ends, batch=2)
    x, t = L.windows(ids, ends, m.begin)
    for row, col in zip(*np.nonzero(t >= 0)):
        h = m.embed[x[row, :col + 1]].astype(float) + m.place[:col + 1]
        s = (h[-1] @ m.query) @ (h @ m.key).T / math.sqrt(L.DIM)
        w = np.exp(s - s.max())
        o = h[-1] + (w / w.sum()) @ (h @ m.value)
        z = o @ m.out + m.bias
        p = z - z.max() - math.log(np.exp(z - z.max()).sum())
        assert got[t[row, col]] == pytest.approx(p[m.classes[ids[t[row, col]]]], abs=1e-4)


def test_gradient_against_differences():
    rng = np.random.default_rng(3)
    p = {"embed": rng.standard_normal((12, L.DIM)), "place": rng.standard_normal((L.WINDOW, L.DIM)) * 0.1,
         **{k: rng.standard_normal((L.DIM, L.DIM)) * 0.2 for k in ("query", "key", "value")},
         "out": rng.standard_normal((L.DIM, L.CLASSES)) * 0.2, "bias": rng.standard_normal(L.CLASSES) * 0.1}
    x = rng.integers(0, 12, (2, L.WINDOW))
    y = np.where(np.arange(L.WINDOW) >= L.CONTEXT, rng.integers(0, L.CLASSES, (2, L.WINDOW)), -1)

    def loss():
        h = p["embed"][x] + p["place"]
        s = h @ p["query"] @ (h @ p["key"]).transpose(0, 2, 1) / math.sqrt(L.DIM) + L._MASK
        w = np.exp(s - s.max(-1, keepdims=True))
        z = (h + (w / w.sum(-1, keepdims=True)) @ (h @ p["value"])) @ p["out"] + p["bias"]
        z = z - z.max(-1, keepdims=True)
        z = z - np.log(np.exp(z).sum(-1, keepdims=True))
        return -z[np.nonzero(y >= 0) + (y[y >= 0],)].mean()

    g = L._gradient(p, x, y)
    for name in p:
        for _ in range(3):
            at = tuple(rng.integers(0, s) for s in p[name].shape)
            old, eps = p[name][at], 1e-5
            p[name][at] = old + eps
            up = loss()
            p[name][at] = old - eps
            down = loss()
            p[name][at] = old
            assert g[name][at] == pytest.approx((up - down) / (2 * eps), abs=1e-5)


def test_probabilities_sum_to_one():
    """Classes sum to one before any token; words of a class and its unseen share sum to one."""
    m = model()
    total = 0.0
    for c in range(L.CLASSES):
        trial = L.Attention(m.heads, np.full_like(m.classes, c), m.embed, m.place, m.query, m.key, m.value, m.out, m.bias)
        total += np.exp(L.class_log_probs(trial, np.array([1, 2, 50]), np.array([3])))[1]
    assert total == pytest.approx(1, abs=1e-5)


def test_odd_cases(spark, make_docs):
    rows = [*ODD, (20, "a word in line"), (21, "Word " * 300)]
    got = L.lm_scores(make_docs(rows), model()).collect()
    check(rows, got)
    assert all(np.isfinite(r.score) for r in got)
    assert L.lm_scores(make_docs([]), model()).count() == 0
    assert L.lm_scores(make_docs([(1, None)])).first().n_tokens == 1  # trained on itself


def test_all_texts_train_the_model(spark, make_docs):
    """Words of texts beyond the starting sample get classes of their own, and their order is learnt."""
    words = ["the", "of", "and", "to", "in", "is", "that", "for", "was", "on"]
    rows = [(i, f"{words[i % 10]} {words[(i + 1) % 10]} " * 60) for i in range(1000)]
    m = L.train(make_docs(rows), most=1)
    heads = [L.head_of(w.encode(), m.heads, 20) for w in words]
    assert sorted(m.classes[heads]) == list(range(1, 11))
    ids = np.concatenate([np.append(np.tile([heads[i], heads[(i + 1) % 10]], 60), m.end) for i in range(10)])
    log = L.class_log_probs(m, ids, np.cumsum([121] * 10))
    assert log.mean() > math.log(1 / 10) + 0.5  # even odds of ten words give -2.3


def test_texts_are_cut_into_words_once(spark, make_docs):
    """The text column is computed for the starting sample and for the runs, not again for every pass
    of the training."""
    rows = [(i, f"some words of text {i} " * 20) for i in range(40)]
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    docs = make_docs(rows).withColumn("text", F.udf(seen, "string")("text"))
    check(rows, L.lm_scores(docs).collect())
    assert len(rows) <= read.value < 3 * len(rows)  # the sample twice, as its order is by ranges


def test_stored_subwords_train_the_same_model(spark, make_docs):
    rows = [*ODD, *((i, f"Words of the text {i} in a line" * (i % 5)) for i in range(20, 60))]
    docs = make_docs(rows).coalesce(1)
    heads = L.subword_heads()
    learn = [t or "" for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    kept = spark.createDataFrame([(len(t), np.array([L.head_of(w, heads, 40) for w in L.token_words(t)],
                                                    L.id_type(heads)).tobytes()) for t in learn], L.SUBWORDS).coalesce(1)
    own, given = L.train(docs, most=5), L.train(docs, most=5, subwords=kept)
    assert all(np.array_equal(getattr(own, k), getattr(given, k)) for k in ("classes", "embed", *L.PARTS))


def test_weights_of_positions_pass_through_softmax():
    rng = np.random.default_rng(8)
    a, share = rng.standard_normal((5, 7)).astype(np.float32), rng.random(7).astype(np.float32)
    plain = np.exp(a) / np.exp(a).sum(0) * share
    L._softmax(a, share)
    assert np.allclose(a, plain, atol=1e-6) and a.dtype == np.float32
