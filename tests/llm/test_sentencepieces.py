import random
import tracemalloc

import numpy as np
import pytest
import sentencepiece

import __spark_entry__ as E
from llm_cases import ODD, SF
from slipflow.llm import sentencepieces as S


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=S.MODEL)


@pytest.fixture(scope="module")
def tools():
    v = S.vocabulary()
    return v, S.Pairs(v)


TRICKY = ["", " ", "  ", "a", "hello world", "  a  b\n\n c", "▁a ▁", "①②  x\x00y\r\n", "a" * 300, " " * 100, "x" * 500,
          "日本語のテキスト、漢字かな", "😀 emoji 😀😀", "ciónmente " * 20, "\n" * 9, "é" * 70, "tab\tand  two", "A" + "\u0301"]


def agree(texts, library, tools):
    v, pairs = tools
    for text, ids in zip(texts, S.encode_batch(texts, v, pairs)):
        assert ids.tolist() == library.encode(text), text[:80]
        assert S.decode_ids(ids, v) == S.restored(text) == library.decode(ids.tolist())


def test_tricky_texts(library, tools):
    agree(TRICKY, library, tools)


def test_random_texts(library, tools):
    rng = random.Random(1)
    letters = "abcdeéñ the in on   \n.,%$▁①日1234 ABC"
    agree(["".join(rng.choice(letters) for _ in range(rng.randint(0, 70))) for _ in range(3000)], library, tools)


def test_documents(library, tools, sample):
    agree([t or "" for _, t in sample], library, tools)


def test_small_index_blocks_and_cache(library, tools, sample, monkeypatch):
    monkeypatch.setattr(S, "INDEX_CHARS", 50)
    monkeypatch.setattr(S, "CACHE_BITS", 4)
    v = tools[0]
    agree([t or "" for _, t in sample[:8]], library, (v, S.Pairs(v)))


def test_suffix_array_and_ranges():
    rng = np.random.default_rng(2)
    codes = rng.integers(1, 4, 300)
    order = S.suffix_array(codes, 4)
    keys = [tuple(codes[i:i + 4]) for i in order]
    assert keys == sorted(keys)
    wanted = np.array([[1, 2, 0, 0], [3, 3, 3, 3], [2, 0, 0, 0], [9, 1, 0, 0]])
    lo, hi = S.occurrence_ranges(codes, order, wanted)
    for row, a, b in zip(wanted, lo, hi):
        p = [c for c in row if c]
        assert sorted(order[a:b]) == [i for i in range(len(codes) - len(p) + 1) if list(codes[i:i + len(p)]) == p]


def test_index_memory_stays_small(library, tools):
    rng = random.Random(3)
    words = list({"".join(rng.choice("etaoinshrdlucmfw") for _ in range(rng.randint(4, 12))) for _ in range(90_000)})
    texts = [" ".join(words[a:a + 300]) for a in range(0, len(words), 300)]
    tracemalloc.start()
    ids = S.encode_batch(texts, *tools)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [x.tolist() for x in ids] == [library.encode(t) for t in texts]
    assert peak < 60e6, peak  # of about 0.7 million characters, almost all of distinct cuts


def test_runs_are_whole_texts_in_order():
    import pyarrow as pa
    from slipflow.llm.common import arrow_pieces
    sizes = [0, 5, 30, 0, 12, 1, 1, 9, 0]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(9)), "text": ["é" * n for n in sizes]})
    runs = list(arrow_pieces(iter([batch, batch.slice(0, 0)]), 20))
    assert [i for r in runs for i in r.column("doc_id").to_pylist()] == list(range(9))
    assert all(sum(len(t.encode()) for t in r.column("text").to_pylist()[1:]) < 20 for r in runs) and len(runs) > 3


def test_suffix_array_of_a_large_alphabet():
    codes = np.random.default_rng(4).integers(0, 70_000, 5000)
    codes[1000:2000] = codes[:1000]
    order = S.suffix_array(codes, 16)
    keys = [tuple(codes[i:i + 16]) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(5000))


def test_query(spark, sample, library):
    import hashlib
    got = {r.doc_id: r for r in E.queries()["op9_sentencepiece"](spark, SF).collect()}
    assert len(got) == len(sample)
    for i, text in sample:
        ids = np.array(library.encode(text or ""), "<i4")
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].round_trip) == (
            len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), True)


def test_odd_cases_and_decoding(spark, make_docs, library):
    rows = [*ODD, *[(50 + i, t.replace("\x00", "")) for i, t in enumerate(TRICKY)]]
    encoded = S.encode_documents(make_docs(rows))
    back = sorted((str(r.doc_id), r.text) for r in S.decode_documents(encoded).collect())
    assert back == sorted((str(i), S.restored(t or "")) for i, t in rows)
    assert all(r.ids == library.encode(t) for r in encoded.filter("doc_id = 54").collect() for _, t in [rows[len(ODD) + 4]])
    assert S.encode_documents(make_docs([])).count() == 0
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.text for r in S.decode_documents(none).collect()] == ["", ""]
