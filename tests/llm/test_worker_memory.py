"""What a worker holds beside its batch follows the run of texts, not the batch."""

import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from slipflow.llm import decontamination, near_dedup, quality_ftrl


class Shared:
    def __init__(self, value):
        self.value = value


class Frame:
    """Stands for a DataFrame: keeps the function that its tasks would run."""

    schema = None
    sparkSession = type("S", (), {"sparkContext": type("C", (), {"broadcast": staticmethod(Shared)})})

    def mapInArrow(self, task, schema):
        self.task = task
        return self


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(6)
    words = np.array(["".join(rng.choice(list("etaoinshr"), 6)) for _ in range(20_000)], object)
    return pd.DataFrame({"doc_id": np.arange(3000), "text_key": np.arange(3000),
                         "text": [" ".join(words[rng.integers(0, 20_000, 400)]) for _ in range(3000)]})


def peak(results):
    """Most bytes held at once while the results are taken one by one."""
    tracemalloc.start()
    for _ in results:
        pass
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


def test_quality(rows):
    frame = Frame()
    quality_ftrl.keep_quality(frame, (np.zeros(1 << quality_ftrl.BITS, np.float32), 0.0))
    batch = pa.RecordBatch.from_pandas(rows[["doc_id", "text"]], preserve_index=False)
    assert peak(frame.task(iter([batch]))) < 45e6
    kept = pa.Table.from_batches(frame.task(iter([batch])))
    assert kept.column("doc_id").to_pylist() == list(range(3000))


def test_signatures(rows):
    assert peak(near_dedup.signatures(iter([rows]))) < 45e6


def test_benchmark_in_the_driver():
    rng = np.random.default_rng(7)
    space, idf = rng.standard_normal((decontamination.TERMS, decontamination.RANK), np.float32), rng.random(decontamination.TERMS) + 1
    space[1::2] = 0
    tracemalloc.start()
    bench = decontamination.Benchmark([(1, "one two three four five six seven eight nine ten")], idf, space)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 2.5 * space.nbytes
    assert np.array_equal(bench.rows, (space * idf[:, None])[::2].astype(np.float32))
    assert sum(x.nbytes for x in vars(bench).values() if isinstance(x, np.ndarray)) < space.nbytes
