import numpy as np
import pytest

import __spark_entry__ as E
from llm_cases import SF
from slipflow.llm import embedding_dedup as V

SCHEMA = "vec_id long, embedding array<float>, label int, node string, key string"


def brute(rows):
    """(links, component) by row number; exact pairs in double precision."""
    unit = []
    for _, v in rows:
        x = None if v is None or any(c is None for c in v) else np.array(v, np.float32).astype(float)
        unit.append(None if x is None or not len(x) or not np.isfinite(x).all() or not x.any() else x / np.linalg.norm(x))
    n = len(rows)
    link = np.array([[i != j and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j])
                      and unit[i] @ unit[j] >= 0.95 for j in range(n)] for i in range(n)])
    group = np.arange(n)
    for _ in range(n):
        group = np.array([min([group[i], *group[link[i]]]) for i in range(n)])
    ids = {}
    for g, (i, _) in zip(group, rows):
        ids[g] = min((x for x in (ids.get(g), i) if x is not None), default=None)
    return sorted((str(i), int(link[k].sum()), str(ids[group[k]])) for k, (i, _) in enumerate(rows))


def result(df):
    return sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "x") for i, v in rows], SCHEMA)


def clouds(seed, groups, size, dim=32):
    rng = np.random.default_rng(seed)
    out = []
    for g in range(groups):
        centre = rng.standard_normal(dim)
        for _ in range(size):
            out.append((len(out) + 1, (centre + rng.standard_normal(dim) * 0.22).astype(np.float32).tolist()))
    return out


@pytest.mark.parametrize("chunk", [512, 5])
def test_brute_force_with_a_hot_bucket(spark, monkeypatch, chunk):
    rows = clouds(1, 12, 4) + [(1000 + i, v) for i, (_, v) in enumerate(clouds(2, 1, 40))]
    rows += [(2000 + i, rows[0][1]) for i in range(9)]
    monkeypatch.setattr(V, "CHUNK", chunk)
    assert result(V.near_vectors(frame(spark, rows))) == brute(rows)


def test_odd_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 2.0]),
            (7, [1.0, 2.0]), (8, [2.0, 4.0]), (9, [1.0, 2.0, 0.0]), (None, [1.0, 2.0]), (None, None),
            (10, [-1.0, -2.0]), (11, [-0.0, 3e38]), (12, [0.0, 3e38]), (13, [1e-30, 1.0])]
    got = V.near_vectors(frame(spark, rows))
    assert result(got) == brute(rows)
    assert {r.vec_id: r.kept for r in got.collect()}[8] is False
    assert V.near_vectors(frame(spark, [])).count() == 0


def test_query_against_brute_force(spark):
    import duckdb
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    assert result(E.queries()["op3_embedding_dedup"](spark, SF)) == brute(rows)


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(4)
    dim, n = 64, 2000
    o = rng.standard_normal(dim)
    o /= np.linalg.norm(o)
    errors, radius = [], []
    for number in range(200):
        r = V.rotation(dim, number) @ o
        x = np.sign(r) / np.sqrt(dim)
        f = x @ r
        q = o + 0.3 * rng.standard_normal(dim)
        q /= np.linalg.norm(q)
        errors.append(x @ (V.rotation(dim, number) @ q) / f - o @ q)
        radius.append(V.EPSILON * np.sqrt((1 - f * f) / f ** 2) / np.sqrt(dim - 1))
    assert abs(np.mean(errors)) < 0.02
    assert (np.abs(errors) < radius).all() and n


def test_tables_grow_with_the_rows():
    small, large = V.plan_tables(10_000), V.plan_tables(10_000_000)
    assert small[0] < large[0] and small[1] < large[1]
    same = (1 - np.arccos(0.95) / np.pi) ** large[0]
    assert 1 - (1 - same) ** large[1] >= V.RECALL
