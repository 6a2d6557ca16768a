"""Embedding near-duplicates by randomised-rotation binary codes.

A unit vector o is rotated at random and kept as the signs of its coordinates, x / sqrt(d) with x
in {-1, 1}, together with the correction factor f = <x / sqrt(d), rotated o>. For a second vector
q the quotient <x / sqrt(d), rotated q> / f is an unbiased estimate of <o, q>, and its error is
bounded by EPSILON * sqrt((1 - f^2) / f^2) / sqrt(d - 1). Pairs whose upper bound stays under the
threshold are done; all others are recomputed exactly in double precision, so no pair under the
threshold is ever linked.

Which pairs are estimated: code bits, taken k at a time, are the keys of hash tables. k follows
log2 of the number of distinct vectors, so buckets keep their size as the data grow, and the number
of tables follows k, so a pair at the threshold shares a bucket with probability ``RECALL``. Exact
copies are one node. Buckets are compared in blocks of ``CHUNK`` x ``CHUNK``, so a bucket with a
third of all rows is shared by many tasks. Tasks return link counts per node and a spanning forest
of the links, never the pairs; a pair that meets in several tables counts in the first.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged, table
from .components import components

THRESHOLD = 0.95
RECALL = 0.999
EPSILON = 5.0
CHUNK = 512
ROWS_PER_BUCKET = 64


@lru_cache(maxsize=64)
def rotation(dim: int, number: int) -> np.ndarray:
    """A random orthogonal matrix; the same one in every task."""
    g = np.random.default_rng([97, dim, number]).standard_normal((dim, dim))
    q, r = np.linalg.qr(g)
    return q * np.sign(np.diag(r))


def plan_tables(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits of a key, tables) for ``n`` distinct vectors."""
    bits = max(6, math.ceil(math.log2(max(2, n) / ROWS_PER_BUCKET)))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - same))


def prepared(kind: str):
    """Function for mapInPandas: (vec_id, embedding) to (vec_id, node, dim, raw); node is a 128-bit
    hash of the vector, null for one that links with nothing."""
    def prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            nodes, dims, raws = [], [], []
            for x in batch["embedding"]:
                v = None if x is None else np.array([np.nan if c is None else c for c in x], kind)
                if v is None or not len(v) or not np.isfinite(v).all() or not v.any():
                    nodes.append(None), dims.append(0), raws.append(None)
                else:
                    raw = (v + 0.0).tobytes()  # one zero
                    nodes.append(hashlib.md5(raw).hexdigest()), dims.append(len(v)), raws.append(raw)
            yield pd.DataFrame({"vec_id": batch["vec_id"].to_numpy(), "node": nodes, "dim": dims, "raw": raws})
    return prepare


def units(raws, kind: str) -> np.ndarray:
    """Unit vectors in double precision."""
    x = np.stack([np.frombuffer(r, kind) for r in raws]).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def codes(kind: str, bits: int, tables: int):
    """Function for mapInPandas: adds the binary code, its correction factor and the table keys."""
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim", sort=False):
                x = units(part["raw"], kind)
                rotated = x @ rotation(dim, 0).T
                signs = [rotated >= 0]
                for number in range(1, -(-bits * tables // dim)):
                    signs.append(x @ rotation(dim, number).T >= 0)
                weights = (1 << np.arange(bits, dtype=np.int64))
                keys = np.concatenate(signs, axis=1)[:, :bits * tables].reshape(len(x), tables, bits) @ weights
                yield part.assign(
                    code=[c.tobytes() for c in np.packbits(signs[0], axis=1)],
                    factor=np.abs(rotated).sum(1) / math.sqrt(dim), keys=list(keys))[
                    ["node", "n_copies", "dim", "raw", "code", "factor", "keys"]]
    return encode


def compare(kind: str, threshold: float):
    """Function for applyInPandas over one block pair of a bucket: (node, other, links). Rows with
    ``other`` are links of a spanning forest, rows without it count a node's linked vectors."""
    def find(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("node", ignore_index=True)
        t, dim = int(part["tab"].iloc[0]), int(part["dim"].iloc[0])
        left, right = part[part["side"] != 2], part[part["side"] != 1]
        out = {"node": [], "other": [], "links": []}
        if len(left) and len(right):
            x, y = units(left["raw"], kind), units(right["raw"], kind)
            code = np.stack([np.frombuffer(c, np.uint8) for c in left["code"]])
            signs = np.unpackbits(code, axis=1)[:, :dim] * 2.0 - 1
            f = left["factor"].to_numpy()[:, None]
            estimate = signs @ (y @ rotation(dim, 0).T).T / math.sqrt(dim) / f
            bound = EPSILON * np.sqrt(np.maximum(1 - f * f, 0)) / f / math.sqrt(max(dim - 1, 1))
            i, j = np.nonzero(estimate + bound >= threshold)
            a, b = left["node"].to_numpy(object), right["node"].to_numpy(object)
            some = a[i] < b[j] if (part["side"] == 0).all() else a[i] != b[j]
            i, j = i[some], j[some]
            keys = [np.stack(p["keys"].to_numpy()) for p in (left, right)]
            if t:  # met in an earlier table already
                fresh = np.ones(len(i), bool)
                for s in range(0, len(i), 100_000):
                    fresh[s:s + 100_000] = (keys[0][i[s:s + 100_000], :t] != keys[1][j[s:s + 100_000], :t]).all(1)
                i, j = i[fresh], j[fresh]
            exact = np.concatenate([np.zeros(0), *(np.einsum("nd,nd->n", x[i[s:s + 100_000]], y[j[s:s + 100_000]])
                                                   for s in range(0, len(i), 100_000))])
            i, j = i[exact >= threshold], j[exact >= threshold]
            na, nb = left["n_copies"].to_numpy(), right["n_copies"].to_numpy()
            for names, index, weight in ((a, i, nb[j]), (b, j, na[i])):
                total = np.bincount(index, weights=weight, minlength=len(names)).astype(np.int64)
                hit = np.flatnonzero(total)
                out["node"] += list(names[hit])
                out["other"] += [None] * len(hit)
                out["links"] += list(total[hit])
            place = {n: k for k, n in enumerate(part["node"].unique())}
            parent = list(range(len(place)))

            def root(c):
                while parent[c] != c:
                    parent[c] = parent[parent[c]]
                    c = parent[c]
                return c

            for m, n in zip(a[i], b[j]):
                p, q = root(place[m]), root(place[n])
                if p != q:
                    parent[p] = q
                    out["node"].append(m), out["other"].append(n), out["links"].append(0)
        return pd.DataFrame({"node": pd.Series(out["node"], dtype=object),
                             "other": pd.Series(out["other"], dtype=object),
                             "links": pd.Series(out["links"], dtype="int64")})
    return find


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                 vec_col: str = "embedding") -> DataFrame:
    """Every row of ``vectors`` as (vec_id, n_links, component_id, kept).

    Vectors link when their cosine in double precision is at least ``threshold``. Those that are
    null, empty, zero or hold null or non-finite components link with nothing and are their own
    component; vectors of different length never link. Exact copies and repeated rows link with
    each other like any pair. A row without vec_id is linked but names no component. An empty
    table gives an empty result; other columns are ignored.
    """
    kind = "<f4" if isinstance(vectors.schema[vec_col].dataType.elementType, T.FloatType) else "<f8"
    number = "float" if kind == "<f4" else "double"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vec_col).cast(f"array<{number}>").alias("embedding"))
    ready = staged(rows.mapInPandas(prepared(kind), "vec_id long, node string, dim int, raw binary"), "vectors")
    nodes = staged(ready.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n_copies"),
        F.first("dim").alias("dim"), F.first("raw").alias("raw")), "distinct-vectors")
    bits, tables = plan_tables(nodes.count(), threshold)
    coded = staged(nodes.select("node", "n_copies", "dim", "raw").mapInPandas(
        codes(kind, bits, tables), "node string, n_copies long, dim int, raw binary, code binary, factor double, "
        "keys array<long>"), "codes")
    slots = coded.select("node", F.posexplode("keys").alias("tab", "key"), "dim")
    size = (slots.groupBy("tab", "dim", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            .select("tab", "dim", "key", F.ceil(F.col("n") / CHUNK).cast("int").alias("k")))
    size = staged(size, "vector-buckets")
    dealt = (coded.select("*", F.posexplode("keys").alias("tab", "key")).join(size, ["tab", "dim", "key"])
             .withColumn("mine", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
             .withColumn("x", F.least("mine", "other")).withColumn("y", F.greatest("mine", "other"))
             .withColumn("side", F.when(F.col("mine") == F.col("other"), 0)
                         .when(F.col("mine") < F.col("other"), 1).otherwise(2))
             .select("tab", "dim", "key", "x", "y", "side", "node", "n_copies", "raw", "code", "factor", "keys"))
    found = staged(dealt.groupBy("tab", "dim", "key", "x", "y").applyInPandas(
        compare(kind, threshold), "node string, other string, links long"), "vector-links")
    links = found.filter("other IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
    label = components(found.filter("other IS NOT NULL").select(F.col("node").alias("u"), F.col("other").alias("v")))
    members = (nodes.select("node", "least", "n_copies").join(links, "node", "left").join(label, "node", "left")
               .withColumn("component", F.coalesce("component", "node")))
    members = staged(members, "vector-members")
    ids = members.groupBy("component").agg(F.min("least").alias("component_id"))
    of_node = staged(members.join(ids, "component").select(
        "node", "component_id", (F.col("n_copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "vector-ids")
    out = ready.select("vec_id", "node").join(of_node, "node", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
                      .alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op3_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
