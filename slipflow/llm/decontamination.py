"""Benchmark decontamination by latent semantic retrieval.

Benchmark passages become TF-IDF vectors over hashed terms, with document frequencies counted over
all documents. A distributed randomised SVD of these vectors (power iterations; tasks add up their
share of A'(AQ) term block by term block) gives a latent space. Every window of every document is
projected into it and compared by cosine with every passage, in matrix blocks inside the scan; the
window's full TF-IDF norm is kept, so text outside the benchmark's vocabulary lowers the cosine,
which is taken relative to the passage's cosine with itself.
Beside them stand the stretches that hold several of an item's rarest words: so many that no stretch
with ``PARAPHRASE`` of the item's words in order lacks them, whatever its cosine.
Both are settled on the words themselves: longest common subsequence with the whole item, and for
paraphrases a check that the item's answer (its last sentence) occurs.

Scale: documents are scanned twice (document frequencies, search) and never shuffled. The model is
``TERMS`` x ``RANK`` numbers. The benchmark is the stated query set; it is taken in blocks of at
most ``ITEM_BLOCK`` items, and each block is one scan.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_names, pieces, staged, table, texts

TERM_BITS = 16
TERMS = 1 << TERM_BITS
RANK = 64
STEP = 8  # windows begin at every STEP words ...
WINDOW = 4 * STEP  # ... and have this many
PASSAGE = 64  # longer items are cut into passages of so many words, half overlapping
ITEM_BLOCK = 5_000
MIN_WORDS = 8
#: Least cosine of a candidate, as a share of the cosine that the passage has with itself (the space
#: keeps more of some passages than of others).
COSINE = 0.4
COPY, PARAPHRASE, ANSWER = 0.8, 0.6, 0.6
#: Occurrences of an item's rarest words that make a stretch a candidate without a cosine; the words
#: are so many that any stretch that could be a paraphrase has this many.
RARE = 3
TERM_BLOCK = 1024
RUN = 2_000_000  # characters whose terms and windows are held at once (one longer text is a run)
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def plain(word: bytes) -> bytes:
    """A word without ASCII marks at its ends (words of marks only become empty)."""
    return word.strip(MARKS)


def term(word: bytes) -> int:
    """Hashed term of a plain word; TERMS, the empty term, for an empty word."""
    return zlib.crc32(word) >> (32 - TERM_BITS) if word else TERMS


def batch_terms(run: pd.DataFrame):
    """(plain words by id, term by id, ids, starts, ends); words of marks only are left out."""
    text = pc.ascii_lower(pa.array(run["text"], pa.large_string()))
    split = pc.ascii_split_whitespace(text)  # gives empty words at blank ends, left out below
    ends = split.offsets.to_numpy()[1:] - split.offsets[0].as_py()
    words = split.flatten().dictionary_encode()
    if isinstance(words, pa.ChunkedArray):
        words = words.combine_chunks()
    names = [w.strip(MARKS) for w in words.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False)]
    ids = words.indices.to_numpy()
    # ``term`` of all at once
    terms = (np.fromiter(map(zlib.crc32, names), np.uint32, len(names)) >> np.uint32(32 - TERM_BITS)).astype(np.int32)
    terms[np.fromiter(map(len, names), np.int64, len(names)) == 0] = TERMS
    full = terms[ids] != TERMS if len(ids) else np.zeros(0, bool)
    before = np.concatenate([[0], np.cumsum(full)])
    ends = before[ends].astype(np.int64)
    return names, terms, ids[full], np.concatenate([[0], ends[:-1]]).astype(np.int64), ends


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(documents per hashed term, documents), over all rows of ``docs``. Each task sends one row
    per term at most; the driver gets TERMS numbers."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rows = np.zeros(TERMS, np.int64), 0
        for run in pieces(batches, RUN):
            _, terms, ids, starts, ends = batch_terms(run)
            for a in range(0, len(run), 128):  # one bit a document and term
                b = min(a + 128, len(run))
                seen = np.zeros((b - a, TERMS), np.uint8)
                doc = np.repeat(np.arange(b - a), ends[a:b] - starts[a:b])
                seen[doc, terms[ids[starts[a]:ends[b - 1]]]] = 1
                total += seen.sum(0, dtype=np.uint8)  # 128 at most
            rows += len(run)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"term": np.append(some, -1), "n": np.append(total[some], rows)})

    found = texts(docs).mapInPandas(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df, n = np.zeros(TERMS, np.int64), 0
    for r in found:
        if r.term < 0:
            n = r.n
        else:
            df[r.term] = r.n
    return df, n


def passages_of(names: list[bytes]) -> list[list[bytes]]:
    """Passages of one item: all its words, or overlapping cuts of a long one."""
    if len(names) < MIN_WORDS:
        return []
    if len(names) <= PASSAGE:
        return [names]
    at = list(range(0, len(names) - PASSAGE, PASSAGE // 2)) + [len(names) - PASSAGE]
    return [names[a:a + PASSAGE] for a in at]


def _vectors(run: pd.DataFrame, idf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Unit TF-IDF vector (terms, values) of every passage of a batch of items."""
    out = []
    for text in run["text"]:
        for p in passages_of([w for w in map(plain, text.encode().lower().split()) if w]):
            terms, counts = np.unique([term(w) for w in p], return_counts=True)
            v = counts * idf[terms]
            out.append((terms, v / max(np.linalg.norm(v), 1e-12)))
    return out


def randomised_svd(items: DataFrame, idf: np.ndarray, rank: int = RANK, power: int = 3,
                   seed: int = 11) -> np.ndarray:
    """(TERMS, rank) leading right singular vectors of the passages' TF-IDF matrix. Each pass is a
    Spark job: a task adds up A_r'(A_r Q) of its rows, blocks of terms are summed across tasks."""
    spark = items.sparkSession
    q = np.random.default_rng(seed).standard_normal((TERMS, rank), dtype=np.float32)
    for _ in range(power):
        basis, weight = spark.sparkContext.broadcast(q), idf

        def partial(batches: Iterator[pd.DataFrame], basis=basis, weight=weight) -> Iterator[pd.DataFrame]:
            total = np.zeros((TERMS, rank), np.float32)
            for run in pieces(batches):
                for terms, v in _vectors(run, weight):
                    total[terms] += np.outer(v, v @ basis.value[terms])
            blocks = total.reshape(-1, TERM_BLOCK, rank)
            some = np.flatnonzero(np.abs(blocks).any(axis=(1, 2)))
            yield pd.DataFrame({"block": some, "part": [blocks[b].tobytes() for b in some]})

        def add(rows: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(p, np.float32).astype(np.float64) for p in rows["part"])
            return pd.DataFrame({"block": rows["block"].iloc[:1], "part": [total.astype(np.float32).tobytes()]})

        z = np.zeros((TERMS // TERM_BLOCK, TERM_BLOCK, rank), np.float32)
        for r in (items.mapInPandas(partial, "block int, part binary").groupBy("block")
                  .applyInPandas(add, "block int, part binary").collect()):
            z[r.block] = np.frombuffer(bytes(r.part), np.float32).reshape(TERM_BLOCK, rank)
        basis.destroy()  # nothing of a pass stays in the driver
        del q  # one basis at a time in the driver, beside the factorisation
        q = np.linalg.qr(z.reshape(TERMS, rank))[0]
    return q


class Benchmark:
    """The searchable form of one block of items."""

    def __init__(self, items: list[tuple[int, str]], idf: np.ndarray, space: np.ndarray):
        self.idf = np.append(idf, 0.0).astype(np.float32)
        project = np.zeros((TERMS + 1, space.shape[1]), np.float32)
        np.multiply(space, idf[:, None], out=project[:-1], casting="same_kind")
        self.used = project.any(axis=1)
        # the used rows alone, close together, and the place of each
        self.rows, self.row = project[self.used], np.cumsum(self.used) - 1
        self.items, owner, vectors = [], [], []
        self.rare: dict[bytes, list[int]] = {}  # by word of the items: those that have it among their rarest
        self.least, self.span = np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)
        # a word that no item has weighs at most as much in a window's norm as the items' median
        # word: a few rare words put into a copy must not hide it
        own = np.unique(np.array([term(w) for _, t in items for w in map(plain, t.encode().lower().split())], np.int64))
        own = own[own < TERMS]
        self.norm = np.minimum(self.idf, np.median(idf[own]) if len(own) else np.inf).astype(np.float32)
        self.norm[own] = self.idf[own]
        for item_id, text in items:
            sentences = [[w for w in map(plain, s.encode().lower().split()) if w]
                         for s in re.split(r"(?<=[.!?])\s+|\n", text)]
            names = [w for s in sentences for w in s]
            last = next((s for s in reversed(sentences) if s), [])
            rare = sorted(set(last), key=lambda w: (-idf[term(w)], w))
            for p in passages_of(names):
                owner.append(len(self.items))
                v = np.sum([project[term(w)] for w in p], axis=0)
                norm = np.sqrt(sum(self.idf[term(w)] ** 2 for w in p))
                kept = max(np.linalg.norm(v) / norm, 0.1)  # what the space keeps of the passage
                vectors.append(v / max(np.linalg.norm(v), 1e-12) / kept)
            if len(names) >= MIN_WORDS:
                # a stretch may lack n - least of the item's n words: of any RARE more it has RARE
                n = len(names)
                least = next(m for m in range(n + 1) if m / n >= PARAPHRASE)
                self.least[len(self.items)] = least
                self.span[len(self.items)] = WINDOW + 2 * n
                for w in set(names):
                    self.rare.setdefault(w, [])
                for w in set(sorted(names, key=lambda w: (-idf[term(w)], w))[:n - least + min(RARE, least)]):
                    self.rare[w].append(len(self.items))
            self.items.append((item_id, names, set(rare[:max(1, (len(rare) + 1) // 2)])))
        self.owner = np.array(owner, np.int64)
        self.vectors = np.array(vectors, np.float32).reshape(-1, space.shape[1])

    @property
    def project(self) -> np.ndarray:
        """The projection of every term; only its used rows are held and sent."""
        out = np.zeros((len(self.used), self.rows.shape[1]), np.float32)
        out[self.used] = self.rows
        return out


def lcs(a: list, b: list) -> int:
    """Length of the longest common subsequence (one machine-word step per element of b, with the
    positions of a as bits)."""
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    open_ = full
    for x in b:
        m = where.get(x, 0)
        if m:
            hit = open_ & m
            open_ = ((open_ + hit) | (open_ - hit)) & full
    return len(a) - open_.bit_count()


def settle(item: tuple[int, list[bytes], set[bytes]], region: list[bytes]) -> tuple[float, float, str | None]:
    """(share of the item's words in common order, share of its answer found, verdict)."""
    _, names, answer = item
    held = set(region)
    if sum(map(held.__contains__, names)) < PARAPHRASE * len(names):  # no subsequence can be longer
        return 0.0, 0.0, None
    common = lcs(names, region) / len(names)
    found = len(answer & held) / max(1, len(answer))
    verdict = "copy" if common >= COPY else "paraphrase" if common >= PARAPHRASE and found >= ANSWER else None
    return common, found, verdict


def _runs(key: np.ndarray, at: np.ndarray, n: np.ndarray, span: np.ndarray) -> list[np.ndarray]:
    """(key, begin, end) of the regions that hold every stretch of ``span`` words with ``n`` of the
    occurrences ``at`` of its key (sorted by key and place), merged where they meet."""
    last = np.arange(len(key)) + n - 1
    fits = np.flatnonzero(last < len(key))
    last = last[fits]
    close = (key[last] == key[fits]) & (at[last] - at[fits] < span[fits])
    fits, last = fits[close], last[close]
    a, b = at[last] - span[fits] + 1, at[fits] + span[fits]
    k = key[fits]
    new = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (a[1:] > b[:-1]))[:len(k)])
    return [k[new], a[new], b[np.append(new[1:], len(k)) - 1] if len(k) else b]


def rare_regions(names: list[bytes], ids: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                 bench: Benchmark) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """Regions (begin, end in words) by (text, item) that hold every stretch of ``bench.span`` words
    which has ``PARAPHRASE`` of the item's words: by the rarest words first, then by all of them."""
    spelt: dict[bytes, list[int]] = {}  # ids by plain word, of the items' words
    for i, w in enumerate(names):
        if w in bench.rare:
            spelt.setdefault(w, []).append(i)
    size = np.zeros(len(names), np.int64)
    for w, some in spelt.items():
        size[some] = len(bench.rare[w])
    flat = np.fromiter((k for i in np.flatnonzero(size) for k in bench.rare[names[i]]), np.int64, size.sum())
    n = size[ids]
    at = np.repeat(np.arange(len(ids)), n)
    item = flat[np.repeat((np.cumsum(size) - size)[ids], n) + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)]
    key = np.repeat(np.repeat(np.arange(len(ends)), ends - starts), n) * len(bench.items) + item
    order = np.argsort(key * len(ids) + at)  # by place within a key
    found: dict[tuple[int, int], list[tuple[int, int]]] = {}
    key, at, item = key[order], at[order], item[order]
    masks: dict[int, np.ndarray] = {}
    for key, a, b in zip(*_runs(key, at, np.minimum(RARE, bench.least[item]), bench.span[item])):
        d, k = divmod(int(key), len(bench.items))
        if k not in masks:
            masks[k] = np.zeros(len(names), bool)
            masks[k][[i for w in set(bench.items[k][1]) for i in spelt.get(w, ())]] = True
        a, b = max(a, starts[d]), min(b, ends[d])
        held = a + np.flatnonzero(masks[k][ids[a:b]])
        if len(held) < bench.least[k]:
            continue
        same = np.full(len(held), bench.least[k]), np.full(len(held), bench.span[k])
        for _, x, y in zip(*_runs(np.zeros(len(held), np.int64), held, *same)):
            found.setdefault((d, k), []).append((max(int(x - starts[d]), 0), int(min(y, ends[d]) - starts[d])))
    return found


def search(run: pd.DataFrame, bench: Benchmark) -> list[tuple[int, int, float, float, float, str]]:
    """(row, item_id, cosine, lcs share, answer share, verdict) of the leaks in a batch of texts."""
    names, terms, ids, starts, ends = batch_terms(run)
    n = ends - starts
    tail = WINDOW // STEP - 1  # empty blocks after each text, so that no window crosses into the next
    blocks = -(-n // STEP) + tail
    first = np.concatenate([[0], np.cumsum(blocks)])
    line = np.full(first[-1] * STEP, TERMS, np.int32)
    line[np.arange(len(ids)) - np.repeat(starts, n) + np.repeat(first[:-1] * STEP, n)] = terms[ids]
    part = np.zeros((first[-1], bench.rows.shape[1]), np.float32)
    norm = np.zeros(first[-1], np.float32)
    for j in range(STEP):  # a term that no item has adds nothing but to the norm
        at = line[j::STEP]
        some = np.flatnonzero(bench.used[at])
        part[some] += bench.rows[bench.row[at[some]]]
        norm += bench.norm[at] ** 2
    size = max(0, first[-1] - tail)
    window = sum(part[j:j + size] for j in range(tail + 1))
    norm = np.sqrt(sum(norm[j:j + size] for j in range(tail + 1)))
    window /= np.maximum(norm, 1e-6)[:, None]
    best: dict[tuple[int, int], list] = {}
    rows = max(1, 500_000 // max(1, len(bench.vectors)))
    for a in range(0, size, rows):
        cos = window[a:a + rows] @ bench.vectors.T
        w, p = np.nonzero(cos >= COSINE)
        doc = np.searchsorted(first, a + w, "right") - 1
        for d, k, at, c in zip(doc.tolist(), bench.owner[p].tolist(), (a + w).tolist(), cos[w, p].tolist()):
            best.setdefault((d, k), []).append((at, c))
    held = rare_regions(names, ids, starts, ends, bench)
    found, spelt = [], {}
    for d, k in sorted(best.keys() | held.keys()):
        item, hits = bench.items[k], best.get((d, k), ())
        reach = len(item[1])
        if d not in spelt:
            spelt = {d: [names[i] for i in ids[starts[d]:ends[d]].tolist()]}
        spans: list[list] = []  # regions around the hits, merged where they meet
        for w, c in hits:
            at = (w - first[d]) * STEP
            if spans and at - reach <= spans[-1][1]:
                spans[-1][1] = at + WINDOW + reach
                spans[-1][2] = max(spans[-1][2], c)
            else:
                spans.append([max(0, at - reach), at + WINDOW + reach, c])
        for a, b in held.get((d, k), ()):  # with the best cosine of the windows there
            some = window[first[d] + a // STEP:first[d] + max(a // STEP + 1, -(-b // STEP))]
            spans.append([a, b, float((some @ bench.vectors[bench.owner == k].T).max())])
        top = None
        for a, b, c in spans:
            region = spelt[d][a:b]
            common, answer, verdict = settle(item, region)
            if verdict and b - a > WINDOW + 2 * reach:  # a merged region: hold it to the item's own length
                span = 2 * reach + WINDOW
                tried = [settle(item, region[x:x + span]) for x in range(0, max(1, len(region) - span + STEP), STEP)]
                common, answer, verdict = max(tried, key=lambda t: (t[2] is not None, t[0], t[1]))
            if verdict and (top is None or common > top[3]):
                top = (d, item[0], c, common, answer, verdict)
        if top:
            found.append(top)
    return found


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_key, item_id, cosine, lcs, answer, verdict): one row per document row and
    benchmark item found in it; verdict is ``copy`` or ``paraphrase``.

    Texts are compared whole, by lower-cased words without marks at their ends. Null and empty
    texts hold nothing; items that are null, have no item_id or fewer than ``MIN_WORDS`` words are
    too short to tell a leak from chance and match nothing. Repeated rows give repeated results, a
    null doc_id stays null (``text_key`` is xxhash64 of the text), empty tables give an empty
    result; other columns are ignored.
    """
    spark = docs.sparkSession
    schema = "doc_id long, text_key long, item_id long, cosine double, lcs double, answer double, verdict string"
    rows = texts(docs)
    items = (benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
             .filter("item_id IS NOT NULL AND text IS NOT NULL").distinct())
    n_items = items.count()
    if not n_items:
        return spark.createDataFrame([], schema)
    df, n = document_frequencies(docs)
    idf = np.log((n + 1) / (df + 1.0)) + 0.01
    space = randomised_svd(items, idf)
    keyed, n_blocks, out = rows.withColumn("text_key", F.xxhash64("text")), -(-n_items // ITEM_BLOCK), None
    for b in range(n_blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), n_blocks) == b).collect()
        shared = spark.sparkContext.broadcast(Benchmark([(r.item_id, r.text) for r in block], idf, space))

        def scan(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for run in pieces(batches, RUN):
                found = search(run, shared.value)
                some = run.iloc[[f[0] for f in found]]
                yield pd.DataFrame({
                    "doc_id": some["doc_id"].to_numpy(), "text_key": some["text_key"].to_numpy(),
                    **{c: pd.Series([f[i + 1] for f in found], dtype=kind) for i, (c, kind) in enumerate((
                        ("item_id", "int64"), ("cosine", float), ("lcs", float), ("answer", float),
                        ("verdict", object)))}})

        part = keyed.mapInPandas(scan, schema)
        out = part if out is None else out.unionByName(part)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, in whose texts ``leaks`` finds no item."""
    i, key = free_names(docs, "_id", "_key")
    found = leaks(docs, benchmark).select(F.col("doc_id").alias(i), F.col("text_key").alias(key))
    return docs.join(staged(found.distinct(), "leaks"), docs["doc_id"].cast("long").eqNullSafe(F.col(i))
                     & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col(key)), "left_anti")


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, one row per pair."""
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.round("cosine", 4).alias("cosine"), "lcs", "answer", "verdict")
