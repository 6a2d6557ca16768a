"""Near-duplicate documents by ProbMinHash over weighted word shingles.

Every distinct shingle of a text (five words, weight = occurrences) starts a Poisson process whose
arrivals fall on the registers of the text; a register keeps the element of its earliest arrival.
Two texts agree on a register with the probability Jaccard similarity J_P of their weighted
shingles. A process ends as soon as its next arrival is later than the latest register, so a text
costs about shingles + m log m arrivals. Bands of registers are the buckets of candidate pairs,
and every link is verified by the exact J_P.

Scale and skew. Exact copies meet in an aggregation and go on as one node, so a group of copies
costs one row per task. Two steps follow. In the buckets, texts are compared by their registers in
numpy, blocks of at most ``CHUNK`` rows against each other; a block gives no pairs, only a
representative of each node's component among the likely links, which falls silent as soon as the
whole block is one component. The components over all buckets are *groups*, and every likely link
lies inside one. Then the shingle sets of a group's nodes are dealt once, in blocks of at most
``BLOCK`` nodes and ``BLOCK_BYTES``, and every task settles the exact J_P of all pairs of its blocks
by merging the lists of their shingles. A spanning forest of verified links leaves the task, at most
a row per node, however many pairs a group has. Links join nodes of one group only, so nothing is
looked at twice, and no link between different texts that meet in a bucket stays unexamined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmaps import bit_map
from .common import free_names, mix64, packed, pieces, staged, staged_with, table, texts
from .components import components

WORDS = 5
BANDS, ROWS = 30, 6
REGISTERS = BANDS * ROWS
CHUNK = 4096
BLOCK, BLOCK_BYTES = 1024, 16 << 20
SHARE, SHARE_BYTES = 20_000, 2 << 20
SIMILARITY = 0.8
RUN = 2_000_000  # characters whose shingles are held at once (one longer text is a run)
#: A pair of a bucket is likely when at least this share of its registers agrees, more than six
#: standard errors under the threshold (sqrt(0.8 * 0.2 / 180) = 0.03): a pair at exactly 0.8 stays under
#: it with a probability of about 10^-9.
LIKELY = 0.61


def shingles(run: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text index, shingle hash, weight, word count) of a batch; the first three by text and hash.

    A text with fewer than five words has one shingle of all its words; one without words, none.
    """
    words, ids, ends = packed(run)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    n = ends - starts
    code = np.fromiter(map(xxhash.xxh3_64_intdigest, words.words), np.uint64, len(words.words))[ids]
    size = len(code)
    total = np.zeros(size, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(WORDS):
            total[:max(size - j, 0)] += mix64(code[j:] + np.uint64(j + 1) * np.uint64(0xA24BAED4963EE407))
        # short texts: every word of the text, by position
        doc = np.repeat(np.arange(len(n)), n)
        at = np.arange(size) - starts[doc]
        whole = at + WORDS <= n[doc]
        short = np.flatnonzero((n > 0) & (n < WORDS))
        head = [np.sum(mix64(code[starts[d]:ends[d]] + (np.arange(n[d], dtype=np.uint64) + np.uint64(1))
                             * np.uint64(0xA24BAED4963EE407))) + np.uint64(n[d]) for d in short]
    doc = np.concatenate([doc[whole], short])
    total = np.concatenate([total[whole], np.array(head, np.uint64)])
    order = np.lexsort((total, doc))
    doc, total = doc[order], total[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (total[1:] != total[:-1])
    first = np.flatnonzero(new)
    weight = np.diff(np.append(first, len(doc)))
    return doc[first], total[first], weight, n


def _draw(element: np.ndarray, arrival: int) -> tuple[np.ndarray, np.ndarray]:
    """(waiting time, register) of an element's arrival: one hash gives an Exp(1) and a register."""
    with np.errstate(over="ignore"):
        r = mix64(element + np.uint64(arrival) * np.uint64(0xD1342543DE82EF95))
    wait = -np.log(((r >> np.uint64(24)).astype(np.float64) + 0.5) * 2.0 ** -40)
    return wait, ((r & np.uint64(0xFFFFFF)) % np.uint64(REGISTERS)).astype(np.int64)


def prob_minhash(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int) -> np.ndarray:
    """(n_docs, REGISTERS) elements, by rounds of one arrival of every process still running."""
    earliest = np.full(n_docs * REGISTERS, np.inf)
    holder = np.zeros(n_docs * REGISTERS, np.uint64)
    limit = np.full(n_docs, np.inf)
    time = np.zeros(len(doc))
    arrival = 0
    while len(doc):
        arrival += 1
        wait, register = _draw(element, arrival)
        time = time + wait / weight
        at = doc * REGISTERS + register
        np.minimum.at(earliest, at, time)
        won = earliest[at] == time
        holder[at[won]] = element[won]
        running = np.unique(doc) if len(doc) < n_docs else slice(None)
        limit[running] = earliest.reshape(n_docs, REGISTERS)[running].max(1)
        go = time < limit[doc]
        doc, element, weight, time = doc[go], element[go], weight[go], time[go]
    return holder.reshape(n_docs, REGISTERS)


def signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(doc_id, text_key, node, bands, registers): ``node`` is a 128-bit hash of the text's words, null for a
    text without words; ``registers`` has 8 bits of every register's element, ``bands`` the buckets."""
    for run in pieces(batches, RUN):
        doc, element, weight, n = shingles(run)
        holder = prob_minhash(doc, element, weight, len(run))
        low = (mix64(holder) >> np.uint64(56)).astype(np.uint8)
        band = np.repeat(np.arange(BANDS, dtype=np.int64)[None, :], len(run), axis=0)
        for j in range(ROWS):  # band number and the kept bits of its registers: the bucket itself
            band = (band << 8) | low[:, j::ROWS]
        has = n > 0
        node = [hashlib.md5(b" ".join(t.encode().lower().split())).digest() if h else None
                for t, h in zip(run["text"], has)]
        yield pd.DataFrame({
            "doc_id": run["doc_id"].to_numpy(), "text_key": run["text_key"].to_numpy(), "node": node,
            "bands": [b if h else None for b, h in zip(band, has)],
            "registers": [r.tobytes() if h else None for r, h in zip(low, has)]})


def weighted_shingles(wanted):
    """Function for mapInPandas: (doc_id, text_key, hash, text) to (doc_id, text_key, elements,
    weights) of the rows whose hash may be wanted: sorted hashes as bytes; weights null when all are
    one."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            some = batch[wanted.value.has(batch["hash"].to_numpy(np.int64).view(np.uint64))]
            for part in pieces(iter([some]), RUN):
                doc, element, weight, _ = shingles(part)
                cut = np.searchsorted(doc, np.arange(len(part) + 1))
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].to_numpy(), "text_key": part["text_key"].to_numpy(),
                    "elements": [element[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])],
                    "weights": [None if (weight[a:b] == 1).all() else weight[a:b].astype(np.int32).tobytes()
                                for a, b in zip(cut[:-1], cut[1:])]})
    return run


def probability_jaccard(a: np.ndarray, u: np.ndarray, b: np.ndarray, v: np.ndarray) -> float:
    """Exact J_P of two weighted sets (sorted elements with weights): the sum over common elements
    d of 1 / sum over all e of max(u_e / u_d, v_e / v_d)."""
    if not len(a) or not len(b):
        return 0.0
    every = np.union1d(a, b)
    x, y = np.zeros(len(every)), np.zeros(len(every))
    x[np.searchsorted(every, a)] = u
    y[np.searchsorted(every, b)] = v
    both = (x > 0) & (y > 0)
    kinds, counts = np.unique(np.stack([x[both], y[both]]), axis=1, return_counts=True)
    return float(sum(c / np.maximum(x / p, y / q).sum() for (p, q), c in zip(kinds.T, counts)))


def agreements(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Equal registers of every row with every column of the transposed registers."""
    if columns.shape[1] <= 64:
        return (rows[:, None, :] == columns.T[None, :, :]).sum(2)
    total = np.zeros((len(rows), columns.shape[1]), np.uint8)  # REGISTERS < 256
    for r in range(REGISTERS):
        total += rows[:, r, None] == columns[r]
    return total


def joined(label: np.ndarray, at: int, others: np.ndarray) -> None:
    """Give ``at``, ``others`` and all that share a label with one of them the smallest of their labels."""
    labels = np.unique(np.append(label[others], label[at]))
    if len(labels) > 1:
        label[np.isin(label, labels)] = labels[0]


def likely_components(sig: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Label of every row: rows that a chain of likely links between ``left`` and ``right`` joins share
    one. Ends as soon as all rows do."""
    label = np.arange(len(sig))
    columns = np.ascontiguousarray(sig[right].T)
    for at in range(0, len(left), 64):
        some = left[at:at + 64]
        ok = agreements(sig[some], columns) >= LIKELY * REGISTERS
        for i, row in zip(some.tolist(), ok):
            others = right[row]
            if len(others) and (label[others] != label[i]).any():
                joined(label, i, others)
        if (label == label[0]).all():
            break
    return label


def likely_edges(share: pd.DataFrame) -> pd.DataFrame:
    """For applyInPandas over one share of the block pairs of buckets: (a, b) with every node and the
    representative of its component among the likely links of its block pair."""
    share = share.sort_values(["bucket", "x", "y", "node"], ignore_index=True)
    bucket, x, y, side = (share[c].to_numpy(np.int64) for c in ("bucket", "x", "y", "side"))
    node = share["node"].to_numpy(object)
    sig = np.frombuffer(b"".join(share["registers"]), np.uint8).reshape(len(share), REGISTERS)
    new = np.ones(len(share), bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    cut = np.append(np.flatnonzero(new), len(share))
    found = [np.zeros((0, 2), np.int64)]
    # buckets of two, which most are: all at once
    two = cut[:-1][np.diff(cut) == 2]
    two = two[x[two] == y[two]]
    ok = (sig[two] == sig[two + 1]).sum(1) >= LIKELY * REGISTERS
    found.append(np.stack([two[ok], two[ok] + 1], axis=1))
    for a, b in zip(cut[:-1], cut[1:]):
        if b - a < 2 or b - a == 2 and x[a] == y[a]:
            continue
        every = np.arange(b - a)
        left, right = (every, every) if x[a] == y[a] else (np.flatnonzero(side[a:b] == 1), np.flatnonzero(side[a:b] == 2))
        label = likely_components(sig[a:b], left, right)
        moved = np.flatnonzero(label != every)
        found.append(a + np.stack([label[moved], moved], axis=1))
    pairs = np.concatenate(found)
    edges = pd.DataFrame({"a": node[pairs[:, 0]], "b": node[pairs[:, 1]]}, dtype=object)
    return edges.drop_duplicates()


def verified_forest(elements: list[np.ndarray], weights: list[np.ndarray | None], left: np.ndarray,
                    right: np.ndarray | None, similarity: float) -> list[tuple[int, int]]:
    """A spanning forest of the pairs with J_P >= ``similarity`` between ``left`` and ``right`` (None:
    among ``left``), as positions.

    The lists of the shingles of a row give, for all other rows at once, the number of shingles in
    common and the sum of the smaller shares of the total weight, which J_P never exceeds. Without
    repeated shingles J_P is the plain Jaccard similarity, of which the first is all that is needed;
    the others that the bound leaves are settled one by one, but for those that are joined already.
    """
    n = len(elements)
    size = np.array([len(e) for e in elements], np.int64)
    once = np.array([w is None for w in weights])
    share = np.concatenate([np.full(k, 1.0 / max(k, 1)) if w is None else w / w.sum()
                            for k, w in zip(size, weights)]) if n else np.zeros(0)
    code = np.unique(np.concatenate(elements), return_inverse=True)[1] if n else np.zeros(0, np.int64)
    own = np.repeat(np.arange(n), size)
    several = np.bincount(code)[code] > 1 if len(code) else np.zeros(0, bool)
    code, own, share = code[several], own[several], share[several]
    first = np.searchsorted(own, np.arange(n + 1))
    order = np.argsort(code, kind="stable")
    owner, part = own[order], share[order]
    begin = np.searchsorted(code[order], np.arange((code.max() if len(code) else -1) + 2))
    scope = np.zeros(n, bool)
    scope[left if right is None else right] = True
    label, links = np.arange(n), []
    for i in left.tolist():
        if right is None:
            scope[i] = False  # every pair once
        if (label[scope] == label[i]).all():
            continue
        mine = code[first[i]:first[i + 1]]
        length = begin[mine + 1] - begin[mine]
        at = np.repeat(begin[mine] - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum()) \
            if len(mine) else np.zeros(0, np.int64)
        common = np.bincount(owner[at], minlength=n)
        ok = scope & (common > 0)
        if once[i]:
            ok &= ~once | (common / np.maximum(size[i] + size - common, 1) >= similarity)
            doubtful = ok & ~once
        else:
            doubtful = ok.copy()
        if doubtful.any():
            most = np.bincount(owner[at], np.minimum(np.repeat(share[first[i]:first[i + 1]], length), part[at]), n)
            doubtful &= most >= similarity - 1e-9
            sure = np.flatnonzero(ok & once) if once[i] else np.zeros(0, np.int64)
            joined_to = set(label[sure].tolist()) | {int(label[i])}
            checked = []
            for j in np.flatnonzero(doubtful)[np.argsort(-most[doubtful], kind="stable")].tolist():
                if int(label[j]) not in joined_to and probability_jaccard(
                        elements[i], _weights(weights[i], size[i]), elements[j], _weights(weights[j], size[j])) >= similarity:
                    checked.append(j)
                    joined_to.add(int(label[j]))
            others = np.concatenate([sure, np.array(checked, np.int64)])
        else:
            others = np.flatnonzero(ok)
        others = others[label[others] != label[i]]
        if len(others):
            _, one = np.unique(label[others], return_index=True)
            links += [(i, j) for j in others[one].tolist()]
            joined(label, i, others)
    return links


def _weights(w: np.ndarray | None, n: int) -> np.ndarray:
    return np.ones(n) if w is None else w.astype(float)


def verified_links(similarity: float):
    """Function for applyInPandas over one share of the block pairs of groups: (a, b), a spanning
    forest of the links of every block pair."""
    def find(share: pd.DataFrame) -> pd.DataFrame:
        pairs: list[tuple] = []
        for (_, x, y), block in share.groupby(["component", "x", "y"], sort=False):
            block = block.sort_values("node", ignore_index=True)
            elements = [np.frombuffer(e, np.uint64) for e in block["elements"]]
            weights = [None if w is None else np.frombuffer(w, np.int32) for w in block["weights"]]
            side = block["side"].to_numpy()
            left = np.arange(len(block)) if x == y else np.flatnonzero(side == 1)
            right = None if x == y else np.flatnonzero(side == 2)
            node = block["node"].tolist()
            pairs += [(node[i], node[j]) for i, j in verified_forest(elements, weights, left, right, similarity)]
        return pd.DataFrame(pairs, columns=["a", "b"], dtype=object)
    return find


def _sides(dealt: DataFrame, key: str, shares: int) -> DataFrame:
    """Rows with ``k`` blocks of their ``key`` dealt to the pair of their block with every block, with
    the pair (x, y), its share of the work and ``side``: 1 and 2 are the two blocks of a pair, 0 a block
    against itself."""
    dealt = (dealt.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
             .withColumn("x", F.least("mine", "other")).withColumn("y", F.greatest("mine", "other")))
    return dealt.select(F.pmod(F.xxhash64(key, "x", "y"), F.lit(shares)).alias("share"), key, "x", "y", "node",
                        F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1)
                        .otherwise(2).alias("side"))


def _likely_groups(hits: DataFrame, registers: DataFrame) -> DataFrame:
    """(node, component) of the nodes that chains of likely links join; ``hits`` are (bucket, node) of
    the buckets with several nodes. Block pairs go by hash to shares of about ``SHARE`` rows, one
    task's work at a time."""
    size, total = staged_with(
        hits.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("k"), F.count(F.lit(1)).alias("n")),
        "buckets", F.sum(F.col("n") * F.col("k")).alias("rows"))
    dealt = _sides(hits.join(size.select("bucket", "k"), "bucket"), "bucket", 1 + (total["rows"] or 0) // SHARE)
    edges = (dealt.join(registers, "node").groupBy("share").applyInPandas(likely_edges, "a binary, b binary").distinct())
    return staged(components(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), "groups")


def _shingle_sets(rows: DataFrame, copies: DataFrame, groups: DataFrame) -> DataFrame:
    """(node, component, elements, weights, bytes) of the nodes in groups, from the text of the row
    that stands for each. The texts are not shuffled: a bit map of the wanted rows goes to them."""
    wanted, seen = staged_with(
        groups.join(copies.select("node", "place"), "node").select(
            "node", "component", F.col("place.doc_id").alias("doc_id"), F.col("place.text_key").alias("text_key"),
            F.xxhash64("place.doc_id", "place.text_key").alias("hash")), "wanted", F.count(F.lit(1)).alias("n"))
    sent = rows.sparkSession.sparkContext.broadcast(bit_map(wanted, seen["n"]))
    sets = rows.withColumn("hash", F.xxhash64("doc_id", "text_key")).select("doc_id", "text_key", "hash", "text") \
        .mapInPandas(weighted_shingles(sent), "doc_id long, text_key long, elements binary, weights binary")
    sets = sets.withColumnsRenamed({"doc_id": "_doc", "text_key": "_text"})
    of_node = sets.join(wanted, wanted["doc_id"].eqNullSafe(sets["_doc"]) & (wanted["text_key"] == sets["_text"]))
    # rows that repeat an id and a text give equal sets
    return staged(of_node.groupBy("node", "component").agg(F.first("elements").alias("elements"),
                                                           F.first("weights").alias("weights"))
                  .withColumn("bytes", F.octet_length("elements").cast("long")), "shingles")


def _verified(sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b): links that span the classes of near duplicates, from the sets of the groups."""
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("bytes") / BLOCK_BYTES)).cast("int")
    size, total = staged_with(
        sets.groupBy("component").agg(blocks.alias("k"), F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
        .filter("n > 1"), "group-sizes", F.sum(F.col("bytes") * F.col("k")).alias("bytes"))
    dealt = _sides(sets.select("node", "component").join(size.select("component", "k"), "component"), "component",
                   1 + (total["bytes"] or 0) // SHARE_BYTES)
    return (dealt.join(sets.select("node", "elements", "weights"), "node").groupBy("share")
            .applyInPandas(verified_links(similarity), "a binary, b binary"))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as (doc_id, class_id, n_class, n_copies, kept, text_key, node).

    ``class_id`` is the smallest doc_id reachable by links of J_P >= ``similarity``; ``n_class``
    counts the rows of the class and ``n_copies`` those with the same words; ``kept`` marks the row of
    each class that stays (that of the smallest doc_id). Texts are compared by
    their words between ASCII blanks, A-Z lower-cased. A null or empty text, or one of blanks
    only, has no shingles and links with nothing, not even with its like. Repeated rows are copies
    of each other. A row without doc_id joins its class but gives it no id (its own class_id is
    null when no member has one). An empty table gives an empty result; other columns are ignored.
    """
    rows = texts(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    signed = staged(rows.mapInPandas(signatures, "doc_id long, text_key long, node binary, bands array<long>, "
                                     "registers binary"), "signatures")
    # of each node the row of its smallest doc_id stands for it (null ids last)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    copies = staged(signed.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n_copies"), F.min(place).alias("place"),
        F.first("bands").alias("bands"), F.first("registers").alias("registers")), "nodes")
    hits = copies.select("node", F.explode("bands").alias("bucket"))
    shared = hits.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    hits = staged(hits.join(staged(shared, "shared"), "bucket"), "hits")
    groups = _likely_groups(hits, copies.select("node", "registers"))
    links, found = staged_with(_verified(_shingle_sets(rows, copies, groups), similarity), "links",
                               F.count(F.lit(1)).alias("rows"))
    labels = staged(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "labels") \
        if found["rows"] else None
    members = copies.select("node", "least", "n_copies")
    if labels is not None:
        members = members.join(labels, "node", "left")
    else:
        members = members.withColumn("component", F.lit(None).cast("binary"))
    members = members.withColumn("component", F.coalesce("component", "node"))
    first = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "node"))
    # written first, so that the join has a plain exchange on either side, which can be split
    classes = staged(members.groupBy("component").agg(
        F.min("least").alias("class_id"), F.sum("n_copies").alias("n_class"), first.alias("first")), "class-sizes")
    of_node = staged(members.join(classes, "component").select(
        "node", "class_id", "n_class", "n_copies",
        F.when(F.col("first.node") == F.col("node"), F.struct("least")).alias("chosen")), "classes")
    out = signed.select("doc_id", "text_key", "node").join(of_node, "node", "left")
    alone = F.col("node").isNull()
    return out.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.coalesce("n_class", F.lit(1)).cast("long").alias("n_class"),
                      F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
                      (alone | (F.col("chosen").isNotNull() & F.col("doc_id").eqNullSafe(F.col("chosen.least"))))
                      .alias("kept"), "text_key", "node")


def keep_one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, with all their columns, without near duplicates: of each class of
    ``near_duplicates`` the row marked ``kept`` stays, of rows equal in doc_id and words one."""
    i, key, node, rows = free_names(docs, "_id", "_key", "_node", "_rows")
    found = staged(near_duplicates(docs, similarity).filter("kept").select(
        F.col("doc_id").alias(i), F.col("text_key").alias(key), F.col("node").alias(node)), "kept")
    chosen = staged(found.groupBy(i, key, node).agg(F.count(F.lit(1)).alias(rows)), "chosen")
    out = docs.join(chosen, docs["doc_id"].cast("long").eqNullSafe(chosen[i])
                    & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == chosen[key]))
    again = chosen.groupBy(i, node).agg(F.sum(rows).alias("n")).filter(F.col(node).isNotNull() & (F.col("n") > 1))
    if not again.isEmpty():  # rows that repeat a doc_id with the same words
        alone = out.filter(F.col(node).isNull())
        out = alone.unionByName(out.filter(F.col(node).isNotNull()).dropDuplicates([i, node]))
    return out.select(*docs.columns)


def op10_probminhash(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_class", "n_copies", "kept")
