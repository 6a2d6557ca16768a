"""SentencePiece encoding and decoding by suffix-array matching.

A batch's text is cut at blanks and line ends (no piece crosses them), and the distinct cuts are
concatenated and indexed by a suffix array, sorted as deep as the longest piece. Every piece of
the vocabulary is looked up by binary search; its range of suffixes gives all its occurrences.
These are the edges of a graph over text positions: sorted by position, they are relaxed in one
sweep. For a vocabulary of byte-pair merges, as here, exactly one piece that ends at a position
goes with the piece before it; whether two neighbours go together follows from their merge trees:
no merge across their border may come before the merges that build them.

The tokenizer is public and never trained here; its file is a parameter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, arrow_pieces, mix64, table, texts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"  # stands for a blank in pieces
_CUTS = re.compile(f"{BLANK}?[^{BLANK}\n]+|{BLANK}|\n")
RUN_BYTES = 4_000_000  # text whose distinct cuts are held at once (one longer text is a run)
INDEX_CHARS = 300_000  # text indexed at once (one longer cut is indexed whole)
NEVER = np.int32(2 ** 31 - 1)
BEGIN, UNSET = -1, -2
CACHE_BITS = 21


@dataclass
class Vocabulary:
    """What encoding and decoding need of a model; arrays are by piece id."""

    raw: list[bytes]  # what a piece stands for
    codes: np.ndarray  # (matched pieces, longest) code points + 1, 0 after the end
    ids: np.ndarray  # their ids
    length: np.ndarray  # code points of every id; one more entry for unknown characters
    left: np.ndarray  # (ids, depth) pieces along the left edge of the merge tree, character first
    right: np.ndarray
    left_until: np.ndarray  # merge order at which each of them is merged further
    right_until: np.ndarray
    pair_keys: np.ndarray  # sorted left * n + right of all pairs that may merge ...
    pair_order: np.ndarray  # ... and their place in the order of merges
    first_byte: int
    blank: int
    blank_runs: list[tuple[int, int]]  # (length, id) of pieces of blanks only, longest first

    @property
    def size(self) -> int:
        return len(self.raw)


def _merge_tree(piece: str, order: dict[str, int]) -> dict[str, tuple[str, str]] | None:
    """The merges that build ``piece`` from characters; None if they end in something else."""
    parts, tree = list(piece), {}
    while len(parts) > 1:
        best = min(((order[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in order),
                   default=None)
        if best is None:
            return None
        i = best[1]
        tree[parts[i] + parts[i + 1]] = (parts[i], parts[i + 1])
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return tree


@lru_cache(maxsize=2)
def vocabulary(path: str = MODEL) -> Vocabulary:
    """Read a byte-pair SentencePiece model with byte fallback."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    names = [sp.id_to_piece(i) for i in range(n)]
    plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    by_name = {names[i]: i for i in plain}
    longer = sorted((i for i in plain if len(names[i]) > 1), key=lambda i: (-sp.get_score(i), i))
    order = {names[i]: k for k, i in enumerate(longer)}

    def edge(tree: dict[str, tuple[str, str]], name: str, side: int) -> list[int]:
        """Pieces along one edge of the merge tree, from a character up to the piece."""
        out = []
        while len(name) > 1:
            out.append(by_name[name])
            name = tree[name][side]
        return (out + [by_name[name]])[::-1] if name in by_name else out[::-1]

    edges = {}  # of the pieces that merges build; one tree at a time is held
    for i in plain:
        if (len(names[i]) == 1 or names[i].strip(BLANK)) and (tree := _merge_tree(names[i], order)) is not None:
            edges[i] = edge(tree, names[i], 0), edge(tree, names[i], 1)
    usable = list(edges)
    depth = max(max(map(len, e)) for e in edges.values())
    left, right = np.zeros((n + 1, depth), np.int32), np.zeros((n + 1, depth), np.int32)
    until = np.full((2, n + 1, depth), NEVER, np.int32)
    for i, both in edges.items():
        for side, (where, chain) in enumerate(zip((left, right), both)):
            where[i, :len(chain)] = chain
            until[side, i, :len(chain) - 1] = [order[names[c]] for c in chain[1:]]
    pairs = sorted((by_name[p[:k]] * n + by_name[p[k:]], order[p]) for p in order for k in range(1, len(p))
                   if p[:k] in by_name and p[k:] in by_name)
    longest = max(len(names[i]) for i in usable)
    codes = np.zeros((len(usable), longest), np.int32)
    for r, i in enumerate(usable):
        codes[r, :len(names[i])] = [ord(c) + 1 for c in names[i]]
    first_byte = next(i for i in range(n) if sp.is_byte(i))
    raw = [bytes([i - first_byte]) if sp.is_byte(i) else b"" if sp.is_control(i) or sp.is_unknown(i)
           else names[i].replace(BLANK, " ").encode() for i in range(n)]
    return Vocabulary(
        raw, codes, np.array(usable, np.int32), np.array([len(x) for x in names] + [1], np.int64), left, right,
        until[0], until[1], np.array([k for k, _ in pairs], np.int64), np.array([o for _, o in pairs], np.int32),
        first_byte, by_name[BLANK],
        sorted(((len(names[i]), i) for i in plain if not names[i].strip(BLANK)), reverse=True))


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of the next ``depth`` codes: as many codes as 63 bits hold are compared
    at once, then the compared length is doubled."""
    n, key = len(codes), np.zeros(len(codes), np.int64)
    used = np.zeros(int(codes.max(initial=0)) + 1, bool)
    used[codes] = True
    small = np.cumsum(used, dtype=np.int32)[codes]  # 0 stands for the end
    bits = int(small.max(initial=1)).bit_length()
    k = min(63 // bits, depth)
    for i in range(k):
        key <<= bits
        key[:max(n - i, 0)] |= small[i:]
    while k < depth:
        rank = np.unique(key, return_inverse=True)[1]
        key = rank * (n + 1)
        key[:max(n - k, 0)] += rank[k:] + 1
        k *= 2
    return np.argsort(key, kind="stable").astype(np.int32)


def occurrence_ranges(codes: np.ndarray, order: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``wanted`` the range of the suffix array that begins with it, by binary
    search for all rows together, one code at a time."""
    n = len(codes)
    padded = np.append(codes, np.zeros(wanted.shape[1], codes.dtype))
    lo, hi = np.zeros(len(wanted), np.int32), np.full(len(wanted), n, np.int32)

    def bound(rows, j, target):
        a, b = lo[rows].copy(), hi[rows].copy()
        while True:
            open_ = a < b
            if not open_.any():
                return a
            mid = (a + b) >> 1
            less = open_ & (padded[order[np.minimum(mid, n - 1)] + j] < target)
            a = np.where(less, mid + 1, a)
            b = np.where(open_ & ~less, mid, b)

    for j in range(wanted.shape[1]):
        rows = np.flatnonzero((wanted[:, j] > 0) & (lo < hi))
        target = wanted[rows, j]
        start, end = bound(rows, j, target), bound(rows, j, target + 1)
        lo[rows], hi[rows] = start, end
    return lo, hi


class Pairs:
    """Which two neighbouring pieces go together, with a direct-mapped cache of answers."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.keys = np.full(1 << CACHE_BITS, -1, np.int64)
        self.good = np.zeros(1 << CACHE_BITS, bool)

    def together(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n = self.v.size
        key = a.astype(np.int64) * (n + 1) + b
        slot = (mix64(key) >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
        out = self.good[slot]
        missing = np.flatnonzero(self.keys[slot] != key)
        if len(missing):
            new, inverse = np.unique(key[missing], return_inverse=True)
            answer = self._check(new // (n + 1), new % (n + 1))
            out[missing] = answer[inverse]
            place = (mix64(new) >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
            self.keys[place] = new
            self.good[place] = answer
            twice = self.keys[place] != new  # two new pairs in one slot: the later one holds it
            self.good[place[~twice]] = answer[~twice]
        return out

    def _check(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Replay the merges next to the border: at each step the piece of either side that is
        merged next, unless a merge across the border comes first."""
        v, n = self.v, self.v.size
        ok = np.ones(len(a), bool)
        live = np.flatnonzero((a < n) & (b < n))  # an unknown character merges with nothing
        i, j = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        while len(live):
            x, y = a[live], b[live]
            key = v.right[x, i[live]].astype(np.int64) * n + v.left[y, j[live]]
            at = np.minimum(np.searchsorted(v.pair_keys, key), len(v.pair_keys) - 1)
            across = np.where(v.pair_keys[at] == key, v.pair_order[at], NEVER)
            left, right = v.right_until[x, i[live]], v.left_until[y, j[live]]
            bad = (across < left) & (across <= right)
            ok[live[bad]] = False
            ended = bad | ((left == NEVER) & (right == NEVER))
            first = left <= right  # merges of equal order go from left to right
            i[live[first]] += 1
            j[live[~first]] += 1
            live = live[~ended]
        return ok


def encode_cuts(cuts: list[str], v: Vocabulary, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, offsets): tokens[offsets[i]:offsets[i + 1]] are the ids of cut i."""
    unknown = v.size
    size = np.fromiter(map(len, cuts), np.int64, len(cuts))
    end = np.cumsum(size + 1) - 1  # a 0 follows each cut
    start = end - size
    raw = np.frombuffer("".join(cuts).encode("utf-32-le"), np.int32) + np.int32(1)
    owner = np.repeat(np.arange(len(cuts), dtype=np.int32), size)
    place = np.arange(len(raw), dtype=np.int32) + owner
    codes = np.zeros(end[-1] + 1, np.int32)
    codes[place] = raw
    order = suffix_array(codes, v.codes.shape[1])
    lo, hi = occurrence_ranges(codes, order, v.codes)
    count = hi - lo
    token = np.repeat(v.ids, count)
    skip = (lo - np.cumsum(count) + count).astype(np.int32)
    where = order[np.repeat(skip, count) + np.arange(len(token), dtype=np.int32)]
    single = np.zeros(len(codes), bool)
    single[where[v.length[token] == 1]] = True
    strange = place[~single[place]]
    token = np.concatenate([token, np.full(len(strange), unknown, np.int32)])
    where = np.concatenate([where, strange])
    # sort by position in the cut: all cuts are relaxed side by side
    depth = np.zeros(len(codes), np.int32)
    depth[place] = place - start.astype(np.int32)[owner]
    level = depth[where]
    deepest = int(size.max(initial=0))
    by = np.argsort(level.astype(np.uint16) if deepest < 65536 else level, kind="stable")
    token, where = token[by], where[by]
    bounds = np.concatenate([[0], np.cumsum(np.bincount(level, minlength=max(1, deepest)))])
    last = np.full(len(codes) + 1, UNSET, np.int32)  # the piece that ends before a position
    last[start] = BEGIN
    stop = where + v.length[token].astype(np.int32)
    for k in range(deepest):
        a, b = bounds[k], bounds[k + 1]
        if a == b:
            continue
        t, before = token[a:b], last[where[a:b]]
        ok = before == BEGIN
        check = np.flatnonzero(before >= 0)
        if len(check):
            ok[check] = pairs.together(before[check], t[check])
        last[stop[a:b][ok]] = t[ok]
    # walk back from the ends, all cuts side by side
    cuts_, toks, chars = [], [], []
    live, at = np.flatnonzero(size > 0), end.copy()
    while len(live):
        t = last[at[live]]
        if (t < 0).any():
            raise ValueError("the vocabulary does not hold a byte-pair segmentation of this text")
        at[live] -= v.length[t]
        cuts_.append(live)
        toks.append(t)
        chars.append(np.where(t == unknown, codes[at[live]] - 1, 0))
        live = live[at[live] > start[live]]
    if not cuts_:
        return np.zeros(0, np.int32), np.zeros(len(cuts) + 1, np.int64)
    who = np.concatenate(cuts_[::-1])
    by = np.argsort(who, kind="stable")
    who, tok, char = who[by], np.concatenate(toks[::-1])[by], np.concatenate(chars[::-1])[by]
    # unknown characters as their bytes
    wide = np.ones(len(tok), np.int64)
    strange = np.flatnonzero(tok == unknown)
    as_bytes = [chr(c).encode() for c in char[strange]]
    wide[strange] = [len(b) for b in as_bytes]
    out = np.repeat(tok, wide)
    first = np.cumsum(wide) - wide
    for i, b in zip(first[strange], as_bytes):
        out[i:i + len(b)] = np.frombuffer(b, np.uint8).astype(np.int32) + v.first_byte
    per_cut = np.bincount(who, weights=wide, minlength=len(cuts)).astype(np.int64)
    return out, np.concatenate([[0], np.cumsum(per_cut)])


def _join_blanks(ids: np.ndarray, v: Vocabulary) -> np.ndarray:
    """Runs of single blanks become the longest pieces of blanks (merged after all else)."""
    blank = np.concatenate([[False], ids == v.blank, [False]])
    change = np.flatnonzero(blank[1:] != blank[:-1])
    out, at = [], 0
    for a, b in zip(change[::2], change[1::2]):
        if b - a > 1:
            out.append(ids[at:a])
            left, run = b - a, []
            for size, i in v.blank_runs:
                run += [i] * (left // size)
                left %= size
            out.append(np.array(run, np.int32))
            at = b
    return np.concatenate([*out, ids[at:]]) if out else ids


def encode_batch(batch: list[str], v: Vocabulary, pairs: Pairs) -> list[np.ndarray]:
    """Token ids of whole texts. The distinct cuts of the batch are indexed, in blocks."""
    seen, parts = Words(), []
    for text in batch:
        parts.append(seen.ids(_CUTS.findall(BLANK + text.replace(" ", BLANK))) if text else np.zeros(0, np.int32))
    cuts = seen.words
    tokens, counts, at = [], [], 0
    sizes = np.cumsum([0] + [len(c) + 1 for c in cuts])
    while at < len(cuts):
        end = max(at + 1, int(np.searchsorted(sizes, sizes[at] + INDEX_CHARS, "right")) - 1)
        out, offsets = encode_cuts(cuts[at:end], v, pairs)
        tokens.append(out)
        counts.append(np.diff(offsets))
        at = end
    table_ = np.concatenate(tokens) if tokens else np.zeros(0, np.int32)
    count = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    offset = np.cumsum(count) - count
    result = []
    for units in parts:
        n = count[units]
        total = np.cumsum(n)
        ids = table_[np.repeat(offset[units] - (total - n), n) + np.arange(total[-1] if len(n) else 0)]
        result.append(_join_blanks(ids, v))
    return result


def decode_ids(ids: np.ndarray, v: Vocabulary) -> str:
    """The text of token ids: pieces joined, bytes read as UTF-8, without the blank put in front."""
    text = b"".join(map(v.raw.__getitem__, ids.tolist())).decode("utf8", "replace")
    return text[1:] if text.startswith(" ") else text


def restored(text: str) -> str:
    """What decoding gives back: the text, with the sign that stands for a blank as a blank."""
    return text.replace(BLANK, " ")


def _encoder(path: str, with_ids: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)  # read once per worker
        pairs = _worker_pairs(path)
        for run in arrow_pieces(batches, RUN_BYTES):
            batch = run.column("text").to_pylist()
            ids = encode_batch(batch, v, pairs)
            size = np.fromiter(map(len, ids), np.int64, len(ids))
            out = {"doc_id": run.column("doc_id"),
                   "n_tokens": pa.array(size),
                   "ids_sha256": pa.array([hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in ids]),
                   "round_trip": pa.array([decode_ids(x, v) == restored(t) for x, t in zip(ids, batch)])}
            if with_ids:
                edges = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                out["ids"] = pa.ListArray.from_arrays(edges, np.concatenate(ids).astype(np.int32, copy=False))
            yield pa.RecordBatch.from_pydict(out)
    return encode


@lru_cache(maxsize=1)
def _worker_pairs(path: str) -> Pairs:
    return Pairs(vocabulary(path))


def encode_documents(docs: DataFrame, path: str = MODEL, with_ids: bool = True) -> DataFrame:
    """Every row as (doc_id, n_tokens, ids_sha256, round_trip[, ids]).

    ``ids`` are the token ids of the whole text, equal to those of the SentencePiece library;
    ``ids_sha256`` is the hash of them as little-endian 32-bit integers; ``round_trip`` tells that
    decoding them gives the text back. Null and empty texts have no tokens. Repeated rows give
    equal rows, an empty table an empty result; a null doc_id stays null; other columns are
    ignored. ``path`` must be readable where the tasks run.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, round_trip boolean"
    return texts(docs).mapInArrow(_encoder(path, with_ids), schema + (", ids array<int>" if with_ids else ""))


def decode_documents(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give an empty text."""
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = vocabulary(path)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text": [
                decode_ids(np.asarray(x, np.int64), v) if x is not None else "" for x in batch["ids"]]})
    return encoded.select("doc_id", F.col("ids").cast("array<int>").alias("ids")) \
        .mapInPandas(decode, "doc_id long, text string")


def op9_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Token counts, a hash of the ids and the round trip of every document."""
    return encode_documents(table(spark, sf_dir, "documents"), with_ids=False)
