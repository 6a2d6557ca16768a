"""Secrets: a linear-chain conditional random field that tags tokens as the beginning, the inside or
the outside of a secret, beside a fixed base of patterns.

The base finds assignments to a secret's name, access ids and long hexadecimal runs. The CRF is
trained from the small labelled table in ``secret_examples`` and adds what the patterns miss:
passwords after a cue word, bearer and vendor tokens, passwords in addresses. Its features are the
shape of a token, the two neighbours to each side, and features of the file: how much of it is
assignments and brackets, and how many cue words it holds. Every token of every line is scored;
only a token without letters and digits, and the end of a line, cannot begin a secret.

Decoding is Viterbi over whole batches. All tokens of a batch form one chain, in which the end of a
line is outside in any case, so no line and no text influences the path of another. The chain is
cut into stretches of ``STRETCH`` tokens; numpy finds the best path through all stretches at once
for each state before them, and one short pass joins the stretches. A line of any length costs the
same a token. Base spans always stay; a CRF span that touches one is dropped.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, shape, table, texts
from .secret_examples import EXAMPLES

KINDS = ("assign", "access", "hex", "secret")
# --- base patterns (contract values) ---
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
# maximal runs only, so that a run is looked at once
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base matches (kind, start, end) by start, then kind as listed; code points, end exclusive."""
    found = []
    if "=" in text or ":" in text:
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


# --- tokens and features ---
_SYMBOLS = r"""\"'`:=,;(){}\[\]<>|@"""
# full stops and the like end a token only where no more of it follows
_TOKEN = re.compile(rf"\n|[^\s{_SYMBOLS}.!?]++(?:[.!?]++[^\s{_SYMBOLS}.!?]++)*|[{_SYMBOLS}.!?]")
_CUE = re.compile(r"pass|pwd|secret|token|key|auth|bearer|cred|kennwort|passe|contrase|login|private|session|refresh")
O, B, I = range(3)
FEATURES = 1 << 14
REACH = 2  # neighbours to each side
STRETCH = 128
MOST_KNOWN = 200_000  # tokens whose features a task keeps from batch to batch
NEVER = np.float32(-1e4)


def _known_words(source: str = EXAMPLES) -> frozenset[str]:
    return frozenset(w for w in re.findall(r"[^\W\d_]+", source.lower()) if len(w) <= 12)


KNOWN = _known_words()


def token_features(token: str) -> tuple[str, ...]:
    """Features of one token: collapsed shape, length, kind of characters, the word itself where the
    labelled table knows it, a cue inside it, its first letters, how often letters and digits and
    capitals alternate, and how many different characters it has."""
    if len(token) > 256:  # a run of any length is judged by its ends
        token = token[:128] + token[-128:]
    low = token.lower()
    if token.isalpha() and (token.islower() or token.istitle()):
        return (f"s:{'x' if token.islower() else 'Xx'}", f"l:{min(len(token), 20) // 3}", "k:word",
                f"w:{low if low in KNOWN else '?'}", f"c:{bool(_CUE.search(low))}", "p:", "t:0", "u:0")
    kinds = [0 if "0" <= c <= "9" else 1 if c.islower() else 2 if c.isalpha() else 3 for c in token]
    turns = sum(a != b for a, b in zip(kinds, kinds[1:]))
    digits, hexed = kinds.count(0), all(c in "0123456789abcdef" for c in low)
    kind = ("digits" if digits == len(token) else "hex" if hexed and len(token) >= 16 else
            "mark" if kinds.count(3) == len(token) else "mixed" if digits else "letters")
    head = token[:4] if len(token) >= 16 else ""
    return (f"s:{shape(token.encode()).decode('utf8', 'replace')[:8]}", f"l:{min(len(token), 48) // 3}", f"k:{kind}",
            f"w:{low if low in KNOWN or len(token) == 1 else '?'}", f"c:{bool(_CUE.search(low))}", f"p:{head}",
            f"t:{min(turns, 12) // 2}:{min(len(token), 40) // 8}", f"u:{min(len(set(token)), 24) // 3}")


def file_features(text: str, cues: int) -> tuple[str, ...]:
    """Features of the text a token is in: assignments and brackets a thousand characters, and cue
    words."""
    marks = sum(map(text.count, "={};"))
    return (f"F:marks:{int(np.log2(1 + 1000 * marks / (200 + len(text))))}", f"F:cues:{min(cues, 3)}")


def _slots(features: tuple[str, ...], at: int) -> list[int]:
    return [zlib.crc32(f"{at}|{f}".encode()) % FEATURES for f in features]


def may_begin(token: str) -> bool:
    return len(token) > 1 and any(map(str.isalnum, token[:256]))


class Tokens(dict):
    """Token -> row of its features, given out on first sight. Tokens with the same features share a
    row; ordinary words, whose features are their length and first letter's case, find it at once."""

    def __init__(self):
        super().__init__()
        self.rows: dict[tuple, int] = {}
        self.words: dict[tuple, int] = {}
        self.features: list[tuple[tuple[str, ...], bool]] = []
        self.edge = self["\n"]

    def __missing__(self, token: str) -> int:
        low, key = token.lower(), None
        if token.isalpha() and len(token) > 1 and low not in KNOWN and not _CUE.search(low):
            if (small := token.islower()) or token.istitle():
                key = (small, min(len(token), 20) // 3)
        at = self.words.get(key, -1)
        if at < 0:
            own = (("edge",), False) if token == "\n" else (token_features(token), may_begin(token))
            at = self.rows.setdefault(own, len(self.rows))
            if at == len(self.features):
                self.features.append(own)
            if key:
                self.words[key] = at
        self[token] = at
        return at

    def emissions(self, emit: np.ndarray) -> np.ndarray:
        """(offsets, rows, states): what a row adds to the token at each offset from it."""
        out = np.zeros((2 * REACH + 1, len(self.features), 3), np.float32)
        for r, (features, _) in enumerate(self.features):
            for k in range(2 * REACH + 1):
                out[k, r] = emit[_slots(features, k - REACH)].sum(0)
        return out


def chain_of(batch: list[str], known: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(rows of all tokens, ends): every text is followed by ``REACH`` line ends, so no neighbour is
    in another text; ``ends[i]`` is where text i ends in the chain."""
    parts, ends, at = [], np.zeros(len(batch), np.int64), 0
    for i, text in enumerate(batch):
        found = _TOKEN.findall(text)
        parts.append(np.fromiter(map(known.__getitem__, found), np.int32, len(found)))
        parts.append(np.full(REACH, known.edge, np.int32))
        at += len(found) + REACH
        ends[i] = at
    return np.concatenate(parts) if parts else np.zeros(0, np.int32), ends


def scores(emit: np.ndarray, known: Tokens, chain: np.ndarray, ends: np.ndarray, batch: list[str]) -> np.ndarray:
    """(tokens, states) of the chain: own and neighbours' features, features of the text, and what
    cannot be."""
    table_of = known.emissions(emit)
    score = table_of[REACH][chain]
    for k in range(1, REACH + 1):
        score[:-k] += table_of[REACH + k][chain[k:]]
        score[k:] += table_of[REACH - k][chain[:-k]]
    cue = np.array(["c:True" in f for f, _ in known.features])
    counts = np.diff(np.concatenate([[0], np.cumsum(cue[chain])[ends - 1]])) if len(ends) else []
    bias = np.array([emit[_slots(file_features(t, int(c)), 0)].sum(0) for t, c in zip(batch, counts)],
                    np.float32).reshape(-1, 3)
    score += np.repeat(bias, np.diff(ends, prepend=0), axis=0)
    begin = np.array([ok for _, ok in known.features])
    score[~begin[chain], B] = NEVER
    score[chain == known.edge, I] = NEVER
    return score


# --- the chain model ---

def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def masked(trans: np.ndarray) -> np.ndarray:
    """Transition scores (from, to): the inside of a secret follows its beginning or inside."""
    out = trans.astype(np.float32, copy=True)
    out[O, I] = NEVER
    return out


def parse_examples(source: str = EXAMPLES) -> list[tuple[str, list[tuple[int, int]]]]:
    """(text, spans of its secrets) of each text of the labelled table."""
    out = []
    for block in source.strip("\n").split("\n\n"):
        text, spans = "", []
        for i, part in enumerate(re.split(r"\[\[|\]\](?!\])", block)):
            if i % 2:
                spans.append((len(text), len(text) + len(part)))
            text += part
        out.append((text, spans))
    return out


def gold_states(text: str, spans: list[tuple[int, int]]) -> list[int]:
    states, before = [], None
    for m in _TOKEN.finditer(text):
        inside = next((s for s in spans if s[0] <= m.start() < s[1]), None)
        states.append(O if inside is None else I if inside == before else B)
        before = inside
    return states


def likelihood(params, chain_data) -> tuple[float, np.ndarray, np.ndarray]:
    """(negative log-likelihood, its gradients by emissions and transitions) of the labelled texts;
    forward-backward over all texts at once, shorter ones padded."""
    emit, trans = params
    slots, width, allowed, gold, lengths = chain_data
    t = masked(trans).astype(np.float64)
    n, longest = gold.shape
    score = emit[slots].sum(2) + allowed
    fore, back = np.zeros((n, longest, 3)), np.zeros((n, longest, 3))
    fore[:, 0] = score[:, 0] + t[O]  # before the first token: outside
    for p in range(1, longest):
        fore[:, p] = _lse(fore[:, p - 1][:, :, None] + t, 1) + score[:, p]
    for p in range(longest - 2, -1, -1):
        new = _lse(t[None] + (score[:, p + 1] + back[:, p + 1])[:, None, :], 2)
        back[:, p] = np.where((p + 1 < lengths)[:, None], new, 0)
    rows = np.arange(n)
    total = _lse(fore[rows, lengths - 1], 1)
    inside = np.arange(longest) < lengths[:, None]
    p1 = np.where(inside[:, :, None], np.exp(fore + back - total[:, None, None]), 0)
    pair = np.exp(fore[:, :-1, :, None] + t + (score + back)[:, 1:, None, :] - total[:, None, None, None])
    pair = np.where(inside[:, 1:, None, None], pair, 0)
    hot = np.eye(3)[gold] * inside[:, :, None]
    loss = (total - (np.where(inside, np.take_along_axis(score, gold[:, :, None], 2)[:, :, 0], 0).sum(1)
                     + t[O, gold[:, 0]] + np.where(inside[:, 1:], t[gold[:, :-1], gold[:, 1:]], 0).sum(1))).sum()
    g_emit = np.zeros_like(emit)
    np.add.at(g_emit, slots.reshape(-1, width), (p1 - hot).reshape(-1, 1, 3))
    g_trans = pair.sum((0, 1)) - np.einsum("npa,npb->ab", hot[:, :-1] * inside[:, 1:, None], hot[:, 1:])
    g_trans[O] += (p1[:, 0] - hot[:, 0]).sum(0)
    return float(loss), g_emit, g_trans


def training_data(examples=None):
    """Feature slots, what cannot be, states and lengths of the labelled texts, padded."""
    examples = examples or parse_examples()
    found = [_TOKEN.findall(text) + ["\n"] * REACH for text, _ in examples]
    longest, width = max(map(len, found)), 8 * (2 * REACH + 1) + 2
    spare = FEATURES  # one slot more, always zero, for padding
    slots = np.full((len(found), longest, width), spare, np.int64)
    allowed, gold = np.zeros((len(found), longest, 3)), np.zeros((len(found), longest), np.int64)
    for r, (words, (text, spans)) in enumerate(zip(found, examples)):
        rows = [("edge",) if w == "\n" else token_features(w) for w in words]
        about = file_features(text, sum("c:True" in f for f in rows))
        for i, w in enumerate(words):
            own = _slots(about, 0)
            for k in range(-REACH, REACH + 1):
                there = rows[i + k] if 0 <= i + k < len(rows) else ("edge",)
                # what stands at i + k is, seen from there, k to the left
                own += _slots(there, k)
            slots[r, i, :len(own)] = own
            if not may_begin(w):
                allowed[r, i, B] = NEVER
            if w == "\n":
                allowed[r, i, I] = NEVER
        gold[r, :len(words)] = gold_states(text, spans) + [O] * REACH
    return slots, width, allowed, gold, np.array([len(w) for w in found])


def train(examples=None, passes: int = 200, rate: float = 0.25, l2: float = 0.003):
    """(emission weights, transition weights): penalised likelihood by AdaGrad."""
    data = training_data(examples)
    emit, trans = np.zeros((FEATURES + 1, 3)), np.zeros((3, 3))
    sq_e, sq_t = np.full_like(emit, 1e-2), np.full_like(trans, 1e-2)
    for _ in range(passes):
        _, g_e, g_t = likelihood((emit, trans), data)
        g_e, g_t = g_e + l2 * emit, g_t + l2 * trans
        g_e[FEATURES] = 0
        g_t[O, I] = 0
        sq_e += g_e * g_e
        sq_t += g_t * g_t
        emit -= rate * g_e / np.sqrt(sq_e)
        trans -= rate * g_t / np.sqrt(sq_t)
    return emit[:FEATURES].astype(np.float32), masked(trans)


def viterbi(trans: np.ndarray, score: np.ndarray, stretch: int = STRETCH) -> np.ndarray:
    """Best states of one chain that stands after a token outside and ends outside (a line's end)."""
    n = len(score)
    if not n:
        return np.zeros(0, np.int8)
    m = -(-n // stretch)
    cells = np.zeros((m * stretch, 3), np.float32)
    cells[:n] = score
    cells[n:, 1:] = NEVER  # padding is outside
    cells = np.ascontiguousarray(cells.reshape(m, stretch, 3).transpose(1, 2, 0))  # (place, state, stretch)
    back = np.zeros((stretch, 3, 3, m), np.int8)  # best state before, by (state, state before the stretch)
    best = trans.T[:, :, None] + cells[0][:, None, :]
    for p in range(1, stretch):
        new = np.empty_like(best)
        for to in (O, B, I):
            a, b, c = (best[frm] + trans[frm, to] for frm in (O, B, I))
            top = np.maximum(a, b)
            back[p, to] = np.where(c > top, 2, b > a)
            new[to] = np.maximum(top, c) + cells[p, to]
        best = new
    best = best.transpose(2, 1, 0)  # (stretch, state before, state)
    # through the stretches: the state after each, given the one before
    entry, came = np.zeros((m + 1, 3), np.int8), np.zeros(3, np.float64)
    came[B] = came[I] = NEVER  # before the first token: outside
    for s in range(m):
        step = came[:, None] + best[s]
        entry[s + 1] = step.argmax(0)
        came = step.max(0)
        came -= came.max()
    before, state = np.zeros(m, np.int64), np.zeros(m, np.int64)
    last = int(came.argmax())
    for s in range(m - 1, -1, -1):
        state[s] = last
        before[s] = last = int(entry[s + 1, last])
    out = np.zeros((m, stretch), np.int8)
    rows = np.arange(m)
    for p in range(stretch - 1, -1, -1):
        out[:, p] = state
        if p:
            state = back[p, state, before, rows].astype(np.int64)
    return out.reshape(-1)[:n]


def crf_spans(model, batch: list[str], known: Tokens | None = None) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) of the secrets that the CRF finds in each whole text. ``known`` keeps the
    features of tokens from one call to the next."""
    emit, trans = model
    known = Tokens() if known is None else known
    found: list[list[tuple[str, int, int]]] = [[] for _ in batch]
    chain, ends = chain_of(batch, known)
    if not len(chain):
        return found
    states = viterbi(trans, scores(emit, known, chain, ends, batch))
    starts = np.concatenate([[0], ends[:-1]])
    for d in np.unique(np.searchsorted(ends, np.flatnonzero(states == B), side="right")):
        own = states[starts[d]:ends[d]]
        spans, open_ = found[d], False
        for m, s in zip(_TOKEN.finditer(batch[d]), own.tolist()):
            if s == B or s == I and not open_:
                spans.append(("secret", m.start(), m.end()))
            elif s == I:
                spans[-1] = ("secret", spans[-1][1], m.end())
            open_ = s != O
    return found


def _marks(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def merged(base: list[tuple[str, int, int]], extra: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """All base spans and those of ``extra`` that touch none, by start, then kind."""
    out, ends, k = list(base), 0, 0
    for kind, a, b in sorted(extra, key=lambda x: x[1]):
        while k < len(base) and base[k][1] < b:  # base spans that begin before b
            ends = max(ends, base[k][2])
            k += 1
        if ends <= a:
            out.append((kind, a, b))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def finder(model, most: int = 4_000_000):
    """Function for mapInPandas: (doc_id, text) to the secrets of each text."""
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Tokens()
        for run in pieces(batches, most):
            known = known if len(known) < MOST_KNOWN else Tokens()
            batch, rows = run["text"].tolist(), []
            for text, extra in zip(batch, crf_spans(model.value, batch, known)):
                base = base_spans(text)
                every = merged(base, extra)
                counts = [sum(k == x for k, _, _ in base) for x in KINDS[:3]]
                rows.append((*counts, _marks(base), _marks(every), len(every)))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base", "spans", "n_spans"])
            out.insert(0, "doc_id", run["doc_id"].to_numpy())
            yield out
    return find


def secrets(docs: DataFrame, model=None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base, spans, n_spans) of every row.

    ``base`` lists the pattern matches as kind:start:end (code points, end exclusive) by start, then
    kind; ``spans`` has the CRF's spans as well. Null and empty texts have none; texts are read
    whole; repeated rows give equal rows; an empty table gives an empty result; other columns are
    ignored, whatever their names; a null doc_id stays null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or train())  # FEATURES x states floats
    return texts(docs).mapInPandas(finder(shared), (
        "doc_id long, n_assign long, n_access long, n_hex long, base string, spans string, n_spans long"))


def op13_secret_crf(spark, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    found = secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans", "n_spans")
