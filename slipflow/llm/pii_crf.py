"""Personal data: a linear-chain conditional random field over word-shape features beside a fixed
base of patterns.

The base finds e-mail addresses, IP addresses, card numbers and phone numbers by pattern. The CRF
is trained from the small labelled table in ``pii_examples`` and adds what the patterns miss
(phones without a plus sign, cards with unusual grouping, identity numbers, IBANs, secrets); it is
decoded by Viterbi over numpy batches of lines. A mark can only begin at a word that holds a
digit, which is a structural zero of the model: a line without digits has a single possible
labelling and needs no decoding. Base spans always stay; a CRF span that touches one is dropped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import pieces, shape, table, texts
from .pii_examples import EXAMPLES, KINDS

BASE = ("email", "ip", "card", "phone")
# --- base patterns (contract values) ---
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a run of digits that fails at its head fails at its later digits too, hence the lookbehind
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Each @ with the longest local part before it that no earlier match took, if a domain
    follows; the same matches as the pattern, in linear time."""
    found, taken, at = [], 0, text.find("@")
    while at >= 0:
        if at >= taken:
            start = at
            while start > taken and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                found.append((start, m.end()))
                taken = m.end()
            else:
                taken = max(taken, at + 1)
        at = text.find("@", at + 1)
    return found


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Leftmost non-overlapping base matches by kind; code points, end exclusive."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in BASE}
    if "@" in text:
        out["email"] = _emails(text)
    if not _DIGIT.search(text):
        return out
    if "." in text:
        out["ip"] = [m.span() for m in _IP.finditer(text)
                     if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255
                            for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start():
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out["card"].append(m.span())
    if "+" in text:
        out["phone"] = [m.span() for m in _PHONE.finditer(text)
                        if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15]
    return out


# --- the conditional random field ---
_TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")
STATES = ("O",) + tuple(f"{b}-{k}" for k in KINDS for b in "BI")
FEATURES = 1 << 12
_HASH = np.uint64(0x9E3779B97F4A7C15)
BLOCK = 200_000  # words decoded at once


def tokens(line: str) -> list[tuple[str, int, int]]:
    return [(m.group(), m.start(), m.end()) for m in _TOKEN.finditer(line)]


def word_features(word: str) -> list[str]:
    """Features of one word: collapsed shape, full shape of short words, length, digits, and the
    word itself when it is a known cue (all in lower case)."""
    raw = word.encode()
    digits = sum("0" <= c <= "9" for c in word)
    low = word.lower()
    return [f"s:{shape(raw).decode('utf8', 'replace')}",
            f"l:{min(len(word), 12)}:{'d' if digits == len(word) else 'm' if digits else 'w'}",
            f"w:{low if not digits and len(word) <= 9 else ''}",
            f"h:{len(word) >= 16 and all(c in '0123456789abcdef' for c in low) and digits < len(word)}",
            f"z:{min(digits, 12)}"]


def feature_ids(words: list[str]) -> np.ndarray:
    """(words, columns) hashed features of every word with its neighbours two words to each side."""
    cache: dict[str, list[int]] = {}

    def own(w: str) -> list[int]:
        if w not in cache:
            cache[w] = [int.from_bytes(hashlib.blake2b(f.encode(), digest_size=8).digest(), "little")
                        for f in word_features(w)]
        return cache[w]

    base = np.array([own(w) for w in words], np.uint64).reshape(len(words), -1)
    edge = np.array([own("\n")], np.uint64)
    cols = []
    with np.errstate(over="ignore"):
        for offset in (-2, -1, 0, 1, 2):
            moved = np.repeat(edge, len(words), axis=0)
            if offset < 0:
                moved[-offset:] = base[:offset]
            elif offset:
                moved[:-offset] = base[offset:]
            else:
                moved = base
            cols.append((moved + np.uint64(offset + 3)) * _HASH >> np.uint64(52))
    return np.concatenate(cols, axis=1).astype(np.int64) % FEATURES


def allowed_start(words: list[str]) -> np.ndarray:
    """A mark may begin at words with a digit, and at an opening bracket before one."""
    digit = np.array([bool(_DIGIT.search(w)) for w in words], bool)
    opening = np.array([w == "(" for w in words], bool)
    return digit | (opening & np.append(digit[1:], False))


def transitions_allowed() -> np.ndarray:
    """I-k follows B-k or I-k only; the last row is the start of a line."""
    s = len(STATES)
    ok = np.ones((s + 1, s), bool)
    for j in range(s):
        if j and j % 2 == 0:
            ok[:, j] = False
            ok[[j - 1, j], j] = True
    return ok


def parse_examples(source: str = EXAMPLES) -> list[tuple[list[str], np.ndarray]]:
    """(words, states) of each sentence of the labelled table."""
    out = []
    for line in filter(None, map(str.strip, source.split("\n"))):
        words, states = [], []
        for plain, kind, marked in re.findall(r"([^\[]+)|\[(\w+) ([^\]]+)\]", line):
            for i, (w, _, _) in enumerate(tokens(plain or marked)):
                words.append(w)
                states.append(0 if plain else 2 * KINDS.index(kind) + (1 if i == 0 else 2))
        out.append((words, np.array(states)))
    return out


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def train(sentences=None, passes: int = 120, rate: float = 0.2, l2: float = 0.02):
    """(emission weights, transition weights): penalised likelihood by AdaGrad, gradients by
    forward-backward."""
    sentences = sentences or parse_examples()
    s, no = len(STATES), -1e4
    emit, trans = np.zeros((FEATURES, s)), np.zeros((s + 1, s))
    mask = np.where(transitions_allowed(), 0.0, no)
    sq_e, sq_t = np.full_like(emit, 1e-2), np.full_like(trans, 1e-2)
    data = []
    for words, gold in sentences:
        start = np.where(allowed_start(words)[:, None] | ~np.array([x[0] == "B" for x in STATES]), 0.0, no)
        data.append((feature_ids(words), start, gold))
    for _ in range(passes):
        g_e, g_t = l2 * emit, l2 * trans
        for feats, start, gold in data:
            n, score, t = len(gold), emit[feats].sum(1) + start, trans + mask
            fore, back = np.zeros((n, s)), np.zeros((n, s))
            fore[0] = t[s] + score[0]
            for i in range(1, n):
                fore[i] = _logsumexp(fore[i - 1][:, None] + t[:s], 0) + score[i]
            for i in range(n - 2, -1, -1):
                back[i] = _logsumexp(t[:s] + score[i + 1] + back[i + 1], 1)
            total = _logsumexp(fore[-1], 0)
            p = np.exp(fore + back - total)
            p[np.arange(n), gold] -= 1
            np.add.at(g_e, feats.ravel(), np.repeat(p, feats.shape[1], axis=0))
            g_t[s] += p[0]
            for i in range(1, n):
                pair = np.exp(fore[i - 1][:, None] + t[:s] + score[i] + back[i] - total)
                pair[gold[i - 1], gold[i]] -= 1
                g_t[:s] += pair
        sq_e += g_e * g_e
        sq_t += g_t * g_t
        emit -= rate * g_e / np.sqrt(sq_e)
        trans -= rate * g_t / np.sqrt(sq_t)
    return emit.astype(np.float32), (trans + mask).astype(np.float32)


def viterbi(model, lines: list[list[str]]) -> list[np.ndarray]:
    """Best states of each line. Lines go in blocks of similar length: a block is a padded
    (lines, words, states) array that one step per word position moves through."""
    emit, trans = model
    s = len(STATES)
    begins = np.array([x[0] == "B" for x in STATES])
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(lines)
    order = sorted(range(len(lines)), key=lambda i: len(lines[i]))
    order = [i for i in order if lines[i]]
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and len(lines[order[end]]) * (end + 1 - at) <= BLOCK:
            end += 1
        some, longest = order[at:end], len(lines[order[end - 1]])
        at = end
        score = np.zeros((len(some), longest, s), np.float32)
        for r, i in enumerate(some):
            row = emit[feature_ids(lines[i])].sum(1)
            row[np.ix_(~allowed_start(lines[i]), begins)] -= 1e4
            score[r, :len(row)] = row
        lengths = np.array([len(lines[i]) for i in some])
        back = np.zeros((len(some), longest, s), np.int8)
        best = trans[s] + score[:, 0]
        for p in range(1, longest):
            step = best[:, :, None] + trans[:s]
            back[:, p] = step.argmax(1)
            new = step.max(1) + score[:, p]
            best = np.where((p < lengths)[:, None], new, best)
        state = best.argmax(1)
        paths = np.zeros((len(some), longest), np.int64)
        for p in range(longest - 1, -1, -1):
            paths[:, p] = state
            state = np.where(p < lengths, back[np.arange(len(some)), p, state], state) if p else state
        for r, i in enumerate(some):
            out[i] = paths[r, :lengths[r]]
    return out


def crf_spans(model, batch: list[str]) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) found by the CRF in each whole text."""
    found: list[list[tuple[str, int, int]]] = [[] for _ in batch]
    lines, places = [], []
    for d, text in enumerate(batch):
        if not _DIGIT.search(text):
            continue
        at = 0
        for line in text.split("\n"):
            if _DIGIT.search(line):
                toks = tokens(line)
                lines.append([w for w, _, _ in toks])
                places.append((d, at, toks))
            at += len(line) + 1
    for (d, at, toks), states in zip(places, viterbi(model, lines)):
        i = 0
        while i < len(states):
            if states[i] % 2 == 1:
                j = i + 1
                while j < len(states) and states[j] == states[i] + 1:
                    j += 1
                found[d].append((KINDS[states[i] // 2], at + toks[i][1], at + toks[j - 1][2]))
                i = j
            else:
                i += 1
    return found


def _marks(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def finder(model):
    """Function for mapInPandas: (doc_id, text) to the personal data of each text."""
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in pieces(batches):
            batch = run["text"].tolist()
            rows = []
            for text, extra in zip(batch, crf_spans(model.value, batch)):
                base = base_spans(text)
                kept = [(k, a, b) for k in BASE for a, b in base[k]]
                taken = sorted((a, b) for _, a, b in kept)
                ends, k, added = 0, 0, []
                for kind, a, b in sorted(extra, key=lambda x: x[1]):
                    while k < len(taken) and taken[k][0] < b:  # base spans that begin before b
                        ends = max(ends, taken[k][1])
                        k += 1
                    if ends <= a:
                        added.append((kind, a, b))
                every = sorted(kept + added, key=lambda x: (
                    BASE.index(x[0]) if x[0] in BASE else len(BASE) + KINDS.index(x[0]), x[1]))
                rows.append((*(len(base[x]) for x in BASE), _marks(kept), _marks(every), len(added)))
            out = pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base", "spans", "n_added"])
            out.insert(0, "doc_id", run["doc_id"].to_numpy())
            yield out
    return find


def personal_data(docs: DataFrame, model=None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans, n_added) of every row.

    ``base`` lists the pattern matches as kind:start:end (code points, end exclusive), by kind and
    start; ``spans`` has the CRF's spans as well. Null and empty texts have none; texts are read
    whole; repeated rows give equal rows; an empty table gives an empty result; other columns are
    ignored; a null doc_id stays null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or train())  # FEATURES x states floats
    return texts(docs).mapInPandas(finder(shared), (
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string, "
        "n_added long"))


def op1_pii_crf(spark, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    from pyspark.sql import functions as F
    found = personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans", "n_added")
