"""Language-model scoring: a causal self-attention model over subword ids, and add-one word counts.

A word's subword id is the longest piece of a public vocabulary that begins it. The attention
model (one head, trained in numpy) predicts the class of the next word's subword id from the ids
before it; the word itself follows with its add-one share of the counts of its class. So the
score of a text is log10 of the product over its words and its end of
P(class | ids before) * (count + 1) / (class count + class words + 1).
Texts are cut into windows of ``WINDOW`` ids that overlap by ``CONTEXT``: a window scores its last
``STRIDE`` ids, so every token is scored once; windows go through masked attention in batches.

Texts are cut into words once: one scan turns runs of texts into local word ids, the subword ids that
the model is trained on, and the words of a run into slices by word hash. Counts come from the whole
corpus: a slice group adds up the counts of its words over all runs and
sends each run its own words' totals; the run's texts meet them by run. A very frequent word is
one entry per run, so no key is hot, and no vocabulary is broadcast or held whole anywhere.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, pieces, remainder, staged, table, texts
from .sentencepieces import BLANK, MODEL

DIM = 16
CLASSES = 128
WINDOW, CONTEXT = 32, 8
STRIDE = WINDOW - CONTEXT
FEW = 48  # windows whose class scores fit a core's cache
FOLD = (7, 2)
DOCS_PER_SLICE = 2000


@dataclass
class Attention:
    """The model. ``heads`` maps a piece (as text) to its subword id; the last two ids are the end
    of a text and the beginning of one. Class 0 is the end of a text."""

    heads: dict[str, int]
    classes: np.ndarray  # by subword id
    embed: np.ndarray  # (ids, DIM)
    place: np.ndarray  # (WINDOW, DIM)
    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    out: np.ndarray  # (DIM, CLASSES)
    bias: np.ndarray

    @property
    def end(self) -> int:
        return len(self.embed) - 2

    @property
    def begin(self) -> int:
        return len(self.embed) - 1


def subword_heads(path: str = MODEL) -> dict[str, int]:
    """Pieces that can begin a word (without the blank before it) by id; id 0 for none of them."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    names = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
    starts = sorted({x[1:] for x in names if x.startswith(BLANK) and x.strip(BLANK)})
    return {x: i + 1 for i, x in enumerate(starts)}


def head_of(word: bytes, heads: dict[str, int], longest: int) -> int:
    text = word.decode()
    for n in range(min(longest, len(text)), 0, -1):
        if (i := heads.get(text[:n])) is not None:
            return i
    return 0


def windows(ids: np.ndarray, ends: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """(inputs, targets) of all windows: rows of positions in ``ids`` (-1: before the text).

    ``ids`` holds texts one after the other, each with its end token; a target of -1 is not scored.
    """
    starts = np.concatenate([[0], ends[:-1]])
    n = ends - starts
    per = -(-n // STRIDE)
    first = np.repeat(starts, per)
    last = np.repeat(ends, per)
    index = np.arange(len(first)) - np.repeat(np.cumsum(per) - per, per)
    target = (first + index * STRIDE - CONTEXT)[:, None] + np.arange(WINDOW)
    source = target - 1
    source = np.where((source >= first[:, None]) & (source < last[:, None]), source, -1)
    scored = (np.arange(WINDOW) >= CONTEXT) & (target < last[:, None])
    return np.where(source >= 0, ids[source], begin), np.where(scored, target, -1)


_MASK = np.where(np.tril(np.ones((WINDOW, WINDOW), bool)), 0, -1e9).astype(np.float32)


def train_attention(sequences: list[np.ndarray], n_ids: int, classes: np.ndarray, passes: int = 3,
                    batch: int = 96, rate: float = 0.01, seed: int = 5) -> Attention:
    """Adam on the mean log loss of the next class; whole sequences (each with its end) are cut
    into the windows that scoring uses."""
    rng = np.random.default_rng(seed)
    f32 = lambda *s, scale=0.1: (rng.standard_normal(s) * scale).astype(np.float32)
    p = {"embed": f32(n_ids + 2, DIM, scale=0.3), "place": f32(WINDOW, DIM), "query": f32(DIM, DIM, scale=0.25),
         "key": f32(DIM, DIM, scale=0.25), "value": f32(DIM, DIM, scale=0.25), "out": f32(DIM, CLASSES),
         "bias": np.zeros(CLASSES, np.float32)}
    if sequences:
        ids = np.concatenate(sequences)
        p["bias"] = np.log(np.bincount(classes[ids], minlength=CLASSES) + 0.5).astype(np.float32)
        p["bias"] -= p["bias"].mean()
        x, t = windows(ids, np.cumsum([len(s) for s in sequences]), n_ids + 1)
        y = np.where(t >= 0, classes[ids[t]], -1)
        m, v, step = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
        total = passes * -(-len(x) // batch)
        for _ in range(passes):
            order = rng.permutation(len(x))
            for a in range(0, len(x), batch):
                some = order[a:a + batch]
                g = _gradient(p, x[some], y[some])
                step += 1
                now = rate * (1 - step / (total + 1))
                for k in p:
                    m[k] += 0.1 * (g[k] - m[k])
                    v[k] += 0.01 * (g[k] ** 2 - v[k])
                    p[k] -= now * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
    return Attention({}, classes, **p)


def _softmax(a: np.ndarray, share: np.ndarray | float = 1) -> None:
    """Softmax over the axis before the last, times ``share``, in place: numpy reduces it in long rows."""
    a -= a.max(-2, keepdims=True)
    np.exp(a, out=a)
    a *= share / a.sum(-2, keepdims=True)


def _with_one(rows: np.ndarray) -> np.ndarray:
    """Rows with a 1 behind each, which a product with the bias behind the weights adds or sums up."""
    return np.append(rows, np.ones((len(rows), 1), rows.dtype), axis=1)


def _gradient(p: dict, x: np.ndarray, y: np.ndarray) -> dict:
    h = p["embed"][x] + p["place"]
    q, k, v = h @ p["query"], h @ p["key"], h @ p["value"]
    w = k @ q.transpose(0, 2, 1)  # by the token attended to, then the one that attends
    for a in range(0, len(x), FEW):  # few at a time stay in the cache
        s = w[a:a + FEW]
        s /= np.sqrt(DIM, dtype=np.float32)
        s += _MASK.T
        _softmax(s)
    o = h + w.transpose(0, 2, 1) @ v
    late, y = o[:, CONTEXT:].reshape(-1, DIM), y[:, CONTEXT:].ravel()  # what comes before is never scored
    real = y >= 0
    share = (real / max(1, real.sum())).astype(np.float32)
    both, out = np.zeros((CLASSES, DIM + 1), p["out"].dtype), np.append(p["out"], p["bias"][None], axis=0).T
    g = {}
    do = np.zeros_like(o)
    back = np.empty_like(late)
    late = _with_one(late)
    for a in range(0, len(late), FEW * STRIDE):
        some = slice(a, a + FEW * STRIDE)
        d = out @ late[some].T  # by class, then token
        _softmax(d, share[some])
        at = np.flatnonzero(real[some])
        d[y[some][at], at] -= share[some][at]
        both += d @ late[some]
        back[some] = (p["out"] @ d).T
    g["out"], g["bias"] = both[:, :DIM].T, both[:, DIM]
    do[:, CONTEXT:] = back.reshape(len(x), STRIDE, DIM)
    dv = w @ do
    ds = v @ do.transpose(0, 2, 1)
    ds -= (ds * w).sum(1, keepdims=True)
    ds *= w
    ds /= np.sqrt(DIM, dtype=np.float32)
    dq, dk = ds.transpose(0, 2, 1) @ k, ds @ q
    flat = lambda a: a.reshape(-1, a.shape[-1])
    g["query"], g["key"], g["value"] = (flat(h).T @ flat(z) for z in (dq, dk, dv))
    dh = do + dq @ p["query"].T + dk @ p["key"].T + dv @ p["value"].T
    g["place"] = dh.sum(0)
    g["embed"] = np.zeros_like(p["embed"])
    at = x.ravel()
    order = np.argsort(at.astype(np.min_scalar_type(len(p["embed"]))), kind="stable")
    at = at[order]
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    g["embed"][at[first]] = np.add.reduceat(flat(dh)[order], first, axis=0)
    return g


def class_log_probs(m: Attention, ids: np.ndarray, ends: np.ndarray, batch: int = FEW) -> np.ndarray:
    """Natural log of P(class of token | tokens before) for every token of the sequences."""
    out = np.zeros(len(ids), np.float64)
    x, target = windows(ids, ends, m.begin)
    scale = np.float32(1 / np.sqrt(DIM))
    tables = [(m.embed @ w, m.place @ w) for w in (m.query * scale, m.key, m.value)]
    mask, late = _MASK[CONTEXT:].T, slice(CONTEXT, WINDOW)
    by_class = np.append(m.out, m.bias[None], axis=0).T
    for a in range(0, len(x), batch):
        some = x[a:a + batch]
        q = tables[0][0][some[:, late]] + tables[0][1][late]
        k, v = (t[some] + place for t, place in tables[1:])
        s = k @ q.transpose(0, 2, 1)  # by the token attended to, then the one that attends
        s += mask
        _softmax(s)
        o = s.transpose(0, 2, 1) @ v
        o += m.embed[some[:, late]] + m.place[late]
        want = target[a:a + batch, late].ravel()
        real = want >= 0
        want, o = want[real], o.reshape(-1, DIM)[real]
        logits = by_class @ _with_one(o).T  # by class, then token
        chosen = logits[m.classes[ids[want]], np.arange(len(want))].astype(np.float64)
        top = logits.max(0)
        logits -= top
        np.exp(logits, out=logits)
        out[want] = chosen - top - np.log(logits.sum(0, dtype=np.float64))
    return out


def token_words(text: str) -> list[bytes]:
    """Words between ASCII blanks, A-Z lower-cased."""
    return text.encode().lower().split()


def head_ids(words: list[bytes], heads: dict[str, int]) -> np.ndarray:
    longest = max(map(len, heads))
    return np.fromiter((head_of(w, heads, longest) for w in words), np.int32, len(words))


def id_type(heads: dict[str, int]) -> np.dtype:
    """Smallest type of a subword id as it is stored."""
    return np.min_scalar_type(len(heads) + 1)


SUBWORDS = "chars long, subwords binary"


def subword_rows(heads: dict[str, int]):
    """Function for mapInPandas: texts to (chars, subword ids)."""
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in pieces(batches):
            seen = Words()
            local = [seen.ids(token_words(t)) for t in run["text"]]
            head = head_ids(seen.words, heads).astype(id_type(heads))
            yield pd.DataFrame({"chars": run["text"].str.len(), "subwords": [head[x].tobytes() for x in local]})
    return make


def _sequences(run: pd.DataFrame, heads: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(subword ids of all texts one after the other, each with its end, ends)."""
    kind = id_type(heads)
    size = np.fromiter(map(len, run["subwords"]), np.int64, len(run)) // kind.itemsize
    ends = np.cumsum(size + 1)
    ids = np.full(ends[-1], len(heads) + 1, np.int64)
    inside = np.ones(len(ids), bool)
    inside[ends - 1] = False
    ids[inside] = np.frombuffer(b"".join(run["subwords"]), kind)
    return ids, ends


def subword_counts(rows: DataFrame, heads: dict[str, int]) -> tuple[np.ndarray, int]:
    """(occurrences by subword id, ends among them, over all ``rows`` of ``SUBWORDS``; texts). A task
    sends one row per id at most."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(heads) + 2, np.int64)
        for run in pieces(batches, size="chars"):
            total += np.bincount(_sequences(run, heads)[0], minlength=len(total))
        some = np.flatnonzero(total)
        yield pd.DataFrame({"id": some.astype(np.int32), "n": total[some]})

    total = np.zeros(len(heads) + 3, np.int64)
    for r in rows.mapInPandas(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        total[r.id] = r.n
    return total, int(total[len(heads) + 1])


PARTS = ("place", "query", "key", "value", "out", "bias")
ID_BLOCK = 1024
DOCS_PER_TRAINER = 4000


def averaged_pass(rows: DataFrame, start: Attention, heads: dict[str, int], trainers: int,
                  batch: int = 96, rate: float = 0.03) -> Attention:
    """``start`` after one pass over all texts of ``rows`` (``SUBWORDS``): every task trains on from it
    (Adagrad) over its own texts, and the changes are averaged by tokens, those of an id by its occurrences. A task
    sends the blocks of ids it has met; the driver gets one model."""
    shared = rows.sparkSession.sparkContext.broadcast(start)

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = shared.value
        p = {k: getattr(first, k).copy() for k in ("embed", *PARTS)}
        square = {k: np.full_like(a, 1e-8) for k, a in p.items()}
        met, rng = np.zeros(len(first.embed), np.int64), np.random.default_rng(5)
        for run in pieces(batches, 2_000_000, "chars"):
            ids, ends = _sequences(run, heads)
            x, t = windows(ids, ends, first.begin)
            y = np.where(t >= 0, first.classes[ids[t]], -1)
            met += np.bincount(x.ravel(), minlength=len(met))
            order = rng.permutation(len(x))
            for a in range(0, len(x), batch):
                some = order[a:a + batch]
                own, place = np.unique(x[some], return_inverse=True)
                g = _gradient(p | {"embed": p["embed"][own]}, place.reshape(len(some), WINDOW), y[some])
                for k in PARTS:
                    square[k] += g[k] ** 2
                    p[k] -= rate * g[k] / np.sqrt(square[k])
                square["embed"][own] += g["embed"] ** 2
                p["embed"][own] -= rate * g["embed"] / np.sqrt(square["embed"][own])
        task, tokens, out = TaskContext.get().partitionId(), met.sum(), []
        if tokens:
            dense = np.concatenate([(p[k] - getattr(first, k)).ravel() for k in PARTS])
            out.append((task, -1, np.array([tokens], np.int64).tobytes(), dense.astype(np.float32).tobytes()))
            for b in np.unique(np.flatnonzero(met) // ID_BLOCK):
                at = slice(b * ID_BLOCK, (b + 1) * ID_BLOCK)
                out.append((task, int(b), met[at].tobytes(), (p["embed"][at] - first.embed[at]).tobytes()))
        yield pd.DataFrame(out, columns=["task", "block", "n", "part"])

    def add(found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values("task")
        n, total = 0, 0.0
        for count, part in zip(found["n"], found["part"]):
            count = np.frombuffer(count, np.int64)
            n = n + count
            total = total + count[:, None] * np.frombuffer(part, np.float32).reshape(len(count), -1).astype(np.float64)
        mean = (total / np.maximum(n, 1)[:, None]).astype(np.float32)
        return pd.DataFrame({"block": found["block"].iloc[:1], "part": [mean.tobytes()]})

    change = (rows.coalesce(trainers).mapInPandas(learn, "task int, block int, n binary, part binary")
              .groupBy("block").applyInPandas(add, "block int, part binary").collect())
    p = {k: getattr(start, k).copy() for k in ("embed", *PARTS)}
    for r in change:
        mean = np.frombuffer(bytes(r.part), np.float32)
        if r.block >= 0:
            p["embed"][r.block * ID_BLOCK:(r.block + 1) * ID_BLOCK] += mean.reshape(-1, DIM)
        else:
            for k, x in zip(PARTS, np.split(mean, np.cumsum([p[k].size for k in PARTS])[:-1])):
                p[k] += x.reshape(p[k].shape)
    shared.destroy()
    return Attention(heads, start.classes, **p)


def train(docs: DataFrame, path: str = MODEL, most: int = 600, fold: tuple[int, int] = FOLD,
          subwords: DataFrame | None = None) -> Attention:
    """Attention model from all texts outside the held-out fold: started on ``most`` of them (the
    driver gets their subword ids only), then trained by a pass over all, averaged over partitions.
    Classes: the most frequent subword ids of all these texts one each, the others by hash into the
    last quarter. ``subwords`` holds all these texts as ``SUBWORDS``, if they are cut already."""
    heads = subword_heads(path)
    longest = max(map(len, heads))
    chosen = (docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id IS NOT NULL")
              .filter(remainder("doc_id", fold[0]) != fold[1]).distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    if subwords is None:
        learnt = texts(docs).filter("doc_id IS NOT NULL").filter(remainder("doc_id", fold[0]) != fold[1])
        subwords = staged(learnt.mapInPandas(subword_rows(heads), SUBWORDS), "lm-subwords")

    def to_ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": [np.array(
                [head_of(w, heads, longest) for w in token_words(t)], np.int32).tobytes() for t in batch["text"]]})

    # ``most`` ids: a proven bound for the broadcast
    rows = (texts(docs).join(F.broadcast(chosen), "doc_id").mapInPandas(to_ids, "doc_id long, ids binary")
            .orderBy(F.xxhash64("doc_id"), "doc_id", "ids").collect())
    n = len(heads) + 1
    sequences = [np.append(np.frombuffer(bytes(r.ids), np.int32), n).astype(np.int64) for r in rows]
    count, n_texts = subword_counts(subwords, heads)
    count = count[:n + 2]
    count[n:] = 0
    own = CLASSES * 3 // 4
    classes = (own + np.arange(n + 2) * 2654435761 % 2 ** 32 % (CLASSES - own)).astype(np.int64)
    ranked = np.argsort(-count, kind="stable")[:own - 1]
    ranked = ranked[count[ranked] > 0]
    classes[ranked] = np.arange(1, len(ranked) + 1)
    classes[n:] = 0
    model = train_attention(sequences, n, classes)
    model.heads = heads
    # class shares of all texts instead of the starting ones
    count[n] = n_texts
    seen = np.bincount(np.concatenate(sequences), minlength=n + 2) if sequences else np.zeros(n + 2, np.int64)
    share = [np.bincount(classes, weights=c, minlength=CLASSES) + 0.5 for c in (count, seen)]
    model.bias += np.log(share[0] / share[0].sum() / (share[1] / share[1].sum())).astype(np.float32)
    return averaged_pass(subwords, model, heads, 1 + n_texts // DOCS_PER_TRAINER)


def runs(shared, slices: int, training: bool):
    """Function for mapInPandas: texts to runs. A run has one row per text (its local word ids, and the
    subword ids of one that is ``training`` the model), one row with the subword ids of its words, and
    one row per slice with the words themselves and their subword ids."""
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        heads = shared.value
        for run in pieces(batches, 12_000_000):
            seen, ids = Words(), []
            for text in run["text"]:
                ids.append(seen.ids(token_words(text)))
            learn = run["learn"].to_numpy(bool)
            n = len(seen.words)
            counts = np.bincount(np.concatenate([np.zeros(0, np.int32), *(x for x, use in zip(ids, learn) if use)]),
                                 minlength=n)
            # words in the order of their slices
            where = np.fromiter(map(zlib.crc32, seen.words), np.int64, n) % slices
            order = np.argsort(where, kind="stable")
            rank = np.empty(n, np.int32)
            rank[order] = np.arange(n, dtype=np.int32)
            words = [seen.words[i] for i in order]
            head = head_ids(words, heads)
            small = head.astype(id_type(heads))
            counts, where = counts[order], where[order]
            name = uuid.uuid4().hex
            rows = {c: [] for c in ("doc_id", "held", "ids", "chars", "subwords", "heads", "slice", "words", "counts")}

            def add(**values):
                for c, col in rows.items():
                    col.append(values.get(c))

            for doc_id, held, x, use, chars in zip(run["doc_id"], run["held"], ids, learn, run["text"].str.len()):
                x = rank[x]
                add(doc_id=None if pd.isna(doc_id) else int(doc_id), held=bool(held), ids=x.tobytes(),
                    **({"chars": int(chars), "subwords": small[x].tobytes()} if training and use else {}))
            add(heads=head.tobytes())
            edge = np.flatnonzero(np.append(True, where[1:] != where[:-1])) if n else []
            for a, b in zip(edge, np.append(edge[1:], n)):
                add(slice=int(where[a]), words=b" ".join(words[a:b]), counts=counts[a:b].astype(np.int32).tobytes(),
                    heads=head[a:b].tobytes())
            out = pd.DataFrame({c: pd.Series(v, dtype=object) for c, v in rows.items()})
            out.insert(0, "run", pd.Series([name] * len(out), dtype=object))
            yield out
    return make


RUN_SCHEMA = (f"run string, doc_id long, held boolean, ids binary, {SUBWORDS}, heads binary, slice int, words binary, "
              "counts binary")


def add_up(model, part: pd.DataFrame) -> pd.DataFrame:
    """Counts of a slice's words over all runs: each run's totals, and the class sums (run null)."""
    words, sizes = [], []
    for w in part["words"]:
        some = w.split(b" ")
        words += some
        sizes.append(len(some))
    code, _ = pd.factorize(np.array(words, object))
    count = np.concatenate([np.frombuffer(c, np.int32) for c in part["counts"]]).astype(np.int64)
    total = np.bincount(code, weights=count).astype(np.int64)
    first = np.unique(code, return_index=True)[1]
    kind = model.value.classes[np.concatenate([np.frombuffer(c, np.int32) for c in part["heads"]])[first]]
    n = np.bincount(kind, weights=total, minlength=CLASSES).astype(np.int64)
    v = np.bincount(kind, weights=total > 0, minlength=CLASSES).astype(np.int64)
    every, at = total[code], np.cumsum([0] + sizes)
    some = np.flatnonzero(v)
    return pd.DataFrame({
        "run": pd.Series(list(part["run"]) + [None] * len(some), dtype=object),
        "slice": [int(part["slice"].iloc[0])] * (len(part) + len(some)),
        "totals": pd.Series([every[a:b].tobytes() for a, b in zip(at[:-1], at[1:])] + [None] * len(some), dtype=object),
        "kind": [-1] * len(part) + [int(k) for k in some],
        "n": [0] * len(part) + [int(x) for x in n[some]], "v": [0] * len(part) + [int(x) for x in v[some]]})


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def scorer(model, end_count: int, class_n: np.ndarray, class_v: np.ndarray):
    """Function for a cogroup by run: texts and totals to scores."""
    def score(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        m = model.value
        heads = left["heads"].dropna()
        docs = left[left["ids"].notna()]
        head = np.frombuffer(heads.iloc[0], np.int32).astype(np.int64)
        right = right.sort_values("slice")
        count = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(t, np.int64) for t in right["totals"])])
        count = np.append(count, end_count)  # the end of a text is the last local id
        head = np.append(head, m.end)
        ids = [np.append(np.frombuffer(x, np.int32), len(head) - 1) for x in docs["ids"]]
        ends = np.cumsum([len(x) for x in ids])
        ids = np.concatenate(ids)
        start = ends - np.array([len(x) for x in np.split(ids, ends[:-1])])
        base = np.log10((count + 1) / (class_n.sum() + class_v.sum() + 1))
        kind = m.classes[head]
        inside = np.where(kind == 0, 0.0, np.log10((count + 1) / (class_n[kind] + class_v[kind] + 1)))
        log = class_log_probs(m, head[ids], ends) / np.log(10) + inside[ids]
        return pd.DataFrame({
            "doc_id": docs["doc_id"].to_numpy(), "held_out": docs["held"].to_numpy(bool), "n_tokens": ends - start,
            "n_known": np.add.reduceat((count > 0)[ids].astype(np.int64), start),
            "base_score": np.add.reduceat(base[ids], start), "score": np.add.reduceat(log, start)})
    return score


def lm_scores(docs: DataFrame, model: Attention | None = None, fold: tuple[int, int] = FOLD) -> DataFrame:
    """Every row as (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Counts are learnt from all texts whose crc32(doc_id as text) does not leave remainder fold[1]
    modulo fold[0]. Null and empty texts are one token, their end. Repeated rows count and score
    each; a row without doc_id is scored and not learnt from; an empty table gives an empty
    result; other columns are ignored.
    """
    spark = docs.sparkSession
    heads = spark.sparkContext.broadcast(model.heads if model else subword_heads())
    rest = remainder("doc_id", fold[0])
    rows = texts(docs).select("doc_id", "text", F.coalesce(rest == fold[1], F.lit(False)).alias("held"),
                              F.coalesce(rest != fold[1], F.lit(False)).alias("learn"))
    known = rows.agg(F.count(F.lit(1)), F.sum(F.col("learn").cast("long"))).first()
    n_docs, end_count = known[0], known[1] or 0
    slices = 16 + n_docs // DOCS_PER_SLICE
    made = staged(rows.mapInPandas(runs(heads, slices, model is None), RUN_SCHEMA), "lm-runs")
    model = model or train(docs, fold=fold, subwords=made.filter("subwords IS NOT NULL").select("chars", "subwords"))
    shared = spark.sparkContext.broadcast(model)  # subword ids x DIM floats
    totals = staged(made.filter("slice IS NOT NULL").select("run", "slice", "words", "counts", "heads")
                    .groupBy("slice").applyInPandas(
                        lambda part: add_up(shared, part), "run string, slice int, totals binary, kind int, n long, v long"), "lm-totals")
    class_n, class_v = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in totals.filter("kind >= 0").groupBy("kind").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        class_n[r.kind], class_v[r.kind] = r.n, r.v
    class_n[0], class_v[0] = end_count, int(end_count > 0)  # class 0 is the end of a text alone
    left = made.filter("slice IS NULL").select("run", "doc_id", "held", "ids", "heads").groupBy("run")
    right = totals.filter("run IS NOT NULL").select("run", "slice", "totals").groupBy("run")
    out = left.cogroup(right).applyInPandas(scorer(shared, end_count, class_n, class_v), SCORES)
    return out.withColumn("train_tokens", F.lit(int(class_n.sum())).cast("long"))


def op2_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    return lm_scores(table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
