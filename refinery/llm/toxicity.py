"""Toxicity scores: a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as three parts: its own embedding (words of the training sample),
the mean embedding of its hashed character trigrams, and the smoothed log-odds
of toxicity among the training documents that hold it.  Two gated recurrent
units read a window of words from both ends, attention weighs their states, and
a logistic layer scores the window.  All overlapping windows of a whole text
are scored; the document's score is a calibrated function of the highest.

Training takes a bounded sample of labelled rows (``SAMPLE_ROWS`` per class, of
at most ``SAMPLE_CHARS`` characters each) on the driver.  The label is the
document's, so each round trains on the window that the model holds for the
worst of each document, and on one other window of each clean document.
"""

from __future__ import annotations

import pickle
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: neighbours share half a window, so any 17 words in a row lie whole in some window
WINDOW, STRIDE = 32, 16
HIDDEN, WORD_DIM, CHAR_DIM, ATTENTION = 8, 8, 8, 8
CHAR_SLOTS = 4096
#: characters of a word; text without spaces is read in pieces of so many
PIECE = 64
#: bounds of the training sample
SAMPLE_ROWS = 3000
SAMPLE_CHARS = 20_000
#: words whose gate inputs a task remembers before it starts anew
REMEMBERED = 200_000
EDGES = "".join(chr(c) for c in range(33, 128) if not chr(c).isalnum())
ROUNDS, EPOCHS, BATCH, RATE = 3, 3, 128, 0.01


def words_of(text: str) -> list[str]:
    """Words in lower case; a longer one than ``PIECE`` characters is cut into consecutive pieces, each a word."""
    words = text.lower().split()
    if max(map(len, words), default=0) <= PIECE:
        return words
    return [w[i:i + PIECE] for w in words for i in range(0, len(w), PIECE)]


def bare(word: str) -> str:
    """Without ASCII punctuation at both ends (a word of punctuation only stays)."""
    return word.strip(EDGES) or word


def char_slots(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashed byte trigrams of all words in turn, number of each word's); a word is read as ``<word>``."""
    told = [w.encode() or b"_" for w in words]
    text = np.frombuffer(b"<" + b"><".join(told) + b">", np.uint8).astype(np.uint32)
    size = np.fromiter(map(len, told), np.int64, len(told))
    ends = np.cumsum(size + 2)
    inside = np.ones(len(text), bool)
    inside[ends - 1] = inside[ends - 2] = False
    mixed = (text[:-2] * np.uint32(65599) + text[1:-1]) * np.uint32(65599) + text[2:]
    mixed = (mixed * np.uint32(2654435761)) >> np.uint32(20)
    return mixed[inside[:-2]].astype(np.int64) % CHAR_SLOTS, size


def starts(n: int) -> list[int]:
    """Starts of the overlapping windows of ``n`` words; the last one ends with the text."""
    if n <= WINDOW:
        return [0]
    return [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-x))


class Network:
    """Parameters and passes; arrays are float32, gates and states are (time, batch, width)."""

    def __init__(self, vocab: dict[str, int], odds: np.ndarray, seed: int = 7):
        rng, d = np.random.default_rng(seed), WORD_DIM + CHAR_DIM + 1
        init = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.vocab, self.odds = vocab, odds.astype(np.float32)
        self.p = {"word": 0.1 * init(len(vocab) + 1, WORD_DIM), "char": 0.3 * init(CHAR_SLOTS, CHAR_DIM) * 8,
                  "att": init(2 * HIDDEN, ATTENTION), "att_b": np.zeros(ATTENTION, np.float32),
                  "att_v": init(ATTENTION), "out": init(2 * HIDDEN), "out_b": np.full(1, -1, np.float32)}
        for side in "fb":
            self.p |= {f"W{side}": init(d, 3 * HIDDEN), f"U{side}": init(HIDDEN, 3 * HIDDEN),
                       f"c{side}": np.zeros(3 * HIDDEN, np.float32)}
        self.scale = np.array([1.0, 0.0])

    def inputs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(vectors, word ids, flat character slots, offsets) of distinct bare words."""
        ids = np.array([self.vocab.get(w, 0) for w in words], np.int64)
        flat, size = char_slots(words)
        off = np.concatenate([[0], np.cumsum(size)[:-1]])
        chars = np.add.reduceat(self.p["char"][flat], off, axis=0) / size[:, None]
        x = np.concatenate([self.p["word"][ids], chars, self.odds[ids][:, None]], axis=1).astype(np.float32)
        return x, ids, flat, off

    def gates(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """What each word adds to the gates of either direction."""
        return {s: x @ self.p[f"W{s}"] + self.p[f"c{s}"] for s in "fb"}

    def _states(self, gate: np.ndarray, mask: np.ndarray | None, side: str, keep: list | None):
        steps, n, _ = gate.shape
        h, U = np.zeros((n, HIDDEN), np.float32), self.p[f"U{side}"]
        out = np.empty((steps, n, HIDDEN), np.float32)
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            g, r = gate[t], h @ U
            zr = _sigmoid(g[:, :2 * HIDDEN] + r[:, :2 * HIDDEN])
            z, reset, back = zr[:, :HIDDEN], zr[:, HIDDEN:], r[:, 2 * HIDDEN:]
            new = np.tanh(g[:, 2 * HIDDEN:] + reset * back)
            nxt = new + z * (h - new)
            if mask is not None:
                nxt = np.where(mask[:, t, None], nxt, h)
            if keep is not None:
                keep.append((t, h, z, reset, back, new))
            h = out[t] = nxt
        return out

    def logits(self, gate: dict[str, np.ndarray], mask: np.ndarray | None, tape: dict | None = None) -> np.ndarray:
        """Score of each window before the logistic function; ``gate[side]`` is (time, batch, 3 * hidden)."""
        keep = {s: [] if tape is not None else None for s in "fb"}
        hs = np.concatenate([self._states(gate[s], mask, s, keep[s]) for s in "fb"], axis=2)
        a = np.tanh(hs @ self.p["att"] + self.p["att_b"])
        e = a @ self.p["att_v"]
        if mask is not None:
            e = np.where(mask.T, e, -30)
        w = np.exp(e - e.max(axis=0))
        w /= w.sum(axis=0)
        pooled = (hs * w[:, :, None]).sum(axis=0)
        if mask is not None:
            pooled *= mask.any(axis=1)[:, None]
        if tape is not None:
            tape |= {"keep": keep, "hs": hs, "a": a, "w": w, "pooled": pooled, "mask": mask}
        return pooled @ self.p["out"] + self.p["out_b"][0]

    def gradients(self, tape: dict, gate: dict[str, np.ndarray], dlogit: np.ndarray) -> tuple[dict, dict]:
        """(gradients of the parameters above the inputs, gradients of the gates) by back-propagation through time."""
        p, g = self.p, {}
        hs, a, w, pooled, mask = (tape[k] for k in ("hs", "a", "w", "pooled", "mask"))
        g["out"], g["out_b"] = pooled.T @ dlogit, np.array([dlogit.sum()], np.float32)
        dpool = dlogit[:, None] * p["out"]
        dh = w[:, :, None] * dpool
        dw = (hs * dpool).sum(axis=2)
        de = w * (dw - (w * dw).sum(axis=0))
        if mask is not None:
            de = np.where(mask.T, de, 0)
        g["att_v"] = np.einsum("tna,tn->a", a, de)
        da = de[:, :, None] * p["att_v"] * (1 - a * a)
        g["att"], g["att_b"] = np.einsum("tnh,tna->ha", hs, da), da.sum(axis=(0, 1))
        dh = dh + da @ p["att"].T
        dgate = {}
        for k, s in enumerate("fb"):
            U, dU = p[f"U{s}"], np.zeros_like(p[f"U{s}"])
            dg, carry = np.zeros_like(gate[s]), np.zeros((len(dlogit), HIDDEN), np.float32)
            for t, h, z, reset, back, new in reversed(tape["keep"][s]):
                d = dh[t][:, k * HIDDEN:(k + 1) * HIDDEN] + carry
                live = d if mask is None else np.where(mask[:, t, None], d, 0)
                dnew = live * (1 - z) * (1 - new * new)
                dz = live * (h - new) * z * (1 - z)
                dr = dnew * back * reset * (1 - reset)
                dg[t] = np.concatenate([dz, dr, dnew], axis=1)
                drec = np.concatenate([dz, dr, dnew * reset], axis=1)
                dU += h.T @ drec
                carry = live * z + drec @ U.T + (d - live)
            g[f"U{s}"], dgate[s] = dU, dg
        return g, dgate


def _windows(net: Network, texts: list[str], memory: dict, rows: dict[str, list[np.ndarray]]):
    """Ids of the windows of every text into the remembered gate rows, their masks, and each window's text."""
    found = [words_of(t) for t in texts]
    new = list(dict.fromkeys(w for ws in found for w in ws if w not in memory))
    if len(memory) + len(new) > REMEMBERED:
        memory.clear()
        for s in "fb":
            rows[s] = [rows[s][0][:1]]
        new = list(dict.fromkeys(w for ws in found for w in ws))
    if new:
        gates = net.gates(net.inputs([bare(w) for w in new])[0])
        memory.update(zip(new, range(len(memory) + 1, len(memory) + 1 + len(new))))
        for s in "fb":
            rows[s].append(gates[s])
    full, short, full_of, short_of = [], [], [], []
    for i, ws in enumerate(found):
        ids = np.fromiter(map(memory.__getitem__, ws), np.int32, len(ws))
        if len(ids) >= WINDOW:
            at = np.array(starts(len(ids)))
            full.append(ids[at[:, None] + np.arange(WINDOW)])
            full_of += [i] * len(at)
        else:
            short.append(np.concatenate([ids, np.zeros(WINDOW - len(ids), np.int32)])[None])
            short_of.append(i)
    return (np.concatenate(full) if full else None, full_of, np.concatenate(short) if short else None, short_of)


def _best(net: Network, texts: list[str], memory: dict, rows: dict, step: int = 1024):
    """(highest logit, number of its window) of every text."""
    best, which = np.full(len(texts), -np.inf), np.zeros(len(texts), np.int64)
    full, full_of, short, short_of = _windows(net, texts, memory, rows)
    for s in "fb":
        rows[s] = [np.concatenate(rows[s])] if len(rows[s]) > 1 else rows[s]
    for ids, of in ((full, full_of), (short, short_of)):
        if ids is None:
            continue
        of = np.array(of)
        score = np.concatenate([net.logits({s: rows[s][0][ids[at:at + step].T] for s in "fb"},
                                           ids[at:at + step] > 0 if ids is short else None)
                                for at in range(0, len(ids), step)])
        order = np.lexsort((-np.arange(len(of)), score, of))
        last = np.flatnonzero(np.append(of[order][1:] != of[order][:-1], True))
        top = order[last]
        first = np.searchsorted(of, of[top])
        best[of[top]], which[of[top]] = score[top], top - first
    return best, which


def fresh_rows() -> dict[str, list[np.ndarray]]:
    """Gate rows of a task: row 0 stands for padding."""
    return {s: [np.zeros((1, 3 * HIDDEN), np.float32)] for s in "fb"}


def scores(net: Network, texts: list[str], memory: dict, rows: dict) -> np.ndarray:
    """Calibrated score of each text (an empty one counts as one window without words)."""
    return _sigmoid(_best(net, texts, memory, rows)[0] * net.scale[0] + net.scale[1])


def _log_odds(texts: list[list[str]], labels: np.ndarray, prior_weight: float = 10.0):
    """Vocabulary (words in two documents or more) and smoothed log-odds of toxicity relative to the sample's."""
    share = min(max(float(labels.mean()), 0.01), 0.99)
    seen = {0: Counter(), 1: Counter()}
    for ws, y in zip(texts, labels):
        seen[int(y)].update({bare(w) for w in ws})
    words = sorted(w for w in seen[0] | seen[1] if seen[0][w] + seen[1][w] > 1)
    bad, good = (np.array([seen[y][w] for w in words], float) for y in (1, 0))
    odds = np.log((bad + prior_weight * share) / (good + prior_weight * (1 - share))) - np.log(share / (1 - share))
    return {w: i + 1 for i, w in enumerate(words)}, np.concatenate([[0.0], odds])


def train(texts: list[str], labels: list[int], seed: int = 7) -> Network:
    """Fit a network to document labels; the same rows give the same network."""
    y, found = np.array(labels, int), [words_of(t) for t in texts]
    if not len(y) or y.min() == y.max():  # nothing to tell apart: a constant score
        net = Network({}, np.zeros(1), seed)
        net.scale = np.array([0.0, -4.0 if not len(y) or not y.max() else 4.0])
        return net
    vocab, odds = _log_odds(found, y)
    net, rng = Network(vocab, odds, seed), np.random.default_rng(seed)
    moments: dict[str, list[np.ndarray]] = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    count, share = 0, float(y.mean())
    chosen = []
    for ws in found:  # before the first round: the window of the highest log-odds
        o = np.array([odds[vocab.get(bare(w), 0)] for w in ws] or [0.0])
        chosen.append(max(starts(len(ws)), key=lambda a: o[a:a + WINDOW].max(initial=0)))
    for _ in range(ROUNDS):
        rows = [(found[i][a:a + WINDOW], y[i]) for i, a in enumerate(chosen)]
        other = [(found[i], int(rng.choice(starts(len(found[i]))))) for i in np.flatnonzero(y == 0)]
        rows += [(ws[a:a + WINDOW], 0) for ws, a in other]
        for _ in range(EPOCHS):
            for part in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // BATCH)):
                count += 1
                _step(net, [rows[i] for i in part], moments, count)
        best, which = _all_best(net, texts)
        chosen = [starts(len(ws))[int(k)] for ws, k in zip(found, which)]
    net.scale = _calibrate(best, y)
    return net


def _all_best(net: Network, texts: list[str]):
    memory, rows, parts = {}, fresh_rows(), []
    for at in range(0, len(texts), 512):
        parts.append(_best(net, texts[at:at + 512], memory, rows))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _step(net: Network, rows: list[tuple[list[str], int]], moments: dict, count: int) -> None:
    words = [[bare(w) for w in ws] for ws, _ in rows]
    names = {w: i for i, w in enumerate(dict.fromkeys(w for ws in words for w in ws))} or {"": 0}
    x, ids, flat, off = net.inputs(list(names))
    at = np.array([[names[w] for w in ws] + [0] * (WINDOW - len(ws)) for ws in words])
    mask = np.arange(WINDOW) < np.array([len(ws) for ws in words])[:, None]
    base, tape = net.gates(x), {}
    gate = {s: base[s][at.T] for s in "fb"}
    y = np.array([r[1] for r in rows], np.float32)
    p = _sigmoid(net.logits(gate, mask, tape))
    grads, dgate = net.gradients(tape, gate, ((p - y) / len(y)).astype(np.float32))
    dx = np.zeros_like(x)
    for s in "fb":
        d = np.where(mask.T[:, :, None], dgate[s], 0)
        per = np.zeros((len(x), 3 * HIDDEN), np.float32)
        np.add.at(per, at.T.ravel(), d.reshape(-1, 3 * HIDDEN))
        grads[f"W{s}"], grads[f"c{s}"] = x.T @ per, per.sum(axis=0)
        dx += per @ net.p[f"W{s}"].T
    grads["word"] = np.zeros_like(net.p["word"])
    np.add.at(grads["word"], ids, dx[:, :WORD_DIM])
    size = np.diff(np.append(off, len(flat)))
    grads["char"] = np.zeros_like(net.p["char"])
    np.add.at(grads["char"], flat, np.repeat(dx[:, WORD_DIM:WORD_DIM + CHAR_DIM] / size[:, None], size, axis=0))
    for k, g in grads.items():
        m, v = moments[k]
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        net.p[k] -= (RATE * (m / (1 - 0.9 ** count)) / (np.sqrt(v / (1 - 0.99 ** count)) + 1e-6)).astype(np.float32)


def _calibrate(logit: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope and offset of a logistic regression of the label on the logit (damped Newton steps)."""
    x = np.stack([np.clip(logit, -20, 20), np.ones(len(y))], axis=1)
    b = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ b)
        h = x.T @ (x * (p * (1 - p) + 1e-6)[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (y - p) - 1e-3 * (b - [1.0, 0.0]))
        b = b + step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
    return np.array([max(b[0], 1e-3), b[1]])


def bucket(doc_id):
    """crc32 of the id as text, modulo 5 (a null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS):
    """(texts, labels): distinct texts of at most ``rows`` labelled documents of each class, by a hash of the id.

    Only rows whose :func:`bucket` is not 0 are read as labels.  The chosen ids are at most ``2 * rows``, so
    the documents are joined to them without a shuffle.  A text with both labels counts as toxic.
    """
    known = labels.where((bucket(F.col("doc_id")) != 0) & F.col("toxic").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    size = docs.where((F.length("text") > 0) & (F.length("text") <= chars)).groupBy("doc_id").agg(F.lit(1).alias("_x")).drop("_x")
    pick = known.join(size, "doc_id").withColumn("_h", F.xxhash64("doc_id"))
    ids = [r for y in (0, 1) for r in pick.where(F.col("toxic") == y).orderBy("_h", "doc_id").limit(rows).collect()]
    chosen = docs.sparkSession.createDataFrame([(r["doc_id"], int(r["toxic"])) for r in ids], "_id bigint, toxic int")
    found = (docs.select(F.col("doc_id").alias("_id"), "text").where((F.length("text") > 0) & (F.length("text") <= chars))
             .join(F.broadcast(chosen), "_id").collect())
    by: dict[str, int] = {}
    for r in sorted(found, key=lambda r: (r["_id"], r["text"])):
        by[r["text"]] = max(by.get(r["text"], 0), r["toxic"])
    return list(by), list(by.values())


@lru_cache(maxsize=1)
def _loaded(blob: bytes) -> Network:
    return pickle.loads(blob)


def score(df: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``score`` (0 to 1) of every whole text; a null or empty text is scored as having no words.

    The network, of a size set by the training sample's bounds, is broadcast.  Null ids and repeated rows are
    kept row by row; an empty table gives an empty one; other columns are ignored.
    """
    sent = df.sparkSession.sparkContext.broadcast(pickle.dumps(net))
    source = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        model, memory, rows = _loaded(sent.value), {}, fresh_rows()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = scores(model, part.column(1).to_pylist(), memory, rows)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.float64())], ["id", "score"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, score double").select(F.col("id").alias(id_col), "score")


def keep_clean(df: DataFrame, net: Network, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of ``df`` whose whole text scores below ``limit``, all columns as they are, without a shuffle."""
    sent = df.sparkSession.sparkContext.broadcast(pickle.dumps(net))
    at_text = df.columns.index(text_col)

    def run(batches):
        model, memory, rows = _loaded(sent.value), {}, fresh_rows()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = scores(model, [t or "" for t in part.column(at_text).to_pylist()], memory, rows)
                yield part.filter(pa.array(found < limit))

    return df.mapInArrow(run, df.schema)
