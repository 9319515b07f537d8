"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters the network as a learned word vector (frequent words of the sample) beside the scaled sum of learned
vectors of its hashed character 3- and 4-grams, so disguised and unseen forms still mean something.  Both directions
read a window of words, attention pools the states, and a logistic unit scores the window.  A text is cut into
overlapping windows that cover it whole; its score is that of the worst window, calibrated on documents.

Training takes a bounded sample of labelled rows (``per_class`` of each label, smallest hashes first) whose crc32 of
the id leaves another remainder than the held-out one; texts of more than ``MOST_CHARS`` characters are scored but not
learnt from, and an id counts once, so the sample is bounded in rows and bytes.  Documents carry labels, windows do
not: each pass trains on the worst window of every document and on random windows of clean ones.  Networks are kept by
a hash of their sample, so that the same sample is not learnt twice in a session.

Scoring reads each document once, in the stage that scans it, without a shuffle.  The products of a word's vectors
with the input weights are kept per worker, up to a bound, so that a step costs a look-up and one small product.

Defined results: null and empty texts score 0; a null id is not held out and never learnt from; labels that repeat an
id count once, the larger one; without labels of both kinds every other text scores 0.5; an empty table gives an
empty result; only the text is an input of the score.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.storage import bounded_batches

WINDOW, STRIDE = 32, 24
#: Labelled documents of each label to learn from, at most.
PER_CLASS = 1500
#: Characters of a text to learn from, at most; 2 * PER_CLASS such texts are what reaches the driver.
MOST_CHARS = 60_000
THRESHOLD = 0.7
WORD_DIM, CHAR_DIM, HIDDEN, GRAM_BUCKETS, MOST_WORDS = 8, 8, 8, 1 << 14, 30_000
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_ROWS_KEPT = 200_000


def words(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


def grams(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all 3- and 4-grams of ``<word>``, word after word, and how many each word has."""
    flat = np.frombuffer(b"".join(b"<" + w + b">" for w in found), np.uint8).astype(np.uint32)
    lengths = np.fromiter((len(w) + 2 for w in found), np.int64, len(found))
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(found)), lengths)
    left = ends[owner] - np.arange(len(flat))  # bytes from here to the word's end
    padded = np.concatenate([flat, np.zeros(4, np.uint32)])
    h = np.zeros(len(flat), np.uint32)
    buckets, owners = [], []
    for n in range(4):
        h = h * np.uint32(0x01000193) + padded[n : n + len(flat)] + np.uint32(1)
        if n >= 2:
            ok = left > n
            mixed = h[ok] * np.uint32(0x9E3779B1)
            buckets.append((mixed >> np.uint32(18)).astype(np.int64))
            owners.append(owner[ok])
    bucket, owner = np.concatenate(buckets), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.bincount(owner, minlength=len(found))


def windows(n: int, window: int = WINDOW, stride: int = STRIDE) -> np.ndarray:
    """First words of the windows of a text of n words; the last one ends with the text."""
    return np.array([0]) if n <= window else np.append(np.arange(0, n - window, stride), n - window)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.clip(-x, -30, 30)))


@dataclass
class Network:
    """Parameters by name: ``word`` (row 0: padding or unknown), ``char``, and for both directions Wx, Wh, b."""

    vocabulary: dict[bytes, int]
    p: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None
    _moments: dict = field(default_factory=dict, repr=False)

    def vectors(self, found: list[bytes]) -> np.ndarray:
        """One input vector for each word."""
        rows = np.fromiter((self.vocabulary.get(w, 0) for w in found), np.int64, len(found))
        buckets, counts = grams(found)
        starts = np.cumsum(counts) - counts
        summed = np.add.reduceat(self.p["char"][buckets], starts) if len(found) else np.zeros((0, CHAR_DIM), np.float32)
        return np.concatenate([self.p["word"][rows], summed / np.sqrt(counts)[:, None]], axis=1).astype(np.float32)

    def project(self, x: np.ndarray) -> np.ndarray:
        """(n, 2, 3 * HIDDEN): the input side of all gates in both directions."""
        return np.stack([x @ self.p["Wx"][d] + self.p["b"][d] for d in (0, 1)], axis=-2)

    def states(self, xp: np.ndarray) -> tuple[np.ndarray, list]:
        """States (T, B, 2 * HIDDEN) for xp (T, B, 2, 3 * HIDDEN), and what the way back needs."""
        steps, batch = xp.shape[:2]
        out, trace = np.empty((steps, batch, 2 * HIDDEN), np.float32), []
        for d in (0, 1):
            h = np.zeros((batch, HIDDEN), np.float32)
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                x, u = xp[t, :, d], h @ self.p["Wh"][d]
                gates = _sigmoid(x[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                n = 2 * _sigmoid(2 * (x[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])) - 1
                trace.append((d, t, h, z, r, n, u))
                h = n + z * (h - n)
                out[t, :, d * HIDDEN : (d + 1) * HIDDEN] = h
        return out, trace

    def pool(self, states: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logit, attention (T, B) and context; ``real`` (T, B) marks words that are not padding."""
        e = np.where(real, states @ self.p["v"], -1e9)
        a = np.exp(e - e.max(axis=0))
        a /= a.sum(axis=0)
        context = (states * a[:, :, None]).sum(axis=0)
        return context @ self.p["w"] + self.p["c"], a, context

    def logits(self, table: np.ndarray, ids: np.ndarray, block: int = 2048) -> np.ndarray:
        """Logits of windows (n, WINDOW) of row numbers into ``table`` (rows, 2, 3 * HIDDEN); row 0 is padding."""
        out = np.empty(len(ids), np.float32)
        turned = np.ascontiguousarray(ids.T)
        p, half = self.p, 2 * HIDDEN
        both = np.ascontiguousarray(table.transpose(1, 0, 2))
        for i in range(0, len(ids), block):
            part = turned[:, i : i + block]
            steps, n_rows = part.shape
            states = np.empty((steps, n_rows, 2 * HIDDEN), np.float32)
            for d in (0, 1):
                h = np.zeros((n_rows, HIDDEN), np.float32)
                for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                    x = both[d].take(part[t], axis=0)
                    u = h @ p["Wh"][d]
                    gates = x[:, :half] + u[:, :half]
                    np.negative(gates, out=gates)
                    np.exp(gates, out=gates)
                    gates += 1
                    np.reciprocal(gates, out=gates)
                    n = x[:, half:] + gates[:, HIDDEN:] * u[:, half:]
                    n *= -2
                    np.exp(n, out=n)
                    n += 1
                    np.reciprocal(n, out=n)
                    n *= 2
                    n -= 1
                    h = h - n
                    h *= gates[:, :HIDDEN]
                    h += n
                    states[t, :, d * HIDDEN : (d + 1) * HIDDEN] = h
            out[i : i + block] = self.pool(states, part != 0)[0]
        return out

    def gradients(self, ids: np.ndarray, found: list[bytes], labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients on windows (B, WINDOW) of numbers 1.. into ``found`` (0: padding)."""
        p = self.p
        inputs = np.concatenate([np.zeros((1, WORD_DIM + CHAR_DIM), np.float32), self.vectors(found)])
        turned = ids.T
        x = inputs[turned]
        xp = np.stack([x @ p["Wx"][d] + p["b"][d] for d in (0, 1)], axis=2)
        states, trace = self.states(xp)
        logit, a, context = self.pool(states, turned != 0)
        prob = _sigmoid(logit)
        dl = ((prob - labels) / len(labels)).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["w"], g["c"] = context.T @ dl, dl.sum()
        dc = dl[:, None] * p["w"]
        da = (states * dc).sum(axis=2)
        de = a * (da - (a * da).sum(axis=0))
        ds = a[:, :, None] * dc + de[:, :, None] * p["v"]
        g["v"] = np.tensordot(de, states, ([0, 1], [0, 1]))
        dx = np.zeros_like(x)
        carry = [np.zeros((ids.shape[0], HIDDEN), np.float32) for _ in (0, 1)]
        for d, t, h, z, r, n, u in reversed(trace):
            dh = carry[d] + ds[t, :, d * HIDDEN : (d + 1) * HIDDEN]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * u[:, 2 * HIDDEN :] * r * (1 - r)
            du = np.concatenate([dz, dr, dn * r], axis=1)
            dg = np.concatenate([dz, dr, dn], axis=1)
            carry[d] = dh * z + du @ p["Wh"][d].T
            g["Wh"][d] += h.T @ du
            g["Wx"][d] += x[t].T @ dg
            g["b"][d] += dg.sum(axis=0)
            dx[t] += dg @ p["Wx"][d].T
        dv = np.zeros_like(inputs)
        np.add.at(dv, turned.ravel(), dx.reshape(-1, dx.shape[-1]))
        rows = np.fromiter((self.vocabulary.get(w, 0) for w in found), np.int64, len(found))
        np.add.at(g["word"], rows, dv[1:, :WORD_DIM])
        g["word"][0] = 0
        buckets, counts = grams(found)
        np.add.at(g["char"], buckets, np.repeat(dv[1:, WORD_DIM:] / np.sqrt(counts)[:, None], counts, axis=0))
        return float(-np.mean(np.where(labels > 0, np.log(prob + 1e-7), np.log(1 - prob + 1e-7)))), g

    def step(self, ids: np.ndarray, found: list[bytes], labels: np.ndarray, rate: float) -> float:
        """One step of Adam; returns the loss before it."""
        p = self.p
        loss, g = self.gradients(ids, found, labels)
        k = self._moments["k"] = self._moments.get("k", 0) + 1
        for name, grad in g.items():
            m, s = self._moments.setdefault(name, (np.zeros_like(p[name]), np.zeros_like(p[name])))
            m, s = 0.9 * m + 0.1 * grad, 0.999 * s + 0.001 * grad * grad
            self._moments[name] = m, s
            p[name] = (p[name] - rate * (m / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.999**k)) + 1e-6)).astype(np.float32)
        return loss


def _log_odds(bad: Counter, good: Counter, n_bad: int, n_good: int, key) -> float:
    ratio = (bad[key] + 0.5) / (n_bad + 1) / ((good[key] + 0.5) / (n_good + 1))
    return float(np.clip(np.log(ratio), -1.0, 4.0)) if bad[key] + good[key] >= 3 else 0.0


def begin(tokens: list[list[bytes]], labels: np.ndarray, seed: int) -> Network:
    """A network whose first word and character coordinates are log odds of the sample; all else is random."""
    rng = np.random.default_rng(seed)
    seen, gram_seen, n = (Counter(), Counter()), (Counter(), Counter()), Counter(labels.tolist())
    for found, label in zip(tokens, labels):
        distinct = sorted(set(found))
        seen[label].update(distinct)
        if distinct:
            gram_seen[label].update(np.unique(grams(distinct)[0]).tolist())
    total = seen[0] + seen[1]
    frequent = sorted((w for w, c in total.items() if c >= 3), key=lambda w: (-total[w], w))[:MOST_WORDS]
    word = rng.normal(0, 0.1, (len(frequent) + 1, WORD_DIM)).astype(np.float32)
    word[1:, 0] = [_log_odds(seen[1], seen[0], n[1], n[0], w) for w in frequent]
    word[0] = 0
    char = rng.normal(0, 0.05, (GRAM_BUCKETS, CHAR_DIM)).astype(np.float32)
    char[:, 0] = [_log_odds(gram_seen[1], gram_seen[0], n[1], n[0], b) for b in range(GRAM_BUCKETS)]
    width = WORD_DIM + CHAR_DIM
    p = {
        "word": word, "char": char,
        "Wx": rng.normal(0, width**-0.5, (2, width, 3 * HIDDEN)).astype(np.float32), "Wh": rng.normal(0, HIDDEN**-0.5, (2, HIDDEN, 3 * HIDDEN)).astype(np.float32),
        "b": np.zeros((2, 3 * HIDDEN), np.float32), "v": rng.normal(0, 0.3, 2 * HIDDEN).astype(np.float32),
        "w": rng.normal(0, 0.3, 2 * HIDDEN).astype(np.float32), "c": np.float32(-1.0),
    }
    return Network({w: i + 1 for i, w in enumerate(frequent)}, p)


class Corpus:
    """Texts as numbers of distinct words (from 1), padded to a window, and the windows of each."""

    def __init__(self, tokens: list[list[bytes]]):
        numbers: dict[bytes, int] = {}
        flat, starts, self.first, at = [], [], [], 0
        for found in tokens:
            ids = [numbers.setdefault(w, len(numbers) + 1) for w in found]
            self.first.append(len(starts))
            starts.extend((at + windows(len(ids))).tolist())
            ids += [0] * (WINDOW - len(ids))
            flat.extend(ids)
            at += len(ids)
        self.found = list(numbers)
        self.ids = np.array(flat, np.int64)[np.array(starts, np.int64)[:, None] + np.arange(WINDOW)] if starts else np.zeros((0, WINDOW), np.int64)

    def logits(self, net: Network) -> np.ndarray:
        table = np.concatenate([net.project(np.zeros((1, WORD_DIM + CHAR_DIM), np.float32)), net.project(net.vectors(self.found))])
        return net.logits(table, self.ids)

    def batch(self, rows: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        used, ids = np.unique(self.ids[rows], return_inverse=True)
        if used[0] != 0:
            used, ids = np.append(0, used), ids + 1
        return ids.reshape(len(rows), WINDOW), [self.found[i - 1] for i in used[1:]]


def train(texts: list[str], labels: list[int], seed: int = 7, passes: int = 6, batch: int = 96, batches: int = 60, rate: float = 0.01) -> Network:
    """Fit the network; a seventh of the documents only calibrates the score."""
    kept = [(words(t), int(y)) for t, y in zip(texts, labels)]
    kept = [(found, y) for found, y in kept if found]
    y = np.array([label for _, label in kept], np.int64)
    if len(set(y.tolist())) < 2:
        net = begin([], np.zeros(0, np.int64), seed)
        net.constant = 0.5
        return net
    rng = np.random.default_rng(seed)
    calibrates = (np.arange(len(kept)) % 7 == 3) if min(np.bincount(y)) >= 40 else np.zeros(len(kept), bool)
    learns = np.flatnonzero(~calibrates)
    net = begin([kept[i][0] for i in learns], y[learns], seed)
    corpus, truth = Corpus([kept[i][0] for i in learns]), y[learns]
    bad, good = np.flatnonzero(truth == 1), np.flatnonzero(truth == 0)
    first, last = np.array(corpus.first), np.append(corpus.first[1:], len(corpus.ids))
    # Before anything is learnt, the worst window is the one with the largest log odds.
    odds = np.concatenate([[0.0], net.vectors(corpus.found)[:, [0, WORD_DIM]].sum(axis=1)])
    score = np.maximum(odds[corpus.ids], 0).sum(axis=1)
    for n in range(passes):
        worst = np.array([a + int(np.argmax(score[a:b])) for a, b in zip(first, last)])
        for _ in range(batches):
            b, g = rng.choice(bad, batch // 3), rng.choice(good, batch // 3)
            other = rng.choice(good, batch // 3)
            rows = np.concatenate([worst[b], worst[g], (first[other] + rng.integers(0, last[other] - first[other]))])
            ids, found = corpus.batch(rows)
            net.step(ids, found, np.concatenate([np.ones(len(b)), np.zeros(len(g) + len(other))]).astype(np.float32), rate * 0.6**n)
        score = corpus.logits(net)
    measured = np.flatnonzero(calibrates) if calibrates.any() else learns
    held = Corpus([kept[i][0] for i in measured])
    _calibrate(net, np.maximum.reduceat(held.logits(net), held.first), y[measured])
    return net


def _calibrate(net: Network, x: np.ndarray, y: np.ndarray) -> None:
    """Logistic regression of the label on the worst logit, lightly regularised."""
    slope, shift = 1.0, 0.0
    for _ in range(500):
        d = _sigmoid(slope * x + shift) - y
        slope -= 0.2 * (float(np.mean(d * x)) + 0.005 * (slope - 1.0))
        shift -= 0.2 * float(np.mean(d))
    net.slope, net.shift = max(0.1, slope), shift


class _Rows(dict):
    """Row numbers of words; new words wait to be projected."""

    def __init__(self):
        super().__init__()
        self.waiting: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.waiting.append(word)
        number = self[word] = len(self) + 1
        return number


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net: Network = shared.value
        blank = net.project(np.zeros((1, WORD_DIM + CHAR_DIM), np.float32))
        rows, table, used = _Rows(), np.empty((4096, 2, 3 * HIDDEN), np.float32), 1
        table[0] = blank[0]
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            scores = np.zeros(len(texts))
            if net.constant is not None:
                scores[[i for i, t in enumerate(texts) if words(t)]] = net.constant
            else:
                if len(rows) > _ROWS_KEPT:
                    rows, used = _Rows(), 1
                flat, starts, full, at = [], [], [], 0
                for i, text in enumerate(texts):
                    found = words(text)
                    if not found:
                        continue
                    ids = np.fromiter(map(rows.__getitem__, found), np.int64, len(found))
                    if len(ids) < WINDOW:
                        ids = np.concatenate([ids, np.zeros(WINDOW - len(ids), np.int64)])
                    full.append(i)
                    starts.append(at + windows(len(found)))
                    flat.append(ids)
                    at += len(ids)
                if rows.waiting:
                    need = used + len(rows.waiting)
                    if need > len(table):
                        table = np.concatenate([table[:used], np.empty((max(need, 2 * len(table)) - used, 2, 3 * HIDDEN), np.float32)])
                    for i in range(0, len(rows.waiting), 20_000):
                        part = rows.waiting[i : i + 20_000]
                        table[used : used + len(part)] = net.project(net.vectors(part))
                        used += len(part)
                    rows.waiting.clear()
                if full:
                    ids = np.concatenate(flat)[np.concatenate(starts)[:, None] + np.arange(WINDOW)]
                    worst = np.maximum.reduceat(net.logits(table[:used], ids), np.cumsum([0, *map(len, starts[:-1])]))
                    scores[full] = _sigmoid(net.slope * worst.astype(np.float64) + net.shift)
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in batch.schema.names if n != "_text"], pa.array(scores)], names=[*[n for n in batch.schema.names if n != "_text"], "score"])

    return run


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_class: int) -> tuple[list[str], list[int]]:
    """At most ``per_class`` texts of each label, chosen by hash among the rows that may be learnt from."""
    known = labels.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & ~held_out(id_col)).groupBy(F.col(f"`{id_col}`").alias("_id")).agg(F.max(F.col(f"`{label_col}`").cast("int")).alias("_y"))
    picked = [known.where(F.col("_y") == y).orderBy(F.xxhash64("_id", F.lit(5)), "_id").limit(per_class) for y in (0, 1)]
    chosen = F.broadcast(picked[0].union(picked[1]))  # 2 * per_class pairs of numbers at most
    short = docs.where(F.length(f"`{text_col}`") <= MOST_CHARS).select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    rows = short.join(chosen, "_id").groupBy("_id").agg(F.max("_text").alias("_text"), F.max("_y").alias("_y")).collect()
    rows.sort(key=lambda r: r["_id"])
    return [r["_text"] for r in rows], [r["_y"] for r in rows]


_networks: dict[bytes, Network] = {}


def trained(texts: list[str], labels: list[int]) -> Network:
    """The network of a sample; the latest four are kept."""
    h = hashlib.sha256()
    for text, label in zip(texts, labels):
        h.update(f"{label}:{len(text)}:".encode() + text.encode("utf-8", "surrogatepass"))
    key = h.digest()
    if key not in _networks:
        while len(_networks) >= 4:
            del _networks[next(iter(_networks))]
        _networks[key] = train(texts, labels)
        _networks[key]._moments.clear()
    return _networks[key]


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", keep: list[str] | None = None, per_class: int = PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns (the id by default), ``held_out``, ``score`` and ``predicted`` for every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    net = trained(*sample(docs, labels, id_col, text_col, label_col, per_class))
    kept = [c for c in ([id_col] if keep is None else keep) if c not in ("score", "held_out", "predicted")]
    picked = docs.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(kept)], held_out(id_col).alias("held_out"), F.col(f"`{text_col}`").alias("_text"))
    scored = picked.mapInArrow(_scorer(spark.sparkContext.broadcast(net)), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in picked.schema if f.name != "_text") + ", score double")
    return scored.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(kept)], "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
