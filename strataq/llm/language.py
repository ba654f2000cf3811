"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

Texts are cut into segments of bytes. Two gated recurrent layers read a segment forwards and
backwards, every position gets a distribution over languages from both states, and a document's
probabilities are the mean over all its positions. Trained by backpropagation through time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_share, lean

SEGMENT, HIDDEN, BLOCK = 128, 8, 1024
#: Training documents a language, at most about, and the segments taken from each.
MOST_DOCUMENTS, PARTS, TRAIN_SEGMENT = 1500, 2, 64
UNKNOWN = "und"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class BiGRU:
    """Parameters by direction (0 forwards, 1 backwards): inputs by byte, recurrent gates, candidate; output."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 3):
        rng, h, k = np.random.default_rng(seed), hidden, len(languages)
        self.languages, self.h = languages, hidden
        self.p = [rng.normal(0, 0.3, (2, 256, 3 * h)), rng.normal(0, h**-0.5, (2, h, 2 * h)), rng.normal(0, h**-0.5, (2, h, h)), rng.normal(0, 0.3, (2, h, k)), np.zeros(k)]
        self.p = [x.astype(np.float32) for x in self.p]

    def states(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """(T, 2, B, h) states of x (B, T bytes); those of direction 1 in the order it reads."""
        inputs, gates, candidate = self.p[:3]
        n, length = x.shape
        h = self.h
        state = np.zeros((2, n, h), np.float32)
        out = np.empty((length, 2, n, h), np.float32)
        both = np.stack([x.T, x.T[::-1]])
        for t in range(length):
            a = np.stack([inputs[0][both[0, t]], inputs[1][both[1, t]]])
            zr = np.matmul(state, gates)
            zr += a[:, :, : 2 * h]
            zr *= 0.5
            np.tanh(zr, out=zr)
            zr += 1
            zr *= 0.5
            z, r = zr[:, :, :h], zr[:, :, h:]
            c = np.matmul(r * state, candidate)
            c += a[:, :, 2 * h :]
            np.tanh(c, out=c)
            if keep is not None:
                keep.append((state, z, r, c))
            state = state + z * (c - state)
            out[t] = state
        return out

    def positions(self, states: np.ndarray) -> np.ndarray:
        """(T, B, languages): the distribution of every position."""
        y = np.matmul(states[:, 0], self.p[3][0])
        y += np.matmul(states[::-1, 1], self.p[3][1])
        y += self.p[4]
        y -= y.max(axis=2, keepdims=True)
        np.exp(y, out=y)
        y /= y.sum(axis=2, keepdims=True)
        return y

    def gradient(self, x: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy over positions, and its gradient through all of time."""
        inputs, gates, candidate, last, _ = self.p
        kept: list = []
        s = self.states(x, kept)
        y = self.positions(s)
        n, length = x.shape
        h, rows = self.h, np.arange(n)
        loss = float(-np.log(y[:, rows, label] + 1e-9).mean())
        d = y / (n * length)
        d[:, rows, label] -= 1 / (n * length)
        back = s[::-1, 1]
        g = [np.zeros_like(v) for v in self.p]
        g[3][0] = np.einsum("tbh,tbk->hk", s[:, 0], d)
        g[3][1] = np.einsum("tbh,tbk->hk", back, d)
        g[4] = d.sum((0, 1))
        from_out = np.stack([d @ last[0].T, (d @ last[1].T)[::-1]], 1)
        both = np.stack([x.T, x.T[::-1]])
        ds = np.zeros((2, n, h), np.float32)
        for t in range(length - 1, -1, -1):
            state, z, r, c = kept[t]
            ds = ds + from_out[t]
            dc = ds * z * (1 - c * c)
            dz = ds * (c - state) * z * (1 - z)
            rs = r * state
            drs = np.matmul(dc, candidate.transpose(0, 2, 1))
            dr = drs * state * r * (1 - r)
            dzr = np.concatenate([dz, dr], 2)
            g[2] += np.matmul(rs.transpose(0, 2, 1), dc)
            g[1] += np.matmul(state.transpose(0, 2, 1), dzr)
            da = np.concatenate([dzr, dc], 2)
            for k in (0, 1):
                np.add.at(g[0][k], both[k, t], da[k])
            ds = ds * (1 - z) + drs * r + np.matmul(dzr, gates.transpose(0, 2, 1))
        return loss, g

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """(documents, languages): mean over all positions; rows of empty texts are 0."""
        sizes = np.array([len(t) for t in texts], np.int64)
        parts = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), parts)
        total = np.zeros((len(texts), len(self.languages)))
        if not len(owner):
            return total
        x = np.frombuffer(b"".join(map(_filled, texts)), np.uint8).reshape(-1, SEGMENT)
        # the last segment of a text may repeat bytes, which don't count again
        rest = sizes % SEGMENT
        last = {int(e) - 1: (int(r) if n < SEGMENT else int(r) - SEGMENT) for e, r, n in zip(np.cumsum(parts), rest, sizes, strict=True) if r}
        uneven = np.array(sorted(last), np.int64)
        for at in range(0, len(x), BLOCK):
            y = self.positions(self.states(x[at : at + BLOCK]))
            for i in uneven[(uneven >= at) & (uneven < at + BLOCK)].tolist():
                if last[i] > 0:
                    y[last[i] :, i - at] = 0
                else:
                    y[: -last[i], i - at] = 0
            np.add.at(total, owner[at : at + BLOCK], y.sum(0))
        return total / np.maximum(sizes, 1)[:, None]


def _filled(text: bytes) -> bytes:
    """Whole segments: a last one that is short reaches back, a text that is shorter goes round again."""
    n, short = len(text), len(text) % SEGMENT
    if not short:
        return text
    return text[: n - short] + text[-SEGMENT:] if n > SEGMENT else (text * (SEGMENT // n + 1))[:SEGMENT]


def train(segments: np.ndarray, labels: np.ndarray, languages: list[str], steps: int = 300, batch: int = 96, seed: int = 5) -> BiGRU:
    """Adam over random batches, as many of each language."""
    net, rng = BiGRU(languages), np.random.default_rng(seed)
    groups = [np.flatnonzero(labels == k) for k in range(len(languages))]
    first, second = [np.zeros_like(x) for x in net.p], [np.zeros_like(x) for x in net.p]
    for i in range(1, steps + 1):
        label = rng.integers(0, len(languages), batch)
        rows = np.array([groups[k][rng.integers(0, len(groups[k]))] for k in label])
        _, grads = net.gradient(segments[rows], label)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = 0.02 * min(1, 2 * (1 - i / (steps + 1)))
        for k, g in enumerate(grads):
            g = g * min(1, 1 / (norm + 1e-9))
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            net.p[k] -= rate * (first[k] / (1 - 0.9**i)) / (np.sqrt(second[k] / (1 - 0.99**i)) + 1e-8)
    return net


def _training_segments(rows: DataFrame) -> DataFrame:
    """lang, segment: from places of the whole text that its key chooses. rows: key, text, lang."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, segments = [], []
            for key, text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = (text or "").encode()
                rng = np.random.default_rng(abs(key))
                for _ in range(PARTS if raw else 0):
                    at = int(rng.integers(0, max(1, len(raw) - TRAIN_SEGMENT + 1)))
                    langs.append(lang)
                    part = raw[at : at + TRAIN_SEGMENT]
                    segments.append((part * (TRAIN_SEGMENT // len(part) + 1))[:TRAIN_SEGMENT])  # short texts over again
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(segments, pa.binary())], names=["lang", "segment"])

    return rows.mapInArrow(lean(run), "lang string, segment binary")


def identify(docs: DataFrame, held_out: Column, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", most: int = MOST_DOCUMENTS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row.

    Learned from text and non-null lang of rows that `held_out` (over doc_id) doesn't mark; about
    `most` rows of each language, by a hash of id and text, equal rows once. `und` with score 0: null
    texts, texts without a letter, and all if nothing could be learned. Null ids are ids like
    others. Languages are expected to be a short closed list. Other columns don't matter.
    """
    given = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    taught = given.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out).withColumn("key", F.xxhash64("doc_id", "text"))
    counts = {r.lang: max(1, r.n) for r in taught.groupBy("lang").agg(F.approx_count_distinct("key").alias("n")).collect()}
    languages = sorted(counts)
    net = None
    if languages:
        chosen_ = F.lit(False)
        for name in languages:
            chosen_ = F.when(F.col("lang") == name, in_share(F.col("key"), 3, most / counts[name])).otherwise(chosen_)
        chosen = taught.where(chosen_).dropDuplicates(["key", "lang"])
        found = _training_segments(chosen.select("key", "text", "lang")).orderBy("lang", "segment").toPandas()
        kept = [x for x in languages if (found.lang == x).any()]
        if kept:
            segments = np.frombuffer(b"".join(found.segment), np.uint8).reshape(-1, TRAIN_SEGMENT)
            net = train(segments, found.lang.map({x: i for i, x in enumerate(kept)}).to_numpy(), kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            bodies = batch.column("text").to_pylist()
            begin, size = 0, 0
            for i, body in enumerate(bodies):
                size += len(body or "")
                if size > 1 << 21 or i + 1 == len(bodies):
                    part = bodies[begin : i + 1]
                    letters = [bool(b) and any(map(str.isalpha, b)) for b in part]
                    y = net.documents([b.encode() if ok else b"" for b, ok in zip(part, letters, strict=True)]) if net else None
                    for j, ok in enumerate(letters):
                        k = int(y[j].argmax()) if ok and net else 0
                        names.append(net.languages[k] if ok and net else UNKNOWN)
                        scores.append(min(1.0, float(y[j, k])) if ok and net else 0.0)
                    begin, size = i + 1, 0
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    kind = dict(given.dtypes)["doc_id"]
    return given.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(lean(run), f"doc_id {kind}, held_out boolean, lang_pred string, score double")
