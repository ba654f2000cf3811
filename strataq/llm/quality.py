"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text train a small network on statistics of whole texts, by
the non-negative unbiased risk (Kiryo et al., 2017): the part of the unlabelled risk that the
positives explain is taken out, at the estimated class prior, and never below nothing. The prior
comes from positives and unlabelled text alone: regressions tell the two apart, and the prior is
the least ratio of their shares above a score (best bin estimation, Garg et al., 2021). The
unbiased logistic risk of both then sets the scale of the scores, so that a score is a
probability. Rows of label 0 are unlabelled text like any other; their labels are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_share, lean, release_memory, written

#: Rows that the model is fitted on, at most about; hashes of id and text choose them.
MOST_POSITIVE, MOST_UNLABELLED = 20_000, 40_000
_SYMBOLS = [np.frombuffer(x, np.uint8) for x in (b"|", b"#*$%&<>", b"!?", b".,;:", b"\"'()[]{}", b"-_/\\=+@^~`")]
N_FEATURES = 24
_PART, _BLANK = 1 << 20, re.compile(r"\s")
_ODD = np.array([-7046029254386353131, 5871781006564002453], np.int64)  # two odd multipliers of a triple's words


def _parts(t: str) -> Iterator[str]:
    """`t` in parts of about a million characters, cut where white space is."""
    begin = 0
    while begin < len(t):
        cut = _BLANK.search(t, min(len(t), begin + _PART))
        end = cut.start() if cut else len(t)
        yield t[begin:end]
        begin = end


def _lines(t: str) -> Iterator[str]:
    begin = 0
    while begin <= len(t):
        end = t.find("\n", begin)
        line = t[begin : end if end >= 0 else len(t)]
        if line and not line.isspace():
            yield line
        begin = end + 1 if end >= 0 else len(t) + 1


def _distinct(hashes: np.ndarray) -> int:
    """How many there are; sorts them where they lie."""
    hashes.sort()
    return len(hashes[:1]) + int(np.count_nonzero(hashes[1:] != hashes[:-1]))


def text_features(text: str | None) -> list[float]:
    """Statistics of a whole text. A text is read part by part; of each word and line 64-bit hashes are held, which tell equal ones."""
    t = text or ""
    count, upper = np.zeros(256, np.int64), 0
    found, lengths = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    for part in _parts(t):
        count += np.bincount(np.frombuffer(part.encode(), np.uint8), minlength=256)
        words = part.split()
        found.append(np.fromiter(map(hash, words), np.int64, len(words)))
        lengths.append(np.fromiter(map(len, words), np.int32, len(words)))
        upper += sum(map(str.isupper, words))
    words, sizes = np.concatenate(found), np.concatenate(lengths)
    del found, lengths
    lines = np.fromiter(map(hash, _lines(t)), np.int64)
    size, n_words = int(count.sum()), len(words)
    count = count / max(1, size)
    w, m = max(1, n_words), max(1, len(lines))
    twice = int((words[1:] == words[:-1]).sum())
    thrice = 0
    if n_words > 2:
        triples = words[:-2] * _ODD[0]
        triples += words[1:-1] * _ODD[1]
        triples += words[2:]
        thrice = _distinct(triples)
        del triples
    sizes = sizes if n_words else np.zeros(1)
    return [
        np.log1p(size),
        np.log1p(n_words),
        *(count[x].sum() for x in _SYMBOLS),
        count[65:91].sum(),
        count[97:123].sum(),
        count[48:58].sum(),
        count[128:].sum(),
        count[32],
        count[10],
        count[:32].sum(),
        sizes.mean(),
        sizes.std(),
        sizes.max() / 100,
        _distinct(words) / w,
        twice / w,
        thrice / max(1, n_words - 2),
        upper / w,
        _distinct(lines) / m,
        np.log1p(n_words / m),
    ]


def _features(texts: pa.Array | pa.ChunkedArray) -> list[list[float]]:
    return [text_features(t.as_py()) for t in texts]


def featured(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """doc_id, h (hash of the text), x (features) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array(_features(batch.column("text")), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), x], names=["doc_id", "h", "x"])

    kind, body = dict(docs.dtypes)[doc_id], F.col(f"`{text}`")
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(body).alias("h"), body.alias("text")).mapInArrow(lean(run), f"doc_id {kind}, h bigint, x array<double>")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Network:
    """One hidden layer of rectifiers over standardised features."""

    def __init__(self, x: np.ndarray, hidden: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        self.p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 0.1, hidden), np.zeros(1)]
        self.a, self.b = 1.0, 0.0

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def raw(self, z: np.ndarray) -> np.ndarray:
        return np.maximum(z @ self.p[0] + self.p[1], 0) @ self.p[2] + self.p[3][0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.a * self.raw(self.standard(x)) + self.b)

    def gradient(self, z: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
        """Of the sum of slope times output."""
        h = np.maximum(z @ self.p[0] + self.p[1], 0)
        d = np.outer(slope, self.p[2]) * (h > 0)
        return [z.T @ d, d.sum(0), h.T @ slope, np.array([slope.sum()])]


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 1500, batch: int = 512, seed: int = 11) -> Network:
    """Minimise the non-negative risk with the sigmoid loss; where it is under 0, step back from overfitting."""
    rng = np.random.default_rng(seed)
    net = Network(np.concatenate([positive, unlabelled]))
    p_all, u_all = net.standard(positive), net.standard(unlabelled)
    first, second = [np.zeros_like(x) for x in net.p], [np.zeros_like(x) for x in net.p]
    for i in range(1, steps + 1):
        p, u = p_all[rng.integers(0, len(p_all), batch)], u_all[rng.integers(0, len(u_all), batch)]
        sp, su = _sigmoid(net.raw(p)), _sigmoid(net.raw(u))
        dp, du = sp * (1 - sp), su * (1 - su)
        negative = su.mean() - prior * sp.mean()
        if negative >= 0:
            parts = [(p, -2 * prior * dp / batch), (u, du / batch)]
        else:
            parts = [(p, prior * dp / batch), (u, -du / batch)]
        grads = [sum(x) for x in zip(*(net.gradient(z, s) for z, s in parts), strict=True)]
        for k, g in enumerate(grads):
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.001 * (g * g - second[k])
            net.p[k] -= 0.01 * (first[k] / (1 - 0.9**i)) / (np.sqrt(second[k] / (1 - 0.999**i)) + 1e-8)
    return net


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among unlabelled rows. Arguments: scores of rows that the scoring network wasn't fitted on."""
    both = np.sort(np.concatenate([positive, unlabelled]))
    share = lambda x: 1 - np.searchsorted(np.sort(x), both) / len(x)  # noqa: E731  at least each score
    p, u = share(positive), share(unlabelled)
    error = np.sqrt(np.log(20) / 2) * (1 / np.sqrt(len(positive)) + 1 / np.sqrt(len(unlabelled)))
    some = p > 0
    best = np.argmin((u[some] + error) / p[some])
    return float(np.clip(u[some][best] / p[some][best], 0.05, 0.95))


def _linear(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Weights of a logistic regression by Newton steps; x has a column of ones."""
    w = np.zeros(x.shape[1])
    for _ in range(15):
        s = _sigmoid(x @ w)
        step = np.linalg.solve((x * (s * (1 - s))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (s - y) + ridge * w)
        w -= step * min(1, 4 / (np.abs(step).max() + 1e-12))
    return w


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The prior by two halves of the rows, each scored by a regression that learned from the other to tell
    positives from the unlabelled: a plain model, so that few rows do."""
    if min(len(positive), len(unlabelled)) < 20:
        return 0.5
    net = Network(np.concatenate([positive, unlabelled]))
    p, u = (np.c_[net.standard(x), np.ones(len(x))] for x in (positive, unlabelled))
    found = []
    for i in (0, 1):
        y = np.r_[np.ones(len(p[i::2])), np.zeros(len(u[i::2]))]
        w = _linear(np.concatenate([p[i::2], u[i::2]]), y, 5.0)
        found.append(class_prior(p[1 - i :: 2] @ w, u[1 - i :: 2] @ w))
    return float(np.mean(found))


def calibrate(net: Network, positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> None:
    """Scale and shift of the output by Newton steps on the unbiased logistic risk
    mean over unlabelled of log(1 + exp(g)) - prior * mean over positives of g, which is convex in both."""
    gp, gu = net.raw(net.standard(positive)), net.raw(net.standard(unlabelled))
    center, scale = gu.mean(), gu.std() + 1e-9
    design = lambda g: np.stack([(g - center) / scale, np.ones(len(g))], 1)
    z, target, w = design(gu), prior * design(gp).mean(0), np.zeros(2)
    for _ in range(50):
        s = _sigmoid(z @ w)
        slope = (z.T @ s) / len(z) - target + 1e-3 * w * [1, 0]
        step = np.linalg.solve((z * (s * (1 - s))[:, None]).T @ z / len(z) + np.eye(2) * 1e-3, slope)
        w -= step * min(1, 2 / (np.abs(step).max() + 1e-12))
    net.a, net.b = w[0] / scale, w[1] - w[0] * center / scale


def _sample(rows: DataFrame, most: int) -> np.ndarray:
    """About `most` distinct rows (k, x), whatever ids and copies they have; k, a hash, chooses them."""
    n = rows.agg(F.approx_count_distinct("k")).first()[0]
    found = rows.where(in_share(F.col("k"), 4, most / max(1, n))).dropDuplicates(["k"]).orderBy("k").select("x").toPandas().x
    return np.stack(found.to_list()) if len(found) else np.zeros((0, N_FEATURES))


def learned(x: DataFrame, labels: DataFrame, held_out: Column) -> Network | None:
    """The fitted network, or none without trusted positives. x: doc_id, h, x (features)."""
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality")).where(~held_out).where("quality = 1")
    marked = written(x.join(marks, "doc_id", "left").select(F.xxhash64("doc_id", "h").alias("k"), F.col("quality").isNotNull().alias("trusted"), "x"), "marked")
    positive = _sample(marked.where("trusted"), MOST_POSITIVE)
    if not len(positive):
        return None
    unlabelled = _sample(marked, MOST_UNLABELLED)  # all text, as the risk wants it, not only what has no label
    prior = estimate_prior(positive, unlabelled)
    net = fit(positive, unlabelled, prior)
    calibrate(net, positive, unlabelled, prior)
    return net


def score_quality(docs: DataFrame, labels: DataFrame, held_out: Column, text: str = "text", doc_id: str = "doc_id", threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    `held_out`, over doc_id, marks rows whose labels aren't read. Null texts count as empty and
    are scored. Labels: doc_id, quality; null ones don't count, of repeated ones the least does.
    Without trusted positives the score is 0.5. Null ids are never labelled; repeated rows score
    alike, and teach once. Other columns don't matter.
    """
    x = written(featured(docs, text, doc_id), "features")
    net = learned(x, labels, held_out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            s = net.score(np.array(batch.column("x").to_pylist())) if net and n else np.full(n, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    kind = dict(x.dtypes)["doc_id"]
    return x.select("doc_id", held_out.alias("held_out"), "x").mapInArrow(lean(run), f"doc_id {kind}, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, labels: DataFrame, held_out: Column, text: str = "text", doc_id: str = "doc_id", threshold: float = 0.3) -> DataFrame:
    """The rows of `docs` that score `threshold` or more, with all their columns.

    Rows are written once with their features, scored from there; texts aren't shuffled. Null and
    empty texts are scored like others, null ids and repeated rows too. Without trusted positives
    all rows stay; an empty table stays empty. Columns may have any names.
    """
    extra = "x"
    while extra.lower() in {c.lower() for c in docs.columns}:
        extra += "_"

    # only the text goes to Python, and only the features when scores are asked for
    @F.arrow_udf("array<double>")
    def features(texts: pa.Array) -> pa.Array:
        out = pa.array(_features(texts), pa.list_(pa.float64()))
        release_memory()
        return out

    rows = written(docs.withColumn(extra, features(F.col(f"`{text}`"))), "features")
    net = learned(rows.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("h"), F.col(extra).alias("x")), labels, held_out)
    if net is None:
        return rows.drop(extra)

    @F.arrow_udf("boolean")
    def good(x: pa.Array) -> pa.Array:
        return pa.array(net.score(np.array(x.to_pylist()).reshape(len(x), N_FEATURES)) >= threshold)

    return rows.where(good(F.col(extra))).drop(extra)
