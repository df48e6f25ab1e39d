"""Quality by positive-unlabelled learning with the non-negative risk.

Trusted positives are rows labelled good; the unlabelled set is web text as
it comes, whatever its label. With class prior pi, the risk minimised is

    pi * R_p(+) + max(0, R_u(-) - pi * R_p(-))

with logistic losses, by a small network over text statistics; a batch whose
second part is negative takes a step that raises it. No negative label is
ever read. The prior is estimated: a first network separates positives from
unlabelled text, and the prior is the smallest ratio, over thresholds, of
the shares of held-back unlabelled and positive texts above it (with a
margin for the counts).

The fit uses a bounded sample (``positives``, ``unlabelled`` rows of
smallest seeded hash); statistics are computed in the tasks and only they
reach the driver. Scoring covers all rows and whole texts.

Defined results: a null text has the statistics of an empty one; without
positives everything scores 0; repeated rows are scored each; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revmart.llm.common import bounded_sample, limited

N_SHAPE = 20
N_FEATURES = N_SHAPE + 128


def text_features(text: str | None) -> np.ndarray:
    """Shape statistics of a whole text and its byte shares (0-127 each by itself, of the lower half)."""
    out = np.zeros(N_FEATURES, np.float32)
    if not text:
        return out
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    bytes_ = np.bincount(data, minlength=256).astype(np.float32) / len(data)
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    counts = Counter(words)
    sizes = np.array([len(w) for w in words] or [0])
    upper = sum(map(str.isupper, words))
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    ends = Counter(w[-1] for w in words)
    marks = sum(v for c, v in ends.items() if not c.isalnum())
    letters = bytes_[65:91].sum() + bytes_[97:123].sum() + bytes_[128:].sum()
    out[:N_SHAPE] = (
        math.log1p(len(data)), math.log1p(len(words)), math.log1p(len(lines)), sizes.mean() / 10, sizes.std() / 10,
        len(counts) / n, len(counts) / math.sqrt(n) / 10, max(counts.values(), default=0) / n, upper / n, repeats / n,
        marks / n, max(ends.values(), default=0) / n, len(set(lines)) / len(lines), letters,
        bytes_[65:91].sum() / max(letters, 1e-6), bytes_[48:58].sum(), bytes_[128:].sum(),
        bytes_[33:48].sum() + bytes_[58:65].sum() + bytes_[91:97].sum() + bytes_[123:127].sum(),
        sum(map(str.istitle, words)) / n, bytes_[9:14].sum() + bytes_[32])
    out[N_SHAPE:] = np.sqrt(bytes_[:128])
    return out


class Network:
    """One hidden layer over standardised features; gives logits."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, hidden: int, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.spread = mean, spread
        d = len(mean)
        self.p = [rng.standard_normal((d, hidden)) * d**-0.5, np.zeros(hidden),
                  rng.standard_normal(hidden) * hidden**-0.5, np.zeros(1)]
        self.m = [np.zeros_like(a) for a in self.p]
        self.v = [np.zeros_like(a) for a in self.p]
        self.t = 0

    def hidden(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        u = np.clip((x - self.mean) / self.spread, -6, 6)
        return u, np.tanh(u @ self.p[0] + self.p[1])

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self.hidden(x)[1] @ self.p[2] + self.p[3][0]

    def step(self, x: np.ndarray, slope: np.ndarray, rate: float, decay: float = 1e-3) -> None:
        """An Adam step, given the loss's slope at each row's logit."""
        u, h = self.hidden(x)
        dh = slope[:, None] * self.p[2] * (1 - h * h)
        grads = [u.T @ dh, dh.sum(axis=0), h.T @ slope, np.array([slope.sum()])]
        self.t += 1
        fix = rate * math.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for i, g in enumerate(grads):
            g = g + decay * self.p[i] if i in (0, 2) else g
            self.m[i] += 0.1 * (g - self.m[i])
            self.v[i] += 0.001 * (g * g - self.v[i])
            self.p[i] = self.p[i] - fix * self.m[i] / (np.sqrt(self.v[i]) + 1e-8)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def pu_slopes(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Slopes of the non-negative risk at positive and unlabelled logits, and that risk."""
    plus, p_minus, u_minus = np.logaddexp(0, -zp).mean(), np.logaddexp(0, zp).mean(), np.logaddexp(0, zu).mean()
    negative = u_minus - prior * p_minus
    sp, su = _sigmoid(zp), _sigmoid(zu)
    if negative >= 0:
        return prior * ((sp - 1) - sp) / len(zp), su / len(zu), prior * plus + negative
    return prior * sp / len(zp), -su / len(zu), prior * plus  # climb back: the gradient of -negative


def _train(network: Network, pos: np.ndarray, unl: np.ndarray, slopes, rounds: int, rate: float, seed: int) -> None:
    rng = np.random.default_rng(seed)
    size = 256
    steps = max(1, max(len(pos), len(unl)) // size)
    for _ in range(rounds * steps):
        p, u = pos[rng.integers(0, len(pos), size)], unl[rng.integers(0, len(unl), size)]
        sp, su = slopes(network.logits(p), network.logits(u))[:2]
        network.step(np.concatenate((p, u)), np.concatenate((sp, su)), rate)


def estimate_prior(pos: np.ndarray, unl: np.ndarray, delta: float = 0.1) -> float:
    """Smallest ratio of the shares above a threshold, unlabelled over positive (best bin)."""
    pos, unl = np.sort(pos), np.sort(unl)
    cuts = np.unique(np.concatenate((pos, unl)))
    qp = 1 - np.searchsorted(pos, cuts, side="left") / len(pos)
    qu = 1 - np.searchsorted(unl, cuts, side="left") / len(unl)
    slack = lambda n: math.sqrt(math.log(4 / delta) / (2 * n))
    bound = (qu + slack(len(unl)) + slack(len(pos))) / np.maximum(qp, 1e-9)
    best = int(np.argmin(np.where(qp > 0, bound, np.inf)))
    return float(np.clip(qu[best] / max(qp[best], 1e-9), 0.05, 0.97))


def fit(pos: np.ndarray, unl: np.ndarray, hidden: int = 24, seed: int = 13) -> tuple[Network, float]:
    """The network and the estimated prior."""
    both = np.concatenate((pos, unl))
    mean, spread = both.mean(axis=0), both.std(axis=0) + 1e-3
    priors = []
    for s in range(seed, seed + 5):  # the median of five halvings
        rng = np.random.default_rng(s)
        p, u = rng.permutation(pos), rng.permutation(unl)
        half_p, half_u = -(-len(p) // 2), -(-len(u) // 2)
        first = Network(mean, spread, hidden, s)
        _train(first, p[:half_p], u[:half_u],
               lambda zp, zu: ((_sigmoid(zp) - 1) / len(zp), _sigmoid(zu) / len(zu)), 15, 0.005, s)
        held_p, held_u = (p[half_p:], u[half_u:]) if len(p) > 1 and len(u) > 1 else (p, u)
        priors.append(estimate_prior(first.logits(held_p), first.logits(held_u)))
    prior = float(np.median(priors))
    network = Network(mean, spread, hidden, seed + 1)
    _train(network, pos, unl, lambda zp, zu: pu_slopes(zp, zu, prior), 100, 0.005, seed + 1)
    return network, prior


def _features(rows: DataFrame) -> np.ndarray:
    """Statistics of a bounded sample's texts."""
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([text_features(t).tobytes() for t in batch.column("text").to_pylist()], pa.binary())], ["f"])

    got = rows.select("text").mapInArrow(compute, "f binary").collect()
    return np.array([np.frombuffer(r["f"], np.float32) for r in got], dtype=np.float64).reshape(-1, N_FEATURES)


def quality(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.3, positives: int = 3000,
            unlabelled: int = 6000) -> DataFrame:
    """Learn from the rows not held out; score every row: doc_id, held_out, score, predicted."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", held_out.alias("held_out"))
    learning = rows.filter("not held_out")
    good = labels.filter(F.col("quality") == 1).select(F.col("doc_id").cast("bigint").alias("id")).distinct()
    pos = _features(bounded_sample(learning.join(good, F.col("doc_id") == F.col("id"), "left_semi"),
                                   "doc_id", positives, seed=21))
    unl = _features(bounded_sample(learning, "doc_id", unlabelled, seed=22))
    network = fit(pos, unl)[0] if len(pos) and len(unl) else None

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in limited(batches, "text", 4_000_000):
            if network is None:
                value = np.zeros(batch.num_rows)
            else:
                value = _sigmoid(network.logits(np.array(
                    [text_features(t) for t in batch.column("text").to_pylist()], dtype=np.float64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(value)],
                                             ["doc_id", "held_out", "score"])

    return (rows.mapInArrow(score, "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
