"""Toxicity: a bidirectional GRU with attention pooling scores all overlapping windows of a text.

A text is cut into windows of ``WINDOW`` words, each beginning ``STRIDE``
words after the one before, through to its end. A text's score is the
calibrated logit of its most toxic window.

The network (gru.py) is fitted in one task, away from the driver, on a
bounded sample of the labelled rows: per class the ``SAMPLE`` rows of smallest
hash. A label is of a whole text, so a toxic text is taken whole, and one of
more than ``SAMPLE_WORDS`` words is no row of the sample: a part of it may
not hold what made it toxic. Every part of a clean text is clean; of a longer
one ``SAMPLE_WORDS`` words are taken as windows from all over it. Fitting has
rounds: at first windows of toxic texts all count as toxic; later the ones
the network finds most toxic, against the clean texts' most toxic and random
windows. Scoring covers all rows and whole texts.

Defined results: a null text or one without words scores 0; without both
labels everything scores 0; repeated rows are scored each; an empty table
gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from concurrent.futures import ProcessPoolExecutor
from multiprocessing import get_context

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.llm import gru
from revmart.llm.common import bounded_sample, limited, neutral_names

WINDOW, STRIDE = 32, 16
SAMPLE, SAMPLE_WORDS = {1: 800, 0: 1400}, 1024


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end: each window's text, first token and length (texts without tokens: none)."""
    count = np.where(lengths > 0, 1 + np.maximum(0, -(-(lengths - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(lengths)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    begin = np.repeat(np.cumsum(lengths) - lengths, count)
    return text, begin + nth * STRIDE, np.minimum(WINDOW, lengths[text] - nth * STRIDE)


def _matrix(flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    at = np.minimum(first[:, None] + np.arange(size[0]), len(flat) - 1)  # past a window's end: never read
    return flat[at]


class Scorer:
    """Window logits with a bounded table of the tokens' gate inputs."""

    def __init__(self, params: dict[str, np.ndarray], table_words: int = 250_000) -> None:
        self.params, self.table_words = params, table_words
        self._clear()

    def _clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.table = np.zeros((1024, 2 * self.params["Uf"].shape[1]), np.float32)

    def _look_up(self, texts: list[list[str]]) -> np.ndarray:
        known = len(self.ids)
        flat = np.array([self.ids.setdefault(w, len(self.ids)) for t in texts for w in t], dtype=np.int64)
        if len(self.ids) > len(self.table):
            self.table = np.concatenate((self.table, np.zeros((len(self.ids), self.table.shape[1]), np.float32)))
        new = list(self.ids)[known:]
        for i in range(0, len(new), 20_000):
            part = new[i:i + 20_000]
            features = gru.token_features(part, len(self.params["word"]), len(self.params["gram"]))
            self.table[known + i:known + i + len(part)] = gru.gates(self.params, gru.inputs(self.params, features))
        return flat

    def window_logits(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Each window's text, first token, length and logit."""
        if len(self.ids) > self.table_words:
            self._clear()
        flat = self._look_up(texts)
        text, first, size = windows(np.array([len(t) for t in texts], dtype=np.int64))
        out = np.zeros(len(text), np.float32)
        order = np.argsort(-size, kind="stable")
        for i in range(0, len(order), 2048):
            rows = order[i:i + 2048]
            out[rows] = gru.logits(self.params, self.table, _matrix(flat, first[rows], size[rows]), size[rows])
        return text, first, size, out

    def text_logits(self, texts: list[list[str]]) -> np.ndarray:
        """The largest window logit of each text; -inf without words."""
        text, _, _, logit = self.window_logits(texts)
        out = np.full(len(texts), -np.inf)
        np.maximum.at(out, text, logit)
        return out


def tokens_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def fit(texts: list[list[str]], labels: np.ndarray, rounds: int = 3, batch: int = 128, rate: float = 0.01,
        seed: int = 7) -> tuple[dict[str, np.ndarray], float, float]:
    """Parameters, and slope and intercept of the calibration."""
    rng = np.random.default_rng(seed)
    params = gru.init_params(seed)
    adam = gru.Adam(params, rate)
    words = sorted({w for t in texts for w in t})
    index = {w: i for i, w in enumerate(words)}
    flat = np.array([index[w] for t in texts for w in t], dtype=np.int64)
    features = gru.token_features(words, len(params["word"]), len(params["gram"]))
    for r in range(rounds):
        text, first, size, logit = _all_windows(params, texts)
        best = np.lexsort((rng.random(len(text)), -logit if r else np.zeros(len(text)), text))
        rank = np.empty(len(text), dtype=np.int64)  # of a window in its text: by logit, at first at random
        starts = np.searchsorted(text, np.arange(len(texts)))
        rank[best] = np.arange(len(text)) - starts[text[best]]
        chance = rng.random(len(text))
        if r == 0:
            use = rank < np.where(labels[text] == 1, 8, 4)
        else:
            use = np.where(labels[text] == 1, rank < 2, (rank < 1) | (chance < 3 / np.bincount(text)[text]))
        pick = np.flatnonzero(use)
        for _ in range(2):
            rng.shuffle(pick)
            for i in range(0, len(pick), batch):
                rows = pick[i:i + batch]
                rows = rows[np.argsort(-size[rows], kind="stable")]
                used, X = np.unique(_matrix(flat, first[rows], size[rows]), return_inverse=True)
                X = X.reshape(len(rows), -1)
                _, grad = gru.gradients(params, gru.pick(features, used), X, size[rows],
                                        labels[text[rows]].astype(np.float32))
                adam.step(params, grad)
    text, _, _, logit = _all_windows(params, texts)
    top = np.full(len(texts), -np.inf)
    np.maximum.at(top, text, logit)
    return params, *calibrate(top, labels)


def _all_windows(params: dict[str, np.ndarray], texts: list[list[str]]) -> tuple[np.ndarray, ...]:
    """``window_logits`` of many texts, some at a time: little memory."""
    scorer, parts, tokens = Scorer(params, table_words=30_000), [], 0
    for i in range(0, len(texts), 50):
        some = texts[i:i + 50]
        text, first, size, logit = scorer.window_logits(some)
        parts.append((text + i, first + tokens, size, logit))
        tokens += sum(map(len, some))
    return tuple(np.concatenate(p) for p in zip(*parts))


def calibrate(logit: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Platt's slope and intercept, by gradient steps on smoothed targets."""
    keep = np.isfinite(logit)
    x, y = logit[keep], labels[keep] == 1
    if not y.any() or y.all():
        return 1.0, 0.0
    target = np.where(y, (y.sum() + 1) / (y.sum() + 2), 1 / ((~y).sum() + 2))
    mean, spread = x.mean(), x.std() + 1e-6
    u, a, b = (x - mean) / spread, 1.0, 0.0
    for _ in range(2000):
        d = (1 / (1 + np.exp(-(a * u + b))) - target) / len(u)
        a, b = a - 4.0 * (d @ u), b - 4.0 * d.sum()
    return a / spread, b - a * mean / spread


def spread(words: list[str], limit: int = SAMPLE_WORDS) -> list[str]:
    """At most ``limit`` words, as windows that begin at equal distances from the first word to the last."""
    if len(words) <= limit:
        return words
    count = limit // WINDOW
    starts = [k * (len(words) - WINDOW) // max(1, count - 1) for k in range(count)]
    return [w for a in starts for w in words[a:a + WINDOW]]


def _fit_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fits on all rows of (id, label, text); one row with the model, none without both labels."""
    rows = sorted((label, doc, text) for b in batches for label, doc, text in zip(
        b.column("label").to_pylist(), b.column("id").to_pylist(), b.column("text").to_pylist()))
    same: dict[str, str] = {}  # one object for all occurrences of a word
    texts = [[same.setdefault(w, w) for w in spread(tokens_of(text))] for _, _, text in rows]
    labels = np.array([label for label, _, _ in rows])
    keep = [i for i, t in enumerate(texts) if t]
    del rows
    if len(set(labels[keep].tolist())) == 2:
        # In a process of its own, which gives its memory back: Spark keeps this one for other tasks.
        with ProcessPoolExecutor(1, mp_context=get_context("fork")) as apart:
            model = apart.submit(fit, [texts[i] for i in keep], labels[keep]).result()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])


def learn(labelled: DataFrame) -> tuple[dict[str, np.ndarray], float, float] | None:
    """Fit on (id, text, label); None without both labels."""
    n_words = F.size(F.split(F.trim("text"), r"\s+"))
    drawn = [bounded_sample(labelled.filter(F.col("label") == y).filter(
        (F.length("text") > 0) & ((n_words <= SAMPLE_WORDS) | F.lit(y == 0))), "id", n, seed=7)
        for y, n in SAMPLE.items()]
    sample = drawn[0].unionByName(drawn[1]).select("id", "label", "text")
    # One task: the sample's bound is also its input's. The driver sees the model, a few MB.
    rows = sample.repartition(1).mapInArrow(_fit_sample, "model binary").collect()
    return pickle.loads(rows[0]["model"]) if rows else None


def score_rows(docs: DataFrame, model: tuple[dict[str, np.ndarray], float, float] | None,
               text_col: str = "text") -> DataFrame:
    """``docs`` as it is, and each row's score behind it."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few MB, whatever the input

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value[0]) if shared.value else None
        for batch in limited(batches, text_col, 1_000_000):
            if scorer is None:
                value = np.zeros(batch.num_rows)
            else:
                _, slope, intercept = shared.value
                logit = scorer.text_logits([tokens_of(t) for t in batch.column(text_col).to_pylist()])
                value = np.where(np.isfinite(logit), 1 / (1 + np.exp(-np.clip(slope * logit + intercept, -500, 500))), 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value)], [*batch.schema.names, "score"])

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))


def learn_from(docs: DataFrame, labels: DataFrame,
               held_out: Column) -> tuple[dict[str, np.ndarray], float, float] | None:
    """Fit on the labelled rows that are not held out."""
    known = labels.filter(F.col("toxic").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("id"), F.col("toxic").alias("label"))
    rows = docs.filter(~held_out).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return learn(rows.join(known, F.col("doc_id") == F.col("id")).select("id", "text", "label"))


def toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.7) -> DataFrame:
    """Learn from the labelled rows not held out; score every row: doc_id, held_out, score, predicted."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", held_out.alias("held_out"))
    return (score_rows(rows, learn_from(docs, labels, held_out)).select("doc_id", "held_out", "score")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def drop_toxic(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score under the threshold, their columns as they were."""
    rows, names = neutral_names(docs)
    scored = score_rows(rows, learn_from(docs, labels, held_out), names["text"])
    return scored.filter(F.col("score") < threshold).select(*names.values()).toDF(*docs.columns)
