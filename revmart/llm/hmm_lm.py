"""Hidden Markov language model with exact likelihoods.

A text is a run of words and an end token. Hidden states emit word classes;
a word follows from its class by add-one smoothed counts:

    P(text) = P_hmm(classes) * product of (c + 1) / (N_class + V_class + 1)

The ``top_words`` most frequent words are classes of their own, all other
words (seen or not) share ``suffix_classes`` by the crc32 of their last three
characters; each class keeps one place for unseen words, so the
probabilities of all words sum to one in every state.

Counts are over all training rows. Words are first counted per block (a
batch of documents), so a word costs one row per block however frequent it
is; summed per word over blocks; and sent back to the block, where the
documents' base scores and class sequences are made. Baum-Welch starts from
a model fitted on ``start_rows`` sequences (a documented bound; only the
start depends on it) and then runs ``rounds`` rounds over every training
row: each task adds up its expected counts, which are summed in two steps
and give the next model. Training sequences are the documents cut at
``SEGMENT`` tokens. Scores run the scaled forward recursion over whole
documents: segments after the first are kept as matrices from entry state to
exit state, so a long document is as exact as a short one.

Defined results: a null text is empty, its only token the end; with no
training rows every count is 0; repeated rows are scored each; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revmart.llm.common import bounded_sample, limited, materialise, words_of
from revmart.session import scratch_path

END = " "  # no word holds a space
SEGMENT = 256
ENCODED = ("doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, word_score double, "
           "classes binary")
RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double")


@dataclass
class Hmm:
    start: np.ndarray  # states
    entry: np.ndarray  # states, at a later segment's first token (training only)
    move: np.ndarray  # states x states
    emit: np.ndarray  # classes x states: the column of a state sums to 1


# --- ids of a block's own words: varints, 7 bits a byte, the lowest first ---

def _pack(ids: np.ndarray) -> bytes:
    ids = ids.astype(np.uint64)
    width = 1 + sum((ids >> np.uint64(s) > 0).astype(np.int64) for s in range(7, 64, 7))
    ends = np.cumsum(width)
    out = np.zeros(int(ends[-1]) if len(ids) else 0, dtype=np.uint8)
    for k in range(int(width.max(initial=0))):
        has = width > k
        more = (width[has] > k + 1).astype(np.uint64) << np.uint64(7)
        out[(ends - width)[has] + k] = (ids[has] >> np.uint64(7 * k)) & np.uint64(127) | more
    return out.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(raw < 128) + 1
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)[:len(ends)]
    width = ends - starts
    ids = np.zeros(len(ends), dtype=np.int64)
    for k in range(int(width.max(initial=0))):
        has = width > k
        ids[has] |= (raw[starts[has] + k] & 127).astype(np.int64) << (7 * k)
    return ids


def split_blocks(docs: DataFrame, block_chars: int) -> tuple[DataFrame, DataFrame]:
    """Documents as ids of their block's words, and each block's words with their training counts."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        for batch in limited(batches, "text", block_chars):
            block, seq = (part << 32) | seq, seq + 1
            ids: dict[bytes, int] = {END.encode(): 0}
            counts = np.zeros(0, dtype=np.int64)
            held = [bool(h) for h in batch.column("held_out").to_pylist()]
            packed = []
            for out, text in zip(held, batch.column("text").to_pylist()):
                row = np.array([ids.setdefault(w, len(ids)) for w in words_of(text)] + [0], dtype=np.int64)
                if len(ids) > len(counts):
                    counts = np.concatenate((counts, np.zeros(2 * len(ids), dtype=np.int64)))
                if not out:
                    np.add.at(counts, row, 1)
                packed.append(_pack(row))
            n, m = len(packed), len(ids)
            yield pa.RecordBatch.from_pydict({
                "block": np.full(n + m, block), "pos": np.concatenate((np.arange(n), np.arange(m))),
                "doc_id": pa.array(batch.column("doc_id").to_pylist() + [None] * m, pa.int64()),
                "held_out": pa.array(held + [None] * m, pa.bool_()),
                "ids": pa.array(packed + [None] * m, pa.binary()),
                "word": pa.array([None] * n + [w.decode("utf-8", "replace") for w in ids], pa.string()),
                "n": pa.array([None] * n + counts[:m].tolist(), pa.int64()),
                "kind": pa.array(["doc"] * n + ["word"] * m)})

    spark = docs.sparkSession
    path = scratch_path(spark, "lm-blocks")
    schema = "block long, pos long, doc_id long, held_out boolean, ids binary, word string, n long, kind string"
    docs.mapInArrow(split, schema).write.partitionBy("kind").parquet(path)
    both = spark.read.schema(schema).parquet(path)
    return (both.filter("kind = 'doc'").select("block", "pos", "doc_id", "held_out", "ids"),
            both.filter("kind = 'word'").select("block", "pos", "word", "n"))


def _least_of_top(counts: DataFrame, k: int) -> int:
    """A count that k words reach (1 if fewer have any), close to the k-th largest: from a histogram of the counts."""
    steps = (counts.filter("n > 0").groupBy(F.floor(F.log2("n") * 16).alias("step"))
             .agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least")).collect())  # 16 a doubling
    held = 0
    for r in sorted(steps, key=lambda r: -r["least"]):
        held += r["words"]
        if held >= k:
            return r["least"]
    return 1


def count_words(words: DataFrame, top_words: int, suffix_classes: int) -> DataFrame:
    """Per block and word: its count over all blocks, its class, and whether this row stands for the word."""
    spark = words.sparkSession
    # The counts of 3 and more in a block are parts of the whole counts: what top_words words
    # reach of them, the top words reach of the whole. Only such words are carried on by name.
    parts = words.filter("n >= 3").groupBy("word").agg(F.sum("n").alias("n"))
    least = _least_of_top(parts, top_words)
    suffix = F.lit(top_words) + F.pmod(F.crc32(F.substring("word", -3, 3).cast("binary")), F.lit(suffix_classes))
    by = Window.partitionBy("word")
    # one exchange; a word has a row per block at most
    counted = materialise(
        words.withColumn("c", F.sum("n").over(by))
        .withColumn("stands", F.row_number().over(by.orderBy("block")) == 1)
        .select("block", "pos", "c", suffix.cast("int").alias("class"), "stands",
                F.when(F.col("c") >= least, F.col("word")).alias("word")), "lm-counts")
    named = counted.filter("stands AND word IS NOT NULL").select("word", F.col("c").alias("n"))
    top = (named.filter(F.col("n") >= _least_of_top(named, top_words))
           .orderBy(F.desc("n"), "word").limit(top_words).collect())
    classes = spark.createDataFrame([(r["word"], i) for i, r in enumerate(top)], "word string, own int")
    return (counted.join(F.broadcast(classes), "word", "left")  # top_words rows
            .select("block", "pos", "c", F.coalesce("own", "class").alias("class"), "stands"))


def encode(docs: DataFrame, counted: DataFrame, totals: np.ndarray, distinct: np.ndarray) -> DataFrame:
    """Meet documents and counts again in their block: base scores and class sequences."""
    n_all, v_all = int(totals.sum()), int(distinct.sum())

    def score(key: tuple, texts: pa.Table, words: pa.Table) -> pa.Table:
        at = words.column("pos").to_numpy()
        c, cls = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        c[at], cls[at] = words.column("c").to_numpy(), words.column("class").to_numpy()
        base = np.log10((c + 1) / (n_all + v_all + 1))
        inside = np.log10((c + 1) / (totals[cls] + distinct[cls] + 1))
        texts = texts.sort_by("pos")
        out: list[list] = [[] for _ in range(5)]
        for packed in texts.column("ids").to_pylist():
            ids = _unpack(packed)
            for column, value in zip(out, (len(ids), int((c[ids] > 0).sum()), float(base[ids].sum()),
                                           float(inside[ids].sum()), cls[ids].astype("<u2").tobytes())):
                column.append(value)
        types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
        return pa.table([texts.column("doc_id"), texts.column("held_out"),
                         *(pa.array(v, t) for v, t in zip(out, types))],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "word_score", "classes"])

    return materialise(docs.groupBy("block").cogroup(counted.select("block", "pos", "c", "class").groupBy("block"))
                       .applyInArrow(score, ENCODED), "lm-encoded")


# --- Baum-Welch ---

def _segments(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts cut at SEGMENT tokens, longest first: padded classes, lengths, whether a text begins."""
    parts = [(t[i:i + SEGMENT], i == 0) for t in texts for i in range(0, len(t), SEGMENT)]
    parts.sort(key=lambda p: -len(p[0]))
    lengths = np.array([len(p) for p, _ in parts])
    x = np.zeros((len(parts), lengths[0]), dtype=np.int64)
    for row, (p, _) in zip(x, parts):
        row[:len(p)] = p
    return x, lengths, np.array([f for _, f in parts])


def expected_counts(texts: list[np.ndarray], hmm: Hmm) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, float]:
    """One E-step: expected starts, entries, moves and emissions (classes x states), and the log likelihood."""
    x, lengths, begins = _segments(texts)
    (n, width), k = x.shape, len(hmm.start)
    active = [int(np.searchsorted(-lengths, -t, side="left")) for t in range(width + 1)]  # rows longer than t
    alpha, scale = np.zeros((width, n, k)), np.ones((width, n))
    a = np.where(begins[:, None], hmm.start, hmm.entry) * hmm.emit[x[:, 0]]
    for t in range(width):
        m = active[t]
        if t:
            a = (a[:m] @ hmm.move) * hmm.emit[x[:m, t]]
        s = a.sum(axis=1)
        a = a / s[:, None]
        alpha[t, :m], scale[t, :m] = a, s
    moves, beta = np.zeros((k, k)), np.ones((n, k))
    gamma = np.zeros_like(alpha)
    for t in range(width - 1, -1, -1):
        m = active[t]
        gamma[t, :m] = alpha[t, :m] * beta[:m]
        if t:
            behind = beta[:m] * hmm.emit[x[:m, t]] / scale[t, :m, None]
            moves += alpha[t - 1, :m].T @ behind
            beta[:m] = behind @ hmm.move.T
    inside = np.arange(width)[:, None] < lengths[None, :]
    classes = x.T[inside]
    emits = np.stack([np.bincount(classes, gamma[:, :, j][inside], len(hmm.emit)) for j in range(k)], axis=1)
    first = gamma[0]
    return (first[begins].sum(axis=0), first[~begins].sum(axis=0), moves * hmm.move, emits,
            float(np.log(scale[inside]).sum()))


def maximise(start: np.ndarray, entry: np.ndarray, moves: np.ndarray, emits: np.ndarray) -> Hmm:
    """The M-step, smoothed so that nothing has probability 0."""
    k = len(start)
    share = (emits.sum(axis=1) + 1) / (emits.sum() + len(emits))  # of each class, over all states
    emits = emits + 0.5 * k * share[:, None]
    norm = lambda v: (v + 0.1) / (v + 0.1).sum(axis=-1, keepdims=True)
    return Hmm(norm(start), norm(entry), norm(moves), emits / emits.sum(axis=0))


def starting_model(texts: list[np.ndarray], states: int, classes: int, rounds: int = 20, seed: int = 3) -> Hmm:
    rng = np.random.default_rng(seed)
    counts = np.bincount(np.concatenate(texts), minlength=classes) if texts else np.zeros(classes)
    hmm = maximise(np.ones(states), np.ones(states), np.eye(states) * 20 + 1,
                   (counts[:, None] + 0.1) * rng.gamma(1.0, size=(classes, states)))
    for _ in range(rounds if texts else 0):
        hmm = maximise(*expected_counts(texts, hmm)[:4])
    return hmm


def _batches(batches: Iterator[pa.RecordBatch], tokens: int = 300_000) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Runs of rows with about ``tokens`` tokens, and their class sequences."""
    for batch in batches:
        texts = [np.frombuffer(b, "<u2").astype(np.int64) for b in batch.column("classes").to_pylist()]
        first = total = 0
        for i, t in enumerate(texts):
            if total and total + len(t) > tokens:
                yield batch.slice(first, i - first), texts[first:i]
                first, total = i, 0
            total += len(t)
        if texts:
            yield batch.slice(first), texts[first:]


def _add_up(key: tuple, table: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(b, "<f8") for b in table.column("counts").to_pylist()], axis=0)
    return table.slice(0, 1).set_column(table.schema.get_field_index("counts"), "counts",
                                        pa.array([total.tobytes()], pa.binary()))


def baum_welch_round(encoded: DataFrame, hmm: Hmm) -> Hmm:
    """Expected counts of every training row, added up per task, per group of tasks, and over groups."""
    k, classes = len(hmm.start), len(hmm.emit)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for _, texts in _batches(batches):
            got = expected_counts(texts, hmm)[:4]
            total = got if total is None else [a + b for a, b in zip(total, got)]
        if total is not None:
            start, entry, moves, emits = total
            rows = [np.concatenate((start[j:j + 1], entry[j:j + 1], moves[j], emits[:, j])) for j in range(k)]
            yield pa.RecordBatch.from_pydict({
                "team": pa.array([TaskContext.get().partitionId() % 64] * k, pa.int64()),
                "state": pa.array(range(k), pa.int64()),
                "counts": pa.array([r.astype("<f8").tobytes() for r in rows], pa.binary())})

    schema = "team long, state long, counts binary"
    sums = (encoded.filter("not held_out").select("classes").mapInArrow(count, schema)
            .groupBy("team", "state").applyInArrow(_add_up, schema)
            .groupBy("state").applyInArrow(_add_up, schema))
    rows = {r["state"]: np.frombuffer(r["counts"], "<f8") for r in sums.collect()}  # one row per state
    if not rows:
        return hmm
    table = np.stack([rows[j] for j in range(k)])
    return maximise(table[:, 0], table[:, 1], table[:, 2:2 + k], table[:, 2 + k:].T.reshape(classes, k))


# --- exact scores ---

def log_likelihoods(texts: list[np.ndarray], hmm: Hmm) -> np.ndarray:
    """Natural log of each text's probability, by the scaled forward recursion."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    lengths = np.array([len(texts[i]) for i in order])
    k, out = len(hmm.start), np.zeros(len(texts))
    # first segments: one state vector each
    x = np.zeros((len(order), min(SEGMENT, lengths[0])), dtype=np.int64)
    for row, i in zip(x, order):
        part = texts[i][:SEGMENT]
        row[:len(part)] = part
    vector, logs = np.zeros((len(order), k)), np.zeros(len(order))
    a = hmm.start * hmm.emit[x[:, 0]]
    for t in range(x.shape[1]):
        m = int(np.searchsorted(-lengths, -t, side="left"))
        if t:
            a = (vector[:m] @ hmm.move) * hmm.emit[x[:m, t]]
        s = a.sum(axis=1)
        vector[:m], logs[:m] = a / s[:, None], logs[:m] + np.log(s)
    # later segments: a matrix each, from the state before it to the state at its end
    later = [(d, texts[i][at:at + SEGMENT]) for d, i in enumerate(order)
             for at in range(SEGMENT, len(texts[i]), SEGMENT)]
    for first in range(0, len(later), 1000):
        part = sorted(later[first:first + 1000], key=lambda p: -len(p[1]))
        size = np.array([len(p) for _, p in part])
        x = np.zeros((len(part), size[0]), dtype=np.int64)
        for row, (_, p) in zip(x, part):
            row[:len(p)] = p
        matrix, scale = np.tile(np.eye(k), (len(part), 1, 1)), np.zeros(len(part))
        for t in range(x.shape[1]):
            m = int(np.searchsorted(-size, -t, side="left"))
            a = (matrix[:m].reshape(-1, k) @ hmm.move).reshape(m, k, k) * hmm.emit[x[:m, t]][:, None, :]
            s = a.sum(axis=(1, 2))
            matrix[:m], scale[:m] = a / s[:, None, None], scale[:m] + np.log(s)
        place = {}
        for r, (d, _) in enumerate(part):
            place.setdefault(d, []).append(r)  # the sort is stable: a document's segments keep their order
        for d, rows in place.items():
            for r in rows:
                v = vector[d] @ matrix[r]
                s = v.sum()
                vector[d], logs[d] = v / s, logs[d] + np.log(s) + scale[r]
    out[order] = logs
    return out


def score_texts(encoded: DataFrame, hmm: Hmm, train_tokens: int) -> DataFrame:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _batches(batches):
            value = log_likelihoods(texts, hmm) / np.log(10) + batch.column("word_score").to_numpy()
            keep = [batch.column(c) for c in ("doc_id", "held_out", "n_tokens", "n_known")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(np.full(len(value), train_tokens)), batch.column("base_score"), pa.array(value)],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return encoded.mapInArrow(score, RESULT)


def hmm_scores(docs: DataFrame, held_out: Column, states: int = 8, top_words: int = 2048, suffix_classes: int = 2048,
               start_rows: int = 1500, rounds: int = 4, block_chars: int = 8_000_000) -> DataFrame:
    """Train on the rows not held out and score every row."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", held_out.alias("held_out"))
    texts, words = split_blocks(rows, block_chars)
    counted = count_words(words, top_words, suffix_classes)
    classes = top_words + suffix_classes
    totals, distinct = np.zeros(classes, dtype=np.int64), np.zeros(classes, dtype=np.int64)
    for r in counted.filter("stands").groupBy("class").agg(
            F.sum("c").alias("n"), F.sum(F.when(F.col("c") > 0, 1).otherwise(0)).alias("v")).collect():
        totals[r["class"]], distinct[r["class"]] = r["n"], r["v"]
    encoded = encode(texts, counted, totals, distinct)
    start = (bounded_sample(encoded.filter("not held_out"), "doc_id", start_rows, seed=41)
             .select(F.substring("classes", 1, 2 * SEGMENT).alias("classes")).collect())
    hmm = starting_model([np.frombuffer(r["classes"], "<u2").astype(np.int64) for r in start], states, classes)
    for _ in range(rounds):
        hmm = baum_welch_round(encoded, hmm)
    return score_texts(encoded, hmm, int(totals.sum()))
