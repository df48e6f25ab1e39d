"""Maximal periodic runs of words by descending-LCP Kruskal.

Suffixes that share their first l words form a class. Neighbours in the
suffix array are edges weighted by their longest common prefix (LCP); taking
the edges by decreasing LCP, a union-find unites classes whose positions are
kept in order, the smaller set going into the larger one. Two positions
s < t that become neighbours in a set at LCP l share exactly l words, so the
words from s on repeat with period t - s over l + (t - s) words; no smaller
period fits, else a position between them would have been united earlier.
Where the word before s breaks the period, s is the run's start, and the run
is found there once.

All documents of a batch are sorted together: a word's symbol holds its
document, so suffixes of different documents share nothing. The suffix array
and the LCPs come from prefix doubling over numpy arrays, without a row per
word outside the task. A document none of whose shortest seeds (``least``
words) occurs twice has no run and is not sorted at all.

Defined results: a null, empty or blank text has no words, no runs and the
empty collapsed text; very long texts are handled whole; repeated rows are
treated each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revmart.llm.common import WORD, limited

RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def least_seed(min_length: int, exponent: int) -> int:
    """The smallest LCP at which some period makes a run: period + LCP >= max(min_length, exponent * period)."""
    lcp = 1
    while min_length - lcp > lcp // (exponent - 1) or lcp < exponent - 1:
        lcp += 1
    return lcp


def _repeating(words: np.ndarray, doc: np.ndarray, n_docs: int, least: int) -> np.ndarray:
    """Per document: whether ``least`` words in a row occur twice (by hash: a false yes is possible, a false no not)."""
    out = np.zeros(n_docs, dtype=bool)
    n = len(words) - least + 1
    if n <= 0:
        return out
    with np.errstate(over="ignore"):
        h = np.zeros(n, dtype=np.uint64)
        for k in range(least):
            h = (h ^ words[k:k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        h = (h ^ doc[:n].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    inside = np.flatnonzero(doc[:n] == doc[least - 1:])
    order = inside[np.argsort(h[inside], kind="stable")]
    twice = h[order[1:]] == h[order[:-1]]
    out[doc[order[1:]][twice]] = True
    return out


def suffix_order(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and the LCP of each suffix with the one before it.

    ends: per position the end of its document; suffixes end there. Equal
    symbols must lie in one document. The ranks of all doublings are kept, so
    that the LCPs can be put together from powers of two.
    """
    n = len(symbols)
    at = np.arange(n)
    levels = [np.unique(symbols, return_inverse=True)[1].astype(np.int32)]
    while levels[-1].max(initial=-1) < n - 1:
        rank, step = levels[-1].astype(np.int64), 1 << (len(levels) - 1)
        beyond = at + step
        second = np.where(beyond < ends, rank[np.minimum(beyond, n - 1)] + 1, 0)
        levels.append(np.unique(rank * (n + 1) + second, return_inverse=True)[1].astype(np.int32))
    order = np.empty(n, dtype=np.int64)
    order[levels[-1]] = at
    a, b = order[:-1].copy(), order[1:].copy()
    end_a, end_b = ends[a], ends[b]
    lcp = np.zeros(max(0, n - 1), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):  # equal ranks at level k: 2**k words are the same
        same = (a < end_a) & (b < end_b)
        same &= levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)]
        for array in (a, b, lcp):
            array[same] += 1 << k
    return order, np.concatenate(([0], lcp))[:n]


def runs_by_lcp(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, min_length: int = 6,
                exponent: int = 4) -> list[tuple[int, int, int]]:
    """(position, length, period) of every maximal run of at least ``min_length`` words and ``exponent`` periods.

    starts, ends: per position the bounds of its document.
    """
    order, lcp = suffix_order(symbols, ends)
    edges = np.flatnonzero(lcp >= least_seed(min_length, exponent))
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    root: dict[int, int] = {}
    sets: dict[int, list[int]] = {}
    found: list[tuple[int, int, int]] = []

    def find(x: int) -> int:
        top = x
        while (up := root.setdefault(top, top)) != top:
            top = up
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for i, j, l in zip(order[edges - 1].tolist(), order[edges].tolist(), lcp[edges].tolist()):
        a, b = find(i), find(j)
        large, small = sets.get(a) or [a], sets.pop(b, None) or [b]
        if len(large) < len(small):
            large, small = small, large
        for x in small:
            insort(large, x)
        root[b] = a
        sets[a] = large
        longest, shortest = l // (exponent - 1), min_length - l  # of the periods that make a run at this LCP
        came = set(small) if len(small) > 1 else small
        for x in small:
            k = bisect_left(large, x)
            if k and shortest <= x - large[k - 1] <= longest and large[k - 1] not in came:
                found.append((large[k - 1], l, x - large[k - 1]))
            if k + 1 < len(large) and shortest <= large[k + 1] - x <= longest and large[k + 1] not in came:
                found.append((x, l, large[k + 1] - x))
    return [(s, l + q, q) for s, l, q in found if s == starts[s] or symbols[s - 1] != symbols[s - 1 + q]]


def runs_of(docs: list[list[bytes]], min_length: int = 6, exponent: int = 4) -> list[list[tuple[int, int, int]]]:
    """Per document (a list of words): its runs (start, length, period), by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    sizes = np.array([len(d) for d in docs], dtype=np.int64)
    flat = pa.array([w for d in docs for w in d], pa.binary()).dictionary_encode()
    words = flat.indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(docs)), sizes)
    active = _repeating(words, doc, len(docs), least_seed(min_length, exponent))
    chosen = active[doc]
    if not chosen.any():
        return out
    sizes = np.where(active, sizes, 0)
    last = np.cumsum(sizes)
    first, doc = np.repeat(last - sizes, sizes), doc[chosen]
    symbols = doc * max(1, len(flat.dictionary)) + words[chosen]
    for s, length, period in runs_by_lcp(symbols, first, np.repeat(last, sizes), min_length, exponent):
        out[doc[s]].append((s - int(first[s]), length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run holds behind its first period, joined by one space."""
    if runs:
        change = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, period in runs:
            change[start + period] += 1
            change[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    return b" ".join(words).decode("utf-8", "replace")


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6,
                  exponent: int = 4) -> DataFrame:
    """Per row: doc_id, n_words, runs (start, length, period; by start, then period) and the collapsed text."""
    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in limited(batches, "text", 2_000_000):
            words = [t.encode("utf-8", "replace").split() if t else [] for t in batch.column("text").to_pylist()]
            runs = runs_of(words, min_length, exponent)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(w) for w in words], pa.int64()),
                 pa.array([[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in runs], pa.list_(run)),
                 pa.array(map(collapse, words, runs), pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(detect, RUNS)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document (by the id's hash) repeats some of its words from a place on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({WORD})")))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", words.alias("words"),
                       F.floor(h / 10).alias("g"), F.size(words).alias("n"))
    rows = rows.select("*", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int").alias("a"))
    rows = rows.select("*", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int").alias("p"))
    rest = F.col("n") - F.col("a")
    block = F.slice("words", F.col("a") + 1, F.least("p", rest))
    again = F.slice(F.flatten(F.array_repeat(block, F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), again), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def _greatest(runs: str) -> Column:
    """The run of greatest length / period; the first of equals stays."""
    def better(best: Column, run: Column) -> Column:
        more = best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
        return F.when(more, run).otherwise(best)
    return F.reduce(runs, F.lit(None).cast("struct<start: long, length: long, period: long>"), better)


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the greatest run, and SHA-256 of the list of runs and of the collapsed text."""
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"),
                                                  F.lit(","), r["period"].cast("string"), F.lit("\n")))
    rows = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), _greatest("runs").alias("best"),
                        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"),
                       F.col("best.period").alias("period"),
                       F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")
