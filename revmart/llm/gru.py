"""A small bidirectional GRU with attention pooling over word and character inputs, in numpy.

A token's input is its hashed word embedding beside the mean of its hashed
character n-gram embeddings (3 to 5 characters, with word boundaries, so
unseen words share parts with seen ones). The forward and backward states
of every position are pooled by a learned softmax attention; the pooled
state gives the window's logit.

Windows are rows of token ids, longest first; rows shorter than the widest
one simply stop being active, so no padding enters a state.
"""

from __future__ import annotations

import zlib

import numpy as np

PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def init_params(seed: int = 1, words: int = 1 << 14, grams: int = 1 << 15, d_word: int = 12, d_char: int = 20,
                hidden: int = 12) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    d = d_word + d_char
    draw = lambda *s, scale=1.0: (rng.standard_normal(s) * scale).astype(np.float32)
    p = {"word": draw(words, d_word, scale=0.1), "gram": draw(grams, d_char, scale=0.3)}
    for way in "fb":  # forward, backward; gates: update, reset, new
        p["W" + way] = draw(d, 3 * hidden, scale=d**-0.5)
        p["U" + way] = draw(hidden, 3 * hidden, scale=hidden**-0.5)
        p["b" + way] = np.zeros(3 * hidden, np.float32)
    p |= {"att": draw(2 * hidden, scale=0.1), "out": draw(2 * hidden, scale=0.3), "bias": np.zeros(1, np.float32)}
    return p


def token_features(tokens: list[str], words: int, grams: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: the word's bucket; flat n-gram buckets and where each token's begin."""
    parts = [_features(tokens[i:i + 10_000], words, grams) for i in range(0, len(tokens), 10_000)]
    before = np.cumsum([0] + [len(ids) for _, ids, _ in parts])
    return (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]),
            np.concatenate([p[2] + at for p, at in zip(parts, before)]))


def _features(tokens: list[str], words: int, grams: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bare = [t.strip(PUNCT) or t for t in tokens]
    word = np.array([zlib.crc32(t.encode("utf-8", "replace")) for t in bare], dtype=np.int64) % words
    chars = np.frombuffer("".join(f"^{t}$" for t in bare).encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    sizes = np.array([len(t) + 2 for t in bare])
    owner = np.repeat(np.arange(len(bare)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(chars))  # characters from here to the token's end
    ids, of = [], []
    code = np.zeros(len(chars), dtype=np.uint64)
    for n in range(1, 6):
        m = len(chars) - n + 1
        if m <= 0:
            break
        code = (code[:m] * np.uint64(0x9E3779B97F4A7C15)) ^ (chars[n - 1:] + np.uint64(n))
        if n >= 3:
            fits = left[:m] >= n
            buckets = ((code * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(33)) % np.uint64(grams)
            ids.append(buckets[fits].astype(np.int32))
            of.append(owner[:m][fits])
    ids, of = np.concatenate(ids), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return word, ids[order], np.searchsorted(of[order], np.arange(len(bare)))


def inputs(p: dict, features: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Token inputs: word embedding and mean n-gram embedding."""
    word, ids, starts = features
    counts = np.diff(np.append(starts, len(ids)))[:, None]
    chars = np.add.reduceat(p["gram"][ids], starts, axis=0) / counts
    return np.concatenate((p["word"][word], chars), axis=1).astype(np.float32)


def pick(features: tuple[np.ndarray, np.ndarray, np.ndarray], tokens: np.ndarray) -> tuple:
    """The features of some of the tokens."""
    word, ids, starts = features
    sizes = np.diff(np.append(starts, len(ids)))[tokens]
    begin = np.cumsum(sizes) - sizes
    at = np.repeat(starts[tokens] - begin, sizes) + np.arange(sizes.sum())
    return word[tokens], ids[at], begin


def _sum_by(ids: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids and the sums of their rows."""
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    return ids[first], np.add.reduceat(values[order], first, axis=0)


def gates(p: dict, x: np.ndarray) -> np.ndarray:
    """What a token adds to the gates of both directions; independent of its place."""
    return np.concatenate((x @ p["Wf"] + p["bf"], x @ p["Wb"] + p["bb"]), axis=1)


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


def _active(lengths: np.ndarray, width: int) -> list[int]:
    return [int(np.searchsorted(-lengths, -t, side="left")) for t in range(width)]


def _run(g: np.ndarray, X: np.ndarray, U: np.ndarray, active: list[int], times, keep: list | None) -> np.ndarray:
    """States (width x rows x hidden) of one direction; ``keep`` collects what the backward pass needs."""
    n, k = len(X), U.shape[0]
    states = np.zeros((len(active), n, k), np.float32)
    h = np.zeros((n, k), np.float32)
    for t in times:
        m = active[t]
        gx, before = g[X[:m, t]], h[:m].copy()
        hu = before @ U
        zr = _sigmoid(gx[:, :2 * k] + hu[:, :2 * k])
        z, r = zr[:, :k], zr[:, k:]
        new = np.tanh(gx[:, 2 * k:] + r * hu[:, 2 * k:])
        h[:m] = new + z * (before - new)
        states[t, :m] = h[:m]
        if keep is not None:
            keep.append((t, m, before, hu[:, 2 * k:], z, r, new))
    return states


def _pool(p: dict, H: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = np.arange(len(H))[:, None] < lengths[None, :]
    e = np.where(inside, H @ p["att"], -np.inf)
    w = np.exp(e - e.max(axis=0))
    w /= w.sum(axis=0)
    pooled = (w[:, :, None] * H).sum(axis=0)
    return w, pooled, pooled @ p["out"] + p["bias"][0]


def logits(p: dict, g: np.ndarray, X: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Logits of windows (rows of X, longest first) over tokens with gate inputs ``g``."""
    width, k3 = X.shape[1], p["Uf"].shape[1]
    active = _active(lengths, width)
    H = np.concatenate((_run(g[:, :k3], X, p["Uf"], active, range(width), None),
                        _run(g[:, k3:], X, p["Ub"], active, range(width - 1, -1, -1), None)), axis=2)
    return _pool(p, H, lengths)[2]


def _back(dstates: np.ndarray, keep: list, U: np.ndarray, X: np.ndarray) -> tuple[np.ndarray, list, list]:
    """Backward pass of one direction: the gradient of U, and tokens with their gate gradients."""
    dU, tokens, rows = np.zeros_like(U), [], []
    dh = np.zeros(dstates.shape[1:], dstates.dtype)
    for t, m, before, hn, z, r, new in reversed(keep):
        d = dh[:m] + dstates[t, :m]
        dnew = d * (1 - z) * (1 - new * new)
        dz = d * (before - new) * z * (1 - z)
        dr = dnew * hn * r * (1 - r)
        tokens.append(X[:m, t])
        rows.append(np.concatenate((dz, dr, dnew), axis=1))
        dhu = np.concatenate((dz, dr, dnew * r), axis=1)
        dU += before.T @ dhu
        dh[:m] = d * z + dhu @ U.T
    return dU, tokens, rows


def gradients(p: dict, features: tuple, X: np.ndarray, lengths: np.ndarray,
              y: np.ndarray) -> tuple[float, dict]:
    """Mean logistic loss of labelled windows and its gradients (embeddings: rows and their gradients)."""
    word, ids, starts = features
    x = inputs(p, features)
    g, width, k3 = gates(p, x), X.shape[1], p["Uf"].shape[1]
    active, kf, kb = _active(lengths, width), [], []
    H = np.concatenate((_run(g[:, :k3], X, p["Uf"], active, range(width), kf),
                        _run(g[:, k3:], X, p["Ub"], active, range(width - 1, -1, -1), kb)), axis=2)
    w, pooled, z = _pool(p, H, lengths)
    loss = float(np.mean(np.logaddexp(0, z) - y * z))
    dz = ((_sigmoid(z) - y) / len(y)).astype(np.float32)
    grad = {"bias": np.array([dz.sum()], np.float32), "out": pooled.T @ dz}
    dpooled = dz[:, None] * p["out"]
    de = w * ((H * dpooled).sum(axis=2) - (pooled * dpooled).sum(axis=1))
    grad["att"] = np.tensordot(de, H, axes=([0, 1], [0, 1]))
    dH, k = w[:, :, None] * dpooled + de[:, :, None] * p["att"], k3 // 3
    dx = 0
    for way, states, keep in (("f", dH[:, :, :k], kf), ("b", dH[:, :, k:], kb)):
        grad["U" + way], tokens, rows = _back(states, keep, p["U" + way], X)
        used, dg = _sum_by(np.concatenate(tokens), np.concatenate(rows))
        full = np.zeros((len(x), k3), dg.dtype)
        full[used] = dg
        grad |= {"W" + way: x.T @ full, "b" + way: full.sum(axis=0)}
        dx = dx + full @ p["W" + way].T
    d_word = p["word"].shape[1]
    counts = np.diff(np.append(starts, len(ids)))
    grad["word"] = _sum_by(word, dx[:, :d_word])
    grad["gram"] = _sum_by(ids, np.repeat(dx[:, d_word:] / counts[:, None], counts, axis=0))
    return loss, grad


class Adam:
    def __init__(self, p: dict, rate: float) -> None:
        self.rate, self.t = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, p: dict, grad: dict) -> None:
        """Embedding rows without a gradient stay as they are."""
        self.t += 1
        fix = self.rate * np.sqrt(1 - 0.99**self.t) / (1 - 0.9**self.t)
        for k, d in grad.items():
            at, d = d if isinstance(d, tuple) else (slice(None), d)
            m = self.m[k][at] * 0.9 + 0.1 * d
            v = self.v[k][at] * 0.99 + 0.01 * d * d
            self.m[k][at], self.v[k][at] = m, v
            p[k][at] -= fix * m / (np.sqrt(v) + 1e-8)
