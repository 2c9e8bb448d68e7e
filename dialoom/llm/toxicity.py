"""Toxicity: a bidirectional gated recurrent network with attention pooling.

Every word is read twice, as a hashed word and as the mean of its hashed character
n-grams, so an unseen form of a known stem is known too.  The network reads overlapping
windows; the score of a text is that of its worst window.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm.common import narrow
from dialoom.session import stage_table

# a word without the punctuation around it; longer ones are read in pieces
_TOKEN = re.compile(r"\w(?:\S{0,30}\w)?")
_SPACE = re.compile(r"\s")
_PIECE_CHARS, _PIECE_TOKENS = 1 << 20, 1 << 16
_GROUP_TOKENS, _CACHE = 1 << 17, 1 << 18
_PART = 1 << 13  # tokens whose features are worked out together
_ORDERS = (3, 4, 5)


@dataclass(frozen=True)
class ToxicityOptions:
    """``rows_per_label`` and ``sample_chars`` bound the sample that the network is fitted
    on; all rows are scored, whole texts.  ``min_docs``: words and n-grams of fewer sampled
    documents are not learned, as they would tell the documents apart."""

    rows_per_label: int = 1500
    sample_chars: int = 32_000_000
    window: int = 64
    stride: int = 48
    word_bits: int = 14
    char_bits: int = 16
    word_size: int = 8
    char_size: int = 12
    hidden: int = 8
    attention: int = 8
    epochs: int = 8
    batch: int = 256
    rate: float = 0.05
    embedding_rate: float = 0.02
    min_docs: int = 5
    min_steps: int = 150
    threshold: float = 0.7
    seed: int = 11


# -- words and their features ---------------------------------------------------------


def token_pieces(text: str | None) -> Iterator[list[str]]:
    """Tokens of a text in lower case, in lists of bounded length."""
    text = (text or "").lower()
    begin = 0
    while begin < len(text):
        end = len(text)
        if end - begin > _PIECE_CHARS:
            found = _SPACE.search(text, begin + _PIECE_CHARS, begin + 2 * _PIECE_CHARS)
            end = found.start() if found else min(end, begin + 2 * _PIECE_CHARS)
        tokens = _TOKEN.findall(text, begin, end)
        for start in range(0, len(tokens), _PIECE_TOKENS):
            yield tokens[start : start + _PIECE_TOKENS]
        begin = end


def _hash(points: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` code points from each position on."""
    h = np.full(max(0, len(points) - n + 1), 0x811C9DC5 + n, dtype=np.uint32)
    for k in range(n):
        h = (h ^ points[k : k + len(h)]) * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
    h = h * np.uint32(0x2C1B3C6D)
    return h ^ (h >> np.uint32(16))


def token_features(tokens: Sequence[str], o: ToxicityOptions) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word row of each token; rows of its character n-grams, and where each token's
    n-grams begin (one more entry than tokens).  Every token has at least one."""
    points = np.frombuffer("".join([f"^{t}$" for t in tokens]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    size = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) + 2
    first = np.concatenate(([0], np.cumsum(size)))
    owner = np.repeat(np.arange(len(tokens)), size)
    left = first[owner + 1] - np.arange(len(points))  # code points up to the token's end
    own, rows = [], []
    for n in _ORDERS:
        h = _hash(points, n) >> np.uint32(32 - o.char_bits)
        inside = np.flatnonzero(left[: len(h)] >= n)
        own.append(owner[inside])
        rows.append(h[inside])
    own, rows = np.concatenate(own), np.concatenate(rows)
    order = np.argsort(own, kind="stable")
    begins = np.searchsorted(own[order], np.arange(len(tokens) + 1))
    # a word's hash is the polynomial sum of its code points
    weight = np.cumprod(np.full(int(size.max(initial=1)), 0x9E3779B1, dtype=np.uint32), dtype=np.uint32)
    place = np.arange(len(points)) - first[owner]
    with np.errstate(over="ignore"):
        terms = (points + np.uint32(7)) * weight[place]
    word = np.add.reduceat(terms, first[:-1], dtype=np.uint32) if len(tokens) else np.zeros(0, np.uint32)
    word = (word ^ (word >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    word = (word >> np.uint32(32 - o.word_bits)).astype(np.int32)
    return word, rows[order].astype(np.int32), begins


def _many_features(tokens: Sequence[str], o: ToxicityOptions) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``token_features`` of a whole vocabulary, worked out in parts."""
    parts = [
        token_features(tokens[start : start + _PART], o) for start in range(0, len(tokens), _PART)
    ]
    counts = np.concatenate([np.diff(begins) for *_, begins in parts])
    words, rows = (np.concatenate([part[k] for part in parts]) for k in (0, 1))
    return words, rows, np.concatenate(([0], np.cumsum(counts)))


def window_starts(n: int, o: ToxicityOptions) -> np.ndarray:
    """Where the windows of ``n`` tokens begin: every ``stride`` until all are covered."""
    return np.arange(0, max(1, n - (o.window - o.stride)), o.stride)


def windows(ids: np.ndarray, starts: np.ndarray, o: ToxicityOptions) -> np.ndarray:
    """One row of token ids per window, filled up with 0."""
    padded = np.zeros(int(starts[-1]) + o.window, dtype=np.int32)
    size = min(len(padded), len(ids))
    padded[:size] = ids[:size]
    return np.lib.stride_tricks.sliding_window_view(padded, o.window)[starts]


# -- the network ----------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _initial(o: ToxicityOptions) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(o.seed)
    inputs, h = o.word_size + o.char_size, o.hidden

    def normal(*shape, scale):
        return rng.normal(0.0, scale, shape).astype(np.float32)

    return {
        "word": normal(1 << o.word_bits, o.word_size, scale=0.05),
        "char": normal(1 << o.char_bits, o.char_size, scale=0.05),
        "w": normal(2, inputs, 3 * h, scale=0.4),
        "b": np.zeros((2, 3 * h), dtype=np.float32),
        "u": normal(2, h, 3 * h, scale=0.3),
        "a": normal(2 * h, o.attention, scale=0.3),
        "c": np.zeros(o.attention, dtype=np.float32),
        "v": normal(o.attention, scale=0.3),
        "out": normal(2 * h, scale=0.3),
        "bias": np.zeros(1, dtype=np.float32),
    }


def _inputs(p: dict, features: tuple) -> np.ndarray:
    word, rows, begins = features
    counts = np.diff(begins)
    chars = np.add.reduceat(p["char"][rows], begins[:-1], axis=0) / counts[:, None]
    return np.concatenate((p["word"][word], chars), axis=1).astype(np.float32)


def _project(p: dict, x: np.ndarray) -> np.ndarray:
    """What a token adds to the gates, for both directions; row 0 is the filling."""
    both = np.einsum("vi,dig->vdg", x, p["w"], optimize=True) + p["b"]
    return np.concatenate((np.zeros((1, *both.shape[1:]), np.float32), both.astype(np.float32)))


def _forward(p: dict, table: np.ndarray, ids: np.ndarray, keep: bool = False):
    """Logit of each window; with ``keep`` also what the way back needs."""
    n, t = ids.shape
    h = p["u"].shape[1]
    state = np.zeros((2, n, h), dtype=np.float32)
    states = np.zeros((t, 2, n, h), dtype=np.float32)
    trace = []
    turned = ids[:, ::-1]
    for step in range(t):
        now = np.stack((ids[:, step], turned[:, step]))
        x = np.stack((table[now[0], 0], table[now[1], 1]))
        hu = state @ p["u"]
        gates = _sigmoid(x[..., : 2 * h] + hu[..., : 2 * h])
        z, r = gates[..., :h], gates[..., h:]
        new = np.tanh(x[..., 2 * h :] + r * hu[..., 2 * h :])
        live = (now > 0)[..., None]
        following = np.where(live, new + z * (state - new), state)
        if keep:
            trace.append((state, z, r, new, hu[..., 2 * h :], live, now))
        state = states[step] = following
    # the state of a word: read up to it from the left, and up to it from the right
    both = np.concatenate((states[:, 0], states[::-1, 1]), axis=-1).transpose(1, 0, 2)
    key = np.tanh(both @ p["a"] + p["c"])
    weight = key @ p["v"]
    seen = ids > 0
    weight = np.where(seen, weight, -1e9)
    weight = np.exp(weight - weight.max(axis=1, keepdims=True)) * seen
    weight = weight / np.maximum(weight.sum(axis=1, keepdims=True), 1e-9)
    pooled = (weight[..., None] * both).sum(axis=1)
    logit = pooled @ p["out"] + p["bias"][0]
    return (logit, (trace, both, key, weight, pooled)) if keep else logit


def _backward(p: dict, kept: tuple, d_logit: np.ndarray, table: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the weights and of the rows of the table."""
    trace, both, key, weight, pooled = kept
    h = p["u"].shape[1]
    g = {"out": pooled.T @ d_logit, "bias": np.array([d_logit.sum()], dtype=np.float32)}
    d_pooled = d_logit[:, None] * p["out"]
    d_weight = np.einsum("nth,nh->nt", both, d_pooled)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
    g["v"] = np.einsum("ntk,nt->k", key, d_score)
    d_key = d_score[..., None] * p["v"] * (1 - key * key)
    g["a"] = np.einsum("nth,ntk->hk", both, d_key, optimize=True)
    g["c"] = d_key.sum(axis=(0, 1))
    d_both = weight[..., None] * d_pooled[:, None] + d_key @ p["a"].T
    d_both = d_both.transpose(1, 0, 2)
    t = len(trace)
    g["u"] = np.zeros_like(p["u"])
    d_table = np.zeros_like(table)
    d_state = np.zeros_like(trace[0][0])
    seen, steps = [], []
    for step in range(t - 1, -1, -1):
        state, z, r, new, hu_new, live, now = trace[step]
        d_state = d_state + np.stack((d_both[step, :, :h], d_both[t - 1 - step, :, h:]))
        d = np.where(live, d_state, 0)
        d_new = d * (1 - z) * (1 - new * new)
        d_z = d * (state - new) * z * (1 - z)
        d_r = d_new * hu_new * r * (1 - r)
        d_x = np.concatenate((d_z, d_r, d_new), axis=-1)
        d_hu = np.concatenate((d_z, d_r, d_new * r), axis=-1)
        g["u"] += state.transpose(0, 2, 1) @ d_hu
        d_state = np.where(live, d * z, d_state) + d_hu @ p["u"].transpose(0, 2, 1)
        seen.append(now)
        steps.append(d_x)
    for way in (0, 1):
        used = np.concatenate([now[way] for now in seen])
        order = np.argsort(used, kind="stable")
        rows, begins = np.unique(used[order], return_index=True)
        parts = np.concatenate([d_x[way] for d_x in steps])[order]
        d_table[rows, way] = np.add.reduceat(parts, begins, axis=0)
    return g, d_table[1:]


# -- fitting --------------------------------------------------------------------------


@dataclass
class ToxicityModel:
    """Weights and the calibration ``scale * logit + shift``; ``weights`` None stands for
    the constant score ``base`` of a table without both labels."""

    options: ToxicityOptions
    weights: dict[str, np.ndarray] | None
    scale: float = 1.0
    shift: float = 0.0
    base: float = 0.0
    details: dict = field(default_factory=dict)


class _Scorer:
    """Worst window of each of many texts.  Tokens are projected once; the table of known
    tokens has a bounded number of rows and starts anew when it is full."""

    _BATCH = 1024

    def __init__(self, weights: dict, options: ToxicityOptions):
        self.p, self.o = weights, options
        self.known: dict[str, int] = {}
        self.table = np.zeros((_CACHE + 1, 2, 3 * options.hidden), dtype=np.float32)
        self.best = np.zeros(0)
        self.rows: list[np.ndarray] = []
        self.owners: list[np.ndarray] = []
        self.waiting = 0

    def _learn(self, tokens: set[str]) -> None:
        """Rows of the table for these tokens; there are fewer than the table has rows."""
        new = [t for t in tokens if t not in self.known]
        if len(self.known) + len(new) > _CACHE:
            self._flush()
            self.known = {}
            new = list(tokens)
        for start in range(0, len(new), _PART):
            part = new[start : start + _PART]
            at = len(self.known) + 1
            rows = _project(self.p, _inputs(self.p, token_features(part, self.o)))[1:]
            self.table[at : at + len(part)] = rows
            self.known.update(zip(part, range(at, at + len(part)), strict=True))

    def _add(self, owner: int, rows: np.ndarray) -> None:
        self.rows.append(rows)
        self.owners.append(np.full(len(rows), owner))
        self.waiting += len(rows)
        if self.waiting >= 4 * self._BATCH:
            self._flush()

    def _flush(self) -> None:
        if not self.waiting:
            return
        rows, owners = np.concatenate(self.rows), np.concatenate(self.owners)
        for start in range(0, len(rows), self._BATCH):
            part = slice(start, start + self._BATCH)
            np.maximum.at(self.best, owners[part], _forward(self.p, self.table, rows[part]))
        self.rows, self.owners, self.waiting = [], [], 0

    def _work(self, group: list[tuple[int, list[str], bool]], rest: list[str]) -> list[str]:
        """Windows of some pieces of texts; ``rest`` is the end of a text that goes on."""
        o = self.o
        self._learn(set(rest).union(*(tokens for _, tokens, _ in group)))
        for owner, tokens, last in group:
            rest = rest + tokens
            # the last windows of a piece wait for the next one
            size = len(rest)
            starts = window_starts(size, o) if last else np.arange(0, size - o.window - o.stride, o.stride)
            if not len(starts):
                continue
            ids = np.fromiter(map(self.known.__getitem__, rest), dtype=np.int32, count=size)
            self._add(owner, windows(ids, starts, o))
            rest = [] if last else rest[int(starts[-1]) + o.stride :]
        return rest

    def logits(self, texts: Sequence[str | None]) -> np.ndarray:
        self.best = np.full(len(texts), -np.inf)
        group, waiting, rest = [], 0, []
        for i, text in enumerate(texts):
            held: list[str] = []
            for piece in token_pieces(text):
                if held:
                    group.append((i, held, False))
                    waiting += len(held)
                    if waiting >= _GROUP_TOKENS:
                        rest = self._work(group, rest)
                        group, waiting = [], 0
                held = piece
            group.append((i, held, True))
            waiting += len(held)
            if waiting >= _GROUP_TOKENS:
                rest = self._work(group, rest)
                group, waiting = [], 0
        self._work(group, rest)
        self._flush()
        return self.best


def _log_odds(seen: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Cautious log odds of label 1 from ``seen[label, row]``, the documents that hold it."""
    zeros, ones = seen
    n = max(1, (labels == 0).sum()), max(1, (labels == 1).sum())
    odds = np.log((ones + 0.5) / (n[1] + 1.0)) - np.log((zeros + 0.5) / (n[0] + 1.0))
    # only as much as two standard errors leave of it, so rare rows say nothing
    error = np.sqrt(1 / (ones + 0.5) + 1 / (zeros + 0.5))
    return (np.sign(odds) * np.clip(np.abs(odds) - 2 * error, 0, 3)).astype(np.float32)


class _Adam:
    """Steps for the dense weights; embeddings take Adagrad steps on the rows they use."""

    def __init__(self, p: dict, o: ToxicityOptions):
        self.p, self.o, self.t = p, o, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items() if k not in ("word", "char")}
        self.s = {k: np.zeros_like(v) for k, v in p.items()}
        self.learned: dict[str, np.ndarray] = {}

    def dense(self, g: dict) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        clip = min(1.0, 5.0 / (norm + 1e-9))
        for k, x in g.items():
            x = x * clip
            self.m[k] = 0.9 * self.m[k] + 0.1 * x
            self.s[k] = 0.99 * self.s[k] + 0.01 * x * x
            m, s = self.m[k] / (1 - 0.9**self.t), self.s[k] / (1 - 0.99**self.t)
            self.p[k] -= (self.o.rate * m / (np.sqrt(s) + 1e-8)).astype(np.float32)

    def rows(self, name: str, rows: np.ndarray, gradient: np.ndarray) -> None:
        keep = self.learned[name][rows]
        rows, gradient = rows[keep], gradient[keep]
        if not len(rows):
            return
        used, at = np.unique(rows, return_inverse=True)
        order = np.argsort(at, kind="stable")
        begins = np.searchsorted(at[order], np.arange(len(used)))
        g = np.add.reduceat(gradient[order], begins, axis=0)
        self.s[name][used] += g * g
        self.p[name][used] -= self.o.embedding_rate * g / (np.sqrt(self.s[name][used]) + 1e-6)


def _slice_features(features: tuple, tokens: np.ndarray) -> tuple:
    word, rows, begins = features
    counts = np.diff(begins)[tokens]
    ends = np.cumsum(counts)
    at = np.arange(counts.sum()) - np.repeat(ends - counts, counts) + np.repeat(begins[tokens], counts)
    return word[tokens], rows[at], np.concatenate(([0], ends))


def _all_inputs(p: dict, features: tuple) -> np.ndarray:
    """``_inputs`` of a whole vocabulary, in parts of bounded memory."""
    n = len(features[0])
    parts = [
        _inputs(p, _slice_features(features, np.arange(start, min(n, start + _PART))))
        for start in range(0, n, _PART)
    ]
    return np.concatenate(parts)


def _calibrate(logits: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Scale and shift of least weighted loss, Platt's smoothed targets, by Newton steps;
    a weak pull to scale 1 and shift 0 keeps them finite."""
    ones, zeros = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack((logits, np.ones_like(logits)), axis=1)
    theta = np.array([1.0, 0.0])
    weight = weight / weight.mean()

    def loss(at):
        z = x @ at
        return float((weight * (np.logaddexp(0, z) - target * z)).sum() + 0.05 * ((at - [1, 0]) ** 2).sum())

    for _ in range(50):
        q = 1 / (1 + np.exp(-(x @ theta)))
        gradient = x.T @ (weight * (q - target)) + 0.1 * (theta - [1.0, 0.0])
        hessian = (x * (weight * q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(2)
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while size > 1e-4 and loss(theta - size * step) > loss(theta):
            size /= 2
        theta = theta - size * step
    return float(max(theta[0], 1e-3)), float(theta[1])


def fit_toxicity(
    texts: Sequence[str | None],
    labels: Sequence[int],
    population: tuple[int, int] | None = None,
    options: ToxicityOptions | None = None,
) -> ToxicityModel:
    """Fit on labelled texts, in the given order; every fourth row of a label is kept from
    the weights and calibrates.  ``population`` holds how many rows of label 0 and 1 there
    are in all, which the calibration is weighted to.

    A toxic text need hold only one toxic window.  So each round the network reads of a
    toxic text the window that it thinks worst, and of a clean one that window and one by
    chance; before the first round, log odds of words and n-grams, with which one input of
    each embedding begins, choose.
    """
    o = options or ToxicityOptions()
    y = np.asarray(labels, dtype=np.int64)
    population = population or (int((y == 0).sum()), int((y == 1).sum()))
    base = population[1] / max(1, sum(population))
    if not (y == 0).any() or not (y == 1).any():
        return ToxicityModel(o, None, base=base if len(y) else 0.0)
    rank = np.zeros(len(y), dtype=np.int64)
    for label in (0, 1):
        rank[y == label] = np.arange((y == label).sum())
    held = (rank % 4 == 3) & (min((y == 0).sum(), (y == 1).sum()) >= 8)

    known: dict[str, int] = {}
    coded = []
    for text in texts:
        ids = [
            np.fromiter((known.setdefault(t, len(known) + 1) for t in piece), np.int32, len(piece))
            for piece in token_pieces(text)
        ]
        coded.append(np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32))
    features = _many_features(list(known) or ["-"], o)
    fit = np.flatnonzero(~held)
    p = _initial(o)
    adam = _Adam(p, o)
    seen = {name: np.zeros((2, len(p[name])), dtype=np.int64) for name in ("word", "char")}
    for d in fit:
        held_words, held_chars, _ = _slice_features(features, np.unique(coded[d]) - 1)
        seen["word"][y[d], np.unique(held_words)] += 1
        seen["char"][y[d], np.unique(held_chars)] += 1
    for name, counts in seen.items():
        p[name][:, 0] += _log_odds(counts, y[fit])
        adam.learned[name] = counts.sum(axis=0) >= o.min_docs
    x = _all_inputs(p, features)
    guess = np.concatenate(([-9.0], x[:, 0] + 2 * x[:, o.word_size]))
    read = [windows(ids, window_starts(len(ids), o), o) for ids in coded]
    order = np.concatenate([np.full(len(r), d) for d, r in enumerate(read)])
    every = np.concatenate(read)
    first = np.searchsorted(order, np.arange(len(y) + 1))

    def logits_of(chosen: np.ndarray) -> np.ndarray:
        table = _project(p, _all_inputs(p, features))
        return np.concatenate(
            [_forward(p, table, every[chosen[i : i + 1024]]) for i in range(0, len(chosen), 1024)]
        )

    rng = np.random.default_rng(o.seed)
    mine = np.flatnonzero(~held[order])
    score = np.full(len(every), -np.inf)
    # a small sample takes as many steps as a large one, up to eight times the rounds
    steps = -(-(len(fit) + int((y[fit] == 0).sum())) // o.batch)
    rounds = min(8 * o.epochs, max(o.epochs, -(-o.min_steps // steps)))
    for turn in range(rounds):
        if turn == 0:
            score[mine] = guess[every[mine]].max(axis=1)
        elif turn < 3 or turn % 3 == 0:
            score[mine] = logits_of(mine)
        worst = np.array([first[d] + score[first[d] : first[d + 1]].argmax() for d in fit])
        clean = fit[y[fit] == 0]
        other = first[clean] + (rng.random(len(clean)) * (first[clean + 1] - first[clean])).astype(int)
        chosen, target = np.concatenate((worst, other)), np.concatenate((y[fit], np.zeros(len(clean))))
        weight = np.where(target == 1, 0.5 / (target == 1).mean(), 0.5 / (target == 0).mean())
        shuffled = rng.permutation(len(chosen))
        for start in range(0, len(shuffled), o.batch):
            at = shuffled[start : start + o.batch]
            ids = every[chosen[at]]
            used, local = np.unique(ids, return_inverse=True)
            used = used[used > 0]
            if not len(used):
                continue
            local = local.reshape(ids.shape) + (0 if (ids == 0).any() else 1)
            part = _slice_features(features, used - 1)
            x = _inputs(p, part)
            table = _project(p, x)
            logit, kept = _forward(p, table, local, keep=True)
            d = ((_sigmoid(logit) - target[at]) * weight[at] / len(at)).astype(np.float32)
            g, d_table = _backward(p, kept, d, table)
            g["w"] = np.einsum("vi,vdg->dig", x, d_table, optimize=True)
            g["b"] = d_table.sum(axis=0)
            d_x = np.einsum("vdg,dig->vi", d_table, p["w"], optimize=True)
            adam.dense(g)
            adam.rows("word", part[0], d_x[:, : o.word_size])
            counts = np.diff(part[2])
            adam.rows("char", part[1], np.repeat(d_x[:, o.word_size :] / counts[:, None], counts, axis=0))
    last = held if held.any() else np.ones(len(y), dtype=bool)
    score = logits_of(np.arange(len(every)))
    logit = np.maximum.reduceat(score, first[:-1])
    shares = np.bincount(y[last], minlength=2)
    weight = np.array(population, dtype=float)[y[last]] / shares[y[last]]
    scale, shift = _calibrate(logit[last].astype(float), y[last], weight)
    details = {"fit": int((~held).sum()), "calibrated": int(last.sum()), "rounds": rounds}
    return ToxicityModel(o, p, scale, shift, base, details)


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    options: ToxicityOptions | None = None,
) -> ToxicityModel:
    """A model of the labelled rows whose ``remainder`` is not 1.

    An id is toxic if any of its label rows says 1; null labels do not count.  Equal rows
    count once.  The sample of a label is its rows with the smallest hashes: a limit on the
    hash, from the number of rows, keeps all others out before anything is collected.
    """
    o = options or ToxicityOptions()
    marks = (
        labels.select(F.col("doc_id"), F.col(f"`{label_col}`").alias("toxic"))
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .filter(remainder(F.col("doc_id")) != 1)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    rows = narrow(docs, doc_id=id_col, text=text_col)
    hashed = rows.select("doc_id", F.xxhash64("text").alias("content"))
    labelled = (
        hashed.join(marks, "doc_id")
        .groupBy("doc_id", "content")
        .agg(F.max("toxic").alias("toxic"))
        .withColumn("place", F.xxhash64("doc_id", "content", F.lit(o.seed)))
    )
    labelled = stage_table(labelled, "labelled")
    counted = {r.toxic: r.n for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    population = counted.get(0, 0), counted.get(1, 0)
    near = F.lit(False)
    for label, n in enumerate(population):
        # on average a quarter more rows than needed lie below the limit
        share = min(1.0, (1.25 * o.rows_per_label + 50) / max(1, n))
        limit = F.lit(int(-(2**63) + share * (2**64 - 2**12)))
        near = near | ((F.col("toxic") == label) & (F.col("place") <= limit))
    found = labelled.filter(near).toPandas()
    found = found.sort_values(["place", "doc_id", "content"])
    found = found[found.groupby("toxic").cumcount() < o.rows_per_label]
    if found.empty:
        return fit_toxicity([], [], population, o)
    spark = docs.sparkSession
    # at most two times rows_per_label rows
    chosen = F.broadcast(
        spark.createDataFrame(found[["doc_id", "content"]], labelled.select("doc_id", "content").schema)
    )
    keyed = rows.withColumn("content", F.xxhash64("text"))
    texts = (
        keyed.join(chosen, ["doc_id", "content"])
        .groupBy("doc_id", "content")
        .agg(F.first("text").alias("text"))
        .toPandas()
    )
    sample = found.merge(texts, on=["doc_id", "content"]).sort_values(["place", "doc_id", "content"])
    size = sample["text"].fillna("").str.len()
    fits = size.groupby(sample["toxic"]).cumsum() <= o.sample_chars // 2
    sample = sample[fits]
    return fit_toxicity(sample["text"].tolist(), sample["toxic"].tolist(), population, o)


def toxicity_column(model: ToxicityModel, text: Column, spark: SparkSession) -> Column:
    """Score of a text column, 0 to 1.  The model has a fixed size and is shipped once per
    executor."""
    shipped = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shipped.value
        scorer = _Scorer(m.weights, m.options) if m.weights else None
        for batch in batches:
            if scorer is None:
                yield pd.Series(np.full(len(batch), m.base))
            else:
                z = m.scale * scorer.logits(batch.tolist()) + m.shift
                yield pd.Series(1 / (1 + np.exp(-np.clip(z, -500, 500))))

    return score(text)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    options: ToxicityOptions | None = None,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, over all windows of its text.

    Only the text is read for a score, so repeated rows score alike.  Null and empty texts
    are one empty window.  Without both labels among the training rows the score is the
    share of label 1, 0 without any label; an empty table gives an empty result.
    """
    o = options or ToxicityOptions()
    model = train_toxicity(docs, labels, id_col, text_col, label_col, o)
    rows = narrow(docs, doc_id=id_col, text=text_col)
    return rows.select(
        "doc_id",
        (remainder(F.col("doc_id")) == 1).alias("held_out"),
        toxicity_column(model, F.col("text"), docs.sparkSession).alias("score"),
    ).withColumn("predicted", (F.col("score") >= o.threshold).cast("int"))
