"""A small gated recurrent language model in numpy, trained by truncated backpropagation.

Tokens are numbered: HEAD * WIDTH frequent words with an output of their own in HEAD classes of WIDTH words, then classes whose
words share one output. The output is factored: a softmax over classes, and for the first HEAD classes a softmax over the words of the class.
Texts are laid end to end on lanes that run side by side; the state is carried from window to window and starts anew at each text.
"""

from __future__ import annotations

import numpy as np

WIDTH, HEAD, TAIL = 32, 12, 12
FRONT = HEAD * WIDTH
TOKENS, CLASSES = FRONT + TAIL, HEAD + TAIL
HIDDEN = 16
STEPS = 16  # of truncated backpropagation
LIMIT = 60.0  # of logits, so that a softmax needs no maximum
LANES = 512
SHAPES = {"inputs": (TOKENS, 3 * HIDDEN), "recur": (HIDDEN, 3 * HIDDEN), "to_class": (HIDDEN, CLASSES), "class_bias": (CLASSES,), "to_word": (HEAD, HIDDEN, WIDTH), "word_bias": (HEAD, WIDTH)}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    """Views into a flat vector."""
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at : at + n].reshape(shape)
        at += n
    return out


def initial(counts: np.ndarray, seed: int = 1) -> np.ndarray:
    """Parameters that give each token its share of `counts`, whatever went before."""
    flat = (np.random.default_rng(seed).standard_normal(SIZE) * 0.1).astype(np.float32)
    p, counts = unpack(flat), counts + 0.1
    words = counts[:FRONT].reshape(HEAD, WIDTH)
    p["class_bias"][:] = np.log(np.concatenate((words.sum(1), counts[FRONT:])) / counts.sum())
    p["word_bias"][:] = np.log(words / words.sum(1, keepdims=True))
    p["to_class"][:] *= 0.1
    p["to_word"][:] *= 0.1
    return flat


def lanes(sizes: np.ndarray, most: int = LANES) -> list[np.ndarray]:
    """Spread texts over lanes of about equal length, longest first."""
    order = np.argsort(-sizes, kind="stable")
    n = int(min(most, max(1, -(-sizes.sum() // max(sizes.max(), 1)))))
    out, load = [[] for _ in range(n)], np.zeros(n, np.int64)
    for k in order:
        lane = int(load.argmin())
        out[lane].append(k)
        load[lane] += sizes[k]
    return [np.array(x, np.int64) for x in out]


def laid_out(texts: list[np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Steps x lanes: the token to come, the token before (end at the start), and the text it belongs to (-1: none). Texts end with `end`."""
    sizes = np.array([len(t) for t in texts])
    rows = lanes(sizes)
    deep = max(int(sizes[r].sum()) for r in rows)
    target, text = np.zeros((deep, len(rows)), np.int32), np.full((deep, len(rows)), -1, np.int32)
    for k, row in enumerate(rows):
        if len(row):
            n = int(sizes[row].sum())
            target[:n, k], text[:n, k] = np.concatenate([texts[i] for i in row]), np.repeat(row, sizes[row])
    before = np.full_like(target, end)
    before[1:] = target[:-1]
    return target, before, text


def forward(p: dict, h: np.ndarray, before: np.ndarray, end: int) -> tuple[np.ndarray, tuple]:
    """Hidden states after each step of a window, and what going back needs."""
    x = p["inputs"][before]
    keep = (before != end).astype(np.float32)[..., None]
    gates, new = p["recur"][:, : 2 * HIDDEN], p["recur"][:, 2 * HIDDEN :]
    out = np.empty((*before.shape, HIDDEN), np.float32)
    zr_all, c_all, old = np.empty((*before.shape, 2 * HIDDEN), np.float32), np.empty_like(out), np.empty_like(out)
    for t in range(len(before)):
        h = np.multiply(h, keep[t], out=old[t])
        zr = zr_all[t]
        np.matmul(h, gates, out=zr)
        zr += x[t, :, : 2 * HIDDEN]
        np.negative(zr, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        c = c_all[t]
        np.matmul(zr[:, HIDDEN:] * h, new, out=c)
        c += x[t, :, 2 * HIDDEN :]
        np.tanh(c, out=c)
        h = np.add(h, zr[:, :HIDDEN] * (c - h), out=out[t])
    return out, (zr_all, c_all, old, keep)


def class_of(token: np.ndarray) -> np.ndarray:
    return np.where(token < FRONT, token // WIDTH, token - FRONT + HEAD).astype(np.int16)


def softmax_at(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-probability of one entry of each row, and all probabilities."""
    np.clip(x, -LIMIT, LIMIT, out=x)
    got = x[np.arange(len(x)), at]
    e = np.exp(x, out=x)
    total = e @ np.ones(e.shape[1], e.dtype)
    return got - np.log(total), e / total[:, None]


def outputs(p: dict, hidden: np.ndarray, target: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log-probability of each target (rows of hidden); with grads: adds to them, and returns the gradient of hidden."""
    cls, rows = class_of(target), np.arange(len(target))
    got, d = softmax_at(hidden @ p["to_class"] + p["class_bias"], cls)
    back = None
    if grads is not None:
        d[rows, cls] -= 1
        grads["to_class"] += hidden.T @ d
        grads["class_bias"] += d.sum(0)
        back = d @ p["to_class"].T
    order = np.argsort(cls, kind="stable")
    bounds = np.searchsorted(cls[order], np.arange(HEAD + 1))
    for k in range(HEAD):
        i = order[bounds[k] : bounds[k + 1]]
        if not len(i):
            continue
        own, word = hidden[i], target[i] % WIDTH
        more, d = softmax_at(own @ p["to_word"][k] + p["word_bias"][k], word)
        got[i] += more
        if grads is not None:
            d[np.arange(len(i)), word] -= 1
            grads["to_word"][k] += own.T @ d
            grads["word_bias"][k] += d.sum(0)
            back[i] += d @ p["to_word"][k].T
    return got, back


def backward(p: dict, saved: tuple, before: np.ndarray, d_out: np.ndarray, grads: dict) -> None:
    zr_all, c_all, old, keep = saved
    gates, new = p["recur"][:, : 2 * HIDDEN], p["recur"][:, 2 * HIDDEN :]
    d_x = np.empty((*before.shape, 3 * HIDDEN), np.float32)
    d_h = np.zeros_like(d_out[0])
    for t in range(len(before) - 1, -1, -1):
        d_h = d_h + d_out[t]
        z, r, c, h = zr_all[t][:, :HIDDEN], zr_all[t][:, HIDDEN:], c_all[t], old[t]
        d_c = d_h * z * (1 - c * c)
        d_rh = d_c @ new.T
        d_zr = d_x[t, :, : 2 * HIDDEN]
        d_zr[:, :HIDDEN] = d_h * (c - h) * z * (1 - z)
        d_zr[:, HIDDEN:] = d_rh * h * r * (1 - r)
        d_x[t, :, 2 * HIDDEN :] = d_c
        grads["recur"][:, 2 * HIDDEN :] += (r * h).T @ d_c
        grads["recur"][:, : 2 * HIDDEN] += h.T @ d_zr
        d_h = (d_h * (1 - z) + d_rh * r + d_zr @ gates.T) * keep[t]
    flat, tokens = d_x.reshape(-1, 3 * HIDDEN), before.ravel().astype(np.int16)
    order = np.argsort(tokens, kind="stable")
    first = np.flatnonzero(np.diff(tokens[order], prepend=-1))
    grads["inputs"][tokens[order][first]] += np.add.reduceat(flat[order], first, axis=0)


class Trainer:
    """Adagrad over windows of STEPS steps; every token it is given is trained on once."""

    def __init__(self, flat: np.ndarray, end: int, rate: float = 0.05):
        self.flat, self.end, self.rate = flat.copy(), end, rate
        self.seen, self.square = 0, np.full(SIZE, 1e-6, np.float32)

    def learn(self, texts: list[np.ndarray]) -> None:
        target, before, text = laid_out(texts, self.end)
        p, h = unpack(self.flat), np.zeros((target.shape[1], HIDDEN), np.float32)
        for lo in range(0, len(target), STEPS):
            live = np.flatnonzero((text[lo] >= 0))  # lanes are filled from the top, so a lane that is done stays done
            part = slice(lo, lo + STEPS)
            b, y, there = before[part][:, live], target[part][:, live].ravel(), (text[part][:, live] >= 0).ravel()
            flat = np.zeros(SIZE, np.float32)
            grads = unpack(flat)
            hidden, saved = forward(p, h[live], b, self.end)
            rows = np.flatnonzero(there)
            _, back = outputs(p, hidden.reshape(-1, HIDDEN)[rows], y[rows], grads)
            d_out = np.zeros((len(there), HIDDEN), np.float32)
            d_out[rows] = back
            backward(p, saved, b, d_out.reshape(hidden.shape), grads)
            flat /= len(rows)
            np.clip(flat, -1, 1, out=flat)
            self.square += flat * flat
            self.flat -= self.rate * flat / np.sqrt(self.square)
            h[live] = hidden[-1]
            self.seen += len(rows)


def score(flat: np.ndarray, texts: list[np.ndarray], end: int, steps: int = 64) -> np.ndarray:
    """log10-probability of each text's tokens."""
    target, before, text = laid_out(texts, end)
    p, h, out = unpack(flat), np.zeros((target.shape[1], HIDDEN), np.float32), np.zeros(len(texts))
    for lo in range(0, len(target), steps):
        live = np.flatnonzero(text[lo] >= 0)
        part = slice(lo, lo + steps)
        hidden, _ = forward(p, h[live], before[part][:, live], end)
        h[live] = hidden[-1]
        owner = text[part][:, live].ravel()
        rows = np.flatnonzero(owner >= 0)
        got, _ = outputs(p, hidden.reshape(-1, HIDDEN)[rows], target[part][:, live].ravel()[rows])
        out += np.bincount(owner[rows], got.astype(np.float64), len(texts))
    return out / np.log(10)
