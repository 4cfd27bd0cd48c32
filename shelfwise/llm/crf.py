"""Two-state linear-chain conditional random field over many sequences at once.

Sequences lie behind one another; ``first`` marks where one begins.  A step of
the forward (or backward) recursion is a Moebius map of the state odds, and maps
compose by a 2x2 matrix product, so ``_scan`` cuts the whole run into columns,
composes each column's maps side by side, chains the columns, and replays them
with their true start: exact, and its cost doesn't depend on how the items are
spread over sequences (one text of a million words costs what a thousand short
ones do).
"""
from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

_CLIP = 30.0


def _scan(e: np.ndarray, reset: np.ndarray, start: float, a: float, b: float, c: float, d: float) -> np.ndarray:
    """u[t] = e[t] * (a + b u[t-1]) / (c + d u[t-1]), and e[t] * start where reset."""
    n = len(e)
    rows = max(1, int(np.sqrt(n)))
    cols = -(-n // rows)
    ee, zz = np.ones(rows * cols), np.zeros(rows * cols, bool)
    ee[:n], zz[:n] = e, reset
    ee, zz = np.ascontiguousarray(ee.reshape(cols, rows).T), np.ascontiguousarray(zz.reshape(cols, rows).T)
    p, q, r, s = np.zeros(cols), np.ones(cols), np.ones(cols), np.zeros(cols)
    for x, z in zip(ee, zz):
        p, q, r, s = x * (a * r + b * p), x * (a * s + b * q), c * r + d * p, c * s + d * q
        if z.any():
            p[z], q[z], r[z], s[z] = x[z] * start, 0.0, 1.0, 0.0
        scale = 1.0 / (p + q + r + s)
        p, q, r, s = p * scale, q * scale, r * scale, s * scale
    begin, u = np.empty(cols), 1.0
    for k in range(cols):
        begin[k] = u
        u = (p[k] + q[k] * u) / (r[k] + s[k] * u)
    out, u = np.empty((rows, cols)), begin
    for t, (x, z) in enumerate(zip(ee, zz)):
        u = x * (a + b * u) / (c + d * u)
        if z.any():
            u[z] = x[z] * start
        out[t] = u
    return out.T.ravel()[:n]


@dataclass
class Chain:
    """Transition log weights (from state, to state) and the start's log odds."""
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: float = 0.0

    def odds(self, score: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward odds u, and backward odds times the own factor w."""
        e = np.exp(np.clip(score, -_CLIP, _CLIP))
        t = np.exp(self.trans - self.trans.max())
        u = _scan(e, first, float(np.exp(self.start)), t[0, 1], t[1, 1], t[0, 0], t[1, 0])
        last = np.append(first[1:], True)
        w = _scan(e[::-1], last[::-1], 1.0, t[1, 0], t[1, 1], t[0, 0], t[0, 1])[::-1]
        return u, w

    def marginals(self, score: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probability of state 1 of every item."""
        if not len(score):
            return np.zeros(0)
        u, w = self.odds(score, first)
        x = u * w / np.exp(np.clip(score, -_CLIP, _CLIP))
        return x / (1 + x)

    def gradient(self, score: np.ndarray, first: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Of the log likelihood of states y: by score, transition and start."""
        u, w = self.odds(score, first)
        x = u * w / np.exp(np.clip(score, -_CLIP, _CLIP))
        p = x / (1 + x)
        t = np.exp(self.trans - self.trans.max())
        inner = np.flatnonzero(~first)
        before, after = u[inner - 1], w[inner]
        z = np.stack([np.full(len(inner), t[0, 0]), t[0, 1] * after, t[1, 0] * before, t[1, 1] * before * after])
        expect = (z / z.sum(0)).sum(1).reshape(2, 2)
        seen = np.bincount(2 * y[inner - 1] + y[inner], minlength=4).reshape(2, 2)
        return y - p, seen - expect, float((y[first] - p[first]).sum())


class Adam:
    def __init__(self, rate: float):
        self.rate, self.t, self.m, self.v = rate, 0, {}, {}

    def step(self, name: str, value, grad):
        """Value moved up the gradient."""
        m = self.m[name] = 0.9 * self.m.get(name, 0.0) + 0.1 * grad
        v = self.v[name] = 0.999 * self.v.get(name, 0.0) + 0.001 * grad * grad
        return value + self.rate * (m / (1 - 0.9 ** self.t)) / (np.sqrt(v / (1 - 0.999 ** self.t)) + 1e-8)
