"""A character-level bidirectional LSTM with CRF transitions in plain numpy: training and decoding."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

KINDS = ("email", "ip", "card", "phone")
TAGS = ["O", *(f"{p}-{k}" for k in KINDS for p in "BI")]
SYMBOLS = 100  # 0 padding, 1 other, 2 letter beyond ASCII, 3 white space, then printable ASCII
WIDTH, STRIDE = 64, 32
FORBIDDEN = -1e4

_ASCII = np.ones(128, np.int64)
_ASCII[32:127] = np.arange(4, 99)
_ASCII[[9, 10, 11, 12, 13, 32]] = 3


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 128, _ASCII[np.minimum(codes, 127)], np.where(codes >= 0xC0, 2, 1))


def allowed() -> np.ndarray:
    """Added to transitions: I-x only follows B-x or I-x."""
    ban = np.zeros((len(TAGS), len(TAGS)))
    for j, tag in enumerate(TAGS):
        if tag[0] == "I":
            ban[:, j] = [0 if t[1:] == tag[1:] and t != "O" else FORBIDDEN for t in TAGS]
    return ban


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


class Tagger:
    """Parameters: input and recurrent weights of both directions, output layer, transitions."""

    def __init__(self, hidden: int = 24, seed: int = 1):
        rng, k = np.random.default_rng(seed), len(TAGS)
        self.hidden = hidden
        self.p = {
            "x": rng.normal(0, 0.3, (2, SYMBOLS, 4 * hidden)),
            "h": rng.normal(0, hidden**-0.5, (2, hidden, 4 * hidden)),
            "o": rng.normal(0, 0.2, (2 * hidden, k)),
            "b": np.zeros(k),
            "a": np.zeros((k, k)),
            "s": np.zeros(k),
        }
        self.p["x"][:, :, hidden : 2 * hidden] += 1.0  # open forget gates

    def _run(self, ids: np.ndarray, keep: bool = False):
        """Hidden states (batch, time, 2 * hidden); with ``keep`` also what the backward pass needs."""
        n, t, h = *ids.shape, self.hidden
        both = np.stack([ids, ids[:, ::-1]])
        state, cell = np.zeros((2, n, h), self.p["h"].dtype), np.zeros((2, n, h), self.p["h"].dtype)
        out, saved = np.empty((2, t, n, h), self.p["h"].dtype), []
        for i in range(t):
            z = self.p["x"][np.arange(2)[:, None], both[:, :, i]] + state @ self.p["h"]
            gate, new = _sigmoid(z[..., : 3 * h]), np.tanh(z[..., 3 * h :])
            before, was = cell, state
            cell = gate[..., h : 2 * h] * cell + gate[..., :h] * new
            squashed = np.tanh(cell)
            state = gate[..., 2 * h :] * squashed
            out[:, i] = state
            if keep:
                saved.append((gate, new, before, squashed, was))
        joined = np.concatenate([out[0], out[1, ::-1]], -1).transpose(1, 0, 2)
        return joined, both, saved

    def scores(self, ids: np.ndarray) -> np.ndarray:
        return self._run(ids)[0] @ self.p["o"] + self.p["b"]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The best tag sequence of each window (Viterbi)."""
        u, a = self.scores(ids), self.p["a"] + allowed().astype(self.p["a"].dtype)
        best, back = self.p["s"] + u[:, 0], []
        for t in range(1, u.shape[1]):
            each = best[:, :, None] + a
            back.append(each.argmax(1))
            best = each.max(1) + u[:, t]
        path = [best.argmax(1)]
        for b in reversed(back):
            path.append(b[np.arange(len(b)), path[-1]])
        return np.stack(path[::-1], 1)

    def gradients(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        n, t, h, k = *ids.shape, self.hidden, len(TAGS)
        states, both, saved = self._run(ids, keep=True)
        u, a = states @ self.p["o"] + self.p["b"], self.p["a"] + allowed()
        alpha, beta = np.empty((t, n, k)), np.zeros((t, n, k))
        alpha[0] = self.p["s"] + u[:, 0]
        for i in range(1, t):
            alpha[i] = _logsumexp(alpha[i - 1][:, :, None] + a, 1) + u[:, i]
        for i in range(t - 2, -1, -1):
            beta[i] = _logsumexp(a + (u[:, i + 1] + beta[i + 1])[:, None, :], 2)
        total = _logsumexp(alpha[-1], 1)
        du = np.exp(alpha + beta - total[:, None]).transpose(1, 0, 2)
        da = np.zeros((k, k))
        for i in range(1, t):
            da += np.exp(alpha[i - 1][:, :, None] + a + (u[:, i] + beta[i] - total[:, None])[:, None, :]).sum(0)
        rows, cols = np.arange(n)[:, None], np.arange(t)
        right = u[rows, cols, tags].sum(1) + self.p["s"][tags[:, 0]] + a[tags[:, :-1], tags[:, 1:]].sum(1)
        du[rows, cols, tags] -= 1
        np.subtract.at(da, (tags[:, :-1], tags[:, 1:]), 1)
        g = {
            "o": np.einsum("nth,ntk->hk", states, du),
            "b": du.sum((0, 1)),
            "a": da,
            "s": du[:, 0].sum(0),
            "x": np.zeros_like(self.p["x"]),
            "h": np.zeros_like(self.p["h"]),
        }
        dout = (du @ self.p["o"].T).transpose(1, 0, 2)
        dout = np.stack([dout[..., :h], dout[::-1, :, h:]])
        dh, dc = np.zeros((2, n, h)), np.zeros((2, n, h))
        for i in range(t - 1, -1, -1):
            gate, new, before, squashed, was = saved[i]
            into, forget, out = gate[..., :h], gate[..., h : 2 * h], gate[..., 2 * h :]
            dh = dh + dout[:, i]
            dc = dc + dh * out * (1 - squashed**2)
            dgate = np.concatenate([dc * new, dc * before, dh * squashed], -1) * gate * (1 - gate)
            dz = np.concatenate([dgate, dc * into * (1 - new**2)], -1)
            for d in range(2):
                np.add.at(g["x"][d], both[d, :, i], dz[d])
            g["h"] += was.transpose(0, 2, 1) @ dz
            dh, dc = dz @ self.p["h"].transpose(0, 2, 1), dc * forget
        return float((total - right).mean()), {name: x / n for name, x in g.items()}

    def fit(self, ids: np.ndarray, tags: np.ndarray, epochs: int = 14, batch: int = 128, rate: float = 0.012, seed: int = 1) -> float:
        """Adam over shuffled batches; returns the last epoch's loss."""
        rng, step, loss = np.random.default_rng(seed), 0, 0.0
        m = {n: np.zeros_like(x) for n, x in self.p.items()}
        v = {n: np.zeros_like(x) for n, x in self.p.items()}
        for epoch in range(epochs):
            order, losses = rng.permutation(len(ids)), []
            for at in range(0, len(order), batch):
                part = order[at : at + batch]
                loss, g = self.gradients(ids[part], tags[part])
                losses.append(loss)
                step += 1
                now = rate * min(1.0, 2.2 * (1 - epoch / epochs))
                norm = np.sqrt(sum((x**2).sum() for x in g.values()))
                for n, x in g.items():
                    x = x * min(1.0, 5.0 / (norm + 1e-9))
                    m[n] = 0.9 * m[n] + 0.1 * x
                    v[n] = 0.99 * v[n] + 0.01 * x**2
                    self.p[n] -= now * (m[n] / (1 - 0.9**step)) / (np.sqrt(v[n] / (1 - 0.99**step)) + 1e-8)
            loss = float(np.mean(losses)) if losses else 0.0
        return loss

    def small(self) -> Tagger:
        """The same model in single precision, for decoding."""
        self.p = {n: x.astype(np.float32) for n, x in self.p.items()}
        return self


def spans_of(tags: Sequence[int]) -> list[tuple[str, int, int]]:
    """(kind, start, end) of a tag sequence."""
    found, start, kind = [], -1, ""
    for i in np.flatnonzero(np.append(np.asarray(tags), 0) != np.append(0, np.asarray(tags))).tolist() if len(tags) else []:
        tag = TAGS[tags[i]] if i < len(tags) else "O"
        if start >= 0 and not (tag[0] == "I" and tag[2:] == kind):
            found.append((kind, start, i))
            start = -1
        if tag[0] == "B" or tag[0] == "I" and start < 0:
            start, kind = i, tag[2:]
    return found
