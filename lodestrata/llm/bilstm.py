"""Character-level bidirectional LSTM with CRF transitions, in numpy.

Windows are rows of character codes (0 .. CODES - 1); every position gets a tag.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

CODES = 129
HIDDEN = 16


def codes_of(text: str) -> np.ndarray:
    """The ASCII code, or 128 for every other character; 0 also stands outside of a text."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.minimum(points, CODES - 1).astype(np.int64)


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Tagger:
    """E, U of both directions; O, o: emissions; T: transitions, S: start, Z: end."""

    weights: dict[str, np.ndarray]

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        w = self.weights
        ahead, _ = _run(codes, w["E0"], w["U0"])
        back, _ = _run(codes[:, ::-1], w["E1"], w["U1"])
        both = np.concatenate([ahead, back[:, ::-1]], axis=2)
        return both @ w["O"] + w["o"]

    def decode(self, codes: np.ndarray, real: np.ndarray | None = None) -> np.ndarray:
        """Best tag sequence of each window (Viterbi)."""
        e, w = self.emissions(codes), self.weights
        n, steps, tags = e.shape
        best, back = e[:, 0] + w["S"], np.zeros((n, steps, tags), np.int8)
        for t in range(1, steps):
            from_ = best[:, :, None] + w["T"]
            back[:, t] = from_.argmax(axis=1)
            best = from_.max(axis=1) + e[:, t]
        out = np.zeros((n, steps), np.int64)
        out[:, -1] = (best + w["Z"]).argmax(axis=1)
        for t in range(steps - 1, 0, -1):
            out[:, t - 1] = back[np.arange(n), t, out[:, t]]
        return out


def _run(codes, E, U):
    """Hidden states (n, steps, k) and what the way back needs."""
    n, steps = codes.shape
    k = len(U)
    h, c = np.zeros((n, k), np.float32), np.zeros((n, k), np.float32)
    states, kept = np.zeros((n, steps, k), np.float32), []
    for t in range(steps):
        a = E[codes[:, t]] + h @ U
        gates = _sigmoid(a[:, : 3 * k])
        i, f, o = gates[:, :k], gates[:, k : 2 * k], gates[:, 2 * k :]
        g = np.tanh(a[:, 3 * k :])
        c_new = f * c + i * g
        squashed = np.tanh(c_new)
        kept.append((h, c, i, f, o, g, squashed))
        h, c = o * squashed, c_new
        states[:, t] = h
    return states, kept


def _run_back(codes, U, kept, d_states, gE, gU):
    n, steps = codes.shape
    k = len(U)
    d_h, d_c = np.zeros((n, k), np.float32), np.zeros((n, k), np.float32)
    for t in reversed(range(steps)):
        h, c, i, f, o, g, squashed = kept[t]
        d = d_states[:, t] + d_h
        d_cell = d * o * (1 - squashed * squashed) + d_c
        d_a = np.concatenate(
            [
                d_cell * g * i * (1 - i),
                d_cell * c * f * (1 - f),
                d * squashed * o * (1 - o),
                d_cell * i * (1 - g * g),
            ],
            axis=1,
        )
        np.add.at(gE, codes[:, t], d_a)
        gU += h.T @ d_a
        d_h, d_c = d_a @ U.T, d_cell * f


def _log_sum(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _crf(e, tags, w):
    """Gradients of the negative log-likelihood: emissions, T, S, Z."""
    n, steps, m = e.shape
    ahead = np.zeros_like(e)
    back = np.zeros_like(e)
    ahead[:, 0] = e[:, 0] + w["S"]
    for t in range(1, steps):
        ahead[:, t] = _log_sum(ahead[:, t - 1][:, :, None] + w["T"], 1) + e[:, t]
    back[:, -1] = w["Z"]
    for t in range(steps - 2, -1, -1):
        back[:, t] = _log_sum(w["T"][None] + (e[:, t + 1] + back[:, t + 1])[:, None, :], 2)
    whole = _log_sum(ahead[:, -1] + w["Z"], 1)
    p = np.exp(ahead + back - whole[:, None, None])
    gT = np.zeros_like(w["T"])
    for t in range(1, steps):
        pair = ahead[:, t - 1][:, :, None] + w["T"] + (e[:, t] + back[:, t])[:, None, :]
        gT += np.exp(pair - whole[:, None, None]).sum(axis=0)
    rows = np.arange(n)
    for t in range(steps):
        p[rows, t, tags[:, t]] -= 1
    np.subtract.at(gT, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
    gS, gZ = p[:, 0].sum(axis=0), p[:, -1].sum(axis=0)
    return p, gT, gS, gZ


def train(
    codes: np.ndarray, tags: np.ndarray, kinds: int, steps: int = 750, batch: int = 32, seed: int = 3
) -> Tagger:
    """Fit on labelled windows with Adam, in whole passes of about `steps` steps."""
    rng = np.random.default_rng(seed)
    epochs = max(4, -(-steps * batch // len(codes)))
    k, f = HIDDEN, np.float32
    w = {
        "E0": rng.normal(0, 0.3, (CODES, 4 * k)),
        "E1": rng.normal(0, 0.3, (CODES, 4 * k)),
        "U0": rng.normal(0, 0.3, (k, 4 * k)),
        "U1": rng.normal(0, 0.3, (k, 4 * k)),
        "O": rng.normal(0, 0.3, (2 * k, kinds)),
        "o": np.zeros(kinds),
        "T": np.zeros((kinds, kinds)),
        "S": np.zeros(kinds),
        "Z": np.zeros(kinds),
    }
    w = {n: v.astype(f) for n, v in w.items()}
    first = {n: np.zeros_like(v) for n, v in w.items()}
    second = {n: np.zeros_like(v) for n, v in w.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(codes))
        for lo in range(0, len(order), batch):
            x, y = codes[order[lo : lo + batch]], tags[order[lo : lo + batch]]
            ahead, kept0 = _run(x, w["E0"], w["U0"])
            back, kept1 = _run(x[:, ::-1], w["E1"], w["U1"])
            both = np.concatenate([ahead, back[:, ::-1]], axis=2)
            p, gT, gS, gZ = _crf(both @ w["O"] + w["o"], y, w)
            g = {n: np.zeros_like(v) for n, v in w.items()}
            g["T"], g["S"], g["Z"] = gT, gS, gZ
            g["O"] = np.einsum("ntk,ntm->km", both, p)
            g["o"] = p.sum(axis=(0, 1))
            d = p @ w["O"].T
            _run_back(x, w["U0"], kept0, d[:, :, :k], g["E0"], g["U0"])
            _run_back(x[:, ::-1], w["U1"], kept1, d[:, ::-1, k:], g["E1"], g["U1"])
            step += 1
            rate = 0.01 * (1 - epoch / (epochs + 1))
            for n in w:
                grad = np.clip(g[n] / len(x), -5, 5)
                first[n] += 0.1 * (grad - first[n])
                second[n] += 0.001 * (grad * grad - second[n])
                m, v = first[n] / (1 - 0.9**step), second[n] / (1 - 0.999**step)
                w[n] -= (rate * m / (np.sqrt(v) + 1e-8)).astype(f)
    return Tagger(w)
