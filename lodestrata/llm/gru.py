"""A small gated recurrent language model in numpy: training and scoring.

Words are numbers 0 .. n-1 of a shortlist; n is every other word (the tail). The
output is factored: classes of the shortlist by falling frequency plus one class
for the tail, and a softmax over the words within a class. Both depend on the state.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

HIDDEN = 24
CLASSES = 24
#: Steps through which an error is carried back.
WINDOW = 16
STREAMS = 64
#: Words whose outputs are taken at once.
ROWS = 8_192
NAMES = ("E", "U", "A", "a", "W", "b")


def classes_of(counts: np.ndarray, n: int = CLASSES) -> np.ndarray:
    """Bounds of about `n` classes of words (by falling count) of like total root count."""
    mass = np.cumsum(np.sqrt(counts + 1.0))
    cut = np.searchsorted(mass, mass[-1] * np.arange(1, n) / n) + 1 if len(counts) else []
    return np.unique(np.concatenate([[0], cut, [len(counts)]]).astype(np.int64))


def _by_gate(weights: np.ndarray) -> np.ndarray:
    """(rows, 3 k) -> (3, rows, k): a gate's weights side by side, so that its numbers are, too.

    Those of the two gates are halved, as their sigmoid by tanh takes them.
    """
    rows, k = len(weights), weights.shape[1] // 3
    out = np.ascontiguousarray(weights.reshape(rows, 3, k).transpose(1, 0, 2))
    out[:2] *= 0.5
    return out


def _step(x: np.ndarray, u: np.ndarray, h: np.ndarray, gates=None, new=None, after=None):
    """Inputs and recurrent part by gate, and the state -> gates, candidate and next state."""
    gates = np.add(x[:2], u[:2], out=gates)
    np.tanh(gates, out=gates)
    gates *= 0.5
    gates += 0.5
    new = np.multiply(gates[1], u[2], out=new)
    new += x[2]
    np.tanh(new, out=new)
    after = np.subtract(h, new, out=after)
    after *= gates[0]
    after += new
    return gates, new, after


@dataclass
class Gru:
    """E: input gates by word. U: recurrent. A, a: classes. W, b: words within classes."""

    bounds: np.ndarray
    E: np.ndarray
    U: np.ndarray
    A: np.ndarray
    a: np.ndarray
    W: np.ndarray
    b: np.ndarray

    @property
    def hidden(self) -> int:
        return len(self.U)

    def class_of(self, word: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds[1:], word, side="right")

    def logs(self, word: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Natural log of P(class), times P(word | class) within the shortlist."""
        own = self.class_of(word)
        # a column a word: sums and maxima then run over whole rows
        logits = self.A.T @ h.T
        logits += self.a[:, None]
        logits -= logits.max(axis=0)
        out = logits[own, np.arange(len(word))]
        out -= np.log(np.exp(logits, out=logits).sum(axis=0))
        # the words of a class side by side
        order = np.argsort(own.astype(np.uint16), kind="stable")
        cut = np.searchsorted(own[order], np.arange(len(self.bounds)))
        h, word, inside = h.take(order, axis=0), word[order], out[order]
        for c in np.flatnonzero(np.diff(cut)):
            lo, hi = self.bounds[c], self.bounds[c + 1]
            if hi - lo == 1:
                continue
            rows = slice(cut[c], cut[c + 1])
            inner = self.W[:, lo:hi].T @ h[rows].T
            inner += self.b[lo:hi, None]
            inner -= inner.max(axis=0)
            inside[rows] += inner[word[rows] - lo, np.arange(inner.shape[1])]
            inside[rows] -= np.log(np.exp(inner, out=inner).sum(axis=0))
        out[order] = inside
        return out

    def score(self, word: np.ndarray, first: np.ndarray, window: int | None = None) -> np.ndarray:
        """Sum of `logs` over each text; the state runs through a text from end to end.

        Texts advance together, one word a step, the longest first; outputs are taken
        a window of steps at a time, by default as many as make about ROWS words.
        """
        length = np.diff(first)
        order = np.argsort(-length, kind="stable")
        falling, start = length[order], first[:-1][order]
        out = np.zeros(len(length))
        steps = int(falling[0]) if len(length) else 0
        # texts that have a word at a step
        live = np.searchsorted(-falling, -np.arange(steps), side="left")
        h = np.zeros((len(length), self.hidden), np.float32)
        E, U = _by_gate(self.E), _by_gate(self.U)
        begin = 0
        while begin < steps:
            end = min(begin + (window or max(ROWS // int(live[begin]), 1)), steps)
            n = live[begin:end]
            cut = np.concatenate([[0], np.cumsum(n)])
            text = np.arange(cut[-1]) - np.repeat(cut[:-1], n)
            at = start[text] + np.repeat(np.arange(begin, end), n)
            # inputs are the words before; a text's first input is the start
            before = word[at - 1]
            if not begin:
                before[: n[0]] = len(self.b) + 1
            x, states = E.take(before, axis=1), np.empty((cut[-1], self.hidden), np.float32)
            for lo, hi in zip(cut[:-1], cut[1:], strict=True):
                h = h[: hi - lo]
                states[lo:hi] = h = _step(x[:, lo:hi], np.matmul(h, U), h)[2]
            out += np.bincount(order[text], self.logs(word[at], states), minlength=len(out))
            begin = end
        return out


def create(counts: np.ndarray, tail: float, seed: int = 5, hidden: int = HIDDEN) -> Gru:
    """An untrained model: zero output weights, biases that give the counts' distribution."""
    rng = np.random.default_rng(seed)
    n, bounds = len(counts), classes_of(counts)
    mass = np.array([counts[lo:hi].sum() for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)])
    f = np.float32
    return Gru(
        bounds,
        # one row more than words: the start of a text
        rng.normal(0, 0.1, (n + 2, 3 * hidden)).astype(f),
        rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(f),
        np.zeros((hidden, len(mass) + 1), f),
        np.log(np.append(mass, tail) + 1.0).astype(f),
        np.zeros((hidden, n), f),
        np.log(counts + 1.0).astype(f),
    )


def fresh(model: Gru) -> dict[str, np.ndarray]:
    """What `train` keeps of gradients, before any."""
    return {n: np.full_like(getattr(model, n), 1e-6) for n in NAMES}


def packed(model: Gru, memory: dict[str, np.ndarray]) -> np.ndarray:
    """All weights and what `train` keeps of their gradients as one vector."""
    rows = [getattr(model, n).ravel() for n in NAMES] + [memory[n].ravel() for n in NAMES]
    return np.concatenate(rows)


def unpacked(model: Gru, flat: np.ndarray) -> tuple[Gru, dict[str, np.ndarray]]:
    """A copy of `model` with the weights of `packed`, and the memory."""
    shapes = [getattr(model, n).shape for n in NAMES] * 2
    cut = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
    rows = [x.astype(np.float32).reshape(s) for x, s in zip(np.split(flat, cut), shapes, strict=True)]
    half = len(NAMES)
    return Gru(model.bounds, *rows[:half]), dict(zip(NAMES, rows[half:], strict=True))


def train(
    model: Gru,
    texts: list[np.ndarray],
    epochs: int = 3,
    rate: float = 0.02,
    seed: int = 5,
    memory: dict[str, np.ndarray] | None = None,
    at_once: int = STREAMS,
):
    """Truncated back-propagation over streams of whole texts (Adagrad)."""
    rng = np.random.default_rng(seed)
    memory = fresh(model) if memory is None else memory
    start, k = len(model.b) + 1, model.hidden
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        if not len(order):
            return model
        # inputs are the words before; a text's first input is the start
        words = np.concatenate([texts[i] for i in order])
        before = np.concatenate([np.append(start, texts[i][:-1]) for i in order])
        streams = max(1, min(at_once, len(words) // WINDOW))
        steps = -(-len(words) // streams)
        # the last stream is filled up from the beginning, no word is left out
        words = np.resize(words, (streams, steps)).T
        before = np.resize(before, (streams, steps)).T
        h = np.zeros((streams, k), np.float32)
        for lo in range(0, steps, WINDOW):
            h, gradient = _window(model, words[lo : lo + WINDOW], before[lo : lo + WINDOW], h, start)
            # of E only the rows of words that were read have a gradient
            rows, gradient["E"] = gradient["E"]
            for n in NAMES:
                g, at = gradient[n], rows if n == "E" else slice(None)
                np.clip(g, -1, 1, out=g)
                kept = memory[n][at]
                kept += g * g
                memory[n][at] = kept
                g *= np.float32(rate)
                g /= np.sqrt(kept)
                getattr(model, n)[at] -= g
    return model


def _window(model: Gru, words, before, h, start):
    """The state after some steps, and the gradients; that of E as its rows and their sums."""
    k, scale = model.hidden, np.float32(1 / words.size)
    inputs, U = _by_gate(model.E).take(before, axis=1), _by_gate(model.U)
    steps, streams = words.shape
    gates = np.empty((steps, 2, streams, k), np.float32)
    olds, turned, news, states = (np.empty((steps, streams, k), np.float32) for _ in range(4))
    ended = before == start
    some = ended.any(axis=1)
    for t in range(steps):
        olds[t] = h
        if some[t]:
            olds[t][ended[t]] = 0
        u = np.matmul(olds[t], U)
        turned[t] = u[2]
        h = _step(inputs[:, t], u, olds[t], gates[t], news[t], states[t])[2]
    word = words.ravel()
    gradient = {n: np.zeros_like(getattr(model, n)) for n in NAMES if n != "E"}
    d_states = _output_gradient(model, word, states.reshape(-1, k), gradient, scale).reshape(states.shape)
    # what an error of a state is multiplied by on its way to the gates and the candidate
    z, r = gates[:, 0], gates[:, 1]
    rest = 1 - z
    to_z = olds - news
    to_z *= z
    to_z *= rest
    to_new = news * news
    np.subtract(1, to_new, out=to_new)
    to_new *= rest
    to_r = 1 - r
    to_r *= r
    to_r *= turned
    carried = np.zeros_like(h)
    back, d_new = np.ascontiguousarray(model.U.T), np.empty_like(states)
    d_u = np.empty((steps, streams, 3 * k), np.float32)
    for t in reversed(range(steps)):
        d = d_states[t]
        d += carried
        np.multiply(d, to_z[t], out=d_u[t, :, :k])
        np.multiply(d, to_new[t], out=d_new[t])
        np.multiply(d_new[t], to_r[t], out=d_u[t, :, k : 2 * k])
        np.multiply(d_new[t], r[t], out=d_u[t, :, 2 * k :])
        carried = d_u[t] @ back
        d *= z[t]
        carried += d
        if some[t]:
            carried[ended[t]] = 0
    gradient["U"] += olds.reshape(-1, k).T @ d_u.reshape(-1, 3 * k)
    # sums by input word; the candidate's input is not turned by the gate
    d_u[:, :, 2 * k :] = d_new
    order = np.argsort(before.ravel().astype(np.uint16) if start < 1 << 16 else before, axis=None, kind="stable")
    at = before.ravel()[order]
    head = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    gradient["E"] = at[head], np.add.reduceat(d_u.reshape(-1, 3 * k).take(order, axis=0), head, axis=0)
    return h, gradient


def _output_gradient(model: Gru, word, h, gradient, scale):
    own = model.class_of(word)
    # a column a word, as in `logs`
    p = model.A.T @ h.T
    p += model.a[:, None]
    p -= p.max(axis=0)
    np.exp(p, out=p)
    p *= scale / p.sum(axis=0)
    p[own, np.arange(len(word))] -= scale
    gradient["A"] += h.T @ p.T
    gradient["a"] += p.sum(axis=1)
    d_h = p.T @ model.A.T
    # the words of a class side by side
    order = np.argsort(own.astype(np.uint16), kind="stable")
    cut = np.searchsorted(own[order], np.arange(len(model.bounds)))
    h, word = h.take(order, axis=0), word[order]
    inside = np.zeros_like(h)
    for c in np.flatnonzero(np.diff(cut)):
        rows = slice(cut[c], cut[c + 1])
        lo, hi = model.bounds[c], model.bounds[c + 1]
        q = model.W[:, lo:hi].T @ h[rows].T
        q += model.b[lo:hi, None]
        q -= q.max(axis=0)
        np.exp(q, out=q)
        q *= scale / q.sum(axis=0)
        q[word[rows] - lo, np.arange(q.shape[1])] -= scale
        gradient["W"][:, lo:hi] += h[rows].T @ q.T
        gradient["b"][lo:hi] += q.sum(axis=1)
        inside[rows] = q.T @ model.W[:, lo:hi].T
    d_h[order] += inside
    return d_h
