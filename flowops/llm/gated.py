"""A gated recurrent layer in numpy, with backpropagation through time.

One gate decides how much of the state is forgotten, both in the candidate and in the new state:
``f = sigmoid(E_f[x] + U_f h)``, ``c = tanh(E_c[x] + U_c (f h))``, ``h' = h + f (c - h)``.
The input is a symbol, so its weights are a table with ``2 * size`` rows. Arrays are laid out
(feature, lane), steps first.
"""

from __future__ import annotations

import numpy as np

HALF = np.float32(0.5)


def forward(table: np.ndarray, own: np.ndarray, symbols: np.ndarray, state: np.ndarray, keep: np.ndarray | None = None, trace: bool = False):
    """States after every step, and what :func:`backward` needs if ``trace``.

    ``symbols``: (steps, lanes). ``keep``: (steps, lanes), 0 where the state restarts before a step.
    """
    steps, lanes = symbols.shape
    size = own.shape[1]
    states = np.empty((steps, size, lanes), np.float32)
    gates = np.empty((steps, size, lanes), np.float32) if trace else None
    cands = np.empty((steps, size, lanes), np.float32) if trace else None
    olds = np.empty((steps, size, lanes), np.float32) if trace else None
    scaled = table.copy()
    scaled[:size] *= HALF  # sigmoid(x) = (tanh(x / 2) + 1) / 2
    gate_own, cand_own = own[:size] * HALF, own[size:]
    h = state
    for t in range(steps):
        if keep is not None:
            h = h * keep[t]
        x = scaled.take(symbols[t], axis=1)
        f = gate_own @ h
        f += x[:size]
        np.tanh(f, out=f)
        f += 1
        f *= HALF
        c = cand_own @ (f * h)
        c += x[size:]
        np.tanh(c, out=c)
        new = states[t]
        np.subtract(c, h, out=new)
        new *= f
        new += h
        if trace:
            gates[t], cands[t], olds[t] = f, c, h
        h = new
    return (states, (gates, cands, olds)) if trace else (states, None)


def backward(own: np.ndarray, traced, grad: np.ndarray, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Gradients at the input table's rows for every step, and of ``own``, from those at the states."""
    gates, cands, olds = traced
    steps, size, lanes = grad.shape
    rows = np.empty((steps, 2 * size, lanes), np.float32)
    flow = np.zeros((size, lanes), np.float32)
    gate_own, cand_own = own[:size].T.copy(), own[size:].T.copy()
    for t in range(steps - 1, -1, -1):
        f, c, h = gates[t], cands[t], olds[t]
        flow = flow + grad[t]
        dc = flow * f
        dc *= 1 - c * c
        df = flow * (c - h)
        through = cand_own @ dc
        df += through * h
        df *= f * (1 - f)
        flow = flow * (1 - f) + through * f + gate_own @ df
        rows[t, :size], rows[t, size:] = df, dc
        if keep is not None:
            flow = flow * keep[t]
    flat = rows.transpose(1, 0, 2).reshape(2 * size, -1)
    before = olds.transpose(1, 0, 2).reshape(size, -1)
    gated = (gates * olds).transpose(1, 0, 2).reshape(size, -1)
    return rows, np.concatenate([flat[:size] @ before.T, flat[size:] @ gated.T])


def table_gradient(rows: np.ndarray, symbols: np.ndarray, count: int) -> np.ndarray:
    """Sums of ``rows`` (steps, features, lanes) by symbol."""
    flat = symbols.ravel()
    return np.stack([np.bincount(flat, weights=rows[:, k].ravel(), minlength=count) for k in range(rows.shape[1])]).astype(np.float32)


class Adam:
    """Adam over a dictionary of arrays."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.rate, self.step = rate, 0
        self.first = {k: np.zeros_like(v) for k, v in weights.items()}
        self.second = {k: np.zeros_like(v) for k, v in weights.items()}

    def update(self, weights: dict[str, np.ndarray], grads: dict[str, np.ndarray], clip: float = 1.0) -> None:
        self.step += 1
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads.values())))
        scale = np.float32(min(1.0, clip / (norm + 1e-12)))
        rate = np.float32(self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step))
        for k, g in grads.items():
            g = g * scale
            m, v = self.first[k], self.second[k]
            m *= np.float32(0.9)
            m += np.float32(0.1) * g
            v *= np.float32(0.999)
            v += np.float32(0.001) * (g * g)
            weights[k] -= rate * m / (np.sqrt(v) + np.float32(1e-8))
