"""A bidirectional LSTM in numpy that labels each row of a sequence; trained with Adam."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Labeller:
    """Per direction: input weights (d x 4h), state weights (h x 4h), bias; then output weights (2h) and bias."""

    weights: dict[str, np.ndarray]

    @property
    def hidden(self) -> int:
        return self.weights["u0"].shape[0]

    def logits(self, sequences: list[np.ndarray], cells: int = 4096) -> list[np.ndarray]:
        """The logit of each row of each sequence. Sequences of like length run together, about ``cells`` rows at a time."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(sequences)
        order = sorted((i for i in range(len(sequences)) if len(sequences[i])), key=lambda i: len(sequences[i]))
        while order:
            longest = len(sequences[order[-1]])
            many = max(1, cells // longest)
            part, order = order[-many:], order[:-many]
            padded, lengths = _padded([sequences[i] for i in part])
            found = self._forward(padded, lengths)[0]
            for row, i in enumerate(part):
                out[i] = found[: lengths[row], row]
        return out

    def _forward(self, x: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, list]:
        steps, batch, _ = x.shape
        states, traces = [], []
        for d in (0, 1):
            mine = x if d == 0 else _reversed(x, lengths)
            projected = mine @ self.weights[f"w{d}"] + self.weights[f"b{d}"]
            h = np.zeros((batch, self.hidden), x.dtype)
            c = np.zeros_like(h)
            all_h = np.empty((steps, batch, self.hidden), x.dtype)
            trace = []
            for t in range(steps):
                z = projected[t] + h @ self.weights[f"u{d}"]
                i, f, o, g = np.split(z, 4, axis=1)
                i, f, o, g = _sigmoid(i), _sigmoid(f + 1), _sigmoid(o), np.tanh(g)
                before, c = c, f * c + i * g
                tanh = np.tanh(c)
                trace.append((h, before, i, f, o, g, tanh))
                h = o * tanh
                all_h[t] = h
            states.append(all_h if d == 0 else _reversed(all_h, lengths))
            traces.append((mine, trace))
        both = np.concatenate(states, axis=2)
        return both @ self.weights["v"] + self.weights["a"], [both, traces]

    def gradients(self, x: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean logistic loss over the rows in use, and its gradients."""
        steps, batch, _ = x.shape
        used = (np.arange(steps)[:, None] < lengths[None, :]).astype(x.dtype)
        logit, (both, traces) = self._forward(x, lengths)
        p = _sigmoid(logit)
        loss = -np.sum(used * (labels * np.log(p + 1e-7) + (1 - labels) * np.log(1 - p + 1e-7))) / used.sum()
        delta = used * (p - labels) / used.sum()
        grads = {"v": np.einsum("tb,tbh->h", delta, both), "a": np.array([delta.sum()], x.dtype)}
        outward = delta[:, :, None] * self.weights["v"]
        for d in (0, 1):
            n = self.hidden
            incoming = outward[:, :, d * n : (d + 1) * n]
            if d:
                incoming = _reversed(incoming, lengths)
            mine, trace = traces[d]
            u = self.weights[f"u{d}"]
            dz_all = np.empty((steps, batch, 4 * n), x.dtype)
            du = np.zeros_like(u)
            dh_next, dc_next = np.zeros((batch, n), x.dtype), np.zeros((batch, n), x.dtype)
            for t in range(steps - 1, -1, -1):
                h, before, i, f, o, g, tanh = trace[t]
                dh = incoming[t] + dh_next
                dc = dh * o * (1 - tanh**2) + dc_next
                dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tanh * o * (1 - o), dc * i * (1 - g**2)], axis=1)
                dz_all[t] = dz
                du += h.T @ dz
                dh_next, dc_next = dz @ u.T, dc * f
            grads[f"u{d}"] = du
            grads[f"w{d}"] = np.einsum("tbd,tbz->dz", mine, dz_all, optimize=True)
            grads[f"b{d}"] = dz_all.sum(axis=(0, 1))
        return float(loss), grads


def _padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(s) for s in sequences])
    out = np.zeros((lengths.max(), len(sequences), sequences[0].shape[1]), np.float32)
    for i, s in enumerate(sequences):
        out[: len(s), i] = s
    return out, lengths


def _reversed(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each sequence backwards; the padding stays behind it."""
    t = np.arange(x.shape[0])[:, None]
    index = np.where(t < lengths, lengths - 1 - t, t)
    return x[index, np.arange(x.shape[1])]


def train(sequences: list[np.ndarray], labels: list[np.ndarray], hidden: int = 16, steps: int = 400, batch: int = 24, rate: float = 0.01, seed: int = 0) -> Labeller:
    rng = np.random.default_rng(seed)
    width = sequences[0].shape[1]
    weights = {"v": rng.normal(0, 0.2, 2 * hidden), "a": np.zeros(1)}
    for d in (0, 1):
        weights |= {f"w{d}": rng.normal(0, 0.1, (width, 4 * hidden)), f"u{d}": rng.normal(0, 0.1, (hidden, 4 * hidden)), f"b{d}": np.zeros(4 * hidden)}
    model = Labeller({k: v.astype(np.float32) for k, v in weights.items()})
    mean = {k: np.zeros_like(v) for k, v in model.weights.items()}
    square = {k: np.zeros_like(v) for k, v in model.weights.items()}
    for step in range(1, steps + 1):
        part = rng.integers(0, len(sequences), batch)
        x, lengths = _padded([sequences[i] for i in part])
        y = np.zeros(x.shape[:2], np.float32)
        for row, i in enumerate(part):
            y[: lengths[row], row] = labels[i]
        _, grads = model.gradients(x, lengths, y)
        pace = rate * min(1.0, 2 * (1 - (step - 1) / steps))
        for k, g in grads.items():
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.999 * square[k] + 0.001 * g**2
            model.weights[k] = (model.weights[k] - pace * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model
