"""Bidirectional character LSTM with a linear-chain CRF on top, in NumPy.

Windows of characters go through the network side by side.  Gradients are
written out: marginals of the chain give those of the scores, and time is
walked backwards for the two LSTMs.  Training is a seeded Adam run over a
bounded list of windows, so the same windows give the same model.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

CODES = 130  # ASCII with case and digits folded, one code for all else, one for padding
OTHER, PAD = 128, 129
_FOLD = np.arange(128)
_FOLD[ord("A") : ord("Z") + 1] += 32
_FOLD[ord("0") : ord("9") + 1] = ord("0")
NEVER = -1e4


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(points < 128, _FOLD[np.minimum(points, 127)], OTHER)


def padded(texts: Sequence[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, lengths) of texts of at most ``width`` characters."""
    out = np.full((len(texts), width), PAD)
    for row, text in zip(out, texts):
        row[: len(text)] = codes(text)
    return out, np.array([len(t) for t in texts])


@dataclass
class Tagger:
    """Weights by name; ``allowed[a, b]`` says whether tag b may follow tag a, ``starts`` which may come first."""

    weights: dict[str, np.ndarray]
    allowed: np.ndarray
    starts: np.ndarray

    @classmethod
    def fresh(cls, allowed: np.ndarray, starts: np.ndarray, hidden: int = 16, embed: int = 12, seed: int = 0, dtype: type = np.float32) -> Tagger:
        rng, tags = np.random.default_rng(seed), len(starts)
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[-2]), shape).astype(dtype)
        weights = {"embed": rng.normal(0, 0.5, (CODES, embed)).astype(dtype), "out": draw(2 * hidden, tags), "out_b": np.zeros(tags, dtype), "chain": np.zeros((tags, tags), dtype)}
        # first the direction of reading, then the one against it
        weights |= {"in": draw(2, embed, 4 * hidden), "re": draw(2, hidden, 4 * hidden), "b": np.zeros((2, 1, 4 * hidden), dtype)}
        weights["b"][:, :, hidden : 2 * hidden] = 1  # remember at first
        return cls(weights, allowed, starts)

    # ------------------------------------------------------------ network

    def _read(self, x: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
        """States (batch, time, 2 * hidden) of both directions; padding keeps a state as it is."""
        re, h_size = self.weights["re"], self.weights["re"].shape[1]
        table = self.weights["embed"] @ self.weights["in"] + self.weights["b"]
        gates = np.stack([table[0][x], table[1][x[:, ::-1]]])
        on_at = np.stack([inside, inside[:, ::-1]])
        squash = np.repeat(np.array([0.5, 1], re.dtype), [3 * h_size, h_size])
        h = c = np.zeros((2, len(x), h_size), re.dtype)
        out, tape = np.zeros((2, *x.shape, h_size), re.dtype), []
        for t in range(x.shape[1]):
            raw = np.tanh((gates[:, :, t] + h @ re) * squash)
            i, f, o = (0.5 * raw[..., k * h_size : (k + 1) * h_size] + 0.5 for k in range(3))
            g, on = raw[..., 3 * h_size :], on_at[:, :, t, None]
            new_c = np.where(on, f * c + i * g, c)
            shown = np.tanh(new_c)
            tape.append((h, c, i, f, o, g, shown, on))
            h, c = np.where(on, o * shown, h), new_c
            out[:, :, t] = h
        return np.concatenate([out[0], out[1][:, ::-1]], axis=2), tape

    def _unread(self, x: np.ndarray, tape: list[tuple], states: np.ndarray, grads: dict[str, np.ndarray]) -> None:
        re, h_size = self.weights["re"], self.weights["re"].shape[1]
        back = np.stack([states[:, :, :h_size], states[:, ::-1, h_size:]])
        d_gates = np.zeros((2, *x.shape, 4 * h_size), re.dtype)
        dh = dc = np.zeros((2, len(x), h_size), re.dtype)
        turned = re.transpose(0, 2, 1)
        for t in range(x.shape[1] - 1, -1, -1):
            h, c, i, f, o, g, shown, on = tape[t]
            dh = dh + back[:, :, t]
            d_new = dc + np.where(on, dh * o * (1 - shown * shown), 0)
            raw = np.concatenate([d_new * g * i * (1 - i), d_new * c * f * (1 - f), dh * shown * o * (1 - o), d_new * i * (1 - g * g)], axis=2) * on
            d_gates[:, :, t] = raw
            grads["re"] += h.transpose(0, 2, 1) @ raw
            dh, dc = np.where(on, 0, dh) + raw @ turned, np.where(on, d_new * f, d_new)
        for way, read in enumerate((x, x[:, ::-1])):
            flat = read.ravel()
            order = np.argsort(flat, kind="stable")
            present, first = np.unique(flat[order], return_index=True)
            per_code = np.zeros((CODES, 4 * h_size), re.dtype)
            per_code[present] = np.add.reduceat(d_gates[way].reshape(len(flat), -1)[order], first, axis=0)
            grads["in"][way] += self.weights["embed"].T @ per_code
            grads["b"][way] += per_code.sum(axis=0)
            grads["embed"] += per_code @ self.weights["in"][way].T

    def scores(self, x: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Score of every tag at every character (batch, time, tags)."""
        inside = np.arange(x.shape[1]) < lengths[:, None]
        both, tape = self._read(x, inside)
        out = (both @ self.weights["out"] + self.weights["out_b"]).astype(np.float64)
        out[:, 0] = np.where(self.starts, out[:, 0], NEVER)
        return out, (inside, both, tape)

    # -------------------------------------------------------------- chain

    def _chain(self) -> np.ndarray:
        return np.where(self.allowed, self.weights["chain"], NEVER).astype(np.float64)

    def marginals(self, scores: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(tag probabilities, expected transitions, log partition) of the chain, with sums scaled at every step."""
        moves, steps = np.exp(self._chain()), scores.shape[1]
        top = scores.max(axis=2)
        here = np.exp(scores - top[:, :, None])
        ahead, behind, scale = np.empty_like(scores), np.ones_like(scores), np.ones(scores.shape[:2])
        for t in range(steps):
            reach = here[:, t] if t == 0 else (ahead[:, t - 1] @ moves) * here[:, t]
            total = reach.sum(axis=1)
            on = inside[:, t] if t else np.ones(len(scores), dtype=bool)
            scale[:, t] = np.where(on, total, 1)
            ahead[:, t] = np.where(on[:, None], reach / total[:, None], ahead[:, t - 1])
        pairs = np.zeros_like(moves)
        for t in range(steps - 1, 0, -1):
            on = inside[:, t, None]
            onward = np.where(on, here[:, t] * behind[:, t] / scale[:, t, None], 0)
            pairs += (ahead[:, t - 1].T @ onward) * moves
            behind[:, t - 1] = np.where(on, onward @ moves.T, behind[:, t])
        logs = (np.log(scale) + np.where(inside, top, 0)).sum(axis=1) + np.where(inside[:, 0], 0, top[:, 0])
        return ahead * behind * inside[:, :, None], pairs, logs

    def loss(self, x: np.ndarray, lengths: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tags and its gradients."""
        scores, (inside, both, tape) = self.scores(x, lengths)
        chances, pairs, total = self.marginals(scores, inside)
        gold = np.eye(scores.shape[2])[tags] * inside[:, :, None]
        moves = np.zeros_like(pairs)
        step = inside[:, 1:]
        np.add.at(moves, (tags[:, :-1][step], tags[:, 1:][step]), 1)
        value = (total.sum() - (scores * gold).sum() - (self._chain() * moves).sum()) / len(x)
        grads = {name: np.zeros_like(w) for name, w in self.weights.items()}
        back = (chances - gold) / len(x)
        back[:, 0] = np.where(self.starts, back[:, 0], 0)
        grads["chain"] += np.where(self.allowed, (pairs - moves) / len(x), 0)
        back = back.astype(both.dtype)
        grads["out"] += np.tensordot(both, back, ([0, 1], [0, 1]))
        grads["out_b"] += back.sum(axis=(0, 1))
        self._unread(x, tape, back @ self.weights["out"].T, grads)
        return value, grads

    def best(self, scores: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """Most likely tags of every window (Viterbi)."""
        chain, steps = self._chain(), scores.shape[1]
        reach, came = scores[:, 0], np.zeros(scores.shape, dtype=np.int64)
        stay = np.arange(scores.shape[2])
        for t in range(1, steps):
            ways = reach[:, :, None] + chain
            on = inside[:, t, None]
            came[:, t] = np.where(on, ways.argmax(axis=1), stay)
            reach = np.where(on, ways.max(axis=1) + scores[:, t], reach)
        out, rows = np.zeros(scores.shape[:2], dtype=np.int64), np.arange(len(scores))
        out[:, -1] = reach.argmax(axis=1)
        for t in range(steps - 1, 0, -1):
            out[:, t - 1] = came[rows, t, out[:, t]]
        return out

    def tag(self, texts: Sequence[str], width: int) -> tuple[np.ndarray, np.ndarray]:
        """(tags, probability of each tag) of texts of at most ``width`` characters."""
        x, lengths = padded(texts, width)
        scores, (inside, *_) = self.scores(x, lengths)
        tags = self.best(scores, inside)
        chances = self.marginals(scores, inside)[0]
        return tags, np.take_along_axis(chances, tags[:, :, None], 2)[:, :, 0]


def train(tagger: Tagger, x: np.ndarray, lengths: np.ndarray, tags: np.ndarray, epochs: int, batch: int = 64, rate: float = 0.01, seed: int = 0) -> list[float]:
    """Fit by Adam; returns the mean loss of every epoch."""
    rng, step, out = np.random.default_rng(seed), 0, []
    first = {k: np.zeros_like(w) for k, w in tagger.weights.items()}
    second = {k: np.zeros_like(w) for k, w in tagger.weights.items()}
    for epoch in range(epochs):
        order, losses = rng.permutation(len(x)), []
        pace = rate * (1 - 0.9 * epoch / epochs)
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            width = lengths[pick].max()
            value, grads = tagger.loss(x[pick, :width], lengths[pick], tags[pick, :width])
            norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
            step += 1
            losses.append(value)
            for k, g in grads.items():
                g = g * min(1.0, 5.0 / max(norm, 1e-12))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g**2
                tagger.weights[k] -= (pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(g.dtype)
        out.append(float(np.mean(losses)))
    return out
