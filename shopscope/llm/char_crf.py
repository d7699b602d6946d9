"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Trained from windows of text with one tag per character; decodes windows by
Viterbi over the emissions of both directions and the learnt transitions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

# Character classes; letters and other signs share a class each but for those listed.
SINGLE = "@.-_+()/:[]# \n,%='\""
HEX = "abcdef"


def _class_table() -> np.ndarray:
    """Class of each code point below 256: 0 is padding, 1 any other character."""
    table = np.ones(257, np.int64)
    for c in range(256):
        if chr(c).isalpha():
            table[c] = 2 if chr(c).islower() else 3
    next_class = 4
    for c in HEX:
        table[ord(c)] = next_class
    next_class += 1
    for c in "0123456789":
        table[ord(c)] = next_class
        next_class += 1
    for c in SINGLE:
        table[ord(c)] = next_class
        next_class += 1
    return table


CLASSES = _class_table()
N_CLASSES = int(CLASSES.max()) + 1


def char_classes(text: str) -> np.ndarray:
    """Character class of each code point."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return CLASSES[np.minimum(points, 256)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class CharCrf:
    """Parameters of the tagger; ``tags`` counts the outside tag 0."""

    tags: int
    hidden: int = 16
    seed: int = 0
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self):
        if not self.weights:
            rng = np.random.default_rng(self.seed)
            h, scale = self.hidden, 1 / np.sqrt(self.hidden)
            for side in "fb":
                self.weights["x" + side] = rng.normal(0, 0.3, (N_CLASSES, 4 * h)).astype(np.float32)
                self.weights["x" + side][:, h : 2 * h] += 1.0  # open forget gates at the start
                self.weights["h" + side] = rng.normal(0, scale, (h, 4 * h)).astype(np.float32)
            self.weights["o"] = rng.normal(0, scale, (2 * h, self.tags)).astype(np.float32)
            self.weights["ob"] = np.zeros(self.tags, np.float32)
            self.weights["t"] = np.zeros((self.tags, self.tags), np.float32)

    # -- LSTM ------------------------------------------------------------------
    def _run(self, side: str, x: np.ndarray, keep: bool):
        """States of one direction over x (batch, time); ``keep`` also returns what the gradient needs."""
        wx, wh, h = self.weights["x" + side], self.weights["h" + side], self.hidden
        n, steps = x.shape
        out = np.zeros((steps, n, h), np.float32)
        state, cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        trace = []
        for t in range(steps):
            gates = wx[x[:, t]] + state @ wh
            ifo, g = _sigmoid(gates[:, : 3 * h]), np.tanh(gates[:, 3 * h :])
            i, f, o = ifo[:, :h], ifo[:, h : 2 * h], ifo[:, 2 * h :]
            before, last = cell, state
            cell = f * before + i * g
            squashed = np.tanh(cell)
            state = o * squashed
            out[t] = state
            if keep:
                trace.append((i, f, o, g, before, squashed, last))
        return out, trace

    def _back(self, side: str, x: np.ndarray, trace: list, d_out: np.ndarray, grads: dict) -> None:
        wh, h = self.weights["h" + side], self.hidden
        n, steps = x.shape
        d_state, d_cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        for t in range(steps - 1, -1, -1):
            i, f, o, g, before, squashed, last = trace[t]
            d_state = d_state + d_out[t]
            d_cell = d_cell + d_state * o * (1 - squashed**2)
            d_gates = np.concatenate(
                [d_cell * g * i * (1 - i), d_cell * before * f * (1 - f), d_state * squashed * o * (1 - o), d_cell * i * (1 - g**2)], 1
            )
            np.add.at(grads["x" + side], x[:, t], d_gates)
            grads["h" + side] += last.T @ d_gates
            d_state, d_cell = d_gates @ wh.T, d_cell * f

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """Tag scores (time, batch, tags) of windows x (batch, time)."""
        forward, _ = self._run("f", x, False)
        backward, _ = self._run("b", x[:, ::-1], False)
        return np.concatenate([forward, backward[::-1]], 2) @ self.weights["o"] + self.weights["ob"]

    # -- CRF -------------------------------------------------------------------
    def decode(self, x: np.ndarray) -> np.ndarray:
        """Best tags (batch, time) of windows x (batch, time)."""
        scores, moves = self.emissions(x), self.weights["t"]
        steps, n, _ = scores.shape
        best = scores[0]
        back = np.zeros((steps, n, self.tags), np.int8)
        for t in range(1, steps):
            through = best[:, :, None] + moves
            back[t] = through.argmax(1)
            best = through.max(1) + scores[t]
        tags = np.zeros((n, steps), np.int8)
        tags[:, -1] = best.argmax(1)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = back[t][np.arange(n), tags[:, t]]
        return tags

    def decode_long(self, scores: list[np.ndarray], block: int = 96) -> list[np.ndarray]:
        """Best tags of whole sequences, given their emissions (length, tags).

        The best path over all of a sequence, as :meth:`decode` finds it, but in blocks:
        every block is solved for each tag that may enter it, all blocks of all sequences
        side by side; then the blocks of a sequence are chained and their paths read back.
        """
        k, moves = self.tags, self.weights["t"]
        sizes = [len(s) for s in scores]
        counts = [-(-n // block) for n in sizes]
        total = sum(counts)
        if not total:
            return [np.zeros(0, np.int8) for _ in scores]
        first = np.cumsum([0, *counts])
        cells = np.zeros((block, total, k), np.float32)
        inside = np.zeros((block, total), bool)
        opens = np.zeros(total, bool)
        for s, n, at, count in zip(scores, sizes, first, counts):
            if not n:
                continue
            padded = np.zeros((count * block, k), np.float32)
            padded[:n] = s
            cells[:, at : at + count] = padded.reshape(count, block, k).transpose(1, 0, 2)
            inside[:, at : at + count] = (np.arange(count * block) < n).reshape(count, block).T
            opens[at] = True
        entering = np.where(opens[:, None, None], 0, moves)  # no move leads into the first character
        best = entering + cells[0][:, None, :]  # block, entering tag, tag
        back = np.zeros((block, total, k, k), np.int8)
        stay = np.arange(k, dtype=np.int8)
        for t in range(1, block):
            through = best[:, :, :, None] + moves
            back[t] = np.where(inside[t][:, None, None], through.argmax(2), stay)
            best = np.where(inside[t][:, None, None], through.max(2) + cells[t][:, None, :], best)
        ends, enters = np.zeros(total, np.int8), np.zeros(total, np.int8)
        for at, count in zip(first, counts):
            if not count:
                continue
            reach, came = best[at, 0], []
            for b in range(at + 1, at + count):
                step = reach[:, None] + best[b]
                came.append(step.argmax(0))
                reach = step.max(0)
            tag = int(reach.argmax())
            for b in range(at + count - 1, at, -1):
                ends[b] = tag
                tag = int(came[b - at - 1][tag])
                enters[b] = tag
            ends[at] = tag
        tags, rows = np.zeros((block, total), np.int8), np.arange(total)
        tags[-1] = ends
        for t in range(block - 1, 0, -1):
            tags[t - 1] = back[t][rows, enters, tags[t]]
        flat = tags.T.reshape(-1)
        return [flat[at * block : at * block + n] for at, n in zip(first, sizes)]

    def loss_and_gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood per character of tags y, and its gradient."""
        n, steps = x.shape
        forward, trace_f = self._run("f", x, True)
        reverse, trace_b = self._run("b", x[:, ::-1], True)
        both = np.concatenate([forward, reverse[::-1]], 2)
        w, moves = self.weights["o"], self.weights["t"]
        scores = both @ w + self.weights["ob"]
        alpha, beta = np.zeros_like(scores), np.zeros_like(scores)
        alpha[0] = scores[0]
        add = np.logaddexp.reduce
        for t in range(1, steps):
            alpha[t] = add(alpha[t - 1][:, :, None] + moves, 1) + scores[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = add(moves + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
        total = add(alpha[-1], 1)
        rows, times = np.arange(n), np.arange(steps)[:, None]
        gold = scores[times, rows, y.T].sum(0) + moves[y[:, :-1], y[:, 1:]].sum(1)
        count = n * steps
        d_scores = np.exp(alpha + beta - total[:, None])
        d_scores[times, rows, y.T] -= 1
        d_scores /= count
        d_moves = np.zeros_like(moves)
        for t in range(1, steps):
            pair = alpha[t - 1][:, :, None] + moves + (scores[t] + beta[t])[:, None, :] - total[:, None, None]
            d_moves += np.exp(pair).sum(0)
        np.add.at(d_moves, (y[:, :-1].ravel(), y[:, 1:].ravel()), -1)
        grads = {k: np.zeros_like(v) for k, v in self.weights.items()}
        grads["t"] = d_moves / count
        grads["o"] = np.einsum("tnh,tnk->hk", both, d_scores)
        grads["ob"] = d_scores.sum((0, 1))
        d_both = d_scores @ w.T
        self._back("f", x, trace_f, d_both[:, :, : self.hidden], grads)
        self._back("b", x[:, ::-1], trace_b, d_both[::-1, :, self.hidden :], grads)
        return float((total - gold).sum() / count), grads

    def fit(self, x: np.ndarray, y: np.ndarray, rounds: int, batch: int, rate: float = 0.02) -> float:
        """Adam over random batches; returns the last loss."""
        rng = np.random.default_rng(self.seed + 1)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        loss = 0.0
        for step in range(1, rounds + 1):
            pick = rng.integers(0, len(x), min(batch, len(x)))
            loss, grads = self.loss_and_gradient(x[pick], y[pick])
            pace = rate * min(1.0, 2 * (1 - step / (rounds + 1)))
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                self.weights[k] = (self.weights[k] - pace * move).astype(np.float32)
        return loss
