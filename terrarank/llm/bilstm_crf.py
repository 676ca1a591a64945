"""Character tagger: bidirectional LSTM with CRF transitions, forward and backward passes in numpy."""

from __future__ import annotations

import numpy as np

#: Characters: printable ASCII one by one, then other letters, line breaks, everything else, padding.
LETTER, BREAK, OTHER, PAD = 95, 96, 97, 98
ALPHABET = 99


def char_codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    codes = np.where(points >= 0xC0, LETTER, OTHER)
    codes = np.where((points >= 0x20) & (points < 0x7F), points - 0x20, codes)
    return np.where((points == 10) | (points == 13), BREAK, codes).astype(np.int16)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Tagger:
    """Embedding, one LSTM each way, linear emissions and CRF transitions."""

    def __init__(self, n_tags: int, hidden: int = 16, embed: int = 12, seed: int = 7):
        rnd = np.random.default_rng(seed)

        def init(*shape):
            return (rnd.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.hidden, self.n_tags = hidden, n_tags
        self.p = {"embed": init(ALPHABET, embed), "out": init(2 * hidden, n_tags), "out_b": np.zeros(n_tags, np.float32),
                  "trans": np.zeros((n_tags, n_tags), np.float32), "start": np.zeros(n_tags, np.float32)}
        for side in "fb":
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden:2 * hidden] = 1.0  # forget gates start open
            self.p |= {f"w{side}": init(embed, 4 * hidden), f"u{side}": init(hidden, 4 * hidden), f"b{side}": bias}

    def _run(self, side: str, codes: np.ndarray, keep: bool):
        """States of one direction over (time, batch) codes; padding leaves the state as it is."""
        h, p = self.hidden, self.p
        gates_of = p["embed"] @ p[f"w{side}"] + p[f"b{side}"]
        steps, n = codes.shape
        state, cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        out, tape = np.zeros((steps, n, h), np.float32), []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = gates_of[codes[t]] + state @ p[f"u{side}"]
            s = _sigmoid(z[:, :3 * h])
            i, f, o, g = s[:, :h], s[:, h:2 * h], s[:, 2 * h:], np.tanh(z[:, 3 * h:])
            new_cell = f * cell + i * g
            squashed = np.tanh(new_cell)
            live = (codes[t] != PAD)[:, None]
            if keep:
                tape.append((t, i, f, o, g, squashed, cell, state, live))
            cell = np.where(live, new_cell, cell)
            state = np.where(live, o * squashed, state)
            out[t] = state
        return out, tape

    def emissions(self, codes: np.ndarray, keep: bool = False):
        forward, tape_f = self._run("f", codes, keep)
        backward, tape_b = self._run("b", codes, keep)
        both = np.concatenate([forward, backward], axis=2)
        return both @ self.p["out"] + self.p["out_b"], both, tape_f, tape_b

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """Best tag paths (Viterbi) for (batch, time) codes; tags behind the padding mean nothing."""
        codes = codes.T
        scores = self.emissions(codes)[0]
        steps, n, k = scores.shape
        best, back = self.p["start"] + scores[0], np.zeros((steps, n, k), np.int8)
        for t in range(1, steps):
            paths = best[:, :, None] + self.p["trans"]
            back[t] = paths.argmax(axis=1)
            step = np.take_along_axis(paths, back[t][:, None, :].astype(np.int64), axis=1)[:, 0] + scores[t]
            live = (codes[t] != PAD)[:, None]
            back[t] = np.where(live, back[t], np.arange(k))
            best = np.where(live, step, best)
        tags = np.zeros((steps, n), np.int8)
        tags[-1] = best.argmax(axis=1)
        for t in range(steps - 1, 0, -1):
            tags[t - 1] = back[t][np.arange(n), tags[t]]
        return tags.T

    def gradients(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood per sequence, and its gradients (batch, time inputs)."""
        codes, tags = codes.T, tags.T.astype(np.int64)
        scores, both, tape_f, tape_b = self.emissions(codes, keep=True)
        steps, n, k = scores.shape
        trans, rows, p = self.p["trans"], np.arange(n), self.p
        live = codes != PAD

        def logsum(x, axis):
            top = x.max(axis=axis, keepdims=True)
            return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))

        alpha = np.zeros((steps, n, k), np.float32)
        alpha[0] = p["start"] + scores[0]
        for t in range(1, steps):
            step = logsum(alpha[t - 1][:, :, None] + trans, 1) + scores[t]
            alpha[t] = np.where(live[t][:, None], step, alpha[t - 1])
        total = logsum(alpha[-1], 1)
        beta = np.zeros((steps, n, k), np.float32)
        grads = {name: np.zeros_like(v) for name, v in p.items()}
        d_scores = np.zeros_like(scores)
        gold = p["start"][tags[0]] + scores[0][rows, tags[0]]
        for t in range(steps - 1, -1, -1):
            if t + 1 < steps:
                on = live[t + 1][:, None]
                ahead = scores[t + 1] + beta[t + 1]
                beta[t] = np.where(on, logsum(trans + ahead[:, None, :], 2), beta[t + 1])
                pair = np.exp(np.minimum(alpha[t][:, :, None] + trans + ahead[:, None, :] - total[:, None, None], 0))
                grads["trans"] += (pair * on[:, :, None]).sum(axis=0)
                np.add.at(grads["trans"], (tags[t], tags[t + 1]), -live[t + 1].astype(np.float32))
                gold = gold + live[t + 1] * (trans[tags[t], tags[t + 1]] + scores[t + 1][rows, tags[t + 1]])
            d_scores[t] = np.exp(alpha[t] + beta[t] - total[:, None]) * live[t][:, None]
            d_scores[t][rows, tags[t]] -= live[t]
        grads["start"] = d_scores[0].sum(axis=0)
        grads["out"] = np.tensordot(both, d_scores, axes=([0, 1], [0, 1]))
        grads["out_b"] = d_scores.sum(axis=(0, 1))
        d_both = d_scores @ p["out"].T
        self._back("f", codes, tape_f, d_both[:, :, :self.hidden], grads)
        self._back("b", codes, tape_b, d_both[:, :, self.hidden:], grads)
        return float((total - gold).mean()), {name: g / n for name, g in grads.items()}

    def _back(self, side: str, codes: np.ndarray, tape: list, d_out: np.ndarray, grads: dict) -> None:
        p, n = self.p, codes.shape[1]
        d_state, d_cell = np.zeros((n, self.hidden), np.float32), np.zeros((n, self.hidden), np.float32)
        per_code = np.zeros((ALPHABET, 4 * self.hidden), np.float32)
        for t, i, f, o, g, squashed, cell, state, live in reversed(tape):
            d_state = d_state + d_out[t]
            dc = d_cell + d_state * o * (1 - squashed ** 2)
            dz = np.concatenate([dc * g * i * (1 - i), dc * cell * f * (1 - f), d_state * squashed * o * (1 - o),
                                 dc * i * (1 - g ** 2)], axis=1) * live
            grads[f"u{side}"] += state.T @ dz
            np.add.at(per_code, codes[t], dz)
            d_state = np.where(live, dz @ p[f"u{side}"].T, d_state)
            d_cell = np.where(live, dc * f, d_cell)
        grads[f"b{side}"] += per_code.sum(axis=0)
        grads[f"w{side}"] += p["embed"].T @ per_code
        grads["embed"] += per_code @ p[f"w{side}"].T

    def fit(self, codes: np.ndarray, tags: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.02,
            seed: int = 11) -> list[float]:
        """Adam over shuffled batches; returns the mean loss of each epoch."""
        rnd, losses, step = np.random.default_rng(seed), [], 0
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        for epoch in range(epochs):
            order, seen = rnd.permutation(len(codes)), []
            for at in range(0, len(order), batch):
                take, step = order[at:at + batch], step + 1
                loss, grads = self.gradients(codes[take], tags[take])
                seen.append(loss)
                size = np.sqrt(sum(float((g ** 2).sum()) for g in grads.values()))
                pace = rate * (1 - epoch / epochs)
                for k, g in grads.items():
                    g = g * min(1.0, 5.0 / (size + 1e-9))
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    self.p[k] = (self.p[k] - pace * (first[k] / (1 - 0.9 ** step))
                                 / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
            losses.append(float(np.mean(seen)))
        return losses
