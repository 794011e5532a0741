"""A bidirectional LSTM with a conditional random field on top, in numpy.

Arrays are laid out as step, window, feature: all windows of a batch step together.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

F32 = np.float32
TINY = F32(1e-30)


@dataclass
class Tagger:
    """Parameters of the network; ``allowed`` masks the transitions between tags."""

    table: np.ndarray  # characters to inputs
    into: list[np.ndarray]  # per direction, inputs to gates
    again: list[np.ndarray]  # per direction, state to gates
    shift: list[np.ndarray]
    out: np.ndarray  # both states to tags
    out_shift: np.ndarray
    moves: np.ndarray  # tags to tags
    allowed: np.ndarray

    @staticmethod
    def new(characters: int, tags: int, allowed: np.ndarray, inputs: int, states: int, seed: int) -> Tagger:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0])).astype(F32)
        shift = np.zeros(4 * states, F32)
        shift[states : 2 * states] = 1  # remember at first
        return Tagger(
            draw(characters, inputs) * F32(3),
            [draw(inputs, 4 * states) for _ in "fb"],
            [draw(states, 4 * states) for _ in "fb"],
            [shift.copy() for _ in "fb"],
            draw(2 * states, tags),
            np.zeros(tags, F32),
            np.zeros((tags, tags), F32),
            allowed,
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.table, *self.into, *self.again, *self.shift, self.out, self.out_shift, self.moves]

    # --- forward ---------------------------------------------------------

    def _run(self, chars: np.ndarray, side: int, keep: bool) -> tuple[np.ndarray, list]:
        """States of one direction; the steps of ``chars`` are in its order."""
        gates = (self.table @ self.into[side] + self.shift[side])[chars]
        states = self.again[side].shape[0]
        again = self.again[side]
        h = np.zeros((chars.shape[1], states), F32)
        c = np.zeros_like(h)
        out, kept = np.empty((len(chars), *h.shape), F32), []
        for step in range(len(chars)):
            z = gates[step] + h @ again
            z[:, : 3 * states] *= F32(0.5)
            np.tanh(z, out=z)
            z[:, : 3 * states] = z[:, : 3 * states] * F32(0.5) + F32(0.5)
            i, f, o, g = (z[:, n * states : (n + 1) * states] for n in range(4))
            before = c
            c = f * before + i * g
            tanh_c = np.tanh(c)
            h = o * tanh_c
            out[step] = h
            if keep:
                kept.append((z, before, tanh_c))
        return out, kept

    def emissions(self, chars: np.ndarray) -> np.ndarray:
        """Scores of the tags, from character numbers ``[step, window]``."""
        ahead, _ = self._run(chars, 0, False)
        back, _ = self._run(chars[::-1], 1, False)
        return np.concatenate([ahead, back[::-1]], axis=2) @ self.out + self.out_shift

    def decode(self, chars: np.ndarray) -> np.ndarray:
        """The most probable tags (Viterbi), ``[step, window]``."""
        scores = self.emissions(chars)
        moves = np.where(self.allowed, self.moves, F32(-1e4))
        best, origin = scores[0] + np.where(self.allowed[0], F32(0), F32(-1e4)), []
        for step in range(1, len(scores)):
            ways = best[:, :, None] + moves
            origin.append(ways.argmax(1))
            best = ways.max(1) + scores[step]
        tags = np.empty(chars.shape, np.int64)
        tags[-1] = best.argmax(1)
        for step in range(len(scores) - 2, -1, -1):
            tags[step] = np.take_along_axis(origin[step], tags[step + 1][:, None], 1)[:, 0]
        return tags

    # --- training --------------------------------------------------------

    def gradients(self, chars: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean log-likelihood of the tags per window, and its gradients."""
        steps, windows = chars.shape
        ahead, kept_ahead = self._run(chars, 0, True)
        back, kept_back = self._run(chars[::-1], 1, True)
        both = np.concatenate([ahead, back[::-1]], axis=2)
        scores = both @ self.out + self.out_shift
        value, d_scores, d_moves = self._field(scores, tags)
        d_out = np.tensordot(both, d_scores, ((0, 1), (0, 1)))
        d_both = d_scores @ self.out.T
        states = self.again[0].shape[0]
        d_table = np.zeros_like(self.table)
        sides = []
        for side, (order, kept, d) in enumerate(
            ((chars, kept_ahead, d_both[:, :, :states]), (chars[::-1], kept_back, d_both[::-1, :, states:]))
        ):
            h = ahead if side == 0 else back
            d_again = np.zeros_like(self.again[side])
            d_gates = np.empty((steps, windows, 4 * states), F32)
            d_h, d_c = np.zeros((windows, states), F32), np.zeros((windows, states), F32)
            for step in range(steps - 1, -1, -1):
                z, before, tanh_c = kept[step]
                i, f, o, g = (z[:, n * states : (n + 1) * states] for n in range(4))
                d_h = d_h + d[step]
                d_c = d_c + d_h * o * (1 - tanh_c**2)
                at = d_gates[step]
                at[:, :states] = d_c * g * i * (1 - i)
                at[:, states : 2 * states] = d_c * before * f * (1 - f)
                at[:, 2 * states : 3 * states] = d_h * tanh_c * o * (1 - o)
                at[:, 3 * states :] = d_c * i * (1 - g**2)
                if step:
                    d_again += h[step - 1].T @ at
                d_h = at @ self.again[side].T
                d_c = d_c * f
            flat = d_gates.reshape(-1, 4 * states)
            by_char = np.zeros((len(self.table), 4 * states), F32)
            np.add.at(by_char, order.ravel(), flat)
            d_table += by_char @ self.into[side].T
            sides.append((self.table.T @ by_char, d_again, flat.sum(0)))
        gradients = [d_table, *(s[0] for s in sides), *(s[1] for s in sides), *(s[2] for s in sides)]
        gradients += [d_out, d_scores.sum((0, 1)), d_moves]
        return value, [g / windows for g in gradients]

    def _field(self, scores: np.ndarray, tags: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Log-likelihood, and observed less expected tags and transitions."""
        steps, windows, count = scores.shape
        factors = np.where(self.allowed, np.exp(self.moves), F32(0))
        local = np.exp(scores - scores.max(2, keepdims=True))
        first = local[0] * self.allowed[0]
        ahead = np.empty_like(local)
        total = np.log(first.sum(1)) + scores.max(2).sum(0)
        ahead[0] = first / first.sum(1, keepdims=True)
        for step in range(1, steps):
            a = (ahead[step - 1] @ factors) * local[step]
            size = a.sum(1, keepdims=True) + TINY
            ahead[step] = a / size
            total += np.log(size[:, 0])
        marginal = np.empty_like(local)
        marginal[-1] = ahead[-1]
        after = np.ones((windows, count), F32)
        moved = np.zeros((count, count), F32)
        for step in range(steps - 2, -1, -1):
            weight = local[step + 1] * after
            reach = weight @ factors.T
            size = (ahead[step] * reach).sum(1, keepdims=True) + TINY
            moved += factors * ((ahead[step] / size).T @ weight)
            marginal[step] = ahead[step] * reach / size
            after = reach / (reach.sum(1, keepdims=True) + TINY)
        seen = np.zeros((count, count), F32)
        np.add.at(seen, (tags[:-1].ravel(), tags[1:].ravel()), F32(1))
        gold = np.take_along_axis(scores, tags[:, :, None], 2)[:, :, 0].sum(0)
        gold = gold + self.moves[tags[:-1], tags[1:]].sum(0)
        d_scores = -marginal
        at = np.take_along_axis(d_scores, tags[:, :, None], 2) + 1
        np.put_along_axis(d_scores, tags[:, :, None], at, 2)
        return float((gold - total).mean()), d_scores, (seen - moved) * self.allowed


def fit(tagger: Tagger, chars: np.ndarray, tags: np.ndarray, updates: int, batch: int, seed: int) -> float:
    """Adam on random batches of the windows (columns); returns the last mean value."""
    rng = np.random.default_rng(seed)
    parameters = tagger.parameters()
    mean, square = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    values = []
    for update in range(1, updates + 1):
        pick = rng.integers(0, chars.shape[1], batch)
        value, gradients = tagger.gradients(chars[:, pick], tags[:, pick])
        values.append(value)
        norm = np.sqrt(sum(float((g**2).sum()) for g in gradients))
        rate = 0.02 * min(1.0, 5.0 / max(norm, 1e-9)) if update < 20 else 0.02 * (1 - update / (updates + 1))
        for p, g, m, s in zip(parameters, gradients, mean, square, strict=True):
            m += F32(0.1) * (g - m)
            s += F32(0.01) * (g**2 - s)
            p += F32(rate / (1 - 0.9**update)) * m / (np.sqrt(s / F32(1 - 0.99**update)) + F32(1e-6))
    return float(np.mean(values[-10:]))
