"""What the classifiers compute, against enumeration and an independent optimum."""

from __future__ import annotations

from itertools import product

import numpy as np

from tallyframe.llm import quality
from tallyframe.llm.quality import _Tokens, indicators, train_quality
from tallyframe.llm.toxicity import _forward_backward


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    for _ in range(60):
        lengths = rng.integers(1, 7, rng.integers(1, 5))
        odds = np.exp(rng.normal(0, 2, lengths.sum()))
        moves, start = np.exp(rng.normal(0, 1.5, (2, 2))), float(np.exp(rng.normal()))
        forward, backward = _forward_backward(odds, lengths, moves, start)
        found = forward * backward / (1 + forward * backward)
        wanted, at = [], 0
        for n in lengths.tolist():
            own, sums = odds[at : at + n], np.zeros(n)
            total = 0.0
            for states in product((0, 1), repeat=n):
                weight = start ** states[0] * np.prod([o**s for o, s in zip(own, states, strict=True)])
                weight *= np.prod([moves[a, b] for a, b in zip(states, states[1:], strict=False)])
                total += weight
                sums += weight * np.array(states)
            wanted += (sums / total).tolist()
            at += n
        assert np.allclose(found, wanted, rtol=1e-9)
    none = _forward_backward(np.empty(0), np.array([0, 0]), moves, start)
    assert [len(x) for x in none] == [0, 0]


def test_hinge_loss_is_at_its_optimum():
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(40)]
    sample = []
    for i in range(120):
        label = i % 3 != 0
        odds = np.linspace(1, 3, 40) if label else np.linspace(3, 1, 40)
        sample.append((" ".join(rng.choice(words, 15, p=odds / odds.sum())), int(label)))
    model = train_quality(sample)
    y = np.array([1.0 if label else -1.0 for _, label in sample])
    place, counts = indicators([t for t, _ in sample], _Tokens())
    x = np.zeros((len(y), quality.PLACES))
    x[np.repeat(np.arange(len(y)), counts), place] = model.ratios[place]
    x /= np.maximum(np.sqrt((x**2).sum(1, keepdims=True)), 1e-9)
    x = np.hstack([x[:, (x != 0).any(0)], np.ones((len(y), 1))])
    cost = quality.COST * len(y) / (2 * np.where(y > 0, (y > 0).sum(), (y < 0).sum()))
    # The dual optimum, by projected gradient steps on all multipliers at once.
    q = (x * y[:, None]) @ (x * y[:, None]).T
    alpha, step = np.zeros(len(y)), 1 / np.linalg.eigvalsh(q)[-1]
    for _ in range(20_000):
        alpha = np.clip(alpha + step * (1 - q @ alpha), 0, cost)
    best = alpha.sum() - alpha @ q @ alpha / 2
    used = model.ratios != 0
    w = np.zeros(quality.PLACES)
    w[used] = model.weights[used] / model.ratios[used]
    margins = np.array([m for m in model.margins([t for t, _ in sample], _Tokens())])
    reached = (w @ w + model.bias**2) / 2 + (cost * np.maximum(0, 1 - y * margins)).sum()
    # Weak duality: no weights are below the dual optimum; these are close to it.
    assert best <= reached + 1e-9 and reached <= 1.03 * best
