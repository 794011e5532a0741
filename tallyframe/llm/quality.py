"""Quality of documents by a support vector machine on naive Bayes features."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tallyframe.llm.common import labelled_sample, slices, with_text

#: Labelled texts that the model is trained on, at most, by class.
TRAINING_TEXTS = {1: 2000, 0: 1500}
#: Documents with at least this score are good.
THRESHOLD = 0.5
#: n-grams are hashed to this many places.
PLACES = 1 << 18
#: Tokens that a task keeps the hashes of.
KEPT_TOKENS = 300_000

#: Weight of one more document with each n-gram in either class.
SMOOTHING = 1.0
#: Largest multiplier of a training text, and passes of coordinate descent.
COST, PASSES = 1.0, 12

REPEATED = np.uint64(0x9E3779B97F4A7C15)
ORDERS = [np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]

_CLASSES = ((re.compile(r"[^\W\d_A-ZÀ-Þ]+"), "a"), (re.compile(r"[A-ZÀ-Þ]+"), "A"), (re.compile(r"\d+"), "0"), (re.compile(r"(.)\1+"), r"\1"))


def shape(token: str) -> str:
    """A token with its letters, capitals, digits and repeated signs drawn together."""
    for pattern, sign in _CLASSES:
        token = pattern.sub(sign, token)
    return token


class _Tokens(dict):
    """Numbers of tokens, with the hashes of their shape and of their lower case."""

    def __init__(self):
        super().__init__()
        self.shapes, self.words = array("Q"), array("Q")

    def __missing__(self, token: str) -> int:
        self.shapes.append(xxhash.xxh64_intdigest(shape(token)))
        self.words.append(xxhash.xxh64_intdigest(token.lower()))
        number = self[token] = len(self.shapes) - 1
        return number


def indicators(texts: list[str], tokens: _Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Sorted places of the n-grams of each text, once each, and their numbers.

    Tokens stand between white space. Taken are single tokens in lower case, and one,
    two and three shapes in a row, where a shape also says if its token repeats the one
    before.
    """
    if len(tokens) > KEPT_TOKENS:
        tokens.clear()
        tokens.shapes, tokens.words = array("Q"), array("Q")
    get = tokens.__getitem__
    numbers = [np.fromiter(map(get, t.split()), np.int64) for t in texts]
    sizes = np.array([len(n) for n in numbers], dtype=np.int64)
    number = np.concatenate([*numbers, np.empty(0, np.int64)])
    text = np.repeat(np.arange(len(texts)), sizes)
    words = np.array(tokens.words, dtype=np.uint64)[number]
    shapes = np.array(tokens.shapes, dtype=np.uint64)[number]
    follows = np.concatenate([[False], text[1:] == text[:-1]])[: len(text)]
    repeats = follows & np.concatenate([[False], words[1:] == words[:-1]])[: len(text)]
    shapes = shapes + repeats * REPEATED
    two = shapes[:-1] * ORDERS[1] + shapes[1:]
    three = two[:-1] * ORDERS[2] + shapes[2:]
    inside = follows[1:]
    grams = [
        (words * ORDERS[3], text),
        (shapes * ORDERS[0], text),
        (two[inside], text[1:][inside]),
        (three[inside[1:] & inside[:-1]], text[2:][inside[1:] & inside[:-1]]),
    ]
    keys = [
        t * PLACES + (h * ORDERS[0] >> np.uint64(64 - 18)).astype(np.int64) for h, t in grams
    ]
    keys = np.sort(np.concatenate(keys))
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)]]
    owner, place = keys // PLACES, keys % PLACES
    return place, np.bincount(owner, minlength=len(texts)) if len(keys) else np.zeros(len(texts), np.int64)


@dataclass
class QualityModel:
    weights: np.ndarray  # of the places, with their naive Bayes ratios multiplied in
    ratios: np.ndarray
    bias: float
    scale: tuple[float, float]

    def margins(self, texts: list[str], tokens: _Tokens) -> np.ndarray:
        place, counts = indicators(texts, tokens)
        owner = np.repeat(np.arange(len(texts)), counts)
        sums = np.bincount(owner, self.weights[place], len(texts))
        norms = np.sqrt(np.bincount(owner, self.ratios[place] ** 2, len(texts)))
        return sums / np.maximum(norms, 1e-9) + self.bias

    def scores(self, texts: list[str], tokens: _Tokens) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self.margins(texts, tokens) + b, -30, 30)))


def train_quality(sample: list[tuple[str, int]], seed: int = 7) -> QualityModel | None:
    """A model from labelled texts; None without both classes.

    The n-gram indicators of a text are scaled by the logarithm of the ratio of their
    shares in good and bad texts, the vector is brought to length 1, and a linear
    machine with hinge loss is fitted by dual coordinate descent: one multiplier per
    text is set to its best value, the others fixed, in random order.
    """
    y = np.array([1.0 if label else -1.0 for _, label in sample])
    if len(set(y.tolist())) < 2:
        return None
    tokens = _Tokens()
    place, counts = indicators([text for text, _ in sample], tokens)
    ends = np.cumsum(counts)
    good = np.repeat(y > 0, counts)
    share = [np.bincount(place[side], minlength=PLACES) + SMOOTHING for side in (good, ~good)]
    ratios = np.log(share[0] / share[0].sum()) - np.log(share[1] / share[1].sum())
    rows = []
    for end, count in zip(ends.tolist(), counts.tolist(), strict=True):
        at = place[end - count : end]
        value = ratios[at]
        rows.append((at, value / max(np.sqrt(value @ value), 1e-9)))
    weights, bias = np.zeros(PLACES), 0.0
    alpha = np.zeros(len(y))
    # Each class has the same total cost.
    cost = np.where(y > 0, COST * len(y) / (2 * (y > 0).sum()), COST * len(y) / (2 * (y < 0).sum()))
    lengths = np.array([value @ value + 1.0 for _, value in rows])
    rng = np.random.default_rng(seed)
    for _ in range(PASSES):
        for i in rng.permutation(len(y)).tolist():
            at, value = rows[i]
            slope = y[i] * (weights[at] @ value + bias) - 1
            new = min(max(alpha[i] - slope / lengths[i], 0.0), cost[i])
            if step := (new - alpha[i]) * y[i]:
                weights[at] += step * value
                bias += step
                alpha[i] = new
    model = QualityModel(weights * ratios, ratios, bias, (1.0, 0.0))
    margins = np.array([weights[at] @ value + bias for at, value in rows])
    model.scale = _sigmoid(margins, (y > 0).astype(float))
    return model


def _sigmoid(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities, both classes alike."""
    x = np.stack([margins, np.ones(len(y))], axis=1)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum()) * len(y)
    w = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(2)
        w += np.linalg.solve(hessian, x.T @ (weight * (y - p)) - (w - [1.0, 0.0]))
    return max(float(w[0]), 1e-3), float(w[1])


def quality(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, score`` per row of ``docs``: between 0 and 1, higher is better.

    Null texts are empty, and empty ones get the score of the bias alone. ``labels``
    (the id, ``quality``) are learned from where the id is not held out; without both
    classes every score is 0.5. The model is trained when this is called; scoring needs
    no shuffle.
    """
    model = train_quality(labelled_sample(docs, labels, "quality", TRAINING_TEXTS, id=id, text=text))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _Tokens()
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            scores = np.full(len(texts), 0.5) if model is None else model.scores(texts, tokens)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return with_text(docs, id, text).mapInArrow(score, "doc_id bigint, score double")
