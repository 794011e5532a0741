"""Toxic spans and documents by a linear-chain conditional random field."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyframe.llm.common import labelled_sample, slices, with_text

#: Labelled texts that the model is trained on, at most, by class.
TRAINING_TEXTS = {1: 800, 0: 1600}
#: Documents with at least this score are toxic.
THRESHOLD = 0.7
#: A token is reported with at least this marginal probability.
SPAN_PROBABILITY = 0.5

WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
PREFIXES = (3, 4, 5, 6)
#: Tokens on either side of a labelled one that are trained on with it.
AROUND = 12
ROUNDS = 60
#: Words that a task keeps the emissions of.
KEPT_WORDS = 200_000


def _keys(word: str) -> list[str]:
    """Features of a word: itself, its beginnings and its end."""
    word = word.lower()
    return [
        f"={word}",
        *(f"{n}{word[:n]}" for n in (2, *PREFIXES[:3]) if len(word) >= n),
        f"-{word[-3:]}",
    ]


def _telling(word: str) -> list[str]:
    """Of these, the ones that may tell a toxic word from others."""
    word = word.lower()
    return [f"={word}", *(f"{n}{word[:n]}" for n in PREFIXES if len(word) > n)]


def toxic_marks(texts: list[list[str]], labels: list[int]) -> list[np.ndarray]:
    """A flag per token: the toxic ones, as far as labels of whole documents tell.

    Only documents are labelled, so the labelled tokens are found first, by the words
    and beginnings of words that explain the labels: of all that are frequent in toxic
    documents and rare in others, the one in most toxic documents without an explanation
    yet, again and again. A beginning that common words share explains only documents
    that repeat it. Words that only happen to stand in copies of a toxic document are
    not chosen, as those documents are explained already.
    """
    memory: dict[str, list[str]] = {}
    toxic = [i for i, label in enumerate(labels) if label]
    places: dict[tuple[str, int], set[int]] = {}
    for i in toxic:
        for key in _repeated(texts[i], memory, None):
            places.setdefault(key, set()).add(i)
    able = {key: found for key, found in places.items() if len(found) >= 3}
    wanted, memory = {key for key, _ in able}, {}
    clean: Counter[tuple[str, int]] = Counter()
    for words, label in zip(texts, labels, strict=True):
        if not label:
            clean.update(_repeated(words, memory, wanted))
    share = max(1, len(texts) - len(toxic)) / max(1, len(toxic))
    most = {1: 0.02 * share, 2: 0.1 * share}
    able = {key: found for key, found in able.items() if clean[key] <= most[key[1]] * len(found)}
    chosen: dict[int, set[str]] = {1: set(), 2: set()}
    while able:
        best = max(able, key=lambda k: (len(able[k]), -clean[k], len(k[0]), k))
        explained = able.pop(best)
        chosen[best[1]].add(best[0])
        able = {k: rest for k, found in able.items() if len(rest := found - explained) >= 3}
    marks = []
    for words, label in zip(texts, labels, strict=True):
        mark = np.zeros(len(words), dtype=bool)
        if label:
            keys = [_telling(word) for word in words]
            times = Counter(key for found in keys for key in found if key in chosen[2])
            for i, found in enumerate(keys):
                mark[i] = any(k in chosen[1] or times[k] > 1 for k in found)
        marks.append(mark)
    return marks


def _repeated(
    words: list[str], memory: dict[str, list[str]], wanted: set[str] | None
) -> Iterator[tuple[str, int]]:
    """The keys of a document with 1, and those that several of its tokens have with 2."""
    times: Counter[str] = Counter()
    for word, count in Counter(words).items():
        keys = memory.get(word)
        if keys is None:
            keys = memory[word] = [k for k in _telling(word) if wanted is None or k in wanted]
        for key in keys:
            times[key] += count
    for key, count in times.items():
        yield key, 1
        if count > 1:
            yield key, 2


@dataclass
class ToxicityModel:
    """Weights of a chain with two states, other and toxic, and of the document score."""

    weights: dict[str, float]
    bias: float
    moves: np.ndarray  # factors from state to state
    start: float  # odds of toxic at the start of a text
    document: tuple[float, float, float]

    def emission(self, word: str) -> float:
        """The odds of toxic against other that a word alone gives."""
        total = self.bias + sum(self.weights.get(key, 0.0) for key in _keys(word))
        return float(np.exp(min(max(total, -30.0), 30.0)))

    def marginals(self, odds: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Forward-backward over many texts at once; their tokens follow each other."""
        forward, backward = _forward_backward(odds, lengths, self.moves, self.start)
        both = forward * backward
        return both / (1 + both)

    def score(self, largest: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Document scores from the greatest marginal and the sum of marginals."""
        a, b, c = self.document
        return 1 / (1 + np.exp(-(a * _logit(largest) + b * np.log1p(total) + c)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _forward_backward(
    odds: np.ndarray, lengths: np.ndarray, moves: np.ndarray, start: float
) -> tuple[np.ndarray, np.ndarray]:
    """Odds of toxic per token from all before it with it, and from all after it.

    With two states one number per token is enough. All texts step forward together,
    the longest first, so that those still running are always the first ones.
    """
    (oo, ot), (to, tt) = moves
    begin = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    begin, sizes = begin[order], lengths[order]
    running = np.searchsorted(-sizes, -np.arange(1, int(sizes.max(initial=0)) + 1), side="right")
    forward, backward = np.empty_like(odds), np.ones_like(odds)
    before = np.empty(0)
    for step, live in enumerate(running.tolist()):
        at = begin[:live] + step
        if step == 0:
            before = odds[at] * start
        else:
            before = before[:live]
            before = odds[at] * (ot + before * tt) / (oo + before * to)
        before = np.clip(before, 1e-30, 1e30)
        forward[at] = before
    after = np.empty(0)
    for step in range(len(running) - 2, -1, -1):
        live = int(running[step + 1])
        at = begin[:live] + step + 1
        grown = np.ones(live)
        grown[: len(after)] = after
        weight = odds[at] * grown
        after = np.clip((to + weight * tt) / (oo + weight * ot), 1e-30, 1e30)
        backward[at - 1] = after
    return forward, backward


def train_toxicity(sample: list[tuple[str, int]], rounds: int = ROUNDS) -> ToxicityModel | None:
    """A model from labelled texts; None without both classes or without toxic words."""
    labels = [label for _, label in sample]
    if len(set(labels)) < 2:
        return None
    # One string object per distinct word: a place then takes 8 bytes and not 60.
    shared: dict[str, str] = {}
    texts = [[shared.setdefault(w, w) for w in WORD.findall(text)] for text, _ in sample]
    marks = toxic_marks(texts, labels)
    if not any(mark.any() for mark in marks):
        return None
    clean = [words for words, label in zip(texts, labels, strict=True) if not label]
    windows = [
        _window(words, mark, place)
        for words, mark in zip(texts, marks, strict=True)
        for place in np.flatnonzero(mark)[:5].tolist()
    ]
    windows += [_window(w, None, place) for w in clean for place in range(0, len(w), 97)[:3]]
    model = _fit_chain(windows, rounds // 2)
    # Once more, with the clean words that it took for toxic.
    odds = {word: model.emission(word) for words in clean for word in set(words)}
    doubtful = {w for w, o in odds.items() if o * model.moves[0, 1] > 0.01 * model.moves[0, 0]}
    for words in clean:
        windows += [_window(words, None, i) for i, w in enumerate(words) if w in doubtful][:6]
    model = _fit_chain(windows, rounds)
    largest, total, _ = document_marginals(model, texts)
    model.document = _fit_document(largest, total, np.array(labels, dtype=float))
    return model


def _window(words: list[str], mark: np.ndarray | None, place: int) -> tuple[list[str], np.ndarray]:
    """Tokens around a place with their flags; without flags none is toxic."""
    cut = slice(max(0, place - AROUND), place + AROUND + 1)
    return words[cut], np.zeros(len(words[cut]), dtype=bool) if mark is None else mark[cut]


def _fit_chain(windows: list[tuple[list[str], np.ndarray]], rounds: int) -> ToxicityModel:
    """Maximum likelihood with a small penalty, by Adam on the whole sample."""
    types = {w: i for i, w in enumerate(dict.fromkeys(w for words, _ in windows for w in words))}
    names: dict[str, int] = {"": 0}
    keys = [[names.setdefault(k, len(names)) for k in _keys(w)] for w in types]
    table = np.zeros((len(types), max(map(len, keys))), dtype=np.int64)
    for row, ids in zip(table, keys, strict=True):
        row[: len(ids)] = ids
    length = 2 * AROUND + 1
    lengths = np.array([len(words) for words, _ in windows])
    tokens = np.array([types[w] for words, _ in windows for w in words])
    y = np.concatenate([mark for _, mark in windows]).astype(float)
    ends = np.cumsum(lengths)
    first = ends - lengths
    inner = np.ones(len(tokens), dtype=bool)
    inner[ends - 1] = False  # tokens with one after them in their window
    here = np.flatnonzero(inner)
    seen = np.array([[(y[here] == i) @ (y[here + 1] == j) for j in (0, 1)] for i in (0, 1)], float)
    theta = np.zeros(len(names) + 1 + 4 + 1)
    theta[len(names)] = -4.0
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    assert lengths.max() <= length
    for round_ in range(1, rounds + 1):
        weights, bias = theta[: len(names)], theta[len(names)]
        moves, start = np.exp(theta[-5:-1].reshape(2, 2)), np.exp(theta[-1])
        odds = np.exp(np.clip(weights[table].sum(1) + bias, -30, 30))[tokens]
        forward, backward = _forward_backward(odds, lengths, moves, start)
        p = forward * backward / (1 + forward * backward)
        a = np.stack([np.ones(len(here)), forward[here]])
        b = np.stack([np.ones(len(here)), odds[here + 1] * backward[here + 1]])
        joint = a[:, None] * moves[:, :, None] * b[None]
        joint /= joint.sum((0, 1))
        by_type = np.bincount(tokens, y - p, len(types))
        gradient = np.zeros_like(theta)
        gradient[: len(names)] = np.bincount(table.ravel(), np.repeat(by_type, table.shape[1]), len(names))
        gradient[len(names)] = (y - p).sum()
        gradient[-5:-1] = (seen - joint.sum(2)).ravel()
        gradient[-1] = (y[first] - p[first]).sum()
        gradient -= 0.05 * theta
        gradient[0] = 0
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta += 0.15 * (mean / (1 - 0.9**round_)) / (np.sqrt(square / (1 - 0.99**round_)) + 1e-8)
    weights = {name: float(theta[i]) for name, i in names.items() if abs(theta[i]) > 1e-3}
    moves, start = np.exp(theta[-5:-1].reshape(2, 2)), float(np.exp(theta[-1]))
    return ToxicityModel(weights, float(theta[len(names)]), moves, start, (1.0, 0.0, 0.0))


def _fit_document(largest: np.ndarray, total: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression of the label."""
    x = np.stack([_logit(largest), np.log1p(total), np.ones(len(y))], axis=1)
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.eye(3)
        w += np.linalg.solve(hessian, x.T @ (y - p) - w)
    return tuple(w.tolist())


class _Emissions(dict):
    def __init__(self, model: ToxicityModel):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= KEPT_WORDS:
            self.clear()
        odds = self[word] = self.model.emission(word)
        return odds


def document_marginals(
    model: ToxicityModel, texts: Iterable[list[str]], known: dict[str, float] | None = None
) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Greatest marginal, sum of marginals, and the marginals of each list of words.

    The lists may come from a generator, and only one of them is kept at a time.
    """
    get = (known if known is not None else _Emissions(model)).__getitem__
    odds = [np.fromiter(map(get, words), float, len(words)) for words in texts]
    lengths = np.array([len(o) for o in odds], dtype=np.int64)
    marginals = model.marginals(np.concatenate([*odds, np.empty(0)]), lengths)
    parts = np.split(marginals, np.cumsum(lengths)[:-1]) if len(odds) else []
    largest = np.array([p.max(initial=0.0) for p in parts])
    return largest, np.array([p.sum() for p in parts]), parts


def train_on(docs: DataFrame, labels: DataFrame, id: str, text: str) -> ToxicityModel | None:
    """A model from a bounded sample of the labelled rows, see ``labelled_sample``.

    The driver holds at most ``sum(TRAINING_TEXTS.values())`` texts of 32 KB, and of
    their words one object each.
    """
    return train_toxicity(labelled_sample(docs, labels, "toxic", TRAINING_TEXTS, id=id, text=text))


def toxicity(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, score, spans`` per row of ``docs``.

    ``spans`` are the toxic tokens as code points, end exclusive, with their marginal
    probability; neighbouring ones are merged, with the greatest of theirs. The score
    is between 0 and 1. Null and empty texts have no tokens and get the score of a text
    without a toxic token. ``labels`` (the id, ``toxic``) are learned from where the id
    is not held out; without both classes every score is 0. The model is trained when
    this is called; scoring needs no shuffle.
    """
    model = train_on(docs, labels, id, text)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Emissions(model)
        place = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())])
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            scores, parts = _scored(model, texts, known)
            found = [_spans(t, p) for t, p in zip(texts, parts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(found, pa.list_(place))],
                ["doc_id", "score", "spans"],
            )

    return with_text(docs, id, text).mapInArrow(
        score,
        "doc_id bigint, score double, spans array<struct<start: bigint, end: bigint, probability: double>>",
    )


def _scored(model: ToxicityModel | None, texts: list[str], known: dict) -> tuple[np.ndarray, list[np.ndarray]]:
    if model is None:
        return np.zeros(len(texts)), [np.empty(0)] * len(texts)
    largest, total, parts = document_marginals(model, map(WORD.findall, texts), known)
    return model.score(largest, total), parts


def _spans(text: str, marginals: np.ndarray) -> list[dict]:
    toxic = marginals >= SPAN_PROBABILITY
    if not toxic.any():
        return []
    places = [match.span() for match in WORD.finditer(text)]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], toxic.astype(np.int8), [0]])))
    return [
        {"start": places[a][0], "end": places[b - 1][1], "probability": float(marginals[a:b].max())}
        for a, b in edges.reshape(-1, 2).tolist()
    ]


def drop_toxic(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` with a score below ``threshold``, unchanged."""
    model = train_on(docs, labels, id, text)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Emissions(model)
        for batch in slices(batches, text):
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            scores, _ = _scored(model, texts, known)
            yield batch.filter(pa.array(scores < threshold))

    return docs.mapInArrow(keep, docs.schema)

