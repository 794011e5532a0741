"""Passages of benchmark items in training texts, found through FM-indexes."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import BYTE_WORD, slices, with_text
from tallyframe.llm.fmindex import FMIndex

WINDOW = 10
#: Test phrases are sent to the tasks in blocks of about this size.
BLOCK_BYTES = 16 << 20
#: Occurrences located together.
LOCATED = 1 << 20

#: The same words as BYTE_WORD, of a text in its own case.
WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def test_phrases(benchmark: DataFrame, id: str, text: str, window: int) -> DataFrame:
    """``item, phrase``: every run of ``window`` words of every item, lower-cased.

    An item of fewer words, but not none, is one phrase.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for item, words in zip(
                batch.column("item").to_pylist(),
                (BYTE_WORD.findall(t.encode().lower()) for t in batch.column("text").to_pylist()),
                strict=True,
            ):
                last = max(len(words) - window, 0) + 1 if words else 0
                phrases = [b" ".join(words[i : i + window]).decode() for i in range(last)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * last, pa.string()), pa.array(phrases, pa.string())],
                    ["item", "phrase"],
                )

    items = benchmark.select(
        benchmark[id].cast("string").alias("item"),
        F.coalesce(benchmark[text].cast("string"), F.lit("")).alias("text"),
    )
    return items.mapInArrow(cut, "item string, phrase string").distinct()


def phrase_blocks(phrases: DataFrame) -> list:
    """The phrases as broadcast blocks of bounded size, each with its own vocabulary.

    The driver holds one block at a time, and so does a task.
    """
    size = F.octet_length("phrase") + F.coalesce(F.octet_length("item"), F.lit(0)) + 64
    total = phrases.agg(F.sum(size)).first()[0] or 0
    count = -(-total // BLOCK_BYTES)
    blocks = []
    for number in range(count):
        mine = F.pmod(F.xxhash64("phrase"), F.lit(count)) == number
        rows = phrases.where(mine).toArrow().to_pydict()
        blocks.append(phrases.sparkSession.sparkContext.broadcast(_block(**rows)))
    return blocks


def _block(item: list[str | None], phrase: list[str]) -> dict:
    """Phrases as rows of word ids from 1, and the items that each comes from."""
    names = sorted({i for i in item if i is not None})
    place = {name: i for i, name in enumerate(names)}
    items: dict[str, list[int]] = {}
    for name, text in zip(item, phrase, strict=True):
        items.setdefault(text, []).extend([place[name]] if name is not None else [])
    split = [text.encode().split(b" ") for text in items]
    words = {word: i for i, word in enumerate(sorted({w for s in split for w in s}), 1)}
    lengths = np.array([len(s) for s in split], dtype=np.int64)
    ids = np.zeros((len(split), int(lengths.max(initial=1))), dtype=np.int32)
    for row, s in zip(ids, split, strict=True):
        row[: len(s)] = [words[w] for w in s]
    return {"words": words, "phrases": ids, "lengths": lengths, "items": list(items.values()), "names": names}


def hits(texts: list[str], blocks: Iterable[dict]) -> tuple[list[np.ndarray], list[set[str]]]:
    """Of each text a flag per word, and the items whose phrases occur in it.

    The texts are one training shard. For each block of phrases their words become ids
    of its vocabulary. Any other word cannot be part of an occurrence, so it ends a run,
    and runs shorter than the shortest phrase are left out of the index: it covers all
    places where a phrase can be.
    """
    flags: list[np.ndarray] | None = None
    items: list[set[str]] = [set() for _ in texts]
    for block in blocks:
        get = block["words"].get
        ids = [
            np.fromiter(map(get, BYTE_WORD.findall(t.encode().lower()), repeat(0)), np.int32)
            for t in texts
        ]
        if flags is None:
            flags = [np.zeros(len(i), dtype=bool) for i in ids]
        # All texts in one stream, each ended by a 0.
        ends = np.cumsum([len(i) + 1 for i in ids])
        stream = np.concatenate([part for i in ids for part in (i, np.zeros(1, np.int32))])
        known = np.concatenate([[False], stream > 0])
        edges = np.flatnonzero(known[1:] != known[:-1])
        first, last = edges[::2], edges[1::2]
        long = last - first >= block["lengths"].min()
        first, last = first[long], last[long]
        if not len(first):
            continue
        sizes = last - first + 1  # with the 0 that follows each run
        before = np.cumsum(sizes) - sizes
        where = np.repeat(first - before, sizes) + np.arange(sizes.sum())
        index = FMIndex(stream[where])
        lo, hi = index.search(block["phrases"], block["lengths"])
        found = np.flatnonzero(hi > lo)
        change = np.zeros(len(stream) + 1, dtype=np.int64)
        pairs = []
        for part in _parts(found, hi[found] - lo[found]):
            counts = hi[part] - lo[part]
            phrase = np.repeat(part, counts)
            within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            start = where[index.locate(lo[phrase] + within)]
            np.add.at(change, start, 1)
            np.add.at(change, start + block["lengths"][phrase], -1)
            text = np.searchsorted(ends, start, side="right")
            pairs.append(np.unique(text * len(hi) + phrase))
        hit = np.cumsum(change)[:-1] > 0
        for pair in np.unique(np.concatenate(pairs)) if pairs else ():
            text, phrase = divmod(int(pair), len(hi))
            items[text].update(block["names"][i] for i in block["items"][phrase])
        for text in np.unique(np.searchsorted(ends, np.flatnonzero(hit), side="right")):
            end = ends[text] - 1
            flags[text] |= hit[end - len(flags[text]) : end]
    if flags is None:
        flags = [np.zeros(len(BYTE_WORD.findall(t.encode().lower())), dtype=bool) for t in texts]
    return flags, items


def _parts(phrases: np.ndarray, counts: np.ndarray) -> Iterator[np.ndarray]:
    """Phrases in parts of about LOCATED occurrences."""
    cuts = np.flatnonzero(np.diff(np.cumsum(counts) // LOCATED)) + 1
    yield from np.split(phrases, cuts)


def spans(text: str, flags: np.ndarray) -> list[tuple[int, int]]:
    """Code points from the first to the last word of each run of flagged words."""
    if not flags.any():
        return []
    places = [match.span() for match in WORD.finditer(text)]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(places[a][0], places[b - 1][1]) for a, b in edges.reshape(-1, 2).tolist()]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """``doc_id, n_words, n_hit, items, spans`` per row of ``docs``.

    Words are runs of digits, letters and characters beyond ASCII, A-Z lower-cased. A
    word is hit if it lies in an occurrence of ``window`` consecutive words of an item
    (or of a whole shorter item). ``items`` lists the ids of the items found, sorted as
    strings, and ``spans`` the merged passages in code points, end exclusive.

    Documents are neither shuffled nor joined: a task indexes about 8 MB of texts at a
    time and searches all phrases in the index. Null texts have no words; a null
    ``item_id`` flags words but is not listed; repeated items count once; rows with the
    same ``doc_id`` are rows of their own. Without benchmark items nothing is hit.
    """
    blocks = phrase_blocks(test_phrases(benchmark, item_id, item_text, window))

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            flags, items = hits(texts, _loaded(blocks))
            place = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            found = [
                [{"start": a, "end": b} for a, b in spans(t, f)]
                for t, f in zip(texts, flags, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(f) for f in flags], pa.int64()),
                    pa.array([int(f.sum()) for f in flags], pa.int64()),
                    pa.array([sorted(i) for i in items], pa.list_(pa.string())),
                    pa.array(found, pa.list_(place)),
                ],
                ["doc_id", "n_words", "n_hit", "items", "spans"],
            )

    return with_text(docs, id, text).mapInArrow(
        find,
        "doc_id bigint, n_words bigint, n_hit bigint, items array<string>, "
        "spans array<struct<start: bigint, end: bigint>>",
    )


def _loaded(blocks: list) -> Iterator[dict]:
    """One block after the other; only the first stays in memory."""
    for number, block in enumerate(blocks):
        yield block.value
        if number:
            del block._value


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """``docs`` with all benchmark passages cut out of the texts; all rows are kept.

    The passages are those of ``contamination``. Where a cut brings the words of another
    occurrence together, that is cut as well, until none is left. Other texts do not
    change; null stays null.
    """
    blocks = phrase_blocks(test_phrases(benchmark, item_id, item_text, window))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            place = batch.schema.get_field_index(text)
            texts = batch.column(place).to_pylist()
            left = [i for i, t in enumerate(texts) if t]
            changed = False
            while left:
                flags, _ = hits([texts[i] for i in left], _loaded(blocks))
                again = []
                for i, flag in zip(left, flags, strict=True):
                    for a, b in reversed(spans(texts[i], flag)):
                        texts[i] = texts[i][:a] + texts[i][b:]
                        again = again if again[-1:] == [i] else [*again, i]
                left, changed = again, changed or bool(again)
            yield batch.set_column(place, text, pa.array(texts, batch.schema.field(place).type)) if changed else batch

    return docs.mapInArrow(cut, docs.schema)
