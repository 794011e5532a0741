"""Passages that repeat within and across documents, by runs of sentences, and texts without them."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.common import slices, unused
from tallyframe.plans import Scratch, join_groups

#: A run has at least this many sentences and this many words.
RUN_SENTENCES, RUN_WORDS = 3, 12
#: With this many words, one sentence fewer is enough.
FEWER_WORDS = 16
#: Longer sentences are cut into parts of so many words at most.
LONGEST = 16

WORD = re.compile(r"\S+")
MARKS = ".!?"
#: Text that a task cuts at a time, and distinct words whose hashes it keeps.
SLICE_BYTES, KEPT_WORDS = 2 << 20, 200_000
#: Spans are joined to texts by broadcast up to this size, and by a shuffle beyond.
BROADCAST_BYTES = 64 << 20

# Odd multipliers of a 64-bit mixer; the two halves of a digest start from other ones.
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
HALVES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


def word_hash(word: str) -> int:
    """64 bits of a word in lower case; the lowest one tells whether it ends a sentence."""
    return xxhash.xxh3_64_intdigest(word.encode()) & ~1 | (word[-1] in MARKS)


class Cut:
    """The runs of sentences of many texts at once.

    Words are what white space separates, in lower case. A sentence ends with a word
    that ends with a full stop, an exclamation or a question mark, and with the line. One
    longer than LONGEST words is cut in step: a part ends with the word that has the
    least hash (the last one of several) of any LONGEST words in a row. So it has LONGEST
    words at most, and of two sentences with words in common the parts are equal but for
    LONGEST words at each end of these, wherever they start.
    """

    def __init__(self, least_sentences: int = RUN_SENTENCES, least_words: int = RUN_WORDS):
        self.least_sentences, self.least_words = least_sentences, least_words
        self.known: dict[str, int] = {}

    def runs(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """``text, start, end, high, low`` of the sufficient runs, in order.

        ``start`` and ``end`` count words of the text. From every sentence on there is
        the shortest run of ``least_sentences`` and ``least_words``, and the one with a
        sentence fewer if it has FEWER_WORDS words. The longer of the two is left out
        where the shorter ones from its first and its second sentence cover it.
        """
        hashes, text, ends = self._words(texts)
        if not len(hashes):
            return tuple(np.empty(0, np.int64) for _ in range(5))
        limits = np.flatnonzero(ends) + 1
        starts = np.concatenate([[0], limits[:-1]]).astype(np.int64)
        owner = text[starts]
        before = np.concatenate([[0], limits]).astype(np.int64)  # words before each sentence
        digests = self._digests(hashes, starts, limits)
        first = np.arange(len(starts))
        last_of = np.searchsorted(owner, owner, side="right")

        fewer = self.least_sentences - 1
        short_end = first + fewer
        short = (short_end <= last_of) & (fewer > 0)
        short &= before[np.minimum(short_end, len(starts))] - before[first] >= max(self.least_words, FEWER_WORDS)
        end = np.maximum(first + self.least_sentences, np.searchsorted(before, before[first] + self.least_words))
        next_short = np.append(short[1:], False) & (np.append(owner[1:], -1) == owner)
        covered = short & next_short & (end - first == self.least_sentences)
        whole = (end <= last_of) & ~covered

        chosen = np.concatenate([first[short], first[whole]])
        until = np.concatenate([short_end[short], end[whole]])
        order = np.lexsort((until, chosen))
        chosen, until = chosen[order], until[order]
        halves = []
        for digest, mix in zip(digests, HALVES, strict=True):
            total = (until - chosen).astype(np.uint64)
            for step in range(int((until - chosen).max(initial=0))):
                live = chosen + step < until
                total[live] = _mixed(total[live] * mix + digest[chosen[live] + step])
            halves.append(total.view(np.int64))
        text_start = np.searchsorted(text, np.arange(len(texts)))
        at = owner[chosen]
        return at, starts[chosen] - text_start[at], before[until] - text_start[at], *halves

    def _words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of all words, the text each is in, and which of them end a sentence."""
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        known = self.known
        known["\0"] = 0  # stands for the end of a line; no hash of a word is taken for it
        hashes, counts = [], []
        for text in texts:
            words = text.replace("\0", "\1").lower().replace("\n", " \0 ").split()
            found = list(map(known.get, words))
            if None in found:
                found = [known[w] if w in known else known.setdefault(w, word_hash(w) or 2) for w in words]
            hashes += found
            counts.append(len(found))
        hashed = np.array(hashes, np.uint64)
        text = np.repeat(np.arange(len(texts)), counts)
        line = hashed == 0
        ends = (hashed & np.uint64(1)).astype(bool)
        ends[:-1] |= line[1:]
        ends[np.flatnonzero(np.diff(text, append=-1))] = True
        hashed, text, ends = hashed[~line], text[~line], ends[~line]
        if len(text):
            ends[np.flatnonzero(np.diff(text, append=-1))] = True
        if len(hashed) >= LONGEST:
            sentence = np.concatenate([[0], np.cumsum(ends)[:-1]])
            windows = np.lib.stride_tricks.sliding_window_view(hashed[::-1], LONGEST)
            least = len(hashed) - 1 - (np.arange(len(windows)) + windows.argmin(1))
            low = len(hashed) - LONGEST - np.arange(len(windows))
            inside = sentence[low] == sentence[low + LONGEST - 1]
            # A sentence of LONGEST words is short enough.
            size = np.bincount(sentence)[sentence[low]]
            ends[least[inside & (size > LONGEST)]] = True
        return hashed, text, ends

    @staticmethod
    def _digests(hashes: np.ndarray, starts: np.ndarray, limits: np.ndarray) -> list[np.ndarray]:
        """128 bits per sentence, of its words and their order."""
        place = (np.arange(len(hashes)) - np.repeat(starts, limits - starts)).astype(np.uint64)
        return [np.add.reduceat(_mixed(_mixed(hashes * half + place) + half), starts) for half in HALVES]


RUNS = "row bigint, doc_id bigint, start int, end int, by bigint, more bigint"


def sentence_runs(
    docs: DataFrame, least_sentences: int = RUN_SENTENCES, least_words: int = RUN_WORDS
) -> DataFrame:
    """``row, doc_id, start, end, by, more``: a row per run of ``docs(row, doc_id, text)``.

    ``start`` and ``end`` count words; ``by`` and ``more`` are the halves of a digest.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cut(least_sentences, least_words)
        for batch in slices(batches, most=SLICE_BYTES):
            at, start, end, by, more = cutter.runs([t or "" for t in batch.column("text").to_pylist()])
            places = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(places), batch.column("doc_id").take(places),
                 pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(by), pa.array(more)],
                ["row", "doc_id", "start", "end", "by", "more"],
            )

    return docs.select("row", "doc_id", "text").mapInArrow(cut, RUNS)


def repeated_runs(numbered: DataFrame, least_sentences: int, least_words: int, scratch: Scratch) -> DataFrame:
    """``row, places``: per row the merged runs that stand elsewhere before, as words.

    The texts are cut twice, which is cheaper than to keep all runs. The first time
    digests are counted, with sums in the map tasks. The second time all runs are joined
    with the digests that occur more than once, each of which is one row there: a plain
    join, as one that reads its rows more than once would cut the texts again. A run has
    a row per document of the hundreds that a document has, and Spark splits what is
    skewed even so. Of what is left, the first place of each run is that in the document
    with the least id, the others are repeated; these joins keep hot runs out of the
    shuffle.
    """
    counted = scratch.keep(
        sentence_runs(numbered, least_sentences, least_words)
        .groupBy(F.col("by").alias("key"), F.col("more").alias("same"))
        .agg(F.count("*").alias("total"))
        .where("total > 1")
    )
    same = F.expr("more = same")
    runs = sentence_runs(numbered, least_sentences, least_words)
    several = scratch.keep(
        runs.join(counted.select("key", "same"), (F.col("by") == F.col("key")) & same)
        .select("row", "doc_id", "start", "end", "by", "more")
    )
    first = "min(struct(doc_id IS NULL AS missing, doc_id, row, start))"
    firsts = scratch.keep(
        several.groupBy(F.col("by").alias("key"), F.col("more").alias("same")).agg(F.expr(first).alias("first"))
    )
    places = join_groups(several, firsts, counted, same, broadcast_bytes=8 << 20).where(
        "row <> first.row OR start <> first.start"
    ).selectExpr("row", "struct(start, end, first.doc_id AS first_doc_id) AS place")

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("first_doc_id", pa.int64())]))
        for batch in batches:
            merged = [_merged(places) for places in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(merged, kind)], ["row", "places"])

    return scratch.keep(
        places.groupBy("row").agg(F.collect_list("place").alias("places")).mapInArrow(
            merge, "row bigint, places array<struct<start: int, end: int, first_doc_id: bigint>>"
        )
    )


def _merged(places: list[dict]) -> list[dict]:
    """Places that touch or overlap as one, with the least first document."""
    out: list[dict] = []
    for place in sorted(places, key=lambda p: (p["start"], p["end"])):
        if out and place["start"] <= out[-1]["end"]:
            last, known = out[-1], (out[-1]["first_doc_id"], place["first_doc_id"])
            last["end"] = max(last["end"], place["end"])
            last["first_doc_id"] = min((d for d in known if d is not None), default=None)
        else:
            out.append(dict(place))
    return out


def without_spans(text: str, places: list[dict]) -> tuple[str, list[tuple[int, int]]]:
    """A text without the places, given in words, and where they were, in code points.

    The white space after a place goes with it, and at the end of the text that before.
    """
    words = [m.span() for m in WORD.finditer(text)]
    spans = [(words[p["start"]][0], words[p["end"] - 1][1]) for p in places]
    kept, at = [], 0
    for place, (start, _) in zip(places, spans, strict=True):
        kept.append(text[at:start])
        at = words[place["end"]][0] if place["end"] < len(words) else len(text)
    kept.append(text[at:])
    left = "".join(kept)
    return (left.rstrip() if spans and at == len(text) else left), spans


SPANS = T.ArrayType(
    T.StructType([T.StructField(name, T.LongType()) for name in ("start", "end", "first_doc_id")])
)


def without_repeats(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    spans: str = "repeated_spans",
    least_sentences: int = RUN_SENTENCES,
    least_words: int = RUN_WORDS,
    scratch: Scratch | None = None,
) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``, and the column ``spans`` more.

    Every run of at least ``least_sentences`` sentences and ``least_words`` words, or of
    a sentence fewer and FEWER_WORDS words, is looked up among all runs of all documents.
    The first place of a run is the one in the document with the least id (rows without
    an id come last, rows with the same id in the order they are read), and in it the
    first. The sentences of all other places go, with the white space after them.
    ``spans`` tells where they were: code points of the old text, the end exclusive,
    those that touch or overlap merged, with the least id of the documents that hold the
    first places (null if these have none). Rows with nothing repeated keep their text
    and have no spans; null texts stay null. All rows and columns are returned; a column
    that is named like ``spans`` is an error. Long sentences are cut in step, so of a
    passage of 51 words that starts and ends inside sentences at least the middle goes.

    The table is written once with numbered rows, so that both cuts and the removal see
    the same rows. Digests have 128 bits. The spans are joined to the texts by broadcast
    if they are small, by their size, and by a shuffle on the row if not.
    """
    if spans.lower() in map(str.lower, docs.columns):
        raise ValueError(f"docs has a column {spans} already")
    scratch = scratch or Scratch(docs.sparkSession)
    row, own_id, found = (unused(docs, name) for name in ("row", "id", "places"))
    numbered = scratch.keep(
        docs.withColumns({row: F.monotonically_increasing_id(), own_id: docs[id].cast("bigint")})
    )
    plain = numbered.select(
        F.col(row).alias("row"), F.col(own_id).alias("doc_id"), F.col(text).alias("text")
    )
    with Scratch(docs.sparkSession, scratch.folder) as passing:
        places = scratch.keep(
            repeated_runs(plain, least_sentences, least_words, passing)
            .select(F.col("row").alias(row), F.col("places").alias(found))
        )
    size = places.agg(F.sum(F.size(found) * 32 + 64)).first()[0] or 0
    joined = numbered.join(F.broadcast(places) if size <= BROADCAST_BYTES else places, row, "left")

    names = docs.columns

    def remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("first_doc_id", pa.int64())]))
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts, lists = batch.column(at).to_pylist(), batch.column(found).to_pylist()
            told: list[list[dict]] = []
            for i, marked in enumerate(lists):
                cut: list[tuple[int, int]] = []
                if marked:
                    texts[i], cut = without_spans(texts[i], marked)
                told.append([
                    {"start": a, "end": b, "first_doc_id": p["first_doc_id"]}
                    for (a, b), p in zip(cut, marked or [], strict=True)
                ])
            kept = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(told, kind)], [*names, spans])

    schema = T.StructType([
        T.StructField(f.name, T.StringType() if f.name == text else f.dataType) for f in docs.schema
    ]).add(spans, SPANS)
    columns = [F.col(c).cast("string").alias(c) if c == text else F.col(c) for c in docs.columns]
    return joined.select(*columns, found).mapInArrow(remove, schema)
