"""Spelling variants: words one edit apart, found by sorting their permuterm rotations."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import slices, with_text
from tallyframe.plans import Scratch

#: Words shorter or rarer than this take no part, and a form has so many times the count.
LEAST_LETTERS, LEAST_COUNT, TIMES = 5, 3, 2
#: One in so many distinct runs of a document loses a letter, chosen by checksum.
DROPPED_EVERY = 97
#: Marks the end of a word in its rotations. It is no letter.
END = "$"
#: Words that a task counts before it hands them on.
COUNTED_WORDS = 300_000

LETTERS = [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)]
#: Latin-1 bytes: letters as they are, A-Z lower-cased, all others as blanks.
AS_WORDS = bytes(
    (b + 32 if 0x41 <= b <= 0x5A else b) if b in LETTERS else 0x20 for b in range(256)
)


def letter_runs(text: str) -> list[bytes]:
    """The maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased, in Latin-1.

    Characters beyond Latin-1 are replaced by one that is no letter, so they end a run.
    """
    return text.encode("latin-1", "replace").translate(AS_WORDS).split()


def as_typed(run: bytes, start: int, every: int) -> bytes:
    """``run`` without one letter if the checksum that goes on from ``start`` says so."""
    spoken = run if run.isascii() else run.decode("latin-1").encode()
    h = zlib.crc32(spoken, start)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    dropped_every: int | None = DROPPED_EVERY,
    least_letters: int = LEAST_LETTERS,
) -> DataFrame:
    """``word, n``: the letter runs of whole texts and how often they occur.

    A run of a document whose checksum with the id, the CRC-32 of ``<id>:<run>``, is
    divisible by ``dropped_every`` loses the letter at checksum modulo length, wherever
    it stands in the document; None leaves all runs as they are, and so does a null id.
    Results of fewer than ``least_letters`` letters are left out. Null texts have no runs.
    Tasks sum up counts before anything is shuffled, so a frequent word costs one row
    per task (and per COUNTED_WORDS words).
    """

    def rows(found: dict[bytes, int]) -> pa.RecordBatch:
        words = pa.array([word.decode("latin-1") for word in found], pa.string())
        counts = pa.array(list(found.values()), pa.int64())
        return pa.RecordBatch.from_arrays([words, counts], ["word", "n"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, int] = {}
        for batch in slices(batches):
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, batch.column("text").to_pylist(), strict=True):
                times = Counter(letter_runs(text))
                start = zlib.crc32(f"{doc_id}:".encode())
                drop = dropped_every is not None and doc_id is not None
                for run, n in times.items():
                    word = as_typed(run, start, dropped_every) if drop else run
                    if len(word) >= least_letters:
                        found[word] = found.get(word, 0) + n
                if len(found) >= COUNTED_WORDS:
                    yield rows(found)
                    found = {}
        yield rows(found)

    counted = with_text(docs, id, text).mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


#: Of a word, every rotation of it with its end mark, and every one that skips the letter
#: it would end with; ``skipped`` is that letter.
ROTATIONS = f"""
    concat(
        transform(sequence(0, length(word)), i -> struct(
            concat(substr(word, i + 1), '{END}', substr(word, 1, i)) AS key,
            CAST(NULL AS string) AS skipped)),
        transform(sequence(1, length(word)), i -> struct(
            concat(substr(word, i + 1), '{END}', substr(word, 1, i - 1)) AS key,
            substr(word, i, 1) AS skipped)))
"""


def neighbours(words: DataFrame) -> DataFrame:
    """``word, n_near, best``: parts of what is near each word, to be summed up by word.

    ``words`` has ``word`` (not empty, without the end mark) and ``n``, a word once. Two words are near
    if one edit turns one into the other. A rotation starts behind some letter and ends
    with that letter. Without it, the rotations of two words are equal if the words
    differ in that letter alone; and such a shortened rotation equals a whole one of
    the word that lacks the letter. So all rotations are sorted, and a prefix range, the
    rows with equal key, holds words near each other: at most one whole rotation, and
    one shortened one for each letter there is, so a range has as many rows as the
    alphabet has letters at most, whatever the number of words. An insertion into a run
    of the same letter shows in several ranges, and counts where the letter before is
    another one. ``best`` is the near word of largest count, the first in order of code
    points of several, as ``struct<less: bigint, word: string>`` with the count negated.
    """
    rotations = words.selectExpr("word", "n", f"explode({ROTATIONS}) AS r").selectExpr(
        "r.key AS key", "r.skipped AS skipped", "word", "n"
    )
    ordered = rotations.repartition("key").sortWithinPartitions("key")
    return ordered.mapInArrow(
        _scan, "word string, n_near bigint, less bigint, best string"
    ).selectExpr("word", "n_near", "struct(less, best AS word) AS best")


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows for the members of every group of equal keys, in order of the keys."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = batch.column("key")[-1].as_py()
        # Rows of the last key may go on in the next batch.
        whole = batch.num_rows - pc.sum(pc.equal(batch.column("key"), last)).as_py()
        if whole:
            yield from _near(pa.Table.from_batches([*rest, batch.slice(0, whole)]))
            rest = []
        rest.append(batch.slice(whole))
        if len(rest) > 1 and rest[0].column("key")[0].as_py() != last:
            yield from _near(pa.Table.from_batches(rest[:-1]))
            rest = rest[-1:]
    if rest:
        yield from _near(pa.Table.from_batches(rest))


def _near(table: pa.Table) -> Iterator[pa.RecordBatch]:
    keys = table.column("key").combine_chunks()
    other = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.flatnonzero(other) + 1])
    sizes = np.diff(np.append(starts, len(keys)))
    starts, sizes = starts[sizes > 1], sizes[sizes > 1]
    at = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    members = table.select(["skipped", "word", "n"]).take(pa.array(at))
    skipped, words, counts = (column.to_pylist() for column in members.columns)
    ends = pc.utf8_slice_codeunits(keys.take(pa.array(starts)), -1).to_pylist()
    out: tuple[list, list, list, list] = ([], [], [], [])
    first = 0
    for size, end in zip(sizes.tolist(), ends, strict=True):
        short, whole = [], None
        for i in range(first, first + size):
            if skipped[i] is None:
                whole = (-counts[i], words[i])
            else:
                short.append((-counts[i], words[i], skipped[i]))
        first += size
        short.sort()
        inserted = [s for s in short if s[2] != end] if whole else []
        if inserted:
            _add(out, whole[1], len(inserted), inserted[0])
        for i, one in enumerate(short):
            others = [short[1 if i == 0 else 0]] if len(short) > 1 else []
            without = whole is not None and one[2] != end
            if without:
                others.append((*whole, None))
            if others:
                _add(out, one[1], len(short) - 1 + without, min(o[:2] for o in others))
    types = (pa.string(), pa.int64(), pa.int64(), pa.string())
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(out, types, strict=True)], ["word", "n_near", "less", "best"]
    )


def _add(out: tuple[list, ...], word: str, near: int, best: tuple) -> None:
    for column, value in zip(out, (word, near, best[0], best[1]), strict=True):
        column.append(value)


def spelling_variants(
    counts: DataFrame,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    times: int = TIMES,
    scratch: Scratch | None = None,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` per word of ``counts(word, n)``.

    Words of at least ``least_letters`` letters and ``least_count`` occurrences take
    part; a word that stands in several rows has the sum of them, and a null word or
    count takes no part, nor does a word with the end mark. Two words are near if one of them has one letter more or one
    other letter, as ``neighbours`` says. The form of a word is its near word with the largest count, of
    several the first in order of code points, if it has at least ``times`` the count of
    the word; else it is null, with a null ``form_n``. The root is where the forms of
    forms end, the word itself if it has none. Each form is more frequent than its word,
    so there are no cycles, and following forms takes as many rounds as the logarithm of
    the longest chain, each written as a table. No words give no rows. ``times`` has to
    be more than 1, as forms could lead around in a circle otherwise.
    """
    if times <= 1:
        raise ValueError("a form has to be more frequent than its word: times > 1")
    scratch = scratch or Scratch(counts.sparkSession)
    with Scratch(counts.sparkSession, scratch.folder) as passing:
        words = passing.keep(
            counts.where("word IS NOT NULL AND n IS NOT NULL")
            .groupBy("word").agg(F.sum("n").alias("n"))
            .where(f"length(word) >= {max(least_letters, 1)} AND n >= {least_count}")
            .where(~F.col("word").contains(END))
        )
        alone = "CAST(NULL AS struct<less: bigint, word: string>) AS best"
        parts = neighbours(words).selectExpr("word", "0L AS n", "n_near", "best").unionByName(
            words.selectExpr("word", "n", "0L AS n_near", alone)
        )
        known = parts.groupBy("word").agg(
            F.sum("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best")
        )
        formed = scratch.keep(
            known.selectExpr("word", "n", "n_near", "best", f"-best.less >= {times} * n AS has_form")
            .selectExpr("word", "if(has_form, best.word, NULL) AS form", "n", "n_near", "if(has_form, -best.less, NULL) AS form_n")
        )
        tips = passing.keep(formed.where("form IS NOT NULL").selectExpr("word", "form AS root", "true AS moved"))
        while not tips.where("moved").isEmpty():
            ahead = tips.selectExpr("word AS root", "root AS next")
            tips = passing.keep(
                tips.join(ahead, "root", "left").selectExpr(
                    "word", "coalesce(next, root) AS root", "next IS NOT NULL AS moved"
                )
            )
        roots = scratch.keep(tips.select("word", "root"))
    return formed.join(roots, "word", "left").selectExpr(
        "word", "form", "coalesce(root, word) AS root", "n", "n_near", "form_n"
    )
