"""What several text operators share."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A task works on slices of a batch with about this many bytes of text at a time.
SLICE_BYTES = 8 << 20

#: Words of lower-cased UTF-8: digits, letters and every character beyond ASCII.
BYTE_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def with_text(df: DataFrame, id: str, text: str, *more: str) -> DataFrame:
    """``id`` as bigint and ``text``, null as empty, under names of our own.

    The ways of writing an id column that is no number (text, say) are not accepted:
    the cast raises, or gives null outside ANSI mode.
    """
    return df.select(
        df[id].cast("bigint").alias("doc_id"),
        F.coalesce(df[text].cast("string"), F.lit("")).alias("text"),
        *(df[name] for name in more),
    )


def slices(
    batches: Iterable[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in record batches of bounded text size (one text may exceed it)."""
    for batch in batches:
        start, size = 0, 0
        column = batch.column(batch.schema.get_field_index(text))
        lengths = pyarrow.compute.binary_length(column).to_pylist()
        for i, length in enumerate(lengths):
            if size and size + (length or 0) > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += length or 0
        if start < batch.num_rows:
            yield batch.slice(start)


def unused(docs: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as no column of ``docs`` has."""
    while name.lower() in map(str.lower, docs.columns):
        name = f"_{name}"
    return name


#: Tables of one id a row are broadcast up to this many rows, 48 bytes each in a hash table.
BROADCAST_ROWS = 1_000_000


def few(ids: DataFrame) -> DataFrame:
    """Written ``ids`` with a hint to broadcast them, where their number allows it."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def held_out(id: Column) -> Column:
    """True for the rows that a classifier must not learn from."""
    return F.crc32(id.cast("string").cast("binary")) % 3 == 1


def is_held_out(doc_id: int) -> bool:
    """The same for one id, in Python."""
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    per_class: dict[int, int],
    max_text_bytes: int = 32_768,
    id: str = "doc_id",
    text: str = "text",
) -> list[tuple[str, int]]:
    """A bounded sample of labelled texts for training, each text once.

    Of each class the ``per_class[label]`` labelled rows with the least hash of their
    id, held-out ids never. The driver gets ``sum(per_class.values())`` ids, and as many
    texts of at most ``max_text_bytes``; longer ones are not trained on. Rows without
    id or label do not count. An id with both labels is left out.
    """
    known = (
        labels.select(labels[id].cast("bigint").alias("doc_id"), labels[label].alias("label"))
        .where("doc_id IS NOT NULL AND label IS NOT NULL")
        .where(~held_out(F.col("doc_id")))
    )
    picked = None
    for value, most in per_class.items():
        part = known.where(F.col("label") == value).distinct()
        part = part.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        picked = part if picked is None else picked.unionByName(part)
    chosen: dict[int, set[int]] = {}
    for row in picked.collect():
        chosen.setdefault(row["doc_id"], set()).add(int(row["label"]))
    ids = sorted(doc_id for doc_id, found in chosen.items() if len(found) == 1)
    if not ids:
        return []
    wanted = docs.sparkSession.createDataFrame([(i,) for i in ids], "doc_id bigint")
    texts = with_text(docs, id, text).where(F.octet_length("text") <= max_text_bytes)
    rows = texts.join(F.broadcast(wanted), "doc_id").dropDuplicates(["doc_id"]).collect()
    seen: dict[str, int] = {}
    for row in sorted(rows, key=lambda row: row["doc_id"]):
        seen.setdefault(row["text"], next(iter(chosen[row["doc_id"]])))
    return list(seen.items())
