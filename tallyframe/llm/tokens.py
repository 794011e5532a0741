"""Token ids of documents in ORC files, and reading them back."""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyframe.llm.common import slices, with_text

SCHEMA = "shard int, position bigint, doc_id bigint, n_tokens bigint, ids array<int>"
#: Bytes of pieces with their ids that a worker keeps, twice: those used lately, and the
#: ones before. ENTRY_BYTES is what an entry takes beside its letters and ids.
KEPT_BYTES, ENTRY_BYTES = 48 << 20, 200
#: Words that go through the model in one call.
JOINED_WORDS = 100

#: Fixed values of byte-level BPE: the pattern of its words, and the bytes that stand
#: for themselves. All others stand for the characters from 256 on.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
OWN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]

#: Characters of which the pattern holds in every Unicode version: without blanks and
#: numbers beyond ASCII. Others take the library's way.
PLAIN = "\t\n\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ"


class WordEncoder:
    """Encodes texts with a byte-level BPE tokenizer, each distinct word only once.

    The tokenizer splits a text into words, with the blank before them, and encodes one
    word after the other. So texts are cut into pieces at blanks that stand between two
    other characters, where a word always starts, and the ids of pieces are kept and
    reused. The pieces of many texts that are not known yet are collected first; their
    words go through the model together: as no token goes on after a blank within a
    word, the ids of words joined are those of the words. Texts with other blanks at
    their cuts, with special tokens or with rare characters at a cut go to the library
    whole. So does every text if the tokenizer file has other rules than these. The ids
    are the same in all cases.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.words = re.compile(WORDS)
        self.odd = re.compile(f"[^{PLAIN}]")
        others = [b for b in range(256) if b not in OWN_BYTES]
        self.letters = {b: b for b in OWN_BYTES} | {b: 256 + i for i, b in enumerate(others)}
        self.blank = chr(self.letters[0x20])
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.sizes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.sizes[list(vocabulary.values())] = list(map(len, vocabulary))
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before = {k: v for k, v in (spec["pre_tokenizer"] or {}).items() if k != "trim_offsets"}
        self.usual = spec["normalizer"] is None and before == {
            "type": "ByteLevel", "add_prefix_space": False, "use_regex": True
        } and not spec["model"].get("dropout")
        # A letter before a blank, in one token, would tie two words together.
        spoken = {i: v for v, i in self.letters.items()}
        self.joins = not any(
            bytes(spoken[ord(c)] for c in t[: t.rindex(self.blank)]).decode(errors="replace")[-1].isalnum()
            for t in vocabulary if self.blank in t.lstrip(self.blank)
        )
        self.known: dict[str, bytes | None] = {}
        self.older: dict[str, bytes | None] = {}
        self.few: dict[str, bytes] = {}
        self.held = 0

    def whole(self, text: str) -> bytes:
        """The library's ids of a text, as little-endian 32-bit numbers."""
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        split = [self._split(text) for text in texts]
        missing: set[str] = set()
        for pieces in filter(None, split):
            if len(pieces) > 1:
                missing.update(set(pieces).difference(self.known))
        self._learn(missing)
        get = self.known.__getitem__
        out = []
        for text, pieces in zip(texts, split, strict=True):
            try:
                ids = pieces and self._first(pieces[0]) + b"".join(map(get, islice(pieces, 1, None)))
            except TypeError:  # a piece that cannot stand alone
                ids = None
            out.append((self.whole(text) if text else b"") if ids is None else ids)
        # What was not used for so long that as much again was learned is forgotten.
        if self.held > KEPT_BYTES:
            self.older, self.known, self.held = self.known, {}, 0
        return out

    def _split(self, text: str) -> list[str] | None:
        """The pieces of a text; None if it goes to the library whole."""
        if not text or not self.usual or any(special in text for special in self.special):
            return None
        pieces = text.split(" ")
        first = pieces[0]
        if len(pieces) > 1 and (not first or first[-1].isspace() or self.odd.search(first[-1])):
            return None
        return pieces

    def _first(self, piece: str) -> bytes:
        if self.odd.search(piece):
            return self.whole(piece)
        return b"".join(map(self._word, self.words.findall(piece)))

    def _learn(self, missing: set[str]) -> None:
        """Make pieces known: their ids after a blank, or None where they can't stand alone."""
        odd, older = self.odd.search, self.older
        again = missing & older.keys()
        for piece in again:
            self._keep(piece, older.pop(piece))
        fresh = missing - again
        # Pieces of one word, of letters alone.
        single = [p for p in fresh if p.isalpha() and (p.isascii() or not odd(p))]
        others = fresh.difference(single)
        split: dict[str, list[str]] = {}
        new: set[str] = set()
        for piece in others:
            if not piece or piece[0].isspace() or piece[-1].isspace() or odd(piece[0]) or odd(piece[-1]):
                self._keep(piece, None)
            elif odd(piece):
                self._keep(piece, self.whole(" " + piece))
            else:
                first, *rest = split[piece] = self.words.findall(" " + piece)
                if first[1:].isalpha():
                    new.add(first[1:])
        for piece in new.difference(self.known, single):
            if piece in older:
                self._keep(piece, older.pop(piece))
            else:
                single.append(piece)
        if self.joins:
            single.sort()
            for at in range(0, len(single), JOINED_WORDS):
                self._joined(single[at : at + JOINED_WORDS])
        else:
            for piece in single:
                self._keep(piece, self._word(" " + piece))
        known, word = self.known, self._word
        for piece, (first, *rest) in split.items():
            start = known[first[1:]] if first[1:].isalpha() else word(first)
            self._keep(piece, start + b"".join(map(word, rest)))

    def _keep(self, piece: str, ids: bytes | None) -> None:
        self.known[piece] = ids
        self.held += len(piece) + len(ids or b"") + ENTRY_BYTES

    def _joined(self, pieces: list[str]) -> None:
        """Keep the ids of words of letters, each after a blank, by one call of the model."""
        spelled = self._spelled(" " + " ".join(pieces))
        ids = np.array([token.id for token in self.model.tokenize(spelled)], "<u4")
        ends = np.cumsum([len(word) + 1 for word in spelled[1:].split(self.blank)])
        cuts = [0, *(4 * np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 4).tolist()]
        data = ids.tobytes()
        self.known.update(zip(pieces, (data[a:b] for a, b in pairwise(cuts)), strict=True))
        self.held += len(spelled) + len(data) + ENTRY_BYTES * len(pieces)

    def _word(self, word: str) -> bytes:
        """The ids of one word; those of short ones, of which there are few, are kept."""
        found = self.few.get(word)
        if found is None:
            found = array("I", [token.id for token in self.model.tokenize(self._spelled(word))]).tobytes()
            if len(word) <= 3:
                self.few[word] = found
        return found

    def _spelled(self, word: str) -> str:
        return word.encode().decode("latin-1").translate(self.letters)


def _encoder(path: str) -> WordEncoder:
    """The encoder of this worker process, which many tasks share."""
    kept = sys.__dict__.setdefault("_tallyframe_encoders", {})
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int | None = 0,
    id: str = "doc_id",
    text: str = "text",
) -> None:
    """Write the token ids of all documents to ORC files, in ascending id order.

    ``tokenizer`` is a byte-level BPE file of the tokenizers library, at the same place
    on every executor. ``end_id`` is appended to each document unless it is None. Null
    texts are empty; a null id comes first; rows with equal ids stay rows of their own,
    in any order. Texts are dealt out by ranges of ids and sorted, then encoded, so token
    ids are never shuffled; a file, or shard, is one range. Ids with many rows are split.

    ORC packs the ids by run-length encoding. Each stripe holds its own row index and a
    Bloom filter on the ids of its documents, so readers may take stripes in parallel
    and skip those without a wanted document.
    """

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, position = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        for batch in slices(batches):
            found = [ids + end for ids in encoder.encode_all(batch.column("text").to_pylist())]
            sizes = np.array([len(f) // 4 for f in found], dtype=np.int64)
            values = np.frombuffer(b"".join(found), "<i4")
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(sizes), shard, np.int32)),
                    pa.array(np.arange(position, position + len(sizes))),
                    batch.column("doc_id"),
                    pa.array(sizes),
                    pa.ListArray.from_arrays(offsets, values),
                ],
                ["shard", "position", "doc_id", "n_tokens", "ids"],
            )
            position += len(sizes)

    rows = with_text(docs, id, text).withColumn("row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")
    ordered.select("doc_id", "text").mapInArrow(encode, SCHEMA).write.option(
        "orc.bloom.filter.columns", "doc_id"
    ).option("orc.compress", "ZSTD").orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The written rows. A filter on ``doc_id`` skips files, stripes and row groups."""
    return spark.read.schema(SCHEMA).orc(path)


def token_index(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of rows that ``read_tokens`` gives.

    ``start`` counts the ids of all documents before; the checksum covers the ids as
    little-endian 32-bit numbers. Shards are summed up first, so the running count looks
    at one number per shard, and at the documents of a shard only within it.
    """

    def checksum(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            offsets, values = ids.offsets.to_numpy(), ids.values.to_numpy().astype("<i4", copy=False)
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets, offsets[1:], strict=False)]
            rest = [batch.column(name) for name in ("shard", "position", "doc_id", "n_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(sums, pa.int64())],
                ["shard", "position", "doc_id", "n_tokens", "ids_crc32"],
            )

    rows = tokens.mapInArrow(
        checksum, "shard int, position bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"
    )
    totals = tokens.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        "shard", F.coalesce(F.sum("total").over(earlier.orderBy("shard")), F.lit(0)).alias("before")
    )
    within = F.sum("n_tokens").over(earlier.partitionBy("shard").orderBy("position"))
    return rows.join(before, "shard").select(
        "doc_id",
        (F.col("before") + F.coalesce(within, F.lit(0))).alias("start"),
        "n_tokens",
        "ids_crc32",
    )
