"""Which tokens of one tokenizer stand where tokens of another do, by Arrow columns."""

from __future__ import annotations

import json
import sys
from collections.abc import Iterable, Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyframe.llm.common import slices, with_text
from tallyframe.plans import Scratch, join_groups

#: Fixed values of byte-level BPE: the bytes that stand for themselves. All others stand
#: for the characters from 256 on.
OWN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Fixed value: how byte-level BPE cuts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pairs of ids that tasks get the counts of at once, 17 bytes each; the most frequent
#: ones if there are more. The counts of all others are joined by a shuffle.
KNOWN_PAIRS = 2_000_000
#: Text that a task aligns at a time: its columns take some 60 times as much.
SLICE_BYTES = 2 << 20
#: Rows of partial counts that a task holds before it adds them up.
PARTIAL_ROWS = 2_000_000


class Tokens:
    """A tokenizer: ids of texts, and the bytes of each id."""

    def __init__(self, path: str):
        self.bytes: pa.Array = pa.array(self._load(path), pa.binary())
        self.lengths = pc.binary_length(self.bytes).to_numpy().astype(np.int64)


class ByteLevel(Tokens):
    """A byte-level BPE file of the tokenizers library.

    If ids rise with the ranks of the merges, and nothing but the usual words is cut,
    the faster tiktoken computes the same ids from the same file; else the library does.
    The strings of special tokens are plain text in both.
    """

    def _load(self, path: str) -> list[bytes]:
        library = Tokenizer.from_file(path)
        library.encode_special_tokens = True
        others = [b for b in range(256) if b not in OWN_BYTES]
        letters = {b: b for b in OWN_BYTES} | {256 + i: b for i, b in enumerate(others)}
        vocabulary = library.get_vocab(with_added_tokens=False)
        found = [b""] * library.get_vocab_size(with_added_tokens=True)
        for token, id in vocabulary.items():
            found[id] = token.translate(letters).encode("latin-1")
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        merges = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
        ranks = [vocabulary.get(m.replace(" ", "", 1), -1) for m in merges]
        before = {k: v for k, v in (spec["pre_tokenizer"] or {}).items() if k != "trim_offsets"}
        plain = before == {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        in_ranks = ranks == list(range(256, 256 + len(ranks))) == sorted(vocabulary.values())[256:]
        special = all(t.special for t in library.get_added_tokens_decoder().values())
        if plain and in_ranks and special and spec["normalizer"] is None:
            known = {found[id]: id for id in vocabulary.values()}
            own = tiktoken.Encoding("own", pat_str=WORDS, mergeable_ranks=known, special_tokens={})
            self._encode = own.encode_ordinary
        else:
            self._encode = lambda text: library.encode(text, add_special_tokens=False).ids
        return found

    def encode(self, text: str) -> list[int]:
        return self._encode(" " + text)


class Pieces(Tokens):
    """A sentencepiece model, which puts a blank before a text itself."""

    def _load(self, path: str) -> list[bytes]:
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        return [
            bytes([int(piece[3:5], 16)]) if model.IsByte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(map(model.IdToPiece, range(len(model))))
        ]

    def encode(self, text: str) -> list[int]:
        return self.model.Encode(text)


def _loaded(kind: type[Tokens], path: str) -> Tokens:
    """The tokenizer of this worker process, which many tasks share."""
    kept = sys.__dict__.setdefault("_tallyframe_tokenizers", {})
    if (kind.__name__, path) not in kept:
        kept[kind.__name__, path] = kind(path)
    return kept[kind.__name__, path]


def _lists(encoded: list[list[int]]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(ids) for ids in encoded])]).astype(np.int32)
    flat = np.fromiter(chain.from_iterable(encoded), np.int32, int(offsets[-1]))
    return pa.ListArray.from_arrays(offsets, flat)


def _spoken(lists: pa.ListArray, tokens: Tokens) -> list[memoryview]:
    """The joined bytes of each list of ids."""
    joined = tokens.bytes.take(pc.list_flatten(lists))
    offsets = np.frombuffer(joined.buffers()[1], np.int32, len(joined) + 1) if len(joined) else np.zeros(1, np.int32)
    ends = offsets[lists.offsets.to_numpy()]
    data = memoryview(joined.buffers()[2]).cast("B") if len(joined) and joined.buffers()[2] else memoryview(b"")
    return [data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def _whole(texts: list[str], a: Tokens, b: Tokens) -> tuple[pa.ListArray, pa.ListArray]:
    """Ids of both tokenizers; none for texts that one of them doesn't give back."""
    encoded = [[t.encode(text) if text else [] for text in texts] for t in (a, b)]
    lists = [_lists(ids) for ids in encoded]
    spoken = [_spoken(ids, t) for ids, t in zip(lists, (a, b), strict=True)]
    right = [
        bool(text) and x == y and x == b" " + text.encode()
        for text, x, y in zip(texts, *spoken, strict=True)
    ]
    if not all(right):
        lists = [_lists([i if ok else [] for i, ok in zip(ids, right, strict=True)]) for ids in encoded]
    return lists[0], lists[1]


def _ends(lists: pa.ListArray, tokens: Tokens, name: str) -> pa.Table:
    """A row per token: its document, the byte of the document where it ends, its number."""
    document = pc.list_parent_indices(lists)
    lengths = pa.array(tokens.lengths[pc.list_flatten(lists).to_numpy()], pa.int64())
    running = pc.cumulative_sum(lengths).to_numpy()
    # The sum starts again with each document: what was there before it is taken off.
    begin = lists.offsets.to_numpy()[:-1]
    before = np.concatenate([[0], running])[begin]
    ends = running - before[document.to_numpy()]
    return pa.table({"document": document, "end": ends, name: np.arange(len(ends))})


class Aligned:
    """The groups of a slice of texts: where tokens of both tokenizers end together."""

    def __init__(self, texts: list[str], a: Tokens, b: Tokens):
        self.lists = _whole(texts, a, b)
        self.flat = [pc.list_flatten(ids).to_numpy() for ids in self.lists]
        ends = [_ends(ids, t, name) for ids, t, name in zip(self.lists, (a, b), "ab", strict=True)]
        both = ends[0].join(ends[1], ["document", "end"], join_type="inner", use_threads=False).sort_by("a")
        self.document = both["document"].to_numpy()
        last = [both[name].to_numpy() for name in "ab"]
        self.first = [np.concatenate([[0], x[:-1] + 1]).astype(np.int64) for x in last]
        self.sizes = [x - f + 1 for x, f in zip(last, self.first, strict=True)]

    def per_document(self, values: np.ndarray) -> np.ndarray:
        """Sums of values of the groups."""
        n = len(self.lists[0])
        return np.bincount(self.document, values, n).astype(np.int64) if len(values) else np.zeros(n, np.int64)

    def pairs(self, b_ids: int) -> tuple[pa.ListArray, pa.ListArray]:
        """Per document the distinct linked pairs, as ``a * b_ids + b``, and their links.

        Links of a group are all pairs of its tokens. They are expanded for as many
        groups at a time as give a million of them; a group of more is counted by its
        distinct tokens.
        """
        document, number, links = [], [], []
        products = self.sizes[0] * self.sizes[1]
        step = np.cumsum(products) // (1 << 20)
        cuts = np.flatnonzero(np.diff(step)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(products)], strict=True):
            if start == end:
                continue
            if products[start:end].sum() > 1 << 22:
                for group in range(start, end):
                    d, k, n = self._large(group, b_ids)
                    document.append(d), number.append(k), links.append(n)
                continue
            repeat = np.repeat(np.arange(start, end), products[start:end])
            within = np.arange(len(repeat)) - np.repeat(np.cumsum(products[start:end]) - products[start:end], products[start:end])
            width = self.sizes[1][repeat]
            x = self.flat[0][self.first[0][repeat] + within // width].astype(np.int64)
            y = self.flat[1][self.first[1][repeat] + within % width]
            document.append(self.document[repeat]), number.append(x * b_ids + y), links.append(np.ones(len(x), np.int64))
        n = len(self.lists[0])
        if not document:
            none = pa.ListArray.from_arrays(np.zeros(n + 1, np.int32), pa.array([], pa.int64()))
            return none, none
        table = pa.table([np.concatenate(c) for c in (document, number, links)], ["document", "pair", "links"])
        table = table.group_by(["document", "pair"], use_threads=False).aggregate([("links", "sum")])
        table = table.sort_by([("document", "ascending"), ("pair", "ascending")])
        sizes = np.bincount(table["document"].to_numpy(), minlength=n)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return tuple(
            pa.ListArray.from_arrays(offsets, table[name].combine_chunks()) for name in ("pair", "links_sum")
        )

    def _large(self, group: int, b_ids: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        parts = [flat[f[group] : f[group] + s[group]] for flat, f, s in zip(self.flat, self.first, self.sizes, strict=True)]
        (x, nx), (y, ny) = (np.unique(part, return_counts=True) for part in parts)
        pairs = (x.astype(np.int64)[:, None] * b_ids + y).ravel()
        return np.full(len(pairs), self.document[group]), pairs, (nx[:, None] * ny).ravel()

    def digests(self) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2``; nothing for documents without tokens."""
        n = len(self.lists[0])
        if not len(self.document):
            return [""] * n
        ids, marks, place = [], [], []
        at = np.cumsum(self.sizes[0] + self.sizes[1]) - self.sizes[0] - self.sizes[1]
        for side, mark in enumerate("|;"):
            sizes, flat = self.sizes[side], self.flat[side]
            place.append(np.arange(len(flat)) + np.repeat(at + side * self.sizes[0] - self.first[side], sizes))
            ids.append(flat)
            kind = np.zeros(len(flat), np.int32)
            kind[self.first[side] + sizes - 1] = 1
            marks.append(pa.array([",", mark]).take(pa.array(kind)))
        order = np.empty(sum(map(len, ids)), np.int64)
        order[np.concatenate(place)] = np.arange(len(order))
        order = pa.array(order)
        numbers = pc.cast(pa.array(np.concatenate(ids)), pa.string()).take(order)
        spoken = pc.binary_join_element_wise(numbers, pa.concat_arrays(marks).take(order), "")
        offsets = np.frombuffer(spoken.buffers()[1], np.int32, len(spoken) + 1)
        per = self.per_document(self.sizes[0] + self.sizes[1])
        ends = offsets[np.concatenate([[0], np.cumsum(per)])]
        data = memoryview(spoken.buffers()[2])
        return [sha256(data[a : b - 1]).hexdigest() if b > a else "" for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


DOCUMENTS = (
    "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups_sha256 string, pairs array<bigint>, links array<bigint>"
)


def aligned_documents(docs: DataFrame, a: str, b: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of ``docs``: numbers of tokens, groups and links, the digest of the
    groups, and the distinct pairs of ids that are linked with the number of links."""

    def align(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, other = _loaded(ByteLevel, a), _loaded(Pieces, b)
        for batch in slices(batches, most=SLICE_BYTES):
            found = Aligned(batch.column("text").to_pylist(), one, other)
            pairs, links = found.pairs(len(other.bytes))
            counts = [pc.list_value_length(ids).cast(pa.int64()) for ids in found.lists]
            groups = found.per_document(np.ones(len(found.document)))
            products = found.per_document(found.sizes[0] * found.sizes[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), *counts, pa.array(groups), pa.array(products),
                 pa.array(found.digests(), pa.string()), pairs, links],
                [part.split()[0] for part in DOCUMENTS.split(", ")],
            )

    rows = with_text(docs.withColumn("__row", F.monotonically_increasing_id()), id, text, "__row")
    return rows.withColumnRenamed("__row", "row").mapInArrow(align, DOCUMENTS)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, total``: in how many documents each pair of ids is linked.

    Tasks count by ``Table.group_by`` and Spark adds up what they have counted.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []
        held = 0
        for batch in batches:
            pairs = pc.list_flatten(batch.column(0))
            table = pa.table({"pair": pairs}).group_by("pair", use_threads=False).aggregate([("pair", "count")])
            parts.append(table)
            held += table.num_rows
            if held > PARTIAL_ROWS:
                merged = _added(parts)
                parts, held = [merged], merged.num_rows
                if held > PARTIAL_ROWS // 2:
                    yield from merged.to_batches()
                    parts, held = [], 0
        if parts:
            yield from _added(parts).to_batches()

    def _added(parts: list[pa.Table]) -> pa.Table:
        table = pa.concat_tables(parts).group_by("pair", use_threads=False).aggregate([("pair_count", "sum")])
        return pa.table([table["pair"], table["pair_count_sum"]], ["pair", "pair_count"])

    counted = aligned.select("pairs").mapInArrow(count, "pair bigint, pair_count bigint")
    return counted.groupBy("pair").agg(F.sum("pair_count").alias("total"))


def token_alignment(
    docs: DataFrame,
    a: str,
    b: str,
    id: str = "doc_id",
    text: str = "text",
    known_pairs: int = KNOWN_PAIRS,
    scratch: Scratch | None = None,
) -> DataFrame:
    """``row, doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    Every text is encoded with a blank before it by ``a``, a byte-level BPE file of the
    tokenizers library, and by ``b``, a sentencepiece model, both at the same place on
    every executor; special tokens are not added, and their strings are plain text.
    Bytes where tokens of both end cut the tokens into groups, and within a group every
    token of ``a`` is linked with every one of ``b``. The count of a pair of ids is the
    number of rows that hold it linked. ``n_best`` are the links whose count is the
    largest that the id of ``a`` has, and ``count_sum`` adds up the counts of all links.
    Null and empty texts, and those that one of the tokenizers does not give back byte
    by byte, have no tokens: zeros, and an empty digest. Rows with equal ids are rows of
    their own, and a null id stays null. An empty table gives an empty one.

    Texts are encoded once. The distinct pairs of each row are written and read again
    with the counts: the ``known_pairs`` most frequent pairs, 17 bytes each, go to the
    tasks as a broadcast, and where there are more the others are joined by pair.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    spark = docs.sparkSession
    aligned = scratch.keep(aligned_documents(docs, a, b, id, text))
    with Scratch(spark, scratch.folder) as passing:
        width = len(_loaded(Pieces, b).bytes)
        totals = passing.keep(pair_counts(aligned).withColumn("a", F.expr(f"pair div {width}")))
        most = totals.groupBy("a").agg(F.max("total").alias("most"))
        judged = totals.join(most, "a").selectExpr("pair", "total", "total = most AS best")
        counts = scratch.keep(judged)
    every = counts.count() <= known_pairs
    least = 0 if every else _least_total(counts, known_pairs)
    table = counts.where(f"total >= {least}").toArrow().sort_by("pair")
    known = spark.sparkContext.broadcast(
        [table[name].to_numpy(zero_copy_only=False) for name in ("pair", "total", "best")]
    )

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, total, best = known.value
        for batch in batches:
            lists, links = (batch.column(batch.schema.get_field_index(n)) for n in ("pairs", "links"))
            row = pc.list_parent_indices(lists).to_numpy()
            wanted, times = (pc.list_flatten(c).to_numpy() for c in (lists, links))
            at = np.minimum(np.searchsorted(pairs, wanted), max(len(pairs) - 1, 0))
            found = pairs[at] == wanted if len(pairs) else np.zeros(len(wanted), bool)
            at, row, times = at[found], row[found], times[found]
            sums = np.zeros((2, batch.num_rows), np.int64)
            np.add.at(sums[0], row, times * total[at])
            np.add.at(sums[1], row, times * best[at])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sums[0]), pa.array(sums[1])], ["row", "count_sum", "n_best"]
            )

    fields = "row bigint, count_sum bigint, n_best bigint"
    digest = "doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256".split(", ")
    if every:
        kept = fields + ", " + ", ".join(f for f in DOCUMENTS.split(", ")[1:7])

        def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                (sums,) = score([batch])
                rest = [batch.column(i) for i in range(1, 7)]
                yield pa.RecordBatch.from_arrays(
                    [*sums.columns, *rest], [part.split()[0] for part in kept.split(", ")]
                )

        return aligned.mapInArrow(whole, kept).select("row", *digest)

    rest = counts.where(f"total < {least}").selectExpr("pair AS key", "total", "best")

    def unknown(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = known.value[0]
        for batch in batches:
            lists, links = batch.column(1), batch.column(2)
            row = batch.column(0).take(pc.list_parent_indices(lists))
            wanted = pc.list_flatten(lists)
            values = wanted.to_numpy()
            at = np.minimum(np.searchsorted(pairs, values), max(len(pairs) - 1, 0))
            new = pa.array(pairs[at] != values) if len(pairs) else pa.array(np.ones(len(values), bool))
            yield pa.RecordBatch.from_arrays(
                [row.filter(new), wanted.filter(new), pc.list_flatten(links).filter(new)], ["row", "by", "times"]
            )

    some = aligned.select("row", "pairs", "links")
    rare = join_groups(
        some.mapInArrow(unknown, "row bigint, by bigint, times bigint"),
        rest, rest.select("key", "total"),
    ).selectExpr("row", "times * total AS count_sum", "if(best, times, 0L) AS n_best")
    sums = some.mapInArrow(score, fields).unionByName(rare).groupBy("row").agg(
        F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best")
    )
    return aligned.drop("pairs", "links").join(sums, "row").select("row", *digest)


def _least_total(counts: DataFrame, most: int) -> int:
    """The least count that at most ``most`` pairs reach, to a ninth of its value."""
    level = F.floor(F.log2("total") * 8).alias("level")
    reached = 0
    for row in sorted(counts.groupBy(level).agg(F.count("*"), F.max("total")).collect(), reverse=True):
        reached += row[1]
        if reached > most:
            return row[2] + 1
    return 0
