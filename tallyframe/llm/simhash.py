"""Near-duplicates by SimHash: fingerprints, and a self-join of their binary trie."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.common import few, slices, unused, with_text
from tallyframe.llm.components import components
from tallyframe.plans import Scratch, join_groups

SEED = 42
#: Buckets of more fingerprints are divided by further bits.
BUCKET_ROWS = 1 << 14
#: Node pairs that a task looks at together.
FRONTIER = 1 << 17
ALL_BITS = (1 << 64) - 1


def fingerprint(text: str, shingle: int = 4) -> int:
    """64 bits, each set if it is set in over half the hashes of the word shingles.

    A-Z are lower-cased, words are split at ASCII white space, repeated shingles count
    as often as they occur. Fewer words than a shingle are one shingle, and no words
    give zero.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    last = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, last, strict=False)]
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], dtype="<u8").view(np.uint8)
        counts += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def fingerprints(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4
) -> DataFrame:
    """``row, doc_id, fingerprint``, one row per row of ``docs``; a null text is empty.

    ``row`` tells rows with the same id apart. The fingerprint is a signed bigint.
    """

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), _signed(found)],
                ["row", "doc_id", "fingerprint"],
            )

    rows = with_text(docs.withColumn("__row", F.monotonically_increasing_id()), id, text, "__row")
    return rows.withColumnRenamed("__row", "row").mapInArrow(
        compute, "row bigint, doc_id bigint, fingerprint bigint"
    )


# --- the trie self-join ------------------------------------------------------


def _divided(mask: int, parts: int) -> list[int]:
    """``mask`` with one of ``parts`` equal blocks of the other bits added, for each."""
    free = [bit for bit in range(63, -1, -1) if not mask >> bit & 1]
    cuts = np.array_split(free, parts)
    return [mask | sum(1 << int(bit) for bit in cut) for cut in cuts if len(cut)]


def _as_long(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _bucketed(rows: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
    """Rows ``mask, fingerprint``, each repeated under the masks that refine its own."""
    cases = " ".join(
        f"WHEN {_as_long(mask)}L THEN array({', '.join(f'{_as_long(m)}L' for m in finer)})"
        for mask, finer in masks.items()
    )
    return rows.selectExpr(f"explode(CASE mask {cases} END) AS mask", "fingerprint").selectExpr(
        "mask", "fingerprint & mask AS value", "fingerprint"
    )


def similar(distinct: DataFrame, scratch: Scratch, max_bits: int = 4) -> DataFrame:
    """``u, v``: links that connect all fingerprints within ``max_bits`` of each other.

    ``distinct`` has one row per ``fingerprint``. Of two fingerprints within the budget,
    one of ``max_bits + 1`` blocks of bits is the same in both. So each row goes to one
    bucket per block, and a bucket is a trie whose first levels are known to agree. A
    bucket of more than BUCKET_ROWS rows is divided in the same way by its other bits,
    again and again; as its rows are distinct, it is small once 14 bits are left. Every
    bucket is then joined with itself by ``trie_links``, which returns a spanning forest
    of the links, so a dense group gives no more links than it has members.
    """
    level = {0: _divided(0, max_bits + 1)}
    rows = _bucketed(distinct.selectExpr("0L AS mask", "fingerprint"), level)
    links = None
    while True:
        sizes = scratch.keep(rows.groupBy("mask", "value").count().where("count > 1"))
        known = sizes.agg(F.max("count"), F.collect_set(F.expr(f"if(count > {BUCKET_ROWS}, mask, NULL)")))
        largest, hot_masks = known.first()
        final = largest is None or largest <= BUCKET_ROWS
        small = rows if final else rows.join(
            sizes.where(f"count > {BUCKET_ROWS}"), ["mask", "value"], "left_anti"
        )
        found = _trie_join(small, max_bits)
        links = found if links is None else links.unionByName(found)
        if final:
            return links
        hot = sizes.where(f"count > {BUCKET_ROWS}")
        rows = scratch.keep(
            rows.join(hot, ["mask", "value"], "left_semi").select("mask", "fingerprint")
        )
        level = {mask & ALL_BITS: _divided(mask & ALL_BITS, max_bits + 1) for mask in hot_masks}
        rows = _bucketed(rows, level).distinct()


def _trie_join(rows: DataFrame, max_bits: int) -> DataFrame:
    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.empty((3, 0), dtype=np.int64)
        for batch in batches:
            new = np.stack([np.asarray(batch.column(i)) for i in range(3)])
            rest = np.concatenate([rest, new], axis=1)
            # The last bucket may go on in the next batch.
            change = np.flatnonzero((rest[:2, 1:] != rest[:2, :-1]).any(0))
            if len(change):
                yield links(rest[:, : change[-1] + 1])
                rest = rest[:, change[-1] + 1 :]
        if rest.shape[1]:
            yield links(rest)

    def links(part: np.ndarray) -> pa.RecordBatch:
        change = np.flatnonzero((part[:2, 1:] != part[:2, :-1]).any(0)) + 1
        bounds = np.concatenate([[0], change, [part.shape[1]]])
        prints = part[2].view(np.uint64)
        root = trie_links(prints, bounds, max_bits)
        child = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays(
            [pa.array(part[2][child]), pa.array(part[2][root[child]])], ["u", "v"]
        )

    dealt = rows.select("mask", "value", "fingerprint").repartition("mask", "value")
    # The order of a trie: by unsigned value, bit by bit.
    ordered = dealt.sortWithinPartitions("mask", "value", F.expr(f"fingerprint ^ {-(1 << 63)}L"))
    return ordered.mapInArrow(join, "u bigint, v bigint")


def trie_links(prints: np.ndarray, bounds: np.ndarray, max_bits: int) -> np.ndarray:
    """Of sorted fingerprints, the least index that each is linked with in its bucket.

    ``bounds`` are the limits of the buckets, each a trie of its own. The walk starts
    with every trie paired with itself and goes down one bit at a time: a pair of nodes
    becomes up to four pairs of children, of which those on unlike sides have one more
    differing bit, and a pair beyond the budget is dropped with all below it. A pair of
    single leaves is settled by its other bits at once, and a pair whose leaves are all
    linked with each other already is dropped. The pairs found last are walked first, so
    the leaves of a dense group are linked early and most of its pairs are not walked.
    """
    root = np.arange(len(prints))
    steps = np.arange(len(prints))  # grows where neighbours are not linked
    ones = [np.concatenate([[0], np.cumsum(prints >> np.uint64(63 - d) & np.uint64(1), dtype=np.int64)])
            for d in range(64)] if len(prints) <= FRONTIER else None

    def ones_before(depth: int, at: np.ndarray) -> np.ndarray:
        if ones is not None:
            return ones[depth][at]
        bits = (prints >> np.uint64(63 - depth)).astype(np.int64) & 1
        return np.concatenate([[0], np.cumsum(bits)])[at]

    lo, hi = bounds[:-1], bounds[1:]
    several = hi - lo > 1
    start = np.stack([lo[several], hi[several], lo[several], hi[several], np.zeros(several.sum(), np.int64)])
    stack = [(0, start)]
    while stack:
        depth, pairs = stack.pop()
        if pairs.shape[1] > FRONTIER:
            half = pairs.shape[1] // 2
            stack += [(depth, pairs[:, half:]), (depth, pairs[:, :half])]
            continue
        a0, a1, b0, b1, differing = pairs
        leaves = (a1 - a0 == 1) & (b1 - b0 == 1)
        if leaves.any():
            x, y = a0[leaves], b0[leaves]
            near = (np.bitwise_count(prints[x] ^ prints[y]) <= max_bits) & (x != y)
            if unite(root, x[near], y[near]):
                steps = np.concatenate([[0], np.cumsum(root[1:] != root[:-1])])
            pairs = pairs[:, ~leaves]
        a0, a1, b0, b1, differing = pairs
        linked = (root[a0] == root[b0]) & (steps[a1 - 1] == steps[a0]) & (steps[b1 - 1] == steps[b0])
        a0, a1, b0, b1, differing = pairs[:, ~linked]
        if not len(a0) or depth == 64:
            continue
        a_one = a1 - (ones_before(depth, a1) - ones_before(depth, a0))
        b_one = b1 - (ones_before(depth, b1) - ones_before(depth, b0))
        children = [
            (a0, a_one, b0, b_one, differing),
            (a_one, a1, b_one, b1, differing),
            (a0, a_one, b_one, b1, differing + 1),
            (a_one, a1, b0, b_one, differing + 1),
        ]
        same = a0 == b0
        kept = []
        for i, child in enumerate(children):
            c = np.stack(child)
            alive = (c[1] > c[0]) & (c[3] > c[2]) & (c[4] <= max_bits)
            if i == 3:
                alive &= ~same  # of a node with itself the mirror image of the pair before
            # A single leaf with itself links nothing.
            alive &= ~((c[0] == c[2]) & (c[1] - c[0] == 1))
            kept.append(c[:, alive])
        below = np.concatenate(kept, axis=1)
        if below.shape[1]:
            stack.append((depth + 1, below))
    return root


def unite(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> bool:
    """Merge the sets of ``x[i]`` and ``y[i]``; ``root`` holds the least index of each.

    True if any sets were merged.
    """
    merged = False
    while len(x):
        rx, ry = root[x], root[y]
        apart = rx != ry
        x, y, rx, ry = x[apart], y[apart], rx[apart], ry[apart]
        merged |= bool(len(x))
        np.minimum.at(root, np.maximum(rx, ry), np.minimum(rx, ry))
        while (higher := root[root] != root).any():
            root[higher] = root[root[higher]]
    return merged


# --- groups of documents -----------------------------------------------------


def simhash_groups(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = 4,
    max_bits: int = 4,
    scratch: Scratch | None = None,
) -> DataFrame:
    """``row, doc_id, fingerprint, component_id, first_row`` per row of ``docs``.

    Documents are linked if their fingerprints differ in at most ``max_bits`` bits, and
    a component holds all that links reach. ``component_id`` is its least id (null if
    it has none) and ``first_row`` the row that holds it, the least one of several.
    Equal fingerprints need no link: rows are grouped by fingerprint first, and only
    distinct ones are joined. Texts without words have fingerprint zero and are linked
    like any others. An empty table gives an empty one. Jobs run while it is called.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    rows = scratch.keep(fingerprints(docs, id, text, shingle))
    return _grouped(rows, max_bits, scratch)


def _grouped(rows: DataFrame, max_bits: int, scratch: Scratch) -> DataFrame:
    """The groups of written rows ``row, doc_id, fingerprint``."""
    # Ids before rows without one; of rows with the same id the first.
    first = "min(struct(doc_id IS NULL AS missing, doc_id, row))"
    with Scratch(rows.sparkSession, scratch.folder) as passing:
        prints = passing.keep(
            rows.groupBy("fingerprint").agg(F.expr(first).alias("first"), F.count("*").alias("total"))
        )
        links = passing.keep(similar(prints.select("fingerprint"), passing, max_bits))
        linked = components(links, passing)
        members = passing.keep(
            linked.join(prints, linked["node"] == prints["fingerprint"]).select(
                F.col("root").alias("by"), "node", "first"
            )
        )
        # A component may hold any part of all fingerprints, so its head is joined by size.
        heads = passing.keep(
            members.groupBy(F.col("by").alias("key")).agg(
                F.min("first").alias("head"), F.count("*").alias("total")
            )
        )
        headed = join_groups(members, heads.select("key", "head"), heads)
        groups = prints.join(headed.selectExpr("node AS fingerprint", "head"), "fingerprint", "left")
        groups = scratch.keep(
            groups.selectExpr("fingerprint AS key", "coalesce(head, first) AS head", "total")
        )
    return join_groups(
        rows.withColumnRenamed("fingerprint", "by"), groups.select("key", "head"), groups
    ).selectExpr(
        "row",
        "doc_id",
        "by AS fingerprint",
        "head.doc_id AS component_id",
        "head.row AS first_row",
    )


def drop_near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = 4,
    max_bits: int = 4,
    scratch: Scratch | None = None,
) -> DataFrame:
    """``docs`` with one row of each group of ``simhash_groups``, unchanged.

    The row with the least id stays; rows without an id come last, and of rows with the
    same id the one read first stays. The table is written once with its fingerprints,
    so later steps see the same rows. The rows to drop are broadcast if they are few,
    by their count, and joined by a shuffle if not. Of all tables written on the way only
    these two stay, as the result reads them; they belong to ``scratch``.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    row, own_id, print_ = (unused(docs, name) for name in ("row", "id", "fingerprint"))

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            found = [fingerprint(t or "", shingle) for t in texts]
            yield batch.append_column(print_, _signed(found))

    numbered = docs.withColumns({row: F.monotonically_increasing_id(), own_id: docs[id].cast("bigint")})
    schema = T.StructType([*numbered.schema.fields, T.StructField(print_, T.LongType())])
    kept = scratch.keep(numbered.mapInArrow(compute, schema))
    rows = kept.select(
        F.col(row).alias("row"), F.col(own_id).alias("doc_id"), F.col(print_).alias("fingerprint")
    )
    with Scratch(docs.sparkSession, scratch.folder) as passing:
        groups = _grouped(rows, max_bits, passing)
        dropped = scratch.keep(groups.where("row <> first_row").select(F.col("row").alias(row)))
    return kept.join(few(dropped), row, "left_anti").select(*docs.columns)
