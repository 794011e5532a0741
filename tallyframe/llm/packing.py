"""Best-fit packing of documents into training sequences, with conflicts."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that a sequence holds.
CAPACITY = 1024
#: Pieces that are packed together.
SHARD_PIECES = 4096


class Bins:
    """Open bins, ordered by what is left in them.

    Each bin carries two bitmaps, of the sources and of the duplicate clusters in it.
    A bitmap is a whole number of any size, so their number has no limit.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.order: list[tuple[int, int]] = []  # residual and number of the bins with room
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.counts: list[int] = []

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Put a piece into the tightest compatible bin; the bin and the place in it.

        ``source`` and ``cluster`` are bits, or 0. The search starts at the first bin
        with room enough and goes on to its successors until neither bitmap holds the
        piece's bit. Of bins that are equally tight the first opened is taken. Without
        a compatible bin a new one is opened.
        """
        order, sources, clusters = self.order, self.sources, self.clusters
        for at in range(bisect_left(order, (size, 0)), len(order)):
            residual, number = order[at]
            if not (sources[number] & source or clusters[number] & cluster):
                del order[at]
                break
        else:
            residual, number = self.capacity, len(sources)
            sources.append(0)
            clusters.append(0)
            self.counts.append(0)
        sources[number] |= source
        clusters[number] |= cluster
        self.counts[number] += 1
        if residual > size:
            insort(order, (residual - size, number))
        return number, self.counts[number] - 1


def pack_shard(
    sizes: list[int], sources: list, clusters: list, capacity: int
) -> list[tuple[int, int]]:
    """Bin and place of each piece, packed in the order given (the largest first)."""
    bins = Bins(capacity)
    source_bits: dict = {None: 0}
    for source in sources:
        source_bits.setdefault(source, 1 << (len(source_bits) - 1))
    # Only clusters with several members here can conflict.
    several = [c for c, n in Counter(clusters).items() if n > 1 and c is not None]
    cluster_bits = {c: 1 << i for i, c in enumerate(several)}
    return [
        bins.place(size, source_bits[source], cluster_bits.get(cluster, 0))
        for size, source, cluster in zip(sizes, sources, clusters, strict=True)
    ]


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    cluster: Column | None = None,
) -> DataFrame:
    """``bin_id, place, doc_id, piece, start_word, n_words``: where every word goes.

    A document longer than ``capacity`` words is cut into full pieces and a rest. A bin
    holds at most ``capacity`` words, at most one piece of each source and at most one of
    each duplicate cluster: by default of each text, as it is. Pieces go into the
    tightest bin that allows them, the largest pieces first.

    Nothing is left out: a null or text without words is a piece of no words. A null
    source conflicts with none, and neither does a null cluster or a text without words.
    Rows with the same id are documents of their own.

    Pieces are counted first and dealt to shards of about SHARD_PIECES by a hash, so a source or cluster
    with a third of all rows has a third of every shard; shards are packed on their own.
    Only ids, sources, hashes and sizes are shuffled.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    words = F.coalesce(F.regexp_count(docs[text], F.lit(r"\S+")), F.lit(0)).cast("bigint")
    copies = F.xxhash64(docs[text]) if cluster is None else F.xxhash64(cluster)
    known = docs[text] if cluster is None else cluster
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        docs[id].cast("bigint").alias("doc_id"),
        docs[source].cast("string").alias("source"),
        words.alias("words"),
        F.when(known.isNotNull() & (words > 0), copies).alias("cluster"),
    )
    last = F.greatest(F.expr(f"(words - 1) div {capacity}"), F.lit(0))
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).selectExpr(
        "row", "doc_id", "piece", "source", "cluster", f"least({capacity}, words - piece * {capacity}) AS size"
    )
    total = rows.agg(F.sum(last + 1)).first()[0] or 0
    shards = max(1, -(-total // SHARD_PIECES))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _shards(batches):
            shard, _, doc_id, piece, source, cluster, size = table.columns
            found = pack_shard(size.to_pylist(), source.to_pylist(), cluster.to_pylist(), capacity)
            bins, places = (np.array(x, dtype=np.int64) for x in zip(*found, strict=True))
            columns = [
                pa.array((shard.to_numpy().astype(np.int64) << 32) + bins),
                pa.array(places),
                doc_id.combine_chunks(),
                piece.combine_chunks(),
                pa.array(piece.to_numpy() * capacity),
                size.combine_chunks(),
            ]
            names = ["bin_id", "place", "doc_id", "piece", "start_word", "n_words"]
            yield from pa.table(columns, names=names).to_batches()

    dealt = (
        pieces.select(
            F.pmod(F.xxhash64("row", "piece"), F.lit(shards)).cast("int").alias("shard"), "row", "doc_id", "piece", "source", "cluster", "size"
        )
        .repartition("shard")
        .sortWithinPartitions("shard", F.desc("size"), "row", "piece")
    )
    return dealt.mapInArrow(
        place, "bin_id bigint, place bigint, doc_id bigint, piece bigint, start_word bigint, n_words bigint"
    )


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one shard after the other, from batches that are sorted by shard."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        shard = batch.column(0).to_numpy()
        cuts = np.flatnonzero(np.diff(shard)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shard)], strict=True):
            if start == end:
                continue
            if kept and kept[-1].column(0)[0].as_py() != shard[start]:
                yield pa.Table.from_batches(kept)
                kept = []
            kept.append(batch.slice(start, end - start))
    if kept:
        yield pa.Table.from_batches(kept)
