from __future__ import annotations

import random

import pytest

from tallyframe.llm import packing
from tallyframe.llm.packing import pack, pack_shard


def plain(pieces, capacity):
    """Bin and place of each piece, looking at all bins."""
    bins, result = [], []
    for size, source, cluster in pieces:
        able = []
        for number, members in enumerate(bins):
            left = capacity - sum(m[0] for m in members)
            conflict = any(
                (source is not None and m[1] == source) or (cluster is not None and m[2] == cluster)
                for m in members
            )
            if 0 < left >= size and not conflict:
                able.append((left, number))
        number = min(able)[1] if able else len(bins)
        if number == len(bins):
            bins.append([])
        result.append((number, len(bins[number])))
        bins[number].append((size, source, cluster))
    return result


def test_shards_equal_brute_force():
    rng = random.Random(2)
    for _ in range(150):
        capacity = rng.randint(1, 20)
        pieces = [
            (rng.randint(0, capacity), rng.choice(["a", "b", "c", None]), rng.choice([1, 2, None, *range(3, 40)]))
            for _ in range(rng.randint(0, 60))
        ]
        pieces.sort(key=lambda p: -p[0])
        columns = list(zip(*pieces, strict=True)) if pieces else [[], [], []]
        assert pack_shard(*map(list, columns), capacity) == plain(pieces, capacity)


@pytest.mark.parametrize("shard_pieces", [4096, 50])
def test_all_words_are_placed_without_conflict(spark, monkeypatch, documents, shard_pieces):
    monkeypatch.setattr(packing, "SHARD_PIECES", shard_pieces)
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    source = {r["doc_id"]: r["source"] for r in frame.select("doc_id", "source").collect()}
    texts = dict(documents)
    rows = pack(frame, capacity=300).collect()
    for doc_id, text in documents:
        words = sum(r["n_words"] for r in rows if r["doc_id"] == doc_id)
        assert words == len(text.split())
        starts = sorted(r["start_word"] for r in rows if r["doc_id"] == doc_id)
        assert starts == [300 * i for i in range(len(starts))]
    bins = {}
    for r in rows:
        bins.setdefault(r["bin_id"], []).append(r)
    for members in bins.values():
        assert sum(m["n_words"] for m in members) <= 300
        assert sorted(m["place"] for m in members) == list(range(len(members)))
        for of in (source, texts):
            assert len({of[m["doc_id"]] for m in members}) == len(members)


def test_odd_documents(spark, odd_documents, no_documents):
    rows = pack(odd_documents, capacity=1000).collect()
    assert sum(r["n_words"] for r in rows) == 16 + 16 + 4 + 120_000
    assert {r["doc_id"] for r in rows} == {1, 2, 3, 4, 5, None}
    assert sum(r["n_words"] == 0 for r in rows) == 3
    assert pack(no_documents).collect() == []
    with pytest.raises(ValueError):
        pack(odd_documents, capacity=0)
