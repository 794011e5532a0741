from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from tallyframe.llm import simhash
from tallyframe.llm.components import components
from tallyframe.llm.simhash import drop_near_duplicates, fingerprint, simhash_groups, trie_links
from tallyframe.plans import Scratch


def plain_fingerprint(text, size=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(prints, max_bits):
    """Components by comparing all with all."""
    root = list(range(len(prints)))
    for _ in root:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= max_bits:
                    root[i] = root[j] = min(root[i], root[j])
    return root


@pytest.mark.parametrize("text", ["", " \n", "One", "a b c", "a b c d", "Ä b\tC d  e\x0bf g a b c d e", "x " * 999])
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_trie_links_equal_all_pairs():
    rng = random.Random(1)
    for trial in range(60):
        prints, bounds = [], [0]
        for _ in range(rng.randint(1, 4)):
            centre = rng.getrandbits(64)
            near = {centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 6))) & simhash.ALL_BITS
                    for _ in range(rng.randint(1, 25))}
            prints += sorted(near)
            bounds.append(len(prints))
        array = np.array(prints, dtype=np.uint64)
        frontier, simhash.FRONTIER = simhash.FRONTIER, rng.choice([7, 1 << 18])
        found = trie_links(array, np.array(bounds), 4)
        simhash.FRONTIER = frontier
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            assert (found[lo:hi] - lo).tolist() == groups_of(prints[lo:hi], 4), trial


def test_groups_equal_brute_force(spark, documents):
    frame = spark.createDataFrame(documents, "doc_id bigint, text string")
    rows = simhash_groups(frame).collect()
    prints = [plain_fingerprint(text) for _, text in documents]
    root = groups_of(prints, 4)
    expected = {d: (p, documents[r][0]) for (d, _), p, r in zip(documents, prints, root, strict=True)}
    assert {r["doc_id"]: (r["fingerprint"] & simhash.ALL_BITS, r["component_id"]) for r in rows} == expected
    assert len(set(root)) < len(documents)


def test_large_buckets_are_divided(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 70)
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    prints = sorted({centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(120)}
                    | {rng.getrandbits(64) for _ in range(60)})
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    with Scratch(spark) as scratch:
        links = simhash.similar(spark.createDataFrame(signed, "fingerprint bigint"), scratch)
        found = {r["node"]: r["root"] for r in components(links, scratch).collect()}
    groups = {}
    for (value,), root in zip(signed, groups_of(prints, 4), strict=True):
        groups.setdefault(root, []).append(value)
    expected = {v: min(group) for group in groups.values() if len(group) > 1 for v in group}
    assert found == expected


def test_components_of_a_chain_a_star_and_self_links(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (301, 300)]
    with Scratch(spark) as scratch:
        found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "u bigint, v bigint"), scratch).collect()}
        assert components(spark.createDataFrame([], "u bigint, v bigint"), scratch).collect() == []
    expected = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {200: 200, 300: 300, 301: 300}
    assert found == expected


def test_odd_documents(odd_documents, no_documents):
    rows = sorted(simhash_groups(odd_documents).collect(), key=lambda r: r["row"])
    assert [(r["doc_id"], r["component_id"]) for r in rows] == [
        (1, 1), (1, 1), (2, 2), (3, 2), (None, None), (4, 4), (5, 2),
    ]
    kept = drop_near_duplicates(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect() if r["doc_id"] != 4) == sorted([
        (0, "no id at all"), (1, odd_documents.first()["text"]), (2, None),
    ], key=lambda x: x[0])
    assert kept.count() == 4
    assert simhash_groups(no_documents).collect() == [] and drop_near_duplicates(no_documents).collect() == []
