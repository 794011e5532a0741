from __future__ import annotations

import random
import re

import numpy as np

from tallyframe.llm import decontaminate as module
from tallyframe.llm.decontaminate import contamination, decontaminate
from tallyframe.llm.fmindex import FMIndex

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(texts, items, window):
    """Flags and items by looking up every window of every text."""
    known = {}
    for item, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            known.setdefault(tuple(words[i : i + window]), set()).add(item)
    result = []
    for text in texts:
        words = words_of(text)
        flags, found = [False] * len(words), set()
        for size in {len(k) for k in known}:
            for i in range(len(words) - size + 1):
                if (at := known.get(tuple(words[i : i + size]))) is not None:
                    flags[i : i + size] = [True] * size
                    found |= {str(x) for x in at if x is not None}
        result.append((len(words), sum(flags), sorted(found)))
    return result


def test_index_finds_all_places():
    rng = random.Random(4)
    for _ in range(40):
        runs = [[rng.randint(1, 4) for _ in range(rng.randint(1, 40))] for _ in range(rng.randint(1, 4))]
        sequence = np.array([x for run in runs for x in (*run, 0)])
        index = FMIndex(sequence)
        phrases = np.zeros((20, 5), dtype=np.int32)
        lengths = np.array([rng.randint(1, 5) for _ in phrases])
        for row, n in zip(phrases, lengths, strict=True):
            row[:n] = [rng.randint(1, 5) for _ in range(n)]
        for row, n, lo, hi in zip(phrases, lengths, *index.search(phrases, lengths), strict=True):
            expected = [i for i in range(len(sequence) - n + 1) if (sequence[i : i + n] == row[:n]).all()]
            assert sorted(index.locate(np.arange(lo, hi)).tolist()) == expected


def test_random_texts(spark, monkeypatch):
    rng = random.Random(5)
    vocabulary = ["a", "b", "Cc", "é9", "x1", "...", "und", "Ö"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    texts = [text(rng.randint(0, 50)) for _ in range(60)]
    items = [(k, text(rng.choice([0, 1, 2, 5, 9]))) for k in range(9)] + [(None, text(6)), (3, text(5))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    expected = dict(enumerate(plain(texts, items, 3)))
    for block_bytes in (module.BLOCK_BYTES, 400):
        monkeypatch.setattr(module, "BLOCK_BYTES", block_bytes)
        rows = contamination(docs, benchmark, window=3).collect()
        assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in rows} == expected
    cut = decontaminate(docs, benchmark, window=3)
    assert all(r["n_hit"] == 0 for r in contamination(cut, benchmark, window=3).collect())
    same = dict(map(tuple, cut.collect()))
    assert all(same[i] == texts[i] for i, (_, hit, _) in expected.items() if not hit)


def test_registered_query_equals_brute_force(spark, documents):
    import hashlib

    import __spark_entry__

    folder = "/root/testdata/sf0.001"
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    rows = __spark_entry__.queries()["op3_decontamination"](spark, folder).collect()
    found = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows}
    expected = {}
    for (doc_id, _), (n, hit, at) in zip(documents, plain([t for _, t in documents], items, 10), strict=True):
        expected[doc_id] = (n, hit, len(at), hashlib.sha256(",".join(at).encode()).hexdigest(), hit > 0)
    assert found == expected
    assert any(v[4] for v in expected.values())


def test_spans_and_cuts(spark):
    docs = spark.createDataFrame([(1, "Ä start: One two THREE, four. End é"), (2, "one two three")], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(7, "one two three four")], "item_id bigint, text string")
    rows = {r["doc_id"]: r for r in contamination(docs, benchmark).collect()}
    assert [tuple(s) for s in rows[1]["spans"]] == [(9, 28)] and rows[1]["items"] == ["7"]
    assert rows[2]["n_hit"] == 0
    assert dict(map(tuple, decontaminate(docs, benchmark).collect()))[1] == "Ä start: . End é"
    # A cut that brings another occurrence together.
    nested = spark.createDataFrame([(1, "x one two one two three four three four y")], "doc_id bigint, text string")
    assert decontaminate(nested, benchmark).first()["text"].split() == ["x", "y"]


def test_odd_documents(spark, odd_documents, no_documents):
    benchmark = spark.createDataFrame([(1, "brown fox jumps over the lazy dog it was here so"), (2, None)], "item_id bigint, text string")
    rows = contamination(odd_documents, benchmark).collect()
    assert sorted((r["doc_id"] or 0, r["n_hit"]) for r in rows) == [(0, 0), (1, 11), (1, 11), (2, 0), (3, 0), (4, 0), (5, 0)]
    cut = decontaminate(odd_documents, benchmark)
    assert cut.columns == odd_documents.columns and cut.count() == 7
    assert [r["text"] for r in cut.where("doc_id = 2").collect()] == [None]
    assert contamination(no_documents, benchmark).collect() == []
    nothing = benchmark.where("item_id > 9")
    assert sum(r["n_hit"] for r in contamination(odd_documents, nothing).collect()) == 0
    assert decontaminate(odd_documents, nothing).exceptAll(odd_documents).count() == 0
