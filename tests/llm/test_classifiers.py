from __future__ import annotations

import pyarrow.parquet as pq
import pytest

from tallyframe.llm.common import is_held_out, labelled_sample
from tallyframe.llm.quality import quality, shape, train_quality
from tallyframe.llm.toxicity import drop_toxic, toxicity, train_toxicity

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "labels")]


def labels_of(name):
    table = pq.read_table(f"{FOLDER}/labels.parquet").to_pydict()
    return dict(zip(table["doc_id"], table[name], strict=True))


def test_the_sample_is_bounded_and_holds_nothing_held_out(spark, tables):
    sample = labelled_sample(*tables, "toxic", {1: 40, 0: 60})
    assert len(sample) <= 100 and len({t for t, _ in sample}) == len(sample)
    ids = {r["text"]: r["doc_id"] for r in tables[0].collect()}
    first = dict(sample)
    assert sum(first.values()) <= 40
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (4, 0), (4, 1), (6, 0)], "doc_id bigint, toxic int")
    texts = spark.createDataFrame([(i, f"text {i}") for i in range(8)], "doc_id bigint, text string")
    kept = {(f"text {i}", y) for i, y in ((1, 1), (6, 0)) if not is_held_out(i)}
    assert set(labelled_sample(texts, labels, "toxic", {1: 9, 0: 9})) == kept
    assert ids


def test_toxicity_on_held_out_labels(tables):
    wanted = labels_of("toxic")
    rows = toxicity(*tables).select("doc_id", "score", "spans").collect()
    assert len(rows) == tables[0].count() and all(0 <= r["score"] <= 1 for r in rows)
    right = {0: [], 1: []}
    for r in rows:
        if r["doc_id"] in wanted and is_held_out(r["doc_id"]):
            label = wanted[r["doc_id"]]
            right[label].append((r["score"] >= 0.7) == bool(label))
    assert sum(right[1]) >= 0.85 * len(right[1]) and sum(right[0]) >= 0.98 * len(right[0])
    texts = {r["doc_id"]: r["text"] for r in tables[0].collect()}
    told = [texts[r["doc_id"]][s["start"] : s["end"]] for r in rows for s in r["spans"]]
    assert "idiot" in told and "the" not in told


def test_quality_on_held_out_labels(tables):
    wanted = labels_of("quality")
    right = []
    for r in quality(*tables).collect():
        if r["doc_id"] in wanted and is_held_out(r["doc_id"]):
            right.append((r["score"] >= 0.5) == bool(wanted[r["doc_id"]]))
    assert len(right) > 1000 and sum(right) >= 0.98 * len(right)


def test_shapes():
    assert [shape(t) for t in ("Thaned,", "DNTEA!!", "a%%%", "v1.25", "|", "éÀ")] == ["Aa,", "A!", "a%", "a0.0", "|", "aA"]


def test_without_both_classes(spark, odd_documents, no_documents):
    assert train_toxicity([("a b", 1)]) is None and train_quality([("a b", 0)]) is None
    none = spark.createDataFrame([], "doc_id bigint, toxic int, quality int")
    assert {r["score"] for r in toxicity(odd_documents, none).collect()} == {0.0}
    assert {r["score"] for r in quality(odd_documents, none).collect()} == {0.5}
    assert drop_toxic(odd_documents, none).exceptAll(odd_documents).count() == 0


def test_odd_documents(tables, odd_documents, no_documents):
    for scored in (toxicity(odd_documents, tables[1]), quality(odd_documents, tables[1])):
        assert len(scored.collect()) == 7
    labels = tables[1]
    mixed = tables[0].where("doc_id < 3000").select("doc_id", "text").unionByName(odd_documents.select("doc_id", "text"))
    rows = toxicity(mixed, labels).where("doc_id IS NULL").collect()
    assert len(rows) == 1 and rows[0]["score"] < 0.7 and rows[0]["spans"] == []
    kept = drop_toxic(odd_documents, labels)
    assert kept.columns == odd_documents.columns
    for scored in (toxicity(no_documents, labels), quality(no_documents, labels), drop_toxic(no_documents, labels)):
        assert scored.collect() == []
