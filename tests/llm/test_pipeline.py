from __future__ import annotations

from collections import Counter
from pathlib import Path

import corpus_pipeline
from tallyframe.llm.decontaminate import contamination
from tallyframe.llm.pii import rule_spans
from tallyframe.llm.simhash import simhash_groups
from tallyframe.plans import Scratch, work_folder

FOLDER = "/root/testdata/sf0.01"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, results = docs.columns, {}
    with Scratch(spark) as scratch:
        for name, stage in corpus_pipeline.STAGES:
            results[name] = docs
            docs = scratch.keep(stage(spark, docs, FOLDER))
            if name != "best_fit_packing":
                assert docs.columns == columns
        before = [results[name].count() for name, _ in corpus_pipeline.STAGES]
        assert before[0] > before[1] > before[2] == before[3] == before[4]
        groups = simhash_groups(results["benchmark_decontamination"])
        assert groups.where("component_id <> doc_id").count() == 0
        benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
        assert contamination(results["personal_data"], benchmark).where("n_hit > 0").count() == 0
        last = results["best_fit_packing"].collect()
        assert not any(rule_spans(r["text"]) for r in last)
        assert all(r["n_chars"] == len(r["text"]) for r in last)
        words = {r["doc_id"]: len(r["text"].split()) for r in last}
        packed: dict[int, int] = {}
        for r in docs.collect():
            packed[r["doc_id"]] = packed.get(r["doc_id"], 0) + r["n_words"]
        assert packed == words
        labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
        gone = {r["doc_id"] for r in results["toxicity"].collect()} - {
            r["doc_id"] for r in results["simhash_near_duplicates"].collect()
        }
        known = [labels[d] for d in gone if d in labels]
        assert sum(known) >= 0.9 * len(known) > 0


def test_run_equals_its_stages_and_leaves_one_table(spark):
    folder = "/root/testdata/sf0.001"
    place = Path(work_folder(spark).removeprefix("file:").removeprefix("//"))
    before = set(place.iterdir())
    rows = corpus_pipeline.run(spark, folder).collect()
    left = set(place.iterdir()) - before
    assert len(left) == 1  # what the lazy result reads: the texts after the last but one stage
    assert "text" in spark.read.parquet(str(left.pop())).columns
    assert {"bin_id", "doc_id", "n_words"} <= set(rows[0].asDict())
    with Scratch(spark) as scratch:
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES:
            docs = scratch.keep(stage(spark, docs, folder))
        words = {}
        for found in rows, docs.collect():
            totals = Counter()
            for r in found:
                totals[r["doc_id"]] += r["n_words"]
            words[len(words)] = totals
    assert words[0] == words[1]


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, FOLDER)
        assert result.collect() == []
