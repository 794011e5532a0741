from __future__ import annotations

import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyframe.llm import tokens
from tallyframe.llm.tokens import WordEncoder, read_tokens, token_index, write_tokens
from tallyframe.plans import Scratch

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def plain(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


def test_encoder_equals_the_library(library, documents, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_BYTES", 100_000)
    encoder = WordEncoder(PATH)
    rng = random.Random(1)
    signs = ["a", "B", " ", "  ", "\n", "\t", "é", "9", "!", "'s", "'ll", "<|endoftext|>", "²", "_", "中", "😀", "\x1c", "\x85", "\xa0", " the", " x", ".", "ª", "½"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 14))) for _ in range(5000)]
    texts += [t for _, t in documents]
    texts += ["word's don't, (ab)cd-ef naïve über ÿes\xa0no a\xa0 b 12ab ab12 \xc2\xa0x Â\xa0 Âł Ġx " + t[:90] for t in texts[:300]]
    for start in range(0, len(texts), 400):
        part = texts[start : start + 400]
        for text, ids in zip(part, encoder.encode_all(part), strict=True):
            assert ids == plain(library, text), repr(text)
    assert encoder.usual and encoder.joins and encoder.older


@pytest.mark.parametrize("change", [{"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}}])
def test_a_file_with_other_rules_takes_the_library(tmp_path, change):
    spec = json.loads(open(PATH, encoding="utf-8").read()) | change
    (path := tmp_path / "other.json").write_text(json.dumps(spec), encoding="utf-8")
    encoder, other = WordEncoder(str(path)), Tokenizer.from_file(str(path))
    assert not encoder.usual
    for text in ("Abc DEF ghi", "", "x"):
        assert encoder.encode(text) == plain(other, text)


def test_round_trip(spark, library, documents):
    import __spark_entry__

    rows = {r["doc_id"]: r for r in __spark_entry__.queries()["op6_token_files"](spark, "/root/testdata/sf0.001").collect()}
    start = 0
    for doc_id, text in documents:
        ids = plain(library, text) + b"\0\0\0\0"
        row = rows.pop(doc_id)
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
    assert not rows


def test_files_hold_indexes_and_filters(spark, documents):
    with Scratch(spark) as scratch:
        frame = spark.createDataFrame(documents, "doc_id bigint, text string")
        write_tokens(frame, path := scratch.path(), PATH)
        written = read_tokens(spark, path)
        files = written.inputFiles()
        assert all(name.endswith(".zstd.orc") for name in files)
        some = written.where(f"doc_id = {documents[3][0]}")
        assert some.count() == 1 and "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id" in some._jdf.queryExecution().toString()
        shards = sorted(map(tuple, written.selectExpr("shard", "position", "doc_id").collect()))
        assert [s[2] for s in shards] == [d for d, _ in documents]


def test_footers_hold_row_indexes_and_bloom_filters(spark, documents):
    """As the ORC library reads them back from a file of the writer."""
    with Scratch(spark) as scratch:
        frame = spark.createDataFrame(documents, "doc_id bigint, text string")
        write_tokens(frame, path := scratch.path(), PATH)
        jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
        name = jvm.org.apache.hadoop.fs.Path(read_tokens(spark, path).inputFiles()[0])
        reader = jvm.org.apache.orc.OrcFile.createReader(name, jvm.org.apache.orc.OrcFile.readerOptions(conf))
        assert reader.getRowIndexStride() > 0 and reader.getCompressionKind().toString() == "ZSTD"
        rows, (stripe, *_) = reader.rows(), reader.getStripes()
        assert stripe.getIndexLength() > 0
        streams = list(rows.readStripeFooter(stripe).getStreamsList())
        kinds = {(s.getKind().toString(), s.getColumn()) for s in streams}
        columns = reader.getSchema().getFieldNames()
        doc_id = 1 + list(columns).index("doc_id")
        assert {("ROW_INDEX", doc_id), ("BLOOM_FILTER_UTF8", doc_id)} <= kinds
        rows.close()


def test_odd_documents(spark, odd_documents, no_documents, library):
    for frame, count in ((odd_documents, 7), (no_documents, 0)):
        with Scratch(spark) as scratch:
            write_tokens(frame, path := scratch.path(), PATH)
            rows = token_index(read_tokens(spark, path)).orderBy("start").collect()
        assert len(rows) == count
        if rows:
            assert [r["doc_id"] for r in rows] == [None, 1, 1, 2, 3, 4, 5]
            assert rows[0]["start"] == 0 and rows[3]["n_tokens"] == rows[4]["n_tokens"] == 1
