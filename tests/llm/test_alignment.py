from __future__ import annotations

import json
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyframe.llm import alignment
from tallyframe.llm.alignment import Aligned, ByteLevel, Pieces, token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    one = Tokenizer.from_file(A)
    one.encode_special_tokens = True
    return one, sentencepiece.SentencePieceProcessor(model_file=B)


def groups_of(text, libraries):
    """Lists of ids of both tokenizers between common ends, one token after the other."""
    one, other = libraries
    if not text:
        return []
    table = {c: i for i, c in enumerate(bytes_to_letters())}
    ids = one.encode(" " + text, add_special_tokens=False).ids
    a = [(i, bytes(table[c] for c in one.id_to_token(i))) for i in ids]
    b = []
    for i in other.encode(text):
        piece = other.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if other.is_byte(i) else piece.replace("▁", " ").encode()))
    wanted = (" " + text).encode()
    if b"".join(x[1] for x in a) != wanted or b"".join(x[1] for x in b) != wanted:
        return []
    groups, at, end_a, end_b = [([], [])], 0, 0, 0
    for i, token in a:
        groups[-1][0].append(i)
        end_a += len(token)
        while end_b < end_a:
            groups[-1][1].append(b[at][0])
            end_b += len(b[at][1])
            at += 1
        if end_a == end_b:
            groups.append(([], []))
    return groups[:-1]


def bytes_to_letters():
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


def plain(documents, libraries):
    groups = [(d, groups_of(t, libraries)) for d, t in documents]
    linked = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in groups]
    count = Counter(pair for links in linked for pair in links)
    best = Counter()
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for (doc_id, found), links in zip(groups, linked, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in found)
        out.append((
            doc_id, sum(len(a) for a, _ in found), sum(len(b) for _, b in found), len(found),
            sum(links.values()), sum(n for p, n in links.items() if count[p] == best[p[0]]),
            sum(n * count[p] for p, n in links.items()), sha256(text.encode()).hexdigest() if found else "",
        ))
    return sorted(out, key=str)


def found(frame, **more):
    return sorted((tuple(r)[1:] for r in token_alignment(frame, A, B, **more).collect()), key=str)


def test_documents_of_the_tables(spark, documents, libraries):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    wanted = plain(documents, libraries)
    assert found(docs) == wanted and all(r[1] for r in wanted)
    # The counts of most pairs by a join.
    assert found(docs, known_pairs=500) == wanted
    assert found(docs, known_pairs=1) == wanted


ODD = [
    "<|endoftext|> is <s> plain </s> text <unk>", "  two  blanks\n\n\tand a tab ", "naïve ☃ \U0001f600 日本語テキスト",
    "á ﬁ ½ Ⅷ", "'s 't it's 12345 ...", "▁mark", "x" * 3000, "aaaa bbbb " * 40, "\x00\x07", " 　", "<0x41>",
]


def test_odd_texts_equal_the_plain_way(spark, libraries):
    rows = [*enumerate(ODD), (3, ODD[0]), (None, "no id"), (77, ""), (78, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS row", "'x' AS pairs", "2 AS links")
    assert found(frame) == plain(rows, libraries)


def test_a_file_with_other_rules_takes_the_library(tmp_path, libraries):
    spec = json.loads(open(A, encoding="utf-8").read())
    spec["normalizer"] = {"type": "Lowercase"}
    (path := tmp_path / "lower.json").write_text(json.dumps(spec), encoding="utf-8")
    lower, usual = ByteLevel(str(path)), ByteLevel(A)
    assert lower.encode("ABC Def") == usual.encode("abc def") != usual.encode("ABC Def")
    assert usual._encode.__self__.__class__.__name__ == "Encoding"
    for text in ODD:
        assert usual.encode(text) == libraries[0].encode(" " + text, add_special_tokens=False).ids


def test_large_groups_are_counted_by_distinct_tokens(libraries):
    one = Aligned(["a b a b a", "c"], ByteLevel(A), Pieces(B))
    n = len(one.flat[0])
    one.first, one.sizes = [np.array([0])] * 2, [np.array([len(f)]) for f in one.flat]
    one.document = np.array([0])
    plainly = one.pairs(32_000)
    document, pairs, links = one._large(0, 32_000)
    assert plainly[0][0].as_py() == pairs.tolist() and plainly[1][0].as_py() == links.tolist()
    assert links.sum() == n * len(one.flat[1]) and set(document) == {0}


def test_odd_and_no_documents(spark, odd_documents, no_documents, libraries):
    rows = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    assert found(odd_documents) == plain(rows, libraries)
    assert found(no_documents) == []
    assert alignment.KNOWN_PAIRS * 17 <= 64 << 20
