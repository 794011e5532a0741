from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from tallyframe.llm import pii
from tallyframe.llm.bilstm_crf import Tagger
from tallyframe.llm.pii import find_spans, personal_data, redact, redacted, rule_spans, tagged_spans, train_tagger

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def checked(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and checked(digits(m))]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(found)


@pytest.fixture(scope="module")
def tagger():
    texts = [t for t in _texts() if pii.TRIGGER.search(t)]
    return train_tagger(texts[:500])


def _texts():
    import pyarrow.parquet as pq

    return pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"])["text"].to_pylist()


def test_rules_equal_plain_patterns():
    rng = random.Random(5)
    signs = [*"0123456789a@@..-+ (", "é", "1.2.3.4", "4111111111111111", "x@y.z"]
    for _ in range(20_000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 30)))
        assert rule_spans(text) == plain(text), text


def test_rules_are_fast_on_long_texts():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" * 150_000, "1 " * 150_000):
        rule_spans(text)


def test_gradients():
    allowed = np.array([[b == 0 or b % 2 == 1 or a in (b, b - 1) for b in range(5)] for a in range(5)])
    tagger = Tagger.new(7, 5, allowed, 4, 3, 0)
    chars = np.random.default_rng(0).integers(0, 7, (6, 3))
    tags = np.array([[0, 1, 2, 0, 3, 4], [1, 2, 2, 0, 0, 3], [0, 0, 0, 1, 1, 2]]).T
    _, gradients = tagger.gradients(chars, tags)
    for parameter, gradient in zip(tagger.parameters(), gradients, strict=True):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        before, values = parameter[at].copy(), []
        for step in (0.01, -0.01):
            parameter[at] = before + np.float32(step)
            values.append(tagger.gradients(chars, tags)[0])
        parameter[at] = before
        assert (values[0] - values[1]) / 0.02 == pytest.approx(gradient[at], rel=0.02, abs=1e-3)


def test_held_out_spans_and_clean_texts(tagger):
    texts = [t for t in _texts() if pii.TRIGGER.search(t)][500:]
    found = wanted = 0
    for text, tagged in zip(texts, tagged_spans(tagger, texts), strict=True):
        rules = set(rule_spans(text))
        found += len(rules & set(tagged))
        wanted += len(rules)
    assert wanted > 100 and found >= 0.85 * wanted
    clean = [t for t in _texts()[:400] if not rule_spans(t)]
    assert sum(len(spans) for _, spans in find_spans(tagger, clean)) <= 0.02 * len(clean)


def test_windows_do_not_matter_where_a_span_lies(tagger):
    text = "and the words go on " * 30
    for at in (0, 40, 90, 95, 143, 300):
        put = text[:at] + " joe.doe@mail.example.com " + text[at:]
        (rules, spans), = find_spans(tagger, [put])
        assert rules == plain(put) and set(rules) <= set(spans)


def test_registered_query_equals_plain_patterns(spark, documents):
    import __spark_entry__

    rows = {r["doc_id"]: r for r in __spark_entry__.queries()["op5_personal_data"](spark, "/root/testdata/sf0.001").collect()}
    assert len(rows) == len(documents)
    for doc_id, text in documents:
        base, row = plain(text), rows[doc_id]
        written = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert row["base_sha256"] == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == i for s in base) for i in range(4)]
        assert set(written) <= set(row["spans"].split(","))


def test_odd_documents(odd_documents, no_documents):
    rows = personal_data(odd_documents).collect()
    assert len(rows) == 7 and all(r["rules"] == [] for r in rows)
    assert personal_data(no_documents).collect() == []
    kept = redact(odd_documents)
    assert kept.columns == odd_documents.columns and kept.exceptAll(odd_documents).count() == 0
    assert redacted("a x@y.z b 1.2.3.4.", [(2, 0, 7), (10, 1, 17)]) == "a [email] b [ip]."
    assert redacted("1234567", [(0, 2, 5), (3, 3, 6)]) == "[card]7"
