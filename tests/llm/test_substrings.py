from __future__ import annotations

import hashlib
import random

import pytest

from tallyframe.llm.substrings import Cut, word_hash, without_repeats


def units_of(text):
    """Sentences and parts of long ones as tuples of words; only the hash is the operator's."""
    units, place = [], 0
    for line in text.split("\n"):
        words, sentence = line.lower().split(), []
        for i, word in enumerate(words):
            sentence.append(word)
            if word[-1] in ".!?" or i == len(words) - 1:
                cuts = {len(sentence)}
                for k in range(len(sentence) - 15):
                    if len(sentence) > 16:
                        window = [(word_hash(w), -j) for j, w in enumerate(sentence[k : k + 16])]
                        cuts.add(k - min(window)[1] + 1)
                at = 0
                for end in sorted(cuts):
                    units.append((place + at, tuple(sentence[at:end])))
                    at = end
                place += len(sentence)
                sentence = []
    return units


def runs_of(text):
    """``words, start, end`` of the runs of a text, in words, from each unit on."""
    units = units_of(text)

    def size(first, end):
        return sum(len(u[1]) for u in units[first:end])

    def short(first):
        return first + 2 <= len(units) and size(first, first + 2) >= 16

    for first in range(len(units)):
        whole = next((e for e in range(first + 3, len(units) + 1) if size(first, e) >= 12), None)
        ends = [first + 2] if short(first) else []
        if whole and not (short(first) and short(first + 1) and whole == first + 3):
            ends.append(whole)
        for end in ends:
            last = units[end - 1]
            yield tuple(u[1] for u in units[first:end]), units[first][0], last[0] + len(last[1])


def plain(texts):
    """``text, spans`` by looking up the runs of one document after the other, by id."""
    seen, result = {}, {}
    for doc_id in sorted(texts):
        text, hit = texts[doc_id], []
        for run, start, end in runs_of(text or ""):
            if run in seen:
                hit.append((start, end, seen[run]))
            else:
                seen[run] = doc_id
        merged = []
        for start, end, first in sorted(hit):
            if merged and start <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(end, merged[-1][1]), min(first, merged[-1][2]))
            else:
                merged.append((start, end, first))
        spans, gone = [], set()
        at, places = 0, []
        for word in (text or "").split():
            at = text.index(word, at)
            places.append((at, at + len(word)))
            at += len(word)
        for start, end, first in merged:
            spans.append((places[start][0], places[end - 1][1], first))
            after = places[end][0] if end < len(places) else len(text)
            gone.update(range(places[start][0], after))
        left = text and "".join(c for i, c in enumerate(text) if i not in gone)
        ends_cut = bool(merged) and merged[-1][1] == len(places)
        result[doc_id] = (left.rstrip() if ends_cut else left), spans
    return result


def found(frame):
    rows = without_repeats(frame).collect()
    return {r["doc_id"]: (r["text"], [tuple(s) for s in r["repeated_spans"]]) for r in rows}


def test_sentences_and_parts():
    text = "One two.  Three! \n\n Four?? five\n" + " ".join(f"w{i}" for i in range(40)) + " . end"
    assert [u[1] for u in units_of(text)][:4] == [("one", "two."), ("three!",), ("four??",), ("five",)]
    for some in (text, "", "\n", "a", "x " * 16, "y " * 17, "a.\0b c\n\0 d. e", " " + text + " é ⅷ. \x1c q r"):
        at, start, end, _, _ = Cut().runs(["", some, "last one"])
        assert [(a, b) for t, a, b in zip(at, start, end, strict=True) if t == 1] == [r[1:] for r in runs_of(some)]


def test_query_equals_brute_force(spark, documents):
    import __spark_entry__

    rows = __spark_entry__.queries()["op9_repeated_passages"](spark, "/root/testdata/sf0.001").collect()
    wanted = plain(dict(documents))
    assert len(rows) == len(wanted) and any(r["n_spans"] for r in rows)
    for r in rows:
        text, spans = wanted[r["doc_id"]]
        assert r["spans"] == ",".join(":".join(map(str, s)) for s in spans) and r["n_spans"] == len(spans)
        assert r["n_repeated"] == sum(b - a for a, b, _ in spans)
        assert r["kept_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_what_is_left_has_no_repeats(spark, documents):
    frame = spark.createDataFrame(documents, "doc_id bigint, text string")
    left = without_repeats(frame).drop("repeated_spans")
    again = without_repeats(left).where("size(repeated_spans) > 0").collect()
    # Sentences on both sides of a cut are neighbours now, as they may be elsewhere.
    assert len(again) <= 0.01 * len(documents)


def test_small_texts_equal_brute_force(spark):
    rng = random.Random(5)
    few = ["a", "b", "c.", "d\n", "e!", "F", "g", "\n\n", "h i j k", "l. m?"]
    texts = {i: " ".join(rng.choice(few) for _ in range(rng.randrange(80))) for i in range(60)}
    assert found(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")) == plain(texts)


def test_planted_passages(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    text = lambda n: " ".join(word() + rng.choice(["", "", "", "", ".", ","]) for _ in range(n))
    passage = text(60) + "."
    texts = {i: text(100) + ". " for i in range(30)}
    for i in (3, 7, 20):
        texts[i] += passage + " " + text(50)
    rows = found(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"))
    hit = {d: spans for d, (_, spans) in rows.items() if spans}
    assert hit.keys() == {7, 20} and all(s[2] == 3 for spans in hit.values() for s in spans)
    for d, spans in hit.items():
        assert sum(s[1] - s[0] for s in spans) > 0.7 * len(passage)
        assert all(rows[i][0] == texts[i] for i in texts if i not in hit)


def test_odd_documents(odd_documents, no_documents):
    columns = odd_documents.columns
    result = without_repeats(odd_documents)
    assert result.columns == [*columns, "repeated_spans"]
    rows = sorted(result.collect(), key=str)
    text = odd_documents.first()["text"]
    spans = sorted((r["doc_id"], *r["repeated_spans"][0]) for r in rows if r["repeated_spans"])
    assert spans == [(1, 0, len(text), 1), (4, 36, 20_000 * 36 - 1, 4)]
    assert {r["doc_id"]: r["text"] for r in rows if r["doc_id"] in (2, 3, 5)} == {2: None, 3: "", 5: " \n\t "}
    assert sorted(r["text"] for r in rows if r["doc_id"] == 1) == ["", text] and len(rows) == 7
    assert without_repeats(no_documents).collect() == []
    with pytest.raises(ValueError, match="already"):
        without_repeats(odd_documents, spans="SPANS")


def test_passages_inside_sentences_and_without_marks(spark):
    rng = random.Random(9)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    inside = words(13) + ". " + words(13) + ". " + words(13) + ". " + words(12)
    passages = [words(200), *(words(51) for _ in range(10)), inside]
    texts, places = {}, {}
    for number, passage in enumerate(passages):
        for copy, (before, after) in enumerate([(3, 4), (5, 9), (40, 0)]):
            doc_id = 3 * number + copy
            texts[doc_id] = f"{words(before)} {passage} {words(after)}"
            places[doc_id] = texts[doc_id].index(passage), len(passage)
    rows = found(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"))
    for d, (_, spans) in rows.items():
        at, length = places[d]
        assert all(at <= a and b <= at + length and first == d // 3 * 3 for a, b, first in spans)
        covered = sum(len(texts[d][a:b].split()) for a, b, _ in spans)
        # All but 16 words at each end.
        assert covered >= len(passages[d // 3].split()) - 32 or d % 3 == 0
