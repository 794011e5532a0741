"""Personal data in texts: rules, and a character tagger that adds to them."""

from __future__ import annotations

import random
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.bilstm_crf import Tagger, fit
from tallyframe.llm.common import slices, with_text

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, number of the kind, end

#: Documents that the tagger is trained on, at most, and their greatest length.
TRAINING_DOCS, TRAINING_BYTES = 600, 32_768
#: Characters of a window, and from one window to the next.
WINDOW, STRIDE = 96, 48
#: Windows that a task decodes together.
DECODED = 512
UPDATES, BATCH, SEED = 260, 96, 11

# --- rules -------------------------------------------------------------------

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NO_DIGIT = re.compile("[^0-9]+")
#: No personal data of these kinds is without one of these.
TRIGGER = re.compile("[0-9@]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def rule_spans(text: str) -> list[Span]:
    """What the rules find, by start and then kind, in time linear in the text.

    Matches of a kind do not overlap and are the leftmost ones. An address runs back
    from its @ as far as its characters allow, and numbers joined by dots are taken four
    at a time, which is what a search from the left gives. Of numbers, those with a
    part over 255, a wrong number of digits or a wrong check digit are dropped.
    """
    found: list[Span] = []
    if not TRIGGER.search(text):
        return found
    end, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        start = at
        while domain and start > end and text[start - 1] in LOCAL:
            start -= 1
        if domain and start < at:
            end = domain.end()
            found.append((start, 0, end))
        at = text.find("@", max(at + 1, end))
    for match in NUMBERS.finditer(text):
        if match[0].count(".") < 3:
            continue
        parts, start = match[0].split("."), match.start()
        for i in range(0, len(parts) - 3, 4):
            size = sum(map(len, parts[i : i + 4])) + 3
            if all(map(_octet, parts[i : i + 4])):
                found.append((start, 1, start + size))
            start += size + 1
    for match in CARD.finditer(text):
        digits = NO_DIGIT.sub("", match[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((match.start(), 2, match.end()))
    if "+" in text:
        for match in PHONE.finditer(text):
            if 9 <= len(NO_DIGIT.sub("", match[0])) <= 15:
                found.append((match.start(), 3, match.end()))
    return sorted(found)


def written(spans: Iterable[Span]) -> str:
    """``kind:start:end``, joined by commas."""
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


# --- the tagger --------------------------------------------------------------

#: Characters as the tagger sees them: nothing, a digit, white space, a letter beyond
#: ASCII, any other character, then letters without case and the signs of ASCII.
PAD, DIGIT, BLANK, LETTER, OTHER = range(5)
_OWN = {c: 5 + i for i, c in enumerate("abcdefghijklmnopqrstuvwxyz!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")}
CHARACTERS = 5 + len(_OWN)
_ASCII = np.array(
    [
        DIGIT if chr(i).isdigit() else BLANK if chr(i).isspace() else _OWN.get(chr(i).lower(), OTHER)
        for i in range(128)
    ]
)
TAGS = 1 + 2 * len(KINDS)  # outside; then begin and inside of each kind
ALLOWED = np.array(
    [[b == 0 or b % 2 == 1 or a in (b, b - 1) for b in range(TAGS)] for a in range(TAGS)]
)


def _numbers(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(points < 128, _ASCII[np.minimum(points, 127)], np.where(points < 0x2000, LETTER, OTHER))


def _digits(rng: random.Random, form: str) -> str:
    return "".join(str(rng.randrange(10)) if c == "d" else c for c in form)


_PHONES = ("(ddd) ddd-dddd", "ddd-ddd-dddd", "ddd.ddd.dddd", "+dd ddd ddd dddd", "+d (ddd) ddd-dddd", "+dd-ddd-ddddddd", "00dd ddd ddd dddd", "(ddd)ddd-dddd")
_CARDS = ("dddddddddddddddd", "dddd dddd dddd dddd", "dddd-dddd-dddd-dddd", "dddd.dddd.dddd.dddd", "dddd dddddd ddddd", "dddddddddddddd")
_OTHERS = ("dddd-dd-dd", "dd/dd/dddd", "dd:dd", "dd:dd:dd", "$d,ddd.dd", "d.d", "v d.d.d", "#ddddd", "dd-dd", "dddd", "d", "dd %", "ddd,ddd", "dddddddddddddddddddddddd", "ddd-dd", "dd.dd.dddd", "@", "d@d", "dd kg", "a.d.d")


def _example(kind: int, rng: random.Random) -> str:
    """A made-up span of a kind, or with -1 a number that is none."""
    if kind == 0:
        word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))
        name = word() + rng.choice(["", "." + word(), _digits(rng, "dd"), "_" + word()])
        return name + rng.choice(["@", "@", "@", " @ "]) + word() + rng.choice(["", _digits(rng, "d"), "." + word()]) + rng.choice([".com", ".org", ".example.com", ".de"])
    if kind == 1:
        return ".".join(str(rng.randrange(256)) for _ in range(4))
    forms = _OTHERS if kind < 0 else _CARDS if kind == 2 else _PHONES
    if kind < 0 and rng.random() < 0.2:
        return "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice((8, 32, 40))))
    return _digits(rng, rng.choice(forms))


def _card_like(text: str) -> list[Span]:
    """Numbers of a card's length; whether the check digit holds is not to be learned."""
    return [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(NO_DIGIT.sub("", m[0])) <= 19]


def train_tagger(texts: list[str], updates: int = UPDATES, seed: int = SEED) -> Tagger:
    """A tagger from the spans that the rules label in real texts, and from made-up ones.

    Half the windows show the spans of the rules in their place. The other half are
    windows of the same texts with a made-up span put in, in more ways of writing than
    the rules know, or with a number that is no personal data.
    """
    rng = random.Random(seed)
    windows: list[tuple[str, list[Span]]] = []
    for text in texts:
        spans = [s for s in rule_spans(text) if s[1] != 2] + _card_like(text)
        for match in list(TRIGGER.finditer(text))[:: max(1, len(TRIGGER.findall(text)) // 3)][:4]:
            start = max(0, match.start() - rng.randrange(WINDOW))
            inside = [(a - start, k, b - start) for a, k, b in spans if start <= a and b <= start + WINDOW]
            cut = [s for s in spans if s[0] < start + WINDOW and s[2] > start]
            if len(cut) == len(inside):  # none is cut at a border
                windows.append((text[start : start + WINDOW], inside))
    filler = [text for text in texts if len(text) > 2] or ["the and of to in a"]
    for _ in range(max(len(windows), 400)):
        text = rng.choice(filler)
        at = rng.randrange(len(text))
        around = TRIGGER.sub("", text[max(0, at - WINDOW) : at + WINDOW])
        cut = around.rfind(" ", 0, rng.randrange(WINDOW)) + 1
        kind = rng.choice((0, 1, 2, 3, 3, -1, -1, -1))
        put = _example(kind, rng)
        end = rng.choice((" ", " ", ". ", ", ", "\n", ""))
        window = (around[:cut] + put + end + around[cut:])[:WINDOW]
        spans = [(cut, kind, cut + len(put))] if kind >= 0 else []
        if cut + len(put) <= WINDOW:
            windows.append((window, spans))
    chars = np.zeros((WINDOW, len(windows)), np.int64)
    tags = np.zeros_like(chars)
    for i, (text, spans) in enumerate(windows):
        chars[: len(text), i] = _numbers(text)
        for start, kind, end in spans:
            tags[start:end, i] = 2 + 2 * kind
            tags[start, i] = 1 + 2 * kind
    tagger = Tagger.new(CHARACTERS, TAGS, ALLOWED, inputs=16, states=24, seed=seed)
    fit(tagger, chars, tags, updates, BATCH, seed)
    return tagger


def tagged_spans(tagger: Tagger, texts: list[str]) -> list[list[Span]]:
    """What the tagger reads in each text, from windows that overlap by half.

    Windows cover the whole text; those without a digit or @ hold no span of any kind
    and are not decoded. A span that touches the border of its window, and not of the
    text, may go on, and is left to the next window. Spans of different windows that
    overlap are reconciled over the whole text: the one with more context on its
    nearer side stays, then the longer one, then the first.
    """
    places = []
    for number, text in enumerate(texts):
        last = -1
        for match in TRIGGER.finditer(text):
            # The windows that hold this character, each once.
            first = max(0, match.start() // STRIDE - 1, last + 1)
            places += [(number, w * STRIDE) for w in range(first, match.start() // STRIDE + 1)]
            last = max(last, match.start() // STRIDE)
    candidates: list[list[tuple[int, int, int, int, int]]] = [[] for _ in texts]
    for at in range(0, len(places), DECODED):
        part = places[at : at + DECODED]
        chars = np.zeros((WINDOW, len(part)), np.int64)
        for i, (number, start) in enumerate(part):
            cut = texts[number][start : start + WINDOW]
            chars[: len(cut), i] = _numbers(cut)
        tags = tagger.decode(chars)
        for i in np.flatnonzero(tags.any(0)).tolist():
            number, start = part[i]
            size = min(WINDOW, len(texts[number]) - start)
            for a, kind, b in _runs(tags[:size, i]):
                before = WINDOW if start == 0 else a
                after = WINDOW if start + size == len(texts[number]) else size - b
                if before and after:
                    candidates[number].append((-min(before, after), a - b, start + a, kind, start + b))
    found = []
    for spans in candidates:
        kept: list[Span] = []
        for _, _, a, kind, b in sorted(set(spans)):
            if all(b <= s or e <= a for s, _, e in kept):
                kept.append((a, kind, b))
        found.append(sorted(kept))
    return found


def _runs(tags: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Spans ``start, kind, end`` from tags."""
    start = None
    for place, tag in enumerate([*tags.tolist(), 0]):
        if start is not None and (tag == 0 or tag % 2 == 1):
            yield start, kind, place
            start = None
        if tag % 2 == 1:
            start, kind = place, tag // 2


def _credible(text: str, kind: int) -> bool:
    """Rules that also hold for what only the tagger finds."""
    digits = NO_DIGIT.sub("", text)
    if text != text.strip() or "\n" in text:
        return False
    if kind == 0:
        name, _, domain = text.partition("@")
        return bool(name.strip()) and bool(DOMAIN.fullmatch(domain.strip()))
    if kind == 1:
        parts = text.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and _octet(p) for p in parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15 and len(digits) >= 0.6 * len(text)


def find_spans(tagger: Tagger, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """Of each text the spans of the rules, and all spans; the rules' always stay.

    A span of the tagger is added if it overlaps none of the rules' and is credible.
    """
    result = []
    rules = [rule_spans(t) for t in texts]
    for text, base, tagged in zip(texts, rules, tagged_spans(tagger, texts), strict=True):
        more = [
            s for s in tagged
            if all(s[2] <= a or b <= s[0] for a, _, b in base) and _credible(text[s[0] : s[2]], s[1])
        ]
        result.append((base, sorted(base + more)))
    return result


# --- Spark -------------------------------------------------------------------


def train_on(docs: DataFrame, id: str, text: str) -> Tagger:
    """A tagger from a bounded sample: the documents with a digit or @ whose ids have
    the least hashes, and that are not too long. Rows without an id are not taken."""
    rows = with_text(docs, id, text).where("doc_id IS NOT NULL")
    able = rows.where(F.col("text").rlike("[0-9@]") & (F.octet_length("text") <= TRAINING_BYTES))
    ids = able.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAINING_DOCS).collect()
    wanted = docs.sparkSession.createDataFrame([(r[0],) for r in ids], "doc_id bigint")
    # dropDuplicates: one row per id, so that the sample stays bounded.
    found = able.join(F.broadcast(wanted), "doc_id", "left_semi").dropDuplicates(["doc_id"]).collect()
    return train_tagger([row["text"] for row in sorted(found, key=lambda row: row["doc_id"])])


def personal_data(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, rules, spans`` per row of ``docs``, each an array of kind, start, end.

    ``rules`` are the spans of the rules, ``spans`` all, in code points, end exclusive,
    by start and then by kind. Null texts are empty. The tagger is trained when this is
    called; finding needs no shuffle.
    """
    tagger = train_on(docs, id, text)
    place = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = find_spans(tagger, batch.column("text").to_pylist())
            columns = [
                pa.array(
                    [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in both[n]] for both in found],
                    pa.list_(place),
                )
                for n in (0, 1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "rules", "spans"])

    spans = "array<struct<kind: string, start: bigint, end: bigint>>"
    return with_text(docs, id, text).mapInArrow(find, f"doc_id bigint, rules {spans}, spans {spans}")


def redact(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with each span replaced by its kind, as ``[email]``; all rows stay.

    Spans that overlap are replaced together, by the kind of the first. Null stays null.
    """
    tagger = train_on(docs, id, text)

    def replace(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            column = batch.schema.get_field_index(text)
            texts = batch.column(column).to_pylist()
            found = find_spans(tagger, [t or "" for t in texts])
            for i, (_, spans) in enumerate(found):
                if spans:
                    texts[i] = redacted(texts[i], spans)
            yield batch.set_column(column, text, pa.array(texts, batch.schema.field(column).type))

    return docs.mapInArrow(replace, docs.schema)


def redacted(text: str, spans: list[Span]) -> str:
    parts, end = [], 0
    for start, kind, stop in spans:
        if start >= end:
            parts += [text[end:start], f"[{KINDS[kind]}]"]
        end = max(end, stop)
    return "".join(parts) + text[end:]
