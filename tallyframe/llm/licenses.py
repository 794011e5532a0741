"""Licence notices in texts, recognised sentence by sentence. SQL functions only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and notices, by identifier.
SENTENCES = {
    1: "Released under the MIT License.",
    2: "Licensed under the MIT License.",
    3: "This project is licensed under the MIT License.",
    4: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    5: "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    6: "The Software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.",
    7: "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the Software or the use or other dealings in the Software.",
    10: "Licensed under the Apache License, Version 2.0.",
    11: "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    12: "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    13: "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    14: "See the License for the specific language governing permissions and limitations under the License.",
    20: "This work is licensed under the GNU General Public License, version 3.",
    21: "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    22: "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    23: "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    24: "See the GNU General Public License for more details.",
    25: "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    26: "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    27: "See the GNU Lesser General Public License for more details.",
    28: "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    29: "See the GNU Affero General Public License for more details.",
    30: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    31: "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    32: "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    33: "Neither the name of {holder} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    34: "The name of {holder} may not be used to endorse or promote products derived from this software without specific prior written permission.",
    35: "This software is provided by {holder} \"as is\" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed.",
    36: "In no event shall {holder} be liable for any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage.",
    37: "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    40: "Licensed under CC BY-NC 4.0.",
    41: "Licensed under CC BY 4.0.",
    42: "Licensed under CC BY-SA 4.0.",
    43: "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    44: "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    45: "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    50: "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    51: "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    52: "The software is provided \"as is\" and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness.",
    53: "This software is provided 'as-is', without any express or implied warranty.",
    54: "In no event will the authors be held liable for any damages arising from the use of this software.",
    55: "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    56: "This is free and unencumbered software released into the public domain.",
    57: "Distributed under the Boost Software License, Version 1.0.",
    58: "To the extent possible under law, {holder} has waived all copyright and related or neighboring rights to this work.",
    70: "All rights reserved.",
}

# Names of licences in SPDX lines, by identifier of the line.
SPDX = {
    60: "MIT", 61: "Apache-2.0", 62: "GPL-3.0-or-later", 63: "BSD-3-Clause", 64: "BSD-2-Clause", 65: "ISC",
    66: "MPL-2.0", 67: "GPL-2.0-only", 68: "GPL-2.0-or-later", 69: "GPL-3.0-only", 71: "LGPL-2.1-only",
    72: "LGPL-2.1-or-later", 73: "LGPL-3.0-or-later", 74: "AGPL-3.0-or-later", 75: "AGPL-3.0-only",
    76: "Unlicense", 77: "Zlib", 78: "BSL-1.0", 79: "CC0-1.0", 80: "EPL-2.0", 81: "0BSD", 82: "BSD-4-Clause",
    83: "CC-BY-4.0", 84: "CC-BY-SA-4.0", 85: "Apache-2.0 OR MIT", 86: "MIT OR Apache-2.0",
}
SENTENCES |= {number: f"SPDX-License-Identifier: {name}" for number, name in SPDX.items()}

# Licences by the identifiers of their sentences, in the order in which
# the rules are tried.
NOTICES = (
    ("MIT", (4, 5, 6, 7)),
    ("MIT", (4, 5)),
    ("Apache-2.0", (11, 12, 13, 14)),
    ("Apache-2.0", (11, 13)),
    ("GPL-3.0-or-later", (21, 23, 24)),
    ("GPL-2.0-or-later", (22, 23, 24)),
    ("LGPL-2.1-or-later", (25, 26, 27)),
    ("AGPL-3.0-or-later", (28, 23, 29)),
    ("BSD-4-Clause", (30, 31, 32, 37, 33)),
    ("BSD-4-Clause", (30, 31, 32, 37, 34)),
    ("BSD-3-Clause", (30, 31, 32, 33)),
    ("BSD-3-Clause", (30, 31, 32, 34)),
    ("BSD-2-Clause", (30, 31, 32)),
    ("ISC", (51, 52)),
    ("Zlib", (53, 54, 55)),
)
# Where a notice follows at once, the reserved rights of its copyright line are no licence.
RULES = (
    *((name, (70, *run)) for name, run in NOTICES),
    *NOTICES,
    ("MIT", (1,)),
    ("MIT", (2,)),
    ("MIT", (3,)),
    ("Apache-2.0", (10,)),
    ("Apache-2.0", (11,)),
    ("GPL-3.0", (20,)),
    ("GPL-3.0-or-later", (21,)),
    ("GPL-2.0-or-later", (22,)),
    ("CC-BY-NC-4.0", (40,)),
    ("CC-BY-4.0", (41,)),
    ("CC-BY-SA-4.0", (42,)),
    ("CC-BY-4.0", (43,)),
    ("CC-BY-SA-4.0", (44,)),
    ("CC-BY-NC-4.0", (45,)),
    ("MPL-2.0", (50,)),
    ("ISC", (51,)),
    ("LGPL-2.1-or-later", (25,)),
    ("AGPL-3.0-or-later", (28,)),
    ("Zlib", (55,)),
    ("Unlicense", (56,)),
    ("BSL-1.0", (57,)),
    ("CC0-1.0", (58,)),
    *((name, (number,)) for number, name in SPDX.items()),
    ("proprietary", (70,)),
)

#: Stands in a sentence for the name of a holder, of so many words at most.
SLOT, SLOT_WORDS = "{holder}", 12

#: Every known sentence holds one of these; most texts hold none.
ANCHORS = "(?i)licen|copyright|software|redistribut|rights|warrant"
#: A sentence ends with a single mark before white space, or with its line. So marks
#: strewn between words do not cut it.
BREAK = r"([^.!?][.!?])[ \t\r\n]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(sentence: str) -> str:
    """A sentence as it is compared: its ASCII letters and digits, in lower case."""
    return re.sub("[^a-z0-9]+", " ", sentence.translate(str.maketrans(CAPITALS, SMALL))).strip()


def parts(sentence: str) -> list[str]:
    """A sentence as it is compared, before and after its slot."""
    return [normalised(part) for part in sentence.split(SLOT)]


#: Known sentences without their slots, and the patterns of those that have one.
KNOWN = {" ".join(parts(sentence)): number for number, sentence in SENTENCES.items()}
SLOTTED = [parts(sentence) for sentence in SENTENCES.values() if SLOT in sentence]


def _alternatives(gap: str, wide: str) -> str:
    """All known sentences as one pattern, the longest first, wrapped at any gap.

    A name in a slot may hold an abbreviation, which ends a sentence: a ``wide`` gap.
    """
    word = "[a-z0-9]+"
    slot = f"{gap}{word}(?:{wide}{word}){{0,{SLOT_WORDS - 1}}}{wide}"
    ordered = sorted(SENTENCES.values(), key=lambda s: (-len(s), s))
    return "|".join(slot.join(part.replace(" ", gap) for part in parts(s)) for s in ordered)


#: A known sentence between ends of sentences or lines, wrapped anywhere.
PATTERN = r"(?<![^|\n])(?:" + _alternatives(r"[ \n]", r"[ \n|]") + r")(?![^|\n])"


def _marked(text: Column) -> Column:
    """A text in lower case without signs, with | after sentences and \\n after lines."""
    small = F.translate(text, CAPITALS + "|", SMALL + "-")
    plain = F.regexp_replace(F.regexp_replace(small, BREAK, "$1|"), r"[^a-z0-9\n|]+", " ")
    return F.regexp_replace(F.regexp_replace(plain, r"[ \n]*\|[ \n|]*", "|"), r" ?\n[ \n]*", "\n")


def _unslotted(sentence: Column) -> Column:
    for before, after in SLOTTED:
        sentence = F.regexp_replace(sentence, f"^({before}) .+[ |]({after})$", "$1 $2")
    return sentence


def licence_scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, sentence_ids, licences`` per row of ``docs``.

    Texts are brought to lower case without signs but for the ends of sentences and
    lines, and the known sentences between such ends become identifiers, also if they are
    wrapped over several lines. Where a sentence names the holder, any name of up to
    SLOT_WORDS words may stand. ``sentence_ids`` lists them in the order of the text.
    The rules are tried in their order on this list: each takes every place where its
    identifiers follow each other, and a place that is taken is not matched again.
    ``licences`` lists the names of the rules in the order of the text. Sentences that
    are not known do not separate. Null and other texts without known sentences have
    empty lists. Only text with one of the ANCHORS is cut up, as all known sentences
    hold one.
    """
    numbers = F.create_map(*(F.lit(x) for pair in KNOWN.items() for x in pair))
    known = F.regexp_extract_all(F.trim(_marked(docs[text])), F.lit(PATTERN), F.lit(0))
    ids = F.transform(known, lambda s: F.element_at(numbers, _unslotted(F.translate(s, "\n", " "))))
    none = F.array().cast("array<int>")
    rows = docs.select(
        docs[id].cast("bigint").alias("doc_id"),
        F.when(docs[text].rlike(ANCHORS), ids).otherwise(none).alias("sentence_ids"),
    )
    # A chain of marks, one per sentence; a matched run becomes the name of its rule.
    chain = F.array_join(F.transform("sentence_ids", lambda n: F.format_string("<%d>", n)), "")
    for name, run in RULES:
        chain = F.replace(chain, F.lit("".join(f"<{n}>" for n in run)), F.lit("{" + name + "}"))
    names = F.regexp_extract_all(chain, F.lit(r"\{([^}]+)\}"), F.lit(1))
    return rows.select("doc_id", "sentence_ids", names.alias("licences"))


def licence_sql() -> str:
    """The same in SQL: ``doc_id, sentence_ids, licences``, the lists joined by commas."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    known = "[" + ", ".join(quoted(s) for s in KNOWN) + "]"
    numbers = "[" + ", ".join(str(n) for n in KNOWN.values()) + "]"
    chain = "array_to_string([concat('<', n, '>') FOR n IN ids], '')"
    for name, run in RULES:
        chain = f"replace({chain}, '{''.join(f'<{n}>' for n in run)}', '{{{name}}}')"
    # Ends are doubled, as a match takes the one on either side of it.
    pattern = rf"(?:^|[|\n])(" + _alternatives(r"(?: |\n\n)", r"(?: |\n\n|\|\|)") + r")(?:$|[|\n])"
    plain = "replace(s, chr(10) || chr(10), ' ')"
    for before, after in SLOTTED:
        plain = rf"regexp_replace({plain}, '^({before}) .+[ |]({after})$', '\1 \2')"
    return rf"""
        WITH small AS (
            SELECT doc_id, translate(coalesce(text, ''), '{CAPITALS}|', '{SMALL}-') AS s FROM documents
        ), plain AS (
            SELECT doc_id, regexp_replace(regexp_replace(s, '{BREAK}', '\1|', 'g'), '[^a-z0-9\n|]+', ' ', 'g') AS s FROM small
        ), marked AS (
            SELECT doc_id, trim(regexp_replace(regexp_replace(s, '[ \n]*\|[ \n|]*', '|', 'g'), ' ?\n[ \n]*', chr(10), 'g')) AS s
            FROM plain
        ), said AS (
            SELECT doc_id, regexp_extract_all(
                replace(replace(s, '|', '||'), chr(10), chr(10) || chr(10)), '{pattern}', 1) AS said
            FROM marked
        ), found AS (
            SELECT doc_id, [{numbers}[list_position({known}, {plain})] FOR s IN said] AS ids FROM said
        )
        SELECT doc_id, array_to_string(ids, ',') AS sentence_ids,
               array_to_string(regexp_extract_all({chain}, '\{{([^}}]+)\}}', 1), ',') AS licences
        FROM found
    """
