"""License wording in texts: templates with optional and replaceable regions, compiled into automata over words.

A license is found where its whole mandatory wording stands, with its conditions and its disclaimer; a text that drops or changes a clause is not
taken for it. Notices, which only name a license, have templates and labels of their own.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.batches import text_slices

#: The phrases every scan counts, with their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: The whole wording of licenses, from grant to disclaimer. [[ ]] is optional, {{n}} stands for up to n words of any kind.
LICENSES = {
    "mit-text": """permission is hereby granted free of charge to any person obtaining a copy of {{12}} to deal in the {{3}} without restriction including
        without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the {{3}} and to permit persons to whom
        the {{3}} is furnished to do so subject to the following conditions the above copyright notice and this permission notice
        [[including the next paragraph]] shall be included in all copies or substantial portions of the {{3}} the {{3}} is provided as is without warranty of
        any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no
        event shall {{12}} be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in
        connection with the {{3}} or the use or other dealings in the {{3}}""",
    "isc-text": """permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby granted provided that the above
        copyright notice and this permission notice appear in all copies the software is provided as is and {{8}} disclaims all warranties with regard to this
        software including all implied warranties of merchantability and fitness in no event shall {{8}} be liable for any special direct indirect or
        consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other
        tortious action arising out of or in connection with the use or performance of this software""",
    "bsd-2-text": """redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
        {{1}} redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer {{1}} redistributions
        in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other
        materials provided with the distribution this software is provided by {{12}} as is and any express or implied warranties including but not limited to
        the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall {{12}} be liable for any direct
        indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use
        data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including
        negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage""",
    "bsd-3-text": """redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
        {{1}} redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer {{1}} redistributions
        in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other
        materials provided with the distribution {{1}} neither the name of {{12}} nor the names of [[its]] {{3}} contributors may be used to endorse or promote
        products derived from this software without specific prior written permission this software is provided by {{12}} as is and any express or implied
        warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event
        shall {{12}} be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of
        substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract
        strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of
        such damage""",
    "zlib-text": """this software is provided as is without any express or implied warranty in no event will the {{3}} be held liable for any damages arising from
        the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and
        redistribute it freely subject to the following restrictions {{1}} the origin of this software must not be misrepresented you must not claim that you
        wrote the original software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not
        required {{1}} altered source versions must be plainly marked as such and must not be misrepresented as being the original software {{1}} this notice
        may not be removed or altered from any source distribution""",
    "unlicense-text": """this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or
        distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means in
        jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software to the
        public domain we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors we intend this
        dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law the software is
        provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular
        purpose and noninfringement in no event shall the authors be liable for any claim damages or other liability whether in an action of contract tort or
        otherwise arising from out of or in connection with the software or the use or other dealings in the software [[for more information please refer to
        http [[s]] unlicense org]]""",
}

#: Notices that name a license without giving its text, marked alike.
NOTICES = {
    "apache-2-notice": "licensed under the apache license version 2 0 [[the license]] you may not use this file except in compliance with the license",
    "apache-2-name": "apache license [[version]] 2 0",
    "mit-name": "released under [[the terms of]] the mit license",
    "gpl-notice": "this {{3}} is free software you can redistribute it and or modify it under the terms of the gnu [[lesser]] [[affero]] general public license",
    "mpl-2-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-by-notice": "licensed under a creative commons attribution {{4}} [[international]] license",
    "cc-by-nc-name": "cc by nc [[sa]] [[nd]] 4 0",
    "spdx-notice": "spdx license identifier {{1}}",
}

TEMPLATES = {**LICENSES, **NOTICES}

#: Lower-cases A-Z, keeps digits, letters and bytes above 127, and turns all other bytes into spaces.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_MARKS = re.compile(r"\[\[|\]\]|\{\{(\d+)\}\}|[^\s\[\]{}]+")


@dataclass
class Automaton:
    """A template as a bit-parallel automaton: bit i stands for the i-th place in its wording.

    `edges` holds the places a word may stand at, `anything` those of replaceable regions, and `jumps` the ends of
    regions that may be left out, by place. The wording must begin with a mandatory word; those before the first
    region are the anchor by which candidates are found.
    """

    label: str
    base: bool
    anchor: bytes
    edges: dict[bytes, int]
    anything: int
    jumps: list[tuple[int, int]]
    accept: int

    def longest(self, words: list[bytes], start: int) -> int:
        """End of the longest match that begins at word `start`; 0 if there is none."""
        state, end = 1, 0
        for at in range(start, len(words)):
            state = (state & (self.edges.get(words[at], 0) | self.anything)) << 1
            if not state:
                break
            state = self._jumped(state)
            if state & self.accept:
                end = at + 1
        return end

    def _jumped(self, state: int) -> int:
        for place, to in self.jumps:
            if state >> place & 1:
                state |= 1 << to
        return state


def compile_template(label: str, text: str, base: bool = False) -> Automaton:
    """Compile one template. Optional regions may nest; a template may not begin with a region."""
    edges: dict[bytes, int] = {}
    anything, jumps, open_, place, anchor, fixed = 0, [], [], 0, [], True
    for m in _MARKS.finditer(text):
        token = m[0]
        if token == "[[":
            open_.append(place)
            fixed = False
        elif token == "]]":
            jumps.append((open_.pop(), place))
        elif m[1]:
            end = place + int(m[1])
            jumps += [(i, end) for i in range(place, end)]
            anything |= (1 << end) - (1 << place)
            place, fixed = end, False
        else:
            word = token.encode()
            edges[word] = edges.get(word, 0) | 1 << place
            place += 1
            if fixed:
                anchor.append(word)
    if not anchor or open_:
        raise ValueError(f"template {label} must begin with a mandatory word and close its regions")
    return Automaton(label, base, b" " + b" ".join(anchor) + b" ", edges, anything, sorted(jumps), 1 << place)


def compiled(templates: dict[str, str] = TEMPLATES, base: dict[str, str] = BASE) -> list[Automaton]:
    return [compile_template(label, phrase, True) for phrase, label in base.items()] + [compile_template(k, v) for k, v in templates.items()]


def scan_text(text: str, automata: list[Automaton]) -> tuple[int, list[tuple[str, bool, int, int]]]:
    """Number of words, and (label, base, first word, end) of the longest match at each place where one begins."""
    words = text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()
    line, found = b" " + b" ".join(words) + b" ", []
    for a in automata:
        at, word, counted = line.find(a.anchor), 0, 0
        while at >= 0:
            word += line.count(b" ", counted, at)
            counted = at
            end = a.longest(words, word)
            if end:
                found.append((a.label, a.base, word, end))
            at = line.find(a.anchor, at + 1)
    return len(words), sorted(found, key=lambda m: (m[2], m[3], m[0]))


def scan(docs: DataFrame, automata: list[Automaton] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, matches (label, base, start, end in words; sorted), covered (words inside matches).

    Words are runs of digits, letters a-z (A-Z lower-cased) and non-ASCII characters. A null text is empty. Templates of
    other labels may overlap. An empty table gives no rows.
    """
    automata = compiled() if automata is None else automata
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    match = T.StructType([T.StructField("label", T.StringType()), T.StructField("base", T.BooleanType()), T.StructField("start", T.LongType()),
                          T.StructField("end", T.LongType())])
    schema = T.StructType([slim.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("matches", T.ArrayType(match)),
                           T.StructField("covered", T.LongType())])
    kind = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            counts, matches, covered = [], [], []
            for text in (t for _, texts in text_slices(batch.column(1)) for t in texts):
                n, found = scan_text(text, automata)
                upto = inside = 0
                for _, _, start, end in found:
                    inside += max(0, end - max(start, upto))
                    upto = max(upto, end)
                counts.append(n)
                covered.append(inside)
                matches.append([{"label": m[0], "base": m[1], "start": m[2], "end": m[3]} for m in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(matches, kind), pa.array(covered, pa.int64())],
                                             names=schema.names)

    return slim.mapInArrow(run, schema)
