"""Licence scan by sentence rules.

Two steps: every sentence of a text is normalised and looked up among known licence sentences, giving a sequence of
sentence identifiers; then ordered rules (identifiers that must follow each other, with at most ``GAP`` other sentences
between) name the licences. Known sentences that no rule used are reported as leftovers: a part of a licence, not
the licence. Texts are scanned where they lie, in one pass with no shuffle.
"""

from __future__ import annotations

import re
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Known licence sentences, normalised (lower-case words and numbers, one space between), by identifier.
SENTENCES = {
    "apache-short": ["licensed under the apache license version 2 0", "released under the apache license version 2 0",
                     "this work is licensed under the apache license version 2 0", "license apache 2 0"],
    "apache-1": ["licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"],
    "apache-2": ["you may obtain a copy of the license at http www apache org licenses license 2 0",
                 "you may obtain a copy of the license at https www apache org licenses license 2 0"],
    "apache-3": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
                 "without warranties or conditions of any kind either express or implied"],
    "apache-4": ["see the license for the specific language governing permissions and limitations under the license"],
    "mit-short": ["released under the mit license", "licensed under the mit license", "this work is licensed under the mit license",
                  "the mit license", "mit license", "the mit license mit"],
    "mit-1": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to "
              "deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
              "and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mit-2": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "mit-3": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of "
              "merchantability fitness for a particular purpose and noninfringement"],
    "bsd-short": ["licensed under the bsd license", "released under the bsd license", "licensed under the bsd 3 clause license"],
    "bsd-1": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-2": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-3": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the "
              "documentation and or other materials provided with the distribution"],
    "bsd-4": ["neither the name of 0holder nor the names of 0holder may be used to endorse or promote products derived from this "
              "software without specific prior written permission",
              "the name of 0holder may not be used to endorse or promote products derived from this software without specific prior written permission"],
    "bsd-notice": ["all advertising materials mentioning features or use of this software must display the following acknowledgement"],
    "gpl2-short": ["this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2"],
    "gpl3-short": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3",
                   "released under the gnu general public license version 3"],
    "gpl-1": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free "
              "software foundation either version 3 of the license or at your option any later version"],
    "gpl-1-v2": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
                 "free software foundation either version 2 of the license or at your option any later version"],
    "gpl-2": ["this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or "
              "fitness for a particular purpose"],
    "gpl-3": ["see the gnu general public license for more details"],
    "lgpl21-1": ["this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
                 "the free software foundation either version 2 1 of the license or at your option any later version"],
    "lgpl-2": ["this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or "
               "fitness for a particular purpose"],
    "lgpl-3": ["see the gnu lesser general public license for more details"],
    "mpl-1": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "mpl-2": ["if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
              "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0"],
    "isc-1": [f"permission to use copy modify {join} distribute this software for any purpose with or without fee is hereby granted provided that the above "
              "copyright notice and this permission notice appear in all copies" for join in ("and or", "and")],
    "unlicense-1": ["this is free and unencumbered software released into the public domain"],
    "reserved": ["all rights reserved"],
}

#: How a statement of a licence begins, and the names it may give to each licence.
STATED = ["licensed under", "released under", "distributed under", "available under", "published under", "provided under", "licenced under", "covered by"]
NAMES = {
    "Apache-2.0": ["apache license version 2 0", "apache license 2 0", "apache license v2 0", "apache license version 2", "apache 2 0 license", "apache 2 0"],
    "MIT": ["mit license", "mit licence", "expat license"],
    "BSD-2-Clause": ["bsd 2 clause license", "2 clause bsd license", "simplified bsd license"],
    "BSD-3-Clause": ["bsd license", "bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license"],
    "ISC": ["isc license"],
    "GPL-2.0": ["gnu general public license version 2", "gnu general public license v2", "gnu gpl version 2", "gnu gpl v2", "gpl version 2", "gplv2"],
    "GPL-3.0": ["gnu general public license version 3", "gnu general public license v3", "gnu gpl version 3", "gnu gpl v3", "gpl version 3", "gplv3"],
    "LGPL-2.1": ["gnu lesser general public license version 2 1", "gnu lgpl version 2 1", "lgpl version 2 1"],
    "LGPL-3.0": ["gnu lesser general public license version 3", "gnu lgpl version 3", "lgpl version 3", "lgplv3"],
    "AGPL-3.0": ["gnu affero general public license version 3", "gnu agpl version 3", "agpl version 3", "agplv3"],
    "MPL-2.0": ["mozilla public license version 2 0", "mozilla public license v 2 0", "mozilla public license 2 0", "mpl 2 0"],
    "Unlicense": ["unlicense"],
    "CC0-1.0": ["cc0 1 0", "cc0 1 0 universal license", "creative commons zero 1 0"],
}
#: Parts of the Creative Commons licences that follow attribution, as in their short and full names.
CC_PARTS = {"": "", "sa": "sharealike", "nc": "noncommercial", "nd": "noderivatives", "nc sa": "noncommercial sharealike", "nc nd": "noncommercial noderivatives"}
for _short, _full in CC_PARTS.items():
    for _version in ("3 0", "4 0"):
        _tag = "-".join(["CC", "BY", *_short.upper().split(), _version.replace(" ", ".")])
        _long = f"creative commons attribution {_full} {_version}".replace("  ", " ")
        NAMES[_tag] = [f"cc by {_short} {_version}".replace("  ", " "), f"{_long} international license", f"{_long} license", f"{_long} unported license"]

#: Ordered rules as (licence, sentence identifiers in order), a longer rule before a shorter one.
RULES = [
    ("Apache-2.0", ["apache-1", "apache-2", "apache-3", "apache-4"]), ("Apache-2.0", ["apache-short"]),
    ("MIT", ["mit-1", "mit-2", "mit-3"]), ("MIT", ["mit-short"]), ("BSD-4-Clause", ["bsd-1", "bsd-2", "bsd-3", "bsd-notice", "bsd-4"]),
    ("BSD-3-Clause", ["bsd-1", "bsd-2", "bsd-3", "bsd-4"]), ("BSD-2-Clause", ["bsd-1", "bsd-2", "bsd-3"]), ("BSD-3-Clause", ["bsd-short"]),
    ("GPL-3.0", ["gpl-1", "gpl-2", "gpl-3"]), ("GPL-2.0", ["gpl-1-v2", "gpl-2", "gpl-3"]), ("GPL-2.0", ["gpl2-short"]), ("GPL-3.0", ["gpl3-short"]),
    ("LGPL-2.1", ["lgpl21-1", "lgpl-2", "lgpl-3"]), ("MPL-2.0", ["mpl-1", "mpl-2"]), ("ISC", ["isc-1"]), ("Unlicense", ["unlicense-1"]),
    ("All-Rights-Reserved", ["reserved"]),
]
#: Other sentences allowed between two sentences of a rule; a known sentence of fewer words than SHORT_WORDS may not run over
#: the end of a sentence or an empty line (a heading "MIT", then a heading "License").
GAP = 2
SHORT_WORDS = 8
#: A word of a known sentence that stands for one to SLOT_WORDS words of any kind (the holder's name).
SLOT, SLOT_WORDS = "0holder", 10

_KNOWN = {f"{how}{terms}{article} {name}": f"stated:{licence}" for licence, names in NAMES.items() for name in names for how in STATED
          for terms in ("", " the terms of") for article in ("", " the", " a", " an")}
_ANYWHERE = set(_KNOWN)  # also inside a sentence, as long ones; other short ones are a whole sentence
_KNOWN.update({sentence: name for name, many in SENTENCES.items() for sentence in many})
_ANYWHERE |= {x for x in _KNOWN if len(x.split()) >= SHORT_WORDS} | set(SENTENCES["reserved"])
_TRIE: dict = {}
for _sentence in _KNOWN:
    _node = _TRIE
    for _word in _sentence.split():
        _node = _node.setdefault(_word, {})
    _node[None] = _sentence
#: Every word of a known sentence; texts keep these and "" for all others.
_VOCABULARY = {w: w for sentence in _KNOWN for w in [*sentence.split(), "not", "never"]}
_SPDX = re.compile(r"SPDX-License-Identifier\s*:[ \t]*([^\r\n]*)", re.I)
_TOKEN = re.compile(r"\s*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
_CANON = {x.lower(): x for x in [*NAMES, "BSD-4-Clause", "Zlib", "BSL-1.0", "EPL-2.0", "0BSD"]}
_WORDS = re.compile(r"[a-z0-9]+")
#: Texts are cut after . ! ? : or ; before white space, at line ends, and after the Apache address in running text. Known
#: sentences hold such cuts themselves ('(the "License"); you may', 'v. 2.0'), so they are looked up across pieces.
_CUT = re.compile(r"(?<=[.!?:;])\s+|\n\s*|(?<=-2\.0)\s+(?=[Uu]nless\s)")
#: Every known sentence has one of these words, so a text without them has none.
_QUICK = re.compile(r"licen[sc]|spdx|released|distributed|available|published|provided|covered|reserved|permission|permitted|copyright|redistribution|software|warrant|\bmpl\b|\bcc0\b", re.I)


def normalise(sentence: str) -> str:
    """Lower-case runs of ASCII letters and digits, with one space between."""
    return " ".join(_WORDS.findall(sentence.lower()))


def _pieces(text: str) -> list[tuple[str, bool]]:
    """The normalised pieces that have words, each with whether a sentence ended or an empty line stood before it."""
    out, start, ended = [], 0, True
    for cut in _CUT.finditer(text):
        piece = normalise(text[start:cut.start()])
        if piece:
            out.append((piece, ended))
            ended = False
        ended = ended or text[cut.start() - 1:cut.start()] in (".", "!", "?", ";") or cut.group().count("\n") > 1
        start = cut.end()
    piece = normalise(text[start:])
    return [*out, (piece, ended)] if piece else out


def spdx_licences(expression: str) -> list[str]:
    """Licences of an SPDX expression, in order; what follows its end is left. Exceptions after WITH are no licences, and
    "-only", "-or-later" and "+" are taken off."""
    out, at, expect = [], 0, True
    while (m := _TOKEN.match(expression, at)) is not None:
        token = m.group(1)
        if token in "()":
            pass
        elif token.upper() in ("AND", "OR", "WITH"):
            if expect:
                break
            expect = token.upper()
        elif not expect:
            break
        else:
            if expect != "WITH":
                name = re.sub(r"(-only|-or-later|\+)$", "", token, flags=re.I).rstrip(".:-")
                out.append(_CANON.get(name.lower(), name))
            expect = False
        at = m.end()
    return out


def _longest(words: list[str], i: int, ended: bytearray, starts: bytearray, ends: bytearray) -> tuple[int, str] | None:
    """(end, identifier) of the longest known sentence from word ``i``. Short ones may not run over the end of a sentence, and
    must be a whole piece unless they may stand anywhere; none counts after "not"."""
    best, todo = None, [(_TRIE, i)]
    while todo:
        node, at = todo.pop()
        sentence = node.get(None)
        if sentence and (best is None or at > best[0]):
            short = at - i < SHORT_WORDS and any(ended[i + 1:at])
            if not short and (sentence in _ANYWHERE or starts[i] and ends[at - 1]):
                best = (at, _KNOWN[sentence])
        if at < len(words):
            if words[at] in node:
                todo.append((node[words[at]], at + 1))
            if SLOT in node:
                todo += [(node[SLOT], at + k) for k in range(1, min(SLOT_WORDS, len(words) - at) + 1)]
    return None if best is None or i and words[i - 1] in ("not", "never") else best


def sentence_ids(text: str) -> list[tuple[int, str]]:
    """(number of the sentence, identifier) of the known sentences, in order.

    They are looked up from every word, however the text is wrapped and with the cuts of their own wording; of those from one word the longest
    counts. A licence in an SPDX line is "stated:" and its name. Each one found counts as a sentence, and so does each piece outside of them.
    """
    if not _QUICK.search(text):
        return []
    spdx: list[list[str]] = []

    def marked(m: re.Match) -> str:
        spdx.append(spdx_licences(m.group(1)))
        return f"\n\n0spdx{len(spdx) - 1}\n\n"

    pieces = _pieces(_SPDX.sub(marked, text))
    marks = {f"0spdx{k}": names for k, names in enumerate(spdx)}
    kept = _VOCABULARY | {m: m for m in marks}
    words: list[str] = []
    piece, ended, starts, ends = array("l"), bytearray(), bytearray(), bytearray()
    for k, (normal, after_end) in enumerate(pieces):
        own = [kept.get(w, "") for w in normal.split()]
        words += own
        piece.extend([k] * len(own))
        for flags, first, last in ((ended, after_end, 0), (starts, 1, 0), (ends, 0, 1)):
            flags += bytes(len(own))
            flags[-len(own)] |= first
            flags[-1] |= last
    found, done = [], 0  # (first word, end, identifiers)
    for i in [i for i, w in enumerate(words) if w in _TRIE or w in marks]:
        if i < done:
            continue
        if words[i] in marks:
            found.append((i, i + 1, [f"stated:{x}" for x in marks[words[i]]]))
        elif (m := _longest(words, i, ended, starts, ends)) is not None:
            found.append((i, m[0], [m[1]]))
        else:
            continue
        done = found[-1][1]
    out, at, reached = [], 0, 0  # pieces before ``reached`` are counted
    for first, end, names in found:
        at += max(0, piece[first] - reached)
        for name in names:
            out.append((at, name))
            at += 1
        reached = piece[end - 1] + 1
    return out


def match_rules(found: list[tuple[int, str]]) -> tuple[list[str], list[str]]:
    """(licences in order of place, identifiers no rule used). At each place the longest rule wins; a sentence is used once.
    A licence stated by name needs no rule."""
    used, licences = set(), []
    for start in range(len(found)):
        if found[start][1].startswith("stated:"):
            used.add(start)
            licences.append(found[start][1].removeprefix("stated:"))
            continue
        for licence, rule in sorted(RULES, key=lambda r: -len(r[1])):
            if start in used or found[start][1] != rule[0]:
                continue
            chain, k = [start], start
            for name in rule[1:]:
                k = next((j for j in range(k + 1, len(found))
                          if found[j][1] == name and j not in used and found[j][0] - found[chain[-1]][0] <= GAP + 1), None)
                if k is None:
                    break
                chain.append(k)
            if len(chain) == len(rule):
                used.update(chain)
                licences.append(licence)
                break
    return licences, [name for k, (_, name) in enumerate(found) if k not in used]


def scan_licenses(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents (all columns but the text; same-named inputs replaced) with licenses, leftovers and n_sentences.

    licenses: array of the licences whose rules match, one entry a match, in order; leftovers: known
    sentences outside any match; n_sentences: known sentences in all. Null and empty texts have none; repeated
    rows are scanned each for itself; an empty table gives an empty result.
    """
    new = {"licenses": "array<string>", "leftovers": "array<string>", "n_sentences": "bigint"}
    keep = [c for c in docs.columns if c not in new and c != text_col]
    cols = [f"c{i}" for i in range(len(keep))]
    src = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(keep, cols)], F.col(f"`{text_col}`").alias("_text"))

    def run(batches):
        for batch in batches:
            found = [sentence_ids(x.as_py() or "") for x in batch.column(len(cols))]
            rules = [match_rules(f) for f in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(cols)], pa.array([r[0] for r in rules], pa.list_(pa.string())),
                 pa.array([r[1] for r in rules], pa.list_(pa.string())), pa.array([len(f) for f in found], pa.int64())], [*cols, *new])

    fields = T._parse_datatype_string(", ".join(f"{c} {t}" for c, t in new.items())).fields
    out = src.mapInArrow(run, T.StructType([*src.schema.fields[:-1], *fields]))
    return out.select(*[F.col(a).alias(c) for c, a in zip(keep, cols)], *new)
