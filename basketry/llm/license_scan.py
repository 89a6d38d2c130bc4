"""License wording: fixed phrases, and templates with optional and replaceable regions.

A template is a text with markup: ``[[ ... ]]`` may be left out, ``{{name:n}}`` stands for up to n
words of any wording. It is compiled into an automaton over words; a place is accepted only if all
mandatory words follow each other exactly, disclaimers included. Templates add labels; phrase labels
always stay. A match is looked for only where the template's mandatory word that is rarest in the
text stands at a possible distance, and takes no more words than the template has.

Defined results: words are runs of letters and digits after lower-casing A-Z; null text is empty
and gives 0 words, null places, empty labels and score 0; rows that repeat give repeated results;
an empty table gives no rows; other columns are ignored. Texts of any length are read whole.
``score`` is the share of the text's words that phrases and accepted templates cover.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from basketry.llm.words import batch, lowered, per_row, runs, text_slices

# Phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Labels and template texts.
TEMPLATES = {
    "mit-notice": "[[is]] [[licensed]] [[released]] [[available]] [[distributed]] under the [[terms of the]] mit license",
    "apache-2.0-notice": "under the [[terms of the]] apache license [[,]] [[version]] 2 [[0]]",
    "gpl-notice": "under the [[terms of the]] [[gnu]] general public license [[as published by the free software "
    "foundation]] [[either]] [[version]] [[{{version:1}}]] [[or [[at your option]] any later version]]",
    "cc-by-nc-notice": "under [[the]] [[a]] [[creative commons]] cc by nc [[{{major:1}}]] [[{{minor:1}}]]",
    "copyright-notice": "copyright [[c]] {{holder:8}} all rights reserved",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice "
    "and this permission notice [[including the next paragraph]] shall be included in all copies or substantial "
    "portions of the software the software is provided as is without warranty of any kind express or implied including "
    "but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no "
    "event shall {{holders:8}} be liable for any claim damages or other liability whether in an action of contract tort "
    "or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies the software is "
    "provided as is and {{author:8}} disclaims all warranties with regard to this software including all implied "
    "warranties of merchantability and fitness in no event shall {{author:8}} be liable for any special direct indirect "
    "or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action "
    "of contract negligence or other tortious action arising out of or in connection with the use or performance of this "
    "software",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that "
    "the following conditions are met [[1]] redistributions of source code must retain the above copyright notice this "
    "list of conditions and the following disclaimer [[2]] redistributions in binary form must reproduce the above "
    "copyright notice this list of conditions and the following disclaimer in the documentation and or other materials "
    "provided with the distribution [[ [[3]] neither the name of {{holder:12}} nor the names of its contributors may be "
    "used to endorse or promote products derived from this software without specific prior written permission ]] this "
    "software is provided by {{holders:8}} [[and contributors]] as is and any express or implied warranties including "
    "but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in "
    "no event shall {{holders:8}} [[or contributors]] be liable for any direct indirect incidental special exemplary or "
    "consequential damages including but not limited to procurement of substitute goods or services loss of use data or "
    "profits or business interruption however caused and on any theory of liability whether in contract strict liability "
    "or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the "
    "possibility of such damage",
    "apache-2.0-header": "licensed under the apache license version 2 0 the license you may not use this file except in "
    "compliance with the license you may obtain a copy of the license at [[http]] [[https]] www apache org licenses "
    "license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is "
    "distributed on an as is basis without warranties or conditions of any kind either express or implied see the "
    "license for the specific language governing permissions and limitations under the license",
    "lgpl-notice": "under the [[terms of the]] [[gnu]] lesser general public license [[as published by the free software "
    "foundation]] [[either]] [[version]] [[{{version:2}}]] [[of the license]] [[or [[at your option]] any later version]]",
    "mpl-2.0-header": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the "
    "mpl was not distributed with this file you can obtain one at [[http]] [[https]] mozilla org mpl 2 0",
    "cc0": "to the extent possible under law {{who:12}} waived all copyright and related or neighboring rights to {{work:12}}",
    "unlicense": "this is free and unencumbered software released into the public domain anyone is free to copy modify "
    "publish use compile sell or distribute this software either in source code form or as a compiled binary for any "
    "purpose commercial or non commercial and by any means in jurisdictions that recognize copyright laws the author or "
    "authors of this software dedicate any and all copyright interest in the software to the public domain we make this "
    "dedication for the benefit of the public at large and to the detriment of our heirs and successors we intend this "
    "dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software "
    "under copyright law the software is provided as is without warranty of any kind express or implied including but "
    "not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event "
    "shall the authors be liable for any claim damages or other liability whether in an action of contract tort or "
    "otherwise arising from out of or in connection with the software or the use or other dealings in the software",
}
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
TOKEN = re.compile(r"\[\[|\]\]|\{\{[a-z]+:\d+\}\}|[^\s\[\]{}]+")


class Automaton(NamedTuple):
    """Words by state: ``steps[s]`` maps a word to states, ``any_word[s]`` takes every word; ``skips`` are closed.

    ``anchors`` gives for each mandatory word how few and how many words of a match stand before it.
    """

    steps: list[dict[str, set[int]]]
    any_word: list[set[int]]
    start: frozenset[int]
    accept: int
    skips: list[frozenset[int]]
    anchors: dict[str, tuple[int, int]]

    @property
    def first_words(self) -> set[str] | None:
        """Words that can begin a match; None if any word can."""
        if any(self.any_word[s] for s in self.start):
            return None
        return {w for s in self.start for w in self.steps[s]}

    def places(self, where: dict[str, list[int]], n: int) -> list[int]:
        """Where in n words a match may begin, ascending; ``where`` lists the places of words."""
        first = self.first_words
        starts = None if first is None else np.array(sorted(i for w in first for i in where.get(w, ())), np.int64)
        if not self.anchors:
            return list(range(n)) if starts is None else starts.tolist()
        word = min(self.anchors, key=lambda w: len(where.get(w, ())))
        at, (least, most) = np.array(where.get(word, ()), np.int64), self.anchors[word]
        if starts is None:
            starts = np.unique(at[:, None] - np.arange(least, most + 1))
            return starts[starts >= 0].tolist()
        reached = np.searchsorted(at, starts + most, side="right") > np.searchsorted(at, starts + least)
        return starts[reached].tolist()

    def longest(self, words: list[str], at: int) -> int:
        """Number of words of the longest accepted run from ``at``; 0 if there is none."""
        states, best = self.start, 0
        for here in range(at, len(words)):
            moved: set[int] = set()
            for s in states:
                moved |= self.steps[s].get(words[here], set()) | self.any_word[s]
            if not moved:
                break
            states = frozenset().union(*(self.skips[s] for s in moved))
            if self.accept in states:
                best = here + 1 - at
        return best


def compile_template(text: str) -> Automaton:
    steps: list[dict[str, set[int]]] = [{}]
    any_word: list[set[int]] = [set()]
    empty: list[set[int]] = [set()]

    def new() -> int:
        steps.append({})
        any_word.append(set())
        empty.append(set())
        return len(steps) - 1

    here, opened = 0, []
    least = most = 0
    anchors: dict[str, tuple[int, int]] = {}
    for token in TOKEN.findall(text.lower()):
        if token == "[[":
            opened.append(here)
            here = new()
            empty[opened[-1]].add(here)
        elif token == "]]":
            end = new()
            empty[here].add(end)
            empty[opened.pop()].add(end)
            here = end
        elif token.startswith("{{"):
            end = new()
            for _ in range(int(token[2:-2].split(":")[1])):
                most += 1
                following = new()
                empty[here].add(end)
                any_word[here].add(following)
                here = following
            empty[here].add(end)
            here = end
        else:
            for word in WORD.findall(token):
                following = new()
                steps[here].setdefault(word, set()).add(following)
                here = following
                if not opened:
                    anchors.setdefault(word, (least, most))
                    least += 1
                most += 1
    if opened:
        raise ValueError("an optional region is not closed")

    def closed(s: int) -> frozenset[int]:
        seen, todo = {s}, [s]
        while todo:
            for t in empty[todo.pop()] - seen:
                seen.add(t)
                todo.append(t)
        return frozenset(seen)

    skips = [closed(s) for s in range(len(steps))]
    return Automaton(steps, any_word, skips[0], here, skips, anchors)


def finds(words: list[str], automata: dict[str, Automaton], phrases: dict[str, str]) -> tuple[list, list]:
    """(start, length, label) of the phrases and of the longest accepted run of each template at each place."""
    known = {p.split()[0] for p in phrases}.union(*(a.anchors for a in automata.values()))
    known = known.union(*(a.first_words or () for a in automata.values()))
    where: dict[str, list[int]] = {}
    for i, w in enumerate(words):
        if w in known:
            where.setdefault(w, []).append(i)
    base = []
    for phrase, label in phrases.items():
        parts = phrase.split()
        for i in where.get(parts[0], ()):
            if words[i : i + len(parts)] == parts:
                base.append((i, len(parts), label))
    matched = []
    for label, automaton in automata.items():
        covered = 0
        for i in automaton.places(where, len(words)):
            if i >= covered and (n := automaton.longest(words, i)):
                matched.append((i, n, label))
                covered = i + n
    return base, matched


FOUND = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
     ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
)
IN_WORD = np.isin(np.arange(256), [*b"0123456789abcdefghijklmnopqrstuvwxyz", *range(128, 256)])
FOUND_DDL = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    "labels string, score double"
)


def scan(documents: DataFrame, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """One row a document with its phrase places, labels and score."""
    automata = {label: compile_template(text) for label, text in templates.items()}
    # Words that every match holds are looked for first, the longest before the others.
    needed = {tuple(sorted({w.encode() for w in p.split()}, key=len, reverse=True)) for p in phrases}
    needed |= {mandatory(t) for t in templates.values()}

    def run(batches):
        for rows in batches:
            ids = rows.column(0).cast(pa.int64())
            for piece in text_slices(rows.column(1)):
                n = piece.last - piece.first
                data = lowered(piece.data)
                row, _, _ = runs(IN_WORD[data], piece.offsets)
                n_words = per_row(row, n)
                n_base, score = np.zeros(n, np.int64), np.zeros(n)
                first, last, base_labels, labels = [None] * n, [None] * n, [""] * n, [""] * n
                raw = data.tobytes()
                at = piece.offsets - piece.offsets[0]
                for i in range(n):
                    content = raw[at[i] : at[i + 1]]
                    if not any(all(w in content for w in words) for words in needed):
                        continue
                    base, matched = finds(WORD.findall(content.decode()), automata, phrases)
                    if not base and not matched:
                        continue
                    covered = np.zeros(n_words[i], bool)
                    for start, length, _ in base + matched:
                        covered[start : start + length] = True
                    score[i] = covered.mean()
                    n_base[i] = len(base)
                    if base:
                        first[i], last[i] = min(b[0] for b in base), max(b[0] for b in base)
                    base_labels[i] = ",".join(sorted({b[2] for b in base}))
                    labels[i] = ",".join(sorted({b[2] for b in base + matched}))
                yield batch(FOUND, ids.slice(piece.first, n), n_words, n_base, first, last, base_labels, labels, score)

    return documents.select("doc_id", "text").mapInArrow(run, FOUND_DDL)


def mandatory(template: str) -> tuple[bytes, ...]:
    """The distinct mandatory words of a template, longest first."""
    depth, words = 0, set()
    for token in TOKEN.findall(template.lower()):
        depth += (token == "[[") - (token == "]]")
        if not depth and token != "]]" and not token.startswith("{{"):
            words.update(w.encode() for w in WORD.findall(token))
    return tuple(sorted(words, key=lambda w: (-len(w), w)))
