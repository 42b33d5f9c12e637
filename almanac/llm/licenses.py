"""License scans by template-markup matching.

A template is the wording of a notice with markup: ``<<beginOptional>> ... <<endOptional>>`` may be there or not, and
``<<var;min=a;max=b>>`` stands for any a to b words. It is compiled into an automaton over words: states are linked by
the words that lead on, optional regions by empty moves, and replaceable regions by states that any word passes. A text
is accepted where some run of its words leads from the start to the end of an automaton, so all mandatory wording must
be there, word for word and in order.

The automata of all templates run together over the words of a text. A run can only start where a word is the first
of some template, which most words are not, so other places are passed over at once.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from almanac.llm.batches import map_texts
from almanac.sources import table

# fixed values: the base phrases and their labels
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# fixed values: the wording of whole licenses, from their grant to the end of their disclaimer
_NUMBER = "<<var;min=0;max=1>>"
_WHO = "<<var;min=1;max=12>>"
_BSD_OPENING = f"""
    redistribution and use in source and binary forms with or without modification are permitted provided that the
    following conditions are met {_NUMBER} redistributions of source code must retain the above copyright notice this list
    of conditions and the following disclaimer {_NUMBER} redistributions in binary form must reproduce the above copyright
    notice this list of conditions and the following disclaimer in the documentation and or other materials provided with
    the distribution
"""
_BSD_NAMES = f"""
    {_NUMBER} neither the name of {_WHO} nor the names of <<var;min=1;max=3>> contributors may be used to endorse or promote
    products derived from this software without specific prior written permission
"""
_BSD_DISCLAIMER = f"""
    this software is provided by {_WHO} as is and any express or implied warranties including but not limited to the implied
    warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall {_WHO} be liable
    for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of
    substitute goods or services loss of use data or profits or business interruption however caused and on any theory of
    liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use
    of this software even if advised of the possibility of such damage
"""
LICENSES = {
    "mit": f"""
    permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation
    files the software to deal in the software without restriction including without limitation the rights to use copy
    modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software
    is furnished to do so subject to the following conditions the above copyright notice and this permission notice
    <<beginOptional>>including the next paragraph<<endOptional>> shall be included in all copies or substantial portions of
    the software the software is provided as is without warranty of any kind express or implied including but not limited
    to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall {_WHO} be
    liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or
    in connection with the software or the use or other dealings in the software
    """,
    "bsd-2-clause": _BSD_OPENING + _BSD_DISCLAIMER,
    "bsd-3-clause": _BSD_OPENING + _BSD_NAMES + _BSD_DISCLAIMER,
    "isc": f"""
    permission to use copy modify and <<beginOptional>>or<<endOptional>> distribute this software for any purpose with or
    without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the
    software is provided as is and {_WHO} disclaims
    all warranties with regard to this software including all implied warranties of merchantability and fitness in no event
    shall {_WHO} be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from
    loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in
    connection with the use or performance of this software
    """,
    "zlib": f"""
    this software is provided as is without any express or implied warranty in no event will {_WHO} be held liable for any
    damages arising from the use of this software permission is granted to anyone to use this software for any purpose
    including commercial applications and to alter it and redistribute it freely subject to the following restrictions
    {_NUMBER} the origin of this software must not be misrepresented you must not claim that you wrote the original software
    if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not
    required {_NUMBER} altered source versions must be plainly marked as such and must not be misrepresented as being the
    original software {_NUMBER} this notice may not be removed or altered from any source distribution
    """,
    "apache-2.0-header": """
    licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
    you may obtain a copy of the license at <<var;min=1;max=12>> unless required by applicable law or agreed to in writing
    software distributed under the license is distributed on an as is basis without warranties or conditions of any kind
    either express or implied see the license for the specific language governing permissions and limitations under the license
    """,
}

# Labels of the method: the licenses, and templates of notices that name one, most of them in several wordings.
NOTICES = {
    "apache-2.0": [
        "licensed under <<beginOptional>>the<<endOptional>> apache license <<beginOptional>>version<<endOptional>> 2 0",
    ],
    "mit": [
        "<<beginOptional>>released<<endOptional>><<beginOptional>>licensed<<endOptional>> under the mit license",
    ],
    "bsd": [
        "under the <<beginOptional>><<var;min=1;max=2>> clause<<endOptional>> bsd license",
    ],
    "gpl-notice": [
        "licensed under the <<beginOptional>>gnu<<endOptional>> general public license "
        "<<beginOptional>>version <<var;min=1;max=2>><<endOptional>>",
        "redistribute it and or modify it under the terms of the gnu <<beginOptional>>lesser<<endOptional>> "
        "<<beginOptional>>affero<<endOptional>> general public license",
    ],
    "cc-by-nc": ["licensed under <<beginOptional>>a<<endOptional>> cc by nc <<beginOptional>>4 0<<endOptional>>"],
    "cc-by-sa": ["licensed under <<beginOptional>>a<<endOptional>> cc by sa <<beginOptional>>4 0<<endOptional>>"],
    "copyright-notice": [
        "copyright <<beginOptional>>c<<endOptional>> <<var;min=1;max=8>> all rights reserved",
    ],
    "mpl-2.0": ["subject to the terms of the mozilla public license <<beginOptional>>v<<endOptional>> 2 0"],
}
TEMPLATES = {label: [*([LICENSES[label]] if label in LICENSES else []), *NOTICES.get(label, [])] for label in {**LICENSES, **NOTICES}}
BASE_SCORE = 0.5

_MARKUP = re.compile(r"<<(.*?)>>", re.S)
_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def words_of(text: str) -> list[str]:
    return _WORDS(text.translate(_LOWER))


@dataclass
class State:
    """A state: where each word leads, where any word leads, and where no word is needed."""

    by_word: dict[str, list[int]] = field(default_factory=dict)
    by_any: list[int] = field(default_factory=list)
    free: list[int] = field(default_factory=list)


class Automaton:
    """States of all templates; ``closed`` lists what a state reaches without a word."""

    def __init__(self, templates: dict[str, list[str]]):
        self.states: list[State] = []
        self.accepts: dict[int, str] = {}
        starts = []
        for label, wordings in templates.items():
            for wording in wordings:
                start, end = self._compile(wording)
                starts.append(start)
                self.accepts[end] = label
        self.closed = [self._closure(i) for i in range(len(self.states))]
        self.first: dict[str, list[int]] = {}
        for start in starts:
            for i in self.closed[start]:
                if i in self.accepts or self.states[i].by_any:
                    raise ValueError("a template must begin with a mandatory word")
                for word, targets in self.states[i].by_word.items():
                    self.first.setdefault(word, []).extend(targets)

    def _new(self) -> int:
        self.states.append(State())
        return len(self.states) - 1

    def _compile(self, wording: str) -> tuple[int, int]:
        start = here = self._new()
        optional: list[int] = []
        for i, piece in enumerate(_MARKUP.split(wording)):
            if i % 2 == 0:
                for word in words_of(piece):
                    after = self._new()
                    self.states[here].by_word.setdefault(word, []).append(after)
                    here = after
                continue
            name, *options = piece.split(";")
            if name == "beginOptional":
                optional.append(here)
            elif name == "endOptional" and optional:
                after = self._new()
                self.states[here].free.append(after)
                self.states[optional.pop()].free.append(after)
                here = after
            elif name == "var":
                limits = {k: int(v) for k, v in (o.split("=") for o in options)}
                ends = []
                for n in range(limits["max"] + 1):
                    if n >= limits["min"]:
                        ends.append(here)
                    if n < limits["max"]:
                        after = self._new()
                        self.states[here].by_any.append(after)
                        here = after
                after = self._new()
                for end in ends:
                    self.states[end].free.append(after)
                here = after
            else:
                raise ValueError(f"unknown or unbalanced markup: {piece}")
        if optional:
            raise ValueError("an optional region is not closed")
        return start, here

    def _closure(self, state: int) -> list[int]:
        seen, stack = {state}, [state]
        while stack:
            for target in self.states[stack.pop()].free:
                if target not in seen:
                    seen.add(target)
                    stack.append(target)
        return sorted(seen)

    def at(self, words: list[str], start: int) -> dict[str, int]:
        """Labels of the templates that begin at this word, each with the number of words of its longest match."""
        found: dict[str, int] = {}
        states = {s for t in self.first.get(words[start], ()) for s in self.closed[t]}
        place = start + 1
        while states:
            for state in states:
                if state in self.accepts:
                    found[self.accepts[state]] = place - start
            if place == len(words):
                break
            word = words[place]
            reached = set()
            for state in states:
                moves = self.states[state]
                reached.update(moves.by_word.get(word, ()), moves.by_any)
            states = {s for t in reached for s in self.closed[t]}
            place += 1
        return found


@dataclass
class Scanner:
    """Base phrases and templates in one automaton."""

    base: dict[str, str]
    templates: dict[str, list[str]]

    def __post_init__(self) -> None:
        self.automaton = Automaton({f"\n{phrase}": [phrase] for phrase in self.base} | self.templates)
        # The rarest way to rule a text out: it has no word that begins a template.
        self.first = frozenset(self.automaton.first)

    def __call__(self, text: str) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, score, notices (text of each template match)."""
        words = words_of(text)
        base_places, base_labels, labels, notices = [], set(), set(), []
        if not self.first.isdisjoint(words):
            first = self.first
            for i in [i for i, word in enumerate(words) if word in first]:
                for label, length in self.automaton.at(words, i).items():
                    if label[0] == "\n":
                        base_places.append(i)
                        base_labels.add(self.base[label[1:]])
                    else:
                        labels.add(label)
                        notices.append(" ".join(words[i : i + length]))
        score = 1.0 if labels else BASE_SCORE if base_labels else 0.0
        return (
            len(words), len(base_places), min(base_places, default=None), max(base_places, default=None),
            ",".join(sorted(base_labels)), ",".join(sorted(base_labels | labels)), score, notices,
        )


@lru_cache(maxsize=1)
def _scanner() -> Scanner:
    return Scanner(BASE, TEMPLATES)


COLUMNS = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "notices array<string>"
)


def license_scan(
    docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
    scanner: Callable[[], Scanner] = _scanner,
) -> DataFrame:
    """The kept columns and COLUMNS of every row.

    A null, empty or wordless text has n_words 0, no places (null) and empty labels. Score is 1 where a template
    matches, BASE_SCORE where only base phrases occur, else 0. Rows are independent: repeated rows come out each, null
    keys are kept, other columns are not read. Whole texts are scanned, in time proportional to their length: a run
    of an automaton is no longer than its template.
    """

    def prepare() -> Callable[[list[str]], list]:
        scan = scanner()
        return lambda texts: [list(column) for column in zip(*map(scan, texts))]

    return map_texts(docs, text, keep, COLUMNS, prepare)


def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(table(spark, folder, "documents"))


QUERIES = {"op5_licenses": op5_licenses}
ORACLES: dict[str, str] = {}
