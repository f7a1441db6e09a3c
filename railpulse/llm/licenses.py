"""License scan by ordered signature rules.

A text is taken as its words (ASCII lower case, punctuation as spaces), joined by single
spaces, and rules are regular expressions over that. A table of license families, each
with its names, versions and places on the web, times a list of forms (a tag, a notice, an
address, a name with its version, a bare name), makes several hundred rules; sentences of
license texts and general wording add theirs.

A rule is tried only on texts that hold all its keywords. Of the places found, one that
lies inside a place of higher rank (by priority, then length, then order of the rules) is
suppressed: "gnu general public license version 3" hides the bare "gnu general public
license" in it. Places that overlap otherwise both stay. The base phrases are reported
wherever they stand, whatever else is found there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from railpulse.llm.words import as_bytes, term_blocks

#: Phrases that are reported wherever they stand, with their labels. Fixed values.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Label, names (regular expressions over words), versions, addresses on the web.
FAMILIES: list[tuple[str, list[str], list[str], list[str]]] = [
    ("gpl", ["gnu general public licen[sc]e", "gnu gpl", "gpl"], ["1.0", "2.0", "3.0"], ["gnu org licenses gpl", "gnu org copyleft gpl"]),
    ("lgpl", ["gnu (?:lesser|library) general public licen[sc]e", "gnu lgpl", "lgpl"], ["2.0", "2.1", "3.0"], ["gnu org licenses lgpl", "gnu org copyleft lesser"]),
    ("agpl", ["(?:gnu )?affero general public licen[sc]e", "gnu agpl", "agpl"], ["1.0", "3.0"], ["gnu org licenses agpl"]),
    ("gfdl", ["gnu free documentation licen[sc]e", "gnu fdl", "gfdl"], ["1.1", "1.2", "1.3"], ["gnu org licenses fdl", "gnu org copyleft fdl"]),
    ("apache", ["apache(?: software)? licen[sc]e", "apache software foundation licen[sc]e", "asl"], ["1.0", "1.1", "2.0"], ["apache org licenses license"]),
    ("mpl", ["mozilla public licen[sc]e", "mpl"], ["1.0", "1.1", "2.0"], ["mozilla org mpl", "mozilla org (?:[a-z]+ )?mpl"]),
    ("epl", ["eclipse public licen[sc]e", "epl"], ["1.0", "2.0"], ["eclipse org legal epl"]),
    ("edl", ["eclipse distribution licen[sc]e"], ["1.0"], ["eclipse org org documents edl"]),
    ("cpl", ["common public licen[sc]e"], ["1.0"], []),
    ("ipl", ["ibm public licen[sc]e"], ["1.0"], []),
    ("cddl", ["common development and distribution licen[sc]e", "cddl"], ["1.0", "1.1"], []),
    ("cpal", ["common public attribution licen[sc]e"], ["1.0"], []),
    ("eupl", ["european union public licen[sc]e", "eupl"], ["1.0", "1.1", "1.2"], ["joinup ec europa eu (?:[a-z]+ )?eupl"]),
    ("osl", ["open software licen[sc]e"], ["1.0", "2.0", "2.1", "3.0"], []),
    ("afl", ["academic free licen[sc]e"], ["2.0", "2.1", "3.0"], []),
    ("artistic", ["artistic licen[sc]e"], ["1.0", "2.0"], ["perlfoundation org artistic license"]),
    ("bsl", ["boost software licen[sc]e"], ["1.0"], ["boost org license"]),
    ("psf", ["python software foundation licen[sc]e", "psf licen[sc]e"], ["2.0"], ["python org psf license"]),
    ("php", ["php licen[sc]e"], ["3.0", "3.01"], ["php net license"]),
    ("zpl", ["zope public licen[sc]e"], ["2.0", "2.1"], []),
    ("apsl", ["apple public source licen[sc]e"], ["1.0", "2.0"], ["opensource apple com license apsl"]),
    ("ms-pl", ["microsoft public licen[sc]e"], [], []),
    ("ms-rl", ["microsoft reciprocal licen[sc]e"], [], []),
    ("ofl", ["sil open font licen[sc]e", "open font licen[sc]e"], ["1.0", "1.1"], ["scripts sil org ofl"]),
    ("lppl", ["latex project public licen[sc]e", "lppl"], ["1.2", "1.3"], ["latex project org lppl"]),
    ("cecill", ["cecill", "cecill free software licen[sc]e agreement"], ["1.0", "2.0", "2.1"], ["cecill info licences"]),
    ("sspl", ["server side public licen[sc]e"], ["1.0"], ["mongodb com licensing server side"]),
    ("busl", ["business source licen[sc]e"], ["1.1"], ["mariadb com bsl"]),
    ("elastic", ["elastic licen[sc]e"], ["1.0", "2.0"], ["elastic co licensing elastic license"]),
    ("polyform-nc", ["polyform noncommercial licen[sc]e"], ["1.0"], ["polyformproject org licenses noncommercial"]),
    ("unlicense", ["(?:the )?unlicense"], [], ["unlicense org"]),
    ("wtfpl", ["wtfpl"], ["2.0"], ["wtfpl net"]),
    ("zlib", ["zlib licen[sc]e", "zlib libpng licen[sc]e"], [], ["zlib net zlib license"]),
    ("libpng", ["libpng licen[sc]e"], ["2.0"], []),
    ("isc", ["isc licen[sc]e"], [], ["opensource org licenses isc"]),
    ("ncsa", ["university of illinois ncsa open source licen[sc]e", "ncsa open source licen[sc]e"], [], []),
    ("x11", ["x11 licen[sc]e"], [], []),
    ("mit", ["mit licen[sc]e", "expat licen[sc]e"], [], ["opensource org licenses mit", "mit license org"]),
    ("mit-0", ["mit no attribution"], [], []),
    ("0bsd", ["zero clause bsd(?: licen[sc]e)?", "0bsd"], [], []),
    ("bsd-2-clause", ["(?:simplified|freebsd) bsd licen[sc]e", "(?:2|two) clause bsd(?: licen[sc]e)?", "bsd (?:2|two) clause(?: licen[sc]e)?"], [], ["opensource org licenses bsd 2 clause"]),
    ("bsd-3-clause", ["(?:new|revised|modified) bsd licen[sc]e", "(?:3|three) clause bsd(?: licen[sc]e)?", "bsd (?:3|three) clause(?: licen[sc]e)?"], [], ["opensource org licenses bsd 3 clause"]),
    ("bsd-4-clause", ["original bsd licen[sc]e", "(?:4|four) clause bsd(?: licen[sc]e)?"], [], []),
    ("bsd", ["bsd(?: style)? licen[sc]e"], [], ["opensource org licenses bsd"]),
    ("cc-by", ["creative commons attribution", "cc by"], ["1.0", "2.0", "2.5", "3.0", "4.0"], ["creativecommons org licenses by"]),
    ("cc-by-sa", ["creative commons attribution share ?alike", "cc by sa"], ["1.0", "2.0", "2.5", "3.0", "4.0"], ["creativecommons org licenses by sa"]),
    ("cc-by-nc", ["creative commons attribution non ?commercial", "cc by nc"], ["1.0", "2.0", "2.5", "3.0", "4.0"], ["creativecommons org licenses by nc"]),
    ("cc-by-nd", ["creative commons attribution no ?deriv(?:ative)?s?", "cc by nd"], ["1.0", "2.0", "2.5", "3.0", "4.0"], ["creativecommons org licenses by nd"]),
    ("cc-by-nc-sa", ["creative commons attribution non ?commercial share ?alike", "cc by nc sa"], ["1.0", "2.0", "2.5", "3.0", "4.0"], ["creativecommons org licenses by nc sa"]),
    ("cc-by-nc-nd", ["creative commons attribution non ?commercial no ?deriv(?:ative)?s?", "cc by nc nd"], ["1.0", "2.0", "2.5", "3.0", "4.0"], ["creativecommons org licenses by nc nd"]),
    ("cc0", ["cc0", "creative commons zero"], ["1.0"], ["creativecommons org publicdomain zero"]),
    ("pddl", ["(?:odc )?public domain dedication and licen[sc]e", "pddl"], ["1.0"], ["opendatacommons org licenses pddl"]),
    ("odbl", ["open (?:data commons open )?database licen[sc]e", "odbl"], ["1.0"], ["opendatacommons org licenses odbl"]),
    ("odc-by", ["open data commons attribution licen[sc]e", "odc by"], ["1.0"], ["opendatacommons org licenses by"]),
    ("ogl-uk", ["open government licen[sc]e"], ["1.0", "2.0", "3.0"], ["nationalarchives gov uk doc open government licence"]),
    ("etalab", ["licence ouverte", "etalab open licen[sc]e"], ["1.0", "2.0"], []),
    ("cdla-permissive", ["community data license agreement permissive"], ["1.0", "2.0"], ["cdla (?:io|dev) permissive"]),
    ("cdla-sharing", ["community data license agreement sharing"], ["1.0"], ["cdla (?:io|dev) sharing"]),
    ("openrail", ["(?:creativeml )?openrail(?: m)?", "(?:creativeml )?open rail(?: m)?"], [], []),
]

#: Sentences of license texts and general wording: label, expression, priority, confidence.
SENTENCES: list[tuple[str, str, int, float]] = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", 70, 0.95),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 70, 0.95),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", 70, 0.9),
    ("bsd-3-clause", "neither the name of [^ ]+(?: [^ ]+){0,12} nor the names of its contributors may be used to endorse", 70, 0.9),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display", 70, 0.9),
    ("apache-2.0", "you may not use this file except in compliance with the license", 70, 0.8),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of", 65, 0.7),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of", 65, 0.7),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", 75, 0.95),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented", 70, 0.9),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", 75, 0.95),
    ("unlicense", "this is free and unencumbered software released into the public domain", 75, 0.95),
    ("wtfpl", "do what the fuck you want to public license", 75, 0.95),
    ("cc0-1.0", "to the extent possible under law (?:the author|the person|[^ ]+(?: [^ ]+){0,8}) (?:has|have) waived all copyright", 75, 0.95),
    ("ofl-1.1", "this font software is licensed under the sil open font license version 1 1", 80, 0.98),
    ("public-domain", "(?:released|placed|dedicated|is) (?:into|in|to) the public domain", 40, 0.6),
    ("public-domain", "public domain dedication", 35, 0.5),
    ("all-rights-reserved", "all rights reserved", 20, 0.4),
    ("proprietary", "proprietary and confidential", 40, 0.7),
    ("proprietary", "confidential and proprietary", 40, 0.7),
    ("proprietary", "unauthorized (?:copying|use|reproduction|distribution)(?: [^ ]+){0,8} (?:is )?(?:strictly )?prohibited", 40, 0.6),
    ("commercial", "(?:subject to|under) (?:a|the) commercial licen[sc]e", 40, 0.6),
    ("unknown-license-reference", "see (?:the )?(?:file )?(?:licen[sc]e|copying)(?: txt| md| file)?(?: file)? for (?:more |full )?(?:details|information|terms)", 15, 0.3),
    ("unknown-license-reference", "licen[sc]ed under (?:the )?terms", 10, 0.2),
]

#: Words that start a notice, and how often they are followed by filling words.
_NOTICE = (
    "(?:licen[sc]ed|released|distributed|available|provided|published|covered|made available|redistribute it|shared)"
    "(?: only)? (?:under|by|subject to)(?: the)?(?: terms(?: and conditions)? of(?: the)?)?"
)
#: Priority and confidence of the forms.
_TAG, _WEB, _NOTED, _VERSIONED, _BARE = (90, 1.0), (80, 0.95), (60, 0.9), (50, 0.8), (30, 0.6)
_BASE = (30, 0.6)


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: re.Pattern[str]
    keywords: frozenset[str]
    priority: int
    confidence: float


def _pieces(expression: str, separator: str) -> list[str]:
    """The expression cut at a character where that stands outside groups and classes."""
    pieces, depth = [""], 0
    for c in expression:
        depth += (c in "([") - (c in ")]")
        if c == separator and not depth:
            pieces.append("")
        else:
            pieces[-1] += c
    return pieces


_GROUP = re.compile(r"\((?:[^()]|\([^()]*\))*\)[?*]?")


def _keywords(expression: str) -> frozenset[str]:
    """Words that every match of an expression holds.

    Between two spaces outside groups lies one word, and more where a group at its
    beginning ends, or a group at its end begins, with a space in all its branches. What
    is left must be plain letters and digits.
    """
    pieces, found = _pieces(expression, " "), set()
    for n, piece in enumerate(pieces):
        glued = piece.startswith("?") or (n + 1 < len(pieces) and pieces[n + 1].startswith("?"))
        while group := _GROUP.match(piece):
            branches = _pieces(group[0].rstrip("?*")[:-1].removeprefix("(?:"), "|")
            if not all(b.endswith(" ") for b in branches):
                break
            piece = piece[group.end() :]
        while piece.endswith((")", ")?")) and (groups := list(_GROUP.finditer(piece))):
            last = groups[-1]
            if last.end() != len(piece):
                break
            body = last[0].rstrip("?*")[:-1]
            if not body.startswith("(?!") and not all(b.startswith(" ") for b in _pieces(body.removeprefix("(?:"), "|")):
                break
            piece = piece[: last.start()]
        if not glued and re.fullmatch("[a-z0-9]+", piece):
            found.add(piece)
    return frozenset(found)


def _rule(label: str, expression: str, grade: tuple[int, float]) -> Rule:
    return Rule(label, re.compile(f"(?<![^ ]){expression}(?![^ ])"), _keywords(expression), *grade)


def _version(version: str) -> str:
    """A version as words: a last zero may be left out, "v" may stand before it."""
    number = version.removesuffix(".0").replace(".", " ") + ("(?: 0)?" if version.endswith(".0") else "")
    # no further number, so that "2" is not found in "2 1"
    return f"(?:v|v |version )?{number}(?! [0-9]+(?![^ ]))"


@cache
def rules() -> tuple[Rule, ...]:
    """All rules, those of higher priority first; among equals the order of the tables."""
    found = []
    for label, names, versions, places in FAMILIES:
        tag = label.replace("-", " ")
        for version in versions:
            own = f"{label}-{version}"
            number = _version(version)
            found.append(_rule(own, f"spdx licen[sc]e identifier {tag} {number}(?: only| or later)?", _TAG))
            for place in places:
                found.append(_rule(own, f"(?:https? )?(?:www )?{place} {number}(?: html| txt| en)?", _WEB))
            for name in names:
                text = f"(?:the )?{name}(?: licen[sc]e)?(?: international| unported)?(?: version)? {number}"
                tail = "(?: only| or(?: at your option)?(?: any)? later(?: version)?| international| unported)?"
                found.append(_rule(own, f"{_NOTICE} {text}{tail}", _NOTED))
                found.append(_rule(own, f"{text}{tail}", _VERSIONED))
                if name.isalpha():  # "gplv3"
                    short = version.removesuffix(".0").split(".")
                    found.append(_rule(own, " ".join([f"{name}v{short[0]}", *short[1:]]) + tail, _VERSIONED))
        found.append(_rule(label, f"spdx licen[sc]e identifier {tag}(?: only| or later)?", (_TAG[0] - 5, _TAG[1])))
        for place in places:
            found.append(_rule(label, f"(?:https? )?(?:www )?{place}(?: html| txt)?", (_WEB[0] - 5, _WEB[1])))
        for name in names:
            found.append(_rule(label, f"{_NOTICE} {name}(?: licen[sc]e)?", (_NOTED[0] - 15, _NOTED[1])))
            found.append(_rule(label, f"(?:the )?{name}(?: licen[sc]e)?", _BARE))
    found += [_rule(label, text, (priority, sure)) for label, text, priority, sure in SENTENCES]
    return tuple(sorted(found, key=lambda r: -r.priority))


@cache
def _by_keyword() -> tuple[frozenset[str], dict[str, list[tuple[int, Rule]]], list[tuple[int, Rule]]]:
    """(all keywords, rules by the rarest-looking keyword of each, rules without any)."""
    ordered = list(enumerate(rules()))
    common = {"license", "public", "general", "the", "of", "and", "by", "to", "org", "licenses", "software", "open", "is"}
    keyed: dict[str, list[tuple[int, Rule]]] = {}
    free = []
    for n, rule in ordered:
        if rule.keywords:
            first = min(rule.keywords, key=lambda w: (w in common, -len(w), w))
            keyed.setdefault(first, []).append((n, rule))
        else:
            free.append((n, rule))
    return frozenset(w for r in rules() for w in r.keywords), keyed, free


def _outranked(start: np.ndarray, end: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Whether a place lies inside one of higher rank. Containment is transitive and so is
    rank, so it does not matter whether that one is outranked itself."""
    gone = np.zeros(len(start), dtype=bool)
    above_start, above_end = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    for level in np.unique(rank[:, 0]).tolist():
        on = np.flatnonzero(rank[:, 0] == level)
        # Longer places come first among equals, then the order of the rules.
        on = on[np.lexsort((rank[on, 1], -end[on], start[on]))]
        reach = np.maximum.accumulate(above_end) if len(above_end) else above_end
        at = np.searchsorted(above_start, start[on], side="right") - 1
        gone[on] = (at >= 0) & (end[on] <= reach[np.maximum(at, 0)]) if len(reach) else False
        inside = np.maximum.accumulate(np.concatenate([[-1], end[on][:-1]]))
        gone[on] |= end[on] <= inside
        merged = np.concatenate([above_start, start[on]])
        by = np.argsort(merged, kind="stable")
        above_start = merged[by]
        above_end = np.concatenate([above_end, end[on]])[by]
    return gone


def detect(words: list[bytes]) -> list[tuple[str, int, int, int, float, bool]]:
    """(label, first word, words, priority, confidence, base) of what the words state, by
    place."""
    known, keyed, free = _by_keyword()
    held = {w.decode() for w in _encoded(known).intersection(words)}
    text = b" ".join(words).decode()
    spans = []
    for key in held & keyed.keys():
        for n, rule in keyed[key]:
            if rule.keywords <= held:
                spans += [(m.start(), m.end(), -rule.priority, n) for m in rule.pattern.finditer(text)]
    for n, rule in free:
        spans += [(m.start(), m.end(), -rule.priority, n) for m in rule.pattern.finditer(text)]
    base = []
    for k, phrase in enumerate(BASE):
        if _words_of_phrase(phrase) <= held:
            pattern = re.compile(f"(?<![^ ]){phrase}(?![^ ])")
            base += [(m.start(), m.end(), k) for m in pattern.finditer(text)]
    if not spans and not base:
        return []
    starts = _word_starts(text)

    def place(start: int, end: int) -> tuple[int, int]:
        first, last = np.searchsorted(starts, [start, end])
        return int(first), int(last - first)

    found = []
    if spans:
        table = np.array(spans, dtype=np.int64)
        gone = _outranked(table[:, 0], table[:, 1], table[:, 2:])
        every = rules()
        for start, end, _, n in table[~gone].tolist():
            rule = every[n]
            found.append((rule.label, *place(start, end), rule.priority, rule.confidence, False))
    labels = list(BASE.values())
    found += [(labels[k], *place(start, end), *_BASE, True) for start, end, k in base]
    return sorted(found, key=lambda f: (f[1], -f[2], f[5], f[0]))


@cache
def _encoded(words: frozenset[str]) -> frozenset[bytes]:
    return frozenset(w.encode() for w in words | {w for p in BASE for w in p.split(" ")})


@cache
def _words_of_phrase(phrase: str) -> frozenset[str]:
    return frozenset(phrase.split(" "))


def _word_starts(text: str) -> np.ndarray:
    """Where in the text, as characters, words start."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return np.concatenate([[0], np.flatnonzero(codes == 32) + 1])


SCHEMA = (
    "doc_id bigint, n_words bigint, places array<struct<label:string,start:bigint,words:bigint,"
    "priority:int,confidence:double,base:boolean>>"
)


def scan_licenses(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, places): what each whole text states about its license.

    A place has the label, the number of its first word (from 0) and of its words, the
    priority and confidence (0 to 1) of its rule, and whether it is one of the base
    phrases, which are never suppressed. Places go by first word, longer ones first.

    One row per input row, repeated rows and rows without an id included; a null or empty
    text has no words and no places. Other columns are ignored, whatever their names.
    Nothing is shuffled; a task holds one text as words at a time.
    """
    kind = pa.struct(
        [
            ("label", pa.string()), ("start", pa.int64()), ("words", pa.int64()),
            ("priority", pa.int32()), ("confidence", pa.float64()), ("base", pa.bool_()),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, places = [], []
            for body in as_bytes(batch.column(1)):
                words = [w for block in term_blocks(body) for w in block]
                counts.append(len(words))
                names = [f.name for f in kind]
                places.append([dict(zip(names, p, strict=True)) for p in detect(words)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(places, pa.list_(kind))],
                names=["doc_id", "n_words", "places"],
            )

    whole = docs.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"`{text}` as text")
    return whole.mapInArrow(scan, SCHEMA)
