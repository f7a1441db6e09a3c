import random
import re
from re import _constants as K
from re import _parser

import numpy as np
import pytest

from railpulse.llm.licenses import BASE, _outranked, detect, rules, scan_licenses
from railpulse.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def stated(text):
    return [(p[0], p[1], p[2]) for p in detect([w.encode() for w in words(text)]) if not p[5]]


def example(rng, node):
    """A string that a parsed expression matches; look-arounds are passed over."""
    out = ""
    for op, value in node:
        if op is K.LITERAL:
            out += chr(value)
        elif op is K.NOT_LITERAL:
            out += "x"
        elif op is K.IN:
            out += "x" if value[0][0] is K.NEGATE else chr(rng.choice(value)[1]) if value[0][0] is K.LITERAL else "a"
        elif op is K.SUBPATTERN:
            out += example(rng, value[3])
        elif op is K.BRANCH:
            out += example(rng, rng.choice(value[1]))
        elif op is K.MAX_REPEAT:
            low, high, inner = value
            out += "".join(example(rng, inner) for _ in range(rng.randint(low, min(high, low + 2))))
        else:
            assert op in (K.ASSERT, K.ASSERT_NOT), op
    return out


def test_every_rule_finds_its_examples_and_holds_its_keywords():
    rng = random.Random(1)
    assert len(rules()) > 300 and all(r.keywords for r in rules())
    for rule in rules():
        tree = _parser.parse(rule.pattern.pattern)
        for _ in range(6):
            text = example(rng, tree)
            assert rule.pattern.fullmatch(text), (rule.pattern.pattern, text)
            assert rule.keywords <= set(text.split(" ")), (rule.pattern.pattern, text)
            assert detect(text.encode().split(b" "))  # the prefilter lets it through


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("This work is licensed under the GNU General Public License, version 3.", [("gpl-3.0", 3, 9)]),
        ("Released under the MIT License.", [("mit", 0, 5)]),
        ("// SPDX-License-Identifier: GPL-2.0-or-later", [("gpl-2.0", 0, 8)]),
        ("see https://creativecommons.org/licenses/by-sa/4.0/ for it", [("cc-by-sa-4.0", 1, 8)]),
        ("GPLv3 or LGPL 2.1 or later", [("gpl-3.0", 0, 1), ("lgpl-2.1", 2, 5)]),
        ("Creative Commons Attribution-ShareAlike 3.0", [("cc-by-sa-3.0", 0, 6)]),
        ("All rights reserved. See LICENSE for details", [("all-rights-reserved", 0, 3), ("unknown-license-reference", 3, 4)]),
        ("the summit licensee is a CCD by the way", []),
    ],
)
def test_statements(text, want):
    assert stated(text) == want


def test_containment_against_all_pairs():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(1, 30)
        start = np.array([rng.randrange(12) for _ in range(n)])
        end = start + np.array([rng.randint(1, 8) for _ in range(n)])
        rank = np.array([[rng.randint(-3, -1), k] for k in range(n)])
        key = [(int(rank[i, 0]), int(start[i] - end[i]), int(rank[i, 1])) for i in range(n)]
        want = [
            any(start[j] <= start[i] and end[i] <= end[j] and key[j] < key[i] for j in range(n) if j != i)
            for i in range(n)
        ]
        assert _outranked(start, end, rank).tolist() == want


def base_places(w):
    return sorted(
        (i, label)
        for phrase, label in BASE.items()
        for i in range(len(w))
        if w[i : i + len(phrase.split(" "))] == phrase.split(" ")
    )


def test_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, "..."), (None, "MIT License"), (4, "mit\nlicense mit licensé"), (4, "mit\nlicense mit licensé")]
    rows.append((5, "CC-BY the Apache  License " * 20_000))
    got = scan_licenses(documents(rows)).collect()
    assert sorted((r.doc_id or -1, r.n_words) for r in got) == [(-1, 2), (1, 0), (2, 0), (3, 0), (4, 4), (4, 4), (5, 100_000)]
    texts = dict(rows)
    for r in got:
        assert sorted((p.start, p.label) for p in r.places if p.base) == base_places(words(texts[r.doc_id]))
    assert scan_licenses(documents([])).collect() == []


def test_query_against_every_word(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in REGISTRY["op12_license_scan"](spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        w, r = words(d.text), got[d.doc_id]
        places = base_places(w)
        starts = [i for i, _ in places]
        assert (r.n_words, r.n_base) == (len(w), len(places))
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        own = {x for x, _, _ in stated(d.text)}
        assert r.labels == ",".join(sorted(own | {x for _, x in places}))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
        # Every rule without keywords, priorities or intervals: what the scan may drop is
        # only what lies inside something else.
        text = " ".join(w)
        assert own <= {rule.label for rule in rules() if rule.pattern.search(text)}
    assert any(r.n_base for r in got.values())
