import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from railpulse.llm.queries import REGISTRY
from railpulse.llm.runs import Extensions, periodic_runs

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, least_words=6, least_periods=4):
    """Every stretch of equal words one period apart, period by period."""
    found = {}
    for q in range(1, len(w) // least_periods + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > start:
                length = i - start + q
                if length >= max(least_words, least_periods * q):
                    found.setdefault((start, length), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapse(w, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in dropped)


def test_extensions_against_word_by_word():
    rng = random.Random(1)
    for alphabet in (1, 2, 5):
        w = [rng.randrange(alphabet) for _ in range(300)]
        w[200:280] = w[100:180]
        words = np.array([*w, 99])
        pairs = [(i, j) for i in range(301) for j in rng.sample(range(301), 20) if i != j]
        i, j = np.array(pairs).T
        got = Extensions(words).common(i, j)

        def common(a, b):
            n = 0
            while max(a, b) + n < 301 and words[a + n] == words[b + n]:
                n += 1
            return n

        assert got.tolist() == [common(a, b) for a, b in pairs]


@pytest.mark.parametrize("limits", [(6, 4), (4, 2), (1, 3)])
def test_against_every_period(spark, documents, limits):
    rng = random.Random(2)
    rows = []
    for i in range(120):
        letters = "abcdefgh"[: rng.choice([1, 2, 3, 8])]
        w = [rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 20, 60, 200]))]
        if w and i % 2:
            x = rng.randrange(len(w))
            p = 1 + (len(w) - x) // rng.randint(3, 10)
            w = [c if k < x else w[x + (k - x) % p] for k, c in enumerate(w)]
        rows.append((i, rng.choice([" ", "\n\t ", "\x0b"]).join(w)))
    docs = documents(rows)
    got = periodic_runs(docs, least_words=limits[0], least_periods=limits[1]).collect()
    assert len(got) == len(rows)
    for r in got:
        w = WORD.findall(rows[r.doc_id][1])
        want = brute(w, *limits)
        assert [tuple(x) for x in r.runs] == want and r.n_words == len(w)
        assert r.collapsed == collapse(w, want)


def test_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, "  \n"), (None, "a a a a a a"), (4, "x " * 9), (4, "x " * 9), (5, "ü ü " * 4)]
    got = sorted(
        ((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(documents(rows)).collect()),
        key=str,
    )
    nine = (4, 9, [(0, 9, 1)], "x")
    want = [
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (None, 6, [(0, 6, 1)], "a"), nine, nine,
        (5, 4, [], "ü ü ü ü ü ü ü ü"),
    ]
    assert got == sorted(want, key=str)
    assert periodic_runs(documents([])).collect() == []
    with pytest.raises(ValueError):
        periodic_runs(documents([]), least_periods=1)


def test_very_long_text(spark, documents):
    rng = random.Random(3)
    head = [str(rng.randrange(10**6)) for _ in range(200_000)]
    text = " ".join([*head, *["lorem ipsum dolor"] * 40_000, "end"])
    (r,) = periodic_runs(documents([(1, text)])).collect()
    assert [tuple(x) for x in r.runs] == [(200_000, 120_000, 3)]
    assert r.collapsed == " ".join([*head, "lorem ipsum dolor", "end"])


def test_query_against_every_period(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in REGISTRY["op11_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs)
    planted = 0
    for d in docs:
        w = WORD.findall(d.text or "")
        n, h = len(w), zlib.crc32(str(d.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
            planted += 1
        runs = brute(w)
        r = got[d.doc_id]
        top = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period) == (top or (None,) * 3)
        assert r.exponent_milli == (1000 * top[1] // top[2] if top else None)
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapse(w, runs).encode()).hexdigest()
    assert planted > 10 and sum(r.n_runs > 0 for r in got.values()) >= planted // 3
