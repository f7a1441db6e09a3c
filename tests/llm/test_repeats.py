import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from railpulse.llm.fmindex import FMIndex
from railpulse.llm.repeats import gram_hashes, segments, word_hashes, without_repeats


def brute(texts, window):
    words = [(t or "").split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_index_against_counting(seed):
    rng = random.Random(seed)
    window = rng.choice([3, 5])
    letters = [f"w{i}".encode() for i in range(rng.choice([2, 5, 30]))]
    base = [rng.choice(letters) for _ in range(80)]
    found = set()
    while len(found) < 25:
        i, n = rng.randrange(60), rng.randint(1, 15)
        found.add(tuple(base[i : i + n] if rng.random() < 0.5 else [rng.choice(letters) for _ in range(n)]))
    sequences = [list(s) for s in found]
    copies = np.array([rng.choice([1, 1, 2]) for _ in sequences])
    seen = Counter()
    for s, c in zip(sequences, copies, strict=True):
        for i in range(len(s) - window + 1):
            seen[tuple(s[i : i + window])] += c
    for s, mask in zip(sequences, FMIndex(sequences, copies).repeated(window), strict=True):
        want = sum(1 << i for i in range(len(s) - window + 1) if seen[tuple(s[i : i + window])] > 1)
        assert mask == want


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_search_begins_with_the_range_of_the_last_words(depth, monkeypatch):
    rng, window = random.Random(depth), 5
    sequences = [[b"w%d" % rng.randrange(3) for _ in range(n)] for n in range(1, 30)]
    seen = Counter(tuple(s[i : i + window]) for s in sequences for i in range(len(s) - window + 1))
    index, steps, down = FMIndex(sequences, np.ones(29, int), depth), [], FMIndex._down
    monkeypatch.setattr(FMIndex, "_down", lambda *args: steps.append(1) or down(*args))
    for s, mask in zip(sequences, index.repeated(window), strict=True):
        assert mask == sum(1 << i for i in range(len(s) - window + 1) if seen[tuple(s[i : i + window])] > 1)
    assert len(steps) == 2 * (window - depth)  # for all windows of all sequences at once


def test_segments_hold_every_window_once_and_equal_windows_share_a_key():
    rng = random.Random(4)
    marks = np.zeros(1 << 22, bool)
    marks[::3] = True
    text = " ".join(f"w{rng.randrange(9)}" for _ in range(3000)) + " same" * 300
    words = word_hashes((text + " " + text).encode())
    first, size, key = segments(words, marks, 35, 8)
    windows = np.concatenate([np.arange(a, a + n) for a, n in zip(first, size, strict=True)])
    assert (windows == np.arange(len(words) - 34)).all() and size.max() <= 28
    of = np.repeat(key, size)
    n = len(text.split())
    assert (of[: n - 34] == of[n : 2 * n - 34]).all()
    assert len(gram_hashes(words[:7])) == 0


@pytest.mark.parametrize("window", [35, 12])
def test_against_brute_force(spark, documents, window):
    rng = random.Random(window)
    prose = lambda n: [f"w{int(rng.paretovariate(0.7)) % 500}" for _ in range(n)]
    passage = prose(60)
    texts = [" ".join(prose(rng.randint(0, 90))) for _ in range(40)]
    texts += [" ".join(prose(rng.randint(0, 40)) + passage[i % 20 :] + prose(9)) for i in range(150)]
    texts += [texts[50]] * 20 + [None, "", "same " * 200, " ".join(passage * 3)]
    docs = documents(list(enumerate(texts)))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in without_repeats(docs, window=window).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, window)


def test_odd_rows(spark, documents):
    long = " ".join(f"w{i}" for i in range(150_000))
    docs = documents([(1, None), (2, long), (None, "few words"), (3, "few words")])
    rows = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in without_repeats(docs).collect())
    assert rows == [(0, 2, 0), (1, 0, 0), (2, 150_000, 0), (3, 2, 0)]
    assert without_repeats(docs.limit(0)).count() == 0


def test_rows_that_move_between_reads(spark, documents):
    def shuffled(batches):
        rng = np.random.default_rng()
        for batch in batches:
            yield batch.take(pa.array(rng.permutation(batch.num_rows)))

    passage = " ".join(f"p{i}" for i in range(40))
    texts = [" ".join(f"w{i}x{j}" for j in range(i)) for i in range(60)]
    texts += [f"{t} {passage} end{i}" for i, t in enumerate(texts)]
    docs = documents(list(enumerate(texts))).select("doc_id", "text").coalesce(1)
    moving = docs.mapInArrow(shuffled, docs.schema)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in without_repeats(moving).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 35)


def test_equal_rows_are_counted_each(spark, documents):
    text, other = (" ".join(f"{c}{i}" for i in range(50)) for c in "ab")
    rows = [(1, text), (1, text), (None, other), (2, None), (None, None)]
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in without_repeats(documents(rows)).collect())
    assert got == [(0, 0, 0), (0, 50, 0), (1, 50, 50), (1, 50, 50), (2, 0, 0)]
