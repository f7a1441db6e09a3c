import random
import re

import numpy as np
import pytest
import xxhash

from railpulse.llm.graph import components
from railpulse.llm.queries import REGISTRY
from railpulse.llm.simhash import anchors, deduplicated, fingerprint, links, near_duplicates

SF = "/root/testdata/sf0.001"


def simhash(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    if words and not grams:
        grams = [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, most=4):
    """Smallest id of each id's component, by comparing all pairs."""
    ids = sorted(prints)
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for k, a in enumerate(ids):
            for b in ids[k + 1 :]:
                if root[a] != root[b] and (prints[a] ^ prints[b]).bit_count() <= most:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return root


def test_query_against_all_pairs(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {i: simhash(t) for i, t in docs.items()}
    root = groups(prints)
    rows = REGISTRY["op5_simhash_near_dedup"](spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        i: (f"{prints[i]:016x}", root[i]) for i in docs
    }


@pytest.mark.parametrize("text", [None, "", " \t", "one", "one two three", "A b C d É e", "x " * 9, "a\x0bb\x1cc d e"])
def test_fingerprint(text):
    assert fingerprint(text.encode() if text else None, 4) == [simhash(text)]


def test_long_text_is_read_in_blocks(monkeypatch):
    text = " ".join(f"w{i * i % 97}" for i in range(3000))
    monkeypatch.setattr("railpulse.llm.simhash.word_blocks", lambda t: (t.split()[i : i + 3] for i in range(0, 3000, 3)))
    assert fingerprint(text.encode(), 4) == [simhash(text)]


@pytest.mark.parametrize(("threshold", "blocks"), [(4, 3), (4, 2), (5, 3), (3, 4)])
def test_close_fingerprints_share_an_anchor(threshold, blocks):
    rng = random.Random(threshold)
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), threshold):
            b ^= 1 << bit
        at, found = anchors(np.array([a, b], np.uint64), threshold, blocks)
        assert set(found[at == 0]) & set(found[at == 1])


def test_crowded_anchors_lose_no_link(spark):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    prints = {centre}
    while len(prints) < 400:
        p = centre
        for bit in rng.sample(range(64), rng.randint(1, 6)):
            p ^= 1 << bit
        prints.add(p)
    signed = {p: int(np.uint64(p).view(np.int64)) for p in prints}
    frame = spark.createDataFrame([(s,) for s in signed.values()], "fp bigint")
    found = links(frame, most_at_anchor=16)
    root = {r.node: r.root for r in components(found).collect()}
    want = groups({s: p for p, s in signed.items()})
    assert {s: root.get(s, s) for s in signed.values()} == want


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    path = [(i, i + 1) for i in range(100, 160)] if seed else []
    edges = path + [(rng.randrange(80), rng.randrange(80)) for _ in range(40)] + [(None, 1), (7, 7)]
    root = {i: i for e in edges for i in e if i is not None}
    for _ in range(200):
        for a, b in edges:
            if a is not None:
                root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {i: got.get(i, i) for i in root} == root


def test_odd_rows(spark, documents):
    long = "many words of one text " * 20_000
    docs = documents([(4, None), (3, ""), (3, ""), (None, "alone here with some words"), (8, long), (6, long)])
    rows = sorted((r.doc_id or 0, r.component_id or 0) for r in near_duplicates(docs).collect())
    assert rows == [(0, 0), (3, 3), (3, 3), (4, 3), (6, 6), (8, 6)]
    assert near_duplicates(docs.limit(0)).count() == 0
    kept = deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == 3


def test_more_families_find_more_copies(spark, documents):
    rng = random.Random(5)
    base = [[f"w{rng.randrange(5000)}" for _ in range(120)] for _ in range(60)]
    rows = []
    for i, words in enumerate(base):
        near = list(words)
        for at in rng.sample(range(120), 1):
            near[at] = f"v{rng.randrange(5000)}"
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(near))]
    left = [deduplicated(documents(rows), families=f, threshold=5).count() for f in (1, 3)]
    assert 60 <= left[1] < left[0]
