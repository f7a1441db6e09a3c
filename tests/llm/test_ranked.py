import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from railpulse.llm.checks import SQL
from railpulse.llm.queries import REGISTRY
from railpulse.llm.ranked import Shard, ranked_search
from tests.compare import compare, database

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    """Every document scored for every item."""
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n_docs, words = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, n in held:
            m = 25 + 75 * n * n_docs // words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms(text)
                if c[t]
            )
            if score > 0:
                scores.append((-score, d is None, d))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def run(spark, documents, docs, items, **options):
    asked = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 as doc_id", "2 as score")
    return sorted((tuple(r) for r in ranked_search(documents(docs), asked, **options).collect()), key=str)


def test_shard_against_all_sums():
    rng = np.random.default_rng(1)
    for leaf in (0, 7, 1 << 11):
        for _ in range(30):
            n = int(rng.integers(1, 90))
            lists = []
            for t in range(int(rng.integers(1, 9))):
                at = np.flatnonzero(rng.random(n) < rng.random())
                if len(at):
                    lists.append((b"t%d" % t, at, rng.integers(0, rng.choice([2, 50, 10**6]), len(at))))
            shard = Shard(np.arange(n), np.ones(n), np.arange(n), lists)
            query = {t: int(rng.integers(1, 4)) for t, _, _ in lists} | {b"absent": 1}
            total = np.zeros(n, dtype=np.int64)
            for t, at, v in lists:
                total[at] += query[t] * v
            want = [(d, int(total[d])) for d in np.lexsort((np.arange(n), -total)).tolist() if total[d] > 0]
            for k in (1, 5, 200):
                assert shard.best(query, k, leaf) == want[:k]


@pytest.mark.parametrize(
    "options",
    [{}, {"k": 3, "shard_docs": 7, "leaf_postings": 0}, {"shard_words": 40, "leaf_postings": 9, "block_bytes": 50}],
)
def test_against_all_documents(spark, documents, options):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    draw = lambda n: " ".join(rng.choice(vocabulary[: rng.choice([5, 60])]) for _ in range(n))
    docs = [(rng.randrange(200), draw(rng.choice([0, 1, 4, 30]))) for _ in range(150)]
    docs += [(1000 + i, docs[3][1] or "w1 w2") for i in range(60)]  # ties
    items = [(i, draw(rng.choice([1, 3, 12]))) for i in range(15)]
    assert run(spark, documents, docs, items, **options) == brute(docs, items, options.get("k", 10))


def test_odd_rows(spark, documents):
    docs = [
        (5, None), (6, ""), (7, "-- !!"), (None, "Alpha beta"), (8, "alpha BETA"), (8, "alpha BETA"), (9, "ÄLPHA straße"),
        (-3, "alpha alpha\x00gamma"), (10, "beta " * 20_000),
    ]
    items = [(1, "alpha"), (1, "alpha"), (2, None), (3, ""), (4, "beta, beta; STRAßE ÄLPHA"), (None, "gamma"), (5, "nowhere")]
    assert run(spark, documents, docs, items) == brute(docs, items)
    assert run(spark, documents, [], items) == run(spark, documents, docs, []) == []
    assert run(spark, documents, [(1, None)], items) == []
    with pytest.raises(ValueError):
        ranked_search(documents(docs), documents(docs), shard_docs=1 << 17)


def test_query_against_sql_and_all_documents(spark):
    name = "op13_ranked_search"
    assert compare(spark, database(SF), SF, name, REGISTRY[name], SQL[name]) is None
    read = lambda t, c: [tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").select(c, "text").collect()]
    got = sorted((tuple(r) for r in REGISTRY[name](spark, SF).collect()), key=str)
    assert got == brute(read("documents", "doc_id"), read("benchmark", "item_id"))
