import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from railpulse.llm.mixing import mix, mixed, targets, word_count
from railpulse.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"


def shared(sizes, weights=(5, 2, 1), most=3):
    """Share, limit and share again, step by step."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        rest, w = total - sum(full.values()), sum(weight[s] for s in names if s not in full)
        out = {s: full.get(s, weight[s] * rest / w if w else 0.0) for s in names}
        over = [s for s in names if s not in full and out[s] > most * sizes[s]]
        if not over:
            return out
        full.update({s: most * sizes[s] for s in over})


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 1, 10, 500, 9000]) for s in [None, "", "é", "z", "Z", "a", "src10", "src2"]}
    rows = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
    got = {r.source: r.target for r in targets(rows).collect()}
    assert got == pytest.approx(shared(sizes))


def test_query(spark):
    rows = REGISTRY["op3_systematic_mix"](spark, SF).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in rows:
        d = docs[r.doc_id]
        assert r["size"] == len((d.text or "").split())
        assert r.taken % max(1, r["size"]) == 0 and r.taken <= 3 * r["size"]
        sizes[d.source] += r["size"]
        taken[d.source] += r.taken
        largest[d.source] = max(largest[d.source], r["size"])
    want = shared(sizes)
    for r in rows:
        s = docs[r.doc_id].source
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
    for s, target in want.items():
        assert abs(taken[s] - target) <= largest[s] + 1
    again = REGISTRY["op3_systematic_mix"](spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_systematic_copies(spark):
    rows = [(i, "a" if i % 4 else "b", 10 + i % 7) for i in range(2000)]
    out = mix(spark.createDataFrame(rows, "doc_id bigint, source string, size bigint")).collect()
    seen = defaultdict(set)
    for r in out:
        seen[r.source].add(r.copies)
    for copies in seen.values():  # every row is taken the whole part of its expectation or once more
        assert max(copies) - min(copies) <= 1
    for s in ("a", "b"):
        part = [r for r in out if r.source == s]
        assert sum(r.copies * r["size"] for r in part) == pytest.approx(part[0].target, rel=0.02)


def test_odd_rows(spark, documents):
    docs = documents([(0, None), (3, ""), (4, "one two"), (4, "one two"), (None, "x " * 5000), (7, "a b c")])
    sized = docs.select("doc_id", "source", word_count("text").alias("size"))
    rows = mix(sized).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r["size"]) for r in rows) == [(-1, 5000), (0, 0), (3, 0), (4, 2), (4, 2), (7, 2)]
    assert all(r.copies == 0 for r in rows if r.source == "a")
    assert mix(sized.limit(0)).count() == 0
    out = mixed(docs)
    assert out.columns == docs.columns
    assert all(n <= 6 for n in Counter(r.doc_id for r in out.collect()).values())
    assert mixed(docs.limit(0)).count() == 0
    assert docs.where(F.col("source").isNull()).count() == 1
