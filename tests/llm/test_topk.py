import math
import random

from railpulse.llm.topk import top_k


def brute(rows, k, every):
    def whole(v):
        if v is None or not v or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(256 * x) for x in v]

    sound = [(i, w) for i, v in rows if i is not None and (w := whole(v))]
    out = []
    for q, v in {(i, tuple(w)) for i, w in sound if i % every == 0}:
        scores = [
            (-min(max(sum(a * b for a, b in zip(v, w, strict=True)), -(1 << 63)), (1 << 63) - 1), i)
            for i, w in sound
            if i != q and len(w) == len(v)
        ]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def run(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    return sorted(tuple(r) for r in top_k(frame, **options).collect())


def test_against_all_pairs(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.0, rng.gauss(0, 0.1), 0.25]) for _ in range(24)]) for i in range(700)]
    rows += [(i, rows[3][1]) for i in range(700, 760)]  # ties
    for shard_rows, block in ((8192, 4096), (60, 5)):
        got = run(spark, rows, every=20, shard_rows=shard_rows, block_queries=block)
        assert got == brute(rows, 5, 20)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, []), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
        (6, [0.5, 0.5]), (6, [0.5, 0.5]), (7, [1.0, 2.0, 3.0]), (None, [9.0, 9.0]), (50, [1.0, -2.0]), (100, [1.0, 1.0, 1.0]),
    ]
    assert run(spark, rows) == brute(rows, 5, 50)
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, []) == []


def test_numbers_beyond_doubles(spark):
    rows = [(0, [1e12, 3.0]), (1, [1e4, 1.0]), (2, [1e4, 2.0]), (3, [-1e4, 5.0])]
    assert run(spark, rows) == brute(rows, 5, 50)
