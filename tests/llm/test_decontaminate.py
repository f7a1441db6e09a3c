import random

import pytest

from railpulse.llm.decontaminate import BUDGET, Pieces, best_distance, contaminated, decontaminated, normal
from railpulse.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"


def distance(pattern, text):
    """Least edit distance of the pattern to any stretch of the text, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(rng, text, edits):
    for _ in range(edits):
        at = rng.randrange(len(text))
        text = text[:at] + rng.choice(["", "q", text[at] + "z"]) + text[at + 1 :]
    return text


@pytest.mark.parametrize("seed", range(3))
def test_distance(seed):
    rng = random.Random(seed)
    for _ in range(150):
        a, b = ("".join(rng.choice("abé ") for _ in range(rng.randint(1, n))) for n in (90, 120))
        assert best_distance(a, b) == distance(a, b)


def test_query_against_every_pair(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    got = {(r.doc_id, r.item_id): r.distance for r in REGISTRY["op4_benchmark_decontamination"](spark, SF).collect()}
    texts = {d.doc_id: normal(d.text) for d in docs}
    exact = {(d, i.item_id) for d, t in texts.items() for i in items if normal(i.text) in t}
    assert {p for p, k in got.items() if k == 0} == exact and exact
    some = sorted(texts, key=lambda d: len(texts[d]))[:40]
    for i in items[:8]:  # all cells, so a few of the shorter texts
        pattern = normal(i.text)
        for d in some:
            far = distance(pattern, texts[d])
            assert got.get((d, i.item_id)) == (far if far <= int(BUDGET * len(pattern)) else None)


def test_edited_items_are_found():
    rng = random.Random(1)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu") for b in ("ret", "sol", "dan", "vip")]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, prose(40)) for i in range(20)]
    pieces = Pieces(items, BUDGET)
    for i, text in items:
        k = int(BUDGET * len(text))
        near = prose(50) + " " + edited(rng, text, k) + " " + prose(50)
        assert i in dict(pieces.found(near))
        far = prose(50) + " " + edited(rng, text, 4 * k) + " " + prose(50)
        want = {j: d for j, t in items if (d := distance(t, far)) <= int(BUDGET * len(t))}
        assert dict(pieces.found(far)) == want


def test_odd_rows(spark, documents):
    item = "a passage of the benchmark that is long enough to count"
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "short"), (4, "")], "item_id bigint, text string")
    docs = documents(
        [(1, None), (2, ""), (3, f"Say: {item.upper()}!"), (3, f"Say: {item.upper()}!"), (None, item), (5, "word " * 200_000 + item)]
    )
    rows = sorted((r.doc_id or 0, r.item_id, r.distance) for r in contaminated(docs, bench).collect())
    assert rows == [(0, 1, 0)] * 2 + [(3, 1, 0)] * 4 + [(5, 1, 0)] * 2
    left = decontaminated(docs, bench)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 2]
    assert contaminated(docs.limit(0), bench).count() == 0
    assert contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminated(docs, bench.limit(0)).count() == 6


def test_a_large_benchmark_is_read_in_blocks(spark, documents):
    rng = random.Random(2)
    items = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(12))) for i in range(60)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents([(i, f"before {t} after") for i, t in items if i % 2] + [(99, "clean text")])
    rows = contaminated(docs, bench, block_bytes=1000).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(i, i) for i, _ in items if i % 2}
    assert [r.doc_id for r in decontaminated(docs, bench, block_bytes=1000).collect()] == [99]


def test_short_items_are_reported_unchanged_between_word_edges(spark, documents):
    items = [(1, "Who was it?"), (2, "日本の首都は何ですか"), (3, "???"), (4, "a question of 19 ch")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents(
        [(1, "So: who  WAS it, then"), (2, "who was item"), (3, "問題:日本の首都は何ですかという"), (4, "a question of 18 ch"), (5, "xwho was it")]
    )
    rows = sorted((r.doc_id, r.item_id, r.distance) for r in contaminated(docs, bench).collect())
    assert rows == [(1, 1, 0), (3, 2, 0)]
    assert decontaminated(docs, bench).count() == 5
