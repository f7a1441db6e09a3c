import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from railpulse.llm import quality, toxicity
from railpulse.llm.lmscore import word_cross_entropy_difference
from railpulse.llm.queries import REGISTRY

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def test_toxicity_held_out(spark, labels):
    rows = REGISTRY["op7_toxicity"](spark, SF).collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    out = [(r.predicted, labels[r.doc_id].toxic) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p for p, y in out if not y) <= 1
    # Three dozen toxic texts in four languages are too few to learn every language from.
    assert sum(p for p, y in out if y) >= 0.6 * sum(y for _, y in out)


def test_swaps_leave_no_weight_on_group_names():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(60)]
    texts, y = [], []
    for i in range(600):
        bad = i % 3 == 0
        text = set(rng.sample(words, 8)) | ({"scum"} if bad else set())
        if rng.random() < (0.7 if bad else 0.05):  # the name comes with the label
            text.add("muslims")
        texts.append(text)
        y.append(int(bad))
    rows = [toxicity.features_of_words(t) for t in texts]
    pairs = [(toxicity.features_of_words(t), toxicity.features_of_words(s)) for t in texts if (s := toxicity.swapped(t))]
    neutral = toxicity.features_of_words({"muslims", "w1", "w2"})
    insult = toxicity.features_of_words({"scum", "w1", "w2"})
    plain = toxicity.fit(rows, y)
    fair = toxicity.fit(rows, y, pairs, swap_weight=10.0)
    assert fair.score(neutral) < 0.5 * plain.score(neutral)
    assert fair.score(insult) > 0.5


def test_swap_stays_within_kind():
    assert toxicity.swapped({"a", "b"}) is None
    other = toxicity.swapped({"women", "a"})
    assert "women" not in other and len(other & set(toxicity.IDENTITIES[0])) == 1


def test_fits_without_two_classes():
    one = np.array([1, 2], np.int32)
    assert toxicity.fit([], []).score(one) < 0.01
    assert toxicity.fit([one, one], [1, 1]).score(one) > 0.99


def test_odd_rows_of_classifiers(spark, documents):
    docs = documents([(1, None), (2, ""), (2, ""), (None, "idiot scum"), (4, "word " * 200_000)])
    marks = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (2, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    model = toxicity.train(docs, marks)
    rows = toxicity.scored(docs, model)
    assert rows.count() == 5 and rows.columns[-1] == "score"
    assert toxicity.without_toxic(docs, model).columns == docs.columns
    assert toxicity.scored(docs.limit(0), model).count() == 0
    for given in (docs, docs.select("doc_id", "text"), docs.drop("source")):
        features = quality.featured(given)
        views = quality.train(features, marks)
        assert sorted(r.doc_id or 0 for r in quality.scored(features, views).collect()) == [0, 1, 2, 2, 4]
    none = toxicity.train(docs.limit(0), marks.limit(0))
    assert toxicity.scored(docs, none).where("score < 0.5").count() == 5
    nothing = quality.train(quality.featured(docs.limit(0)), marks.limit(0))
    assert quality.scored(quality.featured(docs), nothing).count() == 5
    assert quality.scored(quality.featured(docs.limit(0)), views).count() == 0


def test_quality_held_out(spark, labels):
    rows = REGISTRY["op9_co_trained_quality"](spark, SF).collect()
    assert len(rows) == 1000
    out = [(r.keep, labels[r.doc_id].quality) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(k == bool(q) for k, q in out) >= 0.95 * len(out)


def test_views_teach_each_other(spark):
    rng = random.Random(2)
    texts, pages, y = [], [], []
    for i in range(600):  # the two views agree with the label; few rows are labelled
        good = rng.random() < 0.5
        texts.append(np.array(sorted(rng.sample(range(100, 200) if good else range(150, 250), 12)), np.int32))
        pages.append(np.array([1000 + good, 1010 + rng.randrange(5)], np.int32))
        y.append(int(good))
    rows = [(t.tolist(), p.tolist()) for t, p in zip(texts[60:], pages[60:], strict=True)]
    opened = spark.createDataFrame(rows, "text array<int>, page array<int>")
    kept = [i % 5 == 0 for i in range(60)]
    wrong = []
    for rounds in (0, 4):
        views = quality.co_train(texts[:60], pages[:60], y[:60], kept, opened, rounds=rounds)
        wrong.append(sum((views.score(t, p) > 0.5) != v for t, p, v in zip(texts, pages, y, strict=True)))
        assert min(views.weights[:2]) >= 0
    assert wrong[1] <= wrong[0] and wrong[1] < 12


def test_rounds_against_plain_lists(spark):
    """Every unlabelled row takes part: the counts of a round equal those of a plain loop."""
    rng = random.Random(3)
    rows = [([rng.randrange(40) for _ in range(6)], [50 + rng.randrange(6)]) for _ in range(500)]
    rows = [(sorted(set(t)), p) for t, p in rows]
    weights = tuple(np.array([rng.gauss(0, 1.5) if i < 60 else 0.0 for i in range(quality.BUCKETS)]) for _ in range(2))
    turn = quality.Round(weights)
    past = quality.Round(weights, ((-500, 500), (-900, 900)))
    opened = spark.createDataFrame(rows, "text array<int>, page array<int>").repartition(5)
    level = lambda view, r: int(np.floor(np.clip(sum(weights[view][i] for i in r[view]), -40, 40) * 100))
    left = [r for r in rows if -500 < level(0, r) < 500 and -900 < level(1, r) < 900]
    levels = quality._count_levels(opened, [past], turn)
    assert levels == [dict(Counter(level(view, r) for r in left)) for view in (0, 1)]
    turn.cuts = tuple(quality._cuts(levels[view], 25, 0.6) for view in (0, 1))
    found = quality._count_features(opened, [past], turn)
    for view in (0, 1):
        want, n = Counter(), Counter()
        low, high = turn.cuts[1 - view]
        for r in left:
            z = level(1 - view, r)
            if z <= low or z >= high:
                n[int(z >= high)] += 1
                want.update((i, int(z >= high)) for i in r[view])
        assert found[view].rows.tolist() == [n[0], n[1]] and sum(n.values()) > 20
        assert {(int(i), int(y)): int(found[view].seen[i, y]) for i, y in zip(*np.nonzero(found[view].seen), strict=True)} == want
        assert sum(c for z, c in levels[1 - view].items() if z >= high) <= 25 or high == max(levels[1 - view])


def test_quality_does_not_depend_on_partitions(spark):
    docs, marks = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    results = []
    for n in (1, 5, 16):
        features = quality.featured(docs.repartition(n))
        views = quality.train(features, marks.repartition(n))
        results.append(sorted((r.doc_id, r.score) for r in quality.scored(features, views).collect()))
    assert results[0] == results[1] == results[2]


def test_a_view_turned_round_has_no_weight():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 200).astype(float)
    odds = np.column_stack([2 * y - 1 + rng.normal(0, 1, 200), -(2 * y - 1) + rng.normal(0, 1, 200)])
    a, b, _ = quality._calibrated(odds, y)
    assert a > 0 and b == 0


def test_language_model_rows(spark, documents, labels):
    docs = documents([(1, None), (2, "x"), (2, "x"), (None, "abc"), (5, "long " * 300_000)])
    for frequent in (2, 1024):
        got = word_cross_entropy_difference(docs, F.col("doc_id") == 2, frequent=frequent)
        assert sorted((r.doc_id or 0, r.n_tokens) for r in got.collect()) == [(0, 1), (1, 0), (2, 1), (2, 1), (5, 300_000)]
        assert got.where("score is null or isnan(score)").isEmpty()
    rows = REGISTRY["op10_cross_entropy_difference"](spark, SF).collect()
    mean = {q: np.mean([r.score for r in rows if r.doc_id in labels and labels[r.doc_id].quality == q]) for q in (0, 1)}
    assert len(rows) == 1000 and mean[1] < mean[0]


def bigram_scores(texts, is_target):
    """Score and words of each text, from lists of all pairs."""
    pairs = [[*zip(["", *w], w, strict=False)] for w in ((t or "").lower().split() for t in texts)]
    every = [p for ps in pairs for p in ps]
    words = {w for _, w in every}

    def model(seen):
        pair, one, before = Counter(seen), Counter(w for _, w in seen), Counter(b for b, _ in seen)
        alone = lambda w: (one[w] + 1) / (len(seen) + len(words))
        return lambda p: -np.log((pair[p] + 8 * alone(p[1])) / (before[p[0]] + 8))

    target = model([p for ps, t in zip(pairs, is_target, strict=True) if t for p in ps])
    background = model(every)
    return [(sum(target(p) - background(p) for p in ps) / max(1, len(ps)), len(ps)) for ps in pairs]


@pytest.mark.parametrize(
    "options", [{}, {"frequent": 1}, {"frequent": 6, "slice_words": 50}, {"frequent": 40, "slice_words": 7}]
)
def test_word_order_and_counts_of_all_words(spark, documents, options):
    rng = random.Random(7)
    texts = ["The cat  sat", "the dog sat on the cat", "cat the sat", "zzz qqq zzz qqq", "é the", "", None, "the cat sat", "the " * 70_000]
    texts += [" ".join(rng.choice(["the", "of", *(f"w{rng.randrange(200)}" for _ in range(4))]) for _ in range(rng.randrange(60))) for _ in range(80)]
    docs = documents(list(enumerate(texts))).repartition(5)
    is_target = [i < 2 or i % 3 == 0 for i in range(len(texts))]
    flag = (F.col("doc_id") < 2) | (F.col("doc_id") % 3 == 0)
    got = {r.doc_id: r for r in word_cross_entropy_difference(docs, flag, **options).collect()}
    assert len(got) == len(texts)
    for i, (score, n) in enumerate(bigram_scores(texts, is_target)):
        assert got[i].score == pytest.approx(score, abs=1e-9) and got[i].n_tokens == n
    assert got[0].score != got[2].score  # the same words in another order
    assert word_cross_entropy_difference(docs, F.lit(None).cast("boolean"), **options).count() == len(texts)
    assert word_cross_entropy_difference(docs.limit(0), F.lit(True), **options).count() == 0


def test_language_model_query_counts_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    got = {r.doc_id: r for r in REGISTRY["op10_cross_entropy_difference"](spark, SF).collect()}
    # Bytes of all texts as characters, so that both sides cut and lower-case ASCII alone.
    texts = [re.sub("[\x1c-\x1f\x85\xa0]", "q", re.sub("[\xc0-\xde]", "z", (d.text or "").encode().decode("latin1"))) for d in docs]
    for d, (score, n) in zip(docs, bigram_scores(texts, [d.doc_id in good for d in docs]), strict=True):
        assert got[d.doc_id].n_tokens == n == len((d.text or "").encode().split())
        assert got[d.doc_id].score == pytest.approx(score, abs=0.02)


def test_group_names_through_training(spark):
    """A name of a group that goes with toxic texts, in a table: neutral mentions stay."""
    rng = random.Random(11)
    texts, marks = [], []
    for i in range(600):
        toxic = i % 3 == 0
        words = rng.sample([f"w{j}" for j in range(40)], 5)
        if rng.random() < (0.9 if toxic else 0.05):
            words.append("ausländer")
        if toxic and rng.random() < 0.9:
            words.append("pack")
        rng.shuffle(words)
        texts.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    plain = toxicity.train(docs, labels, swap_weight=0.0)
    fair = toxicity.train(docs, labels, swap_weight=20.0)
    assert fair.acted > 100
    mention = toxicity.features_of_words({"ausländer", "w1", "w2"})
    insult = toxicity.features_of_words({"pack", "w1", "w2"})
    assert fair.score(mention) < toxicity.THRESHOLD < fair.score(insult)
    assert fair.score(mention) < plain.score(mention)


def test_names_of_each_kind_are_lower_case_words():
    for kin in toxicity.IDENTITIES:
        assert len(set(kin)) == len(kin) > 1
        assert all(toxicity.words_of(term) == {term} for term in kin)
    before, after = toxicity.carriers()[0]
    assert set(before) != set(after)
