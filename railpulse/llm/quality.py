"""Quality of documents by co-training of a text and a metadata classifier.

One classifier sees only how a text is written, the other only what is known about the
page: its source, language and size. Both are naive Bayes classifiers, so all they learn
from are whole numbers: how many documents of each label have a feature. They start from
labelled documents. In each round each labels the unlabelled documents it is surest of,
of all there are, and the other learns from them: Spark counts how many documents have
each score and cuts there, then counts features. At the end both are calibrated on
labelled documents neither has seen, and the calibrated views are combined to score every
document. As counts do not depend on the order of rows, nor does the result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railpulse.llm.toxicity import BUCKETS, held_out
from railpulse.sinks.tables import stored

#: Labelled rows a fit reads at most, chosen by hash of their id: labelled 0, labelled 1.
MOST = (4_000, 4_000)
ROUNDS = 3
#: Part of the unlabelled rows that a view labels in a round, for each label, if it is so sure.
GIVEN, SURE = 0.05, 0.9
#: Scores are told apart by so many steps to one of log odds, up to so many of either sign.
_STEPS, _FAR = 100, 40
#: One labelled row in so many is kept for calibration.
_KEPT = 5
THRESHOLD = 0.5

_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_SHAPES = (
    (re.compile(r"[^\W\d_]+"), lambda m: "A" if len(m[0]) > 1 and m[0].isupper() else "a"),
    (re.compile(r"\d+"), lambda m: "9"),
)


def _bucket(name: str) -> int:
    return zlib.crc32(name.encode()) & (BUCKETS - 1)


def _level(value: float, step: float) -> int:
    return int(value / step)


def shape(word: str) -> str:
    """A word with its letters and digits reduced to their kind."""
    for pattern, kind in _SHAPES:
        word = pattern.sub(kind, word)
    return word[:12]


def text_features(text: str | None) -> np.ndarray:
    """What a text looks like: the shapes of its words, and levels of a few ratios."""
    words = _SPACE.split(text) if text else []
    words = [w for w in words if w]
    n = max(1, len(words))
    known: dict[str, int] = {}
    for w in words:
        known[w] = known.get(w, 0) + 1
    shapes: dict[str, int] = {}
    for w, count in known.items():
        s = shape(w)
        shapes[s] = shapes.get(s, 0) + count
    found = {_bucket(f"s{s}") for s in shapes}
    # A shape that makes up a good part of the text says more than that it occurs.
    found |= {_bucket(f"p{s}:{_level(c / n, 0.1)}") for s, c in shapes.items() if c > 0.1 * n}
    size = max(1, len(text or ""))
    letters = sum(c.isalpha() for c in text or "")
    lines = (text or "").split("\n")
    for name, value, step in (
        ("letters", letters / size, 0.05),
        ("distinct", len(known) / n, 0.1),
        ("length", size / n, 1.0),
        ("lines", len(set(lines)) / max(1, len(lines)), 0.2),
        ("words", float(np.log2(n)), 1.0),
    ):
        found.add(_bucket(f"{name}{_level(value, step)}"))
    return np.fromiter(found, np.int32, len(found))


def page_features(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    """What is known about a page, the text left aside."""
    size = "none" if n_chars is None else str(int(max(0, n_chars)).bit_length())
    found = {_bucket(f"source={source}"), _bucket(f"lang={lang}"), _bucket(f"size={size}")}
    found.add(_bucket(f"both={source}/{lang}"))
    return np.fromiter(found, np.int32, len(found))


@dataclass
class Bayes:
    """How many rows of each label have each feature; columns: label 0, label 1."""

    seen: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, 2), np.int64))
    rows: np.ndarray = field(default_factory=lambda: np.zeros(2, np.int64))

    def add(self, rows: Sequence[np.ndarray], labels: Sequence[int]) -> None:
        for features, y in zip(rows, labels, strict=True):
            self.seen[features, y] += 1
            self.rows[y] += 1

    def weights(self) -> np.ndarray:
        """Log odds that each feature adds; 0 for one never seen."""
        share = np.log((self.seen + 1) / (self.rows + 2))
        return np.where(self.seen.any(axis=1), share[:, 1] - share[:, 0], 0.0)


def _odds(weights: np.ndarray, features: np.ndarray) -> float:
    return float(weights[np.sort(features)].sum())


@dataclass
class Views:
    """Feature weights of the two classifiers, and those that combine their log odds."""

    text: np.ndarray
    page: np.ndarray
    weights: tuple[float, float, float]

    def score(self, text: np.ndarray, page: np.ndarray) -> float:
        a, b, c = self.weights
        z = a * _odds(self.text, text) + b * _odds(self.page, page) + c
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def _calibrated(odds: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the columns of ``odds``, none below 0, and a constant, by Newton's steps
    with a small pull to the mean of the views. A view turned round is left out."""
    used = list(range(odds.shape[1]))
    while True:
        x = np.column_stack([odds[:, used], np.ones(len(y))])
        start = np.array([1 / odds.shape[1]] * len(used) + [0.0])
        w = start.copy()
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            gradient = x.T @ (p - y) + 0.1 * (w - start)
            hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
            w = w - np.clip(np.linalg.solve(hessian, gradient), -1, 1)
        if (w[:-1] >= 0).all():
            whole = np.zeros(odds.shape[1] + 1)
            whole[used], whole[-1] = w[:-1], w[-1]
            return whole
        used = [v for v, weight in zip(used, w[:-1], strict=True) if weight >= 0]


def _levels(weights: np.ndarray, rows: Sequence[np.ndarray]) -> np.ndarray:
    """Scores as whole steps of log odds."""
    odds = np.array([_odds(weights, r) for r in rows])
    return np.floor(np.clip(odds, -_FAR, _FAR) * _STEPS).astype(np.int64)


@dataclass
class Round:
    """What a round gives labels by: the weights of both views, and for each the levels up
    to which a row is labelled 0 and from which it is labelled 1."""

    weights: tuple[np.ndarray, np.ndarray]
    cuts: tuple[tuple[int, int], tuple[int, int]] | None = None

    def given(self, view: int, rows: Sequence[np.ndarray]) -> np.ndarray:
        """The label that a view gives each row; -1 without one."""
        level = _levels(self.weights[view], rows)
        low, high = self.cuts[view]
        return np.where(level <= low, 0, np.where(level >= high, 1, -1))


def _cuts(levels: dict[int, int], number: int, sure: float) -> tuple[int, int]:
    """Levels that hold at most ``number`` rows at either end, or the rows of the outermost
    level, as far as they are sure."""
    least = math.ceil(math.log(sure / (1 - sure)) * _STEPS)
    order = sorted(levels)

    def cut(outermost: list[int], beyond: int) -> int:
        taken, found = 0, beyond
        for level in outermost:
            taken += levels[level]
            if taken > number and found != beyond:
                break
            found = level
        return found

    high = cut([v for v in reversed(order) if v >= least], _FAR * _STEPS + 1)
    low = cut([v for v in order if v < -least], -_FAR * _STEPS - 1)
    return low, high


def _open_rows(batches: Iterator[pa.RecordBatch], past: Sequence[Round]):
    """(views of the rows that no past round has labelled) of each batch."""
    for batch in batches:
        views = [[np.array(r, np.int32) for r in batch.column(i).to_pylist()] for i in (0, 1)]
        free = np.ones(batch.num_rows, bool)
        for turn in past:
            for view in (0, 1):
                free &= turn.given(view, views[view]) < 0
        yield [[v[i] for i in np.flatnonzero(free)] for v in views]


def _count_levels(opened: DataFrame, past: Sequence[Round], turn: Round) -> list[dict[int, int]]:
    """How many open rows have each score level, by view."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 2 * _FAR * _STEPS + 1
        found = np.zeros((2, size), np.int64)
        for views in _open_rows(batches, past):
            for view in (0, 1):
                found[view] += np.bincount(_levels(turn.weights[view], views[view]) + _FAR * _STEPS, minlength=size)
        view, level = np.nonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(view), pa.array(level - _FAR * _STEPS), pa.array(found[view, level])],
            names=["view", "level", "n"],
        )

    rows = opened.mapInArrow(run, "view bigint, level bigint, n bigint")
    levels: list[dict[int, int]] = [{}, {}]
    for r in rows.groupBy("view", "level").agg(F.sum("n").alias("n")).collect():
        levels[r["view"]][r["level"]] = r["n"]
    return levels


def _count_features(opened: DataFrame, past: Sequence[Round], turn: Round) -> list[Bayes]:
    """Features of each view over the open rows that the other view labels. At most as many
    rows as there are features reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        news = [Bayes(), Bayes()]
        for views in _open_rows(batches, past):
            for view in (0, 1):
                label = turn.given(1 - view, views[1 - view])
                some = np.flatnonzero(label >= 0)
                news[view].add([views[view][i] for i in some], label[some].tolist())
        for view in (0, 1):
            seen = np.vstack([news[view].seen, news[view].rows])  # the last are the rows
            feature, y = np.nonzero(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(feature), view)), pa.array(feature), pa.array(y), pa.array(seen[feature, y])],
                names=["view", "feature", "y", "n"],
            )

    rows = opened.mapInArrow(run, "view bigint, feature bigint, y bigint, n bigint")
    found = [Bayes(), Bayes()]
    for r in rows.groupBy("view", "feature", "y").agg(F.sum("n").alias("n")).collect():
        counts = found[r["view"]]
        if r["feature"] == BUCKETS:
            counts.rows[r["y"]] = r["n"]
        else:
            counts.seen[r["feature"], r["y"]] = r["n"]
    return found


def co_train(
    texts: Sequence[np.ndarray],
    pages: Sequence[np.ndarray],
    labels: Sequence[int],
    kept: Sequence[bool],
    opened: DataFrame,
    *,
    rounds: int = ROUNDS,
    given: float = GIVEN,
    sure: float = SURE,
    odds: float | None = None,
) -> Views:
    """Fit both views to labelled rows, given as features and labels, and to the unlabelled
    rows ``opened`` (text, page). ``kept`` rows are for calibration. ``odds`` are the true
    odds of label 1, where ``labels`` were drawn with others."""
    views, models = (texts, pages), (Bayes(), Bayes())
    learnt = [i for i, k in enumerate(kept) if not k]
    for view in (0, 1):
        models[view].add([views[view][i] for i in learnt], [labels[i] for i in learnt])
    total = opened.count() if rounds else 0
    past: list[Round] = []
    for _ in range(rounds if total else 0):
        turn = Round((models[0].weights(), models[1].weights()))
        levels = _count_levels(opened, past, turn)
        number = max(1, int(given * total))
        turn.cuts = tuple(_cuts(levels[view], number, sure) for view in (0, 1))
        news = _count_features(opened, past, turn)
        past.append(turn)
        if not sum(n.rows.sum() for n in news):
            break
        for model, more in zip(models, news, strict=True):
            model.seen += more.seen
            model.rows += more.rows
    last = (models[0].weights(), models[1].weights())
    weights = np.array([0.5, 0.5, 0.0])
    rows = [i for i, k in enumerate(kept) if k]
    y = np.array([labels[i] for i in rows], float)
    if len(y) and 0 < y.mean() < 1:
        z = np.array([[_odds(last[v], views[v][i]) for v in (0, 1)] for i in rows])
        weights = _calibrated(z, y)
        if odds:  # the rows were drawn with other odds
            weights[-1] += float(np.log(odds) - np.log(y.mean() / (1 - y.mean())))
    return Views(*last, tuple(float(w) for w in weights))


_PAGE = (("source", "string"), ("lang", "string"), ("n_chars", "bigint"))


def featured(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, page): the features of both views of every row, written once to the
    shared folder. A missing metadata column counts as null."""
    columns = [
        F.col(f"`{n}`").cast(kind) if n in docs.columns else F.lit(None).cast(kind)
        for n, kind in ((text, "string"), *_PAGE)
    ]
    own = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int32())
        for batch in batches:
            texts, *pages = (c.to_pylist() for c in batch.columns[1:])
            views = (
                [text_features(t) for t in texts],
                [page_features(*p) for p in zip(*pages, strict=True)],
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, kind) for v in views)],
                names=["doc_id", "text", "page"],
            )

    whole = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        *(c.alias(f"_{i}") for i, c in enumerate(columns)),
    )
    return stored(
        whole.mapInArrow(run, f"doc_id {own}, text array<int>, page array<int>"), "features"
    )


def train(
    features: DataFrame,
    labels: DataFrame,
    *,
    label: str = "quality",
    most: tuple[int, int] = MOST,
    rounds: int = ROUNDS,
    sent_ids: int = 1 << 20,
) -> Views:
    """Co-train on the ``featured`` rows outside the held-out part.

    Of labelled documents at most ``most`` of label 0 and 1 are read, the first by hash of
    their id; their features reach the driver. All others without a label take part in the
    rounds. Rows with a null label count as unlabelled, rows with a null id are left out, of
    rows labelled twice the higher label counts. Up to ``sent_ids`` labelled ids are sent to
    every task; beyond that both sides of their join are dealt out.
    """
    known = (
        labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y"))
        .where(F.col("y").isin(0, 1) & F.col("id").isNotNull() & ~held_out("id"))
        .groupBy("id")
        .agg(F.max("y").alias("y"))
    )
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    chosen = None
    for y, limit in enumerate(most):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(limit)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = (
        features.join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))  # at most sum(most)
        .select("y", "text", "page", (F.crc32(F.concat(F.lit("kept"), F.col("id").cast("string"))) % _KEPT == 0).alias("kept"))
        .orderBy("id", "text", "page")
        .toArrow()
    )
    labelled = known.select("id")
    if sum(counts.values()) <= sent_ids:
        labelled = F.broadcast(labelled)
    opened = (
        features.where(F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .join(labelled, F.col("doc_id") == F.col("id"), "left_anti")
        .select("text", "page")
    )
    odds = counts.get(1, 0) / counts[0] if counts.get(0) and counts.get(1) else None
    kept = np.array(rows["kept"].to_pylist(), bool)
    if rows.num_rows < 4 * _KEPT:
        kept[:] = False
    return co_train(
        *([np.array(r, np.int32) for r in rows[name].to_pylist()] for name in ("text", "page")),
        rows["y"].to_pylist(),
        kept.tolist(),
        opened,
        rounds=rounds,
        odds=odds,
    )


def scored(features: DataFrame, views: Views) -> DataFrame:
    """(doc_id, score) of every ``featured`` row, from 0 to 1, higher for better documents.

    Null and empty texts are scored like any other; repeated rows are each given; an empty
    table gives no rows.
    """
    sent = features.sparkSession.sparkContext.broadcast(views)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        views = sent.value
        for batch in batches:
            both = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            scores = [views.score(np.array(t, np.int32), np.array(p, np.int32)) for t, p in both]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

    own = features.schema["doc_id"].dataType.simpleString()
    return features.mapInArrow(run, f"doc_id {own}, score double")
