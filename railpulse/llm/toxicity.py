"""Toxicity of documents by a classifier that does not lean on who is spoken of.

A logistic regression on the distinct words of a text and their beginnings. While it is
fitted, every labelled text that names a group is also read with that name swapped for
another one of the same kind, and the squared change of the score is added to the loss.
Neutral carrier sentences, which say nothing but the name, are swapped as well, each name
for the next of its kind, as labelled texts may hold few names. So the names of groups gain
no weight of their own, and neutral mentions stay neutral.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railpulse.llm.words import free_name

#: Hashed features.
BUCKETS = 1 << 18
#: Labelled rows of each class that a fit reads at most, chosen by hash of their id.
MOST_TOXIC, MOST_CLEAN = 4_000, 8_000
#: Beginnings of words that are features of their own; they meet inflected forms.
BEGINNINGS = (4, 5)
THRESHOLD = 0.3
SWAP_WEIGHT = 1.0

# Names of groups in the languages of the texts (English, German, French,
# Spanish), by kind; a swap stays within its kind.
IDENTITIES: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys", "females", "males"),
    ("woman", "man", "girl", "boy", "female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "natives", "refugees", "foreigners"),
    ("disabled", "deaf", "blind", "old", "young"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten", "katholiken"),
    ("schwarze", "weiße", "asiaten", "afrikaner", "europäer", "araber"),
    ("schwule", "lesben", "bisexuelle", "heterosexuelle"),
    ("einwanderer", "einheimische", "flüchtlinge", "ausländer"),
    ("behinderte", "gehörlose", "blinde", "alte", "junge"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées", "catholiques"),
    ("noirs", "blancs", "asiatiques", "africains", "européens", "arabes"),
    ("homosexuels", "lesbiennes", "bisexuels", "hétérosexuels"),
    ("immigrés", "autochtones", "réfugiés", "étrangers"),
    ("handicapés", "sourds", "aveugles", "vieux", "jeunes"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos", "católicos"),
    ("negros", "blancos", "asiáticos", "africanos", "europeos", "árabes"),
    ("homosexuales", "lesbianas", "bisexuales", "heterosexuales"),
    ("inmigrantes", "nativos", "refugiados", "extranjeros"),
    ("discapacitados", "sordos", "ciegos", "viejos", "jóvenes"),
)
# A name of two languages goes with the kind listed first.
_KIN = {term: kin for kin in reversed(IDENTITIES) for term in kin}
_WORD = re.compile(r"\w+")


def _bucket(kind: str, word: str) -> int:
    return zlib.crc32(f"{kind}{word}".encode()) & (BUCKETS - 1)


def features_of_words(words: Iterable[str]) -> np.ndarray:
    """Distinct feature numbers of distinct lower-case words."""
    found = set()
    for w in words:
        found.add(_bucket("w", w))
        for n in BEGINNINGS:
            if len(w) > n:
                found.add(_bucket("b", w[:n]))
    return np.fromiter(found, np.int32, len(found))


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def swapped(words: set[str]) -> set[str] | None:
    """The words with every group name replaced by another of its kind; None without any."""
    named = words & _KIN.keys()
    if not named:
        return None
    other = set(words) - named
    for term in sorted(named):
        kin = _KIN[term]
        step = 1 + zlib.crc32(" ".join(sorted(words)[:8]).encode()) % (len(kin) - 1)
        other.add(kin[(kin.index(term) + step) % len(kin)])
    return other


def carriers() -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of neutral sentences before and after a swap; what they share adds nothing to
    the change of a score, so only the names are left of them."""
    return [
        (features_of_words([term]), features_of_words([kin[(at + 1) % len(kin)]]))
        for kin in IDENTITIES
        for at, term in enumerate(kin)
    ]


@dataclass
class Model:
    """``acted`` counts the swapped pairs that the penalty could act on: those that differ
    in a feature the classifier weighs."""

    weights: np.ndarray
    bias: float
    acted: int = 0

    def score(self, features: np.ndarray) -> float:
        z = float(self.weights[features].sum()) + self.bias
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


class _Rows:
    """Sparse 0/1 rows."""

    def __init__(self, rows: Sequence[np.ndarray]):
        self.index = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.row = np.repeat(np.arange(len(rows)), self.sizes)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.index], len(self.sizes))

    def back(self, r: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(self.index, np.repeat(r, self.sizes), n)


def informative(rows: Sequence[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Features whose share differs between the classes beyond chance, by the likelihood
    ratio test at a level that allows for the number of features tried."""
    index = np.concatenate(rows)
    n1, n0 = float(y.sum()), float(len(y) - y.sum())
    label = np.repeat(y, [len(r) for r in rows])
    a = np.bincount(index, label, BUCKETS)
    b = np.bincount(index, 1 - label, BUCKETS)
    p = (a + b) / (n1 + n0)

    def part(seen: np.ndarray, n: float, share: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            hit = np.where(seen > 0, seen * np.log(seen / (n * share)), 0.0)
            miss = np.where(n > seen, (n - seen) * np.log((n - seen) / (n * (1 - share))), 0.0)
        return hit + miss

    test = 2 * (part(a, n1, p) + part(b, n0, p))
    return np.flatnonzero((a + b > 1) & (test > 4 + 2 * np.log(np.count_nonzero(a + b))))


def fit(
    rows: Sequence[np.ndarray],
    labels: Sequence[int],
    swaps: Sequence[tuple[np.ndarray, np.ndarray]] = (),
    *,
    swap_weight: float = SWAP_WEIGHT,
    decay: float = 1e-5,
    steps: int = 400,
    rate: float = 0.05,
    odds: float | None = None,
) -> Model:
    """Logistic regression on the informative features and those that swaps change, by Adam
    on whole gradients.

    ``swaps`` are pairs of rows before and after a swap; those alike in all features
    of the fit are left out of the mean change. ``odds`` are the true odds of
    label 1, where ``labels`` were drawn with others. Without rows, or with one class
    only, the score is the rate of label 1.
    """
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(BUCKETS), 20.0 * (2 * y[0] - 1) if len(y) else -20.0)
    # Names that are swapped are features in any case: the penalty decides on their weight.
    seen = np.unique(np.concatenate(rows))
    names = [np.setxor1d(a, b) for a, b in swaps]
    named = np.intersect1d(np.concatenate(names), seen) if names else seen[:0]
    keep = np.union1d(informative(rows, y), named)
    place = np.full(BUCKETS, -1, np.int64)
    place[keep] = np.arange(len(keep))

    def inside(features: np.ndarray) -> np.ndarray:
        found = place[features]
        return found[found >= 0]

    x = _Rows([inside(r) for r in rows])
    acting = [(a, b) for a, b in ((inside(a), inside(b)) for a, b in swaps) if set(a) != set(b)]
    before, after = (_Rows([pair[i] for pair in acting]) for i in (0, 1))
    n, mean = len(keep), y.mean()
    odds = odds or mean / (1 - mean)
    share = odds / (1 + odds)
    weight = np.where(y == 1, share / mean, (1 - share) / (1 - mean)) / len(y)
    w, bias = np.zeros(n), float(np.log(odds))
    m, v, mb, vb = np.zeros(n), np.zeros(n), 0.0, 0.0
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x.times(w) + bias, -40, 40)))
        r = (p - y) * weight
        g, gb = x.back(r, n) + decay * w, float(r.sum())
        if acting:
            change = (before.times(w) - after.times(w)) * (2 * swap_weight / len(acting))
            g += before.back(change, n) - after.back(change, n)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        fix, fix2 = 1 - 0.9**step, 1 - 0.999**step
        w -= rate * (m / fix) / (np.sqrt(v / fix2) + 1e-8)
        bias -= rate * (mb / fix) / (np.sqrt(vb / fix2) + 1e-8)
    whole = np.zeros(BUCKETS)
    whole[keep] = w
    return Model(whole, bias, len(acting))


def held_out(doc_id: str | Column) -> Column:
    """Rows that no fit reads."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    most: tuple[int, int] = (MOST_TOXIC, MOST_CLEAN),
    swap_weight: float = SWAP_WEIGHT,
) -> Model:
    """Fit on labelled documents outside the held-out part.

    Reads at most ``most`` rows of label 1 and 0, the first by hash of their id, so the
    sample is the same at every run; only their feature numbers reach the driver. Rows
    with a null label or id are left out, of rows labelled twice the higher label counts.
    Swapped are the names in these rows and those of the carrier sentences.
    """
    known = (
        labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y"))
        .where(F.col("_y").isin(0, 1) & F.col("_id").isNotNull() & ~held_out("_id"))
        .groupBy("_id")
        .agg(F.max("_y").alias("_y"))
    )
    counts = {r["_y"]: r["count"] for r in known.groupBy("_y").count().collect()}
    chosen = None
    for y, limit in ((1, most[0]), (0, most[1])):
        part = known.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(limit)
        chosen = part if chosen is None else chosen.unionByName(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, others = [], []
            for t in batch.column(1).to_pylist():
                words = words_of(t)
                rows.append(features_of_words(words))
                other = swapped(words)
                others.append(None if other is None else features_of_words(other))
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, kind), pa.array(others, kind)],
                names=["y", "features", "swapped"],
            )

    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"))
    rows = (
        texts.join(F.broadcast(chosen), "_id")  # at most sum(most) rows
        .select("_y", "_text")
        .mapInArrow(run, "y int, features array<int>, swapped array<int>")
        .toArrow()
    )
    features = [np.array(r, np.int32) for r in rows["features"].to_numpy()]
    pairs = [
        (f, np.array(s, np.int32))
        for f, s in zip(features, rows["swapped"].to_numpy(), strict=True)
        if s is not None
    ]
    odds = counts.get(1, 0) / counts[0] if counts.get(0) and counts.get(1) else None
    pairs += carriers()
    return fit(features, rows["y"].to_pylist(), pairs, swap_weight=swap_weight, odds=odds)


def scored(
    docs: DataFrame, model: Model, *, text: str = "text", name: str = "score"
) -> DataFrame:
    """The rows with a score from 0 to 1, from the text alone.

    Null and empty texts score by the bias. All columns are kept; one that has the
    score's name is replaced. An empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    columns = [c for c in docs.columns if c != name]
    at = columns.index(text)
    fields = [docs.schema[c] for c in columns]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            scores = [
                model.score(features_of_words(words_of(t))) for t in batch.column(at).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=[*columns, name]
            )

    return docs.select(*(F.col(f"`{c}`") for c in columns)).mapInArrow(
        run, f"{schema}, `{name}` double"
    )


def without_toxic(
    docs: DataFrame, model: Model, *, text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows that score below the threshold, with their own columns.

    Null and empty texts score by the bias, so all of them stay or none; repeated rows stay
    repeated. An empty table gives no rows.
    """
    own = free_name("score", docs)
    return scored(docs, model, text=text, name=own).where(F.col(own) < threshold).drop(own)
