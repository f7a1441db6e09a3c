"""Passages of words that occur more than once, removed from documents.

Every window of consecutive words belongs to its anchor, the word gram in it that comes
first in an order of hashes. Windows in a row with the same anchor form a segment; equal
windows have equal anchors, so they lie in segments of the same key. Keys that occur once
are done. The segments of the others are dealt out by key to shards, equal segments counted
together; each shard builds a compressed FM-index of its segments and streams them through
it: backward search, begun with the range of a window's last 32 words, reports the windows
that occur at least twice.

Grams that occur very often come last in the order of hashes. So a window that reaches over
the edge of a passage that very many documents share has its anchor outside of it, and the
many different edges of such a passage spread over many keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railpulse.llm.fmindex import FMIndex
from railpulse.llm.words import as_bytes, word_blocks
from railpulse.sinks.tables import stored

WINDOW = 35
GRAM = 8
#: Bytes of distinct segments in one shard, about.
SHARD_BYTES = 2 << 20
#: A gram is frequent if it makes up more than this part of all; so there are at most as
#: many of them as its inverse.
FREQUENT = 1 / 50_000
#: Frequent grams are marked in a table of this many bits; the order of hashes may also
#: put a rare gram last that shares its place with one.
_MARKS = 1 << 22
_ROWS = 256  # documents whose segments are held at once
_SEEN = 1 << 18  # segments a task remembers having passed on
_COUNTED = 1 << 22  # grams a task counts before it passes on the frequent ones
_MULTIPLIERS = tuple(
    np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
)


def word_hashes(text: bytes | None) -> np.ndarray:
    parts = [
        np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        for words in word_blocks(text)
    ]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def gram_hashes(words: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of every run of ``gram`` words, a power of two, by doubling."""
    hashes, step, turn = words, 1, 0
    while step < gram:
        if len(hashes) <= step:
            return np.zeros(0, np.uint64)
        hashes = hashes[:-step] + hashes[step:] * _MULTIPLIERS[turn % 3]
        hashes = hashes ^ (hashes >> np.uint64(29))
        step, turn = step * 2, turn + 1
    return hashes * _MULTIPLIERS[0]


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    least, step = values, 1
    while step * 2 <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    rest = width - step
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def segments(
    words: np.ndarray, marks: np.ndarray, window: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, number of windows, key) of every segment of a text's word hashes."""
    if len(words) < window:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    grams = gram_hashes(words, gram)
    frequent = marks[(grams & np.uint64(_MARKS - 1)).astype(np.int64)]
    order = np.lexsort((grams, frequent)) if frequent.any() else np.argsort(grams, kind="stable")
    place = np.empty(len(grams), np.int64)
    place[order] = np.arange(len(grams))  # of equal grams the left one comes first
    anchor = order[_sliding_least(place, window - gram + 1)]
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    size = np.diff(np.concatenate([first, [len(anchor)]]))
    return first, size, grams[anchor[first]].view(np.int64)


def frequent_marks(texts: DataFrame, gram: int, part: float = FREQUENT) -> np.ndarray:
    """Marks of the grams that make up more than ``part`` of all grams of all texts.

    A task passes on the grams that are frequent in what it has just counted, with their
    counts; a gram frequent in all texts is so in some task. At most ``4 / part`` rows
    leave a task's count, and fewer than ``1 / part`` grams reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            grams, counts = np.unique(np.concatenate(held), return_counts=True)
            keep = counts >= max(4, int(size * part / 4))
            total = pa.array([None, *grams[keep].view(np.int64)], pa.int64())
            return pa.RecordBatch.from_arrays(
                [total, pa.array([size, *counts[keep]], pa.int64())], names=["gram", "n"]
            )

        for batch in batches:
            for text in as_bytes(batch.column(0)):
                held.append(gram_hashes(word_hashes(text), gram))
                size += len(held[-1])
                if size >= _COUNTED:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    counted = stored(
        texts.select("text").mapInArrow(run, "gram bigint, n bigint"), "grams"
    )
    total = counted.where("gram is null").agg(F.sum("n")).first()[0] or 0
    found = (
        counted.where("gram is not null")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") > max(64, int(total * part)))
        .select("gram")
        .toArrow()
    )
    marks = np.zeros(_MARKS, bool)
    grams = found["gram"].to_numpy().view(np.uint64)
    marks[(grams & np.uint64(_MARKS - 1)).astype(np.int64)] = True
    return marks


def _slices(text: bytes, firsts: list[int], lengths: list[int]) -> Iterator[bytes]:
    """The words of stretches of a text, joined by spaces; stretches come in order."""
    blocks, words, base = word_blocks(text), [], 0
    for first, length in zip(firsts, lengths, strict=True):
        while base + len(words) < first + length:
            keep = max(0, min(first - base, len(words)))
            words = words[keep:] + next(blocks)
            base += keep
        yield b" ".join(words[first - base : first - base + length])


def repeated_windows(docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(row, hits): of every row of (row, text) with repeated windows the segments that
    hold some, by first word, and a bit mask of the windows repeated. Rows of one ``row``
    have to be of one text; they are counted each and come back once."""
    spark = docs.sparkSession
    marks = spark.sparkContext.broadcast(frequent_marks(docs, gram))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                segments(word_hashes(t), marks.value, window, gram)
                for t in as_bytes(batch.column(1))
            ]
            sizes = np.array([len(f[0]) for f in found], np.int64)
            rows = batch.column(0).take(pa.array(np.repeat(np.arange(len(found)), sizes)))
            first, size, key = (np.concatenate([f[i] for f in found]) for i in range(3))
            yield pa.RecordBatch.from_arrays(
                [rows, pa.array(first), pa.array(size, pa.int32()), pa.array(key)],
                names=["row", "first", "size", "key"],
            )

    cuts = stored(
        docs.select("row", "text").mapInArrow(cut, "row binary, first bigint, size int, key bigint"),
        "segments",
    )
    again = cuts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    wanted = (
        cuts.join(again, "key", "left_semi")
        .groupBy("row")
        .agg(F.sort_array(F.collect_set(F.struct("first", "size", "key"))).alias("parts"))
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        for whole in batches:
            for i in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(i, _ROWS)
                out = {n: [] for n in ("row", "first", "key", "digest", "words")}
                for row, parts, text in zip(
                    batch.column(0).to_pylist(),
                    batch.column(1).to_pylist(),
                    as_bytes(batch.column(2)),
                    strict=True,
                ):
                    firsts = [p["first"] for p in parts]
                    lengths = [p["size"] + window - 1 for p in parts]
                    for part, words in zip(parts, _slices(text, firsts, lengths), strict=True):
                        digest = xxhash.xxh3_128_digest(words)
                        fresh = digest not in seen
                        if fresh:
                            if len(seen) >= _SEEN:
                                seen.clear()
                            seen.add(digest)
                        out["row"].append(row)
                        out["first"].append(part["first"])
                        out["key"].append(part["key"])
                        out["digest"].append(digest)
                        out["words"].append(words if fresh else None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)],
                    names=[*out],
                )

    # Each task gives the words of equal segments once.
    places = stored(
        wanted.join(docs.select("row", "text"), "row")
        .select("row", "parts", "text")
        .mapInArrow(
            read,
            "row binary, first bigint, key bigint, digest binary, words binary",
        ),
        "places",
    )
    size = places.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    shards = size // SHARD_BYTES + 1
    distinct = places.groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"),
        F.first("words", ignorenulls=True).alias("words"),
        F.first("key").alias("key"),
    )

    def search(shard: pa.Table) -> pa.Table:
        sequences = [w.split() for w in shard["words"].to_pylist()]
        depth = 1 << (window.bit_length() - 1)
        index = FMIndex(sequences, shard["copies"].to_numpy().astype(np.int64), depth)
        masks = index.repeated(window)
        hit = np.flatnonzero(masks)
        return pa.table(
            {"digest": shard["digest"].take(pa.array(hit)), "mask": pa.array(masks[hit])}
        )

    masks = stored(
        distinct.select(
            F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), "digest", "copies", "words"
        )
        .groupBy("shard")
        .applyInArrow(search, "digest binary, mask bigint"),
        "masks",
    )
    return (
        places.select("row", "first", "digest")
        .join(masks, "digest")
        .groupBy("row")
        .agg(F.sort_array(F.collect_set(F.struct("first", "mask"))).alias("hits"))
    )


def _covered(words: int, first: np.ndarray, mask: np.ndarray, window: int) -> np.ndarray:
    hit, bit = np.nonzero(mask[:, None] >> np.arange(63) & 1)
    start = first[hit] + bit
    change = np.bincount(start, minlength=words + 1) - np.bincount(start + window, minlength=words + 1)
    return np.cumsum(change[:-1]) > 0


def without_repeats(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    digest: bool = False,
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row: the words left, joined by single
    spaces, when each word covered by a repeated window is removed; with ``digest`` their
    SHA-256 in hex instead.

    A window of ``window`` words is repeated if its word sequence also starts anywhere
    else, in the same text or another; windows are judged on the input. Null texts have
    no words; texts shorter than a window are kept whole; repeated rows remove each
    other; an empty table gives no rows; other columns are ignored. ``docs`` is read
    several times, in any order and cut into any partitions: a row goes by a digest of
    its id and text, not by its place.
    """
    own, body = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (doc_id, text))
    rows = docs.select(
        F.unhex(F.md5(F.concat(F.length(own).cast("string"), F.lit(":"), own, body))).alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.col(text).cast("string").alias("text"),
    )
    hits = repeated_windows(rows, window=window, gram=gram)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            found = batch.column(2).flatten()
            first, mask = (found.field(i).to_numpy(zero_copy_only=False) for i in range(2))
            ends = np.cumsum(pc.list_value_length(batch.column(2)).fill_null(0).to_numpy(False))
            at = 0
            for text, end in zip(as_bytes(batch.column(1)), ends.tolist(), strict=True):
                words = [w for block in word_blocks(text) for w in block]
                left = words
                if end > at:
                    gone = _covered(len(words), first[at:end], mask[at:end], window)
                    left = list(compress(words, (~gone).tolist()))
                    at = end
                total.append(len(words))
                removed.append(len(words) - len(left))
                body = b" ".join(left)
                kept.append(hashlib.sha256(body).hexdigest() if digest else body.decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(total, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return (
        rows.join(hits, "row", "left")
        .select("doc_id", "text", "hits")
        .mapInArrow(keep, f"doc_id {kind}, n_words bigint, n_removed bigint, kept string")
    )
