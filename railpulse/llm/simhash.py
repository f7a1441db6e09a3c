"""Near-duplicate documents by SimHash and anchor points of a covering code.

A fingerprint of 64 bits is cut into blocks. Two fingerprints that differ in at most
``threshold`` bits differ in at most ``threshold // blocks`` bits of some block. In each
block the anchors are the words of a Hamming code on the block's first bits, the other
bits being free: every block value lies within one bit (the covering radius) of an
anchor. So a pair that is close in a block meets at the anchor nearest to either one if
both are sent to every anchor within the radius plus the block's threshold. Pairs are
compared at the anchors only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railpulse.llm.graph import components
from railpulse.llm.words import as_bytes, free_name, word_blocks
from railpulse.sinks.tables import stored

BITS = 64
SEED = 42
_HASH = partial(xxhash.xxh64_intdigest, seed=SEED)
_CHUNK = 1 << 16
_APART = 0x1F3D5B79A2C4E687
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit, lowest bit first."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def _families(hashes: np.ndarray, families: int) -> Iterator[np.ndarray]:
    """The hashes, and for every further family other hashes made from them."""
    yield hashes
    for family in range(1, families):
        mixed = (hashes ^ np.uint64(family * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * _MIX[0]
        mixed = (mixed ^ (mixed >> np.uint64(31))) * _MIX[1]
        yield mixed ^ (mixed >> np.uint64(29))


def fingerprint(text: bytes | None, shingle: int, families: int = 1) -> list[int]:
    """SimHash of one text, by each family of hashes: a bit is set if it is in over half of
    the hashes of the text's word shingles, repeats included. The first family is XXH64. A
    text of fewer words is one shingle, one without words has fingerprint 0. A very long
    text is read block by block."""
    counts, total, tail, whole = np.zeros((families, BITS), np.int64), 0, [], True

    def add(hashes: np.ndarray) -> None:
        for i in range(0, len(hashes), _CHUNK):
            for family, more in enumerate(_families(hashes[i : i + _CHUNK], families)):
                counts[family] += _bit_counts(more)

    for words in word_blocks(text.lower() if text else None):
        tail = tail + words
        if len(tail) < shingle:
            continue
        whole = False
        grams = map(b" ".join, zip(*(tail[i:] for i in range(shingle)), strict=False))
        hashes = np.fromiter(map(_HASH, grams), np.uint64)
        add(hashes)
        total += len(hashes)
        tail = tail[len(tail) - shingle + 1 :]
    if whole and tail:
        add(np.array([_HASH(b" ".join(tail))], np.uint64))
        total = 1
    bits = np.packbits(2 * counts > total, axis=1, bitorder="little")
    return bits.view(np.uint64)[:, 0].tolist()


def fingerprints(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 4,
    families: int = 1,
) -> DataFrame:
    """(doc_id, fp, fp1, ...) of every row, a fingerprint for each family, its 64 bits as a
    signed number. A null text counts as empty."""
    names = ["fp", *(f"fp{i}" for i in range(1, families))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, shingle, families) for t in as_bytes(batch.column(1))]
            each = np.array(prints, np.uint64).reshape(-1, families).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(each[:, i]) for i in range(families))],
                names=["doc_id", *names],
            )

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, ", ".join([f"doc_id {kind}", *(f"{n} bigint" for n in names)]))


def _blocks(blocks: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of each block."""
    edges = [i * BITS // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


@cache
def _syndromes(coded: int) -> np.ndarray:
    """The Hamming syndrome of every value of ``coded`` bits; 0 for code words."""
    table = np.zeros(1 << min(coded, 16), np.uint8)
    for bit in range(min(coded, 16)):
        table[1 << bit : 2 << bit] = table[: 1 << bit] ^ (bit + 1)
    return table


def _coded(width: int) -> int:
    """Length of the longest Hamming code that fits into a block."""
    return (1 << ((width + 1).bit_length() - 1)) - 1


def _syndrome(values: np.ndarray, coded: int) -> np.ndarray:
    low = _syndromes(coded)[values & ((1 << min(coded, 16)) - 1)]
    for bit in range(16, coded):
        low = low ^ (((values >> bit) & 1) * (bit + 1)).astype(np.uint8)
    return low


def anchors(prints: np.ndarray, threshold: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the fingerprint, anchor) for every anchor a fingerprint is sent to."""
    index, found = [], []
    radius = 1 + threshold // blocks
    for number, (first, width) in enumerate(_blocks(blocks)):
        part = ((prints >> np.uint64(first)) & np.uint64((1 << width) - 1)).astype(np.int64)
        own = _syndrome(part, coded := _coded(width))
        for weight in range(radius + 1):
            for flipped in combinations(range(width), weight):
                mask = sum(1 << b for b in flipped)
                away = int(_syndrome(np.array([mask]), coded)[0])
                hit = np.flatnonzero(own == away)  # the code is linear
                index.append(hit)
                found.append((part[hit] ^ mask) | (number << 40))
    return np.concatenate(index), np.concatenate(found)


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest index each of n items can reach over the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root[a] == root[b]).all():
            while not (root == root[root]).all():
                root = root[root]
            return root


def _close(keys: np.ndarray, prints: np.ndarray, threshold: int) -> Iterator[pa.RecordBatch]:
    """Links among rows of equal key, as a forest. Rows come sorted by key."""
    n, a, b, pending = len(keys), [], [], 0

    def flush() -> pa.RecordBatch:
        items, at = np.unique(np.concatenate(a + b), return_inverse=True)
        half = len(at) // 2
        distinct, of = np.unique(prints[items], return_inverse=True)
        root = _forest(of[at[:half]], of[at[half:]], len(distinct))
        hung = np.flatnonzero(root != np.arange(len(distinct)))
        return pa.RecordBatch.from_arrays(
            [pa.array(distinct[hung].view(np.int64)), pa.array(distinct[root[hung]].view(np.int64))],
            names=["a", "b"],
        )

    alive = np.arange(n)
    for step in range(1, n):
        alive = alive[alive + step < n]
        alive = alive[keys[alive] == keys[alive + step]]
        if not len(alive):
            break
        near = alive[np.bitwise_count(prints[alive] ^ prints[alive + step]) <= threshold]
        if len(near):
            a.append(near)
            b.append(near + step)
            pending += len(near)
        if pending > 1 << 20:
            yield flush()
            a, b, pending = [], [], 0
    if pending:
        yield flush()


def links(
    prints: DataFrame, *, threshold: int = 4, blocks: int = 3, most_at_anchor: int = 2048
) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints ``fp`` exactly as all pairs
    within ``threshold`` bits would: at each anchor only a spanning forest is given.

    An anchor that more than ``most_at_anchor`` fingerprints are sent to is cut into
    pieces, and each pair of pieces is compared in a task of its own, so no task holds
    more than two pieces of one anchor and no pair is lost.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for i in range(0, len(values), 20_000):
                part = values[i : i + 20_000]
                at, anchor = anchors(part, threshold, blocks)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(part[at].view(np.int64))], names=["anchor", "fp"]
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            prints = np.concatenate([prints, batch.column(1).to_numpy().view(np.uint64)])
            if not len(keys):
                continue
            done = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
            yield from _close(keys[:done], prints[:done], threshold)
            keys, prints = keys[done:], prints[done:]
        yield from _close(keys, prints, threshold)

    sent = prints.select("fp").mapInArrow(send, "anchor bigint, fp bigint")
    crowded = (
        sent.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > most_at_anchor)
        .select("anchor", F.ceil(F.col("n") / most_at_anchor).cast("int").alias("pieces"))
    )
    piece = F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
    other = F.explode(
        F.when(F.col("pieces").isNull(), F.array(F.lit(0))).otherwise(
            F.sequence(F.lit(0), F.col("pieces") - 1)
        )
    )
    keyed = (
        sent.join(crowded, "anchor", "left")
        .withColumn("other", other)
        .withColumn("own", F.coalesce(piece, F.lit(0)))
        .select(
            F.xxhash64("anchor", F.least("own", "other"), F.greatest("own", "other")).alias("key"),
            "fp",
        )
    )
    return (
        keyed.repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(compare, "a bigint, b bigint")
        .distinct()
    )


def _other_links(prints: DataFrame, family: int, **options) -> DataFrame:
    """Edges that join the nodes of the first family whose fingerprints of another family
    link. The other fingerprints are nodes too, moved by a constant to numbers of their
    own; one that neither links nor is shared joins nothing and is left out."""

    def moved(name: str) -> Column:
        return F.col(name).bitwiseXOR(F.lit(family * _APART & (1 << 62) - 1))

    member = stored(
        prints.select(F.col("fp").alias("node"), F.col(f"fp{family}").alias("fp")).distinct(),
        "members",
    )
    found = stored(links(member.select("fp").distinct(), **options), "links")
    shared = member.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fp")
    wanted = shared.union(found.select("a")).union(found.select("b")).distinct()
    member = member.join(wanted, "fp", "left_semi").select(
        F.col("node").alias("a"), moved("fp").alias("b")
    )
    return member.unionByName(found.select(moved("a").alias("a"), moved("b").alias("b")))


def near_duplicates(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 4,
    threshold: int = 4,
    blocks: int = 3,
    families: int = 1,
) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    Rows with the same fingerprint are one node; nodes link at ``threshold`` or fewer
    differing bits. With more ``families`` of hashes a link by any of them counts, which
    finds near copies that one fingerprint happens to set apart. ``component_id`` is the
    smallest doc_id of the component, null if all of its ids are null. Null and empty
    texts share fingerprint 0; repeated rows come back repeated; an empty table gives no
    rows; other columns are ignored.
    """
    prints = stored(
        fingerprints(docs, doc_id=doc_id, text=text, shingle=shingle, families=families), "prints"
    )
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    edges = links(nodes, threshold=threshold, blocks=blocks)
    for family in range(1, families):
        edges = edges.unionByName(
            _other_links(prints, family, threshold=threshold, blocks=blocks)
        )
    roots = components(edges)
    placed = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = stored(placed.join(smallest, "root").select("fp", "component_id"), "components")
    return prints.join(of_print, "fp").select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One row of each near-duplicate group of :func:`near_duplicates`, with its columns.

    Rows are grouped each for itself, so of repeated rows one stays, whatever their ids;
    null and empty texts are one group. An empty table gives no rows.
    """
    own = free_name("row", docs)
    rows = stored(docs.withColumn(own, F.monotonically_increasing_id()), "rows")
    groups = near_duplicates(rows, doc_id=own, **options)
    first = groups.where(F.col("doc_id") == F.col("component_id")).select(
        F.col("doc_id").alias(own)
    )
    return rows.join(first, own, "left_semi").select(*docs.columns)
