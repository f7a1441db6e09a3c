"""Cross-entropy difference: how much likelier a text is under a target model than under a
background model.

Both are interpolated bigram models over one vocabulary, the words of all texts. A word's
loss after the word before it is

    -log((c(before, word) + s p(word)) / (c(before) + s)),  p(word) = (c(word) + 1) / (N + V)

so it falls into a part of the pair and its word and a part of the word before alone. All
three counts of a word meet where the pairs that end in it are dealt out by that word, in
one exchange; from there go back, for every document, the sums of its losses. Words that
make up a good part of all texts are few. Their counts go to every task, the pairs that
end in them are dealt out by both words, and pairs that are frequent themselves are not
dealt out at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railpulse.llm.words import as_bytes, word_blocks
from railpulse.sinks.tables import held

#: Weight of the shorter context's estimate, in observations.
SMOOTHING = 8.0
#: A word or pair is frequent if it makes up one in so many words of all texts, so there
#: are at most so many of each.
FREQUENT = 1024
#: Words of one slice of the pairs, and of one block of documents.
SLICE_WORDS, BLOCK_WORDS = 1 << 21, 1 << 20
_BLOCK_ROWS = 1 << 15  # a row number and its flag fit into 16 bits
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_START = np.uint64(0)  # stands before the first word
_LAST = np.uint64((1 << 48) - 1)  # in place of the word before: the word is a text's last


def _hashes(text: bytes | None) -> np.ndarray:
    """The words of a text in lower case as 64-bit numbers, none of them 0."""
    parts = [
        np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        for words in word_blocks(text.lower() if text else None)
    ]
    words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return np.maximum(words, np.uint64(1))


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * _MIX[0]) ^ (a >> np.uint64(29)) ^ (b * _MIX[1])


@dataclass
class _Block:
    """Words of neighbouring documents, one after the other."""

    ids: list = field(default_factory=list)
    flags: list[bool] = field(default_factory=list)
    parts: list[np.ndarray] = field(default_factory=list)
    size: int = 0

    def arrays(self) -> tuple[np.ndarray, ...]:
        """(row, before, word, whether the word is the row's last, words of each row)."""
        sizes = np.array([len(p) for p in self.parts])
        word = np.concatenate(self.parts)
        row = np.repeat(np.arange(len(sizes)), sizes)
        before = np.concatenate([[_START], word[:-1]]) if len(word) else word
        first = np.cumsum(sizes) - sizes
        before[first[sizes > 0]] = _START
        last = np.zeros(len(word), bool)
        last[(first + sizes - 1)[sizes > 0]] = True
        return row, before, word, last, sizes


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    """Blocks of (doc_id, text, is_target) rows; a longer text is a block of its own size."""
    block = _Block()
    for batch in batches:
        ids, flags = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for own, text, flag in zip(ids, as_bytes(batch.column(1)), flags, strict=True):
            words = _hashes(text)
            if block.ids and (
                block.size + len(words) > BLOCK_WORDS or len(block.ids) == _BLOCK_ROWS
            ):
                yield block
                block = _Block()
            block.ids.append(own)
            block.flags.append(bool(flag))
            block.parts.append(words)
            block.size += len(words)
    if block.ids:
        yield block


def _counted(keys: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, times with the flag, times)."""
    distinct, of, times = np.unique(keys, return_inverse=True, return_counts=True)
    return distinct, np.bincount(of, flags, len(distinct)).astype(np.int64), times.astype(np.int64)


_COUNTS = ("target", "every")


def _summed(counts: DataFrame, *keys: str) -> DataFrame:
    return counts.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in _COUNTS))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, target, every): how often each word occurs in the target texts and in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            row, _, word, _, _ = block.arrays()
            distinct, target, every = _counted(word, np.array(block.flags)[row])
            out = [pa.array(distinct.view(np.int64)), pa.array(target), pa.array(every)]
            yield pa.RecordBatch.from_arrays(out, names=["word", *_COUNTS])

    return _summed(texts.mapInArrow(run, "word bigint, target bigint, every bigint"), "word")


def _frequent_counts(texts: DataFrame, words: np.ndarray) -> DataFrame:
    """(before, word, target, every) of pairs of the sorted ``words`` or the start of a text,
    and, with a null word, how often each of them stands before any word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.append(words, _START)
        known.sort()
        for block in _blocks(batches):
            row, before, word, _, _ = block.arrays()
            flags = np.array(block.flags)[row]
            a, b = _place(known, before), _place(known, word)
            both = (a >= 0) & (b >= 0)
            pairs = _counted(a[both] * len(known) + b[both], flags[both])
            single = _counted(a[a >= 0], flags[a >= 0])
            for (keys, target, every), paired in ((pairs, True), (single, False)):
                first = known[keys // len(known)] if paired else known[keys]
                second = pa.array(known[keys % len(known)].view(np.int64)) if paired else pa.nulls(len(keys), pa.int64())
                out = [pa.array(first.view(np.int64)), second, pa.array(target), pa.array(every)]
                yield pa.RecordBatch.from_arrays(out, names=["before", "word", *_COUNTS])

    schema = "before bigint, word bigint, target bigint, every bigint"
    return _summed(texts.mapInArrow(run, schema), "before", "word")


def _place(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Where each value is among the sorted known ones, or -1."""
    if not len(known):
        return np.full(len(values), -1, np.int64)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return np.where(known[at] == values, at, -1)


@dataclass
class _Known:
    """Totals, and the counts of frequent words and pairs; columns: target, all texts."""

    totals: np.ndarray  # words
    vocabulary: int
    words: np.ndarray  # sorted, the start included
    counts: np.ndarray
    before: np.ndarray
    pairs: np.ndarray  # sorted mixes of two words
    pair_counts: np.ndarray
    smoothing: float
    slices: int

    def alone(self, counts: np.ndarray) -> np.ndarray:
        """Probability of words by themselves, from their counts."""
        return (counts + 1) / (self.totals + self.vocabulary)

    def pair_part(self, pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Loss difference of a pair but for the word before it."""
        logs = np.log(pairs + self.smoothing * self.alone(counts))
        return logs[:, 1] - logs[:, 0]

    def before_part(self, counts: np.ndarray) -> np.ndarray:
        logs = np.log(counts + self.smoothing)
        return logs[:, 0] - logs[:, 1]


_CUT = "slice int, block string, kind int, words binary, sizes binary, low binary, high binary, rows binary, times binary"
_PARTS = "block string, ids binary, known binary, sizes binary, rows binary, sums binary"


def _cut(block: _Block, name: str, known: _Known) -> Iterator[dict]:
    """A block's own sums, and its other pairs slice by slice."""
    row, before, word, last, sizes = block.arrays()
    sums = np.zeros(len(sizes))
    a, b = _place(known.words, before), _place(known.words, word)
    # Frequent words before others: their part is known here.
    here = a >= 0
    sums += np.bincount(row[here], known.before_part(known.before)[a[here]], len(sums))
    # Frequent pairs too.
    pair = _place(known.pairs, _mixed(before, word))
    done = (pair >= 0) & here & (b >= 0)
    if done.any():
        part = known.pair_part(known.pair_counts[pair[done]], known.counts[b[done]])
        sums += np.bincount(row[done], part, len(sums))
    yield {
        "slice": int(xxhash.xxh32_intdigest(name) % known.slices),
        "block": name,
        "kind": 0,
        "words": np.array([0 if i is None else i for i in block.ids], "<i8").tobytes(),
        "sizes": sizes.astype("<i8").tobytes(),
        "low": np.array([i is not None for i in block.ids]).tobytes(),
        "times": sums.tobytes(),
    }
    rest = np.flatnonzero(~done)
    closing = np.flatnonzero(last & (b < 0))  # a last word stands before no other
    row = np.concatenate([row[rest], row[closing]])
    low = np.concatenate([before[rest], np.full(len(closing), _LAST)]) & _LAST
    word_, frequent = np.concatenate([word[rest], word[closing]]), np.concatenate([b[rest], b[closing]]) >= 0
    _, first, times = np.unique(
        _mixed(_mixed(low, word_), row.astype(np.uint64)), return_index=True, return_counts=True
    )
    row, low, word, frequent = row[first], low[first], word_[first], frequent[first]
    # Words go by their hash; those that are frequent by that of the pair.
    share = np.where(frequent, _mixed(low, word), word) >> np.uint64(32)
    at_slice = (share * np.uint64(known.slices) >> np.uint64(32)).astype(np.int64)
    order = np.lexsort((word, frequent, at_slice))
    while (times > 0xFFFF).any():  # rare: more than 65,535 times in one text
        many = np.flatnonzero(times > 0xFFFF)
        order = np.concatenate([order, many])
        row, low, word, frequent, at_slice = (np.append(x, x[many]) for x in (row, low, word, frequent, at_slice))
        times = np.append(times, np.full(len(many), 0xFFFF))
        times[many] -= 0xFFFF
        order = np.lexsort((word, frequent, at_slice))
    flags = np.array(block.flags)
    row, low, word, times = row[order], low[order], word[order], times[order]
    key = at_slice[order] * 2 + frequent[order]
    cuts = [*np.flatnonzero(np.diff(key, prepend=-1)), len(key)]
    for start, end in zip(cuts, cuts[1:], strict=False):
        part = slice(start, end)
        distinct, sizes = np.unique(word[part], return_counts=True)  # sorted already
        yield {
            "slice": int(key[start] // 2),
            "block": name,
            "kind": int(1 + key[start] % 2),
            "words": distinct.tobytes(),
            "sizes": sizes.astype("<u4").tobytes(),
            "low": low[part].astype("<u4").tobytes(),
            "high": (low[part] >> np.uint64(32)).astype("<u2").tobytes(),
            "rows": (row[part] | (flags[row[part]].astype(np.int64) << 15)).astype("<u2").tobytes(),
            "times": times[part].astype("<u2").tobytes(),
        }


def _joined(cells: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(cells), kind)


def _part_sums(found: pa.Table, known: _Known) -> Iterator[dict]:
    """What the pairs of one slice add to each row of each block."""
    rows = found.to_pylist()
    for r in rows:
        if r["kind"] == 0:
            yield {"block": r["block"], "ids": r["words"], "known": r["low"], "sizes": r["sizes"], "sums": r["times"]}
    for kind in (1, 2):
        some = [r for r in rows if r["kind"] == kind]
        if not some:
            continue
        size = [len(r["rows"]) // 2 for r in some]
        of_block = np.repeat(np.arange(len(some)), size)
        word = np.repeat(
            _joined([r["words"] for r in some], "<u8"), _joined([r["sizes"] for r in some], "<u4")
        )
        low = _joined([r["low"] for r in some], "<u4").astype(np.uint64)
        low |= _joined([r["high"] for r in some], "<u2").astype(np.uint64) << np.uint64(32)
        row = _joined([r["rows"] for r in some], "<u2").astype(np.int64)
        times = _joined([r["times"] for r in some], "<u2").astype(np.float64)
        both = np.stack([times * (row >> 15), times], axis=1)  # in the target, in all

        def sums_by(of: np.ndarray, n: int, take: np.ndarray, both=both) -> np.ndarray:
            return np.stack([np.bincount(of[take], both[take, i], n) for i in (0, 1)], axis=1)

        words, of_word = np.unique(word, return_inverse=True)
        _, first, of_pair = np.unique(_mixed(low, word), return_index=True, return_inverse=True)
        closing = low == _LAST
        real = ~closing
        if kind == 1:
            counts = sums_by(of_word, len(words), real)
            before = counts - sums_by(of_word, len(words), closing)
        else:
            counts = known.counts[_place(known.words, words)]
        pairs = sums_by(of_pair, len(first), real)
        gain = times * known.pair_part(pairs, counts[of_word[first]])[of_pair]
        gain[closing] = 0
        if kind == 1:
            gain += np.where(real, times, -times) * known.before_part(before)[of_word]
        own = (of_block << 15) | (row & 0x7FFF)
        distinct, of = np.unique(own, return_inverse=True)
        total = np.bincount(of, gain, len(distinct))
        cuts = np.searchsorted(distinct, np.arange(len(some) + 1) << 15)
        for k, r in enumerate(some):
            part = slice(cuts[k], cuts[k + 1])
            yield {
                "block": r["block"],
                "rows": (distinct[part] & 0x7FFF).astype("<u2").tobytes(),
                "sums": total[part].tobytes(),
            }


def _table(rows: Iterator[dict], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    names = [f.split(" ") for f in schema.split(", ")]
    rows = list(rows)
    return pa.table({n: pa.array([r.get(n) for r in rows], kinds[k]) for n, k in names})


def _totals(found: pa.Table) -> pa.Table:
    """Rows of one block, from its own sums and those of the slices."""
    rows = found.to_pylist()
    (head,) = (r for r in rows if r["ids"] is not None)
    ids, known = np.frombuffer(head["ids"], "<i8"), np.frombuffer(head["known"], bool)
    sizes, sums = np.frombuffer(head["sizes"], "<i8"), np.frombuffer(head["sums"]).copy()
    for r in rows:
        if r["ids"] is None:
            sums[np.frombuffer(r["rows"], "<u2")] += np.frombuffer(r["sums"])
    score = sums / np.maximum(sizes, 1)
    return pa.table(
        {"doc_id": pa.array(ids, mask=~known), "n_tokens": pa.array(sizes), "score": pa.array(score)}
    )


def word_cross_entropy_difference(
    docs: DataFrame,
    is_target: Column,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    smoothing: float = SMOOTHING,
    frequent: int = FREQUENT,
    slice_words: int = SLICE_WORDS,
) -> DataFrame:
    """(doc_id, n_tokens, score) of every row: the mean over its words of the loss under the
    target model less the loss under the background model; below 0 is nearer the target.

    Words are cut at ASCII white space and compared in lower case, as 64-bit hashes. Rows
    where ``is_target`` is true are the target corpus, all rows the background. Null and
    empty texts have no words and score 0; without target texts the target model is uniform;
    repeated rows count repeatedly, rows without an id like others; an empty table gives no
    rows; other columns are ignored.

    Texts are read three times: to count words, to count the at most ``frequent`` words and
    pairs that make up one in ``frequent`` of all, and to score. Only those counts reach the
    driver. Pairs are exchanged once, packed, in slices of about ``slice_words`` words, so
    tasks stay the same size as the corpus grows.
    """
    texts = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.coalesce(is_target, F.lit(False)).alias("is_target"),
    )
    with held(word_counts(texts), "words") as counts:
        total = counts.agg(
            F.count(F.lit(1)).alias("words"),
            *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _COUNTS),
        ).first()
        often = counts.where(F.col("every") * frequent >= total["every"]).collect()
    often = {np.int64(r["word"]).astype(np.uint64): (r["target"], r["every"]) for r in often}
    words = np.array(sorted([_START, *often]), np.uint64)
    pairs = _frequent_counts(texts, words[1:]).where(
        F.col("word").isNull() | (F.col("every") * frequent >= total["every"])
    ).collect()
    before = {np.int64(r["before"]).astype(np.uint64): (r["target"], r["every"]) for r in pairs if r["word"] is None}
    kept = [(r["before"], r["word"], r["target"], r["every"]) for r in pairs if r["word"] is not None]
    mixes = np.array([(a, b) for a, b, _, _ in kept], np.int64).reshape(-1, 2).view(np.uint64)
    mixes = _mixed(mixes[:, 0], mixes[:, 1])
    order = np.argsort(mixes)
    known = _Known(
        totals=np.array([total[c] for c in _COUNTS], float),
        vocabulary=total["words"],
        words=words,
        counts=np.array([often.get(w, (0, 0)) for w in words], float).reshape(-1, 2),
        before=np.array([before.get(w, (0, 0)) for w in words], float).reshape(-1, 2),
        pairs=mixes[order],
        pair_counts=np.array([(t, e) for _, _, t, e in kept], float).reshape(-1, 2)[order],
        smoothing=smoothing,
        slices=int(total["every"] // slice_words + 1),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, block in enumerate(_blocks(batches)):
            yield from _table(_cut(block, f"{task}-{number}", known), _CUT).to_batches(64)

    def add(found: pa.Table) -> pa.Table:
        return _table(_part_sums(found, known), _PARTS)

    parts = texts.mapInArrow(cut, _CUT).groupBy("slice").applyInArrow(add, _PARTS)
    return parts.groupBy("block").applyInArrow(
        _totals, "doc_id bigint, n_tokens bigint, score double"
    )
