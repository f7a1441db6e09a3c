"""Token ids of documents, in order, as shards of wavelet matrices."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from railpulse.llm.wavelet import WaveletMatrix
from railpulse.session import shared_folder

END = 1
SHARD_TOKENS = 1 << 20
_ROWS, _BYTES = 1000, 2 << 20  # of documents encoded at once; a longer text comes alone
#: Distinct words whose ids a worker keeps from task to task. Twice as many are held at
#: most: the older half goes when the newer is full, but for words met again since.
CACHED_WORDS = 400_000

#: A run of Latin letters and ASCII marks after it. An apostrophe may begin a contraction,
#: which is cut otherwise.
_SIMPLE = r"^(?P<run>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[!-&(-/:-@\[-`{-~]*)$"
_RUN = re.compile("[a-zß-öø-ÿ]+")
_LONG = 200  # bytes from which a word is encoded whole


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies: itself where it is
    printable Latin-1, else the next code point from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"={len(ids)}I", *ids)


def _gathered(
    flat: np.ndarray, sizes: np.ndarray, of: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(values of the groups ``of`` in turn, their sizes); ``flat`` holds the groups in a row."""
    first = (np.cumsum(sizes) - sizes)[of]
    sizes = sizes[of]
    ends = np.cumsum(sizes)
    at = np.repeat(first - (ends - sizes), sizes) + np.arange(int(sizes.sum()))
    return flat[at], sizes


class Encoder:
    """Token ids of texts, each distinct word encoded once.

    Only for tokenizers that cut at white space before anything else, drop it, and
    lower-case: there a text's ids are those of its words in turn. ``exact`` is checked
    by tests against whole-text encoding.
    """

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        self.levels = max(2, (self.tokenizer.get_vocab_size() - 1).bit_length())
        #: Ids of words as unsigned 32-bit numbers in a row: a list takes thrice the memory.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.letters = _byte_letters()

    def _whole(self, word: str) -> bytes:
        return _packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def _letters(self, word: str) -> bytes:
        """Ids of a run of Latin letters in lower case, straight from the model."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return _packed([t.id for t in self.model.tokenize(word)])

    def _missing(self, word: str) -> bytes:
        if (ids := self.older.get(word)) is None:
            run = len(word) < _LONG and _RUN.fullmatch(word)
            ids = self._letters(word) if run else self._whole(word)
        self.known[word] = ids
        return ids

    def _each(self, words: pa.Array) -> list[bytes]:
        """Ids of stretches without plain spaces and line ends."""
        words = words.to_numpy(zero_copy_only=False).tolist()
        each = list(map(self.known.get, words))
        for i, ids in enumerate(each):
            if ids is None:
                each[i] = self._missing(words[i])
        return each

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each word) of distinct words.

        Words of letters and marks are cut there: few runs in lower case, and fewer kinds
        of marks, make up many words.
        """
        cut = pc.extract_regex(words, _SIMPLE)
        simple = pc.and_(cut.is_valid(), pc.less(pc.binary_length(words), _LONG))
        run, marks = cut.field("run"), cut.field("marks")
        run = pc.if_else(simple, pc.utf8_lower(run), words).dictionary_encode()
        marks = pc.if_else(simple, marks, "").dictionary_encode()
        each = self._each(run.dictionary)
        of = np.empty(2 * len(words), np.int64)
        of[::2] = run.indices.to_numpy()
        of[1::2] = marks.indices.to_numpy() + len(each)
        each += self._each(marks.dictionary)
        sizes = np.fromiter(map(len, each), np.int64, len(each)) // 4
        ids, sizes = _gathered(np.frombuffer(b"".join(each), np.uint32), sizes, of)
        return ids, sizes[::2] + sizes[1::2]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each text)."""
        texts = pc.replace_substring(texts.cast(pa.large_string()).fill_null(""), "\n", " ")
        split = pc.split_pattern(texts, " ")
        words = split.flatten().dictionary_encode()
        if len(self.known) > CACHED_WORDS:
            self.known, self.older = {}, self.known
        ids, sizes = _gathered(*self._distinct(words.dictionary), words.indices.to_numpy())
        ends = np.concatenate([[0], np.cumsum(sizes)])
        bounds = split.offsets.to_numpy()
        return ids, np.diff(ends[bounds - bounds[0]])


_ENCODERS: dict[int, Encoder] = {}


def encoder(definition: str) -> Encoder:
    """The encoder of a tokenizer definition, kept by a worker from task to task."""
    key = zlib.crc32(definition.encode())
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(definition)
    return _ENCODERS[key]


def _pieces(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """The rows in turn, so many together that their texts have about ``most`` bytes."""
    first, held = 0, 0
    for row, size in enumerate(pc.binary_length(batch.column(1)).fill_null(0).to_pylist()):
        if row > first and (held + size > most or row - first >= _ROWS):
            yield batch.slice(first, row - first)
            first, held = row, 0
        held += size
    if first < batch.num_rows:
        yield batch.slice(first)


def _encoded_pieces(
    encode: Encoder, batch: pa.RecordBatch, most: int
) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """(all ids, number of ids of each text, doc_ids) of the pieces of (doc_id, text) rows."""
    for rows in _pieces(batch, most):
        values, sizes = encode.encode(rows.column(1))
        yield values, sizes, rows.column(0)
        # Else the pool keeps what the words of a piece took, in every worker.
        pa.default_memory_pool().release_unused()


def write_shards(
    docs: DataFrame,
    tokenizer: str,
    *,
    root: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    end: int = END,
    shard_tokens: int = SHARD_TOKENS,
) -> str:
    """Encode every text whole, append ``end``, and write the ids in ascending doc_id order.

    Returns the folder written (a fresh one in the shared folder without ``root``). Its
    rows are shards in the order of (part, shard): ``payload`` is one compressed file in
    the format of ``WaveletMatrix``, ``doc_ids`` and ``lengths`` are its documents and
    ``before`` the ids of earlier shards of its part. A shard ends with the few documents,
    encoded together, that fill ``shard_tokens``. ``tokenizer`` is the path of a tokenizer file on the driver.

    Null texts count as empty and hold the end id alone; null doc_ids come first; equal
    doc_ids are ordered by text; an empty table writes no shard; other columns are ignored.
    """
    definition = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text("utf-8"))
    root = root or shared_folder(docs.sparkSession, "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(definition.value)
        part = TaskContext.get().partitionId()
        ids, lengths, names, before, number = [], [], [], 0, 0

        def shard() -> pa.RecordBatch:
            nonlocal ids, lengths, names, before, number
            values, sizes = np.concatenate(ids), np.concatenate(lengths)
            kind = np.uint16 if encode.levels <= 16 else np.uint32
            data = WaveletMatrix.of(values.astype(kind), encode.levels).to_bytes()
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([number], pa.int32()),
                    pa.array([before], pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array([0, len(sizes)], pa.int32()), pa.concat_arrays(names)
                    ),
                    pa.array([sizes], pa.list_(pa.int64())),
                    pa.array([data], pa.binary()),
                ],
                names=["part", "shard", "before", "doc_ids", "lengths", "payload"],
            )
            before, number = before + len(values), number + 1
            ids, lengths, names = [], [], []
            return row

        held = 0
        for batch in batches:
            for values, sizes, of in _encoded_pieces(encode, batch, min(_BYTES, 4 * shard_tokens)):
                at = np.cumsum(sizes)
                values = np.insert(values, at, end)
                ids.append(values)
                lengths.append(sizes + 1)
                names.append(of)
                held += len(values)
                if held >= shard_tokens:
                    yield shard()
                    held = 0
        if held:
            yield shard()

    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    tie = F.xxhash64("text")
    (
        texts.repartitionByRange(F.col("doc_id").asc_nulls_first(), tie)
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
        .mapInArrow(
            run,
            "part int, shard int, before bigint, "
            f"doc_ids array<{kind}>, lengths array<bigint>, payload binary",
        )
        .write.parquet(root)
    )
    return root


def read_shards(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in written shards.

    ``start`` counts the ids of all documents before it. Only the number of ids of each
    part is summed up in one task.
    """
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()
    sizes = shards.groupBy("part").agg(
        F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, b: a + b)).alias("n")
    )
    total = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("part", F.coalesce(total, F.lit(0)).alias("_first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, before, names, lengths, data = (c[row] for c in batch.columns)
                values = WaveletMatrix.from_bytes(data.as_py()).values().astype("<u4")
                sizes = lengths.values.to_numpy()
                ends = np.cumsum(sizes)
                sums = [
                    zlib.crc32(values[a:b]) for a, b in zip(ends - sizes, ends, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(sizes), part.as_py(), np.int32)),
                        names.values,
                        pa.array(before.as_py() + ends - sizes),
                        pa.array(sizes),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["part", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    decoded = shards.select("part", "before", "doc_ids", "lengths", "payload").mapInArrow(
        run, f"part int, doc_id {kind}, at bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return decoded.join(offsets, "part").select(
        "doc_id", (F.col("at") + F.col("_first")).alias("start"), "n_tokens", "ids_crc32"
    )


def encoded(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the documents as shards and read them back."""
    spark = docs.sparkSession
    return read_shards(spark.read.parquet(write_shards(docs, tokenizer, **options)))
