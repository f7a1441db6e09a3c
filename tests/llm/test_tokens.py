import random
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from railpulse.llm import tokens
from railpulse.llm.queries import REGISTRY, TOKENIZER
from railpulse.llm.tokens import Encoder, encoded, write_shards
from railpulse.llm.wavelet import WaveletMatrix

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(TOKENIZER)


@pytest.mark.parametrize("levels", [1, 5, 16, 20])
@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 3000])
def test_wavelet_matrix(levels, n):
    rng = np.random.default_rng(n + levels)
    values = rng.integers(0, min(1 << levels, 40), n).astype(np.uint32)
    matrix = WaveletMatrix.from_bytes(WaveletMatrix.of(values, levels).to_bytes())
    assert (matrix.values() == values).all()
    for i in rng.integers(0, n, 20) if n else ():
        i = int(i)
        assert matrix.access(i) == values[i]
        v = int(values[i])
        places = np.flatnonzero(values == v)
        assert matrix.count(v) == len(places)
        assert matrix.count(v, i) == (places >= i).sum()
        k = int(rng.integers(0, len(places)))
        assert matrix.occurrence(v, k) == places[k]
    with pytest.raises(IndexError):
        matrix.occurrence(0, n)


def test_each_piece_returns_what_arrow_held(monkeypatch):
    released, pool = [], pa.default_memory_pool()
    counting = SimpleNamespace(release_unused=lambda: released.append(pool.release_unused()))
    monkeypatch.setattr(tokens.pa, "default_memory_pool", lambda: counting)
    encoder = Encoder(open(PATH, encoding="utf-8").read())
    texts = ["some words of a text " * 9, None, "", "more of them"] * 5
    batch = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array(texts)], names=["doc_id", "text"])
    got = list(tokens._encoded_pieces(encoder, batch, 200))
    assert len(released) == len(got) > 3
    assert [i for _, _, ids in got for i in ids.to_pylist()] == list(range(20))
    assert np.concatenate([v for v, _, _ in got]).tolist() == encoder.encode(pa.array(texts))[0].tolist()


def test_words_encode_as_whole_texts():
    text = Tokenizer.from_file(PATH)
    encoder = Encoder(open(PATH, encoding="utf-8").read())
    rng = random.Random(1)
    bits = ["it's", "don't", "the", "The,", "Élan", "straße.", "ÅÄ", "İstanbul", "ΟΔΟΣ", "é", "́",
            "x1y2", "<|endoftext|>", "a<|startoftext|>b", "??!", "日本語", "\t", "\n", "\x1c", " ",
            " ", "  ", "'s", "A'S", "½", "_", "naïve;", "ÿ", "×"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " ", "\n"]) for _ in range(rng.randint(0, 12))) for _ in range(500)]
    texts += [None, "", " ", "\n\n", "a" * 5000, "é" * 3000]
    ids, sizes = encoder.encode(pa.array(texts, pa.string()))
    ends = np.cumsum(sizes)
    for t, a, b in zip(texts, ends - sizes, ends, strict=True):
        assert ids[a:b].tolist() == text.encode(t or "", add_special_tokens=False).ids, repr(t)


def test_words_are_looked_up_as_runs_and_marks():
    text = Tokenizer.from_file(PATH)
    encoder = Encoder(open(PATH, encoding="utf-8").read())
    runs = ["many", "MANY", "Many", "élan", "ÉLAN", "straße", "a" * 199, "a" * 200, "b" * 198, "é" * 100]
    texts = [" ".join(r + m for r in runs) for m in ["", ",", ".", "!?", ";", '"', ")."]]
    ids, sizes = encoder.encode(pa.array(texts))
    assert sizes.tolist() == [len(text.encode(t, add_special_tokens=False).ids) for t in texts]
    assert ids.tolist() == [i for t in texts for i in text.encode(t, add_special_tokens=False).ids]
    words = {w for t in texts for w in t.split()}
    assert len([w for w in encoder.known if len(w) < 90]) < 15 < len(words)
    assert {"many", ",", "élan"} <= set(encoder.known) and "Many," not in encoder.known


def expected(rows):
    text = Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc_id, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = text.encode(t or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def by_start(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[1])


def test_query_against_whole_encoding(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert by_start(REGISTRY["op2_token_shards"](spark, SF)) == expected(rows)


def test_odd_rows(spark, documents):
    rows = [(5, "five words are written here"), (None, "no id"), (2, None), (2, "twice"), (2, "twice"), (9, ""), (7, "long " * 50_000)]
    assert by_start(encoded(documents(rows), PATH, shard_tokens=100)) == expected(rows)
    assert encoded(documents(rows).limit(0), PATH).count() == 0


def test_shards_are_files_of_their_own(spark, documents):
    rows = [(i, f"word{i} and more {i * 7}") for i in range(300)]
    root = write_shards(documents(rows), PATH, shard_tokens=500)
    shards = spark.read.parquet(root).orderBy("part", "shard").collect()
    assert len(shards) > 3
    ids = np.concatenate([WaveletMatrix.from_bytes(bytes(s.payload)).values() for s in shards])
    text = Tokenizer.from_file(PATH)
    whole = [i for _, t in rows for i in [*text.encode(t, add_special_tokens=False).ids, 1]]
    assert ids.tolist() == whole
