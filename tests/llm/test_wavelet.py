"""Wavelet shards against the tokenizer and plain arrays."""

import os
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from siftspark.llm.queries import QUERIES
from siftspark.llm.wavelet import Encoder, Matrix, open_matrix, read_shards, to_bytes, with_starts, write_shards

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def expected(rows):
    """doc_id, start, n_tokens, ids_crc32 of rows in order."""
    tokenizer, at = Tokenizer.from_file(WORD_BPE), 0
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        yield doc_id, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        at += len(ids)


def matrix_of(ids, docs=((7, 0),)):
    data = b"".join(to_bytes(np.array(ids, np.uint32), [d for d, _ in docs], np.array([e for _, e in docs], np.int64)))
    return Matrix(lambda at, n: data[at : at + n])


@pytest.mark.parametrize("size, top", [(1, 1), (50, 1), (3000, 5), (70_000, 49_408), (40_000, 1 << 20)])
def test_access_count_and_select(size, top):
    rng = np.random.default_rng(size)
    ids = np.minimum(rng.integers(0, top, size), rng.integers(0, top, size))
    matrix = matrix_of(ids, [(None, 1), (-5, size)])
    assert (matrix.ids() == ids).all()
    assert matrix.documents()[0] == [None, -5] and list(matrix.documents()[1]) == [1, size]
    for i in rng.integers(0, size, 40):
        token = int(ids[i])
        places = np.flatnonzero(ids == token)
        assert matrix.access(int(i)) == token
        lo, hi = sorted(int(x) for x in rng.integers(0, size + 1, 2))
        assert matrix.count(token, lo, hi) == int(((places >= lo) & (places < hi)).sum())
        k = int(rng.integers(0, len(places)))
        assert matrix.select(token, k) == places[k]
    assert matrix.count(1 << 25) == 0 and matrix.count(-1) == 0 and matrix.count(int(ids[0]), 5, 2) == 0
    for wrong in (lambda: matrix.access(size), lambda: matrix.select(int(ids[0]), size), lambda: matrix.select(1 << 25, 0)):
        with pytest.raises(IndexError):
            wrong()


def test_access_reads_few_blocks():
    ids = np.random.default_rng(1).integers(0, 1 << 16, 400_000)
    data, read = b"".join(to_bytes(ids.astype(np.uint32), [1], np.array([len(ids)]))), []
    matrix = Matrix(lambda at, n: read.append(n) or data[at : at + n])
    read.clear()
    assert matrix.access(200_000) == ids[200_000]
    assert len(read) <= 16 and sum(read) < len(data) / 8


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        Matrix(lambda at, n: b"\0" * n)


def test_words_are_encoded_as_in_their_texts():
    tokenizer, encoder, r = Tokenizer.from_file(WORD_BPE), Encoder(WORD_BPE), random.Random(5)
    parts = list("abzAZ09 .,;:!?'\"<|>[]_-é́ÄßÉñΣςİıſKक़\xa0\x1c\x85\t\n\x0b日가\U0001f600ﬁǅ#*$%&")
    parts += ["<|endoftext|>", "<|ENDOFTEXT|>", "don't ", "I'LL", " '", "word,", "Word.'s", "  ", "ÉTÉ!"]
    texts = ["".join(r.choices(parts, k=r.randint(0, 40))) for _ in range(5000)]
    assert encoder.by_words
    ids, ends = encoder(pa.array(texts))
    for text, at, end in zip(texts, [0, *ends], ends):
        assert list(ids[at:end]) == tokenizer.encode(text, add_special_tokens=False).ids + [1]
    other = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    ids, ends = other(pa.array(["Two words", "", "x  y"]))
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.by_words
    assert list(ids[: ends[0]]) == plain.encode("Two words", add_special_tokens=False).ids + [1]
    assert list(ids[ends[0] : ends[1]]) == [1]


def test_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = {tuple(r) for r in QUERIES["op12_wavelet_shards"](spark, SF_DIR).collect()}
    assert found == set(expected(sorted(tuple(r) for r in rows)))


def test_edges(spark, docs, tmp_path):
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0]))
    for name, ids in (("many", 50), ("one", 1 << 22)):
        shards = with_starts(write_shards(docs, str(tmp_path / name), WORD_BPE, ids)).cache()
        assert (shards.count() > 3) == (name == "many")
        found = read_shards(shards).collect()
        assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected(rows)))
        path = shards.orderBy("part", "place").first().path
        assert open_matrix(path).access(0) == Tokenizer.from_file(WORD_BPE).encode(rows[0][1]).ids[0]
        shards.unpersist()
    empty = write_shards(docs.limit(0), str(tmp_path / "none"), WORD_BPE)
    assert read_shards(with_starts(empty)).count() == 0
