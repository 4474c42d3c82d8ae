"""Byte-level BPE and token files against the libraries themselves."""

import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from benchloom.llm import bpe, token_files
from benchloom.llm.columns import utf8

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
FILE = public_tokenizers.path("byte_bpe_50k.json")
LETTERS = "ab'stlm 1. \n é漢!\t 　\x85\x1c"


def random_texts(n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choice(LETTERS) for _ in range(draw.randint(0, 150))) for _ in range(n)]


def test_chunks_keep_the_ids():
    encoder = bpe.encoding(*RANKS)
    for text in random_texts(400, 1):
        for size in (1, 9, 40):
            assert "".join(bpe.chunks(text, size)) == text
            assert [i for x in bpe.chunks(text, size) for i in encoder.encode_ordinary(x)] == encoder.encode_ordinary(text)


def test_encode_and_decode(spark):
    encoder = bpe.encoding(*RANKS)
    assert isinstance(encoder, tiktoken.Encoding)
    got = bpe.decode(bpe.encode(brute.documents(spark), *RANKS), *RANKS).collect()
    assert sorted(bpe.round_trip(brute.documents(spark), *RANKS).collect(), key=str) == sorted(got, key=str)
    wanted = sorted((str(k), encoder.encode_ordinary(t or ""), (t or "").encode()) for k, t in brute.ROWS)
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in got) == wanted
    assert all(r.n_tokens == len(r.ids) // 4 for r in got)


def test_decode_of_parts_of_characters(spark):
    encoder = bpe.encoding(*RANKS)
    ids = np.array(encoder.encode_ordinary("漢"), "<u4")[:1].tobytes()
    rows = spark.createDataFrame([(1, bytearray(ids)), (2, None)], "doc_id bigint, ids binary")
    got = {r.doc_id: bytes(r.decoded) for r in bpe.decode(rows, *RANKS).collect()}
    assert got == {1: encoder.decode_bytes(np.frombuffer(ids, "<u4").tolist()), 2: b""}


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 70_000])
@pytest.mark.parametrize("high", [1, 300, 2**32 - 1])
def test_blocks_round_trip(n, high):
    ids = np.random.default_rng(n).integers(0, high, n, dtype=np.uint32)
    ids[::41] = high
    blocks, starts = token_files.pack(ids)
    assert (token_files.unpack(blocks, starts) == ids).all()
    if n > 1000:  # any block alone
        assert (token_files.unpack(blocks, starts[1:2]) == ids[512:1024]).all()


def test_encoder_is_the_library():
    library = Tokenizer.from_file(FILE)
    texts = random_texts(600, 2) + ["", " ", "  ", " a", "a "]
    own = token_files.Encoder(FILE)
    for _ in range(2):  # new spans, then remembered ones
        ids, counts = own.encode(*utf8(pa.array(texts)))
        ends = np.cumsum(counts)
        for text, end, n in zip(texts, ends, counts):
            assert ids[end - n : end].tolist() == library.encode(text, add_special_tokens=False).ids


def test_spans_that_meet_in_a_slot():
    own = token_files.Encoder(FILE)
    draw = np.random.default_rng(4)
    # Few different low bits, so most spans look at several slots; the table grows on the way.
    hashes = np.unique(draw.integers(0, 1 << 63, 6000, dtype=np.uint64) & ~np.uint64(0xFE0))
    draw.shuffle(hashes)
    known, other = hashes[:5000], hashes[5000:]
    for part in np.array_split(known, 7):
        assert (own.find(part) == -1).all()
        own.enter(part)
    assert (own.find(known) == np.arange(5000)).all() and (own.known == known).all()
    assert (own.find(other) == -1).all()
    own.forget()
    assert (own.find(known) == -1).all()


def test_files(spark, tmp_path):
    library = Tokenizer.from_file(FILE)
    token_files.write(brute.documents(spark), f"{tmp_path}/files", FILE)
    got = token_files.read(spark, f"{tmp_path}/files").orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted([k for k, _ in brute.ROWS], key=lambda k: (k is not None, k or 0))
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids) // 4)
        at += r.n_tokens
    wanted = sorted(zlib.crc32(np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()) for _, t in brute.ROWS)
    assert sorted(zlib.crc32(bytes(r.ids)) for r in got) == wanted


def test_empty_tables(spark, tmp_path):
    empty = brute.documents(spark, [])
    assert bpe.decode(bpe.encode(empty, *RANKS), *RANKS).count() == 0
    token_files.write(empty, f"{tmp_path}/files", FILE)
    assert token_files.read(spark, f"{tmp_path}/files").count() == 0


def test_strings_of_added_tokens():
    library = Tokenizer.from_file(FILE)
    texts = ["a <|endoftext|>b", "<|endoftext|>", "x<|endoftext|> y <|endoftext|><|endoftext|>  z", "<|endoftext"]
    own = token_files.Encoder(FILE)
    ids, counts = own.encode(*utf8(pa.array(texts * 3)))
    assert own.spans and ids.tolist() == [x for t in texts * 3 for x in library.encode(t, add_special_tokens=False).ids]
    assert 50256 in ids


def test_other_tokenizers_encode_whole_texts(tmp_path):
    from tokenizers import normalizers

    library = Tokenizer.from_file(FILE)
    library.normalizer = normalizers.Lowercase()
    library.save(str(tmp_path / "other.json"))
    own = token_files.Encoder(str(tmp_path / "other.json"))
    texts = ["A B  c", "", "D e"]
    ids, counts = own.encode(*utf8(pa.array(texts)))
    assert not own.spans and ids.tolist() == [x for t in texts for x in library.encode(t, add_special_tokens=False).ids]
    assert counts.tolist() == [len(library.encode(t).ids) for t in texts]
