import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fareledger.llm import token_files as tf
from fareledger.llm.common import table
from tests.llm.cases import awkward

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 32), st.integers(0, 2**32 - 1))
def test_blocks_round_trip(seed, bits, base):
    rng = np.random.default_rng(seed)
    ids = np.minimum(rng.integers(0, 2**bits, (3, tf.BLOCK)) + base, 2**32 - 1).astype(np.uint32)
    ids[1, :: rng.integers(1, 200)] = 2**32 - 1
    ids[2] = base
    blocks = tf.encode_blocks(ids)
    starts = np.cumsum([0, *map(len, blocks[:-1])])
    assert (tf.decode_blocks(b"".join(blocks), starts) == ids).all()


def test_ids_are_the_tokenizers(plain):
    rng = random.Random(3)
    letters = [*"ab  \n\t\r\x0b.,'sé漢 A1😀", "<|endoftext|>", "  ", " '", "don't", " 1a", " ", "\x1c"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(50))) for _ in range(3000)] + [None, "", " "]
    ids, counts = tf.Encoder(PATH).ids(pa.array(texts))
    expect = [plain(t) for t in texts]
    assert counts.tolist() == list(map(len, expect)) and ids.tolist() == sum(expect, [])


def brute(rows, plain):
    out, start = [], 0
    for doc_id, text in rows:
        ids = plain(text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def got(df):
    return sorted(map(tuple, df.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])


def test_whole_table_round_trip(spark, plain, monkeypatch):
    monkeypatch.setattr(tf, "FILE_DOCS", 40)
    docs = table(spark, SF_DIR, "documents")
    files = tf.write_token_files(docs, PATH)
    assert files.count() > 2
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert got(tf.read_token_files(files)) == brute(rows, plain)
    reader = tf.Reader(files.orderBy("part").first().path)
    whole = reader.ids(0, reader.total)
    for a, b in [(0, 0), (5, 9), (1000, 3000), (reader.total - 1, reader.total)]:
        assert (reader.ids(a, b) == whole[a:b]).all()


def test_awkward_rows(spark, plain):
    docs = awkward(spark)
    found = got(tf.read_token_files(tf.write_token_files(docs, PATH)))
    assert [r[0] for r in found] == sorted((r.doc_id for r in docs.collect()), key=lambda x: (x is not None, x))
    assert [r[1] for r in found] == np.cumsum([0, *[r[2] for r in found[:-1]]]).tolist()
    expect = sorted((str(i), n, crc) for i, _, n, crc in brute([(r.doc_id, r.text) for r in docs.collect()], plain))
    assert sorted((str(i), n, crc) for i, _, n, crc in found) == expect
    assert tf.read_token_files(tf.write_token_files(docs.limit(0), PATH)).count() == 0


def test_written_out_special_tokens_are_the_untouched_tokenizers(spark):
    tokenizer = Tokenizer.from_file(PATH)

    def untouched(text):
        return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
    rng = random.Random(8)
    letters = ["<|endoftext|>", "<|endoftext|>", "<|endoftext", "|>", *"ab  \n\t.'s\u00e9", " 1a"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(600)]
    texts += ["<|endoftext|>", "one <|endoftext|> two", "one<|endoftext|>two", None]
    assert untouched("one<|endoftext|>")[-2] == 50256
    ids, counts = tf.encoder_of(PATH).ids(pa.array(texts))
    expect = [untouched(t) for t in texts]
    assert counts.tolist() == list(map(len, expect)) and ids.tolist() == sum(expect, [])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert got(tf.read_token_files(tf.write_token_files(docs, PATH))) == brute(list(enumerate(texts)), untouched)
