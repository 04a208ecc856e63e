import os
import random
import struct

import pytest

from tracklens.llm.sentencepiece_fst import BPE, Model, decode, encode, load

PATH = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return load(PATH)


@pytest.fixture(scope="module")
def judge():
    library = pytest.importorskip("sentencepiece")
    return library.SentencePieceProcessor(model_file=PATH)


def test_texts_against_the_library(model, judge, spark, small):
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect()]
    for t in texts:
        ids = model.encode(t)
        assert ids == judge.encode(t)
        assert model.decode(ids) == judge.decode(ids) == t


def test_random_texts_and_ids_against_the_library(model, judge):
    rng = random.Random(1)
    letters = "aabcdeeinorst      \n\t▁éñ漢字😀.,<>0x12_-'\"AZ\u0000"
    for _ in range(3000):
        t = "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
        assert model.encode(t) == judge.encode(t)
    for _ in range(1500):
        ids = [rng.randrange(32_000) if rng.random() < 0.6 else rng.randrange(3, 259) for _ in range(rng.randrange(12))]
        assert model.decode(ids) == judge.decode(ids)


def test_frame_round_trip(odd, empty):
    clash = odd.withColumnsRenamed({"lang": "tokens", "source": "round_trip"})
    got = encode(clash, PATH, check=True)
    rows = got.collect()
    assert len(rows) == odd.count() and all(r.round_trip in (True, None) for r in rows)
    assert all(r.n_tokens == len(r.tokens) and (r.n_tokens > 0) == bool(r.text) for r in rows)
    back = decode(got.withColumnRenamed("text", "was"), PATH)
    assert all(r.text == (r.was or "") for r in back.collect())
    assert encode(empty, PATH).count() == 0


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def message(*fields):
    out = b""
    for number, value in fields:
        if isinstance(value, int):
            out += varint(number << 3) + varint(value)
        elif isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        else:
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def test_unigram_takes_the_lightest_path():
    pieces = [("<unk>", 0.0, 2), ("▁", -3.0, 1), ("▁ab", -4.0, 1), ("a", -2.0, 1), ("b", -2.5, 1), ("abc", -1.0, 1), ("c", -9.0, 1)]
    data = b"".join(message((1, message((1, p.encode()), (2, s), (3, k)))) for p, s, k in pieces)
    model = Model(data + message((2, message((3, 1))), (3, message((3, 1), (4, 0), (5, 1)))))
    assert [model.names[i] for i in model.encode("abc")] == ["▁", "abc"]
    assert [model.names[i] for i in model.encode("ab")] == ["▁ab"]
    assert model.encode("z")[-1] == 0
    assert model.kind != BPE
