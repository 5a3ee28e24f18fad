import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from assay.llm import bpe

from .edge import EDGE, docs

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


TEXTS = EDGE + [(200, "ab" * 40_000), (201, "a" * 5000), (202, "<|endoftext|><|endoftext|>x <|endoftext|"), (203, " \n" * 500),
                (204, "don't we'll I'M you're"), (205, "".join(map(chr, range(1, 0x2FF))))]


def test_tables_equal_the_library(spark, library):
    got = bpe.digest_tokens(docs(spark, TEXTS), PATH).collect()
    want = []
    for i, text in TEXTS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(back.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.digest_tokens(docs(spark, []), PATH).collect() == []


def test_round_trip_on_a_table(spark):
    df = docs(spark, TEXTS)
    back = bpe.decode_tokens(bpe.encode_texts(df, PATH), PATH)
    assert set(df.columns) < set(back.columns)
    assert all(r.decoded == (r.text or "") for r in back.collect())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_texts_equal_the_library(library, texts):
    got = bpe.Encoder(bpe.vocabulary(PATH)).encode(texts)
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [bpe.vocabulary(PATH).decode(x) for x in got] == [library.decode(x, skip_special_tokens=False) for x in got]


def test_full_table_starts_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 50)
    monkeypatch.setattr(bpe, "BATCH_PIECES", 7)
    rnd = random.Random(1)
    encoder = bpe.Encoder(bpe.vocabulary(PATH))
    for _ in range(20):
        texts = [" ".join(f"word{rnd.randrange(300)}" for _ in range(20)) + " <|endoftext|>" for _ in range(4)]
        assert encoder.encode(texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_special_tokens_as_text_are_one_token(library):
    assert bpe.Encoder(bpe.vocabulary(PATH)).encode(["a<|endoftext|>b"]) == \
        [library.encode("a<|endoftext|>b", add_special_tokens=False).ids]
