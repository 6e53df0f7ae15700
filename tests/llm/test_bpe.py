import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.tables import ODD, no_documents, odd_documents
from tidemark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def ours():
    return bpe.Codec(PATH)


@pytest.fixture(scope="module")
def theirs():
    return Tokenizer.from_file(PATH)


def ids(codec, text):
    return np.frombuffer(codec.encode(text), "<u4").tolist()


def test_random_texts(ours, theirs):
    rng = random.Random(4)
    parts = list("aaabcdeEFst '  \n\t.,!?0123ée漢字😀-_") + ["<|endoftext|>", "'s", "'ll", "  ", " the", "ing", " ", "　", "\u0085"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        expected = theirs.encode(text, add_special_tokens=False).ids
        assert ids(ours, text) == expected
        assert ours.decode(ours.encode(text)) == theirs.decode(expected, skip_special_tokens=False)


def test_every_character_is_cut_alike(ours, theirs):
    rng = random.Random(5)
    for c in rng.sample([c for c in range(0x110000) if not 0xD800 <= c < 0xE000], 4000):
        text = f"a{chr(c)}1{chr(c)} {chr(c)}{chr(c)}\n"
        assert ids(ours, text) == theirs.encode(text, add_special_tokens=False).ids


def test_tokens_split_back(ours):
    """Every token is the encoding of its own bytes, and compatible neighbours are what merging gives."""
    rng = random.Random(6)
    for a, b in zip(rng.sample(sorted(ours.ids), 400), rng.sample(sorted(ours.ids), 400), strict=True):
        alone = ours.encode_bytes(a + b) == [ours.ids[a], ours.ids[b]]
        assert ours.compatible(ours.ids[a], ours.ids[b]) == alone


def test_time_is_linear_in_long_pieces(ours, theirs):
    text = "a" * 30000 + "ab" * 5000 + "the" * 3000
    assert ids(ours, text) == theirs.encode(text, add_special_tokens=False).ids


def test_caches_start_anew(theirs, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    monkeypatch.setattr(bpe, "PAIR_ENTRIES", 3)
    codec = bpe.Codec(PATH)
    text = "one two three four five six one two three unbelievably seven"
    assert ids(codec, text) == theirs.encode(text, add_special_tokens=False).ids
    assert len(codec._word_cache) <= 3


def test_odd_rows(spark, theirs):
    found = bpe.round_trip_digest(odd_documents(spark), PATH).collect()
    expected = []
    for key, text, _ in ODD:
        own = theirs.encode(text or "", add_special_tokens=False).ids
        packed = np.array(own, "<u4").tobytes()
        expected.append((key, len(own), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_encode_then_decode(spark):
    back = bpe.decode_documents(bpe.encode_documents(odd_documents(spark), PATH), PATH).collect()
    assert sorted(map(repr, map(tuple, back))) == sorted(repr((k, t or "")) for k, t, _ in ODD)


def test_empty_table(spark):
    assert bpe.round_trip_digest(no_documents(spark), PATH).collect() == []
