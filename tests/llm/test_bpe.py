import gc
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from closewright.llm import bpe
from closewright.llm.queries import vocabulary

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


def expected(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


CASES = [
    "", "   ", "it's we'LL don't THEY'RE", "<|startoftext|>hi<|endoftext|> there <|x|>", "ΑΣ ΣΑΣ", "İstanbul ﬁ é é ½ ² Ⅷ 123", "x\x1cy a\x85b​c",
    "日本語テキスト 中文", "😀😀!!??", "a" * 3000, "\x00\x01 a\x00", "ab" * 500 + "!", "aaab aab aaa abab",
]


@pytest.mark.parametrize("text", CASES)
def test_encodes_like_the_library(library, text):
    ids, decoded = bpe.encoder(vocabulary()).encode(text)
    assert (np.frombuffer(ids, "<u4").tolist(), decoded) == expected(library, text)
    assert bpe.encoder(vocabulary()).decode(ids) == decoded


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdeinorst'ÉéñßΣ0 19!?#%.\n"), max_size=60))
def test_random_texts(text):
    library = tokenizers.Tokenizer.from_file(vocabulary())
    ids, decoded = bpe.encoder(vocabulary()).encode(text)
    assert (np.frombuffer(ids, "<u4").tolist(), decoded) == expected(library, text)


def test_every_token_is_its_own_last_token():
    """A vocabulary token spelled alone is one token, and its halves are compatible only if nothing merges over them."""
    coder = bpe.encoder(vocabulary())
    for token, i in random.Random(3).sample(sorted(coder.vocab.items()), 500):
        if token.endswith(coder.end):
            assert coder.encode_word(token.removesuffix(coder.end)) == (i,)
    for pair, rank in list(coder.rank.items())[:200]:
        assert not coder.fits(*pair)


def test_full_memory_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(bpe, "KEPT_BYTES", 700)
    monkeypatch.setattr(bpe, "_KEPT_FITS", 3)
    monkeypatch.setattr(bpe, "KEPT_LETTERS", 6)
    coder = bpe.PrefixEncoder(vocabulary())
    text = "one two three two one four five one " * 3
    assert np.frombuffer(coder.encode(text)[0], "<u4").tolist() == expected(library, text)[0]


def test_documents(frame, library):
    docs = frame([(1, "Hello world", 9), (1, "Hello world", 9), (None, None, 8), (3, "", 7), (4, "x " * 20000, 6)], "doc_id long, text string, ids int")
    got = bpe.digests(bpe.encode_documents(docs, vocabulary())).collect()
    assert len(got) == 5
    for row in got:
        text = {1: "Hello world", 4: "x " * 20000}.get(row.doc_id, "")
        ids, decoded = expected(library, text)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.encode_documents(docs.limit(0), vocabulary()).count() == 0


def test_kept_words_are_encoded_once(monkeypatch):
    """200,000 distinct words fit in the bytes kept, with all chunks that hold them."""
    coder, letters, calls = bpe.PrefixEncoder(vocabulary()), "bcdfghjklm", []
    encode_word = bpe.PrefixEncoder.encode_word
    monkeypatch.setattr(bpe.PrefixEncoder, "encode_word", lambda self, word: calls.append(word) or encode_word(self, word))
    text = " ".join("q" + "".join(letters[int(d)] for d in f"{k:06}") for k in range(200_000))
    first = coder.encode(text)
    assert len(calls) == 200_000
    assert coder.encode(text) == first and len(calls) == 200_000


def test_many_texts_at_once(library):
    texts = [*CASES, "", "foo Foo foo, İ̇x foo", "<|endoftext|>", "i̇x İx"]
    ids, decoded = bpe.PrefixEncoder(vocabulary()).encode_all(texts)
    for text, i, d in zip(texts, ids, decoded, strict=True):
        assert (np.frombuffer(i, "<u4").tolist(), d) == expected(library, text)


def test_a_task_leaves_no_encoder_in_its_worker(spark):
    """Spark's workers live on beside the tasks of other operators, so what a task has kept must go with it."""

    def held(batches):
        for _ in batches:
            pass
        yield pa.RecordBatch.from_arrays([pa.array([sum(isinstance(x, bpe.PrefixEncoder) for x in gc.get_objects())], pa.int64())], names=["n"])

    docs = spark.range(64, numPartitions=8).selectExpr("id AS doc_id", "concat('word', id, ' more') AS text")
    for _ in range(2):
        assert bpe.encode_documents(docs, vocabulary()).agg({"n_tokens": "sum"}).first()[0] > 64
        assert {r.n for r in spark.range(64, numPartitions=8).mapInArrow(held, "n long").collect()} == {0}
