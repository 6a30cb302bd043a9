import hashlib
import random
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_fixtures import documents, empty, odd_rows, sentences
from tokenizers import Tokenizer

from forecourt.llm import bpe, collocations, common
from forecourt.llm.queries import BYTE_VOCABULARY, QUERIES

PIECES = [
    "a", "b", " ", "  ", "\n", "\t", "<|endoftext|>", "'s", "'ll", "é", "日本", "1", "23", "!", "...", "\xa0", "\x1c",
    "　", "\x85", "the", "Hello", "😀", "\r\n", "_", "​", "aaaaaaa", " of", " ", "ß", "½",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_VOCABULARY)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_vocabulary(BYTE_VOCABULARY))


def batches():
    chance = random.Random(1)
    joined = ["".join(chance.choice(PIECES) for _ in range(chance.randrange(25))) for _ in range(4000)]
    spaced = [" ".join(chance.choice(PIECES) for _ in range(chance.randrange(25))) for _ in range(2000)]
    return joined, spaced, [sentences(i, 300) for i in range(20)], ["", " ", "<|endoftext|>", " <|endoftext|> x", "a  <|endoftext|>"]


@pytest.mark.parametrize("texts", batches())
def test_ids_and_text_match_the_library(library, encoder, texts):
    ids, counts = encoder.encode(pa.array(texts))
    assert encoder.decode(ids, counts) == texts
    at = 0
    for text, n, expected in zip(texts, counts, library.encode_batch(texts, add_special_tokens=False)):
        own = ids[at : at + n].tolist()
        at += n
        assert own == expected.ids
        assert library.decode(own, skip_special_tokens=False) == text


def test_half_characters_decode_as_in_the_library(library, encoder):
    ids = encoder.encode(pa.array(["日本語 😀"]))[0]
    for end in range(len(ids)):
        (own,) = encoder.decode(ids[:end], np.array([end]))
        assert own == library.decode(ids[:end].tolist(), skip_special_tokens=False)


def test_an_unknown_id_is_noticed(encoder):
    with pytest.raises((ValueError, IndexError)):
        encoder.decode(np.array([10**6]), np.array([1]))


def test_query_digests_odd_rows(spark, library, new_dir):
    documents(spark, odd_rows(), clashing=False).write.parquet(f"{new_dir}/documents.parquet")
    rows = QUERIES["op4_bpe"](spark, new_dir).collect()
    assert len(rows) == len(odd_rows())
    for row in rows:
        text = next(t for i, t, *_ in odd_rows() if i == row.doc_id) or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table_and_clashing_columns(spark):
    assert bpe.decode(bpe.encode(empty(spark), BYTE_VOCABULARY), BYTE_VOCABULARY).count() == 0
    encoded = bpe.encode(documents(spark, odd_rows()), BYTE_VOCABULARY)
    assert encoded.columns == ["doc_id", "ids"] and encoded.count() == len(odd_rows())


def test_vocabulary_is_a_parameter():
    assert public_tokenizers.path("byte_bpe_50k.json") == BYTE_VOCABULARY


def test_workers_work_on_little_at_once_and_give_memory_back(monkeypatch):
    given = []
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: SimpleNamespace(release_unused=lambda: given.append(1)))
    batch = pa.record_batch({"text": ["x" * 1000] * 20_000})
    for most in (bpe._BATCH_BYTES, collocations._SLICE_BYTES):
        cut = list(common.slices([batch], 1 << 20, most))
        assert max(part.nbytes for part in cut) < 4_000_000 and sum(part.num_rows for part in cut) == 20_000
    assert len(given) == 2
