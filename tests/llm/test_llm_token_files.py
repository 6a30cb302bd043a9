import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import documents, empty, odd_rows, sentences
from tokenizers import Tokenizer

from forecourt.llm import shared_files, token_files as tf
from forecourt.llm.queries import WORD_VOCABULARY

PIECES = [
    "a", "B", " ", "\n", "\t", "<|endoftext|>", "<|startoftext|>", "'s", "'LL", "é", "É", "日本", "1", "23", "!", "...",
    ",", "\xa0", "\x1c", "　", "The", "Hello", "😀", "é", "_", "J̌", "Σ", "İ", "ß", "?", "(", ")", "ﬁ", "|",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_VOCABULARY)


def expected(library, texts):
    return [e.ids + [tf.END_ID] for e in library.encode_batch(texts, add_special_tokens=False)]


def test_words_put_together_match_the_library(library):
    chance = random.Random(1)
    texts = ["".join(chance.choice(PIECES) for _ in range(chance.randrange(25))) for _ in range(6000)]
    texts += ["", " ", "foo, Bar; (baz) it's 'tis", sentences(1, 500)]
    ids, counts = tf.WordEncoder(tf.read_vocabulary(WORD_VOCABULARY)).encode(pa.array(texts), tf.END_ID)
    assert [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])] == expected(library, texts)


def test_files_hold_every_document_in_order(spark, library):
    rows = [(i, sentences(i, 30 + i), "en", "s") for i in range(400)]
    random.Random(2).shuffle(rows)
    found = {r.doc_id: r for r in tf.round_trip(spark, documents(spark, rows), WORD_VOCABULARY).collect()}
    start = 0
    for i, ids in enumerate(expected(library, [sentences(i, 30 + i) for i in range(400)])):
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (found[i].start, found[i].n_tokens, found[i].ids_crc32) == (start, len(ids), crc)
        start += len(ids)


def test_one_short_document_is_read_by_its_range(spark, library, new_dir):
    docs = documents(spark, [(i, sentences(i, 50), "en", "s") for i in range(300)])
    index = tf.write_token_files(docs, WORD_VOCABULARY, new_dir)
    row = tf.read_token_files(index.where("doc_id = 123"), new_dir, 49408).collect()
    assert np.frombuffer(row[0].ids, "<u4").tolist() == expected(library, [sentences(123, 50)])[0]
    names = {r.dictionary for r in index.select("dictionary").distinct().collect()}
    data = shared_files.read_file(new_dir, f"{names.pop()}.dictionary")
    assert not names and 0 < len(data) <= tf.DICTIONARY_BYTES


def test_a_changed_dictionary_is_noticed(spark, new_dir):
    docs = documents(spark, [(1, "some words", "en", "s")])
    index = tf.write_token_files(docs, WORD_VOCABULARY, new_dir)
    name = index.first().dictionary
    shared_files.write_file(new_dir, f"{name}.dictionary", b"other")
    with pytest.raises(ValueError, match="other content"):
        tf._reader.__wrapped__(new_dir, name)


def test_odd_rows_and_empty_table(spark, library):
    rows = tf.round_trip(spark, documents(spark, odd_rows()), WORD_VOCABULARY).collect()
    assert len(rows) == len(odd_rows())
    for row in rows:
        text = next(t for i, t, *_ in odd_rows() if i == row.doc_id) or ""
        ids = expected(library, [text])[0]
        assert (row.n_tokens, row.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert min(rows, key=lambda r: r.start).doc_id is None
    assert tf.round_trip(spark, empty(spark), WORD_VOCABULARY).count() == 0


def test_ranges_are_coalesced_within_limits(new_dir):
    file = shared_files.Appender(new_dir, "x")
    pieces = [bytes([i]) * 1000 for i in range(200)]
    ranges = [("x", *file.write(p)) for p in pieces]
    file.write(b"-" * shared_files.GAP_BYTES * 2)
    ranges.append(("x", *file.write(b"end")))
    file.close()
    some = ranges[::7] + ranges[-1:] + ranges[:2]
    assert list(shared_files.read_ranges(new_dir, some)) == [([*pieces, b"end"])[ranges.index(r)] for r in some]
    assert len(list(shared_files._coalesced(some))) == 3


def test_dictionary_sample_is_bounded_and_spread(spark):
    long = " ".join(sentences(i, 20) for i in range(200))
    texts = [f"{i} {long}" for i in range(1500)] + ["same"] * 300
    sample = tf.dictionary_sample(documents(spark, [(None, t, "en", "s") for t in texts])).toPandas().text
    assert len(sample) == pytest.approx(tf.SAMPLE_PIECES, rel=0.15)
    assert sample.str.len().max() <= tf.PIECE_CHARS and (sample == "same").sum() <= 1
