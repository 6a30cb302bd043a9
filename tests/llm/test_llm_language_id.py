import math
import zlib
from collections import Counter

import duckdb
import pytest
from llm_fixtures import documents, empty, odd_rows

from forecourt.llm import language_id as li
from forecourt.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain_buckets(text):
    letters = " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())
    padded = f" {letters} "
    return Counter(padded[i : i + n] for n in range(1, li.LARGEST_N + 1) for i in range(len(padded) - n + 1))


def test_every_ngram_is_counted_once():
    for text in ("abc dé", "x", "a1b_c", "Straße " * 50):
        grams = plain_buckets(text)
        assert sum(len(b) for b in li.ngram_buckets(text)) == grams.total()
        assert len({int(b) for part in li.ngram_buckets(text) for b in part}) == len(grams)


def test_pieces_add_up(monkeypatch):
    text = "the quick brown fox jumps over the lazy dog " * 20
    whole = Counter(int(b) for part in li.ngram_buckets(text) for b in part)
    monkeypatch.setattr(li, "_PIECE", 7)
    assert Counter(int(b) for part in li.ngram_buckets(text) for b in part) == whole


def test_posteriors_match_a_plain_model(spark):
    rows = [(i, "abc abd abe" if i % 2 else "xyz xyw", "l1" if i % 2 else "l2", "s") for i in range(40)]
    docs = documents(spark, rows)
    model = li.train(docs)
    counts = {"l1": Counter(), "l2": Counter()}
    for i, text, lang, _ in rows:
        if zlib.crc32(str(i).encode()) % 3 != 1:
            counts[lang].update(plain_buckets(text))
    sample = "abc xy"
    likelihood = {
        lang: sum(
            n * math.log((c[g] + li.SMOOTHING) / (c.total() + li.SMOOTHING * li.BUCKETS))
            for g, n in plain_buckets(sample).items()
        )
        for lang, c in counts.items()
    }
    best = max(likelihood, key=likelihood.get)
    name, score = li.predict_one(sample, model)
    assert name == best
    assert score == pytest.approx(1 / sum(math.exp(v - likelihood[best]) for v in likelihood.values()), rel=1e-6)


def test_held_out_documents_are_recognised(spark):
    lang = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    rows = QUERIES["op8_language_id"](spark, SF).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held_out = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held_out) / len(held_out) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_rows_teach_nothing(spark):
    held_out = [i for i in range(30) if zlib.crc32(str(i).encode()) % 3 == 1]
    rows = [(i, "qqq", "zz", "s") for i in held_out] + [(None, "qqq", "zz", "s")]
    assert li.train(documents(spark, rows)).languages == ()


def test_odd_rows_and_empty_table(spark):
    docs = documents(spark, odd_rows())
    found = li.predict(docs, li.train(docs)).collect()
    assert len(found) == len(odd_rows())
    for row in found:
        text = next(t for i, t, *_ in odd_rows() if i == row.doc_id)
        assert (row.lang_pred == "und") == (not any(map(str.isalpha, text or "")))
    assert li.predict_one("½ ²", li.train(docs)) == ("und", 0.0)
    assert li.predict(empty(spark), li.train(empty(spark))).count() == 0
    assert li.predict_one("words", li.train(empty(spark))) == ("und", 0.0)


def test_scores_do_not_depend_on_the_batch(spark, monkeypatch):
    docs = documents(spark, [(i, "abc abd abe" if i % 2 else "xyz xyw", "l1" if i % 2 else "l2", "s") for i in range(40)])
    model = li.train(docs)
    texts = ["abc xy " * 30, None, "", "12", "xyw abd", "abe " * 200, "ä", "abc xy " * 30]
    alone = [li.predict_one(text, model) for text in texts]
    assert li.predict_batch(texts, model) == alone == li.predict_batch(texts[::-1], model)[::-1]
    assert [name for name, _ in alone][1:4] == ["und"] * 3
    monkeypatch.setattr(li, "_CUT", 50)
    cut = [li.predict_one(text, model) for text in texts]
    assert li.predict_batch(texts, model) == cut
    assert [name for name, _ in cut] == [name for name, _ in alone]
    assert [score for _, score in cut] == pytest.approx([score for _, score in alone])
