import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import documents, empty, odd_rows, sentences

from forecourt.llm import quality
from forecourt.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeats += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, repeats, len(covered), failed


NO_REFERENCES = quality.References((), np.zeros((0, 8)), np.zeros(quality.N_BUCKETS, np.int64), np.zeros((0, 1)))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\t\x0b\x1c\xa0é#|😀", max_size=120))
def test_counts_match_plain_ones(text):
    assert quality.judge(text, NO_REFERENCES, quality.Thresholds())[:6] == plain_counts(text)


def test_distance_is_zero_for_equal_and_one_for_disjoint():
    p = np.array([0.5, 0.5, 0, 0])
    assert quality.jensen_shannon(p, np.array([p, [0, 0, 0.5, 0.5]])) == pytest.approx([0, 1])


def test_strange_documents_go_and_plain_ones_stay(spark):
    plain = [(i, sentences(i, 150, 40), "en", "a") for i in range(60)]
    strange = [(100, " ".join(f"{c}$$$%%%&&&" for c in sentences(9, 150, 40).split()), "en", "a")]
    other_words = [(101, sentences(3, 150, 40).replace("w", "q"), "en", "a")]
    report = quality.quality_report(documents(spark, plain + strange + other_words)).toPandas().set_index("doc_id")
    assert report.kept[list(range(60))].all() and not report.base_failed[[100, 101]].any()
    assert not report.kept[100] and report.char_distance[100] > 0.3
    assert not report.kept[101] and report.word_distance[101] > 0.5


def test_short_documents_are_not_judged_by_distance():
    references = quality.References(("en",), np.eye(1, 8), np.zeros(quality.N_BUCKETS, np.int64), np.ones((1, 2)) / 2)
    result = quality.judge("1 " * 60, references, quality.Thresholds())
    assert result[6:8] == (None, None)


def test_references_count_the_whole_corpus(spark):
    docs = documents(spark, [(1, "aa bb", "x", "s"), (2, "aa CC1", "x", "s"), (3, "zz", "y", "s"), (4, "zz", None, "s")])
    references = quality.language_references(docs)
    assert references.languages == ("x", "y")
    assert references.classes[0][:4] == pytest.approx(np.array([6, 2, 1, 2]) / 11)
    column = references.column_of_bucket[quality.bucket_of(b"aa")]
    assert references.words[0][column] == pytest.approx(2 / 4)


def test_odd_rows_and_empty_table(spark):
    report = quality.quality_report(documents(spark, odd_rows())).collect()
    assert len(report) == len(odd_rows())
    for row in report:
        text = next(t for i, t, *_ in odd_rows() if i == row.doc_id) or ""
        assert tuple(row)[1:7] == plain_counts(text)
    assert quality.quality_report(empty(spark)).count() == 0
    kept = quality.keep_good(documents(spark, odd_rows()))
    assert kept.columns == documents(spark, odd_rows()).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in report if r.kept)


def plain_class(c):
    for name, chars in (("space", " \t\n\x0b\x0c\r"), ("punctuation", ".,;:!?'\"()-"), ("symbol", "#*$%&|<>")):
        if c in chars:
            return name
    if ord(c) > 127:
        return "beyond"
    return "lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "other"


def plain_distance(p, q):
    def entropy(h):
        return -sum(x * math.log2(x) for x in h.values() if x)

    middle = {k: (p.get(k, 0) + q.get(k, 0)) / 2 for k in {*p, *q}}
    return math.sqrt(max(0.0, entropy(middle) - (entropy(p) + entropy(q)) / 2))


def shares(counter):
    return {k: n / counter.total() for k, n in counter.items()}


def test_verdicts_on_given_documents_match_plain_ones(spark):
    rows = duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet'").fetchall()
    limits = quality.Thresholds()
    classes, words = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang in rows:
        if text is not None and lang is not None:
            classes[lang].update(map(plain_class, text))
            words[lang].update(zlib.crc32(w.encode()) % 16384 for w in WORD.findall(text))
    common = {b for c in words.values() for b, _ in sorted(c.items(), key=lambda item: (-item[1], item[0]))[:64]}
    word_references = [shares(Counter({b: n for b, n in c.items() if b in common} | {"rest": sum(n for b, n in c.items() if b not in common)})) for c in words.values()]
    class_references = [shares(c) for c in classes.values()]
    found = {r.doc_id: r for r in QUERIES["op6_quality"](spark, SF).collect()}
    assert len(found) == len(rows)
    judged = 0
    for doc_id, text, _ in rows:
        text = text or ""
        in_text = WORD.findall(text)
        *_, failed = plain_counts(text)
        row, strange = found[doc_id], False
        if len(text) >= limits.char_guard:
            own = shares(Counter(map(plain_class, text)))
            distance = min(plain_distance(own, q) for q in class_references)
            assert row.char_distance == pytest.approx(distance, abs=1e-6)
            strange |= distance > limits.max_char_distance
        if len(in_text) >= limits.word_guard:
            buckets = [zlib.crc32(w.encode()) % 16384 for w in in_text]
            own = shares(Counter(b if b in common else "rest" for b in buckets))
            distance = min(plain_distance(own, q) for q in word_references)
            assert row.word_distance == pytest.approx(distance, abs=1e-6)
            strange |= distance > limits.max_word_distance
        judged += strange
        assert (row.base_failed, row.kept) == (failed, not (failed or strange))
    assert judged
