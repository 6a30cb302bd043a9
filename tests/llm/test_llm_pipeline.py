import hashlib
import math
from collections import Counter

import corpus_pipeline
import duckdb
import pytest
from conftest import SF_DIR
from llm_fixtures import documents, odd_rows, sentences
from test_llm_near_duplicates import edited, plain_classes
from test_llm_secret_scan import plain_spans
from tokenizers import Tokenizer

import __spark_entry__ as entry
from forecourt.llm import mixing, quality
from forecourt.llm.oracles import ORACLES
from forecourt.llm.queries import QUERIES


def poisson_count(doc_id, rate):
    """The count by plain inversion of one uniform number per part."""
    parts = max(1, math.ceil(rate / mixing.PART_RATE))
    count, rate = 0, rate / parts
    for part in range(1, parts + 1):
        u = int(hashlib.md5(f"{mixing.SEED}:{doc_id}:{part}".encode()).hexdigest()[:13], 16) / 16**13
        k, p, upto = 0, math.exp(-rate), math.exp(-rate)
        while upto <= u:
            k += 1
            p = p * rate / k
            upto += p
        count += k
    return count


def plain_pipeline(rows, kept):
    """The rows of the last stage, from the documents that the quality rules keep."""
    texts = {i: t for i, t, _, _ in rows if i in kept}
    classes = plain_classes(texts)
    left = {}
    for i, text, _, source in rows:
        if i in kept and classes[i] == i:
            at, out = 0, ""
            for start, _, end in plain_spans(text):
                if start >= at:
                    out += text[at:start] + "[SECRET]"
                at = max(at, end)
            left[i] = (out + text[at:], source)
    size = Counter()
    for text, source in left.values():
        size[source] += len(text)
    weight = {s: math.sqrt(n) for s, n in size.items()}
    rate = {s: sum(size.values()) * weight[s] / sum(weight.values()) / n for s, n in size.items()}
    library = Tokenizer.from_file(corpus_pipeline.VOCABULARY)
    found = Counter()
    for i, (text, source) in left.items():
        ids = tuple(library.encode(text, add_special_tokens=False).ids)
        copies = poisson_count(i, rate[source])
        if copies:
            found[i, ids, len(ids)] = copies
    return found


@pytest.fixture(scope="module")
def rows():
    given = duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF_DIR}/documents.parquet'").fetchall()
    base = max(i for i, *_ in given) + 1
    extra = []
    for n, (_, text, lang, source) in enumerate(given[:20]):
        extra.append((base + 3 * n, text, lang, source))
        extra.append((base + 3 * n + 1, edited(text, max(1, len(text.split()) // 100), n), lang, source))
        extra.append((base + 3 * n + 2, text + " password=hunter2hunter2 end", lang, "other"))
    return given + extra


def test_pipeline_matches_plain_steps(spark, rows, new_dir):
    docs = documents(spark, rows, clashing=False)
    docs.write.parquet(f"{new_dir}/documents.parquet")
    kept = {r.doc_id for r in quality.quality_report(docs).where("kept").collect()}
    assert 0.4 * len(rows) < len(kept) < len(rows)
    got = Counter((r.doc_id, tuple(r.ids), r.n_tokens) for r in corpus_pipeline.run(spark, new_dir).collect())
    assert got == plain_pipeline(rows, kept)


def test_stages_keep_the_columns_of_documents(spark, rows):
    docs = documents(spark, rows[:60] + odd_rows())
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, SF_DIR)
        assert docs.columns == list(corpus_pipeline.COLUMNS), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).columns == ["doc_id", "ids", "n_tokens"]


def test_stages_take_empty_tables(spark):
    docs = documents(spark, [])
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, docs, SF_DIR).count() == 0


def test_clean_documents_are_kept(spark):
    clean = [(i, sentences(i, 200, 60), "en", "s") for i in range(40)]
    docs = documents(spark, clean)
    for _, function in corpus_pipeline.STAGES[:3]:
        docs = function(spark, docs, SF_DIR)
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == [(i, t) for i, t, *_ in clean]


def test_all_queries_are_registered():
    names = set(entry.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 11)}
    assert set(ORACLES) == {"op2_secret_scan", "op7_warc", "op9_nearest", "op10_mixing"}
