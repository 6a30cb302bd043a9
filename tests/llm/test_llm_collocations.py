import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import documents, empty, odd_rows
from oracle import connect, differences

from forecourt.llm import collocations
from forecourt.llm.oracles import ORACLES
from forecourt.llm.queries import QUERIES


def plain_counts(rows):
    """(lang, phrase words) to count; () for all words."""
    counts = Counter()
    for _, text, lang, _ in rows:
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            counts[lang or "und", ()] += len(words)
            for size in range(1, 6):
                for at in range(len(words) - size + 1):
                    counts[lang or "und", tuple(words[at : at + size])] += 1
    return counts


def plain_collocations(rows, least, percent, per_lang):
    counts = plain_counts(rows)
    langs = {}
    for (lang, words), a in counts.items():
        if len(words) < 2 or a < least:
            continue
        longer = (
            c for (x, w), c in counts.items()
            if x == lang and len(w) > len(words) and c >= least and any(w[i : i + len(words)] == words for i in range(len(w)))
        )
        if any(100 * c >= percent * a for c in longer):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000 * a * counts[lang, ()] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        langs.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right, counts[lang, ()]))
    return {
        (lang, rank, phrase.decode(), -a, left, right, n, -score)
        for lang, found in langs.items()
        for rank, (score, a, phrase, left, right, n) in enumerate(sorted(found)[:per_lang], 1)
    }


def texts(seed: int, n: int, vocabulary: int):
    """Rows with hot words, hot phrases, copies and odd characters."""
    chance = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["The", "É", "日本", "a\x00b", "\x1f", "x" * 40, "x" * 40 + "y"]
    rows = []
    for i in range(n):
        picked = [words[min(int(chance.expovariate(0.15)), len(words) - 1)] for _ in range(chance.randrange(60))]
        if chance.random() < 0.3:
            picked = ["the same", "hot passage", "again."] * 3 + picked
        parted = "".join(w + chance.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\r\n", "\x0b"]) for w in picked)
        rows.append((i, parted, chance.choice(["en", "de", None]), "s"))
    return rows + [rows[0]] * 20 + [(999, "z " * 3000, "en", "s")]


@pytest.fixture
def small_ranges(monkeypatch):
    monkeypatch.setattr(collocations, "RANGE_WORDS", 200)
    monkeypatch.setattr(collocations, "_SLICE_BYTES", 4000)
    monkeypatch.setattr(collocations, "_CHUNK_WORDS", 300)


def as_counts(frame, least):
    return {(r.lang, tuple(r.phrase.split(" ")) if r["size"] else ()): r.n for r in frame.collect()}


@pytest.mark.parametrize("least", [2, 30])
def test_counts_over_many_ranges(spark, small_ranges, least):
    rows = texts(1, 150, 30) + odd_rows()
    frame = documents(spark, rows).repartition(5)
    assert len(collocations.range_bounds(collocations._texts(frame))) > 20
    counts = collocations.phrase_counts(frame, least)
    every = {key: n for key, n in plain_counts(rows).items() if n and (n >= least or not key[1])}
    found = as_counts(counts, least)
    assert found == every and counts.count() == len(found)


@pytest.mark.parametrize(("percent", "per_lang"), [(100, 2000), (70, 5)])
def test_collocations_against_plain_version(spark, small_ranges, percent, per_lang):
    rows = texts(2, 120, 25)
    found = collocations.collocations(documents(spark, rows), 8, percent, per_lang).collect()
    expected = plain_collocations(rows, 8, percent, per_lang)
    assert expected and len(found) == len(expected) and {tuple(r) for r in found} == expected


@pytest.mark.parametrize("seed", range(10))
def test_quicksort_counts_weighted_prefixes(seed):
    chance = random.Random(seed)
    rows = [[chance.randrange(5) if chance.random() < 0.9 else 0 for _ in range(3)] for _ in range(400)]
    rows = [[*row[: row.index(0)], 0, 0, 0][:3] if 0 in row else row for row in rows]
    weights = [chance.randrange(1, 4) for _ in rows]
    counts = Counter()
    for row, weight in zip(rows, weights):
        for size in range(1, 4):
            if all(row[:size]):
                counts[tuple(row[:size])] += weight
    columns = [np.array(column, np.int32) for column in zip(*rows)]
    found = [(tuple(rows[at][:size]), n) for at, size, n in collocations.frequent_prefixes(columns, np.array(weights), 25)]
    assert len(dict(found)) == len(found) and dict(found) == {key: n for key, n in counts.items() if n >= 25}


def test_blocks_hold_the_suffixes():
    rows = texts(3, 40, 20)
    bounds = [("de", (b"w1",)), ("en", (b"same", b"hot")), ("en", (b"w", b"x")), ("en", (b"w3", b"w3", b"w3", b"w3"))]
    langs = pa.array([row[2] or "und" for row in rows])
    counts = Counter()
    for block in collocations.blocks_of(pa.array([row[1] for row in rows]), langs, bounds):
        for at in range(block.num_rows):
            one = pa.Table.from_batches([block.slice(at, 1)])
            columns, weights, words = collocations._read_blocks(one)
            lang, number = one.column("lang")[0].as_py(), one.column("range")[0].as_py()
            for *ids, weight in zip(*columns, weights.tolist()):
                suffix = tuple(words[int(i) - 1].as_py() for i in ids if i)
                assert number == sum(bound <= (lang, suffix) for bound in bounds)
                for size in range(len(suffix) + 1):
                    counts[lang, tuple(w.decode() for w in suffix[:size])] += weight
    assert counts == Counter({key: n for key, n in plain_counts(rows).items() if n})


def test_large_products_are_exact(spark):
    """Products beyond 64 bits: 1000 * a * n for a = 10^8 would wrap around."""
    frame = spark.createDataFrame([(10**11, 10**14, 3 * 10**11, 7 * 10**12)], "a long, n long, l long, r long")
    wide = frame.selectExpr(
        "(cast(1000 as decimal(4,0)) * (cast(a as decimal(16,0)) * cast(n as decimal(16,0))))"
        " div (cast(l as decimal(16,0)) * cast(r as decimal(16,0))) as score"
    )
    assert wide.first().score == 1000 * 10**11 * 10**14 // (3 * 10**11 * 7 * 10**12)


def test_empty_tables_and_texts(spark):
    assert collocations.collocations(empty(spark)).count() == 0
    assert collocations.collocations(documents(spark, [(1, None, None, None), (2, " .\n", "en", "a")])).count() == 0


def test_query_matches_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = QUERIES["op11_collocations"](spark, sf_dir).toArrow()
    assert rows.num_rows > 0
    assert differences(rows, connect(sf_dir).sql(ORACLES["op11_collocations"]).to_arrow_table()) == []
