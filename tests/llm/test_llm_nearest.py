import math

import duckdb
import numpy as np
import pytest
from oracle import connect, differences
from pyspark.sql import functions as F

from forecourt.llm import nearest as nn
from forecourt.llm.oracles import ORACLES
from forecourt.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, length string, code string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x") for i, v in rows], SCHEMA)


def brute(rows, is_query, k):
    """Exact answer over the rows that take part."""
    good = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    found = []
    for q in sorted(filter(is_query, good)):
        scores = []
        for i, v in good.items():
            if i != q:
                total = 0.0
                for a, b in zip(good[q], v):
                    total += a * b
                scores.append((-total, i))
        found += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return found


def test_error_bounds_hold():
    chance = np.random.default_rng(1)
    vectors = chance.standard_normal((3000, 48)) + 0.3
    rotation = nn.random_rotation(vectors.mean(axis=0))
    estimate, error = nn.bounds(vectors[:50], nn.encode(vectors, rotation), rotation)
    missed = np.abs(estimate - vectors[:50] @ vectors.T) > error
    assert missed.mean() < 0.01
    assert np.abs(estimate - vectors[:50] @ vectors.T).mean() < error.mean() / 3


@pytest.mark.parametrize("rows_per_block", [64, 8192])
def test_recall_against_brute_force(spark, monkeypatch, rows_per_block):
    monkeypatch.setattr(nn, "ROWS_PER_BLOCK", rows_per_block)
    chance = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(chance.standard_normal((600, 20)).astype(np.float32))]
    got = nn.nearest(table(spark, rows), F.col("vec_id") % 20 == 0, k=10).collect()
    want = brute(rows, lambda i: i % 20 == 0, 10)
    pairs = {(r.query_id, r.vec_id) for r in got}
    assert len(got) == len(want)
    assert len(pairs & {(q, i) for q, _, i, _ in want}) / len(want) >= 0.99
    score = {(q, i): s for q, _, i, s in want}
    assert all(r.score == score.get((r.query_id, r.vec_id), r.score) for r in got)


def test_given_table_matches_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    found = QUERIES["op9_nearest"](spark, sf_dir).toArrow()
    assert differences(found, connect(sf_dir).sql(ORACLES["op9_nearest"]).to_arrow_table()) == []


def test_recall_on_the_given_table(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = {(r.query_id, r.vec_id) for r in QUERIES["op9_nearest"](spark, sf_dir).collect()}
    ids, vectors = zip(*duckdb.sql(f"SELECT vec_id, embedding FROM '{sf_dir}/embeddings.parquet'").fetchall())
    ids, vectors = np.array(ids), np.array(vectors, float)
    hit = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]]
        hit += sum((ids[q], i) in found for i in best.tolist())
        total += 20
    assert hit / total >= 0.99


def test_ties_go_to_the_smaller_id_and_few_rows_give_all(spark):
    rows = [(0, [1.0, 0.0])] + [(i, [1.0, 1.0]) for i in range(1, 60)] + [(60, [9.0, 0.0])]
    got = nn.nearest(table(spark, rows), F.col("vec_id") == 0, k=20).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [60, *range(1, 20)] and [r["rank"] for r in got] == list(range(1, 21))
    assert nn.nearest(table(spark, rows[:3]), F.col("vec_id") == 0, k=20).count() == 2


def test_vectors_that_take_no_part(spark):
    good = [(i, [float(i), 1.0]) for i in range(1, 8)]
    bad = [
        (20, None), (40, []), (60, [0.0, 0.0]), (80, [1.0, None]), (100, [math.nan, 1.0]), (120, [math.inf, 1.0]),
        (140, [1.0]), (None, [5.0, 5.0]),
    ]
    got = nn.nearest(table(spark, good + bad + good[:2]), (F.col("vec_id") % 20 == 0) | (F.col("vec_id") < 3), k=20)
    assert [tuple(r) for r in got.orderBy("query_id", "rank").collect()] == brute(good, lambda i: i < 3, 20)


def test_rows_that_share_an_id_are_rows_of_their_own(spark, new_dir):
    rows = [(20, [1.0, 0.0]), (1, [0.5, 0.1]), (1, [0.9, 0.1]), (1, [0.9, 0.1]), (20, [0.0, 1.0]), (2, [0.2, 0.3])]
    got = nn.nearest(table(spark, rows), F.col("vec_id") % 20 == 0, k=3).collect()
    first, second = [], []
    for r in sorted(got, key=lambda r: r["rank"]):
        (first if round(r.score, 6) in (0.9, 0.5, 0.2) else second).append((r.query_id, r["rank"], r.vec_id, round(r.score, 6)))
    assert first == [(20, 1, 1, 0.9), (20, 2, 1, 0.5), (20, 3, 2, 0.2)]
    assert second == [(20, 1, 2, 0.3), (20, 2, 1, 0.1), (20, 3, 1, 0.1)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).toPandas().to_parquet(f"{new_dir}/embeddings.parquet")
    found = QUERIES["op9_nearest"](spark, new_dir).toArrow()
    assert differences(found, connect(new_dir).sql(ORACLES["op9_nearest"]).to_arrow_table()) == []


def test_no_rows_and_no_queries(spark):
    assert nn.nearest(table(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert nn.nearest(table(spark, [(1, [1.0]), (2, [2.0])]), F.col("vec_id") % 20 == 0).count() == 0
    assert nn.nearest(table(spark, [(0, [1.0, 2.0])]), F.col("vec_id") % 20 == 0).count() == 0
