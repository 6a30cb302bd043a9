from collections import Counter

import numpy as np
import pytest
from llm_fixtures import documents, empty, odd_rows, sentences
from pyspark.sql import functions as F

from forecourt.llm import mixing


def corpus(spark, sizes):
    rows = [(s * 10**6 + i, sentences(i, 20), "en", f"s{s}") for s, n in enumerate(sizes) for i in range(n)]
    return documents(spark, rows)


def test_output_has_the_target_shares(spark):
    docs = corpus(spark, (3000, 300, 30))
    mixed = mixing.mix(docs, {"s0": 1, "s1": 1, "s2": 2}, size=0.5).toPandas()
    assert set(mixed.columns) == set(docs.columns) | {"position"}
    shares = mixed.groupby("source").n_chars.sum() / mixed.n_chars.sum()
    assert shares["s0"] == pytest.approx(0.25, abs=0.04)
    assert shares["s2"] == pytest.approx(0.5, abs=0.05)
    assert mixed.n_chars.sum() == pytest.approx(0.5 * docs.toPandas().n_chars.sum(), rel=0.1)


def test_counts_are_poisson(spark):
    docs = corpus(spark, (4000, 4000))
    mixed = mixing.mix(docs, {"s0": 3, "s1": 1}).toPandas()
    for source, rate in (("s0", 1.5), ("s1", 0.5)):
        counts = mixed[mixed.source == source].groupby("doc_id").size()
        all_counts = np.concatenate([counts.to_numpy(), np.zeros(4000 - len(counts))])
        assert all_counts.mean() == pytest.approx(rate, abs=0.08)
        assert all_counts.var() == pytest.approx(rate, rel=0.12)


def test_large_rates_are_sums_of_parts(spark):
    docs = corpus(spark, (1000, 5))
    mixed = mixing.mix(docs, {"s0": 0, "s1": 1}).toPandas()
    per_doc = mixed.groupby("doc_id").size()
    assert set(mixed.source) == {"s1"}
    assert per_doc.mean() == pytest.approx(201, abs=25)
    assert sorted(mixed[mixed.doc_id == 10**6]["copy"]) == list(range(1, per_doc[10**6] + 1))


def test_result_does_not_depend_on_the_layout(spark):
    docs = corpus(spark, (200, 50))
    mixed = [mixing.mix(docs.repartition(n)) for n in (1, 7)]
    one, other = (frame.toPandas().sort_values("position", ignore_index=True) for frame in mixed)
    assert one.equals(other) and one.position.is_unique
    parts = mixed[0].select(F.spark_partition_id().alias("part"), "position").toPandas()
    assert all(part.position.is_monotonic_increasing for _, part in parts.groupby("part"))


def test_clashing_names_and_one_reading_of_the_texts(spark):
    docs = corpus(spark, (20, 5)).withColumns({name: F.lit("x") for name in ("__source", "__parts", "__cdf", "row", "cdf", "n_parts", "drawn_by")})
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "n_copies", "copy", "position"] or set(docs.columns) < set(mixed.columns)
    rows = mixed.collect()
    assert rows and all(r["__source"] == r["row"] == r["cdf"] == "x" for r in rows)
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_rows_without_id_draw_apart(spark):
    docs = documents(spark, [(None, f"{i} " + sentences(i, 20), "en", "s") for i in range(3000)])
    mixed = mixing.mix(docs, size=0.7).toPandas()
    counts = mixed.groupby("text").size()
    assert len(mixed) == pytest.approx(2100, rel=0.1) and len(counts) == pytest.approx(3000 * (1 - np.exp(-0.7)), rel=0.1)
    assert mixed.position.is_unique


def test_order_is_mixed(spark):
    mixed = mixing.mix(corpus(spark, (300, 300)), {"s0": 1, "s1": 1}).toPandas()
    half = Counter(mixed.source[: len(mixed) // 2])
    assert abs(half["s0"] - half["s1"]) < 100


def test_odd_rows_and_empty_table(spark):
    docs = documents(spark, odd_rows())
    mixed = mixing.mix(docs, size=3.0).collect()
    assert {r.doc_id for r in mixed} <= {r[0] for r in odd_rows()}
    assert Counter(r.doc_id for r in mixed)[5] % 2 == 0  # both rows of doc 5 draw the same count
    rates = {r.source: r.rate for r in mixing.source_rates(docs).collect()}
    assert set(rates) == {"a", "b", None}
    assert mixing.mix(empty(spark)).count() == mixing.mix(empty(spark), {"a": 1}).count() == 0
