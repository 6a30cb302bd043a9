"""Segments, price model and attributions."""

import math
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from conftest import SF_DIR
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from forecourt.operators import tables
from forecourt.plans import attribution, pricing, refresh, segments
from forecourt.registry.queries import facts, facts_with_id, price_bands
from forecourt.schemas import FACT
from forecourt.session import scratch_path


@pytest.fixture(scope="module")
def features(spark):
    return segments.ml_feature_extract(facts(spark, SF_DIR)).persist()


@pytest.fixture(scope="module")
def gold(spark):
    root = scratch_path(spark, "layers")
    return tables.create_layers(spark, root, prefix=f"m_{root.split('/')[-2][:8]}_")


def test_moments_are_those_of_the_rows(spark, features):
    fitted = segments.fit_segments(features, starts=2)
    scaled = segments.standard_scale(features)
    row = scaled.agg(*[F.stddev_pop(c) for c in segments.FEATURES], *[F.avg(c) for c in segments.FEATURES]).first()
    assert list(fitted.deviations) == pytest.approx(list(row[:3]), rel=1e-9)
    assert list(fitted.means) == pytest.approx(list(row[3:]), rel=1e-9)
    checks = scaled.agg(*[F.stddev_samp(f"scaled_{c}") for c in segments.FEATURES]).first()
    assert list(checks) == pytest.approx([1.0] * 3)


def test_segments_are_the_nearest_centres_and_the_best_start(features):
    many = segments.fit_segments(features, starts=4)
    one = segments.fit_segments(features, starts=1)
    assert many.cost <= one.cost
    distances = many.distances()
    own = F.get(F.array(*distances), F.col("cluster_id"))
    total, best = many.transform(features).agg(F.sum(own), F.sum(F.least(*distances))).first()
    assert total == pytest.approx(best, rel=1e-9) == pytest.approx(many.cost, rel=1e-6)


def test_cost_is_that_of_the_library(features):
    """Within 0.05 % of ten starts of the library's own K-Means on the same scaled rows, or better."""
    fitted = segments.fit_segments(features)
    scaled = [(F.col(n) - m) / d for n, m, d in zip(fitted.columns, fitted.means, fitted.deviations)]
    vectors = features.select(array_to_vector(F.array(*scaled)).alias("features")).persist()
    costs = [KMeans(k=3, seed=42 + i, maxIter=100).fit(vectors).summary.trainingCost for i in range(10)]
    vectors.unpersist()
    assert fitted.cost <= min(costs) * 1.0005


def test_segments_do_not_depend_on_the_layout(spark, features):
    fits = [segments.fit_segments(features.repartition(n), starts=3) for n in (2, 9)]
    assert fits[0].cost == pytest.approx(fits[1].cost, rel=1e-9)
    assert fits[0].centres == pytest.approx(fits[1].centres, rel=1e-6)
    assert fits[0].sizes.tolist() == fits[1].sizes.tolist()


def test_every_start_sees_all_rows(spark):
    """Many rows on few points: a sample of points by hash holds none of them, or one with all its rows."""
    ddl = "CAST(id % 3 * 5000 AS int) price, CAST(id % 3 * 10 AS int) mileage, CAST(2000 + id % 3 AS int) year"
    fitted = segments.fit_segments(spark.range(3_000_000).selectExpr(*ddl.split(", ")))
    assert fitted.sizes.tolist() == [1e6] * 3 and fitted.cost == pytest.approx(0, abs=1e-6)


def test_segments_do_not_depend_on_the_input_size(spark, features):
    times = 8  # more rows than a sample would take whole
    one = segments.fit_segments(features)
    many = segments.fit_segments(features.crossJoin(spark.range(times)).drop("id"))
    assert many.sizes.tolist() == [times * size for size in one.sizes]
    assert many.cost == pytest.approx(times * one.cost, rel=1e-9)


def test_blocks_give_the_sums_of_their_points(spark):
    """Also with points on a border, where two centres are equally far, and with centres without points."""
    points = spark.range(5000).selectExpr(
        "(id % 50 - 25) / 10 AS price", "(id DIV 50 - 50) / 25 AS mileage", "CAST(id % 3 AS double) AS year",
        "CAST(1 + id % 4 AS double) AS weight",
    )
    names = list(segments.FEATURES)
    table = segments.point_blocks(points.selectExpr("CAST(price AS double) price", "CAST(mileage AS double) mileage", "year", "weight", "0L AS draw"), names)
    table = table.toArrow()
    figures = np.array(table.column("figures").to_pylist())
    rows = points.toPandas().astype(float).to_numpy()
    centres = np.array([[[0, 0, 0], [1, 0, 0], [0, 1, 1]], [[-1, 0, 1], [1, 0, 1], [99, 99, 99]]], float)
    found, distances = segments.block_sums(figures, pa.concat_arrays(table.column("points").chunks), centres)
    assert 0 < distances < rows.shape[0] * 6
    for start in range(2):
        squares = ((rows[:, None, :3] - centres[start]) ** 2).sum(axis=2)
        for centre in range(3):
            own = squares.argmin(axis=1) == centre
            weight = rows[own, 3]
            expected = [weight.sum(), (weight * squares[own, centre]).sum(), *(weight[:, None] * rows[own, :3]).sum(axis=0)]
            assert found[start, centre].tolist() == pytest.approx(expected, rel=1e-9, abs=1e-9)


def test_most_points_need_no_distances(spark, features):
    fitted = segments.fit_segments(features, starts=1)
    scaled = [((F.col(n) - m) / d).alias(n) for n, m, d in zip(fitted.columns, fitted.means, fitted.deviations)]
    table = segments.point_blocks(features.select(*scaled, F.lit(1.0).alias("weight"), F.lit(0).cast("long").alias("draw")).coalesce(1), fitted.columns).toArrow()
    figures, n = np.array(table.column("figures").to_pylist()), features.count()
    _, distances = segments.block_sums(figures, pa.concat_arrays(table.column("points").chunks), fitted.centres[None])
    assert distances < 0.75 * n * 3  # few rows, so wide blocks


def test_profile_is_that_of_the_rows(features):
    fitted = segments.fit_segments(features, starts=1)
    by_rows = segments.cluster_profile_means(fitted.transform(features)).orderBy("cluster_id").collect()
    assert len(by_rows) == 3
    for a, b in zip(by_rows, fitted.profile()):
        assert tuple(a) == pytest.approx(b, rel=1e-4)


def test_more_than_three_clusters_share_the_names_by_thirds(spark):
    rows = [(i, float(100 * i), 1.0, 1.0) for i in range(5)]
    order = segments.cluster_price_order(spark.createDataFrame(rows, segments.PROFILE))
    assert {r.cluster_id: r.price_position for r in order.collect()} == {0: 1, 1: 1, 2: 2, 3: 2, 4: 3}


def test_fewer_points_than_segments(spark):
    ddl = "brand string, price int, mileage int, year int, is_ulez_compliant boolean"
    frame = spark.createDataFrame([("a", 1, 1, 2000, True), ("b", 9, 9, 2000, False), ("b", 9, 9, 2000, None)], ddl)
    named = segments.cluster_business_names(segments.kmeans_segments(frame, starts=2))
    assert sorted((r.brand, r.cluster_name) for r in named.collect()) == [
        ("a", "Budget Entry (ULEZ Compliant)"),
        ("b", "Standard Market (Non-Compliant)"),
        ("b", "Standard Market (Non-Compliant)"),
    ]


def test_no_usable_rows_leave_the_mart_alone(spark, gold):
    empty = spark.createDataFrame([], FACT)
    table = f"{gold.gold}.mart_market_clusters"
    assert refresh.daily_refresh(spark, empty, gold) is None
    assert not spark.catalog.tableExists(table)
    assert segments.kmeans_segments(segments.ml_feature_extract(empty)).count() == 0


def test_cluster_mart_names_follow_mean_prices(spark, features, gold):
    table = f"{gold.gold}.mart_market_clusters"
    mart = segments.cluster_mart(spark, facts(spark, SF_DIR), table, starts=3)
    assert mart.count() == features.count()
    family = F.split_part("cluster_name", F.lit(" ("), F.lit(1))
    family = F.when(family == "Desperate Dump", "Budget Entry").otherwise(family)
    means = dict(map(tuple, mart.groupBy(family).agg(F.avg("price")).collect()))
    assert means["Budget Entry"] < means["Standard Market"] < means["Premium Segment"]
    segments.cluster_mart(spark, facts(spark, SF_DIR), table, starts=1)
    assert spark.table(table).count() == features.count()


def test_examples_are_at_most_three_per_segment(spark, features):
    named = segments.cluster_business_names(price_bands(facts(spark, SF_DIR)))
    counts = segments.sample_per_cluster(named).groupBy("cluster_name").count().collect()
    assert len(counts) == 6 and {row[1] for row in counts} == {3}


@pytest.fixture(scope="module")
def split(spark):
    return pricing.train_test_split(facts_with_id(spark, SF_DIR))


@pytest.fixture(scope="module")
def model(split):
    return pricing.train_price_model(split[0], rounds=8, depth=4)


def test_split_is_a_fifth_and_repeatable(spark, split):
    train, test = (side.count() for side in split)
    total = facts_with_id(spark, SF_DIR).count()
    assert train + test == total and 0.15 < test / total < 0.25
    again = pricing.train_test_split(facts_with_id(spark, SF_DIR).repartition(5))[1]
    assert again.agg(F.sum("id")).first() == split[1].agg(F.sum("id")).first()


def test_training_on_groups_equals_training_on_rows(split):
    """The first tree of both has the same splits' gain, so the same training error."""
    rows = split[0].where(F.col("price").isNotNull())
    grouped = pricing.train_price_model(split[0], rounds=1, depth=3, bins=256)
    vectors = pricing._with_vector(rows).select("_features", F.col("price").cast("double").alias("price"))
    from pyspark.ml.regression import DecisionTreeRegressor

    tree = DecisionTreeRegressor(
        featuresCol="_features", labelCol="price", maxDepth=3, maxBins=256, predictionCol="predicted_price"
    ).fit(vectors)
    by_rows = pricing.regression_metrics(tree.transform(vectors)).first()
    by_groups = pricing.regression_metrics(pricing.predict_prices(grouped, rows)).first()
    assert by_groups.mae == pytest.approx(by_rows.mae, rel=1e-9)
    assert by_groups.r2 == pytest.approx(by_rows.r2, rel=1e-9)


def test_metrics_agree_with_the_evaluator(split, model):
    scored = pricing.predict_prices(model, split[1])
    row = pricing.regression_metrics(scored).first()
    labelled = scored.withColumn("price", F.col("price").cast("double"))
    evaluator = RegressionEvaluator(labelCol="price", predictionCol="predicted_price")
    assert row.mae == pytest.approx(evaluator.evaluate(labelled, {evaluator.metricName: "mae"}))
    assert row.r2 == pytest.approx(evaluator.evaluate(labelled, {evaluator.metricName: "r2"}))


def test_every_row_gets_a_price(spark, split, model):
    test = split[1].withColumn("price", F.when(F.col("id") % 2 == 0, F.col("price")))
    assert test.where("mileage IS NULL").count() > 0 < test.where("price IS NULL").count()
    scored = pricing.predict_prices(model, test)
    assert scored.where("predicted_price IS NOT NULL").count() == test.count()


def test_unknown_features_are_learned(spark):
    """Rows without mileage cost another price than any with it; the model tells them apart."""
    rows = [(5, i % 50 * 100 if i % 20 else None, 1.5, True, 1000 if i % 20 else 9000) for i in range(2000)]
    ddl = "vehicle_age int, mileage int, engine_size double, is_ulez_compliant boolean, price int"
    frame = spark.createDataFrame(rows, ddl)
    model = pricing.train_price_model(frame, rounds=2, depth=2)
    scored = pricing.predict_prices(model, frame)
    assert scored.agg(F.max(F.abs(F.col("price") - F.col("predicted_price")))).first()[0] < 1
    explained = attribution.shap_contributions(model, frame.where("mileage IS NULL"))
    assert explained.agg(F.min("shap_mileage")).first()[0] > 7000


def test_contributions_add_up_to_the_prediction(split, model):
    explained = attribution.shap_contributions(model, split[1])
    assert explained.count() == split[1].count()
    total = sum((F.col(name) for name in attribution.value_columns()), F.lit(0.0))
    gap = explained.agg(F.max(F.abs(total - F.col("predicted_price")))).first()[0]
    assert gap < 1e-6
    straight = pricing.predict_prices(model, split[1]).agg(F.sum("predicted_price")).first()[0]
    assert explained.agg(F.sum("predicted_price")).first()[0] == pytest.approx(straight)


def test_cells_and_rows_give_the_same_contributions(spark, split, model):
    """Also for continuous values, where the thresholds leave more cells than there are rows."""
    continuous = split[0].withColumns(
        {
            "mileage": F.col("mileage") + F.pmod(F.xxhash64("id"), F.lit(1999)),
            "engine_size": F.col("engine_size") + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(997)) / 9970,
            "vehicle_age": F.col("vehicle_age") * 7 + F.pmod(F.xxhash64("id", F.lit(2)), F.lit(7)).cast("int"),
        }
    )
    fine = pricing.train_price_model(continuous, rounds=60, depth=5)
    boxes = attribution.leaf_boxes(spark, fine)
    assert math.prod(len(boxes.thresholds(i)) + 1 for i in range(len(pricing.INPUTS))) > 1_000_000
    columns = ["id", "predicted_price", *attribution.value_columns()]
    for fitted, rows in ((model, split[1]), (fine, continuous.limit(300))):
        rows = rows.dropDuplicates(["id"]).persist()
        by_cell = attribution.shap_contributions(fitted, rows).select(*columns).orderBy("id").toPandas()
        points = pricing.predict_inputs(fitted, rows.select("id", *[c.alias(n) for n, c in pricing.model_inputs().items()]))
        by_row = attribution._with_values(points, attribution.leaf_boxes(spark, fitted))
        by_row = by_row.select(*columns).orderBy("id").toPandas()
        assert len(by_cell) == len(by_row) > 0
        for name in columns:
            assert by_cell[name].astype(float).tolist() == pytest.approx(by_row[name].astype(float).tolist(), abs=1e-6)


def subset_values(boxes, x):
    """Base value and contributions of one point, from the worth of every subset of features."""
    count = len(x) // 2
    share = boxes.share[:, :count] * boxes.share[:, count:]
    met = [(x[i] > boxes.low[:, i]) & (x[i] <= boxes.high[:, i]) for i in range(2 * count)]
    inside = [met[f] & met[count + f] for f in range(count)]

    def worth(chosen):
        factors = [inside[f] if f in chosen else share[:, f] for f in range(count)]
        return float((boxes.value * np.prod(factors, axis=0)).sum())

    gains = []
    for f in range(count):
        others = [g for g in range(count) if g != f]
        sets = [set(s) for size in range(count) for s in combinations(others, size)]
        weight = {n: math.factorial(n) * math.factorial(count - n - 1) / math.factorial(count) for n in range(count)}
        gains.append(sum(weight[len(s)] * (worth(s | {f}) - worth(s)) for s in sets))
    return [worth(set()), *gains]


@pytest.mark.parametrize("count", [1, 4, 8])
def test_path_weights_equal_the_sum_over_all_subsets(count):
    """Random trees of depth 5 over one, four and eight features, some points on a threshold."""
    chance = np.random.default_rng(count)
    leaves = []

    def grow(box, depth, weight):
        if not depth or chance.random() < 0.1:
            leaves.append((chance.normal(), *zip(*box)))
            return
        f, cut, kept = int(chance.integers(2 * count)), float(chance.integers(1, 9)) / 10, chance.uniform(0.05, 0.95)
        low, high, share = box[f]
        grow([*box[:f], (low, min(high, cut), share * kept), *box[f + 1 :]], depth - 1, weight)
        grow([*box[:f], (max(low, cut), high, share * (1 - kept)), *box[f + 1 :]], depth - 1, weight)

    for _ in range(6):
        grow([(-math.inf, math.inf, 1.0)] * (2 * count), 5, 1.0)
    boxes = attribution.LeafBoxes(*(np.array(part, float) for part in zip(*leaves)))
    inputs = [f"x{i}" for i in range(2 * count)]
    names = attribution.value_columns([f"f{i}" for i in range(count)])
    points = pd.DataFrame(chance.integers(0, 11, (40, 2 * count)) / 10, columns=inputs)
    (found,) = attribution._explainer(boxes, inputs, names)(iter([points]))
    for at in range(len(points)):
        assert found.loc[at, names].tolist() == pytest.approx(subset_values(boxes, points.loc[at].to_numpy()), abs=1e-9)


def test_base_value_is_the_mean_prediction_of_the_training_rows(split, model):
    """For trees whose covers are the training rows, the empty set is worth their mean prediction."""
    train = split[0]
    base = attribution.shap_contributions(model, split[1]).first().base_value
    mean = pricing.predict_prices(model, train).agg(F.avg("predicted_price")).first()[0]
    assert base == pytest.approx(mean, rel=0.02)


def test_unknown_category_is_all_zeros(spark):
    frame = spark.createDataFrame([("P", "A"), ("P", "B"), ("D", "B"), (None, "B")], "fuel_type string, brand string")
    rows = pricing.categorical_encode(frame).collect()
    got = {(r.fuel_type, r.brand): (r.fuel_type_index, r.fuel_type_vector.toArray().tolist()) for r in rows}
    assert got == {
        ("P", "A"): (0.0, [1.0, 0.0]),
        ("P", "B"): (0.0, [1.0, 0.0]),
        ("D", "B"): (1.0, [0.0, 1.0]),
        (None, "B"): (2.0, [0.0, 0.0]),
    }


def test_twenty_thousand_categories(spark):
    frame = spark.range(30_000).select((F.col("id") % 20_000).cast("string").alias("brand"))
    encoded = pricing.categorical_encode(frame, ["brand"])
    rows = encoded.dropDuplicates(["brand"]).orderBy("brand_index").collect()
    names = sorted({r.brand for r in rows}, key=lambda b: (-2 if int(b) < 10_000 else -1, b))
    assert [r.brand for r in rows] == names
    assert [r.brand_index for r in rows] == list(range(20_000))
    assert all(r.brand_vector.size == 20_000 and r.brand_vector.indices.tolist() == [r.brand_index] for r in rows[::501])


def test_one_scan_counts_all_columns(spark):
    """Whatever the number of columns, their values are counted and placed by one plan."""
    frame = spark.range(60).selectExpr(*[f"CAST(id % {n} AS string) AS c{n}" for n in (2, 3, 5, 7)])
    places = pricing.category_places(frame, frame.columns)
    found = sorted(map(tuple, places.collect()))
    assert found == sorted((f"c{n}", str(i), i) for n in (2, 3, 5) for i in range(n)) + sorted(
        ("c7", str(i), i) for i in range(7)
    )
    plan = pricing.category_counts(frame, frame.columns)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1


def test_a_column_may_be_unknown_throughout(spark):
    frame = spark.createDataFrame([("A", None), ("B", None), ("B", None)], "brand string, fuel_type string")
    rows = pricing.categorical_encode(frame, ["brand", "fuel_type"]).collect()
    assert sorted((r.brand, r.brand_index, r.fuel_type_index) for r in rows) == [("A", 1.0, 0.0), ("B", 0.0, 0.0), ("B", 0.0, 0.0)]
