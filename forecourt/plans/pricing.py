"""Price regression: split, boosted trees, metrics, category encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.session import scratch_root, stage

FEATURES = ("vehicle_age", "mileage", "engine_size", "is_ulez_compliant")
_VECTOR = "_features"
UNKNOWN = -1.0  # below every known value that occurs: ages, miles and sizes start at 0


def is_test_row(key: Column) -> Column:
    """A fixed fifth of the keys, the same on every run and for any partitioning."""
    return F.substring(F.md5(key.cast("string")), 1, 4) < "3333"


def split_side(key: Column) -> Column:
    return F.when(is_test_row(key), "test").otherwise("train")


def train_test_split(df: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    side = split_side(F.col(key))
    return df.where(side == "train"), df.where(side == "test")


def known(name: str) -> Column:
    return F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double"))


def model_inputs() -> dict[str, Column]:
    """What the trees see of each feature: its value, or a number below all values, and whether it is known.

    So rows with an unknown feature have a place of their own in the trees, learned like any other.
    """
    values = {f"_{name}": F.when(known(name), F.col(name).cast("double")).otherwise(UNKNOWN) for name in FEATURES}
    return values | {f"_{name}_known": known(name).cast("double") for name in FEATURES}


INPUTS = [*[f"_{name}" for name in FEATURES], *[f"_{name}_known" for name in FEATURES]]


def feature_groups(rows: DataFrame) -> DataFrame:
    """Distinct feature vectors with their row count and mean price.

    A tree sees only the features, so rows with equal features always share a
    leaf, and for squared loss their count and mean price give the same split
    gains and leaf values as the rows. The hundred boosting rounds then run
    over the groups instead of the listings.
    """
    return rows.groupBy(*FEATURES).agg(
        F.count("*").cast("double").alias("weight"), F.avg("price").alias("mean_price")
    )


def _assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=INPUTS, outputCol=_VECTOR).transform(df)


def _with_vector(df: DataFrame) -> DataFrame:
    return _assembled(df.withColumns(model_inputs())).drop(*INPUTS)


def train_price_model(
    train: DataFrame, rounds: int = 100, depth: int = 6, rate: float = 0.3, bins: int = 256, seed: int = 42
) -> GBTRegressionModel:
    """Boosted regression trees on squared error, fitted on all rows with a price."""
    scratch_root(train.sparkSession)
    groups = stage(feature_groups(train.where(F.col("price").isNotNull())), "feature_groups")
    regressor = GBTRegressor(
        featuresCol=_VECTOR,
        labelCol="mean_price",
        weightCol="weight",
        predictionCol="predicted_price",
        lossType="squared",
        maxIter=rounds,
        maxDepth=depth,
        maxBins=bins,
        stepSize=rate,
        seed=seed,
        maxMemoryInMB=1024,
        checkpointInterval=10,
    )
    return regressor.fit(_with_vector(groups).select(_VECTOR, "mean_price", "weight"))


def predict_prices(model: GBTRegressionModel, df: DataFrame) -> DataFrame:
    """Every row with its ``predicted_price``; neither price nor features need be known."""
    return model.transform(_with_vector(df)).drop(_VECTOR)


def predict_inputs(model: GBTRegressionModel, inputs: DataFrame) -> DataFrame:
    """Predictions for rows that hold the model's inputs already."""
    return model.transform(_assembled(inputs)).drop(_VECTOR)


def regression_metrics(scored: DataFrame, label: str = "price", prediction: str = "predicted_price") -> DataFrame:
    """Mean absolute error and R² in one pass."""
    error = F.col(label) - F.col(prediction)
    spread = F.var_pop(label) * F.count(label)
    return scored.agg(
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.sum(error * error) / F.nullif(spread, F.lit(0.0))).alias("r2"),
    )


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, value and count of all known values of all columns, in one scan."""
    values = F.array(*[F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("value")) for name in columns])
    pairs = df.select(F.explode(values).alias("pair")).select("pair.*")
    return pairs.where(F.col("value").isNotNull()).groupBy("column", "value").count()


def category_places(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, value and place: the values of each column by falling frequency, then name, from 0.

    The counts of all columns are sorted by ranges over many tasks, once; a value's place is its place in the
    task plus the column's values in the tasks before, so neither the driver nor one task holds the list.
    """
    order = [F.col("count").desc(), F.col("value")]
    ranged = category_counts(df, columns).repartitionByRange("column", *order).withColumn("part", F.spark_partition_id())
    ranged = stage(ranged, "categories")
    local = F.row_number().over(Window.partitionBy("part", "column").orderBy(*order))
    earlier = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("part", "column").agg(F.count("*").alias("size"))
    offsets = sizes.select("part", "column", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    placed = ranged.withColumn("local", local).join(offsets, ["part", "column"])
    return placed.select("column", "value", (F.col("before") + F.col("local") - 1).alias("place"))


def categorical_encode(df: DataFrame, columns: Sequence[str] = ("fuel_type", "brand")) -> DataFrame:
    """Add ``<column>_index`` and ``<column>_vector``, one slot per value; a NULL is all zeros.

    A NULL's index is one past the last value's. Vectors are sparse. One dictionary holds the places of all
    columns; each column is looked up in its part of it.
    """
    places = stage(category_places(df, columns), "places")
    sizes = {row["column"]: row["size"] for row in places.groupBy("column").agg(F.count("*").alias("size")).collect()}
    indexes, vectors = [f"{name}_index" for name in columns], [f"{name}_vector" for name in columns]
    indexed = df
    for name, index in zip(columns, indexes):
        own = places.where(F.col("column") == name).select(F.col("value").cast(df.schema[name].dataType).alias(name), F.col("place").alias(index))
        size = sizes.get(name, 0)
        nominal = {"ml_attr": {"type": "nominal", "name": index, "num_vals": size + 1}}
        place = F.coalesce(F.col(index), F.lit(size)).cast("double")
        indexed = indexed.join(own, name, "left").withColumn(index, place).withMetadata(index, nominal)
    indexed = indexed.select(*df.columns, *indexes)
    # A column without any value has no slots.
    known = [i for i, name in enumerate(columns) if sizes.get(name)]
    for i in set(range(len(columns))) - set(known):
        indexed = indexed.withColumn(vectors[i], array_to_vector(F.array().cast("array<double>")))
    if not known:
        return indexed
    encoder = OneHotEncoder(inputCols=[indexes[i] for i in known], outputCols=[vectors[i] for i in known])
    return encoder.fit(indexed).transform(indexed)
