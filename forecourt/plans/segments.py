"""K-Means market segments and their business names."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forecourt.operators.keyed import first_per_key
from forecourt.operators.shape import filter_complete
from forecourt.operators.tables import create_if_absent, replace_rows
from forecourt.schemas import CLUSTER_MART
from forecourt.session import stage

FEATURES = ("price", "mileage", "year")
PROFILE = "cluster_id int, avg_price double, avg_mileage double, avg_year double"
FEATURE_COLUMNS = [
    "brand", "model", "year", "price", "mileage", "fuel_type", "engine_size", "is_ulez_compliant",
]

# Names by price position (1 = cheapest), compliant and not.
SEGMENT_NAMES = {
    1: ("Budget Entry (ULEZ Compliant)", "Desperate Dump (Non-Compliant)"),
    2: ("Standard Market (ULEZ Compliant)", "Standard Market (Non-Compliant)"),
    3: ("Premium Segment (ULEZ Compliant)", "Premium Segment (Non-Compliant)"),
}


def ml_feature_extract(facts: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """The model columns of every row whose price, mileage and year are known."""
    return filter_complete(facts.select(*columns), FEATURES)


def _scaled(names: Sequence[str], means: Sequence[float], deviations: Sequence[float], prefix: str) -> dict:
    """(x - mean) / deviation per column, 0 for a constant column."""
    return {
        f"{prefix}{name}": (F.col(name) - mean) / deviation if deviation else F.lit(0.0)
        for name, mean, deviation in zip(names, means, deviations)
    }


def standard_scale(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Add ``scaled_<column>``: (x - mean) / sample standard deviation, 0 for a constant column."""
    moments = df.agg(*[F.avg(c) for c in columns], *[F.stddev_samp(c) for c in columns]).first()
    return df.withColumns(_scaled(columns, moments[: len(columns)], moments[len(columns) :], "scaled_"))


@dataclass(frozen=True)
class Segmenter:
    """A fitted scaling and the centres of the segments in scaled units, with their row counts."""

    columns: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]
    centres: np.ndarray
    sizes: np.ndarray
    cost: float

    def distances(self) -> list[Column]:
        """Squared distance of a row from each centre."""
        scaled = list(_scaled(self.columns, self.means, self.deviations, "").values())
        return [
            sum((x - float(c)) * (x - float(c)) for x, c in zip(scaled, centre)) for centre in self.centres
        ]

    def transform(self, df: DataFrame) -> DataFrame:
        """The rows with ``cluster_id``: the nearest centre, the first one in a tie."""
        distances = F.array(*self.distances())
        nearest = F.array_position(distances, F.array_min(distances)) - 1
        return df.withColumn("cluster_id", nearest.cast("int"))

    def profile(self) -> list[tuple]:
        """cluster_id and mean of each column, for segments that have rows."""
        centres = self.centres * np.array(self.deviations) + np.array(self.means)
        return [(i, *map(float, centre)) for i, centre in enumerate(centres) if self.sizes[i]]


def _first_centres(blocks: DataFrame, names: Sequence[str], k: int, starts: int, seed: int) -> np.ndarray:
    """The first centres of every start: rows drawn one by one, each by its squared distance from those before.

    A point's chance counts its rows. The least of ``-ln(u) / chance`` over all points is such a draw, and u is
    a hash of the point's values and the draw's number, so neither row order nor layout matters.
    """
    size = len(names)
    chosen = np.zeros((starts, k, size))
    fields = ", ".join(["start long, rank double", *[f"{name} double" for name in names]])
    for pick in range(k):

        def least(batches: Iterator[pa.RecordBatch], pick: int = pick) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = _points_of(batch.column("points"), size)
                if not len(rows):
                    continue
                at, weight, draw = rows[:, :size], rows[:, size], rows[:, size + 1].copy().view(np.uint64)
                found = []
                for start in range(starts):
                    distance = np.ones(len(rows))
                    if pick:
                        distance = ((at[:, None, :] - chosen[start, :pick]) ** 2).sum(axis=2).min(axis=1)
                    u = ((_mixed(draw, (seed + start) * k + pick) >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)
                    with np.errstate(divide="ignore"):
                        rank = np.where(distance > 0, -np.log(u) / (weight * distance), np.inf)
                    first = int(np.lexsort((*at.T[::-1], rank))[0]) if np.isinf(rank.min()) else int(rank.argmin())
                    found.append([start, rank[first], *at[first]])
                start, *values = np.array(found).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(start.astype(np.int64)), *map(pa.array, values)], names=["start", "rank", *names]
                )

        drawn = blocks.mapInArrow(least, fields).groupBy("start").agg(F.min(F.struct("rank", *names)).alias("least"))
        for start, (_, *point) in drawn.collect():  # a row per start
            chosen[start, pick] = point
    return chosen


def _mixed(draw: np.ndarray, number: int) -> np.ndarray:
    """A hash of 64-bit numbers and the number of a draw (the finalizer of SplitMix64)."""
    with np.errstate(over="ignore"):
        x = draw + np.uint64(number + 1) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _points_of(packed: pa.Array, size: int) -> np.ndarray:
    """The rows of packed blocks: columns, weight and the bits of the draw's hash."""
    return np.frombuffer(b"".join(packed.to_pylist())).reshape(-1, size + 2)


#: Points of a block. Smaller ones are cut less often by the border of two segments, but there are more of them.
BLOCK_POINTS = 256
_GRID = 16  # bits per column of the order in which points are laid into blocks
_REACH = 8.0  # scaled units beyond which points share the outermost cells of that order


def _spread_bits(number: Column, apart: int) -> Column:
    """The bits of a number below 2^_GRID, ``apart`` places from each other."""
    bits = [F.shiftleft(number.bitwiseAND(1 << i), i * (apart - 1)) for i in range(_GRID)]
    spread = bits[0]
    for bit in bits[1:]:
        spread = spread.bitwiseOR(bit)
    return spread


def point_blocks(points: DataFrame, names: Sequence[str]) -> DataFrame:
    """The weighted points (columns, weight, draw) in blocks of neighbours, with the box, weight and sums of each.

    Points are sorted along a curve that interleaves the bits of their columns, then by value, so a range of any
    size can be split and near points mostly share a block.
    """
    code = None
    for i, name in enumerate(names):
        cell = F.floor((F.col(name) + _REACH) / (2 * _REACH) * (1 << _GRID))
        cell = F.least(F.greatest(cell, F.lit(0)), F.lit((1 << _GRID) - 1)).cast("long")
        bits = F.shiftleft(_spread_bits(cell, len(names)), i)
        code = bits if code is None else code.bitwiseOR(bits)
    size = len(names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *values, weight, draw = [column.to_numpy() for column in batch.columns]
            at = np.column_stack(values)
            rows = np.column_stack([at, weight, draw.view(np.float64)])
            starts = np.arange(0, len(weight), BLOCK_POINTS)
            if not len(starts):
                continue
            ends = np.append(starts[1:], len(weight))
            weighted = at * weight[:, None]
            figures = np.column_stack([
                np.minimum.reduceat(at, starts), np.maximum.reduceat(at, starts), np.add.reduceat(weighted, starts),
                np.add.reduceat(weight, starts), np.add.reduceat((weighted * at).sum(axis=1), starts),
            ])
            packed = pa.array([rows[i:j].tobytes() for i, j in zip(starts, ends)], pa.binary())
            listed = pa.FixedSizeListArray.from_arrays(pa.array(figures.ravel()), figures.shape[1])
            yield pa.RecordBatch.from_arrays([listed.cast(pa.list_(pa.float64())), packed], names=["figures", "points"])

    in_order = points.select(*names, "weight", "draw", code.alias("code")).repartitionByRange("code", *names)
    in_order = in_order.sortWithinPartitions("code", *names).select(*names, "weight", "draw")
    return in_order.mapInArrow(pack, "figures array<double>, points binary")


def block_sums(figures: np.ndarray, packed: pa.Array, centres: np.ndarray) -> tuple[np.ndarray, int]:
    """n, cost and sums per start and centre over some blocks, and how many distances were computed.

    The squared distances of a point from two centres differ by a linear function of the point, so its greatest
    value over a block's box tells whether one centre is the nearest to all of the block. Then the block's sums are
    the points'. Only the blocks on a border between segments are looked into.
    """
    starts, k, size = centres.shape
    low, high, sums = figures[:, :size], figures[:, size : 2 * size], figures[:, 2 * size : 3 * size]
    weight, squares = figures[:, 3 * size], figures[:, 3 * size + 1]
    norms = (centres**2).sum(axis=2)
    found = np.zeros((starts, k, size + 2))
    distances = 0
    for start in range(starts):
        own = ((((low + high) / 2)[:, None, :] - centres[start]) ** 2).sum(axis=2).argmin(axis=1)
        slope = 2 * (centres[start][None, :, :] - centres[start][own][:, None, :])
        most = np.maximum(low[:, None, :] * slope, high[:, None, :] * slope).sum(axis=2)
        most += norms[start][own][:, None] - norms[start][None, :]
        most[np.arange(len(own)), own] = -np.inf
        whole = (most < 0).all(axis=1)
        for centre in range(k):
            inside = whole & (own == centre)
            n, total = weight[inside].sum(), sums[inside].sum(axis=0)
            cost = squares[inside].sum() - 2 * total @ centres[start, centre] + n * norms[start, centre]
            found[start, centre] += [n, cost, *total]
        border = np.flatnonzero(~whole)
        if len(border):
            rows = _points_of(packed.take(pa.array(border)), size)
            at, weights = rows[:, :size], rows[:, size]
            distance = ((at[:, None, :] - centres[start]) ** 2).sum(axis=2)
            distances += distance.size
            nearest = distance.argmin(axis=1)
            found[start, :, 0] += np.bincount(nearest, weights, k)
            found[start, :, 1] += np.bincount(nearest, weights * distance.min(axis=1), k)
            for i in range(size):
                found[start, :, 2 + i] += np.bincount(nearest, weights * at[:, i], k)
    return found, distances


def _assign(blocks: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row count, sum of rows and cost per start and centre, in one pass over the blocks for all starts."""
    starts, k, size = centres.shape
    names = [f"sum_{i}" for i in range(size)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((starts, k, size + 2))
        for batch in batches:
            if batch.num_rows:
                figures = batch.column("figures").flatten().to_numpy().reshape(batch.num_rows, -1)
                total += block_sums(figures, batch.column("points"), centres)[0]
        start, centre = np.divmod(np.arange(starts * k), k)
        columns = [start, centre, *total.reshape(-1, size + 2).T]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["start", "centre", "n", "cost", *names])

    ddl = ", ".join(["start long, centre long, n double, cost double", *[f"{name} double" for name in names]])
    parts = blocks.mapInArrow(sums, ddl).groupBy("start", "centre")
    rows = parts.agg(*[F.sum(name) for name in ("n", "cost", *names)]).collect()  # starts times k rows
    found = np.zeros((starts, k, size + 2))
    for start, centre, *values in rows:
        found[start, centre] = values
    return found[:, :, 0], found[:, :, 2:], found[:, :, 1]


def fit_segments(
    features: DataFrame, k: int = 3, starts: int = 10, seed: int = 42, rounds: int = 300, tolerance: float = 1e-4
) -> Segmenter | None:
    """Best of several K-Means starts on the scaled features; None if there are no rows.

    Every start runs over all rows until its centres' squared shifts add up to ``tolerance`` at most; the one
    of least cost goes on until no coordinate moves by more than that. Equal rows are one weighted point, as the draws
    need equal values together. The points are scaled and written once in blocks of neighbours; a round is
    one pass over the blocks for all starts that still move, which computes distances only in blocks that
    bounds cannot give to one centre, and a task sends a few sums. A centre without rows stays where it is.
    Segments are numbered in the order of their centres.
    """
    names = list(FEATURES)
    count, *found = features.agg(
        F.count("*"), *[F.avg(name) for name in names], *[F.stddev_pop(name) for name in names]
    ).first()
    if not count:
        return None
    means, deviations = tuple(found[: len(names)]), tuple(found[len(names) :])
    scaled = _scaled(names, means, deviations, "")
    distinct = features.groupBy(*names).agg(F.count("*").cast("double").alias("weight"))
    values = [x.cast("double").alias(name) for name, x in scaled.items()]
    points = stage(distinct.select(*values, "weight", F.xxhash64(*names).alias("draw")), "points")
    blocks = stage(point_blocks(points, names), "blocks")
    centres = _first_centres(blocks, names, k, starts, seed)
    sizes, costs = np.zeros(centres.shape[:2]), np.zeros(len(centres))

    def move(moving: np.ndarray) -> np.ndarray:
        """One round of some starts; how far each centre went."""
        counts, sums, cost = _assign(blocks, centres[moving])
        means_of = np.divide(sums, counts[:, :, None], out=centres[moving].copy(), where=counts[:, :, None] > 0)
        shift = means_of - centres[moving]
        centres[moving], sizes[moving], costs[moving] = means_of, counts, cost.sum(axis=1)
        return shift

    moving = np.arange(len(centres))
    for _ in range(rounds):
        moving = moving[(move(moving) ** 2).sum(axis=(1, 2)) > tolerance]
        if not len(moving):
            break
    best = int(np.argmin(costs))
    for _ in range(rounds):
        if np.abs(move(np.array([best]))).max() <= tolerance:
            break
    order = np.lexsort(centres[best].T[::-1])
    return Segmenter(tuple(names), means, deviations, centres[best][order], sizes[best][order], float(costs[best]))


def kmeans_segments(features: DataFrame, **options) -> DataFrame:
    """The features with the ``cluster_id`` of their segment; no rows in, no rows out."""
    segmenter = fit_segments(features, **options)
    if segmenter is None:
        return features.withColumn("cluster_id", F.lit(None).cast("int"))
    return segmenter.transform(features)


def cluster_profile_means(scored: DataFrame) -> DataFrame:
    """Mean price, mileage and year per cluster."""
    return scored.groupBy("cluster_id").agg(*[F.avg(name).alias(f"avg_{name}") for name in FEATURES])


def cluster_price_order(profile: DataFrame) -> DataFrame:
    """Price positions 1 to 3 of the clusters; more than three clusters share them by thirds."""
    position = F.ntile(len(SEGMENT_NAMES)).over(Window.orderBy("avg_price", "cluster_id"))
    return profile.withColumn("price_position", position)


def segment_name(position: Column, compliant: Column) -> Column:
    """NULL for a position without a name."""
    return F.coalesce(
        *[
            F.when(position == place, F.when(compliant, F.lit(yes)).otherwise(F.lit(no)))
            for place, (yes, no) in SEGMENT_NAMES.items()
        ]
    )


def cluster_business_names(scored: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """Add ``cluster_name`` from the cluster's price position and the row's compliance.

    The clusters' means are taken from ``scored`` unless their profile is given.
    """
    profile = cluster_profile_means(scored) if profile is None else profile
    order = cluster_price_order(profile).select("cluster_id", "price_position")
    named = scored.join(F.broadcast(order), "cluster_id", "left")  # a row per cluster
    name = segment_name(F.col("price_position"), F.col("is_ulez_compliant"))
    return named.withColumn("cluster_name", name).drop("price_position")


def sample_per_cluster(mart: DataFrame, rows: int = 3) -> DataFrame:
    """A few example listings of each named cluster, sorted by cluster name."""
    order = [F.col(c).asc_nulls_last() for c in ("price", "brand", "model", "year", "mileage")]
    examples = first_per_key(
        mart.where(F.col("cluster_name").isNotNull()), ["cluster_name"], order, rows
    )
    return examples.select(
        "cluster_name", "brand", "model", "year", "price", "mileage", "is_ulez_compliant"
    ).orderBy("cluster_name", "price", "brand", "model", "year", "mileage")


def cluster_mart(spark: SparkSession, facts: DataFrame, table: str, **options) -> DataFrame | None:
    """Extract, cluster, name and overwrite the mart; without usable rows the mart is left alone.

    The features are written once, as they are read for the moments, for the scaled points, and to assign the rows.
    """
    features = stage(ml_feature_extract(facts), "features")
    segmenter = fit_segments(features, **options)
    if segmenter is None:
        return None
    create_if_absent(spark, table, CLUSTER_MART)
    profile = spark.createDataFrame(segmenter.profile(), PROFILE)
    named = cluster_business_names(segmenter.transform(features), profile)
    replace_rows(named, table)
    return spark.table(table)
