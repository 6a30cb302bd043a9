"""Nearest neighbours by inner product over randomly rotated one-bit codes.

A vector v is centred, scaled to length 1 and rotated into ``code_bits`` dimensions; its code is the
signs, one bit each. With the length of v - c and the inner product of the rotated unit vector with
its code as correction scalars, the packed bits give an unbiased estimate of <q, v> for any query q
and a bound on its error. A task goes through its rows in blocks: the k rows of a block with the best estimates
are scored; their least score, or that of the k best of the blocks before, is a floor, and every row whose upper
bound reaches it is reranked. Scores are summed
component by component in double precision on the original vectors. ``EPSILON`` standard deviations
of error are allowed, so a neighbour can be missed; the tests measure how many are.

Every row is indexed; nothing is fitted on a sample but the centre, the mean of all rows. Queries are
a table in the shared folder that every task reads in blocks against its rows, so no task holds more than its
ROWS_PER_TASK rows and one block of queries, however many there are. A task emits k rows per query.

Rows without vec_id, and vectors that are null, zero, of another length than most, or that hold null
or non-finite components take no part. Equal rows are one; other rows that share a vec_id are rows of
their own, as candidates (also of each other) and as queries, each with its own ranks. Ties in score go to the smaller vec_id. Without rows or queries the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import only
from forecourt.session import scratch_path, stage

EPSILON = 3.0
LEAST_CODE_BITS = 1024
SEED = 9
ROWS_PER_TASK, ROWS_PER_BLOCK, QUERIES_PER_BLOCK = 16384, 4096, 256
#: Place of the query, vec_id and score of hits, by query and then the best first.
Hits = tuple[np.ndarray, np.ndarray, np.ndarray]


@dataclass(frozen=True)
class Rotation:
    """A centre and a matrix with orthonormal columns, from dim to code_bits dimensions."""

    centre: np.ndarray
    matrix: np.ndarray

    @property
    def code_bits(self) -> int:
        return len(self.matrix)


def random_rotation(centre: np.ndarray, seed: int = SEED) -> Rotation:
    bits = max(LEAST_CODE_BITS, -(-len(centre) // 64) * 64)
    gaussian = np.random.default_rng(seed).standard_normal((bits, len(centre)))
    return Rotation(centre, np.linalg.qr(gaussian)[0])


@dataclass(frozen=True)
class Codes:
    """Packed signs of some rows and their two correction scalars."""

    bits: np.ndarray
    length: np.ndarray
    fit: np.ndarray


def encode(vectors: np.ndarray, rotation: Rotation) -> Codes:
    moved = vectors - rotation.centre
    length = np.linalg.norm(moved, axis=1)
    unit = (moved / np.where(length > 0, length, 1.0)[:, None]) @ rotation.matrix.T
    fit = np.abs(unit).sum(axis=1) / np.sqrt(rotation.code_bits)
    return Codes(np.packbits(unit > 0, axis=1), length, fit)


def bounds(queries: np.ndarray, codes: Codes, rotation: Rotation, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray]:
    """Estimates of <query, row> for all rows of a block, and the allowed error of each."""
    rotated = (queries @ rotation.matrix.T).astype(np.float32)
    bits = np.unpackbits(codes.bits, axis=1, count=rotation.code_bits).astype(np.float32)
    # Signs are 2 * bit - 1.
    agreement = (2 * (rotated @ bits.T) - rotated.sum(axis=1, keepdims=True)) / np.sqrt(np.float32(rotation.code_bits))
    fit = np.where(codes.fit > 0, codes.fit, 1.0)
    estimate = (queries @ rotation.centre)[:, None] + agreement * (codes.length / fit)
    spread = codes.length * np.sqrt(np.maximum(0.0, 1 - fit**2)) / fit * epsilon / np.sqrt(rotation.code_bits - 1)
    size = np.linalg.norm(queries, axis=1)[:, None]
    slack = 1e-5 * size * (codes.length + np.linalg.norm(rotation.centre))
    return estimate, size * spread + slack


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row by row, summed in the order of the components."""
    total = np.zeros(len(left))
    for i in range(left.shape[1]):
        total += left[:, i] * right[:, i]
    return total


def search_block(
    query_ids: np.ndarray,
    queries: np.ndarray,
    ids: np.ndarray,
    vectors: np.ndarray,
    codes: Codes,
    rotation: Rotation,
    k: int,
    before: Hits | None = None,
) -> Hits:
    """The k best rows for each query, of a block and the hits of the blocks before it."""
    estimate, error = bounds(queries, codes, rotation)
    q, v = np.nonzero(query_ids[:, None] == ids[None, :])
    own = (queries[q] == vectors[v]).all(axis=1)
    estimate[q[own], v[own]] = -np.inf
    floor = np.full(len(queries), -np.inf)
    if before is not None:
        ends = np.searchsorted(before[0], np.arange(len(queries)), "right")
        full = np.diff(ends, prepend=0) == k
        floor[full] = before[2][ends[full] - 1]
    if len(ids) > k:
        likely = np.argpartition(estimate, len(ids) - k, axis=1)[:, len(ids) - k :]
        q, v = np.repeat(np.arange(len(queries)), k), likely.reshape(-1)
        scored = np.where(np.isfinite(estimate[q, v]), inner_products(queries[q], vectors[v]), -np.inf)
        floor = np.maximum(floor, scored.reshape(-1, k).min(axis=1))
    q, v = np.nonzero((estimate > -np.inf) & (estimate + error >= floor[:, None]))
    hits = (q, ids[v], inner_products(queries[q], vectors[v]))
    if before is not None:
        hits = tuple(np.concatenate(both) for both in zip(before, hits))
    place, found, score = hits
    order = np.lexsort((found, -score, place))
    place = place[order]
    best = order[np.arange(len(place)) - np.searchsorted(place, place) < k]
    return hits[0][best], found[best], score[best]


def _usable(vector: str = "embedding") -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _query_blocks(folder: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, numbers and vectors of the queries."""
    system, root = fs.FileSystem.from_uri(folder)
    for info in system.get_file_info(fs.FileSelector(root)):
        if info.base_name.endswith(".parquet"):
            with system.open_input_file(info.path) as file:
                for batch in pq.ParquetFile(file).iter_batches(QUERIES_PER_BLOCK):
                    if batch.num_rows:
                        yield batch.column("vec_id").to_numpy(), batch.column("query").to_numpy(), _matrix(batch.column("embedding"))


_HIT = pa.schema([("query_id", pa.int64()), ("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def nearest(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest rows of each query row, its own excluded.

    ``vectors`` has vec_id and embedding (array of numbers); ``is_query`` selects the queries.
    """
    spark = vectors.sparkSession
    rows = only(vectors, "vec_id", "embedding").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(_usable(), F.lit(False)))
    lengths = rows.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").take(1)
    dim = lengths[0]["dim"] if lengths else 1
    valid = stage(rows.where(F.size("embedding") == dim).distinct(), "vectors")
    n_rows = valid.count()
    mean = valid.select(F.posexplode("embedding")).groupBy("pos").agg(F.avg("col").alias("mean")).toArrow().to_pylist()
    rotation = random_rotation(np.array([row["mean"] for row in sorted(mean, key=lambda row: row["pos"])] or [0.0]))
    folder = scratch_path(spark, "queries")
    # Queries of one vec_id are told apart by a hash of their vectors.
    valid.where(is_query).withColumn("query", F.xxhash64("embedding")).write.parquet(folder)

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = encode(_matrix(batch.column("embedding")), rotation)
                columns = [pa.array([row.tobytes() for row in codes.bits], pa.binary()), pa.array(codes.length), pa.array(codes.fit)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=["vec_id", "embedding", "code", "length", "fit"])

    coded = valid.mapInArrow(index, "vec_id long, embedding array<double>, code binary, length double, fit double")

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _tables(batches):
            packed = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint8).reshape(table.num_rows, -1)
            ids, vectors = table.column("vec_id").to_numpy(), _matrix(table.column("embedding").combine_chunks())
            length, fit = table.column("length").to_numpy(), table.column("fit").to_numpy()
            blocks = [slice(start, start + ROWS_PER_BLOCK) for start in range(0, len(ids), ROWS_PER_BLOCK)]
            for query_ids, numbers, queries in _query_blocks(folder):
                hits = None
                for at in blocks:
                    codes = Codes(packed[at], length[at], fit[at])
                    hits = search_block(query_ids, queries, ids[at], vectors[at], codes, rotation, k, hits)
                place, *found = hits
                columns = [query_ids[place], numbers[place], *found]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_HIT)

    dealt = coded.repartition(max(1, -(-n_rows // ROWS_PER_TASK)))
    hits = dealt.mapInArrow(search, "query_id long, query long, vec_id long, score double")
    by_score = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _tables(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a task in tables of at most ROWS_PER_TASK: one, but for uneven dealing."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_PER_TASK):
            piece = batch.slice(start, ROWS_PER_TASK)
            if n + piece.num_rows > ROWS_PER_TASK and held:
                yield pa.Table.from_batches(held)
                held, n = [], 0
            held.append(piece)
            n += piece.num_rows
    if n:
        yield pa.Table.from_batches(held)
