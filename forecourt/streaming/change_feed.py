"""Change logs and arriving files as Structured Streaming jobs.

A change log is a folder of parquet files with an ``_action`` column. The
transforms are the batch ones; only source, sink and trigger are added here.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from forecourt.operators.keyed import net_changes
from forecourt.operators.shape import filter_inserts, fit_columns
from forecourt.operators.tables import create_if_absent
from forecourt.plans.facts import api_feed_facts, brand_feed_facts
from forecourt.schemas import FACT, columns_of
from forecourt.session import stage
from forecourt.streaming.compaction import streamed_rows

LOAD = "load"  # partition column of tables that micro-batches fill


def read_parquet_stream(
    spark: SparkSession,
    path: str,
    schema,
    glob: str | None = None,
    max_files_per_batch: int | None = None,
) -> DataFrame:
    """Files of a folder as a stream; the file limit bounds a micro-batch after a long pause."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.parquet(path)


def cdc_insert_facts(changes: DataFrame, brand: str) -> DataFrame:
    """Fact rows of the inserts in a one-brand change log (batch or stream)."""
    return fit_columns(brand_feed_facts(filter_inserts(changes), brand), columns_of(FACT))


def api_cdc_facts(changes: DataFrame) -> DataFrame:
    """Fact rows of the inserts in the API feed's change log (batch or stream)."""
    return fit_columns(api_feed_facts(filter_inserts(changes)), columns_of(FACT))


def start_append(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append a stream to a parquet folder.

    With ``every`` (such as "1 minute") it runs as a service; without, it takes
    what is new since the checkpoint and ends.
    """
    writer = stream.writeStream.outputMode("append").format("parquet")
    writer = writer.option("checkpointLocation", checkpoint).option("path", path)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


class _InputRows(StreamingQueryListener):
    """Input rows of every run of a query. ``recentProgress`` forgets old batches, this does not."""

    def __init__(self) -> None:
        self._rows: dict[str, int] = defaultdict(int)
        self._ended: dict[str, Event] = defaultdict(Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._rows[str(event.progress.runId)] += event.progress.numInputRows

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def of(self, run_id: str, wait_seconds: float = 60) -> int:
        """The total of a run, once the event of its end, which comes last, has arrived."""
        if not self._ended[run_id].wait(wait_seconds):
            raise TimeoutError(f"no end of run {run_id} was reported")
        return self._rows[run_id]


def run_increment(stream: DataFrame, path: str, checkpoint: str) -> int:
    """Process what is new and wait for the end; returns the number of input rows."""
    streams, rows = stream.sparkSession.streams, _InputRows()
    streams.addListener(rows)
    try:
        query = start_append(stream, path, checkpoint)
        query.awaitTermination()
        return rows.of(str(query.runId))
    finally:
        streams.removeListener(rows)


def all_facts(spark: SparkSession, table: str, stream_path: str | None = None) -> DataFrame:
    """Facts loaded by batch jobs and facts appended by a stream: what every reader of facts takes.

    The stream's folder has a commit log of its own, which makes its appends
    exactly-once and hides files others put there. So batch loads go to the
    table, the stream to its folder, and readers take both; compacted files stand in for the stream's own.
    """
    loaded = spark.table(table).select(*columns_of(FACT))
    return loaded.unionByName(streamed_rows(spark, stream_path, FACT)) if stream_path else loaded


def create_load_table(spark: SparkSession, table: str, ddl: str) -> None:
    """A table with one partition per micro-batch."""
    create_if_absent(spark, table, f"{ddl}, {LOAD} string", partition_by=[LOAD])


_FILE_ROWS = 1_000_000


def replace_load(rows: DataFrame, table: str, load: str) -> None:
    """Make ``rows`` the whole content of the table's partition ``load``, in files of about a million rows.

    Micro-batches run without adaptive execution, so the rows are counted to know the number of files.
    """
    spark, rows = rows.sparkSession, stage(rows, "load")
    rows = rows.coalesce(max(1, -(-rows.count() // _FILE_ROWS)))
    names = ", ".join(f"`{name}`" for name in spark.table(table).columns if name != LOAD)
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({LOAD} = '{load}') SELECT {names} FROM {{rows}}", rows=rows)


def run_load_increment(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    mode: str = "append",
) -> None:
    """Process what is new: every micro-batch, transformed, becomes its own partition of ``table``.

    The partition is named by checkpoint and number, so a micro-batch that is replayed after a failure
    replaces what it had written.
    """
    feed = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def write(batch: DataFrame, number: int) -> None:
        replace_load(transform(batch) if transform else batch, table, f"{feed}-{number}")

    query = (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_net_increment(
    changes: DataFrame,
    table: str,
    checkpoint: str,
    facts: Callable[[DataFrame], DataFrame],
    key: str = "_row_id",
    order: str = "_seq",
) -> None:
    """Fold what is new in a change log to its net changes, then add the facts of the inserts.

    A row that came and went within an increment leaves nothing, one that was changed several times leaves its
    last image. ``facts`` are those of a change log (``cdc_insert_facts``, ``api_cdc_facts``).
    """
    run_load_increment(changes, table, checkpoint, lambda batch: facts(net_changes(batch, key, order)))


_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def new_adverts(stream: DataFrame, key: str = "id", newest: str = "search_timestamp") -> DataFrame:
    """Adverts of a stream, each in the first micro-batch that brings it, its newest row there (update mode).

    The state holds a row per advert: the least by micro-batch, then newest first, ties to the smallest remaining
    columns. A micro-batch changes that row only if it brings the advert first. The state holds each value once: the
    row is rebuilt from what orders it. Rows without a key all pass and take no state.
    """
    names = stream.columns
    ties = [name for name in names if name not in (key, newest)]
    parts = [F.col(newest).isNull().alias("late"), (-F.unix_micros(newest)).alias("age")]
    for i, name in enumerate(ties):
        parts += [F.col(name).isNull().alias(f"none_{i}"), F.col(name).alias(f"value_{i}")]
    first = F.min(F.struct(F.col("_seen").alias("seen"), *parts)).alias("first")
    # The micro-batch's own time, also when it is replayed.
    timed = stream.where(F.col(key).isNotNull()).withColumn("_seen", F.current_timestamp())
    known = timed.groupBy(F.col(key).alias("_key")).agg(first)
    row = {key: F.col("_key"), newest: F.timestamp_micros(-F.col("first.age"))}
    row |= {name: F.col(f"first.value_{i}") for i, name in enumerate(ties)}
    known = known.where(F.col("first.seen") == F.current_timestamp()).select(*[row[name].alias(name) for name in names])
    return known.unionByName(stream.where(F.col(key).isNull()))


def run_dedup_increment(stream: DataFrame, table: str, checkpoint: str, key: str = "id") -> None:
    """Add each advert of the stream once to a table of ``create_load_table``; the seen ones are in the state store."""
    conf = stream.sparkSession.conf
    before = conf.get(_STORE)
    conf.set(_STORE, _ROCKS)  # on disk, so the state may exceed the executors' memory
    try:
        run_load_increment(new_adverts(stream, key), table, checkpoint, mode="update")
    finally:
        conf.set(_STORE, before)
