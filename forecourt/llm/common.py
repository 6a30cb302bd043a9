"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SLICE_BYTES = 8 * 1024 * 1024


def slices(
    batches: Iterable[pa.RecordBatch], most_rows: int = 1024, most_bytes: int = _SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Arrow batches in pieces of about 8 MB by default, so that a worker's memory does not follow the batch size.

    Only the piece size varies: every row is in exactly one piece. A worker outlives its task, so at the end Arrow's
    free memory is given back.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = max(1, min(most_rows, most_bytes * batch.num_rows // max(1, batch.nbytes)))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    pa.default_memory_pool().release_unused()


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone; whatever else the table carries cannot clash with ours."""
    return df.select(*[F.col(f"`{name}`") for name in names])


def ascii_any_case(word: str) -> str:
    """A pattern for ``word`` in either case of ASCII letters, alike in every regex engine."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))
