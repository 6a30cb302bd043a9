"""Language identification: multinomial naive Bayes over hashed character n-grams.

Characters are lower-cased; runs of anything but letters become one space. N-grams of one to four
characters are hashed into a fixed number of buckets. Training counts them over all training rows,
per task and language, and sums the counts in one small shuffle. The matrix of log-probabilities
(buckets times languages) is broadcast; its size is fixed but for the number of languages, which is
checked. Scoring lays the n-grams of many texts end to end, as a ragged index into the matrix, and sums
the entries of each text in numpy; how texts fall into batches changes no score.

Training rows have a language and a CRC-32 of their doc_id, as text, that leaves another remainder
than 1 by 3; rows without doc_id are not learned from. A prediction depends on the text alone. Text
that is null or without letters is ``und`` with score 0, as is every text if nothing was learned.
Ties go to the first language by name. A repeated row gets its own result; texts of any length are
read whole; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import only, slices
from forecourt.session import stage

UNKNOWN = "und"
BUCKETS = 1 << 15
LARGEST_N = 4
SMOOTHING = 0.5
MAX_LANGUAGES = 512  # a matrix of 128 MB, and twice that in counts; more is an error, none is left out
_NO_LETTERS = re.compile(r"[\W\d_]+")
_PIECE = 1 << 20  # characters whose n-grams are held at a time
_CUT = 1 << 19  # log-probabilities that are summed at a time


def _piece_buckets(codes: np.ndarray, lead: int) -> np.ndarray:
    """Buckets of the n-grams that end at or after place ``lead``."""
    found, hashed = [], np.zeros(len(codes), np.uint64)
    for n in range(1, LARGEST_N + 1):
        if len(codes) < n:
            break
        hashed = (hashed[: len(codes) - n + 1] + codes[n - 1 :]) * np.uint64(0x9E3779B97F4A7C15)
        mixed = hashed ^ (hashed >> np.uint64(29)) ^ np.uint64(n)
        found.append(((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(49))[max(0, lead - n + 1) :])
    return np.concatenate(found).astype(np.int64)


def ngram_buckets(text: str) -> Iterator[np.ndarray]:
    """The buckets of all n-grams of a text, in pieces of bounded size."""
    if not any(map(str.isalpha, text)):
        return
    letters = _NO_LETTERS.sub(" ", text.lower()).strip()
    codes = np.frombuffer(f" {letters} ".encode("utf-32-le"), "<u4").astype(np.uint64)
    for start in range(0, len(codes), _PIECE):
        lead = min(start, LARGEST_N - 1)
        yield _piece_buckets(codes[start - lead : start + _PIECE], lead)


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept from training by its doc_id; false without one."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in slices(batches):
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            if lang not in counts:
                counts[lang] = np.zeros(BUCKETS, np.int64)
            for buckets in ngram_buckets(text):
                counts[lang] += np.bincount(buckets, minlength=BUCKETS)
    for lang, found in counts.items():
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict(
            {"lang": pa.array([lang] * len(used), pa.string()), "bucket": used, "n": found[used]}
        )


@dataclass(frozen=True)
class Model:
    """Languages by name and the log-probability of each bucket in each, one row per language."""

    languages: tuple[str, ...]
    log_probability: np.ndarray


def train(docs: DataFrame) -> Model:
    """Fit on the rows of ``docs`` (doc_id, text, lang) that training may use, all of them."""
    rows = only(docs, "doc_id", "text", "lang")
    usable = rows.where(F.col("doc_id").isNotNull() & ~is_held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = stage(
        usable.select("text", "lang")
        .mapInArrow(_count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n")),
        "ngrams",
    )
    named = counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).toArrow().column("lang").to_pylist()
    if len(named) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} values of lang: not a column of languages")
    languages = tuple(sorted(named))
    matrix = np.full((len(languages), BUCKETS), SMOOTHING)
    places = docs.sparkSession.createDataFrame(list(enumerate(languages)), "place int, lang string")
    # 16 bytes for each bucket of each language, both bounded.
    table = counts.join(places, "lang").select("place", F.col("bucket").cast("int"), "n").toArrow()
    matrix[table.column("place").to_numpy(), table.column("bucket").to_numpy()] += table.column("n").to_numpy()
    matrix /= matrix.sum(axis=1, keepdims=True)
    return Model(languages, np.log(matrix, out=matrix))


def log_likelihoods(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Per text and language the log-likelihood, and per text whether it has n-grams.

    A text's n-grams are cut at places that depend on the text alone, and each cut is summed by itself.
    """
    totals, seen = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts), bool)
    held: list[np.ndarray] = []
    rows: list[int] = []
    size = 0

    def add_held() -> None:
        starts = np.concatenate(([0], np.cumsum([len(one) for one in held[:-1]]))).astype(np.int64)
        index = np.concatenate(held)
        for place, of_language in enumerate(model.log_probability):
            np.add.at(totals[:, place], rows, np.add.reduceat(of_language.take(index), starts))

    for row, text in enumerate(texts):
        for buckets in ngram_buckets(text or ""):
            seen[row] = True
            for start in range(0, len(buckets), _CUT):
                cut = buckets[start : start + _CUT]
                if size + len(cut) > _CUT and held:
                    add_held()
                    held, rows, size = [], [], 0
                held.append(cut)
                rows.append(row)
                size += len(cut)
    if held:
        add_held()
    return totals, seen


def predict_batch(texts: list[str | None], model: Model) -> list[tuple[str, float]]:
    """The likeliest language of each text and its posterior with equal priors."""
    if not model.languages:
        return [(UNKNOWN, 0.0)] * len(texts)
    totals, seen = log_likelihoods(texts, model)
    best = totals.argmax(axis=1)
    posterior = 1.0 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
    return [(model.languages[b], float(p)) if s else (UNKNOWN, 0.0) for b, p, s in zip(best, posterior, seen)]


def predict_one(text: str | None, model: Model) -> tuple[str, float]:
    return predict_batch([text], model)[0]


_PREDICTED = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())]
)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score per row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = predict_batch(batch.column("text").to_pylist(), shared.value)
            names, scores = zip(*found)
            columns = [batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), pa.array(names), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, schema=_PREDICTED)

    rows = only(docs, "doc_id", "text").select("doc_id", is_held_out().alias("held_out"), "text")
    return rows.mapInArrow(score, "doc_id long, held_out boolean, lang_pred string, score double")
