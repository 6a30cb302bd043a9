"""Quality rules: length and repetition counts, then divergence from language references.

Each document is described by two histograms, one over character classes and one over the
corpus's common words. The references are the same histograms summed over all documents of a
language. A document is rejected if its Jensen-Shannon distance (base 2) from the *nearest*
reference is too large; documents too short for a stable histogram pass that test.

Common words are the fullest of 16,384 hash buckets of words, so counting the whole corpus takes
one pass, a fixed amount of memory per task and one small shuffle. Nulls count as empty text;
an empty corpus has no references and then only the counted rules apply. A repeated row gets its
own result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import only, slices
from forecourt.session import stage

N_BUCKETS = 1 << 14
MAX_LANGUAGES = 512  # bounds the references (16,384 numbers each at most); more is an error, none is left out
_CLASSES = ("lower", "upper", "digit", "space", "punctuation", "symbol", "other", "beyond_ascii")
_CONTINUATION = len(_CLASSES)  # bytes that start no character
_SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"

STATISTICS = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, char_distance double, word_distance double, kept boolean"
)


def _class_table() -> np.ndarray:
    table = np.full(256, 6, dtype=np.uint8)
    table[ord("a") : ord("z") + 1], table[ord("A") : ord("Z") + 1], table[ord("0") : ord("9") + 1] = 0, 1, 2
    table[[ord(c) for c in _SPACES]] = 3
    table[[ord(c) for c in ".,;:!?'\"()-"]] = 4
    table[[ord(c) for c in _SYMBOLS]] = 5
    table[0x80:0xC0], table[0xC0:] = _CONTINUATION, 7
    return table


_CLASS_OF_BYTE = _class_table()


@dataclass(frozen=True)
class Thresholds:
    """Base rules and divergence limits. Distances lie between 0 and 1."""

    min_words: int = 50
    max_repeat_percent: int = 50
    common_words: int = 64
    char_guard: int = 200  # characters below which the class histogram is not judged
    word_guard: int = 100  # words below which the common-word histogram is not judged
    max_char_distance: float = 0.30
    max_word_distance: float = 0.50


@dataclass(frozen=True)
class References:
    """Per language a class histogram and a common-word histogram (last column: all other words)."""

    languages: tuple[str, ...]
    classes: np.ndarray
    column_of_bucket: np.ndarray
    words: np.ndarray


def class_counts(encoded: bytes) -> np.ndarray:
    return np.bincount(_CLASS_OF_BYTE[np.frombuffer(encoded, np.uint8)], minlength=_CONTINUATION + 1)[:_CONTINUATION]


def bucket_of(word: bytes) -> int:
    return zlib.crc32(word) & (N_BUCKETS - 1)


def _count_batch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    classes: dict[str, np.ndarray] = {}
    buckets: dict[str, np.ndarray] = {}
    for batch in slices(batches):
        words: dict[str, Counter] = {}
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            encoded = text.encode()
            if lang not in classes:
                classes[lang] = np.zeros(len(_CLASSES), np.int64)
                buckets[lang] = np.zeros(N_BUCKETS, np.int64)
            classes[lang] += class_counts(encoded)
            words.setdefault(lang, Counter()).update(encoded.split())
        for lang, counter in words.items():
            np.add.at(
                buckets[lang],
                np.fromiter(map(bucket_of, counter), np.int64, len(counter)),
                np.fromiter(counter.values(), np.int64, len(counter)),
            )
    for lang in classes:
        for kind, counts in (("class", classes[lang]), ("word", buckets[lang])):
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang] * len(used), "kind": [kind] * len(used), "bin": used, "n": counts[used]},
                pa.schema([("lang", pa.string()), ("kind", pa.string()), ("bin", pa.int64()), ("n", pa.int64())]),
            )


def language_references(docs: DataFrame, thresholds: Thresholds = Thresholds()) -> References:
    """Histograms of every language over all its documents; documents without a language add none.

    What reaches the driver per language: eight classes, the total, and its counts in the buckets that are among the
    fullest of any language, at most N_BUCKETS.
    """
    counted = stage(
        only(docs, "text", "lang")
        .where("text IS NOT NULL AND lang IS NOT NULL")
        .mapInArrow(_count_batch, "lang string, kind string, bin long, n long")
        .groupBy("lang", "kind", "bin")
        .agg(F.sum("n").alias("n")),
        "histograms",
    )
    by_size = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "bin")
    ranked = counted.select(
        "*",
        F.row_number().over(by_size).alias("place"),
        F.sum("n").over(Window.partitionBy("lang", "kind")).alias("total"),
    )
    rows = (
        ranked.where(F.col("place") <= F.greatest(F.lit(len(_CLASSES)), F.lit(thresholds.common_words)))
        .limit(MAX_LANGUAGES * (len(_CLASSES) + thresholds.common_words) + 1)
        .toArrow()
        .to_pylist()
    )
    languages = tuple(sorted({row["lang"] for row in rows}))
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} values of lang: not a column of languages")
    row_of = {lang: i for i, lang in enumerate(languages)}
    common = sorted({r["bin"] for r in rows if r["kind"] == "word" and r["place"] <= thresholds.common_words})
    column_of_bucket = np.full(N_BUCKETS, len(common), np.int64)
    column_of_bucket[common] = np.arange(len(common))
    classes = np.zeros((len(languages), len(_CLASSES)))
    words = np.zeros((len(languages), len(common) + 1))
    # A bucket common in one language counts in all: take its share in each from the counts.
    in_common = (F.col("kind") == "word") & F.col("bin").isin(common)
    places = docs.sparkSession.createDataFrame(list(enumerate(languages)), "place int, lang string")
    shared = counted.where(in_common).join(places, "lang").select("place", F.col("bin").cast("int"), "n").toArrow()
    for row in rows:
        if row["kind"] == "class":
            classes[row_of[row["lang"]], row["bin"]] = row["n"] / row["total"]
    totals = np.ones(len(languages))
    for row in rows:
        if row["kind"] == "word":
            totals[row_of[row["lang"]]] = row["total"]
    place = shared.column("place").to_numpy()
    words[place, column_of_bucket[shared.column("bin").to_numpy()]] = shared.column("n").to_numpy() / totals[place]
    words[:, -1] = np.maximum(0.0, 1.0 - words[:, :-1].sum(axis=1))
    return References(languages, classes, column_of_bucket, words)


def jensen_shannon(p: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Distance (square root of the divergence, base 2) of one histogram from each reference."""
    middle = (references + p) / 2

    def against(q: np.ndarray) -> np.ndarray:
        ratio = np.divide(q, middle, out=np.ones_like(middle), where=(q > 0) & (middle > 0))
        return (q * np.log2(ratio)).sum(axis=1)

    return np.sqrt(np.clip((against(np.broadcast_to(p, middle.shape)) + against(references)) / 2, 0.0, 1.0))


def repeated_words(ids: np.ndarray) -> int:
    """Words inside three-word windows that occur at least twice in the text, first ones included."""
    if len(ids) < 4:
        return 0
    width = int(ids.max()) + 1
    pairs = ids[:-1] * width + ids[1:]
    if width >= 1 << 21:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * width + ids[2:]
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[which] > 1
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift : len(ids) - 2 + shift] |= again
    return int(covered.sum())


def judge(text: str | None, references: References, limits: Thresholds) -> tuple:
    """All counts and verdicts of one text, in the order of the result's columns after doc_id."""
    text = text or ""
    encoded = text.encode()
    words = encoded.split()
    n_words = len(words)
    local: dict[bytes, int] = {}
    ids = np.fromiter((local.setdefault(word, len(local)) for word in words), np.int64, n_words)
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    n_repeat = repeated_words(ids)
    n_chars = len(text)
    failed = n_words < limits.min_words or 100 * n_repeat > limits.max_repeat_percent * n_words
    char_distance = word_distance = None
    if len(references.languages):
        if n_chars >= limits.char_guard:
            counts = class_counts(encoded)
            char_distance = float(jensen_shannon(counts / counts.sum(), references.classes).min())
        if n_words >= limits.word_guard:
            buckets = np.fromiter(map(bucket_of, local), np.int64, len(local))
            columns = references.column_of_bucket[buckets]
            counts = np.bincount(columns, np.bincount(ids, minlength=len(local)), references.words.shape[1])
            word_distance = float(jensen_shannon(counts / n_words, references.words).min())
    strange = (char_distance or 0.0) > limits.max_char_distance or (word_distance or 0.0) > limits.max_word_distance
    return (
        n_words,
        n_chars - sum(text.count(c) for c in _SPACES),
        sum(text.count(c) for c in _SYMBOLS),
        len(lines) - len(set(lines)),
        n_repeat,
        failed,
        char_distance,
        word_distance,
        not (failed or strange),
    )


_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        *[(name, pa.int64()) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        ("base_failed", pa.bool_()),
        ("char_distance", pa.float64()),
        ("word_distance", pa.float64()),
        ("kept", pa.bool_()),
    ]
)


def quality_report(docs: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Counts, distances and verdict per row of ``docs`` (doc_id, text, lang)."""
    references = language_references(docs, thresholds)

    def judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [judge(text, references, thresholds) for text in batch.column("text").to_pylist()]
            columns = [pa.array(c, t.type) for c, t in zip(zip(*rows), list(_RESULT)[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *columns], schema=_RESULT)

    return only(docs, "doc_id", "text").mapInArrow(judged, STATISTICS)


def keep_good(docs: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Rows of ``docs`` that pass, with their columns, without a join: judged where they are read."""
    references = language_references(docs, thresholds)

    def passing(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept = [judge(text, references, thresholds)[-1] for text in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(passing, docs.schema)
