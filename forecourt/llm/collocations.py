"""Phrase collocations by a multikey three-way quicksort of suffix pointers.

Every word of a piece begins a suffix of at most ``DEPTH`` words. Suffixes are routed by their leading words
to ranges of their order, so that a range is one task's work whatever word is hot; equal suffixes of a batch are
counted before. In a range the pointers are sorted word by word: a pivot parts them in less, equal and greater,
and only the equal part goes on to the next word. The weight of an equal part is the count of its words as a
phrase, and a part that weighs less than the least count is abandoned, as no phrase in it can be frequent.

Only phrases that begin the range's bounds can have occurrences in other ranges. They are counted in each range
whatever they weigh, and the counts of the ranges are added up. The words of a language are counted alike, as
the phrase without words. So all counts are exact; the sample that the bounds come from decides the balance alone.

Null text is empty, null lang is ``und``. Repeated rows count each. Empty texts and tables give no rows, and
columns other than text and lang are ignored. Scores are computed in exact decimals; counts of 10^16 or more
raise an error.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import only, slices, text_or_empty
from forecourt.session import stage

DEPTH = 5
LEAST_COUNT = 100
SHARE_PERCENT = 100
PER_LANG = 2000
SCALE = 1000
NO_LANG = "und"

#: Suffixes of a range, while there are at most MOST_RANGES of them; beyond that ranges grow. The bounds take
#: at most DEPTH * BOUND_BYTES bytes each, so 21 MB in all.
RANGE_WORDS = 1_000_000
MOST_RANGES = 1 << 18
DRAWS_PER_RANGE = 4
BOUND_BYTES = 16
_WINDOW_CHARS = 256
_WORD_BYTES = 6  # of a word and what parts it from the next; for the number of ranges only
_CHUNK_WORDS = 1_500_000
_SLICE_BYTES = 3 * 1024 * 1024

# Fixed values of the contract: what ends a piece, and what parts words.
_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_PARTS = _ENDS.copy()
_PARTS[list(b" \t")] = True

Bound = tuple[str, tuple[bytes, ...]]


def tokenize(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words of the texts in a row, the number of each one's piece, and of its text."""
    lower = pc.ascii_lower(texts)
    _, offsets, data = lower.buffers()
    bounds = np.frombuffer(offsets, np.int32)[lower.offset : lower.offset + len(lower) + 1].astype(np.int64)
    whole = (np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8))[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    inside = ~_PARTS[whole]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    # A text begins a word and a piece.
    begins = bounds[:-1][bounds[:-1] < len(whole)]
    starts[begins] = inside[begins]
    first = np.flatnonzero(starts)
    text = np.searchsorted(bounds, first, "right") - 1
    piece = np.cumsum(_ENDS[whole])[first] + text
    place_in_words = np.cumsum(inside) - inside
    ends = np.append(place_in_words[first], inside.sum()).astype(np.int32)
    letters = pa.py_buffer(whole[inside])
    return pa.StringArray.from_buffers(len(first), pa.py_buffer(ends), letters), piece, text


def suffixes(words: np.ndarray, piece: np.ndarray, n: int) -> list[np.ndarray]:
    """The n-word suffixes' words, one array per place; 0 behind the end of a piece."""
    columns = [words[:n]]
    for d in range(1, DEPTH):
        column = np.zeros(n, words.dtype)
        m = max(0, min(n, len(words) - d))
        column[:m] = np.where(piece[d : m + d] == piece[:m], words[d : m + d], 0)
        columns.append(column)
    return columns


def _order(columns: list[np.ndarray]) -> np.ndarray:
    """The order of the rows, first column first; several columns are packed into one key."""
    bits = max(1, int(max(column.max() for column in columns)).bit_length())
    per_key = max(1, 62 // bits)
    keys = []
    for at in range(0, len(columns), per_key):
        key = columns[at].astype(np.int64)
        for column in columns[at + 1 : at + per_key]:
            key = key << bits | column
        keys.append(key)
    return np.lexsort(keys[::-1])


def _bound_places(columns: list[np.ndarray], words: list[bytes], bounds: list[tuple[bytes, ...]]) -> list[int]:
    """Where each bound falls among the sorted rows of ``columns``, whose ids are places in ``words`` plus one."""
    places = []
    for bound in bounds:
        low, high = 0, len(columns[0])
        for depth, word in enumerate(bound):
            at = bisect_right(words, word)
            known = at > 0 and words[at - 1] == word
            column = columns[depth]
            # Ids up to ``at`` are words up to this one.
            low, above = low + np.searchsorted(column[low:high], at if known else at + 1), high
            if not known:
                break
            high = low + np.searchsorted(column[low:above], at, "right")
            if low == high:
                break
        places.append(int(low))
    return places


_BLOCK = pa.schema([
    ("range", pa.int32()), ("lang", pa.string()), ("sizes", pa.binary()), ("shared", pa.binary()),
    ("counts", pa.binary()), ("words", pa.binary()),
])
_BLOCK_SQL = "range int, lang string, sizes binary, shared binary, counts binary, words binary"


def blocks_of(texts: pa.Array, langs: pa.Array, bounds: list[Bound]) -> Iterator[pa.RecordBatch]:
    """The distinct suffixes of the texts with their counts, a row per range and language.

    A suffix is written without the words that it shares with the one before.
    """
    all_words, piece, text = tokenize(texts)
    coded = langs.dictionary_encode()
    lang_of, lang_names = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    for start in range(0, len(all_words), _CHUNK_WORDS):
        n = min(_CHUNK_WORDS, len(all_words) - start)
        ahead = min(len(all_words), start + n + DEPTH - 1)
        chunk = all_words.slice(start, ahead - start).cast(pa.binary()).dictionary_encode()
        by_bytes = pc.array_sort_indices(chunk.dictionary)
        dictionary = chunk.dictionary.take(by_bytes)
        number = np.empty(len(by_bytes), np.int32)
        number[by_bytes.to_numpy()] = np.arange(1, len(by_bytes) + 1)
        columns = suffixes(number[chunk.indices.to_numpy()], piece[start:ahead], n)
        columns.insert(0, lang_of[text[start : start + n]].astype(np.int32))
        order = _order(columns)
        columns = [column[order] for column in columns]
        same = np.ones(n - 1, bool)
        shared = np.zeros(n, np.uint8)
        for depth, column in enumerate(columns):
            same &= column[1:] == column[:-1]
            if depth:
                shared[1:] += same
        first = np.flatnonzero(np.append(True, ~same))
        counts = np.diff(np.append(first, n)).astype(np.uint32)
        columns, shared = [column[first] for column in columns], shared[first]
        yield from _cut_blocks(columns, shared, counts, dictionary, lang_names, bounds)


def _cut_blocks(columns, shared, counts, dictionary, lang_names, bounds: list[Bound]) -> Iterator[pa.RecordBatch]:
    langs, columns = columns[0], columns[1:]
    names = dictionary.to_pylist()
    starts, ranges, block_langs = [], [], []
    for code in np.unique(langs).tolist():
        low, high = np.searchsorted(langs, [code, code + 1]).tolist()
        before = bisect_right(bounds, (lang_names[code], ()))
        # No word begins with this byte.
        own = [words for _, words in bounds[before : bisect_right(bounds, (lang_names[code], (b"\xff",)))]]
        places = [low + at for at in _bound_places([column[low:high] for column in columns], names, own)]
        for number, (at, end) in enumerate(zip([low, *places], [*places, high])):
            if at < end:
                starts.append(at)
                ranges.append(before + number)
                block_langs.append(lang_names[code])
    shared[starts] = 0
    matrix = np.stack(columns, axis=1)
    sizes = (matrix > 0).sum(axis=1).astype(np.uint8)
    written = np.arange(DEPTH) >= shared[:, None]
    written &= matrix > 0
    flat = dictionary.take(pa.array(matrix[written] - 1))
    in_block = np.add.reduceat(written.sum(axis=1), starts)
    listed = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(in_block))).astype(np.int32)), flat)
    edges = np.append(starts, len(counts))

    def packed(values: np.ndarray) -> pa.Array:
        ends = (edges * values.itemsize).astype(np.int32)
        return pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(values)])

    arrays = [
        pa.array(ranges, pa.int32()), pa.array(block_langs, pa.string()), packed(sizes), packed(shared), packed(counts),
        pc.binary_join(listed, b" "),
    ]
    yield pa.RecordBatch.from_arrays(arrays, schema=_BLOCK)


def _read_blocks(blocks: pa.Table) -> tuple[list[np.ndarray], np.ndarray, pa.Array]:
    """Word columns (0: none), counts and the dictionary of some blocks."""

    def values(name: str, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(blocks.column(name).to_pylist()), kind)

    sizes, shared, counts = values("sizes", np.uint8), values("shared", np.uint8), values("counts", np.uint32)
    words = pa.concat_arrays([pc.split_pattern(chunk.cast(pa.binary()), b" ").flatten() for chunk in blocks.column("words").chunks])
    coded = words.dictionary_encode()
    new = coded.indices.to_numpy() + 1
    n_new = sizes.astype(np.int64) - shared
    start = np.cumsum(n_new) - n_new
    columns, row = [], np.arange(len(sizes))
    for d in range(DEPTH):
        # The word at this place is the row's own, or that of the last row that wrote it.
        own = (shared <= d) & (d < sizes)
        writer = np.maximum.accumulate(np.where(shared <= d, row, 0))
        column = np.zeros(len(sizes), np.int32)
        column[own] = new[(start + d - shared)[own]]
        columns.append(column[writer])
    return columns, counts.astype(np.int64), coded.dictionary


def frequent_prefixes(columns: list[np.ndarray], weights: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Row, number of words and weight of every sequence of leading words that weighs at least ``least``.

    The multikey quicksort: parts below ``least`` are abandoned, the others are sorted by the next word.
    """
    parts = [(np.arange(len(weights)), 0)] if weights.sum() >= least else []
    while parts:
        rows, depth = parts.pop()
        keys = columns[depth][rows]
        some = np.sort(keys[:: max(1, len(keys) // 9)])
        pivot = some[len(some) // 2]
        equal = keys == pivot
        for side in (rows[keys < pivot], rows[keys > pivot]):
            if len(side) and weights[side].sum() >= least:
                parts.append((side, depth))
        if not pivot:
            continue
        rows = rows[equal]
        weight = int(weights[rows].sum())
        if weight < least:
            continue
        yield int(rows[0]), depth + 1, weight
        if depth + 1 < len(columns):
            parts.append((rows, depth + 1))


def _count_range(blocks: pa.Table, bounds: list[Bound], least: int) -> Iterator[tuple[str, int, bytes, int]]:
    """lang, number of words, phrase and count in one range; counts of bounds' beginnings may be parts of a whole."""
    number = blocks.column("range")[0].as_py()
    near = bounds[max(0, number - 1) : number + 1]
    for lang in pc.unique(blocks.column("lang")).to_pylist():
        columns, weights, dictionary = _read_blocks(blocks.filter(pc.equal(blocks.column("lang"), lang)))
        yield lang, 0, b"", int(weights.sum())
        split = {words[:size] for name, words in near if name == lang for size in range(1, len(words) + 1)}
        for words in split:
            places = pc.index_in(pa.array(words, pa.binary()), dictionary).to_pylist()
            rows = np.ones(len(weights), bool)
            for column, place in zip(columns, places):
                rows &= column == (-1 if place is None else place + 1)
            if rows.any():
                yield lang, len(words), b" ".join(words), int(weights[rows].sum())
        for row, size, weight in frequent_prefixes(columns, weights, least):
            words = tuple(dictionary[int(column[row]) - 1].as_py() for column in columns[:size])
            if words not in split:
                yield lang, size, b" ".join(words), weight


def _texts(docs: DataFrame) -> DataFrame:
    return only(docs, "text", "lang").select(text_or_empty().alias("text"), F.coalesce("lang", F.lit(NO_LANG)).alias("lang"))


def range_bounds(texts: DataFrame) -> list[Bound]:
    """Suffixes that part the others in ranges of about RANGE_WORDS.

    Drawn from windows at hashed places of the texts, in proportion to their lengths. Words are cut to
    BOUND_BYTES: any sequence of words can be a bound.
    """
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_ranges = min(MOST_RANGES, -(-n_bytes // (_WORD_BYTES * RANGE_WORDS)))
    if n_ranges < 2:
        return []
    share = n_ranges * DRAWS_PER_RANGE / n_bytes
    drawn = F.octet_length("text") * F.lit(share) + F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / (1 << 20)
    windows = (
        texts.withColumn("draws", F.floor(drawn).cast("int"))
        .where(F.col("draws") > 0)
        .select("lang", "text", F.explode(F.sequence(F.lit(1), "draws")).alias("draw"))
        .withColumn("start", (F.pmod(F.xxhash64("draw", F.xxhash64("text")), F.length("text")) + 1).cast("int"))
        .select("lang", F.substring("text", F.col("start"), F.lit(_WINDOW_CHARS)).alias("text"))
    )

    def seconds(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, piece, text = tokenize(batch.column("text"))
            rows = []
            # The first word of a window may be a part of one.
            for at in np.flatnonzero(text[1:] == text[:-1]) + 1:
                if at < 2 or text[at - 2] != text[at]:
                    end = at + int((piece[at : at + DEPTH] == piece[at]).sum())
                    suffix = [w.as_py().encode()[:BOUND_BYTES] for w in words[at:end]]
                    rows.append({"lang": batch.column("lang")[int(text[at])].as_py(), "suffix": suffix})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("lang", pa.string()), ("suffix", pa.list_(pa.binary()))]))

    sample = windows.mapInArrow(seconds, "lang string, suffix array<binary>").collect()
    found = sorted((lang.encode(), tuple(map(bytes, suffix))) for lang, suffix in sample)
    picked = {found[i * len(found) // n_ranges] for i in range(1, n_ranges)} if found else set()
    return sorted((lang.decode(), words) for lang, words in picked)


def phrase_counts(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """lang, size, phrase and n: all phrases of 1 to DEPTH words with n >= least, and all words of a language as size 0."""
    texts = _texts(docs)
    shared = docs.sparkSession.sparkContext.broadcast(range_bounds(texts))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1 << 20, _SLICE_BYTES):
            yield from blocks_of(batch.column("text"), batch.column("lang"), shared.value)

    def count(blocks: pa.Table) -> pa.Table:
        rows = list(_count_range(blocks, shared.value, least))
        names, kinds = ("lang", "size", "phrase", "n"), (pa.string(), pa.int32(), pa.string(), pa.int64())
        pa.default_memory_pool().release_unused()
        return pa.table([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names=names)

    blocks = texts.mapInArrow(cut, _BLOCK_SQL)
    counted = blocks.groupBy("range").applyInArrow(count, "lang string, size int, phrase string, n long")
    whole = counted.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    return whole.where((F.col("size") == 0) | (F.col("n") >= least))


def _words(first, size):
    return F.array_join(F.slice("words", first, size), " ")


def collocations(
    docs: DataFrame, least: int = LEAST_COUNT, share_percent: int = SHARE_PERCENT, per_lang: int = PER_LANG
) -> DataFrame:
    """The best phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Each phrase is scored by its weakest cut into two. A phrase inside a longer one that has at least
    ``share_percent`` of its occurrences is dropped.
    """
    counts = stage(phrase_counts(docs, least), "phrase_counts")
    totals = stage(counts.where("size = 0").select("lang", F.col("n").alias("total")), "lang_words")
    known = counts.where("size between 1 and 4").select("lang", "phrase", "n")
    phrases = counts.where("size >= 2").select("lang", "phrase", "size", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))

    size, first, length = F.col("size"), F.col("first"), F.col("length")
    inner = (
        phrases.where("size >= 3")
        .select("lang", "a", "words", "size", F.explode(F.sequence(F.lit(2), size - 1)).alias("length"))
        .select("lang", "a", "words", "length", F.explode(F.sequence(F.lit(1), size - length + 1)).alias("first"))
        .select("lang", "a", _words(first, length).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    )
    covered = F.lit(100) * F.col("longest") >= F.lit(share_percent) * F.col("a")
    kept = phrases.join(inner, ["lang", "phrase"], "left").where(F.col("longest").isNull() | ~covered)

    cuts = kept.select("lang", "phrase", "a", "words", "size", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumns({"left": _words(F.lit(1), F.col("k")), "right": _words(F.col("k") + 1, size - F.col("k"))}).drop("words", "size")
    lefts = known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    rights = known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    cuts = cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"]).join(totals, "lang")
    wide = {name: F.col(name).cast("decimal(16,0)") for name in ("a", "total", "l", "r")}
    scaled = F.lit(SCALE).cast("decimal(4,0)") * (wide["a"] * wide["total"])
    cuts = cuts.withColumn("scaled", scaled).withColumn("product", wide["l"] * wide["r"]).withColumn("score", F.expr("scaled div product"))
    weakest = F.min(F.struct("score", "k", "l", "r", F.col("total").alias("n"))).alias("weakest")
    scored = cuts.groupBy("lang", "phrase", "a").agg(weakest).select("lang", "phrase", "a", "weakest.*")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= per_lang)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
