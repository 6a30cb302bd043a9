"""Near-duplicate classes by DartMinHash, banding and an exact check.

A text is the weighted set of its five-word shingles; a shingle that occurs n times weighs
1 + ln(n). Similarity is the weighted Jaccard coefficient, linked at 0.8 or more, and classes are
the connected components of the links.

Sketch: every unit of weight of an element is a cell with its own hashed Poisson process of darts.
A dart has a rank, a coordinate and a position in the cell; it counts if the position lies within
the element's weight. The earliest dart per coordinate is the signature, so two texts agree in a
coordinate with probability equal to their similarity. Only darts up to a rank that fills the
coordinates are drawn, a number that does not depend on the length of the text beyond one draw per
cell.

Joining never emits the pairs of a bucket:

1. Texts equal after normalising are one node, found by a pre-aggregated group-by.
2. Every node of a bucket is compared with the least node of the bucket only.
3. Verified links are contracted to components. The nodes of buckets that still hold two components meet by
   prefixes: shingles are put in one order, rare ones first, and two texts at the similarity share one among the first
   ninth of the lighter text's weight and the first fifth of the other's. So texts that share a bucket by a common
   passage do not meet, however many they are. Nodes of an element's largest component are compared with those of
   other components only. A pair leaves the join if the weight from the shared element on allows the similarity and
   the packed signatures agree.

So each candidate pair is either inside one component already or has been checked exactly. Texts are
fetched once, for nodes that share a bucket; a bitmap of fixed size spares the others the shuffle.

Words are runs of letters and digits in lower case; fewer than five words make one shingle. Texts
without a word are nodes by their raw text (null counts as empty) and link to nothing else. Different
texts under one doc_id are documents of their own. Rows without doc_id go by a hash of their text.
An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import only, slices
from forecourt.llm.components import component_labels
from forecourt.session import stage

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 6
COORDINATES = BANDS * ROWS
# A pair at 0.8 agrees in 90 % of the one-bit coordinates; five standard deviations are allowed below.
MAX_DIFFERENT_BITS = round(COORDINATES * 0.1 + 5 * math.sqrt(COORDINATES * 0.09))

_WORD = re.compile(r"[^\W_]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_WORDS_KEPT = 300_000
_word_hashes: dict[str, int] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _hashes(words: list[str]) -> np.ndarray:
    if len(_word_hashes) > _WORDS_KEPT:
        _word_hashes.clear()
    for word in set(words).difference(_word_hashes):
        _word_hashes[word] = xxhash.xxh64_intdigest(word)
    return np.fromiter(map(_word_hashes.__getitem__, words), np.uint64, len(words))


def shingles(words: list[str]) -> np.ndarray:
    """One hash per shingle, in text order."""
    if not words:
        return np.empty(0, np.uint64)
    hashed = _hashes(words)
    width = min(SHINGLE, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for shift in range(width):
        total = _mix(total * _STEP + hashed[shift : shift + len(total)])
    return total


def weighted_set(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles in order and their weights."""
    elements, counts = np.unique(shingles(words_of(text or "")), return_counts=True)
    return elements, 1.0 + np.log(counts)


def similarity(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard coefficient; 0 if either set is empty."""
    _, at_left, at_right = np.intersect1d(left[0], right[0], assume_unique=True, return_indices=True)
    shared = np.minimum(left[1][at_left], right[1][at_right]).sum()
    total = left[1].sum() + right[1].sum() - shared
    return float(shared / total) if total else 0.0


def dart_min_hash(sets: list[tuple[np.ndarray, np.ndarray]], k: int = COORDINATES) -> np.ndarray:
    """A row of ``k`` dart hashes per non-empty weighted set (elements, weights)."""
    sizes = np.array([len(elements) for elements, _ in sets])
    elements = np.concatenate([e for e, _ in sets])
    weights = np.concatenate([w for _, w in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    n_cells = np.ceil(weights).astype(np.int64)
    first = np.cumsum(n_cells) - n_cells
    level = np.arange(n_cells.sum()) - np.repeat(first, n_cells)
    cells = _mix(np.repeat(elements, n_cells) + (level + 1).astype(np.uint64) * _STEP)
    widths = np.minimum(1.0, np.repeat(weights, n_cells) - level)
    owner = np.repeat(owner, n_cells)
    mass = np.bincount(owner, widths, len(sets))

    signature = np.zeros((len(sets), k), np.uint64)
    reach = (math.log(k) + 3) / mass  # expected (ln k + 3) darts per coordinate below this rank
    todo = np.ones(len(sets), bool)
    while todo.any():
        chosen = todo[owner]
        state, rank = cells[chosen], np.zeros(int(chosen.sum()))
        width, doc = widths[chosen], owner[chosen]
        keys, ranks, darts = [], [], []
        while len(state):
            state = _mix(state + _STEP)
            rank = rank - np.log(((state >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53) / k
            near = rank <= reach[doc]
            state, rank, width, doc = state[near], rank[near], width[near], doc[near]
            dart = _mix(state ^ _STEP)
            hit = ((dart >> np.uint64(40)).astype(np.float64) * 2.0**-24) < width
            keys.append(doc[hit] * k + ((dart[hit] & np.uint64(0xFFFFFFFF)) % np.uint64(k)).astype(np.int64))
            ranks.append(rank[hit])
            darts.append(dart[hit])
        key, rank, dart = np.concatenate(keys), np.concatenate(ranks), np.concatenate(darts)
        best = np.full(len(sets) * k, np.inf)
        np.minimum.at(best, key, rank)
        wins = rank == best[key]
        found = np.zeros(len(sets) * k, np.uint64)
        found[key[wins]] = dart[wins]
        full = np.isfinite(best).reshape(len(sets), k).all(axis=1)
        done = todo & full
        signature[done] = found.reshape(len(sets), k)[done]
        todo &= ~full
        reach = np.where(todo, reach * 2, reach)
    return signature


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of the signature."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP, parts.shape[:2]).copy()
    for row in range(ROWS):
        keys = _mix(keys * np.uint64(3) + parts[:, :, row])
    return keys.view(np.int64)


def packed_bits(signature: np.ndarray) -> np.ndarray:
    """One bit per coordinate, in signed 64-bit words."""
    bits = (_mix(signature) >> np.uint64(63)).astype(np.uint8)
    return np.packbits(bits, axis=1).view(np.int64)


N_BIT_WORDS = COORDINATES // 64
_BITS = [f"bits{i}" for i in range(N_BIT_WORDS)]
_SKETCH = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("own", pa.int64()),
        ("tie", pa.int64()),
        ("content", pa.binary()),
        ("bands", pa.list_(pa.int64())),
        *[(name, pa.int64()) for name in _BITS],
    ]
)


def _sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, most_rows=512):
        content, sets, places = [], [], []
        for place, text in enumerate(batch.column("text").to_pylist()):
            words = words_of(text or "")
            content.append(xxhash.xxh3_128_digest("w " + " ".join(words) if words else "t " + (text or "")))
            if words:
                elements, counts = np.unique(shingles(words), return_counts=True)
                sets.append((elements, 1.0 + np.log(counts)))
                places.append(place)
        bands: list = [None] * batch.num_rows
        bits = np.zeros((batch.num_rows, N_BIT_WORDS), np.int64)
        if sets:
            signature = dart_min_hash(sets)
            bits[places] = packed_bits(signature)
            for place, keys in zip(places, band_keys(signature)):
                bands[place] = keys
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("own"),
                batch.column("tie"),
                pa.array(content, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
                *[pa.array(bits[:, i]) for i in range(N_BIT_WORDS)],
            ],
            schema=_SKETCH,
        )


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, text, ``own`` (the doc_id, or for rows without one a hash of the text) and ``tie``, a hash of the text."""
    text = F.coalesce("text", F.lit("")).alias("text")
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    rows = only(docs, "doc_id", "text").select(doc_id, text)
    return rows.select("doc_id", F.coalesce("doc_id", F.xxhash64("text")).alias("own"), F.xxhash64("text").alias("tie"), "text")


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, own, tie, 16-byte content key, band keys (null without words) and packed bits of each row."""
    bits = ", ".join(f"{name} long" for name in _BITS)
    return _identified(docs).mapInArrow(
        _sketch, f"doc_id long, own long, tie long, content binary, bands array<long>, {bits}"
    )


def _alike(left: list[str], right: list[str]) -> Column:
    different = [F.bit_count(F.col(a).bitwiseXOR(F.col(b))) for a, b in zip(left, right)]
    return sum(different[1:], different[0]) <= MAX_DIFFERENT_BITS


@dataclass(frozen=True)
class KeyBitmap:
    """One bit per hash of a key, at most 16 MB: says which keys may be in a set. No key of the set is missed."""

    n_bits: int
    words: np.ndarray

    def place(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.n_bits))

    def has(self, places: np.ndarray) -> np.ndarray:
        return (self.words[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1) == 1


_MOST_BITS = 1 << 27


def key_bitmap(keys: DataFrame, key: str) -> KeyBitmap:
    """A bitmap of the keys. It grows with their number up to its limit and beyond that only loses sharpness."""
    n_bits = 1 << 16
    wanted = 16 * keys.count()
    while n_bits < min(wanted, _MOST_BITS):
        n_bits *= 2
    bitmap = KeyBitmap(n_bits, np.zeros(n_bits // 64, np.uint64))
    place = bitmap.place(key)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    words = keys.groupBy(F.floor(place / 64).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bitmap.words[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return bitmap


def in_bitmap(rows: DataFrame, key: str, bitmap: KeyBitmap, inside: bool = True) -> DataFrame:
    """The rows whose key may be in the set, or those whose key is surely not."""
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)

    def chosen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1 << 20):
            found = shared.value.has(batch.column(batch.num_columns - 1).to_numpy())
            yield batch.filter(pa.array(found == inside)).select(range(batch.num_columns - 1))

    placed = rows.select(*rows.columns, bitmap.place(key).alias("place"))
    return placed.mapInArrow(chosen, rows.schema)


def node_texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and text of the ``nodes`` (node, own, tie; distinct), written out."""
    likely = in_bitmap(_identified(docs).select("own", "tie", "text"), "own", key_bitmap(nodes, "own"))
    return stage(likely.join(nodes, ["own", "tie"]).groupBy("node").agg(F.max("text").alias("text")), "texts")


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, known = None, None
    for batch in slices(batches, most_rows=512):
        nodes = batch.column("a").to_pylist()
        texts = zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist())
        linked = []
        for node, (left, right) in zip(nodes, texts):
            if node != last:
                last, known = node, weighted_set(left)
            linked.append(similarity(known, weighted_set(right)) >= SIMILARITY)
        yield batch.filter(pa.array(linked, pa.bool_())).select(["a", "b"])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose texts reach the similarity, written out.

    Both joins meet plain shuffles, so a node with many pairs is split over tasks.
    """
    with_a = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    with_both = with_a.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    compared = with_both.select("a", "b", "text_a", "text_b").mapInArrow(_compare, "a long, b long")
    return stage(compared, "links")


_SLOTS = 1 << 18


def _slots(elements: np.ndarray) -> np.ndarray:
    return (elements & np.uint64(_SLOTS - 1)).astype(np.int64)


def _count_slots(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(_SLOTS, np.int64)
    for batch in slices(batches, most_bytes=1 << 20):
        slots = [_slots(weighted_set(text)[0]) for text in batch.column("text").to_pylist()]
        counts += np.bincount(np.concatenate(slots), minlength=_SLOTS)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["slot", "n"])


def slot_counts(texts: DataFrame) -> np.ndarray:
    """How often the shingles of each of 2^18 hash slots occur: a table of 2 MB, whatever the number of texts."""
    counts = texts.select("text").mapInArrow(_count_slots, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(_SLOTS, np.int64)
    table[counts.column("slot").to_numpy()] = counts.column("n").to_numpy()
    return table


def prefix(text: str, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """The first elements that may be the first shared ones of a link, the weight from each on, and the whole weight.

    The order is that of the slots' counts, then of the elements: any order is right, a common element early costs time.
    """
    elements, weights = weighted_set(text)
    order = np.lexsort((elements, counts[_slots(elements)]))
    left = np.cumsum(weights[order][::-1])[::-1]
    near = left >= SIMILARITY * left[0] * (1 - _SLACK)
    return elements[order][near], left[near], float(left[0])


_SLACK = 1e-9
# What two texts at the similarity share, as part of the sum of their weights.
_SHARED = SIMILARITY / (1 + SIMILARITY) * (1 - _SLACK)


def prefixes(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """element, node, label, weight and left (weight from the element on) of the prefixes of ``nodes`` (node, label)."""
    counts = texts.sparkSession.sparkContext.broadcast(slot_counts(texts))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most_rows=256):
            found = [prefix(text, counts.value) for text in batch.column("text").to_pylist()]
            at = np.repeat(np.arange(len(found)), [len(elements) for elements, _, _ in found])
            columns = {
                "element": np.concatenate([elements for elements, _, _ in found]).view(np.int64),
                "node": batch.column("node").to_numpy()[at],
                "label": batch.column("label").to_numpy()[at],
                "weight": np.array([weight for _, _, weight in found])[at],
                "left": np.concatenate([left for _, left, _ in found]),
            }
            yield pa.RecordBatch.from_pydict(columns)

    schema = "element long, node long, label long, weight double, left double"
    return texts.join(nodes, "node").select("node", "label", "text").mapInArrow(cut, schema)


def _meet(lighter: DataFrame, heavier: DataFrame) -> DataFrame:
    """Pairs of nodes of different components that share an element and may link by weights and packed bits."""
    names = ["node", "label", "weight", "left", *_BITS]
    a = lighter.select("element", *[F.col(n).alias(f"a_{n}") for n in names])
    b = heavier.select("element", *[F.col(n).alias(f"b_{n}") for n in names])
    ordered = F.struct("a_weight", "a_node") < F.struct("b_weight", "b_node")
    enough = F.least("a_left", "b_left") >= _SHARED * (F.col("a_weight") + F.col("b_weight"))
    alike = _alike([f"a_{n}" for n in _BITS], [f"b_{n}" for n in _BITS])
    apart = F.col("a_label") != F.col("b_label")
    met = a.join(b, (a["element"] == b["element"]) & apart & ordered & enough & alike)
    return met.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b"))


def _shared_by_labels(rows: DataFrame, key: str) -> DataFrame:
    """The values of ``key`` that rows of two labels have."""
    return rows.groupBy(key).agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select(key)


def _links_across(met: DataFrame, labels: DataFrame, stars: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between components whose nodes still share a bucket."""
    labelled = met.select("key", "node", *_BITS).join(labels, "node", "left")
    labelled = stage(labelled.withColumn("label", F.coalesce("label", "node")), "members")
    open_keys = stage(_shared_by_labels(labelled, "key"), "open")
    nodes = stage(labelled.join(open_keys, "key", "left_semi").select("node", "label", *_BITS).distinct(), "open_nodes")
    found = stage(prefixes(texts, nodes.select("node", "label")), "prefixes")
    per_label = found.groupBy("element", "label").agg(F.count(F.lit(1)).alias("n"))
    main = F.max(F.struct("n", "label"))["label"].alias("main")
    shared = stage(per_label.groupBy("element").agg(main, F.count(F.lit(1)).alias("labels")).where("labels > 1"), "shared")
    rows = stage(found.join(shared.drop("labels"), "element").join(nodes.drop("label"), "node"), "rows")
    short = rows.where(F.col("left") >= 2 * _SHARED * F.col("weight"))
    other = F.col("label") != F.col("main")
    pairs = _meet(short.where(other), rows).unionByName(_meet(short.where(~other), rows.where(other)))
    return verified(stage(pairs.distinct().join(stars, ["a", "b"], "left_anti"), "pairs"), texts)


def _classes(docs: DataFrame) -> DataFrame:
    """doc_id, own, tie, class_id, class_tie and n_same per row of ``docs``.

    A node is a content. Its number is the least ``own`` of its rows; other contents with that ``own`` get a hash
    below all doc_ids instead. ``class_id`` and ``class_tie`` tell the row that stands for the class.
    """
    sketched = stage(sketches(docs), "sketches")
    contents = stage(
        sketched.groupBy("content").agg(
            F.min(F.struct("own", "tie")).alias("least"),
            F.count(F.lit(1)).alias("n_same"),
            F.first("bands").alias("bands"),
            *[F.first(name).alias(name) for name in _BITS],
        ),
        "contents",
    )
    # Few or none: doc_ids with several contents that have no smaller one.
    shared_ids = stage(
        contents.groupBy(F.col("least.own").alias("own")).agg(F.min("content").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"),
        "shared_ids",
    ).select("own", "first")
    other = F.col("first").isNotNull() & (F.col("first") != F.col("content"))
    apart = F.xxhash64("content").bitwiseOR(F.lit(-(1 << 63)))
    nodes = contents.select("*", "least.own", "least.tie").drop("least").join(shared_ids, "own", "left")
    nodes = stage(nodes.withColumn("node", F.when(other, apart).otherwise(F.col("own"))).drop("first"), "nodes")
    members = nodes.select(F.explode("bands").alias("key"), "node", *_BITS)
    least = [f"least_{name}" for name in _BITS]
    shared = stage(
        members.groupBy("key")
        .agg(
            F.min("node").alias("pivot"),
            F.max("node").alias("last"),
            *[F.min_by(name, "node").alias(other) for name, other in zip(_BITS, least)],
        )
        .where("pivot < last")
        .drop("last"),
        "buckets",
    )
    met = stage(members.join(shared, "key"), "members")
    meeting = met.select("node").distinct().join(nodes.select("node", "own", "tie"), "node")
    texts = node_texts(docs, stage(meeting, "met"))
    stars = stage(
        met.where((F.col("node") != F.col("pivot")) & _alike(_BITS, least))
        .select(F.col("pivot").alias("a"), F.col("node").alias("b"))
        .distinct(),
        "pairs",
    )
    links = verified(stars, texts)
    more = _links_across(met, component_labels(links), stars, texts)
    labels = component_labels(links.unionByName(more))
    labelled = labels.join(nodes.select("node", "own", "tie"), "node")
    leaders = labelled.groupBy("label").agg(F.min(F.struct("own", "tie")).alias("leader"))
    leaders = stage(labels.join(leaders, "label").select("node", "leader"), "leaders")
    leader = F.coalesce("leader", F.struct("own", "tie"))
    class_of = stage(
        nodes.select("content", "node", "own", "tie", "n_same")
        .join(leaders, "node", "left")
        .select("content", leader["own"].alias("class_id"), leader["tie"].alias("class_tie"), "n_same"),
        "classes",
    )
    return sketched.select("doc_id", "own", "tie", "content").join(class_of, "content").drop("content")


def duplicate_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (the least doc_id of its class) and n_same (rows of equal words) per row of ``docs``."""
    return _classes(docs).select("doc_id", "class_id", "n_same")


def one_per_class(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` of each class: the least by doc_id, then by a hash of the text.

    Different texts under one doc_id are rows of their own. Rows without doc_id go by a hash of the text. Rows of
    classes of their own, nearly all, are told by a bitmap and stay where they are; only rows that may have to go
    are shuffled.
    """
    text = F.coalesce("text", F.lit(""))
    own, tie = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)), F.xxhash64(text)
    # The row travels as one column, so that none of its names can clash with ours.
    rows = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"), own.alias("own"), tie.alias("tie"))
    rows = rows.withColumn("key", F.xxhash64("own", "tie"))
    leads = (F.col("own") == F.col("class_id")) & (F.col("tie") == F.col("class_tie"))
    per_row = _classes(docs).groupBy("own", "tie").agg(F.min(leads).alias("leads"), F.count(F.lit(1)).alias("n"))
    doubtful = stage(per_row.where(~F.col("leads") | (F.col("n") > 1)).withColumn("key", F.xxhash64("own", "tie")), "doubtful")
    bitmap = key_bitmap(doubtful, "key")
    gone = doubtful.where(~F.col("leads")).select("own", "tie")
    kept = in_bitmap(rows, "key", bitmap).join(gone, ["own", "tie"], "left_anti").dropDuplicates(["own", "tie"])
    chosen = in_bitmap(rows, "key", bitmap, inside=False).unionByName(kept.select(*rows.columns))
    return chosen.select(*[F.col("row")[name].alias(name) for name in docs.columns])
